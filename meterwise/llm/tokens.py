"""Encoding with public tokenizers, shared by the packing and output operators.

Both vocabularies split a text at ASCII white space before any merge, so the
ids of a text are the ids of its pieces in order.  Pieces repeat a lot, so a
worker encodes each distinct piece once and keeps the result.  Texts holding
rarer white space (where a piece border is not certain), or what may be one of the
vocabulary's added tokens, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache

import public_tokenizers

# Other characters that some engine counts as white space.
_ODD_SPACE = re.compile(
    r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
# A space belongs to the piece after it; other white space stands alone.  A
# run of letters ends before ASCII punctuation too (but for the apostrophe, which
# both vocabularies join to what follows), so a word and the same word with a
# comma share a piece.
_LETTERS = r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+(?=[ \t\n\r!-&(-/:-@\[-`{-~])"
_SPACED = re.compile(rf" ?{_LETTERS}| ?[^ \t\n\r]+" r"|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+")
_PLAIN = re.compile(rf"{_LETTERS}|[^ \t\n\r]+")
# Pieces kept by a worker (about 200 bytes each); past it, new pieces are
# encoded again with each chunk of texts.
MAX_PIECES = 600_000


def split_spaced(text: str) -> list[str]:
    return _SPACED.findall(text)


def split_plain(text: str) -> list[str]:
    return _PLAIN.findall(text)


SPLITS = {"byte_bpe_50k.json": split_spaced, "word_bpe_49k.json": split_plain}


class Encoder:
    """Ids of whole texts as little-endian unsigned 16-bit bytes (both
    vocabularies have fewer than 65,536 ids)."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        # An added token may stand anywhere in a text, also in other letter case.
        self.added = tuple({t.content[:2].lower() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.split = SPLITS[name]
        self.kept: dict[str, bytes] = {"": b""}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("H", x.ids).tobytes() for x in found]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes | None] = [b""] * len(texts)
        gaps, new = [], {}
        for n, t in enumerate(texts):
            if not t:
                continue
            if _ODD_SPACE.search(t) or any(mark in t for mark in self.added):
                out[n] = self._encode([t])[0]
                continue
            pieces = self.split(t)
            found = list(map(self.kept.get, pieces))
            if None in found:
                at, missing = -1, found.count(None)
                for _ in range(missing):
                    at = found.index(None, at + 1)
                    new[pieces[at]] = None
                    gaps.append((found, at, pieces[at]))
                out[n] = found
            else:
                out[n] = b"".join(found)
        made = dict(zip(new, self._encode(list(new))))
        for found, at, piece in gaps:
            found[at] = made[piece]
        if len(self.kept) < MAX_PIECES:
            self.kept.update(made)
        return [x if isinstance(x, bytes) else b"".join(x) for x in out]


@cache
def encoder(name: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(name)


def chunks(texts: list, size: int = 512, chars: int = 2_000_000):
    """Slices of a list of texts, limited by number and by characters."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if i + 1 - start >= size or total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
