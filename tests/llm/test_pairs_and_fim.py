"""Operators 11 to 13 against brute force, with nulls, ties, repeated rows,
empty tables and clashing extra columns."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from meterwise.llm import fim, hard_negatives, queries, simhash

# ---- 11 hard negatives


def vectors():
    r = np.random.RandomState(5)
    centres = r.randn(6, 7)
    rows = []
    for i in range(500):
        v = centres[i % 6] + r.randn(7) * 0.3
        v = np.round(v) if i % 4 == 0 else v  # ties
        rows.append((i if i != 5 else None, [float(np.float32(x)) for x in v], int(r.randint(0, 4))))
    rows += [(1000 + i, [1.0] * 7, i % 3) for i in range(200)]  # one vector very often
    rows += [(2000, None, 1), (2100, [1.0, None] + [0.0] * 5, 1), (2200, [math.nan] * 7, 1),
             (2300, [math.inf] * 7, 2), (2400, [1e9] * 7, 2), (2500, [1.0, 2.0], 2), (2600, [], 3),
             (2700, [1.0] * 7, None), (60, [0.5] * 7, 3)]
    return rows + rows[100:130]


def brute_negatives(rows, every):
    held = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(
                x is None or not math.isfinite(x) or abs(x) >= 65536 for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        held[i] = min(held.get(i, (99, [])), (label, [math.floor(256 * x) for x in v]))
    out = set()
    for a, (own, q) in held.items():
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, p)), i, label) for i, (label, p) in held.items() if i != a)
        same = [(-s, i) for s, i, label in scores if label == own][:5]
        other = [(-s, i) for s, i, label in scores if label != own]
        for ps, p in same:
            window = [(s, i) for s, i in other if 80 * ps <= 100 * s <= 100 * ps][:5]
            out |= {(a, p, k + 1, i, ps, s) for k, (s, i) in enumerate(window)}
    return out


@pytest.mark.parametrize("shard_rows", [16_384, 100])
def test_hard_negatives(spark, shard_rows):
    rows = vectors()
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                  "vec_id long, embedding array<float>, label int, shard string, w int").repartition(5)
    got = hard_negatives.hard_negatives(spark, table, every=20, shard_rows=shard_rows).collect()
    want = brute_negatives(rows, 20)
    assert len(got) == len(want) > 300 and {tuple(r) for r in got} == want


def test_hard_negatives_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    got = hard_negatives.hard_negatives(spark, table)
    assert got.count() == 0 and got.columns == [c.split()[0] for c in hard_negatives.RESULT.split(", ")]
    one = spark.createDataFrame([(100, [1.0], 1)], table.schema)
    assert hard_negatives.hard_negatives(spark, one).count() == 0


def test_cells_come_in_order_and_bound_their_rows():
    r = np.random.RandomState(1)
    points = r.randint(-300, 300, (400, 6))
    books = hard_negatives.codebook(points[:, :3], 4), hard_negatives.codebook(points[:, 3:], 4)
    codes = [hard_negatives.nearest(points[:, a:a + 3], c) for a, c in zip((0, 3), books)]
    radii = [np.array([np.sqrt(((points[own == c, a:a + 3] - centres[c]) ** 2).sum(1)).max(initial=0)
                       for c in range(4)]) for a, own, centres in zip((0, 3), codes, books)]

    class Row:
        ids = np.arange(400, dtype="<i8").tobytes()
        labels = ids
        vectors = points.astype("<i4").tobytes()
        starts = np.zeros(17, "<i4").tobytes()
    Row.radii = np.concatenate(radii).tobytes()
    shard = hard_negatives.Shard(Row, books, 6)
    for q in r.randint(-300, 300, (20, 6)):
        cells = list(shard.cells(q))
        bounds = [b for b, _ in cells]
        assert bounds == sorted(bounds, reverse=True) and len({c for _, c in cells}) == 16
        for bound, cell in cells:
            inside = (codes[0] * 4 + codes[1]) == cell
            assert (points[inside] @ q <= bound).all()


# ---- 12 SimHash

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashed = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def classes_of(marks, linked):
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(len(marks)):
        for j in range(i):
            if linked(marks[i], marks[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(marks))]


@pytest.mark.parametrize("hot", [simhash.HOT, 2])
def test_simhash(spark, docs, no_docs, hot):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = simhash.simhash_classes(spark, docs, hot).collect()
    marks = [brute_fingerprint(t) for _, t in rows]
    own = classes_of(marks, lambda a, b: (a ^ b).bit_count() <= 4)
    want = Counter()
    for (d, _), m, c in zip(rows, marks, own):
        ids = [i for (i, _), o in zip(rows, own) if o == c and i is not None]
        want[d, m, min(ids, default=None)] += 1
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in found) == want
    assert simhash.simhash_classes(spark, no_docs).count() == 0


@pytest.mark.parametrize("hot", [10**6, 64, 3])
def test_simhash_links(spark, hot):
    """Random clouds and one dense cloud: outside hot buckets every linked pair,
    within them links that span the classes, never a wrong one."""
    r = random.Random(3)

    def cloud(centre, n, most):
        for _ in range(n):
            x = centre
            for _ in range(r.randint(0, most)):
                x ^= 1 << r.randrange(64)
            yield x
    marks = {0, *cloud(r.getrandbits(64), 250, 3)}
    for _ in range(25):
        marks |= set(cloud(r.getrandbits(64), 20, 9))
    marks = sorted(marks)
    fps = spark.createDataFrame([(int(x),) for x in np.array(marks, np.uint64).view(np.int64)], "fp long")
    got = {tuple(sorted((x["a"] & (1 << 64) - 1, x["b"] & (1 << 64) - 1)))
           for x in simhash.links(spark, fps, hot).collect()}
    close = lambda a, b: (a ^ b).bit_count() <= 4
    want = {(a, b) for i, b in enumerate(marks) for a in marks[:i] if close(a, b)}
    assert got <= want and len(want) > 1000
    if hot == 10**6:
        assert got == want
    assert len(set(classes_of(marks, close))) == len(set(classes_of(marks, lambda a, b: tuple(sorted((a, b))) in got)))


def test_simhash_hot_buckets_make_no_pairs(spark):
    """Many fingerprints of one bucket: rows grow with them, not with their pairs."""
    free = 64 - simhash._bits(0, simhash.CHAIN)
    r = random.Random(4)
    marks = {r.getrandbits(free) << 27 for _ in range(800)}
    fps = spark.createDataFrame([(simhash._signed(x),) for x in marks], "fp long")
    hot = spark.createDataFrame([(0,)], "key long")
    met = simhash.bucket_rows(fps, True).join(
        simhash.bucket_rows(fps, False).select("key").join(hot, "key", "left_anti"), "key")
    assert met.count() < 40 * len(marks)


# ---- 13 fill-in-middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def test_unit_ends():
    r = random.Random(1)
    parts = ["a", "b", " ", "\n", "\t", "\r", "\x0b", "\x08", "\x0e", "\x1f", "é", "漢", "😀", "\x7f", "\x80", "\xa0", "  "]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 40)))
        ends = fim.unit_ends(text.encode())
        running = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
        units = UNIT.findall(text)
        places = np.r_[0, np.cumsum([len(u.encode()) for u in units])].astype(int).tolist()
        assert running[-1] == len(units)
        assert [fim.select_end(ends, running, k) for k in range(len(units) + 1)] == places


def brute_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_fill_in_middle(spark, docs, no_docs, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(7000 + i, t) for i, t in enumerate(
        ["a <P> b", "x <S>", "<M>", "< P> < S> <", "<", "S> P> <S", "é 漢 😀\n", " ", "\n\n a", "a\xa0b c"] * 6)]
    table = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, form string, n int")
    got = Counter(tuple(r) for r in fim.fill_in_middle(table.repartition(3)).collect())
    assert got == Counter((d, *brute_fim(d, t)) for d, t in rows)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    table.write.parquet(f"{tmp_path}/documents.parquet")
    digest = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    made = queries.QUERIES["op13_fill_in_middle"](spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["output_sha256"], r["restored_sha256"]) for r in made) == Counter(
        (d, digest(brute_fim(d, t)[2]), digest(t)) for d, t in rows)
    assert fim.fill_in_middle(no_docs).count() == 0
