"""Operator 3: secret scans with a random forest against false positives.

A scanner with high recall proposes findings: long runs of key-like characters
with a digit or without lower-case letters, and any value (quoted from 4, bare from 6
characters on, up to 512; longer ones as runs) that is assigned to a name with a credential word in it (names are
split at punctuation and camel case).  Each finding gets the features
named in ``FEATURES``; a random forest trained on labelled findings decides
which are secrets.  Labelled findings may be given; without them, findings are
labelled by issuer formats and by assignments to credential names, on all
findings, and a bounded sample of each class trains the forest.  The issuer
formats are no features.  Dictionary coverage is the share of a value's letter groups
that are common among the words of all documents.

Defined cases: null and empty texts have no finding; with labels of one class
only, every finding keeps that class; repeated rows are scanned each on its
own; an empty table gives no finding; extra columns are ignored (``redacted``
carries them along).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.common import read_table, work_path, written

# The bound of the labelled sample the forest is fitted on, by class.
MAX_FINDINGS = 3_000
TREES = 24
DEPTH = 6
SEED = 7
THRESHOLD = 0.5
MASK = "[SECRET]"
FEATURES = (
    "length", "digits", "uppers", "lowers", "transitions", "distinct", "entropy",
    "dictionary", "credential_word", "assigned", "quoted", "placeholder_word", "example_path")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Formats of issuers and names that credentials are given.
_ISSUED = re.compile(
    r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,})$")
_CREDENTIAL_WORDS = frozenset(
    "password passwd passphrase passcode pass pwd token secret secrets auth bearer credential credentials apikey".split())
_KEY_KINDS = frozenset("api access private secret signing encryption auth master account storage".split())
_PLACEHOLDER_WORDS = frozenset(
    "example examples sample dummy changeme placeholder fake your xxxx test tests testing redacted todo".split())
_ASSIGNED = re.compile(r"""[=:>]\s*["'`]?$""")
# A name, a sign of assignment, and a quoted value or one without spaces.
_ASSIGNMENT = re.compile(
    r"""([A-Za-z][\w.\-]{1,63})["'\]]{0,2}[ \t]{0,3}(?::=|=>|[:=])[ \t]{0,3}"""
    r"""(?:"([^"\n]{4,512})"|'([^'\n]{4,512})'|`([^`\n]{4,512})`|([^\s"'`,;]{6,512}))""")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_EXAMPLE_PATH = re.compile(r"(?i)test|example|sample|fixture|doc|demo")
_LETTER_WORDS = re.compile(r"[a-z]{3,}")
# Distinct words that a task counts before it adds up their letter groups.
WORDS_AT_ONCE = 200_000


def parts_of(name: str) -> list[str]:
    """The words of a name, in lower case: split at punctuation, digits and
    camel case."""
    return [p.lower() for p in _PARTS.findall(name)]


def names_credential(parts: list[str]) -> bool:
    return any(p in _CREDENTIAL_WORDS for p in parts) or any(
        k == "key" and p in _KEY_KINDS for p, k in zip(parts, parts[1:]))


def _groups(word: str) -> list[int]:
    """The letter groups (three letters a-z) of a word, as numbers."""
    c = [ord(x) - 97 for x in word]
    return [26 * (26 * x + y) + z for x, y, z in zip(c, c[1:], c[2:])]


def common_groups(docs: DataFrame) -> np.ndarray:
    """Which of the 26^3 letter groups are more frequent in the words of all
    documents than an average one.  A task gives one row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words, seen = np.zeros(26 ** 3, np.int64), Counter(), False

        def add() -> None:
            for w, n in words.items():
                for g in _groups(w):
                    total[g] += n
            words.clear()

        for batch in batches:
            for t in batch.column("text"):
                seen = True
                words.update(_LETTER_WORDS.findall((t.as_py() or "").lower()))
                if len(words) > WORDS_AT_ONCE:
                    add()
        if seen:
            add()
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["g", "n"])

    rows = docs.select("text").mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(26 ** 3)
    out[[r["g"] for r in rows]] = [r["n"] for r in rows]
    return out > out.mean()


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def candidates(text: str) -> list[tuple[int, int, bool]]:
    """start, end and whether a credential name is given this value; what
    overlaps an assigned value belongs to it."""
    out = []
    for m in _ASSIGNMENT.finditer(text):
        if names_credential(parts_of(m[1])):
            k = m.lastindex
            out.append((m.start(k), m.end(k), True))
    given, at = list(out), 0
    for m in _CANDIDATE.finditer(text):
        kinds = {_kind(c) for c in m.group()}
        if 0 not in kinds and 2 in kinds:
            continue
        while at < len(given) and given[at][1] <= m.start():
            at += 1
        if at == len(given) or given[at][0] >= m.end():
            out.append((m.start(), m.end(), False))
    return sorted(out)


def find(text: str | None, path: str | None, common: np.ndarray) -> Iterator[tuple[int, int, list[float], int]]:
    """start, end, features and rule label of each finding of a text."""
    if not text:
        return
    for start, stop, given in candidates(text):
        s = text[start:stop]
        kinds = [_kind(c) for c in s]
        count = Counter(kinds)
        known = sum(int(common[g]) for w in _LETTER_WORDS.findall(s.lower()) for g in _groups(w))
        before, after = text[max(0, start - 24):start], text[stop:stop + 24]
        n = len(s)
        near = parts_of(before)
        credential = given or names_credential(near)
        assigned = given or bool(_ASSIGNED.search(before))
        words = {*near, *parts_of(s), *parts_of(after)}
        placeholder = not words.isdisjoint(_PLACEHOLDER_WORDS) or len(set(s)) <= 4
        quoted = before[-1:] in "\"'`" and before != ""
        coverage = known / max(1, n - 2)
        features = [
            float(n), count[0] / n, count[1] / n, count[2] / n,
            sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1), len(set(s)) / n, _entropy(s),
            coverage, float(credential), float(assigned), float(quoted), float(placeholder),
            float(bool(_EXAMPLE_PATH.search(path or "")))]
        # A bare word of prose after a colon is no secret.
        plain = not quoted and count[2] + count[1] == n and coverage > 0.5
        label = bool(_ISSUED.match(s)) or (credential and assigned and not plain)
        yield start, stop, features, int(label and not placeholder)


def findings(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """doc_id, start, stop, features, rule_label of every finding."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for i, (t, p) in enumerate(zip(batch.column("text").to_pylist(), batch.column("source").to_pylist())):
                for row in find(t, p, common):
                    ids.append(i)
                    rows.append(row)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(ids, pa.int64())),
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.list_(pa.float64())),
                pa.array([r[3] for r in rows], pa.int32())],
                ["doc_id", "start", "stop", "features", "rule_label"])

    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", source.alias("source"))
    return rows.mapInArrow(scan, "doc_id long, start long, stop long, features array<double>, rule_label int")


@dataclass
class Forest:
    """Trees as arrays: feature (-1 in a leaf), threshold, children and the
    share of secrets of each node."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    constant: float | None = None
    # Common letter groups of the documents it was trained on.
    common: np.ndarray = field(default_factory=lambda: np.zeros(26 ** 3, bool))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                f = np.where(inner, feature[at], 0)
                step = np.where(x[rows, f] <= threshold[at], left[at], right[at])
                at = np.where(inner, step, at)
            total += share[at]
        return total / len(self.trees)


def train(spark: SparkSession, labelled: DataFrame, max_findings: int = MAX_FINDINGS) -> Forest:
    """A forest from labelled findings (features, label): at most
    ``max_findings`` of each class, by a hash of the features."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    # Repeated findings (copies of a text) count once.
    distinct = labelled.select("features", F.col("label").cast("double").alias("label")).distinct()
    order = F.xxhash64("features")
    sample = distinct.where("label = 1").orderBy(order, "features").limit(max_findings).unionByName(
        distinct.where("label = 0").orderBy(order, "features").limit(max_findings))
    sample = written(spark, sample.select(array_to_vector("features").alias("features"), "label"), "secret-sample")
    classes = sorted(r["label"] for r in sample.select("label").distinct().collect())
    if len(classes) < 2:
        return Forest([], constant=classes[0] if classes else 0.0)
    path = work_path(spark, "secret-forest")
    RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(
        sample).write().save(path)
    # The saved model lists its nodes: at most TREES * 2^(DEPTH + 1) rows.
    nodes = spark.read.parquet(f"{path}/data")
    node = "nodeData." if "nodeData" in nodes.columns else ""
    rows = nodes.select(
        "treeID", f"{node}id", f"{node}leftChild", f"{node}rightChild", f"{node}split.featureIndex",
        F.get(f"{node}split.leftCategoriesOrThreshold", 0).alias("threshold"),
        f"{node}impurityStats").collect()
    trees = []
    for t in sorted({r["treeID"] for r in rows}):
        own = sorted((r for r in rows if r["treeID"] == t), key=lambda r: r["id"])
        leaf = [r["leftChild"] < 0 for r in own]
        trees.append((
            np.array([-1 if e else r["featureIndex"] for r, e in zip(own, leaf)]),
            np.array([0.0 if e else r["threshold"] for r, e in zip(own, leaf)]),
            np.array([r["leftChild"] for r in own]), np.array([r["rightChild"] for r in own]),
            np.array([r["impurityStats"][1] / max(1e-9, sum(r["impurityStats"])) for r in own])))
    return Forest(trees)


def score_findings(spark: SparkSession, found: DataFrame, forest: Forest) -> DataFrame:
    held = spark.sparkContext.broadcast(forest)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["features"].tolist(), float).reshape(len(batch), len(FEATURES))
            yield batch[["doc_id", "start", "stop"]].assign(score=held.value.predict(x))

    out = found.select("doc_id", "start", "stop", "features").mapInPandas(
        run, "doc_id long, start long, stop long, score double")
    return out.withColumn("is_secret", F.col("score") >= THRESHOLD)


def fit(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, Forest]:
    """All findings of ``docs`` and the forest trained on their rule labels."""
    common = common_groups(docs)
    found = written(spark, findings(docs, common), "secret-findings")
    forest = train(spark, found.select("features", F.col("rule_label").alias("label")))
    forest.common = common
    return found, forest


def redacted(spark: SparkSession, docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``docs`` with every secret of the text masked."""
    held = spark.sparkContext.broadcast(forest)

    def clean(text: str | None, path: str | None) -> str | None:
        found = list(find(text, path, held.value.common))
        if not found:
            return text
        secret = held.value.predict(np.array([f[2] for f in found])) >= THRESHOLD
        out, at = [], 0
        for (start, stop, _, _), bad in zip(found, secret):
            if bad:
                out += [text[at:start], MASK]
                at = stop
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            paths = batch.column("source").to_pylist() if "source" in batch.schema.names else [None] * batch.num_rows
            texts = [clean(t, p) for t, p in zip(batch.column(place).to_pylist(), paths)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.column(place).type))

    return docs.mapInArrow(run, docs.schema)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, forest = fit(spark, read_table(spark, sf_dir, "documents"))
    return score_findings(spark, found, forest)
