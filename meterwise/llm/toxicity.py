"""Operator 1: toxicity by nearest labelled examples.

Terms are words and word beginnings.  Terms tied to the toxic label are chosen
on a bounded sample of labelled training rows, and counted over all documents for
their document frequencies; the sample's TF-IDF vectors over them form an inverted index cut into blocks of examples, with the largest
weight of each term in each block.  A text's nearest examples by cosine are
found exactly: blocks are visited in falling order of their upper bound until
no block can beat the k-th cosine.  The neighbours vote with the square of
their cosine against the share of toxic labels, and a logistic curve fitted on
leave-one-out votes turns the vote into a score; the neighbours are returned
as evidence.

Only text enters a score.  Training rows are those whose crc32(doc_id as
text) mod 3 is not 1.

Defined cases: a null or empty text, or one without any chosen term, has no
neighbour and gets the score of an empty vote; without labels, or without both
classes, every score is the share of toxic labels (0 without labels); a
document labelled twice counts as toxic if either label says so; repeated rows
are scored each on its own; an empty table gives an empty result; extra
columns are ignored (``keep_clean`` carries them along).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.common import as_written, read_table, written

# Bounds of the labelled sample the model is fitted on, by class.
MAX_TOXIC = 2_000
MAX_CLEAN = 6_000
MAX_TERMS = 256
MIN_EVIDENCE = 16.0   # least log-likelihood ratio of a term
MIN_DOCS = 3          # least toxic examples with a term
PREFIXES = (4, 5)
NEIGHBOURS = 15
VOTE_PRIOR = 0.5
BLOCK = 64
THRESHOLD = 0.7
_WORDS = re.compile(r"[^\W_]+")


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id) == 1, F.lit(False))


def text_terms(text: str) -> Counter:
    """Words ``=w`` and word beginnings ``^w`` of a lower-cased text."""
    found: Counter = Counter()
    for w, n in Counter(_WORDS.findall(text.lower())).items():
        found["=" + w] += n
        for k in PREFIXES:
            if len(w) >= k:
                found["^" + w[:k]] += n
    return found


@dataclass
class Model:
    """The fitted index: term weights of examples, cut into blocks."""

    terms: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    examples: list[tuple[int, int, np.ndarray, np.ndarray]] = field(default_factory=list)
    prior: float = 0.0
    curve: tuple[float, float] = (1.0, 0.0)


class Index:
    """Block-max inverted index over the examples of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.doc_ids = np.array([e[0] for e in model.examples], np.int64)
        self.toxic = np.array([e[1] for e in model.examples], np.float64)
        n_blocks = -(-len(model.examples) // BLOCK)
        self.top = np.zeros((len(model.terms), n_blocks))
        lists: list[list] = [[] for _ in model.terms]
        for i, (_, _, ids, weights) in enumerate(model.examples):
            for t, w in zip(ids.tolist(), weights.tolist()):
                lists[t].append((i, w))
                self.top[t, i // BLOCK] = max(self.top[t, i // BLOCK], w)
        # Postings of each term: examples and weights.
        self.lists = [(np.array([p for p, _ in v], np.int64), np.array([w for _, w in v])) for v in lists]

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, skip: int = -1):
        """Positions and cosines of the k best examples (cosine above 0, ties
        to the earlier example), exactly.  Blocks are visited in falling order of their
        bounds, in lots that grow, until no bound reaches the k-th cosine."""
        bounds = weights @ self.top[ids]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        places, cosines, at, lot = np.zeros(0, np.int64), np.zeros(0), 0, 1
        while at < len(order):
            now = order[at:at + lot]
            if len(cosines) == k:
                now = now[bounds[now] >= cosines[-1] - 1e-12]
                if not len(now):
                    break
            at, lot = at + lot, 4 * lot
            open_ = np.zeros(len(bounds), bool)
            open_[now] = True
            got = np.zeros(len(self.toxic))
            for t, w in zip(ids.tolist(), weights.tolist()):
                where, own = self.lists[t]
                inside = open_[where // BLOCK]
                got[where[inside]] += w * own[inside]
            if skip >= 0:
                got[skip] = 0.0
            found = np.flatnonzero(got > 0)
            places, cosines = np.r_[places, found], np.r_[cosines, got[found]]
            best = np.lexsort((places, -cosines))[:k]
            places, cosines = places[best], cosines[best]
        return places.tolist(), cosines

    def vote(self, places: list[int], cosines: np.ndarray) -> float:
        weight = np.minimum(cosines, 1.0) ** 2
        toxic = self.toxic[places] if places else np.zeros(0)
        return float(((weight * toxic).sum() + VOTE_PRIOR * self.model.prior)
                     / (weight.sum() + VOTE_PRIOR))

    def score(self, vote: float) -> float:
        a, b = self.model.curve
        return float(1 / (1 + np.exp(-np.clip(a * _logit(vote) + b, -40, 40))))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _unit(ids: list[int], counts: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids)
    i = np.array(ids, np.int64)[order]
    w = (1 + np.log(np.array(counts, float)[order])) * idf[i]
    return i, w / np.sqrt((w * w).sum())


def _fit_curve(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit, with a small penalty so
    that separable votes keep a finite slope."""
    x, (a, b) = _logit(votes), (1.0, 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(weight * (p - toxic) * x).sum() + 0.01 * a, (weight * (p - toxic)).sum() + 0.01 * b])
        s = weight * p * (1 - p)
        h = np.array([[(s * x * x).sum() + 0.01, (s * x).sum()], [(s * x).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def training_sample(labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """doc_id, toxic: at most so many training rows of each class, by a hash
    of the id."""
    rows = training_labels(labels)
    order = F.xxhash64("doc_id")
    return rows.where("toxic = 1").orderBy(order, "doc_id").limit(max_toxic).unionByName(
        rows.where("toxic = 0").orderBy(order, "doc_id").limit(max_clean))


def training_labels(labels: DataFrame) -> DataFrame:
    rows = as_written(labels, "doc_id", "toxic").where("toxic is not null and doc_id is not null")
    rows = rows.where(remainder(F.col("doc_id")) != 1)
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC,
        max_clean: int = MAX_CLEAN) -> Model:
    """The model; what reaches the driver is bounded by the sample."""
    share = training_labels(labels).agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    model = Model(prior=float(share or 0.0))
    # At most MAX_TOXIC + MAX_CLEAN ids: a proven bound for the broadcast.
    wanted = training_sample(labels, max_toxic, max_clean)
    sample = written(spark, as_written(docs, "doc_id", "text").join(F.broadcast(wanted), "doc_id")
                     .select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text")), "toxic-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return model

    def count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for y, t in zip(batch["toxic"], batch["text"]):
                (toxic if y == 1 else clean).update(text_terms(t).keys())
        terms = list(toxic.keys() | clean.keys())
        if not terms:  # a task without rows: an empty frame has no column types
            return
        yield pd.DataFrame({"term": terms, "toxic": [toxic[t] for t in terms],
                            "clean": [clean[t] for t in terms]})

    counts = sample.mapInPandas(count_terms, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("p"), F.sum("clean").alias("n"))
    base = sizes[1] / (sizes[0] + sizes[1])
    p, n = F.col("p"), F.col("n")

    def part(k, of):
        return F.when(k > 0, k * F.log(k / ((p + n) * of))).otherwise(0.0)

    ratio = 2 * (part(p, base) + part(n, 1 - base))
    total = sizes[0] + sizes[1]
    chosen = (counts.where((p >= MIN_DOCS) & (p > base * (p + n))).withColumn("ratio", ratio)
              .where(F.col("ratio") >= MIN_EVIDENCE).orderBy(F.desc("ratio"), "term").limit(MAX_TERMS)).collect()
    model.terms = [r["term"] for r in chosen]
    if not chosen:
        return model
    n_docs, frequencies = document_frequencies(docs, model.terms)
    model.idf = np.log((1 + n_docs) / (1 + frequencies)) + 1
    place = {t: i for i, t in enumerate(model.terms)}

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            hits = [[(place[t], n) for t, n in text_terms(x).items() if t in place] for x in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"],
                                "ids": [[i for i, _ in h] for h in hits],
                                "counts": [[c for _, c in h] for h in hits]})

    rows = sample.mapInPandas(vectors, "doc_id long, toxic int, ids array<int>, counts array<int>") \
        .orderBy("doc_id", "toxic").collect()
    none = {y: sum(1 for r in rows if not r["ids"] and r["toxic"] == y) for y in (0, 1)}
    model.examples = [(r["doc_id"], int(r["toxic"]), *_unit(r["ids"], r["counts"], model.idf))
                      for r in rows if r["ids"]]
    index = Index(model)
    votes = [index.vote(*index.nearest(i, w, NEIGHBOURS, skip=k))
             for k, (_, _, i, w) in enumerate(model.examples)]
    # The sample's classes weigh as they do among all training labels.
    by_class = {1: model.prior * total / sizes[1], 0: (1 - model.prior) * total / sizes[0]}
    toxic = [e[1] for e in model.examples] + [0, 1]
    weight = [by_class[e[1]] for e in model.examples] + [none[0] * by_class[0], none[1] * by_class[1]]
    model.curve = _fit_curve(np.array(votes + [model.prior] * 2), np.array(toxic, float), np.array(weight))
    return model


class Finder:
    """Finds given terms of a text in one scan."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        kinds: dict[str, list[tuple[bool, int]]] = {}
        for i, t in enumerate(terms):
            kinds.setdefault(t[1:], []).append((t[0] == "=", i))
        for body, held in kinds.items():
            self.found.add_word(body, (len(body), tuple(held)))
        if kinds:
            self.found.make_automaton()

    def __call__(self, text: str) -> dict[int, int]:
        """Times of each term (by its place) in the text."""
        low, hits = text.lower(), {}
        for end, (size, held) in self.found.iter(low):
            start = end - size + 1
            if start and low[start - 1].isalnum():
                continue
            closed = end + 1 == len(low) or not low[end + 1].isalnum()
            for whole, i in held:
                if closed or not whole:
                    hits[i] = hits.get(i, 0) + 1
        return hits


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Number of all documents and of those with each term.  A task gives one
    row per term at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, times, seen = Finder(terms), np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for t in batch.column("text").to_pylist():
                seen += 1
                for i in finder(t) if t else ():
                    times[i] += 1
        if seen:
            place = np.r_[-1, np.flatnonzero(times)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(np.r_[seen, times[times > 0]])], ["place", "n"])

    rows = as_written(docs, "text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = {r["place"]: r["n"] for r in rows.collect()}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(len(terms))], float)


class Scorer:
    """Finds the chosen terms of a text in one scan and scores it."""

    def __init__(self, model: Model):
        self.index, self.model, self.terms = Index(model), model, Finder(model.terms)
        self.empty = model.prior if not model.terms else self.index.score(
            self.index.vote([], np.zeros(0)))

    def __call__(self, text: str | None) -> tuple[float, list[int], list[float]]:
        hits = self.terms(text) if text and self.model.terms else {}
        if not hits:
            return self.empty, [], []
        places, cosines = self.index.nearest(
            *_unit(list(hits), list(hits.values()), self.model.idf), NEIGHBOURS)
        return (self.index.score(self.index.vote(places, cosines)),
                [int(self.index.doc_ids[p]) for p in places[:3]], [float(c) for c in cosines[:3]])


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence ids and cosines."""
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in batches:
            got = [scorer(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array([g[0] for g in got], pa.float64()),
                 pa.array([g[1] for g in got], pa.list_(pa.int64())),
                 pa.array([g[2] for g in got], pa.list_(pa.float64()))],
                ["doc_id", "held_out", "score", "evidence", "cosines"])

    rows = as_written(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    out = rows.mapInArrow(run, "doc_id long, held_out boolean, score double, "
                               "evidence array<long>, cosines array<double>")
    return out.select("doc_id", "held_out", "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", "cosines")


def keep_clean(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield batch.filter(pa.array([scorer(t)[0] < THRESHOLD for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(spark, docs, fit(spark, docs, read_table(spark, sf_dir, "labels")))
