"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings is trained on confirmed toxic texts (P)
and texts of unknown kind (U). With the share pi of toxic texts, the risk of a score g is
``pi * E_P[loss(g, 1)] + max(0, E_U[loss(g, 0)] - pi * E_P[loss(g, 0)])``: the second part
estimates the risk on clean texts and must not fall below zero; where it does, the step goes the
other way. P, U and the features are of bounded size, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import as_bytes, kept, remainder, slices, written

#: Toxic and unlabelled texts to learn from, about.
POSITIVES, UNLABELLED = 3000, 12000
#: Features a model has at most; the standard errors by which a feature must be more frequent in
#: toxic texts; and the share of its unlabelled texts that toxic ones must account for.
FEATURES, ERRORS, ACCOUNTED = 2048, 3.0, 0.5
#: Texts count as toxic from this score on.
THRESHOLD = 0.7
#: Bytes of a word's beginnings that are features besides the word.
BEGINNINGS = (3, 4, 5, 6, 8)
BUCKETS = 1 << 20
PRIOR = 0.1
_PIECE = 1 << 20
_LETTERS = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])


def features(text: bytes | None) -> np.ndarray:
    """Distinct hashed words and beginnings of words of a whole text."""
    text = (text or b"").translate(hashing.LOWER)
    found, start = [], 0
    while start < len(text):
        stop = min(len(text), start + _PIECE)
        while stop < len(text) and not _LETTERS[text[stop]]:
            stop += 1
        data = np.frombuffer(text[start:stop], np.uint8)
        at, to = hashing.spans(data, _LETTERS)
        sums = hashing.prefix_sums(data)
        found.append(hashing.span_hashes(sums, at, to) & np.uint64(BUCKETS - 1))
        for length in BEGINNINGS:
            longer = to - at > length
            some = hashing.span_hashes(sums, at[longer], at[longer] + length)
            found.append(hashing.mixed(some, length) & np.uint64(BUCKETS - 1))
        start = stop
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.zeros(0, np.int64)


@dataclass
class Model:
    """Weight of each bucket (0 for most) and the score of a text without features."""
    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self._table = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_table": None}

    def score(self, text: bytes | None) -> float:
        if self._table is None:
            self._table = np.zeros(BUCKETS, np.float32)
            self._table[self.buckets] = self.weights
        total = float(self._table[features(text)].sum(dtype=np.float64)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], n_features: int,
          prior: float, rounds: int = 120, step: float = 0.05, decay: float = 1e-5,
          seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with sigmoid loss.

    Each text is the array of its feature numbers.
    """
    def matrix(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), n_features), np.float32)
        for i, row in enumerate(rows):
            out[i, row] = 1
        return out

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    random = np.random.Generator(np.random.PCG64(seed))
    weights, bias = np.zeros(n_features), -1.0
    p, u = matrix(positive), matrix(unlabelled)
    batches = max(1, len(u) // 512)
    mean, square, count = np.zeros(n_features + 1), np.zeros(n_features + 1), 0
    for _ in range(rounds):
        deal_p, deal_u = random.permutation(len(p)), random.permutation(len(u))
        for k in range(batches):
            x_p = p[deal_p[k::batches]] if len(p) >= batches else p
            x_u = u[deal_u[k::batches]]
            s_p, s_u = sigmoid(x_p @ weights + bias), sigmoid(x_u @ weights + bias)
            # slopes of the loss of calling a text clean, on P and on U
            up_p, up_u = s_p * (1 - s_p) / len(x_p), s_u * (1 - s_u) / len(x_u)
            if s_u.mean() < prior * s_p.mean():
                g_u, g_p = -up_u, prior * up_p
            else:
                g_u, g_p = up_u, -2 * prior * up_p
            gradient = np.append(x_u.T @ g_u + x_p.T @ g_p + decay * weights,
                                 g_u.sum() + g_p.sum())
            count += 1
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.999 * square + 0.001 * gradient ** 2
            move = step * (mean / (1 - 0.9 ** count)) / (
                np.sqrt(square / (1 - 0.999 ** count)) + 1e-8)
            weights -= move[:-1]
            bias -= move[-1]
    return weights, float(bias)


def _feature_counts(sample: DataFrame) -> DataFrame:
    """``feature, p, u``: texts with a feature, summed within each task first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int32)
        for batch in slices(batches, "text"):
            for positive, text in zip(batch.column("positive").to_pylist(),
                                      as_bytes(batch, "text")):
                counts[0 if positive else 1, features(text)] += 1
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(counts[0, at].astype(np.int64)),
             pa.array(counts[1, at].astype(np.int64))], names=["feature", "p", "u"])
    return sample.mapInArrow(run, "feature long, p long, u long").groupBy("feature").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u"))


def _feature_rows(sample: DataFrame, chosen: np.ndarray) -> DataFrame:
    """``positive, at``: numbers of the chosen features in each text of the sample."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [np.flatnonzero(np.isin(chosen, features(text))).astype(np.int32)
                    for text in as_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), pa.array(rows, pa.list_(pa.int32()))],
                names=["positive", "at"])
    return sample.mapInArrow(run, "positive boolean, at array<int>")


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Model:
    """Learn from the labels of rows for which ``usable`` (of ``doc_id``) holds.

    P is a sample of texts labelled 1, U one of texts of any kind, both chosen by a hash of the
    id; the prior is the share of 1 among usable labels. Labels of other values, nulls and
    repeated labels are allowed (any 1 counts). Without P or U, every score is the prior.
    """
    usable = F.lit(True) if usable is None else usable
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("toxic").cast("int").alias("toxic")) \
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).filter(usable) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    numbers = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    prior = min(0.9, max(0.001, (numbers["p"] or 0) / numbers["n"])) if numbers["n"] else PRIOR
    base = float(np.log(prior / (1 - prior)))
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), base)
    if not numbers["p"]:
        return nothing

    def some(rows: DataFrame, number: int, most: int, seed: int) -> DataFrame:
        parts = 1 << 30
        return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(parts))
                           < int(parts * min(1.0, most / max(1, number))))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text")).filter(usable)
    confirmed = some(known.filter("toxic = 1").select("doc_id"), numbers["p"], POSITIVES, 1)
    total = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter(usable).count()
    # about POSITIVES ids: bounded
    p = texts.join(F.broadcast(confirmed), "doc_id").select(F.lit(True).alias("positive"), "text")
    u = some(texts, total, UNLABELLED, 2).select(F.lit(False).alias("positive"), "text")
    # copies of a text would make each of its words a feature
    sample = written(p.unionByName(u).withColumn("digest", F.md5("text")).dropDuplicates(
        ["positive", "digest"]).drop("digest"), "toxicity-sample")
    sizes = {r["positive"]: r["n"] for r in
             sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(True) or not sizes.get(False):
        return nothing
    n_p, n_u = sizes[True], sizes[False]
    share_p, share_u = (F.col("p") + 0.5) / (n_p + 1), (F.col("u") + 0.5) / (n_u + 1)
    error = F.sqrt(share_p * (1 - share_p) / n_p + share_u * (1 - share_u) / n_u)
    lift = (share_p - share_u) / error
    chosen = _feature_counts(sample).filter(
        (F.col("p") >= 3) & (lift >= ERRORS) & (share_p * prior >= share_u * ACCOUNTED)) \
        .orderBy(lift.desc(), "feature").limit(FEATURES).select("feature").toPandas()
    buckets = np.sort(chosen["feature"].to_numpy(np.int64))
    # POSITIVES + UNLABELLED rows of at most FEATURES numbers
    rows = _feature_rows(sample, buckets).toPandas()
    parts = {flag: [np.asarray(x, np.int64) for x in rows["at"][rows["positive"] == flag]]
             for flag in (True, False)}
    weights, bias = train(parts[True], parts[False], len(buckets), prior)
    return Model(buckets, weights, bias)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of each row, from its whole text alone; null texts score as empty ones.

    Repeated rows and null ids give rows of their own; an empty table gives none.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([model.score(t) for t in as_bytes(batch, "text")], pa.float64())],
                names=["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double")


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below ``threshold``, with all columns."""
    return kept(docs, lambda batch: np.array(
        [model.score(t) < threshold for t in as_bytes(batch, "text")], bool))


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
