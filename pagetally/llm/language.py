"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit one binary classifier weighs byte n-grams:
the log-odds of an n-gram under the languages whose bit is 1 against those whose bit is 0, each
language counting alike, however many rows it has. Counts come from every labelled row. The
answers are weighed by how well a classifier does on each language (measured on a bounded sample
of labelled rows) and the codeword with the least loss wins; a text whose second-best codeword is
nearly as near is ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, remainder, slices

#: Buckets that n-grams are hashed into.
BUCKETS = 1 << 15
#: Labelled rows, about, on which the classifiers are measured.
MEASURED_ROWS = 4000
#: Difference of losses, relative to the number of bits, under which a text is ambiguous.
AMBIGUOUS = 0.02
UNDETERMINED = "und"
_PIECE = 1 << 18
_KEEP = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 for each of ``n`` languages.

    All ways to part up to six languages; for more, the farthest apart of random codes.
    """
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        columns = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(columns, np.int8).T
    random = np.random.Generator(np.random.PCG64(n))
    bits = int(np.ceil(10 * np.log2(n)))
    best, least = None, -1
    for _ in range(50):
        code = random.integers(0, 2, (n, bits), dtype=np.int8) * 2 - 1
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2
        nearest = (apart + bits * np.eye(n, dtype=int)).min()
        if nearest > least:
            best, least = code, nearest
    return best


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the byte 3- and 4-grams of the letters of a text, in bounded pieces."""
    data = b" " + b" ".join((text or "").lower().encode("utf-8", "replace").translate(_KEEP)
                            .split()) + b" "
    for start in range(0, max(1, len(data) - 2), _PIECE):
        b = np.frombuffer(data[start:start + _PIECE + 3], np.uint8).astype(np.uint32)
        if len(b) < 3:
            continue
        three = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
        three = three[:_PIECE]
        four = (b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:])[:_PIECE]
        for value, factor in ((three, 2654435761), (four, 2246822519)):
            yield (value * np.uint32(factor)) >> np.uint32(32 - 15)


def _has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass
class Model:
    """Languages in order, their codewords, n-gram weights by bit, and weights of the decoder."""
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    trust: np.ndarray

    def margins(self, text: str | None) -> np.ndarray:
        total, number = np.zeros(self.weights.shape[1]), 0
        for at in grams(text):
            total += self.weights[at].sum(axis=0, dtype=np.float64)
            number += len(at)
        return total / max(1, number)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighed logistic loss of each codeword."""
        answers = self.code * (margins / self.scale)
        return (self.trust * np.logaddexp(0, -2 * answers)).sum(axis=1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether another language is nearly as likely."""
        if not self.languages or not _has_letter(text):
            return UNDETERMINED, 0.0, True
        loss = self.losses(self.margins(text)) * self.code.shape[1]
        order = np.argsort(loss, kind="stable")
        score = 1 / np.exp(loss[order[0]] - loss).sum()
        near = len(order) > 1 and \
            loss[order[1]] - loss[order[0]] < AMBIGUOUS * self.code.shape[1]
        return self.languages[order[0]], float(min(1.0, score)), bool(near)


def _counts(rows: DataFrame) -> DataFrame:
    """``lang, bucket, n``: n-grams by language, summed within each task first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            waiting: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(),
                                  batch.column("text").to_pylist()):
                waiting.setdefault(lang, []).extend(grams(text))
            for lang, parts in waiting.items():
                if parts:
                    added = np.bincount(np.concatenate(parts), minlength=BUCKETS)
                    total[lang] = total.get(lang, 0) + added
        for lang, number in total.items():
            at = np.flatnonzero(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(number[at])], names=["lang", "bucket", "n"])
    return rows.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _measures(rows: DataFrame, model: Model) -> DataFrame:
    """``lang, bit, right, size``: answers of the classifiers on labelled rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs, bits, right, size = [], [], [], []
            for lang, text in zip(batch.column("lang").to_pylist(),
                                  batch.column("text").to_pylist()):
                margins = model.margins(text)
                good = margins * model.code[model.languages.index(lang)] > 0
                langs += [lang] * len(margins)
                bits += range(len(margins))
                right += good.tolist()
                size += np.abs(margins).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(bits, pa.int32()),
                 pa.array(right, pa.bool_()), pa.array(size, pa.float64())],
                names=["lang", "bit", "right", "size"])
    return rows.mapInArrow(run, "lang string, bit int, right boolean, size double") \
        .groupBy("lang", "bit").agg(F.avg(F.col("right").cast("double")).alias("right"),
                                    F.avg("size").alias("size"))


def fit(docs: DataFrame, usable: Column | None = None) -> Model:
    """Learn from all rows with text and language for which ``usable`` holds.

    What comes to the driver has the size of the model: languages times ``BUCKETS``, and
    languages times bits. Without a labelled row the model knows no language.
    """
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if usable is not None:
        rows = rows.filter(usable)
    table = _counts(rows).toPandas()
    languages = sorted(table["lang"].unique().tolist())
    code = codewords(len(languages))
    counts = np.full((len(languages), BUCKETS), 0.5)
    if languages:
        at = np.searchsorted(languages, table["lang"].to_numpy(dtype=str))
        counts[at, table["bucket"].to_numpy()] += table["n"].to_numpy()
    share = counts / counts.sum(axis=1, keepdims=True)
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        one, zero = code[:, bit] > 0, code[:, bit] < 0
        if one.any() and zero.any():
            weights[:, bit] = np.log(share[one].mean(axis=0)) - np.log(share[zero].mean(axis=0))
    model = Model(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape))
    if len(languages) < 2:
        model.trust /= max(1, code.shape[1])
        return model
    spread = max(1, rows.count() // MEASURED_ROWS)
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(spread)) == 0)
    measured = _measures(sample.select("lang", "text"), model).toPandas()
    trust, sizes = np.full(code.shape, 0.5), []
    for row in measured.itertuples():
        trust[languages.index(row.lang), row.bit] = max(row.right, 0.05)
    for bit in range(code.shape[1]):
        own = measured["size"][measured["bit"] == bit]
        sizes.append(own.mean() if len(own) else 1.0)
    model.scale = np.maximum(np.array(sizes), 1e-9)
    model.trust = trust / trust.sum(axis=1, keepdims=True)
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of each row, from its text alone.

    ``und`` with score 0 for a null text, one without letters, or a model without languages.
    Repeated rows and null ids give rows of their own; an empty table gives none.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [model.predict(text) for text in batch.column("text").to_pylist()]
            lang, score, near = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(near, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "ambiguous"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose language can be told, with all columns: those predicted ``und`` go."""
    return kept(docs, lambda batch: np.array(
        [model.predict(text)[0] != UNDETERMINED for text in batch.column("text").to_pylist()],
        bool))


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
