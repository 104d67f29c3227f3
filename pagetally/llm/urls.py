"""URL filter: rules by host and path, and a character language-model ratio for the rest.

The URLs that rules accept and those that they reject each give a variable-order Markov model of
characters: the probability of a character after its last five is that of the counts, interpolated
with the one after its last four, and so on down to a uniform one; the weight of the shorter context
is the number of different characters seen after the longer (Witten and Bell). A URL's score is the
difference of its log-likelihoods under the two models, over its length. Rules judge four of five
labelled URLs for training; the fifth calibrates the cut.

Counts are of all URLs, and the models are tables that grow with them. URLs are held in blocks; a
block asks for its different n-grams once, so that the commonest n-gram of all is asked for once a
block, and gets back a model of its own, by which its URLs are scored in one group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written

#: Characters of context at most.
ORDER = 5
#: Marks before and after a URL; characters that URLs do not hold.
BEGIN, END = "\x02", "\x03"
#: URLs and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 8192, 1 << 19
#: n-grams that a task gathers before it passes them on.
GATHERED = 1 << 18
#: One of so many labelled URLs calibrates the cut.
FOLDS = 5
#: Scores of calibration are counted in steps of 1 / STEPS up to REACH on each side.
STEPS, REACH = 512, 8
#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
         ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; empty where there is no ``://``."""
    found = F.coalesce(url.cast("string"), F.lit(""))
    pattern = "://([^/?#]*)([^?#]*)"
    return (F.translate(F.regexp_extract(found, pattern, 1), UPPER, LOWER),
            F.regexp_extract(found, pattern, 2))


def ruled(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES,
          ) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls.

    A rule fits its host and all subdomains where the path starts with its own.
    """
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def modelled(url: Column) -> Column:
    """What the models read: the URL after ``://`` with its host lower-cased, or all of it."""
    found = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(found, "://([^/?#]*)", 1)
    rest = F.regexp_extract(found, "(?s)://[^/?#]*(.*)", 1)
    return F.when(F.instr(found, "://") > 0,
                  F.concat(F.translate(host, UPPER, LOWER), rest)).otherwise(found)


def ngrams(text: str, order: int = ORDER) -> list[str]:
    """Each character and the end, with the ``order`` characters before it."""
    padded = BEGIN * order + text + END
    return [padded[i:i + order + 1] for i in range(len(padded) - order)]


def _blocks(rows: DataFrame) -> DataFrame:
    """Adds ``block``: a number that bounded stretches of rows share."""
    schema = rows.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        count = chars = 0
        for batch in slices(batches, "modelled"):
            size = sum(map(len, batch.column("modelled").to_pylist()))
            if count and (count + batch.num_rows > BLOCK_ROWS or chars + size > BLOCK_CHARS):
                block, count, chars = block + 1, 0, 0
            count, chars = count + batch.num_rows, chars + size
            yield batch.append_column("block", pa.array([block] * batch.num_rows, pa.int64()))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.mapInArrow(run, f"{fields}, block long")


def _gathered(rows: DataFrame, order: int) -> DataFrame:
    """``block, gram``, training counts by verdict and whether the block asks for the n-gram.

    A block's n-gram may come more than once.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}
        current = None

        def flush() -> pa.RecordBatch:
            values = list(found.values())
            batch = pa.RecordBatch.from_arrays(
                [pa.array([current] * len(found), pa.int64()), pa.array(list(found), pa.string()),
                 *(pa.array([v[i] for v in values], pa.int64()) for i in range(2)),
                 pa.array([v[2] > 0 for v in values], pa.bool_())],
                names=["block", "gram", "accepted", "rejected", "asked"])
            found.clear()
            return batch

        for batch in slices(batches, "modelled"):
            for block, text, use in zip(*(batch.column(n).to_pylist()
                                          for n in ("block", "modelled", "use"))):
                if found and (block != current or len(found) >= GATHERED):
                    yield flush()
                current = block
                for gram in ngrams(text, order):
                    if gram in found:
                        found[gram][use] += 1
                    else:
                        found[gram] = [int(use == i) for i in range(3)]
        if found:
            yield flush()
    return rows.select("block", "modelled", "use").mapInArrow(
        run, "block long, gram string, accepted long, rejected long, asked boolean")


def _ratios(gathered: DataFrame, order: int) -> DataFrame:
    """``gram, ratio``: log probability under accepted less that under rejected, where asked."""
    sums = written(gathered.groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"),
        F.max("asked").alias("asked")), "grams")
    single = sums.select(F.substring("gram", order + 1, 1).alias("gram")).distinct()
    # a count of different characters: one number
    uniform = F.lit(1.0 / max(single.count(), 1))
    shorter = None
    for size in range(order + 1):
        # n-grams of size + 1 characters; the longest already are
        tail = sums.select(F.substring("gram", order + 1 - size, size + 1).alias("gram"),
                           "accepted", "rejected") \
            .groupBy("gram").agg(F.sum("accepted").alias("accepted"),
                                 F.sum("rejected").alias("rejected")) if size < order else sums
        # as many rows a context as there are different characters
        context = Window.partitionBy(F.substring("gram", 1, size)) if size else \
            Window.partitionBy(F.lit(0))
        seen = tail.select("*", *(
            column for name in ("accepted", "rejected") for column in (
                F.sum(name).over(context).alias(f"{name}_all"),
                F.count_if(F.col(name) > 0).over(context).alias(f"{name}_kinds"))))
        if shorter is None:
            seen = seen.select("*", *(uniform.alias(f"p_{n}") for n in ("accepted", "rejected")))
        else:
            seen = seen.withColumn("_tail", F.substring("gram", 2, size)).join(
                shorter.withColumnRenamed("gram", "_tail"), "_tail")
        kept = ["gram"] + (["asked"] if size == order else [])
        shorter = seen.select(*kept, *(
            F.when(F.col(f"{n}_all") > 0,
                   (F.col(n) + F.col(f"{n}_kinds") * F.col(f"p_{n}"))
                   / (F.col(f"{n}_all") + F.col(f"{n}_kinds")))
            .otherwise(F.col(f"p_{n}")).alias(f"p_{n}") for n in ("accepted", "rejected")))
    return shorter.filter("asked").select(
        "gram", (F.log("p_accepted") - F.log("p_rejected")).alias("ratio"))


def _scored(rows: DataFrame, gathered: DataFrame, ratios: DataFrame, order: int) -> DataFrame:
    """``score`` of the rows that are neither accepted nor rejected for training."""
    own = gathered.filter("asked").select("block", "gram").join(ratios, "gram")
    asked = rows.filter("use = 2")
    schema = asked.drop("block", "modelled", "use").schema

    def run(urls: pa.Table, model: pa.Table) -> pa.Table:
        ratio = dict(zip(model.column("gram").to_pylist(), model.column("ratio").to_pylist()))
        scores = []
        for text in urls.column("modelled").to_pylist():
            grams = ngrams(text, order)
            scores.append(sum(ratio[g] for g in grams) / len(grams))
        return urls.select(schema.names).append_column("score", pa.array(scores, pa.float64()))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return asked.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(
        run, f"{fields}, score double")


def cut(scores: DataFrame) -> float:
    """The score that best parts accepted from rejected URLs; 0 where one kind is missing.

    Best is the largest mean of the two shares that are judged right, then what lies nearest to 0.
    The scores are counted in steps, so that a bounded table reaches the driver.
    """
    step = F.least(F.greatest(F.floor(F.col("score") * STEPS), F.lit(-REACH * STEPS)),
                   F.lit(REACH * STEPS))
    rows = scores.groupBy(step.alias("step"), (F.col("verdict") == "allow").alias("good")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    counts = {good: {r.step: r.n for r in rows if r.good == good} for good in (True, False)}
    totals = {good: sum(c.values()) for good, c in counts.items()}
    if not all(totals.values()):
        return 0.0
    steps = sorted({s for c in counts.values() for s in c})
    below = {True: 0, False: 0}
    best = []
    for before, step in zip([None, *steps], [*steps, None]):
        right = (totals[True] - below[True]) * totals[False] + below[False] * totals[True]
        # all cuts above ``before`` and up to ``step`` part the URLs alike: the one nearest to 0
        low, high = before if before is None else before + 1, step
        near = max(0, low) if low is not None else 0
        near = near if high is None else min(near, high)
        best.append((-right, abs(near), near))
        for good in below:
            below[good] += counts[good].get(step, 0)
    return min(best)[2] / STEPS


def judged(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, key: str = "page_id",
           url: str = "url", order: int = ORDER) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score`` of each URL.

    ``score`` is null where a rule's URL trained the models. A null URL and one without ``://``
    have empty host and path and are scored as they stand; without training URLs of a kind that
    kind's model is uniform, and the score of equals is 0, which is allowed. Repeated rows count
    and are judged each, ties at the cut are allowed, null keys stay, other columns are ignored,
    and an empty table gives no rows.
    """
    host, path = parts(F.col(url))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    split = pages.select(F.col(key), host.alias("host"), path.alias("path"),
                         modelled(F.col(url)).alias("modelled"))
    known = split.withColumns({"rule": rule, "verdict": verdict})
    calibrates = F.crc32(F.col("modelled").cast("binary")) % FOLDS == 0
    use = F.when(F.col("verdict").isNull() | calibrates, 2).when(
        F.col("verdict") == "allow", 0).otherwise(1)
    rows = written(_blocks(known.withColumn("use", use)), "urls")
    gathered = written(_gathered(rows, order), "gathered")
    scores = written(_scored(rows, gathered, _ratios(gathered, order), order), "scores")
    limit = cut(scores.filter("verdict is not null"))
    found = F.when(F.col("score") >= limit, "allow").otherwise("block")
    columns = [key, "host", "path", "rule"]
    return scores.select(*columns, F.coalesce("verdict", found).alias("verdict"), "score") \
        .unionByName(rows.filter("use < 2").select(
            *columns, "verdict", F.lit(None).cast("double").alias("score")))
