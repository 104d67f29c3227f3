"""Ratings by a user-supplied function, and the replies it gives."""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pagetally import fixed
from pagetally.functions.text import strip_fence
from pagetally.operators.calls import CallPolicy, Calls
from pagetally.operators.joins import skew_join
from pagetally.operators.keyed import first_wins
from pagetally.operators.ordering import slice_rows
from pagetally.session import durable, written

# Workers get the code of this module with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUBRIC = """\
Rate the AI Exposure of the occupation described by the user on a scale from 0 to 10.
0 means the work is physical and in person, and software hardly touches it; 10 means the
work is routine, fully digital, and software can already do most of it. Weigh both work
that is automated and work that becomes so productive that fewer people are needed.
Answer with one JSON object and nothing else:
{"exposure": <0-10>, "rationale": "<two or three sentences>"}"""


def length_scorer(text: str) -> str:
    """A deterministic stand-in for a model: rates a document by its length."""
    return json.dumps({"exposure": len(text) % 11, "rationale": f"{len(text)} characters"})


_FIRST_TRIES: set[str] = set()


def shaky_scorer(text: str) -> str:
    """A stand-in that fails as services do: each text's first try in a process loses its
    connection, and texts whose length is a multiple of 7 are refused."""
    if text not in _FIRST_TRIES:
        _FIRST_TRIES.add(text)
        raise ConnectionError("connection lost")
    _FIRST_TRIES.discard(text)
    if len(text) % 7 == 0:
        raise ValueError("refused")
    return length_scorer(text)


def score_table(docs: DataFrame, scorer: Callable[[str], str], text: str = "text",
                policy: CallPolicy | None = None) -> DataFrame:
    """Replies of ``scorer`` to each text: all columns but the text, ``reply`` and ``error``.

    An exception fails its row only. Rows without text are not sent. Without ``policy`` each core
    has one call at a time; with one, ``scorer`` may be a coroutine function, and each task keeps
    a window of calls in flight (see :class:`CallPolicy`). Replies and their order are the same.
    """
    kept = [name for name in docs.columns if name != text]
    # no more tasks than this run at once, so the shares of a rate add up to it at most
    pause = policy.pause(docs.sparkSession.sparkContext.defaultParallelism) if policy else 0.0

    def answered(batch, replies, errors):
        return batch[kept].assign(
            reply=pd.Series(replies, index=batch.index, dtype=object),
            error=pd.Series(errors, index=batch.index, dtype=object))

    def one_by_one(batches):
        for batch in batches:
            replies, errors = [], []
            for document in batch[text]:
                try:
                    replies.append(scorer(document))
                    errors.append(None)
                except Exception as problem:  # user code: any failure is that row's outcome
                    replies.append(None)
                    errors.append(str(problem))
            yield answered(batch, replies, errors)

    def many_at_once(batches):
        begun = []      # batches whose rows are being asked: the window runs on into the next one

        def texts():
            for batch in batches:
                begun.append(batch)
                yield from batch[text]

        replies, errors = [], []
        for reply, error in Calls(scorer, policy, pause).answers(texts()):
            replies.append(reply)
            errors.append(error)
            if len(replies) == len(begun[0]):
                yield answered(begun.pop(0), replies, errors)
                replies, errors = [], []
                while begun and not len(begun[0]):
                    begun.pop(0)

    schema = T.StructType([
        *[docs.schema[name] for name in kept],
        T.StructField("reply", T.StringType()), T.StructField("error", T.StringType())])
    filled = docs.select(*kept, text).filter(F.octet_length(text) > 0)
    return filled.mapInPandas(many_at_once if policy else one_by_one, schema)


def score_documents(docs: DataFrame, scorer: Callable[[str], str],
                    policy: CallPolicy = CallPolicy(), text: str = "text") -> DataFrame:
    """As :func:`score_table`, but equal texts are asked once and get the same reply.

    Texts are equal when their SHA-256 is. The answers are written before they are used, so that
    nothing is asked twice when a later stage is repeated. The different texts are dealt over as
    many tasks as there are shuffle partitions or cores, whatever their size, since it is calls
    that take the time.
    """
    spark, key = docs.sparkSession, "_text_sha256"
    filled = docs.filter(F.octet_length(text) > 0).withColumn(
        key, F.sha2(F.col(text).cast("binary"), 256))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                spark.sparkContext.defaultParallelism)
    questions = filled.groupBy(key).agg(F.any_value(text).alias(text)).repartition(tasks, key)
    answers = written(score_table(questions, scorer, text, policy), "answers")
    kept = [name for name in docs.columns if name != text]
    return skew_join(filled.select(*kept, key), answers, key, "left").drop(key)


def score_requests(docs: DataFrame, model: str, rubric: str = RUBRIC,
                   temperature: float = fixed.TEMPERATURE, text: str = "text") -> DataFrame:
    """Adds ``request``: the chat request for each document as JSON text."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    request = F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", F.lit(rubric)), message("user", F.col(text))).alias("messages"),
        F.lit(temperature).alias("temperature"),
    )
    return docs.withColumn("request", F.to_json(request))


def parse_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Adds ``status`` (``scored`` or ``failed``), ``reason``, ``exposure``, ``rationale``, ``extras``.

    The reply must be exactly one strict JSON object, fenced or not. The JSON reader ignores text
    after a value, so the reply is read as the only element of an array and as the only member of
    an object: no text after it can close both. An explicit null rating is kept; values outside
    the scale are kept for the range check to find. Extras keep their types.
    """
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    body = replies.withColumn("_body", strip_fence(F.col(reply)))
    boxed = F.concat(F.lit("["), F.col("_body"), F.lit("]"))
    member = F.concat(F.lit('{"a":'), F.col("_body"), F.lit("}"))
    read = body.withColumns({
        "_typed": F.from_json(boxed, "array<struct<exposure:double,rationale:string>>", strict),
        "_pairs": F.from_json(boxed, "array<map<string,variant>>", strict),
        # only whether the member closes: its text need not be taken apart again
        "_alone": F.from_json(member, "a string", strict)["a"].isNotNull(),
    }).withColumns({
        "_typed": F.get("_typed", F.lit(0)),
        "_pairs": F.when(F.coalesce("_alone", F.lit(False)) & (F.size("_pairs") == 1),
                         F.get("_pairs", F.lit(0))),
    })
    has_rating = F.map_contains_key("_pairs", F.lit("exposure"))
    text_rating = ~F.is_variant_null(F.col("_pairs")["exposure"]) & F.col("_typed.exposure").isNull()
    reason = (
        F.when(F.col("_body").isNull(), "no reply body")
        .when(F.col("_pairs").isNull(), "not one JSON object")
        .when(F.size("_pairs") == 0, "empty object")
        .when(~has_rating, "no exposure")
        .when(text_rating, "exposure is no number")
    )
    extras = F.map_filter("_pairs", lambda key, _: ~key.isin("exposure", "rationale"))
    judged = read.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return judged.select(
        *[F.col(name) for name in replies.columns],
        F.when(good, "scored").otherwise("failed").alias("status"),
        "reason",
        F.when(good, F.col("_typed.exposure")).alias("exposure"),
        F.when(good, F.col("_typed.rationale")).alias("rationale"),
        F.when(good & (F.size(extras) > 0), F.to_json(extras)).alias("extras"),
    )


ANSWERS = ("ord bigint, slug string, title string, status string, exposure double, "
           "rationale string, extras string, reason string, run string, ts timestamp")


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """The log of answers that runs have appended at ``path``; empty when there is none yet."""
    try:
        columns = [part.split()[0] for part in ANSWERS.split(", ")]
        return spark.read.schema(ANSWERS).parquet(path).select(*columns)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ANSWERS)


@dataclass
class ScoringRun:
    """Outcome of an incremental run: the new score table and one status per item."""

    scores: DataFrame
    statuses: DataFrame


def score_incremental(master: DataFrame, docs: DataFrame, old: DataFrame,
                      scorer: Callable[[str], str], start: int | None = 0,
                      end: int | None = None, force: bool = False, log: str | None = None,
                      batches: int = 1, policy: CallPolicy | None = None) -> ScoringRun:
    """Rate the documents of the master rows ``[start:end)`` that have no rating yet.

    ``master`` has ``ord, slug, title``, ``docs`` has ``slug, text`` and ``old`` is a score
    table. ``force`` starts from an empty table, so ratings outside the slice are lost then.
    The scorer runs once per pending document: its replies are written before they are used.

    ``log`` is a folder to which each of ``batches`` parts of the pending documents, dealt by
    key, appends its answers when it is done. A run that died is resumed by calling it again:
    ratings in the log count as known, failed answers are asked for again. Each batch reads the
    text table once. With ``policy`` calls run as :func:`score_documents` says.
    """
    spark = master.sparkSession
    rows = first_wins(slice_rows(master, start, end).select("ord", "slug", "title"), "slug")
    known = old.limit(0) if force else old
    if log and not force:
        # the latest rating of each key that the old table lacks; fixed before the log grows
        logged = read_answers(spark, log).filter("status = 'scored'").groupBy("slug").agg(
            F.max_by(F.struct("title", "exposure", "rationale", "extras"), "ts").alias("_row"))
        known = known.unionByName(
            written(logged.select("slug", "_row.*").join(old.select("slug"), "slug", "left_anti"),
                    "logged"), allowMissingColumns=True)
    seen = known.select("slug", F.lit(True).alias("_known"))
    marked = written(rows.join(seen, "slug", "left"), "marked")
    texts = docs.filter(F.octet_length("text") > 0).select("slug", "text")
    # texts drive this join, so that a short list of pending keys can be broadcast to them
    todo = texts.join(marked.filter("_known is null").drop("_known"), "slug")

    def answered_by(part: DataFrame) -> DataFrame:
        replies = score_documents(part, scorer, policy) if policy else score_table(part, scorer)
        return parse_replies(replies).select(
            "ord", "slug", "title", "status", "exposure", "rationale", "extras",
            F.coalesce("error", "reason").alias("reason"))

    if log:
        run = uuid.uuid4().hex
        for number in range(batches):
            part = todo.filter(F.pmod(F.xxhash64("slug"), F.lit(batches)) == number)
            answered_by(part).select(
                F.col("ord").cast("bigint").alias("ord"), "slug", "title", "status", "exposure",
                "rationale", "extras", "reason", F.current_timestamp().alias("ts")
                # a folder of its own: two runs may write to one log
            ).write.parquet(f"{log.rstrip('/')}/run={run}/batch={number}")
        answers = read_answers(spark, log).filter(F.col("run") == run)
    else:
        answers = durable(answered_by(todo))
    fresh = answers.filter("status = 'scored'").select(
        "slug", "title", "exposure", "rationale", "extras")
    answered = answers.select("slug", "status", "reason")
    statuses = marked.join(answered, "slug", "left").select(
        "ord", "slug",
        F.when(F.col("_known"), "cached").otherwise(
            F.coalesce("status", F.lit("no_input"))).alias("status"),
        "reason")
    # what is pending is not known: a union, no join
    return ScoringRun(known.unionByName(fresh, allowMissingColumns=True), statuses)
