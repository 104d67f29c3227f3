"""One query per operator, over whole tables with production parameters, and SQL where it can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetally.session import scratch_path

from . import (boilerplate, chat, clusters, decontamination, jaccard, language, licenses,
               neighbours, packing, repair, rollups, toxicity, urls)
from .common import bounded_batches, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one that consists of control strings, read back from their text."""
    rows = _table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    added = spark.sql("SELECT -7L AS conv_id, pos * 1L AS turn, role, "
                      "'</s>[INST] ok [/INST]' AS text "
                      "FROM (SELECT posexplode(array('user', 'assistant')) AS (pos, role))")
    read = chat.read_conversations(chat.format_conversations(rows.unionByName(added)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join(chat.loss_texts(F.col("turns")), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@_query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens: where each piece stands."""
    return packing.pack(_table(spark, folder, "documents"))


@_query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learned from three of four documents by their id."""
    docs = _table(spark, folder, "documents")
    model = language.fit(docs, ~language.held_out())
    return language.predict(docs, model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


@_query
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the words in benchmark windows and the items whose windows occur."""
    found = decontamination.search(_table(spark, folder, "documents"),
                                   _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@_query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score of every text, learned from the labels of two of three ids."""
    docs = _table(spark, folder, "documents")
    model = toxicity.fit(docs, _table(spark, folder, "labels"), ~toxicity.held_out())
    return toxicity.scores(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@_query
def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return boilerplate.extract(_table(spark, folder, "pages"))


@_query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after inserts, a repeated commit, a revision of the counts, and deletes.

    Documents come in three batches, the first of which is committed twice; all counts by words
    are kept beside those by the tokenizer. Then each source's odd documents are revised from
    words to the tokenizer's count under a second version, and documents labelled toxic go. Texts
    are split once: the batches are cut from the counts of single documents.
    """
    docs = _table(spark, folder, "documents")
    words = written(rollups.counted(docs, "words/1"), "words")
    rollup = rollups.Rollup(spark, scratch_path(spark, "rollup"))
    for part in range(3):
        for _ in range(2 if part == 0 else 1):
            rollup.commit(f"insert-{part}", rollups.changes(inserted=words.filter(
                F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == part)))
    rollup.commit("tokens", rollups.changes(inserted=rollups.counted(docs, "bpe50k/1")))
    odd = words.filter(F.pmod("doc_id", F.lit(2)) == 1)
    rollup.commit("revision", rollups.changes(
        revised=(odd, odd.withColumn("tokenizer", F.lit("words/2")))))
    toxic = _table(spark, folder, "labels").filter("toxic = 1").select("doc_id").distinct()
    gone = words.join(toxic, "doc_id", "left_semi")
    rollup.commit("deletes", rollups.changes(deleted=gone.withColumn("tokenizer", F.when(
        F.pmod("doc_id", F.lit(2)) == 1, "words/2").otherwise(F.col("tokenizer")))))
    return rollup.totals()


@_query
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector, by cosine."""
    rows = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(rows, rows.filter(F.col("vec_id") % 50 == 0))


@_query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The group of every document whose word shingles are alike by 0.75 or more."""
    return jaccard.join(_table(spark, folder, "documents"))


@_query
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licenses whose texts or notices each document holds."""
    return licenses.scan(_table(spark, folder, "documents"))


@_query
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return urls.judged(_table(spark, folder, "pages").select("page_id", "url"))


@_query
def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """Eight clusters of all embeddings after ten rounds, from hash-chosen first centroids."""
    return clusters.Clusters(_table(spark, folder, "embeddings")).report()


@_query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Cheapest repairs of all conversations after damage that depends on their keys.

    Of 20 remainders of ``conv_id:turn``, one drops the row, one empties its text, one takes its
    sentence ends away, one repeats it, one makes it a user row. Nulls are one space.
    """
    rows = _table(spark, folder, "conversations")
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    damaged = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("n"))
    damaged = damaged.select(
        "conv_id", "turn", F.when(F.col("n") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("n") == 1, "").when(F.col("n") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("n") == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("n") == 3, 2).otherwise(1))))
    return repair.Repair(damaged, "gone").summary()


def _clustering_sql(count: int, rounds: int, seed: int) -> str:
    """Rounds of assignment and exact floor of the mean, one after the other."""
    text = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id,
        list_transform(embedding, lambda x: floor({clusters.SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = {clusters.DIMENSIONS}
        AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = {clusters.DIMENSIONS}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY hash, v) - 1 AS number, v AS c
    FROM (SELECT *, sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS hash FROM kept)
    ORDER BY hash, v LIMIT {count}),"""
    for i in range(rounds + 1):
        text += f"""
a{i} AS MATERIALIZED (
    SELECT rid, vec_id, v, min(struct_pack(d := list_sum(list_transform(
        list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, n := number)) AS best
    FROM kept, c{i} GROUP BY rid, vec_id, v),"""
        if i < rounds:
            text += f"""
m{i} AS MATERIALIZED (
    SELECT number, list(mean ORDER BY place) AS c
    FROM (SELECT best.n AS number, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))
            // count(*) AS mean
          FROM (SELECT best, unnest(v) AS x, unnest(range(len(v))) AS place FROM a{i})
          GROUP BY best.n, place)
    GROUP BY number),
c{i + 1} AS MATERIALIZED (
    SELECT number, coalesce(m{i}.c, c{i}.c)::BIGINT[] AS c FROM c{i} LEFT JOIN m{i} USING (number)),"""
    return text.rstrip(",") + f"""
SELECT vec_id, best.n::INTEGER AS cluster, best.d AS distance,
    sum(best.d) OVER (PARTITION BY best.n)::BIGINT AS cluster_inertia,
    sum(best.d) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON number = best.n"""


ORACLES = {
    "op1_chat_formatting": r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
    SELECT *, role || chr(10) || text || chr(10) AS said,
        CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 7 WHEN 'system' THEN 18
            ELSE 24 + length(role) END
        + length(text)
        + CASE WHEN regexp_matches(text, '</?s>|\[/?INST\]|<</?SYS>>|<</?ROLE>>|\\[blq]')
            THEN length(text) - length(replace(text, '\', ''))
                + length(regexp_replace(text, '</?s>|\[/?INST\]|<</?SYS>>|<</?ROLE>>',
                                        '\0#', 'g')) - length(text)
            ELSE 0 END AS chars
    FROM rows)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                    FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op4_benchmark_decontamination": r"""
WITH item_words AS (
    SELECT item_id::VARCHAR AS item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM benchmark),
windows AS (
    SELECT item_id, size, list_aggregate(words[i:i + size - 1], 'string_agg', ' ') AS words
    FROM (SELECT item_id, words, least(10, len(words)) AS size,
            unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
          FROM item_words WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
doc_words AS (
    SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents),
places AS (
    SELECT rid, i, size, list_aggregate(words[i:i + size - 1], 'string_agg', ' ') AS words
    FROM (SELECT rid, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM doc_words, sizes)),
found AS (
    SELECT rid, i, size, item_id FROM places JOIN windows USING (size, words)),
hit AS (
    SELECT rid, count(DISTINCT i + k) AS n_hit
    FROM (SELECT DISTINCT rid, i, size, unnest(range(0, size)) AS k FROM found) GROUP BY rid),
named AS (
    SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)""",
    "op12_centroid_clustering": _clustering_sql(8, 10, 3),
    "op13_conversation_repair": r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS step),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations),
hashed AS (
    SELECT keyed.*, xor(list_reduce(
        list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT),
        lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS n
    FROM keyed, crc),
damaged AS (
    SELECT conv_id, turn, CASE n WHEN 4 THEN 'user' ELSE role END AS role,
        CASE n WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text
            END AS text,
        unnest(range(CASE n WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE n <> 0),
ordered AS (
    SELECT conv_id, turn, role, text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                           sha256(length(role) || ':' || role || chr(10) || text)) AS i
    FROM damaged),
repeats AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth
    FROM ordered),
faulty AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN nth > 1 THEN 2
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
        CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 4 END AS kind
    FROM repeats),
counts AS (
    SELECT conv_id, count(*) AS size,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
        count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (before IS NOT NULL AND (before, kind) NOT IN ((1, 2), (2, 3), (3, 2)))
            AS illegal
    FROM (SELECT *, lag(kind) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM faulty)
    GROUP BY conv_id),
-- best way from each of four states: start, after system, after user, after assistant
best AS (
    SELECT conv_id, size + 1 AS i,
        [{'c': 0::BIGINT, 'a': '', 't': ''},
         {'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'},
         {'c': 3, 'a': 'I', 't': chr(10) || 'assistant:'}, {'c': 0, 'a': '', 't': ''}] AS v
    FROM counts
    UNION ALL
    SELECT conv_id, i, list_transform([1, 2, 3, 4], lambda s: list_min([w[s],
        {'c': 3 + w[[3, 3, 4, 3][s]].c, 'a': 'I' || w[[3, 3, 4, 3][s]].a,
         't': chr(10) || ['user:', 'user:', 'assistant:', 'user:'][s] || w[[3, 3, 4, 3][s]].t},
        {'c': 6 + w[[4, 4, 3, 4][s]].c, 'a': 'II' || w[[4, 4, 3, 4][s]].a,
         't': chr(10) || ['user:', 'user:', 'assistant:', 'user:'][s] || chr(10)
            || ['assistant:', 'assistant:', 'user:', 'assistant:'][s] || w[[4, 4, 3, 4][s]].t}]))
    FROM (
        SELECT best.conv_id, faulty.i, list_transform([1, 2, 3, 4], lambda s: list_min([
            {'c': 4 + v[s].c, 'a': 'D' || v[s].a, 't': v[s].t},
            CASE WHEN fault NOT IN (1, 2) AND [[2, 3, 0, 0], [0, 3, 0, 0], [0, 0, 4, 0],
                                               [0, 3, 0, 0]][s][kind] > 0
                THEN {'c': fault + v[[[2, 3, 0, 0], [0, 3, 0, 0], [0, 0, 4, 0],
                                      [0, 3, 0, 0]][s][kind]].c,
                      'a': 'K' || v[[[2, 3, 0, 0], [0, 3, 0, 0], [0, 0, 4, 0],
                                     [0, 3, 0, 0]][s][kind]].a,
                      't': chr(10) || role || ':' || text || v[[[2, 3, 0, 0], [0, 3, 0, 0],
                            [0, 0, 4, 0], [0, 3, 0, 0]][s][kind]].t} END,
            CASE WHEN fault NOT IN (1, 2) THEN
                {'c': 3 + fault + v[[3, 3, 4, 3][s]].c, 'a': 'R' || v[[3, 3, 4, 3][s]].a,
                 't': chr(10) || ['user:', 'user:', 'assistant:', 'user:'][s] || text
                    || v[[3, 3, 4, 3][s]].t} END])) AS w
        FROM best JOIN faulty ON faulty.conv_id IS NOT DISTINCT FROM best.conv_id
            AND faulty.i = best.i - 1))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(v[1].c, 0) AS cost, coalesce(v[1].a, '') AS audit,
    sha256(substr(coalesce(v[1].t, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
    LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id AND best.i = 1""",
}
