"""The registered queries of the operators: thin digests over whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm import (conversation_repair, decontaminate, html_extract, licenses, neighbours, packing, pii, prefix_trie, quality, secrets, sharding,
                          simhash, toxicity)
from cinelake.llm.common import hashed_lines, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean(read_table(spark, sf_dir, "documents")).drop("clean_text", "removed")


@register
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shuffle_into_shards(rows).select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(secrets.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in secrets.BASE], F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


@register
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.protect(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(pii.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.BASE], F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


@register
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table has no paths: a document lies in its source's folder for its language
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"))
    return licenses.scan(rows)


@register
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLES["op7_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least({decontaminate.WINDOW}, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM b)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)"""


@register
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@register
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


@register
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
                         F.col("evidence")["doc_id"].alias("evidence_ids"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The table with faults put in by a hash of id and turn: a row goes, loses its text or its sentence ends, is repeated, or becomes the user's."""
    def named(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", named("role").alias("role"), named("text").alias("text"), fault.alias("fault")).where(F.col("fault") != 0)
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@register
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations")
    report, turns = conversation_repair.repair(damaged(given))
    lines = turns.where(F.col("place").isNotNull()).select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = hashed_lines(lines, "conv_id", "place", "line", "repaired_sha256")
    ids = given.select(F.col("conv_id").alias("id")).distinct()  # conversations that lost every row are reported too
    digests = digests.withColumnRenamed("conv_id", "digest_id")
    found = ids.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(digests, F.col("id").eqNullSafe(F.col("digest_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@register
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


@register
def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
