"""Bronze layer -- SURVEY A1-A9, A13-A15.

Bronze tables are append-only and typed: (key BIGINT, endpoint STRING,
raw_json VARIANT, ingested_at TIMESTAMP_NTZ), every column NOT NULL.  The
land_* functions turn landing frames (``sources.landing``) into bronze rows;
``bronze_append`` is the only writer.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.functions.jsonops import json_bigint, json_bool, required_array

# ---- fixed values -----------------------------------------------------------------
BRONZE_TABLES = {            # table -> key column
    "genre_raw": "genre_id",
    "movie_raw": "movie_id",
    "movie_details_raw": "movie_id",
    "movie_credits_raw": "movie_id",
}
OK_STATUS = 200
SKIPPED_STATUSES = (404, 429)   # details and credits: not found; rate limit still hit after all retries
# -------------------------------------------------------------------------------------


def _not_null(c: Column, name: str) -> Column:
    """Fail the write when a NOT NULL column is null (A6); no extra pass."""
    return F.coalesce(c, F.raise_error(F.lit(f"bronze contract: {name} is NULL"))).alias(name)


def bronze_contract(df: DataFrame, key: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """The typed bronze shape (and ``carry``, the columns that a table is partitioned by).  ``ingested_at`` defaults to the load time
    (one ``current_timestamp()`` per append, as a column default would)."""
    ingested = F.col("ingested_at") if "ingested_at" in df.columns else F.localtimestamp()
    return df.select(
        _not_null(F.col(key).cast("bigint"), key),
        _not_null(F.col("endpoint").cast("string"), "endpoint"),
        _not_null(F.col("raw_json"), "raw_json"),
        _not_null(ingested.cast("timestamp_ntz"), "ingested_at"),
        *[_not_null(F.col(c), c) for c in carry],
    )


def drop_missing_responses(landing: DataFrame, soft: tuple[int, ...] = ()) -> DataFrame:
    """Keep 200 responses; statuses in ``soft`` are skipped (retried next
    run because nothing is recorded); any other or a missing status stops the job.

    Details and credits are soft on 404 and exhausted 429; a failing genre,
    discover or change-list response stops the job, as a page left out there
    would end a month early.
    """
    status = F.col("http_status")
    guard = F.when(status == OK_STATUS, F.lit(True)).when(status.isin(*soft) if soft else F.lit(False), F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit("unexpected HTTP status "), F.coalesce(status.cast("string"), F.lit("NULL")),
                               F.lit(" for "), F.coalesce("endpoint", F.lit("NULL")))).cast("boolean"))
    return landing.where(guard)


def land_genre_rows(landing: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """A1: one row per ``genres[]`` element, each carrying the whole response."""
    ok = drop_missing_responses(landing)
    rows = ok.select("endpoint", "fetched_at", "body", *carry, F.explode(required_array("body", "genres")).alias("g"))
    return bronze_contract(rows.select(json_bigint("g", "id").alias("genre_id"), "endpoint",
                                       F.col("body").alias("raw_json"), F.col("fetched_at").alias("ingested_at"), *carry),
                           "genre_id", carry)


def land_movie_rows(landing: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """A2: one row per ``results[]`` element, carrying only that element."""
    ok = drop_missing_responses(landing)
    rows = ok.select("endpoint", "fetched_at", *carry, F.explode(required_array("body", "results")).alias("m"))
    return bronze_contract(rows.select(json_bigint("m", "id").alias("movie_id"), "endpoint",
                                       F.col("m").alias("raw_json"), F.col("fetched_at").alias("ingested_at"), *carry),
                           "movie_id", carry)


def _land_by_id(landing: DataFrame, suffix: str) -> DataFrame:
    ok = drop_missing_responses(landing, SKIPPED_STATUSES)
    return bronze_contract(ok.select(
        F.col("request_key").alias("movie_id"),
        F.concat(F.lit("/movie/"), F.col("request_key").cast("string"), F.lit(suffix)).alias("endpoint"),
        F.col("body").alias("raw_json"), F.col("fetched_at").alias("ingested_at")), "movie_id")


def land_detail_rows(landing: DataFrame) -> DataFrame:
    """A3: one row per details response, endpoint ``/movie/{id}``."""
    return _land_by_id(landing, "")


def land_credit_rows(landing: DataFrame) -> DataFrame:
    """A4: one row per credits response, endpoint ``/movie/{id}/credits``."""
    return _land_by_id(landing, "/credits")


def parse_json_ingest(df: DataFrame, text_col: str, out: str = "raw_json") -> DataFrame:
    """A5: JSON text -> VARIANT, malformed text fails (``parse_json`` is strict)."""
    return df.withColumn(out, F.parse_json(F.col(text_col))).drop(text_col)


def count_malformed(df: DataFrame, text_col: str) -> DataFrame:
    """A5 companion: how many rows ``parse_json`` would reject."""
    return df.agg(F.count_if(F.try_parse_json(F.col(text_col)).isNull() & F.col(text_col).isNotNull())
                  .alias("malformed_rows"))


def bronze_append(df: DataFrame, path: str) -> str:
    """Append only -- never update, never delete."""
    df.write.mode("append").parquet(path)
    return path


def drop_column_if_exists(df: DataFrame, name: str) -> DataFrame:
    """Remove an obsolete column; no error when it is missing."""
    return df.drop(name)


def bronze_scan(spark: SparkSession, root: str, view_prefix: str | None = None) -> dict[str, DataFrame]:
    """Scan the four bronze tables and project the four columns; views ``<view_prefix><table>`` only on request."""
    out = {}
    for name, key in BRONZE_TABLES.items():
        df = spark.read.parquet(f"{root}/{name}").select(key, "endpoint", "raw_json", "ingested_at")
        if view_prefix is not None:
            df.createOrReplaceTempView(f"{view_prefix}{name}")
        out[name] = df
    return out


_EXPORT_DATE = r"movie_ids_(\d{2}_\d{2}_\d{4})"


def read_id_export(spark: SparkSession, path_glob: str | list[str]) -> DataFrame:
    """Daily gzip JSON-lines ID exports ``movie_ids_MM_DD_YYYY.json.gz``.

    The date comes from the file (or folder) name.  A gzip file is read by
    one task; many daily files make as many tasks, so nothing is shuffled.
    """
    raw = spark.read.text(path_glob).select(
        "value", F.regexp_extract(F.col("_metadata.file_path"), _EXPORT_DATE, 1).alias("tag"))
    v = F.parse_json("value")
    return raw.select(
        F.to_date("tag", "MM_dd_yyyy").alias("ingestion_date"),
        F.variant_get(v, "$.id", "bigint").alias("movie_id"),
        F.variant_get(v, "$.adult", "boolean").alias("adult"),
        F.variant_get(v, "$.video", "boolean").alias("video"),
        F.variant_get(v, "$.popularity", "double").alias("popularity"),
        F.col("value").alias("raw_line"),
    )


def newest_export(spark: SparkSession, path_glob: str) -> list[str]:
    """The paths of the newest export day, from names alone (a listing; no file is opened)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path_glob)
    found = p.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(p) or []
    days: dict[tuple[str, ...], list[str]] = {}
    for path in (str(st.getPath()) for st in found):
        m = re.search(_EXPORT_DATE, path)
        if m:
            month, day, year = m[1].split("_")
            days.setdefault((year, month, day), []).append(path)
    if not days:
        raise FileNotFoundError(f"no ID export at {path_glob}")
    return days[max(days)]


def change_list_rows(landing: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Change-list pages -> (change_date, movie_id, adult, page, raw_json); the date is the last day of the page's window."""
    ok = drop_missing_responses(landing)
    rows = ok.select(change_window()[1].alias("change_date"), *carry,
                     F.variant_get("body", "$.page", "int").alias("page"),
                     F.explode(required_array("body", "results")).alias("r"))
    return rows.select("change_date", json_bigint("r", "id").alias("movie_id"), json_bool("r", "adult").alias("adult"),
                       "page", F.col("r").alias("raw_json"), *carry)


def change_window() -> tuple[Column, Column]:
    """First and last day that a change-list response covers: ``start_date`` and ``end_date`` of its
    request (``/movie/changes?start_date=...&end_date=...``), else the one day it was asked for."""
    def day(name: str) -> Column:
        found = F.regexp_extract("endpoint", rf"[?&]{name}=(\d{{4}}-\d{{2}}-\d{{2}})", 1)
        return F.coalesce(F.to_date(F.when(found != "", found)), F.col("request_date"))
    return day("start_date"), day("end_date")
