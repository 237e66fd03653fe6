"""Landed API responses -- the input side of bronze.

A landing record is one HTTP response, stored as one JSON line (an
"envelope") so that landed files split and parallelise like any text input:

    {"run_id": "daily-2026-02-01", "endpoint": "/movie/603", "http_status": 200,
     "fetched_at": "...", "request_key": 603, "request_date": null,
     "body": {...response...}}

``run_id`` names the fetch run: pages of one month fetched by two runs are two
answers, never mixed.  Files lie in one ``run_id=...`` folder per run, so a
job reads the runs it needs and no other.

``read_landing`` gives the envelope as columns with ``body`` as VARIANT; the
test bed builds the very same frame straight from the driver tables, so every
bronze operator runs on either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE_COLUMNS = ["run_id", "endpoint", "http_status", "fetched_at", "request_key", "request_date", "body"]


def envelope(endpoint, http_status, fetched_at, body, request_key=None, request_date=None, run_id=None) -> list:
    """Columns of a landing frame; ``body`` must be a VARIANT column.  A
    response without a run id belongs to the run of its fetch day."""
    day = F.date_format(fetched_at.cast("timestamp_ntz"), "yyyy-MM-dd")
    return [
        (F.coalesce(run_id, day) if run_id is not None else day).cast("string").alias("run_id"),
        endpoint.cast("string").alias("endpoint"),
        http_status.cast("int").alias("http_status"),
        fetched_at.cast("timestamp_ntz").alias("fetched_at"),
        (request_key if request_key is not None else F.lit(None)).cast("bigint").alias("request_key"),
        (request_date if request_date is not None else F.lit(None)).cast("date").alias("request_date"),
        body.alias("body"),
    ]


def landing_line() -> Column:
    """The JSON line of a row of a landing frame; its body may be VARIANT or a struct."""
    return F.to_json(F.struct(
        "endpoint", "http_status",
        F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
        "request_key",
        F.date_format("request_date", "yyyy-MM-dd").alias("request_date"),
        "body"))


def write_lines(lines: DataFrame, path: str, compression: str | None = None, mode: str = "errorifexists",
                above: tuple[str, ...] = ()) -> str:
    """Write (value, run_id) lines, one folder per run, within folders of the columns ``above`` if any."""
    w = lines.select("value", *above, "run_id").write.mode(mode).partitionBy(*above, "run_id")
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def write_landing(df: DataFrame, path: str, compression: str | None = None, mode: str = "errorifexists") -> str:
    """Write a landing frame as JSON lines (one response per line), one folder per run; mode ``append`` adds late responses."""
    return write_lines(df.select(landing_line().alias("value"), "run_id"), path, compression, mode)


def read_lines(spark: SparkSession, path: str, runs: list[str] | None = None) -> DataFrame:
    """(value, run_id) of a landing folder with one ``run_id=...`` folder per run; ``runs`` prunes the folders."""
    lines = spark.read.schema("value string, run_id string").text(path)
    return lines if runs is None else lines.where(F.col("run_id").isin(runs))


def request_day(value: Column | str = "value") -> Column:
    """``request_date`` of a line, read from what stands before the body; of the whole line if it is not there."""
    value = F.col(value) if isinstance(value, str) else value
    head = F.concat(F.substring_index(value, ',"body":', 1), F.lit("}"))
    return F.to_date(F.coalesce(F.get_json_object(head, "$.request_date"), F.get_json_object(value, "$.request_date")))


def parse_landing(lines: DataFrame, keep: str | None = None) -> DataFrame:
    """(value, run_id) lines -> envelopes, ``keep`` being a column of the lines to carry along; malformed lines fail the read (strict parse).

    A line is parsed once: a filter over the envelope would be moved below the parse and hold a parse of
    its own for each condition, which Spark does not do below a column that it takes for nondeterministic."""
    kept = [] if keep is None else [keep]
    once = F.when(F.spark_partition_id() >= 0, F.parse_json("value"))
    raw = lines.select(once.alias("e"), F.col("run_id").alias("run"), *kept)
    return raw.select(*envelope(
        F.variant_get("e", "$.endpoint", "string"),
        F.variant_get("e", "$.http_status", "int"),
        F.to_timestamp_ntz(F.variant_get("e", "$.fetched_at", "string")),
        F.variant_get("e", "$.body", "variant"),
        F.variant_get("e", "$.request_key", "bigint"),
        F.variant_get("e", "$.request_date", "string").cast("date"),
        F.col("run"),
    ), *kept)


def read_landing(spark: SparkSession, path: str, runs: list[str] | None = None) -> DataFrame:
    """Landed envelopes of a folder, of the named runs only if given."""
    return parse_landing(read_lines(spark, path, runs))
