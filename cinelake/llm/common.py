"""Helpers shared by the operators: column picking, scratch tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import scratch_dir

# Rows that a task turns into Python objects at once; bounds memory, not the result.
SLICE_ROWS = 256


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` reduced to ``new_name=exact_source_name``, taken by position.

    Other columns never matter, also when they repeat a name, differ from one only in case or
    are called like a column that an operator makes.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_c{names.index(src)}").alias(new) for new, src in columns.items()])


def written(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: whatever executor is lost later, the rows (and any ids drawn while they
    were written) stay as they are.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{purpose}")
    w = df.write.option("compression", "zstd")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[list[list]]:
    """Columns of at most ``rows`` rows as Python lists; empty batches give nothing."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield [c.to_pylist() for c in part.columns]


def filter_rows(df: DataFrame, column: str, keeps: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows of ``df`` that a Python test of one column keeps; every column is handed through, in one pass.

    ``keeps`` is called once in each task and gives the test of a list of values.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    at = names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = keeps()
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                yield part.filter(pa.array(test(part.column(at).to_pylist()), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def hashed_lines(df: DataFrame, key: str, order: str, line: str, out: str, separator: str = "\n") -> DataFrame:
    """(key, out): SHA-256 in hex of the ``line`` strings of each key in order, joined.

    A stream over sorted rows: whatever a key's size, one line is held at a time.  A null key is a
    key of its own.
    """
    import hashlib

    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (key, digest so far)
        for batch in batches:
            done = []
            for k, text in zip(batch.column("k").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if held is None or held[0] != k:
                    done += [held] if held else []
                    held = (k, hashlib.sha256())
                else:
                    held[1].update(separator.encode())
                held[1].update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], batch.schema.field("k").type), pa.array([d.hexdigest() for _, d in done])], names=["k", "digest"])
            last = batch.schema.field("k").type
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held[0]], last), pa.array([held[1].hexdigest()])], names=["k", "digest"])

    rows = pick(df, k=key, o=order, line=line).repartition("k").sortWithinPartitions("k", "o").select("k", "line")
    return rows.mapInArrow(run, f"k {kind.simpleString()}, digest string").toDF(key, out)
