"""Row numbers within groups that may be very large -- used for pagination.

``row_number().over(Window.partitionBy(g).orderBy(k))`` moves a whole group
into one task.  Here the rows are range-partitioned and sorted on (g, k), so a
hot group is cut into consecutive slices on many tasks; the rows of a slice are
numbered as they are written, and a small table of slice sizes (at most one row
per group and slice boundary) gives every slice its offset.  Both are written
under ``spark.checkpoint.dir``, so the rows move once.

``ordered_pages`` cuts groups into arrays by their row numbers where the slices
lie; only the rows of pages that two slices share move again.
``ordered_chunks`` cuts groups into ordered arrays; only groups that are larger
than a chunk need row numbers for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.session import scratch_dir


def row_number_within(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "rn",
                      total: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of the row inside its ``group`` by
    ``order`` (which must make rows unique inside a group), and optionally
    ``total`` = the group's size.

    The full rows are range-partitioned once and written once to the shared
    folder (a job that runs while the query is built: the sampled bounds of a
    range exchange are drawn anew each time it runs, so the slices that are
    numbered and the slices that are counted must be one and the same).  A
    written row carries its place in its slice; the number is that place less
    the place of the group's first row there, plus the offset of the slice.
    The offsets are written too: their known size lets the join leave the wide
    rows unshuffled.
    """
    group, order = list(group), list(order)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = _written(df.repartitionByRange(n, *group, *order).sortWithinPartitions(*group, *order)
                      .withColumn("__id", F.monotonically_increasing_id()), "ranked")
    in_slice = F.shiftright("__id", 33)          # the upper bits are the slice, the lower ones the place in it
    sizes = sliced.groupBy(*group, in_slice.alias("__s")).agg(F.count(F.lit(1)).alias("__cnt"), F.min("__id").alias("__first"))
    before = Window.partitionBy(*group).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _written(sizes.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)], "__s",
                                    (F.coalesce(F.sum("__cnt").over(before), F.lit(0)) - F.col("__first") + 1).alias("__off"),
                                    *([F.sum("__cnt").over(Window.partitionBy(*group)).alias(total)] if total else [])), "slices")
    # null-safe equality: rows with a NULL key are numbered and kept like any other
    on = [sliced[c].eqNullSafe(offsets[f"__g{i}"]) for i, c in enumerate(group)] + [in_slice == offsets["__s"]]
    return sliced.join(offsets, on).select(
        *df.columns, (F.col("__id") + F.col("__off")).cast("bigint").alias(out), *([total] if total else []))


def _slice_labels(spark, n: int) -> dict[int, int]:
    """Slice -> a number that Spark's hash deals to the bucket of that very number, so that ``n`` slices are ``n`` buckets."""
    found = spark.range(32 * n).groupBy(F.expr(f"pmod(hash(id), {n})").alias("bucket")).agg(F.min("id").alias("label")).collect()
    return {r.bucket: r.label for r in found}


def ordered_pages(df: DataFrame, group: Sequence[str], order: Sequence[str], size: int, row: Column, total: str) -> DataFrame:
    """(group, ``page`` from 1, ``total`` rows of the group, ``rows``): ``row`` of the rows of every group in ``order``, ``size`` to a page.

    As in ``row_number_within`` the rows are range-partitioned, sorted and written once, here bucketed by
    their slice.  Spark then knows that a slice lies in one task, and gathers the pages there without moving
    a row.  A page that two slices share is told by the first and last number of each and gathered apart: at
    most ``size`` rows at either end of a slice.  Rows that tie in ``order`` keep one number each.
    """
    group, order = list(group), list(order)
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    labels = _slice_labels(spark, n)
    at = F.shiftright("__id", 33).cast("int")
    label = F.coalesce(F.try_element_at(F.array(*[F.lit(labels.get(i, i)).cast("bigint") for i in range(n)]), at + 1), at.cast("bigint"))
    name = f"cinelake_{uuid.uuid4().hex}"
    (df.repartitionByRange(n, *group, *order).sortWithinPartitions(*group, *order)
       .withColumn("__id", F.monotonically_increasing_id()).withColumn("__s", label)
       .write.format("parquet").bucketBy(n, "__s").option("path", scratch_dir(spark, "ranked")).saveAsTable(name))
    sliced = spark.table(name)
    sizes = sliced.groupBy(*group, "__s").agg(F.count(F.lit(1)).alias("__cnt"), F.min("__id").alias("__first"))
    before = Window.partitionBy(*group).orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__cnt").over(before), F.lit(0))).withColumn(
        total, F.sum("__cnt").over(Window.partitionBy(*group)))
    low, high = F.col("__before") + 1, F.col("__before") + F.col("__cnt")        # first and last number of the group in the slice
    slices = _written(sizes.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)], F.col("__s").alias("__sl"), (low - F.col("__first")).alias("__off"), total,
        F.when(F.col("__before") % size != 0, _page_of(low, size)).alias("__cut_low"),
        F.when((high % size != 0) & (high < F.col(total)), _page_of(high, size)).alias("__cut_high")), "slices")
    on = [sliced[c].eqNullSafe(slices[f"__g{i}"]) for i, c in enumerate(group)] + [sliced["__s"] == slices["__sl"]]
    numbered = sliced.join(slices, on).withColumn("rn", F.col("__id") + F.col("__off")).withColumn("page", _page_of(F.col("rn"), size))
    cut = F.coalesce(F.col("page") == F.col("__cut_low"), F.lit(False)) | F.coalesce(F.col("page") == F.col("__cut_high"), F.lit(False))

    def gathered(rows: DataFrame, *by: str) -> DataFrame:
        kept = rows.select(*by, *group, "page", total, F.struct("rn", row.alias("row")).alias("r"))
        return kept.groupBy(*by, *group, "page", total).agg(F.sort_array(F.collect_list("r")).alias("rows")).select(
            *group, "page", total, F.transform("rows", lambda x: x["row"]).alias("rows"))

    return gathered(numbered.where(~cut), "__s").unionByName(gathered(numbered.where(cut)))


def _page_of(number: Column, size: int) -> Column:
    return ((number - 1) / size).cast("int") + 1


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_chunks(narrow: DataFrame, widen: Callable[[DataFrame], DataFrame], group: Sequence[str], order: Sequence[str],
                   size: int) -> DataFrame:
    """(group, ``chunk``, ``rows``): the rows ``widen(narrow)`` of every group in ``order``, cut into arrays of at most ``size``.

    ``widen`` adds columns or drops rows by joins, row by row.  The groups with more than ``size`` narrow
    rows are found first, from their keys alone; they are numbered with ``row_number_within`` and cut by
    number, so none of them is gathered anywhere.  The others are gathered, sorted and cut as arrays: each
    row moves once.  Where a join multiplies rows, an array may be longer than ``size`` before it is cut."""
    group, order = list(group), list(order)
    large = _written(narrow.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > size).select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)]), "large-groups")   # counted on every task: no coalesce here
    on = [narrow[c].eqNullSafe(large[f"__g{i}"]) for i, c in enumerate(group)]
    wide = widen(narrow.join(large, on, "left_anti"))
    fields = [*order, *[c for c in wide.columns if c not in (*group, *order)]]
    gathered = (wide.repartition(*group).groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("all")))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("all") - 1) / size).cast("int")),
                      lambda k: F.slice("all", k * size + 1, F.lit(size)))
    chunks = gathered.select(*group, F.posexplode(cut).alias("chunk", "rows"))
    if large.isEmpty():
        return chunks
    ranked = row_number_within(widen(narrow.join(large, on, "left_semi")), group, order)
    ranked = ranked.withColumn("chunk", F.floor((F.col("rn") - 1) / size).cast("int"))
    numbered = ranked.groupBy(*group, "chunk").agg(F.sort_array(F.collect_list(F.struct("rn", *fields))).alias("r"))
    return chunks.unionByName(numbered.select(*group, "chunk", F.transform("r", lambda x: F.struct(
        *[x[c].alias(c) for c in fields])).alias("rows")))
