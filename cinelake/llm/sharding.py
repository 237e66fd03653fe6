"""Sharding (3): a uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. The rows are written once, each with its place (input partition, position), and counted per
   partition.
2. The matrix of rows from every partition to every shard is drawn exactly: a partition's row of
   the matrix is multivariate hypergeometric over what the shards still have room for.  That is
   the distribution these counts have under a uniform permutation of all rows.
3. Each partition permutes its shard labels locally (a shuffled multiset with exactly the drawn
   counts) and deals them to its rows.
4. After the exchange each shard is permuted again: random keys put its rows into bins of bounded
   expected size, bins are numbered locally, and prefix sums over the bins' counts make the
   slots gapless.  No task ever holds a whole shard.

Draws depend on the seed and the place of a row alone, so a repeated task draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cinelake.llm.common import written

SHARDS = 24
SEED = 3
# Rows that one bin of the second permutation holds in the mean.
BIN_ROWS = 20_000
# Above this, numpy's sampler refuses a population.
_NUMPY_MOST = 900_000_000
# Input partitions whose matrix (one count for each shard) the driver draws and sends; a row is 8 bytes times shards.
MOST_PARTITIONS = 2_000_000


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Row counts at most one apart."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """Good ones among ``draws`` without replacement; exact to the precision of a double for any population."""
    if good + bad <= _NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, draws))
    lo, hi = max(0, draws - bad), min(good, draws)
    mean = draws * (good / (good + bad))
    spread = 12 * math.sqrt(mean * (1 - good / (good + bad)) + 1) + 12  # tails beyond weigh less than 1e-30
    x = np.arange(max(lo, int(mean - spread)), min(hi, int(mean + spread) + 1) + 1)
    # log of p(x + 1) / p(x), summed from the window's start: no large factorials to cancel
    step = (np.log(good - x[:-1]) + np.log(draws - x[:-1]) - np.log(x[:-1] + 1.0) - np.log(bad - draws + x[:-1] + 1.0))
    weight = np.concatenate([[0.0], np.cumsum(step)])
    p = np.cumsum(np.exp(weight - weight.max()))
    return int(x[min(np.searchsorted(p, rng.random() * p[-1], side="right"), len(x) - 1)])


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows from each partition (its count) to each shard (its size); both margins are met exactly."""
    rng = np.random.default_rng(seed)
    room = np.array(sizes, np.int64)
    out = np.zeros((len(counts), len(sizes)), np.int64)
    for p, n in enumerate(counts):
        left, beyond = n, int(room.sum())
        for s in range(len(sizes)):
            beyond -= int(room[s])
            k = hypergeometric(int(room[s]), beyond, left, rng) if left and beyond else left
            out[p, s] = k
            left -= k
        room -= out[p]
    return out


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, seed: int = SEED, bin_rows: int = BIN_ROWS) -> DataFrame:
    """(row, shard, slot): every row of ``df`` as a struct in a shard from 0 and a slot from 0, gapless.

    Shards differ by at most one row.  Names of ``df`` may clash with anything, its rows may be
    equal or null: places, not values, tell rows apart.  With fewer rows than shards the last
    shards stay empty; an empty table gives no rows.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    placed = written(plain.withColumn("place", F.monotonically_increasing_id()), "shard-rows")
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).count().collect()  # one number for each input partition
    if len(counts) > MOST_PARTITIONS:
        raise ValueError(f"{len(counts)} input partitions: coalesce to {MOST_PARTITIONS} at most")
    counts = sorted((r["part"], r["count"]) for r in counts)
    total = sum(n for _, n in counts)
    matrix = communication_matrix([n for _, n in counts], shard_sizes(total, shards), seed)
    sent = df.sparkSession.sparkContext.broadcast({p: row for (p, _), row in zip(counts, matrix, strict=True)})

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, labels = -1, None
        for batch in batches:
            place = batch.column(batch.num_columns - 1).to_numpy()
            parts, at = place >> 33, place & ((1 << 33) - 1)
            out = np.empty(len(place), np.int32)
            for p in np.unique(parts).tolist():
                if p != held:
                    labels = np.repeat(np.arange(shards, dtype=np.int32), sent.value[p])
                    np.random.default_rng([seed, p]).shuffle(labels)
                    held = p
                here = parts == p
                out[here] = labels[at[here]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "shard"])

    labelled = placed.mapInArrow(label, StructType([*placed.schema.fields, StructField("shard", IntegerType())]))
    bins = max(1, math.ceil(total / shards / bin_rows))
    draw = F.xxhash64("place", F.lit(seed))
    dealt = labelled.withColumn("draw", draw).withColumn("bin", F.pmod(F.shiftright("draw", 20), F.lit(bins)))
    dealt = written(dealt, "shard-dealt")
    # one row for each bin of a shard, so bounded by rows / bin_rows + shards
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("shard", "bin").count().select("shard", "bin", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    local = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("draw", "place")).cast("bigint") - 1
    row = F.struct(*[F.col(c).alias(name) for c, name in zip(plain.columns, names, strict=True)]).alias("row")
    return (dealt.withColumn("local", local).join(first, ["shard", "bin"])
            .select(row, "shard", (F.col("first") + F.col("local")).alias("slot")))
