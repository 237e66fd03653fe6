"""SimHash near-duplicates (8) by multi-index hashing.

Fingerprints: 64 bits over word shingles, one pass over the text in tasks.  Exact copies share a
fingerprint, so linking works on distinct fingerprints (one row each, made by a partial
aggregate) and a group of copies of any size costs one node.

Linking at up to two bits: a fingerprint is cut into two 32-bit segments.  If two fingerprints
differ in at most two bits, then either their upper segments differ in at most one bit, or their
lower segments are equal.  Every fingerprint enters both segment tables; it probes the upper
table with the Hamming ball of radius one (itself, and each zero bit set: of two segments that
differ in one bit one has the zero) and the lower table with itself.  Matches are verified on
all 64 bits.  Of n fingerprints that is at most 35 n rows, whatever their groups look like.

A table bucket with more than ``bucket`` fingerprints would give pairs with the square of its
size.  Those who own or probe such a bucket are linked exactly in another way, over the balls of
the whole fingerprint: two fingerprints differ in at most two bits if and only if the balls of
radius one around them meet.  Whoever shares a ball point is linked to its smallest member; a
point has at most 65 members.

Components: alternating large-star / small-star contraction, each round written to the shared
folder.  Nothing but row counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cinelake.llm.common import SLICE_ROWS, pick, slices, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# Fingerprints in one table bucket beyond which its links are found by whole balls instead.
BUCKET = 64
# Shingles whose bits are counted at once (64 bytes each).
_CHUNK = 32_768


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles; 0 without words."""
    words = text.encode("utf-8").lower().split() if text else []  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(b" ".join(w), seed) for w in zip(*(words[i:] for i in range(k)), strict=False)),
                    np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), _CHUNK):
        part = h[at:at + _CHUNK]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the 64-bit fingerprint as a signed bigint; one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, fp bigint")


def _bit(i):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))


def _segments(nodes: DataFrame) -> DataFrame:
    """(fp, key, exact): the table rows (exact) and the probes beside them; key holds segment number and value."""
    upper = F.shiftrightunsigned("fp", 32)
    lower = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1 << 32))
    flips = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: upper.bitwiseAND(_bit(i)) == 0),
        lambda i: F.struct(upper.bitwiseOR(_bit(i)).alias("key"), F.lit(False).alias("exact")))
    own = F.array(F.struct(upper.alias("key"), F.lit(True).alias("exact")), F.struct(lower.alias("key"), F.lit(True).alias("exact")))
    return nodes.select("fp", F.inline(F.concat(own, flips)))


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b), a < b: links between distinct fingerprints ``nodes.fp`` that join up all pairs at <= 2 bits.

    Each row is itself such a pair or two steps through a common ball point, so every pair at
    most two bits apart ends in one component, and no other fingerprints do.
    """
    keyed = written(_segments(nodes), "segments")
    table = keyed.where("exact").select("key", F.col("fp").alias("b"))
    heavy = written(table.groupBy("key").count().where(F.col("count") > bucket).select("key"), "heavy-buckets")
    light = written(table.join(heavy, "key", "left_anti"), "light-table")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (keyed.select("key", F.col("fp").alias("a"), "exact").join(light, "key")
             .where((F.col("a") != F.col("b")) & (apart <= MAX_BITS) & (~F.col("exact") | (F.col("a") < F.col("b"))))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    crowded = keyed.join(heavy, "key", "left_semi").select("fp").distinct()
    ball = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(_bit(i)))
    points = crowded.select("fp", F.explode(F.concat(F.array("fp"), ball)).alias("point"))
    members = F.array_sort(F.collect_list("fp"))  # at most 65 distinct fingerprints
    stars = (points.groupBy("point").agg(members.alias("m")).where(F.size("m") > 1)
             .select(F.col("m")[0].alias("a"), F.explode(F.slice("m", 2, 64)).alias("b")))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root = its component's smallest node.

    Large-star links a node's larger neighbours to the smallest of its neighbourhood, small-star
    its smaller ones; both keep components.  Rounds go on until no edge changes.
    """
    edges = written(edges, "edges")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "large-star")
        large = (both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
                 .where("a < b").distinct())
        large = written(large, "large-edges")
        # small-star: the smaller neighbours of b, and b itself, to the smallest of them
        low = written(large.groupBy("b").agg(F.min("a").alias("m")), "small-star")
        small = (large.join(low, "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("v")).where("m < v")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())
        edges = written(small, "small-edges")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).distinct()


def _labels(rows: DataFrame, order: str, bucket: int) -> DataFrame:
    """(label_fp, least): every fingerprint of ``rows`` with the smallest non-null ``order`` of its component."""
    nodes = written(rows.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    found = components(links(nodes.select("fp"), bucket))
    rooted = written(nodes.join(found, nodes["fp"] == found["node"], "left")
                     .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    named = written(rooted.groupBy("root").agg(F.min("first").alias("least")), "roots")
    return rooted.select(F.col("fp").alias("label_fp"), "root").join(named, "root").select("label_fp", "least")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, fp (signed bigint), component_id (smallest doc_id reachable over links of <= 2 bits).

    Null, empty and wordless texts have fingerprint zero and are linked like any other.  Repeated
    doc_ids keep one result row per input row.  Rows with a null doc_id get their fingerprint and
    component, but never name one; component_id is null if no row of a component has an id.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    labels = _labels(fps, "doc_id", bucket)
    return fps.join(labels, fps["fp"] == labels["label_fp"]).select("doc_id", "fp", F.col("least").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, all columns, for each component: the one with the smallest doc_id.

    Of rows with the same doc_id one stays; a row without doc_id only if no other of its component has one.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    text, doc_id, schema = names.index(text_col), names.index(id_col), plain.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                fps = np.array([fingerprint(t, shingle) for t in part.column(text).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fps, pa.int64())], names=[*part.schema.names, "fp"])

    marked = plain.mapInArrow(run, StructType([*schema.fields, StructField("fp", LongType())]))
    held = written(marked.withColumn("row", F.monotonically_increasing_id()), "fingerprinted")
    order = F.struct(F.col(f"_c{doc_id}").isNull().alias("none"), F.col(f"_c{doc_id}").alias("id"), "row")
    least = _labels(held.select("fp", order.alias("place")), "place", bucket)
    keepers = least.select(F.col("least")["row"].alias("row")).distinct()
    return held.join(keepers, "row", "left_semi").drop("row", "fp").toDF(*names)


def hex_fingerprint(fp):
    """16 lower-case hexadecimal digits of a signed bigint fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
