"""Approximate nearest neighbours (13): an inverted multi-index over two vector halves.

1. Equal vectors are one entry (a class) with the smallest ids that carry it; a vector that a third
   of the rows share is indexed, probed and compared once.
2. Each half of a vector is quantised by its own codebook, fitted by k-means on a bounded sample
   (``SAMPLE`` classes, smallest hashes).  Every class is indexed under its pair of centroids.
3. A query walks the centroid pairs by summed distance (the negative inner products of the halves)
   with a heap, until the cells that it has popped hold ``depth`` entries.  As pairs come in order,
   the last distance tells which cells it has walked: that number is all a probe carries.
4. Cells lie in shards of at most ``SHARD_ROWS`` entries (a larger cell is dealt over several).  A
   probe goes to the shards that hold cells it has walked; entries of those cells are reranked on
   the original vectors, in blocks of bounded size on both sides, and the best of each shard merged.

``depth`` is not guessed: ``CALIBRATION`` sampled queries are compared with every entry, and the
depth is taken at which the walk meets ``recall`` of their true neighbours.  Hard (unclustered) data
gives a deep walk, never a lower recall.

Neighbours are those of largest inner product, in double precision, terms added from left to right;
ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from cinelake.llm.common import pick, written

NEAREST = 20
QUERY_STEP = 20           # rows whose id it divides are queries
RECALL = 0.97             # share of the calibration queries' true neighbours that the walk must meet
SAMPLE = 16_384           # classes that the codebooks are fitted on
CALIBRATION = 128         # queries that are compared with every entry to set the depth
CELL_ROWS = 16            # entries that a cell holds in the mean
MOST_CENTROIDS = 1024     # of a half; bounds the codebooks (and the counts of cells, its square)
SHARD_ROWS = 8_192        # entries of a block
PROBES = 8_192            # probes of a block
_SLICE = 256              # probes scored at once


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of numbers as rows of doubles; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), dims))
    if not len(column):
        return out
    sizes = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten()).astype(np.float64)
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def fit_codebook(rows: np.ndarray, k: int, rounds: int = 8, seed: int = 13) -> np.ndarray:
    """``k`` centroids by k-means (fewer rows than ``k``: the rows)."""
    k = min(k, len(rows))
    centres = rows[np.random.default_rng(seed).choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest_centroid(rows, centres)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, rows)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest_centroid(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * (rows @ centres.T)).argmin(1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, depth: int) -> float:
    """The summed distance at which cells popped in order hold ``depth`` entries (infinite if they never do).

    ``counts`` has the entries of each centroid pair.  The usual multi-sequence walk: a pair is
    pushed once both pairs before it are popped, so the heap stays short.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[a].tolist(), second[b].tolist()
    table = counts.reshape(len(first), len(second))[np.ix_(a, b)].tolist()
    heap, popped, found = [(da[0] + db[0], 0, 0)], [-1] * len(da), 0
    while heap:
        distance, i, j = heapq.heappop(heap)
        found += table[i][j]
        if found >= depth:
            return distance
        popped[i] = j
        if i + 1 < len(da) and popped[i + 1] == j - 1:
            heapq.heappush(heap, (da[i + 1] + db[j], i + 1, j))
        if j + 1 < len(db) and (i == 0 or popped[i - 1] >= j + 1):
            heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
    return math.inf


def _left_to_right(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products whose terms are added in order, whatever block a row is in."""
    return np.cumsum(rows * query, axis=1)[:, -1]


def _best(rows: np.ndarray, near: np.ndarray, query: np.ndarray, first_id: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact products of the ``keep`` best rows; ``near`` are products up to rounding, -inf for rows left out."""
    there = np.flatnonzero(near > -np.inf)
    if len(there) > keep:
        bar = np.partition(near[there], len(there) - keep)[len(there) - keep]
        slack = 1e-9 * (np.abs(rows[there]).max() * np.abs(query).sum() + 1e-300)
        there = there[near[there] >= bar - slack]
    exact = _left_to_right(rows[there], query)
    order = np.lexsort((first_id[there], -exact))[:keep]
    return there[order], exact[order]


class MultiIndex:
    """Two codebooks and the number of entries of every centroid pair; what tasks are sent."""

    def __init__(self, first: np.ndarray, second: np.ndarray, dims: int):
        self.first, self.second, self.dims, self.half = first, second, dims, dims // 2
        self.counts = np.zeros(len(first) * len(second), np.int64)

    def cells(self, rows: np.ndarray) -> np.ndarray:
        return nearest_centroid(rows[:, :self.half], self.first) * len(self.second) + nearest_centroid(rows[:, self.half:], self.second)

    def distances(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every query to the centroids of both halves; in order of terms, so that every task gets the same."""
        def to(part: np.ndarray, centres: np.ndarray) -> np.ndarray:
            out = np.zeros((len(part), len(centres)))
            for j in range(centres.shape[1]):
                out -= part[:, j, None] * centres[None, :, j]
            return out
        return to(queries[:, :self.half], self.first), to(queries[:, self.half:], self.second)

    def shards(self, shard_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """First shard of every cell and the number of shards it is dealt over; neighbouring cells share a shard."""
        pieces = np.maximum(1, -(-self.counts // shard_rows))
        first, at, room = np.zeros(len(self.counts), np.int64), -1, 0
        for c in np.flatnonzero(self.counts):
            if pieces[c] > 1:
                first[c], at, room = at + 1, at + pieces[c], 0
            elif self.counts[c] <= room:
                first[c], room = at, room - self.counts[c]
            else:
                first[c], at, room = at + 1, at + 1, shard_rows - self.counts[c]
        return first, pieces


def _distinct_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part, each once."""
    plain = pick(df, vec_id=id_col, vec=vec_col)
    kind = plain.schema["vec"].dataType
    element = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"
    inf = F.lit(float("inf"))
    fine = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < inf)) & F.exists("vec", lambda x: x != 0)  # NaN sorts above infinity
    rows = plain.select(F.col("vec_id").cast("bigint"), F.col("vec").cast(f"array<{element}>"))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).distinct()


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """(class, vec, ids): a row for each different vector with its ``keep`` smallest ids (limited before the shuffle)."""
    small = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("n") <= keep)
    grouped = small.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return written(grouped.withColumn("class", F.monotonically_increasing_id()), "ann-classes")


def _sampled(df: DataFrame, rows: int, dims: int) -> np.ndarray:
    """A bounded sample of vectors, the same at every run: those of smallest hashes."""
    table = df.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(rows).toArrow()
    return _matrix(table["vec"], dims)


def _true_neighbours(index: DataFrame, queries: np.ndarray, dims: int, nearest: int) -> pa.Table:
    """(query, cell) of the nearest entries of a few queries, by comparing them with every entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, cell = np.empty((len(queries), 0)), np.empty((len(queries), 0), np.int64)
        for batch in batches:
            rows = _matrix(batch.column("vec"), dims)
            score = np.hstack([score, queries @ rows.T])
            cell = np.hstack([cell, np.broadcast_to(batch.column("cell").to_numpy(), (len(queries), len(rows)))])
            top = np.argsort(-score, axis=1, kind="stable")[:, :nearest + 1]
            score, cell = np.take_along_axis(score, top, 1), np.take_along_axis(cell, top, 1)
        q = np.repeat(np.arange(len(queries)), score.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(score.ravel()), pa.array(cell.ravel())], names=["query", "score", "cell"])

    found = index.select("vec", "cell").mapInArrow(run, "query bigint, score double, cell bigint")
    n = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cell"))
    return found.withColumn("n", n).where(F.col("n") <= nearest + 1).select("query", "cell").toArrow()  # a query itself is one of them, mostly the first


def _calibrated(index: MultiIndex, entries: DataFrame, queries: np.ndarray, nearest: int, recall: float) -> int:
    """Entries that a walk must meet for ``recall`` of the true neighbours of the sampled queries."""
    truth = _true_neighbours(entries, queries, index.dims, nearest)
    by_query: dict[int, list[int]] = {}
    for q, c in zip(truth["query"].to_pylist(), truth["cell"].to_pylist(), strict=True):
        by_query.setdefault(q, []).append(c)
    need = []
    for q, cells in by_query.items():
        a, b = index.distances(queries[q:q + 1])
        summed = (a[0][:, None] + b[0][None, :]).ravel()
        order = np.argsort(summed, kind="stable")
        met = np.empty(len(order), np.int64)
        met[order] = np.cumsum(index.counts[order])
        need.extend(met[cells].tolist())
    return int(np.sort(need)[min(len(need) - 1, math.ceil(recall * len(need)) - 1)]) if need else 1


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", is_query: Column | None = None, nearest: int = NEAREST,
           recall: float = RECALL, depth: int | None = None, centroids: int | None = None, shard_rows: int = SHARD_ROWS, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` found of every query row, best first, ranks from 1.

    ``is_query`` is a condition on ``vec_id`` (default: divisible by ``QUERY_STEP``).  A query's own
    id is no candidate.  Null, empty or all-zero vectors, vectors with a null, NaN or infinite
    component and rows without an id take no part, as query or candidate.  A repeated row counts
    once; of several vectors under one id each is an entry, and each a query.  Shorter vectors are
    filled up with zeros.  With fewer candidates than ``nearest`` all are returned; a lone vector or
    an empty table gives no rows.
    """
    spark = df.sparkSession
    is_query = F.col("vec_id") % QUERY_STEP == 0 if is_query is None else is_query
    rows = written(_distinct_rows(df, id_col, vec_col), "ann-rows")
    keep = nearest + 1
    classes = _classes(rows, keep)
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vec")
    asked = written(asked.join(classes.select("class", "vec"), "vec").select("query_id", "class"), "ann-queries")
    total, dims = classes.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], result)

    k = centroids or max(2, min(MOST_CENTROIDS, round(math.sqrt(total / CELL_ROWS))))
    sample = _sampled(classes, SAMPLE, dims)
    index = MultiIndex(fit_codebook(sample[:, :dims // 2], k), fit_codebook(sample[:, dims // 2:], k), dims)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = index.cells(_matrix(batch.column("vec"), dims)) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], names=[*batch.schema.names, "cell"])

    fields = f"class bigint, vec {classes.schema['vec'].dataType.simpleString()}, ids array<bigint>"
    entries = written(classes.select("class", "vec", "ids").mapInArrow(assign, f"{fields}, cell bigint"), "ann-index")
    counts = entries.groupBy("cell").count().toArrow()  # at most one row for each pair of centroids
    index.counts[counts["cell"].to_numpy()] = counts["count"].to_numpy()
    questions = classes.join(asked.select("class").distinct(), "class", "left_semi").select("class", "vec")
    if depth is None:
        depth = _calibrated(index, entries, _sampled(questions, CALIBRATION, dims), nearest, recall)
    first, pieces = index.shards(shard_rows)
    full = np.flatnonzero(index.counts)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(index.second)
        for batch in batches:
            vectors = _matrix(batch.column("vec"), dims)
            a, b = index.distances(vectors)
            reach = np.array([walk(a[i], b[i], index.counts, depth) for i in range(len(vectors))], np.float64)
            shards = []
            for i in range(len(vectors)):
                cells = full[a[i][full // width] + b[i][full % width] <= reach[i]]
                once = pieces[cells] == 1
                many = [np.arange(first[c], first[c] + pieces[c]) for c in cells[~once]]
                shards.append(np.unique(np.concatenate([first[cells[once]], *many])))
            yield pa.RecordBatch.from_arrays([batch.column("class"), batch.column("vec"), pa.array(reach, pa.float64()),
                                              pa.array(shards, pa.list_(pa.int64()))], names=["class", "vec", "reach", "shards"])

    vec_type = classes.schema["vec"].dataType.simpleString()
    sent = questions.mapInArrow(route, f"class bigint, vec {vec_type}, reach double, shards array<bigint>")
    sent = written(sent.select("class", "vec", "reach", F.explode("shards").alias("shard")), "ann-probes")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, ids = batch.column("cell").to_numpy(), batch.column("class").to_numpy().astype(np.uint64)
            spread = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            shard = first[cells] + (spread % pieces[cells].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int64())], names=[*batch.schema.names, "shard"])

    # a shard that many probes reach is copied for every ``probes`` of them, so blocks are bounded on both sides
    copies = sent.groupBy("shard").count().select("shard", F.ceil(F.col("count") / probes).cast("int").alias("copies"))
    left = entries.mapInArrow(place, f"{fields}, cell bigint, shard bigint").join(copies, "shard")
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    right = sent.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("class"), F.col("copies")).cast("int"))
    left, right = left.drop("copies").toDF("shard", "class", "vec", "ids", "cell", "copy"), right.drop("copies").toDF("shard", "class", "vec", "reach", "copy")

    def rerank(members: pa.Table, asking: pa.Table) -> pa.Table:
        x, cells = _matrix(members["vec"], dims), members["cell"].to_numpy()
        ids = members["ids"].combine_chunks()
        first_id = np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()] if len(x) else np.empty(0, np.int64)
        own, inverse = np.unique(cells, return_inverse=True)
        width, q_class = len(index.second), asking["class"].to_numpy()
        out_class, out_place, out_score = [], [], []
        for at in range(0, asking.num_rows if len(x) else 0, _SLICE):
            part = asking.slice(at, _SLICE)
            q = _matrix(part["vec"], dims)
            a, b = index.distances(q)
            walked = a[:, own // width] + b[:, own % width] <= part["reach"].to_numpy()[:, None]
            near = np.where(walked[:, inverse], q @ x.T, -np.inf)
            for i in range(len(q)):
                where, score = _best(x, near[i], q[i], first_id, keep)
                out_class.append(np.full(len(where), q_class[at + i]))
                out_place.append(where)
                out_score.append(score)
        where = np.concatenate(out_place) if out_place else np.empty(0, np.int64)
        return pa.table({"class": pa.array(np.concatenate(out_class) if out_class else [], pa.int64()),
                         "score": pa.array(np.concatenate(out_score) if out_score else [], pa.float64()),
                         "ids": ids.take(pa.array(where)) if len(x) else pa.array([], pa.list_(pa.int64()))})

    by = ("shard", "copy")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(rerank, "class bigint, score double, ids array<bigint>")
    best = Window.partitionBy("class").orderBy(F.desc("score"), F.col("ids")[0])
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep)
    lists = found.groupBy("class").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "ids")).alias("found"))
    each = F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct(f["far"].alias("far"), i.alias("vec_id")))))
    lists = lists.select("class", F.slice(F.sort_array(each), 1, keep).alias("found"))
    answers = asked.join(lists, "class").select(
        "query_id", F.posexplode(F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, nearest)).alias("n", "f"))
    return answers.select("query_id", (F.col("n") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.far")).alias("score"))
