"""Nearest neighbours against comparing everything."""

import heapq

import numpy as np
import pytest

import __spark_entry__ as entry
from cinelake.llm import neighbours as nb
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<float>"


def exact(rows, nearest=20, step=20):
    """{query: [(vec_id, score)]} of rows (vec_id, vector) that take part; terms are added from left to right."""
    dims = max((len(v) for _, v in rows), default=0)
    padded = {(i, tuple(map(float, v))): np.array([*map(float, v), *[0.0] * (dims - len(v))]) for i, v in rows}
    out = {}
    for (q, _), a in padded.items():
        if q % step == 0:
            found = [(-float(np.cumsum(b * a)[-1]), i) for (i, _), b in padded.items() if i != q]
            out[q] = [(i, -s) for s, i in heapq.nsmallest(nearest, found)]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.1"])
def test_recall_and_scores_of_the_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    truth, got = exact(rows), found(entry.queries()["op13_neighbours"](spark, sf))
    assert set(got) == set(truth) and all(len(v) == 20 for v in got.values())
    met = [len({i for i, _ in got[q]} & {i for i, _ in truth[q]}) / 20 for q in truth]
    assert np.mean(met) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, answers in got.items():
        assert answers == sorted(answers, key=lambda a: (-a[1], a[0]))
        assert all(s == np.cumsum(vectors[i] * vectors[q])[-1] for i, s in answers)


def mixed(n=600, dims=10, copies=250):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(n, dims)).astype(np.float32)
    v[:copies] = v[0]                        # a vector that a good third of the rows share
    v[copies:copies + 60] *= 40              # and some of much larger length
    return [(i, [float(x) for x in v[i]]) for i in rng.permutation(n).tolist()]


def test_whole_walk_is_exact_in_small_blocks(spark):
    rows = mixed()
    for sizes in ({}, {"shard_rows": 16, "probes": 5}):
        assert found(nb.search(spark.createDataFrame(rows, SCHEMA), depth=10**9, **sizes)) == exact(rows)


def test_recall_with_copies_and_unequal_lengths(spark):
    rows = mixed()
    truth, got = exact(rows), found(nb.search(spark.createDataFrame(rows, SCHEMA)))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in truth[q]}) / len(truth[q]) for q in truth]) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (20, [0.0, 0.0]), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]),
            (3, []), (None, [1.0, 1.0]), (100, [2.0]), (4, [1.0, 0.0]), (5, [-0.0, 0.0]), (120, [1.0, 0.0])]
    fine = [(i, v) for i, v in rows if i is not None and v and None not in v and all(abs(x) < inf for x in v) and any(v)]
    got = found(nb.search(spark.createDataFrame([(*r, "x", "y") for r in rows], f"{SCHEMA}, class string, Vec string"), depth=10**9))
    assert got == exact(fine)
    assert [i for i, _ in got[0]] == [100, 4, 120, 1]


def test_few_rows_and_none(spark):
    assert nb.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nb.search(spark.createDataFrame([(20, [1.0])], SCHEMA)).count() == 0
    assert found(nb.search(spark.createDataFrame([(20, [1.0]), (1, [3.0])], SCHEMA))) == {20: [(1, 3.0)]}
    assert nb.search(spark.createDataFrame([(21, [1.0]), (1, [3.0])], SCHEMA)).count() == 0     # no query
    same = [(i, [1.0, 2.0]) for i in range(50)]
    assert [i for i, _ in found(nb.search(spark.createDataFrame(same, SCHEMA)))[20]] == list(range(20))


def test_walk_meets_cells_in_order_of_distance():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.normal(size=rng.integers(1, 9)), rng.normal(size=rng.integers(1, 9))
        counts = rng.integers(0, 4, len(a) * len(b))
        summed = (a[:, None] + b[None, :]).ravel()
        met = np.cumsum(counts[np.argsort(summed)])
        for depth in (1, 5, int(counts.sum()), int(counts.sum()) + 1):
            want = np.sort(summed)[np.searchsorted(met, depth)] if depth <= met[-1] else np.inf
            assert nb.walk(a, b, counts, depth) == want
