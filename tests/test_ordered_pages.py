"""Pages cut where the sorted slices lie."""

from collections import defaultdict

from pyspark.sql import functions as F

from cinelake.operators.ranking import ordered_pages
from cinelake.sources import testbed
from tests.conftest import SF_SMALL


def _pages(df, size):
    return ordered_pages(df, ["g"], ["k", "v"], size, F.struct("k", "v"), total="n")


def test_pages_of_hot_null_and_tied_groups(spark):
    # a group with most rows, a null group, null and repeated order keys, and rows that come twice
    df = spark.range(6000).select(F.when(F.col("id") % 50 == 1, None).when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("g"),
                                  F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 40).alias("k"), (F.col("id") % 900).alias("v"))
    df = df.unionByName(df.where("v < 30")).repartition(5)
    groups = defaultdict(list)
    for r in df.collect():
        groups[r.g].append((r.k, r.v))
    want = {}
    for g, rows in groups.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        want |= {(g, i // 7 + 1): (len(rows), rows[i:i + 7]) for i in range(0, len(rows), 7)}
    got = _pages(df, 7).collect()
    assert len(got) == len(want)                # a page that two slices share is one page
    assert {(r.g, r.page): (r.n, [tuple(x) for x in r.rows]) for r in got} == want
    assert _pages(df.limit(0), 7).count() == 0
    assert [len(r.rows) for r in _pages(df.limit(5), 7).collect()] and _pages(df.limit(5), 7).agg(F.sum(F.size("rows"))).first()[0] == 5


def test_only_rows_of_shared_pages_move_again(spark):
    df = spark.range(20000).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"), (F.col("id") * 7 % 101).alias("v"))
    pages = _pages(df, 20)
    pages.collect()
    plan = pages._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    whole, cut = plan.split("ObjectHashAggregate(keys=[__s")[-1].split("ObjectHashAggregate(keys=[g")[:1], plan
    assert " Exchange hashpartitioning" not in whole[0] and cut.count(" Exchange hashpartitioning") == 1
    assert pages.where(F.size("rows") > 20).count() == 0


def test_discover_pages_are_in_the_order_of_their_month(spark):
    landed = testbed.discover_landing(spark, SF_SMALL, as_body=testbed.unparsed)
    ids = [(r.request_date, r.body.page, x.id, x.l_orderkey, x.l_linenumber) for r in landed.collect() for x in r.body.results]
    assert len(ids) == testbed.table(spark, SF_SMALL, "lineitem").count()
    assert [x[2:] for x in sorted(ids, key=lambda x: x[:2])] == [x[2:] for x in sorted(ids, key=lambda x: (x[0], *x[2:]))]
