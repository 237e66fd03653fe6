import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from cinelake.operators import worklist
from cinelake.operators.dedupe import latest_per_key
from cinelake.session import scratch_dir
from cinelake.sources import landing
from cinelake.streaming import bronze_stream as bs
from cinelake.streaming import keyed_table
from tests.conftest import rows_of


def _write_events(spark, path, rows):
    lines = [(json.dumps({"event_id": i, "ts": f"2024-01-01T00:00:{s:02d}.000000", "user_id": u, "event_type": "view", "value": 1.0}),)
             for i, u, s in rows]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)


def _forget_last_commit(checkpoint):
    """The stream died between a batch's write and its commit."""
    commits = f"{checkpoint}/commits"
    newest = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for name in (str(newest), f".{newest}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")


def test_latest_survives_replay_and_restart(spark):
    base = scratch_dir(spark, "test-latest").replace("file:", "")
    _write_events(spark, f"{base}/landing/a", [(i, i % 40, i % 50) for i in range(200)])
    args = (f"{base}/landing/*", f"{base}/table", f"{base}/_ck")
    first = rows_of(bs.stream_latest(spark, *args), "user_id", "event_id")
    assert len(first) == 40 and rows_of(bs.stream_latest(spark, *args), "user_id", "event_id") == first
    _write_events(spark, f"{base}/landing/b", [(1000, 3, 59), (1001, 3, 58)])
    assert (3, 1000) in rows_of(bs.stream_latest(spark, *args), "user_id", "event_id")
    done = keyed_table.versions(spark, f"{base}/table")
    _forget_last_commit(f"{base}/_ck")
    again = rows_of(bs.stream_latest(spark, *args), "user_id", "event_id")
    assert len(again) == 40 and (3, 1000) in again
    assert keyed_table.versions(spark, f"{base}/table") == done         # the replayed batch was known
    # a new checkpoint is another stream: it reads everything again and changes nothing
    assert rows_of(bs.stream_latest(spark, f"{base}/landing/*", f"{base}/table", f"{base}/_ck2"), "user_id", "event_id") == again
    assert len(keyed_table.versions(spark, f"{base}/table")) == len(done) + 1
    shutil.rmtree(base)


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark):
    root = scratch_dir(spark, "test-keyed")
    rows = spark.range(500).select((F.col("id") % 200).alias("k"), F.col("id").alias("at"), (F.col("id") * 2).alias("v"))
    assert keyed_table.merge_batch(rows, root, ["k"], "at", "s", 0, buckets=16)
    assert len(keyed_table.touched_buckets(spark, root, 0)) == 16
    late = spark.createDataFrame([(7, 1, -1), (None, 5, 5), (None, 6, None)], "k bigint, at bigint, v bigint")
    assert keyed_table.merge_batch(late, root, ["k"], "at", "s", 1)
    want = rows_of(latest_per_key(rows.unionByName(late), ["k"], "at").where("k is not null"))
    assert rows_of(keyed_table.read_latest(spark, root).where("k is not null")) == want     # a late row changes nothing
    assert keyed_table.read_latest(spark, root).where("k is null").collect()[0].at == 6
    assert len(keyed_table.touched_buckets(spark, root, 1)) <= 2
    assert not keyed_table.merge_batch(rows, root, ["k"], "at", "s", 1)                      # this batch is in
    assert keyed_table.merge_batch(rows.limit(0), root, ["k"], "at", "s", 2) and not keyed_table.touched_buckets(spark, root, 2)
    before = rows_of(keyed_table.read_latest(spark, root), "at", "v")[-100:]
    keyed_table.rebucket(spark, root, ["k"], 3)
    assert rows_of(keyed_table.read_latest(spark, root), "at", "v")[-100:] == before
    assert keyed_table.read_latest(spark, root).count() == 201
    assert keyed_table.remove_unused(spark, root, keep=1) and keyed_table.read_latest(spark, root).count() == 201
    with pytest.raises(FileNotFoundError):
        keyed_table.read_latest(spark, f"{root}-none")


def test_a_crash_before_the_commit_leaves_the_old_version(spark, monkeypatch):
    root = scratch_dir(spark, "test-crash")
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k bigint, at bigint, v string")
    second = spark.createDataFrame([(1, 2, "c"), (3, 1, "d")], "k bigint, at bigint, v string")
    keyed_table.merge_batch(first, root, ["k"], "at", "s", 0, buckets=4)
    commit = keyed_table._commit

    def crash(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(keyed_table, "_commit", crash)
    with pytest.raises(RuntimeError, match="lost"):
        keyed_table.merge_batch(second, root, ["k"], "at", "s", 1)
    monkeypatch.setattr(keyed_table, "_commit", commit)
    assert rows_of(keyed_table.read_latest(spark, root)) == [(1, 1, "a"), (2, 1, "b")]
    keyed_table.merge_batch(second, root, ["k"], "at", "s", 1)                               # the replay
    assert rows_of(keyed_table.read_latest(spark, root)) == [(1, 2, "c"), (2, 1, "b"), (3, 1, "d")]
    with pytest.raises(RuntimeError, match="another writer"):
        keyed_table._commit(spark, root, keyed_table._state(spark, root))


def _pages(spark, rows):
    """Discover responses: (run, month, page, total_pages, ids, http_status)."""
    bodies = [(run, month, status, json.dumps({"page": page, "total_pages": total, "total_results": 9, "results": [{"id": i} for i in ids]}))
              for run, month, page, total, ids, status in rows]
    return spark.createDataFrame(bodies, "run string, month string, st int, b string").select(*landing.envelope(
        F.lit("/discover/movie"), F.col("st"), F.lit("2024-02-01").cast("timestamp_ntz"), F.parse_json("b"), None,
        F.col("month").cast("date"), F.col("run")))


JAN, FEB, MAR, APR = "2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"
FIRST = [("r1", JAN, 1, 3, [11], 200), ("r1", JAN, 3, 3, [13], 200), ("r1", JAN, 4, 3, [14], 200),      # page 2 comes late, page 4 is beyond the last
         ("r1", FEB, 2, 5, [22], 200), ("r1", FEB, 3, 5, [], 200), ("r1", FEB, 4, 5, [24], 200),        # page 1 comes late, page 3 is empty
         ("r1", MAR, 1, 9, [31], 200), ("r1", MAR, 2, 9, [32], 200), ("r1", MAR, 5, 9, [35], 200),      # page 3 never comes
         ("r2", JAN, 1, 2, [41, 42], 200), ("r2", JAN, 2, 2, [43], 200), ("r2", JAN, 1, 2, [41, 42], 200),   # one page twice
         ("r2", APR, 1, 1, [], 200)]
SECOND = [("r1", JAN, 2, 3, [12], 200), ("r1", FEB, 1, 5, [21], 200), ("r1", MAR, 4, 9, [34], 200), ("r2", APR, 2, 1, [92], 200)]


@pytest.mark.parametrize("files", [None, 3])
def test_streamed_pages_are_those_that_the_batch_accepts(spark, files):
    base = scratch_dir(spark, "test-pages")
    stream = lambda: bs.stream_bronze_append(spark, f"{base}/discover", f"{base}/bronze", f"{base}/_ck", bs.envelope_bronze("discover"), files)

    def streamed():
        return rows_of(spark.read.schema("movie_id bigint").parquet(f"{base}/bronze"), "movie_id")

    landing.write_landing(_pages(spark, FIRST).repartition(5), f"{base}/discover")
    stream()
    assert streamed() == [(i,) for i in (11, 31, 32, 41, 41, 42, 42, 43)]                    # what waits behind a gap is not there yet
    landing.write_landing(_pages(spark, SECOND), f"{base}/more")
    for run in ("r1", "r2"):
        for name in os.listdir(f"{base}/more/run_id={run}".replace("file:", "")):
            if name.startswith("part-"):
                shutil.copy(f"{base}/more/run_id={run}/{name}".replace("file:", ""), f"{base}/discover/run_id={run}/late-{name}".replace("file:", ""))
    stream()
    stream()
    batch = worklist.accept_pages(_pages(spark, FIRST + SECOND))
    want = rows_of(batch.select(F.explode(F.from_json(
        F.to_json(F.variant_get("body", "$.results", "variant")), "array<struct<id: bigint>>")).alias("m")).select("m.id"))
    assert streamed() == want == [(i,) for i in (11, 12, 13, 21, 22, 31, 32, 41, 41, 42, 42, 43)]


def test_envelopes_stream_into_bronze(spark):
    base = scratch_dir(spark, "test-envelopes")
    body = {"page": 1, "results": [{"id": 7}, {"id": 8}], "total_pages": 1}
    rows = spark.createDataFrame([(200, json.dumps(body))], "st int, b string").select(*landing.envelope(
        F.lit("/discover/movie"), F.col("st"), F.lit("2024-02-01").cast("timestamp_ntz"), F.parse_json("b"), None, F.lit("2024-01-01").cast("date")))
    landing.write_landing(rows, f"{base}/discover")
    for _ in range(2):
        bs.stream_bronze_append(spark, f"{base}/discover", f"{base}/bronze", f"{base}/_ck", bs.envelope_bronze("discover"))
    assert rows_of(spark.read.parquet(f"{base}/bronze"), "movie_id") == [(7,), (8,)]
    landing.write_landing(rows.withColumn("http_status", F.lit(429)), f"{base}/bad")
    with pytest.raises(Exception, match="unexpected HTTP status 429"):
        bs.stream_bronze_append(spark, f"{base}/bad", f"{base}/bronze2", f"{base}/_ck2", bs.envelope_bronze("discover"))


def test_stream_append_is_exactly_once(spark):
    base = scratch_dir(spark, "test-stream")
    os.makedirs(f"{base}/landing".replace("file:", ""), exist_ok=True)
    lines = spark.createDataFrame(
        [('{"event_id": %d, "ts": "2024-01-01T00:00:0%d.000000", "user_id": 1}' % (i, i),) for i in range(5)],
        "value string")
    lines.coalesce(1).write.text(f"{base}/landing/a")
    for _ in range(2):
        bs.stream_bronze_append(spark, f"{base}/landing/*", f"{base}/bronze", f"{base}/_ck")
    assert spark.read.parquet(f"{base}/bronze").count() == 5
