"""Popularity kept by day: equal to the full rebuild in any order of days, after a crash, and from the ledger."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cinelake.plans import discover, gold, jobs, popularity_days, silver
from cinelake.session import scratch_dir
from tests.conftest import bronze_df, rows_of


def snapshot(movie, at, popularity):
    return movie, "/discover/movie", json.dumps({"id": movie, "popularity": popularity, "vote_average": 5.0, "vote_count": 3}), at


def days_of(spark, days):
    return spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("snapshot_date"))


def same_as_full(spark, raw, root):
    details = silver.silver_movie_details(bronze_df(spark, [(1, "/movie", json.dumps({"id": 1, "revenue": 7}), "2024-01-01")]))
    fact = gold.fact_movie_popularity(raw, details)
    stored = popularity_days.read_days(spark, root)

    def key(rows):
        return sorted(repr(r) for r in rows)
    assert key(rows_of_any(popularity_days.fact_movie_popularity(stored, details), fact.columns)) == key(rows_of_any(fact, fact.columns))
    full = discover.popularity_over_time(fact)
    assert key(rows_of_any(popularity_days.popularity_over_time(stored), full.columns)) == key(rows_of_any(full, full.columns))


def rows_of_any(df, cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def folders(spark, root):
    """Modification time of each day's files."""
    fs, p = jobs._fs(spark, jobs.table_path(root, "gold", popularity_days.FACT))
    return {st.getPath().getName(): max(f.getModificationTime() for f in fs.listStatus(st.getPath())) for st in fs.listStatus(p) if st.isDirectory()}


@pytest.mark.parametrize("seed", [1, 2])
def test_days_in_any_order_equal_the_full_rebuild(spark, seed):
    rng = random.Random(seed)
    days = [f"2024-01-{d:02d}" for d in range(1, 8)]
    rows = [snapshot(m, f"{d} {h:02d}:00:00", None if rng.random() < 0.1 else float(rng.randint(1, 9)))
            for d in days for m in range(1, 7) for h in (3, 9) if rng.random() < 0.4]
    raw, root = bronze_df(spark, rows).cache(), scratch_dir(spark, "test-popularity")
    order = rng.sample(days, len(days))
    seen = []
    for part in (order[:3], order[3:4], order[4:6], order[6:], order[:1]):       # the last one comes again
        popularity_days.refresh_days(raw, root, days_of(spark, part))
        seen += part
        so_far = raw.where(F.to_date("ingested_at").cast("string").isin(seen))
        same_as_full(spark, so_far, root)
    raw.unpersist()


def test_a_new_day_writes_that_day_and_a_late_one_the_next_of_its_movies(spark):
    root = scratch_dir(spark, "test-popularity-days")
    rows = [snapshot(1, "2024-01-01", 1.0), snapshot(2, "2024-01-01", 1.0), snapshot(1, "2024-01-03", 4.0), snapshot(2, "2024-01-04", 5.0),
            snapshot(1, "2024-01-05", 9.0)]
    popularity_days.refresh_days(bronze_df(spark, rows), root)
    same_as_full(spark, bronze_df(spark, rows), root)
    before = folders(spark, root)
    rows += [snapshot(1, "2024-01-06", 3.0), snapshot(7, "2024-01-06", None)]
    assert [str(r[0]) for r in popularity_days.refresh_days(bronze_df(spark, rows), root, days_of(spark, ["2024-01-06"])).collect()] == ["2024-01-06"]
    after = folders(spark, root)
    assert {k: v for k, v in after.items() if not k.endswith("06")} == before
    rows += [snapshot(1, "2024-01-02", 2.0)]
    written = popularity_days.refresh_days(bronze_df(spark, rows), root, days_of(spark, ["2024-01-02"]))
    assert sorted(str(r[0]) for r in written.collect()) == ["2024-01-02", "2024-01-03"]
    same_as_full(spark, bronze_df(spark, rows), root)
    rows += [snapshot(2, "2024-01-06 08:00:00", 8.0)]                               # the newest day once more
    popularity_days.refresh_days(bronze_df(spark, rows), root, days_of(spark, ["2024-01-06"]))
    same_as_full(spark, bronze_df(spark, rows), root)


def test_a_crash_before_the_carried_rows_is_mended_by_the_same_call(spark, monkeypatch):
    root = scratch_dir(spark, "test-popularity-crash")
    rows = [snapshot(1, "2024-01-01", 1.0), snapshot(2, "2024-01-02", 2.0), snapshot(1, "2024-01-03", 3.0), snapshot(2, "2024-01-04", 1.0)]
    raw = bronze_df(spark, rows)
    popularity_days.refresh_days(raw, root, days_of(spark, ["2024-01-01", "2024-01-03"]))

    def fail(*_):
        raise RuntimeError("lost")
    for day in ("2024-01-04", "2024-01-02"):
        with monkeypatch.context() as m:
            m.setattr(jobs, "materialize_table", fail)
            with pytest.raises(RuntimeError):
                popularity_days.refresh_days(raw, root, days_of(spark, [day]))
        popularity_days.refresh_days(raw, root, days_of(spark, [day]))
    same_as_full(spark, raw, root)


def test_nothing_to_do(spark):
    root = scratch_dir(spark, "test-popularity-none")
    assert popularity_days.refresh_days(bronze_df(spark, []), root).count() == 0
    assert popularity_days.refresh_days(bronze_df(spark, [snapshot(1, "2024-01-01", 1.0)]), root, days_of(spark, ["2024-02-01"])).count() == 0
    assert popularity_days.refresh_popularity(spark, root) is None and rows_of(popularity_days.read_days(spark, root)) == []
