"""Steps that several queries share are done once: bronze, movies in browse order, the exchange of credits."""

import glob
import threading

import pytest
from pyspark.sql import functions as F

from cinelake import queries_extra as qx
from cinelake.plans import catalog, jobs, search_index
from cinelake.session import scratch_dir
from tests.conftest import SF_SMALL, rows_of


def test_models_that_share_bronze_read_one_written_copy(spark):
    m = qx.written_models(spark, SF_SMALL, ["dim_movie", "bridge_movie_genre", "bridge_movie_cast", "bridge_movie_crew"])
    root = m["silver_movie"].inputFiles()[0].removeprefix("file:").split("/silver/")[0]
    assert glob.glob(f"{root}/bronze/movie_raw/*.parquet") and glob.glob(f"{root}/bronze/movie_credits_raw/*.parquet")
    lazy = catalog.all_models(catalog.testbed_bronze(spark, SF_SMALL))
    for name, df in m.items():
        assert rows_of(df.select(*[F.col(c).cast("string") for c in df.columns if c != "ingested_at"]).na.fill("-")) == rows_of(
            lazy[name].select(*[F.col(c).cast("string") for c in df.columns if c != "ingested_at"]).na.fill("-"))


def test_browse_order_is_made_from_written_movies(spark, monkeypatch):
    read = []
    write = search_index.write_browse_order
    monkeypatch.setattr(search_index, "write_browse_order", lambda movies, path: read.append(movies.inputFiles()) or write(movies, path))
    qx.q_browse_catalog(spark, SF_SMALL)
    assert read[0] and all("/gold/dim_movie/" in f for f in read[0])


def test_credits_are_written_as_their_grouping_left_them(spark):
    """Buckets of the whole key: between the grouping and the files there is no second exchange."""
    models = catalog.silver_models(catalog.testbed_bronze(spark, SF_SMALL))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("silver_movie_cast", "silver_movie_crew"):
        def exchanges(df):
            return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert exchanges(models[name].repartition(n, *catalog.BUCKET_KEYS[name])) == exchanges(models[name])


def test_landings_of_the_jobs_are_compressed(spark):
    root = qx.write_test_landing(spark, SF_SMALL, scratch_dir(spark, "test-gzip"), ("details", "genre"))
    files = [f for f in glob.glob(f"{root.removeprefix('file:')}/*/*/part-*")]
    assert files and all(f.endswith(".gz") for f in files)


def test_a_waiting_page_is_held_compressed():
    from cinelake.streaming import page_acceptor
    line = '{"endpoint": "/discover/movie", "body": "é' + '{"id": 1, "title": "a"}, ' * 50 + '"}'
    held = page_acceptor._packed(line)
    assert len(held) < len(line) / 5 and page_acceptor._unpacked(held) == line


def test_models_that_do_not_need_each_other_are_built_at_a_time(spark, monkeypatch):
    """silver_movie_cast waits until silver_movie_crew has begun: one model after the other would end in a time-out."""
    begun, write = threading.Barrier(2, timeout=60), jobs.materialize_table

    def waits(df, root, layer, table, *rest):
        if table in ("silver_movie_cast", "silver_movie_crew"):
            begun.wait()
        return write(df, root, layer, table, *rest)

    monkeypatch.setattr(jobs, "materialize_table", waits)
    m = qx.written_models(spark, SF_SMALL, ["dim_person"])
    assert list(m) == ["silver_movie_cast", "silver_movie_crew", "dim_person"]
    assert rows_of(m["dim_person"]) == rows_of(catalog.all_models(catalog.testbed_bronze(spark, SF_SMALL))["dim_person"])


def test_an_error_of_a_step_is_raised_and_nothing_starts_after_it():
    ran = []

    def fails():
        raise KeyError("broken")

    with pytest.raises(KeyError, match="broken"):
        jobs.materialize_all({"a": (set(), fails), "b": (set(), lambda: ran.append("b")), "c": ({"a"}, lambda: ran.append("c"))}, threads=1)
    assert not ran
