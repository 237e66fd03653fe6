import pytest
from pyspark.sql import functions as F

from cinelake.plans import catalog, jobs
from cinelake.queries_extra import write_test_landing
from cinelake.session import scratch_dir
from tests.conftest import SF_SMALL, rows_of


def test_versions_layers_and_missing_tables(spark):
    root = scratch_dir(spark, "test-jobs")
    df1 = spark.range(3).withColumn("v", F.lit(1))
    df2 = spark.range(5).withColumn("v", F.lit(2))
    jobs.materialize_table(df1, root, "silver", "t", version=1)
    jobs.materialize_table(df2, root, "silver", "t", version=2)
    assert jobs.read_table(spark, root, "silver", "t").count() == 5          # newest complete version
    assert jobs.current_version(spark, jobs.table_path(root, "silver", "t")).endswith("version=2")
    assert jobs.table_path(root, "gold", "dim_movie").endswith("/gold/dim_movie")
    with pytest.raises(ValueError):
        jobs.table_path(root, "platinum", "x")
    with pytest.raises(FileNotFoundError):
        jobs.read_table(spark, root, "gold", "nothing")
    assert jobs.count_rows(df2).first().row_count == 5


BRONZE = ("genre_raw", "movie_raw", "movie_details_raw", "movie_credits_raw")


def _counts(spark, cat):
    return {t: spark.read.parquet(jobs.table_path(cat, "bronze", t)).count() for t in BRONZE}


def test_daily_increment_twice_is_stable(spark):
    base = scratch_dir(spark, "test-daily")
    land = write_test_landing(spark, SF_SMALL, f"{base}/landing")
    cat = f"{base}/catalog"
    report1 = {(r.table_name, r.test_name, r.column_names): r.failures
               for r in jobs.daily_increment(spark, land, cat, version=1).collect()}
    first, counts = rows_of(jobs.read_table(spark, cat, "gold", "dim_movie")), _counts(spark, cat)
    assert min(counts.values()) > 0
    jobs.daily_increment(spark, land, cat, version=2)
    assert rows_of(jobs.read_table(spark, cat, "gold", "dim_movie")) == first
    assert _counts(spark, cat) == counts                     # nothing is loaded twice, into any table
    assert report1[("dim_movie", "unique", "movie_id")] == 0


def test_full_backfill_loads_bronze_once_and_restarts(spark):
    base = scratch_dir(spark, "test-backfill")
    write_test_landing(spark, SF_SMALL, f"{base}/landing", ("discover",))
    land, cat = f"{base}/landing/discover", f"{base}/catalog"
    movies = jobs.full_backfill(spark, land, cat).count()
    path = jobs.table_path(cat, "bronze", "movie_raw")
    n = spark.read.parquet(path).count()
    assert n == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert jobs.full_backfill(spark, land, cat).count() == movies and spark.read.parquet(path).count() == n
    # a crash after some months: their folders are there, the run is not marked as loaded
    fs, marks = jobs._fs(spark, f"{cat}/bronze/_loaded")
    fs.delete(marks, True)
    gone = sorted(st.getPath().toString() for st in fs.listStatus(jobs._fs(spark, path)[1]) if "run_id=" in st.getPath().toString())[:3]
    for folder in gone:
        fs.delete(jobs._fs(spark, folder)[1], True)
    assert jobs.full_backfill(spark, land, cat).count() == movies and spark.read.parquet(path).count() == n


def test_a_failed_model_skips_its_dependents(spark, monkeypatch):
    base = scratch_dir(spark, "test-failed")
    b = catalog.testbed_bronze(spark, SF_SMALL)
    jobs.build_catalog(spark, b, base, version=1)
    broken = dict(catalog.SILVER_BUILDERS, silver_movie=lambda x: x.movie.select(F.raise_error(F.lit("broken " + "long " * 200 + "end")).alias("movie_id")))
    monkeypatch.setattr(catalog, "SILVER_BUILDERS", broken)
    with pytest.raises(jobs.BuildFailed) as failed:
        jobs.build_catalog(spark, catalog.testbed_bronze(spark, SF_SMALL), base, version=2)
    rows = {(r.table_name, r.test_name): r for r in failed.value.report.where("failures > 0").collect()}
    assert rows["silver_movie", "build"].column_names.count("long") >= 200       # the whole error
    assert rows["dim_movie", "skipped"].column_names == "needs silver_movie"
    assert jobs.current_version(spark, jobs.table_path(base, "gold", "dim_movie")).endswith("version=1")
    assert jobs.current_version(spark, jobs.table_path(base, "gold", "dim_person")).endswith("version=2")
    assert failed.value.report.where("table_name = 'dim_movie' and test_name = 'unique'").count() == 1   # tests still run
    monkeypatch.undo()
    jobs.build_catalog(spark, b, base, version=3)
    removed = jobs.remove_old_versions(spark, base, keep=1)
    assert any("dim_movie/version=1" in f for f in removed) and not any("version=3" in f for f in removed)
    assert jobs.read_table(spark, base, "gold", "dim_movie").count() > 0


def test_scale_settings_bounds():
    from cinelake.session import scale_settings
    small = scale_settings(10 << 20, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"                  # two waves of 8 slots
    big = scale_settings(100 * (1 << 40), cores=8000)                      # 100 TB on 8,000 slots
    assert big["spark.sql.shuffle.partitions"] == "100000"
    assert int(big["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == 4 * (256 << 20)
