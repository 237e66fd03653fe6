"""Discovery through indexes gives the rows that it gives without them, and reads less."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cinelake.plans import catalog, discover, jobs
from cinelake.plans import search_index as si
from cinelake.session import scratch_dir
from tests.conftest import SF_SMALL, rows_of


def scanned(df):
    """Rows that the scans of a plan handed on, and files they read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves, found = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        found += metric.get().value() if metric.isDefined() else 0
    return found


WORDS = ["the", "Ring", "ringing", "red", "Straße", "île", "of", "a", "k", "", "xyz", "\U0001f600 face", "ab"]


@pytest.fixture(scope="module")
def movies(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 4))) if i % 50 else None, rng.random() * 100, rng.choice([None, rng.random() * 10]),
             None if i % 17 == 0 else dt.date(1950, 1, 1) + dt.timedelta(days=rng.randint(0, 27_000)), i % 3 == 0) for i in range(4_000)]
    df = spark.createDataFrame(rows, "movie_id bigint, title string, popularity double, vote_average double, release_date date, adult boolean")
    path = scratch_dir(spark, "test-movies")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_search_through_trigrams(spark, movies):
    path = si.write_trigrams(movies, "movie_id", "title", scratch_dir(spark, "test-grams"), 1 << 16)
    postings = spark.read.parquet(path)
    persons = movies.select((F.col("movie_id") + 7).alias("person_id"), F.reverse("title").alias("name"))
    names = spark.read.parquet(si.write_trigrams(persons, "person_id", "name", scratch_dir(spark, "test-grams")))
    for q in ("ring", "RING the", "r", "ri", "", "straße", "île ", "\U0001f600", "zzz", "gni", "a a", "%", "red ring"):
        assert rows_of(discover.title_search(movies, q, postings=postings)) == rows_of(discover.title_search(movies, q))
        assert rows_of(discover.multi_search(movies, persons, q, postings, names)) == rows_of(discover.multi_search(movies, persons, q))
    hits = postings.where(F.col("gram").isin(si.grams_of("xyz")))
    assert "PushedFilters: [In(gram" in hits._jdf.queryExecution().executedPlan().toString() or "EqualTo(gram" in hits._jdf.queryExecution().executedPlan().toString()
    assert 0 < hits.count() <= scanned(hits) < postings.count() / 2      # most files are skipped by their statistics


def test_genres_through_bitmaps(spark, movies):
    rng = random.Random(4)
    links = [(m, g) for m in list(range(0, 4_000, 3)) + [40_000, 70_000, 70_001] for g in rng.sample(range(6), rng.randint(1, 4))]
    bridge = spark.createDataFrame(links + links[:50], "movie_id bigint, genre_id bigint")
    wide = movies.unionByName(spark.createDataFrame([(i, f"t{i}", 1.0, 1.0, None, False) for i in (40_000, 70_000, 70_001, 99_999)], movies.schema))
    bitmaps = spark.read.parquet(si.write_bitmaps(bridge, scratch_dir(spark, "test-bitmaps")))
    for ids in ([1], [1, 2], [0, 3, 5], [2, 2], [77], [1, 77]):
        assert rows_of(discover.genres_all(wide, None, ids, bitmaps), "movie_id") == rows_of(discover.genres_all(wide, bridge, ids), "movie_id")
        assert rows_of(discover.genres_any(wide, None, ids, bitmaps), "movie_id") == rows_of(discover.genres_any(wide, bridge, ids), "movie_id")
    assert discover.genres_all(wide, None, [1, 2], bitmaps).count() > 0


def test_browsing_in_curve_order_reads_fewer_row_groups(spark, movies):
    bridge = spark.createDataFrame([(i, 1) for i in range(0, 4_000, 2)], "movie_id bigint, genre_id bigint")
    ordered = spark.read.parquet(si.write_browse_order(movies, scratch_dir(spark, "test-browse"), files=64))
    assert rows_of(ordered, "movie_id") == rows_of(movies, "movie_id")
    for asked in (dict(min_popularity=90.0), dict(min_rating=9.0), dict(year_from=2010, year_to=2015), dict(min_popularity=80.0, year_from=1960, year_to=1965)):
        assert rows_of(discover.browse_catalog(ordered, bridge, **asked), "movie_id") == rows_of(discover.browse_catalog(movies, bridge, **asked), "movie_id")
        assert scanned(discover.browse_catalog(ordered, bridge, **asked)) < 0.6 * scanned(discover.browse_catalog(movies, bridge, **asked))
    assert rows_of(discover.browse_catalog(ordered, bridge, genre_id=1, min_rating=5.0), "movie_id") == rows_of(
        discover.browse_catalog(movies, bridge, genre_id=1, min_rating=5.0), "movie_id")
    si.write_browse_order(movies.limit(0), scratch_dir(spark, "test-browse"))


def test_indexes_are_written_with_the_tables(spark):
    root = scratch_dir(spark, "test-index")
    jobs.build_catalog(spark, catalog.testbed_bronze(spark, SF_SMALL), root, version=1, indexes=True)
    movie = jobs.read_table(spark, root, "gold", "dim_movie")
    grams = si.read_index(spark, root, "dim_movie_title_grams", 1)
    assert rows_of(discover.title_search(movie, "ring", postings=grams)) == rows_of(discover.title_search(movie, "ring"))
    assert si.read_index(spark, root, "dim_movie_browse", 1).count() == movie.count()
    assert si.read_index(spark, root, "genre_bitmaps", 1).count() > 0
    assert si.read_index(spark, root, "dim_person_name_grams", 1).count() > 0
