"""Credits documents split into chunks give the same silver rows as whole documents."""

from cinelake.plans import silver
from cinelake.sources import bronze, testbed
from tests.conftest import SF_SMALL


def _cast_crew(spark):
    raw = bronze.land_credit_rows(testbed.credits_landing(spark, SF_SMALL))
    return raw, silver.silver_movie_cast(raw), silver.silver_movie_crew(raw)


def test_chunked_credits_documents_keep_first_position(spark, monkeypatch):
    whole_raw, whole_cast, whole_crew = _cast_crew(spark)
    n_whole = whole_raw.count()
    monkeypatch.setattr(testbed, "CREDITS_DOC_SIZE", 2)
    small_raw, small_cast, small_crew = _cast_crew(spark)
    assert small_raw.count() > n_whole                       # documents really were split
    assert small_cast.exceptAll(whole_cast).count() == 0 and whole_cast.exceptAll(small_cast).count() == 0
    assert small_crew.exceptAll(whole_crew).count() == 0 and whole_crew.exceptAll(small_crew).count() == 0
