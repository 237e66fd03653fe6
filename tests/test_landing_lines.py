"""Landed lines are parsed once however many conditions stand over them, and written alike from structs and from VARIANT."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cinelake.functions.jsonops import required_array
from cinelake.operators import worklist
from cinelake.session import scratch_dir
from cinelake.sources import bronze, landing


def _lines(spark, path, lines):
    spark.createDataFrame([(run, line) for run, line in lines], "run_id string, value string").select(
        "value", "run_id").write.partitionBy("run_id").text(path)
    return landing.read_lines(spark, path)


def _page(page, ids, status=200, total=2, date="2024-01-01"):
    return json.dumps({"endpoint": "/discover/movie", "http_status": status, "fetched_at": "2024-02-01T00:00:00.000000", "request_date": date,
                       "body": {"page": page, "results": [{"id": i} for i in ids], "total_pages": total}}, separators=(",", ":"))


def _parses(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("parseJson"), plan.count("FileScan text")


def test_a_line_is_parsed_once(spark):
    lines = _lines(spark, scratch_dir(spark, "test-lines"), [("r", _page(1, [7])), ("r", _page(2, [8]))])
    parsed = landing.parse_landing(lines)
    assert _parses(bronze.land_movie_rows(worklist.accept_pages(parsed, stored=True), carry=("run_id", "month"))) == (1, 1)
    assert _parses(bronze.drop_missing_responses(parsed).select(F.array_size(required_array("body", "results")))) == (1, 1)
    assert _parses(parsed.where("request_key is not null and http_status = 200").select("run_id", "request_key")) == (1, 1)
    with pytest.raises(Exception, match="MALFORMED"):
        landing.parse_landing(lines.withColumn("value", F.lit("{"))).collect()


def test_stored_pages_are_judged_by_numbers_alone(spark):
    lines = [("r", _page(1, [1, 2], total=9)), ("r", _page(2, [3], total=9)), ("r", _page(4, [9], total=9)), ("s", _page(1, [5], total=1)),
             ("s", _page(2, [6], total=1)), ("t", _page(1, [], total=3)), ("u", _page(2, [8]))]
    parsed = landing.parse_landing(_lines(spark, scratch_dir(spark, "test-stored"), lines))
    ids = lambda df: sorted(r.movie_id for r in bronze.land_movie_rows(df).collect())
    root = os.path.dirname(scratch_dir(spark, "x").removeprefix("file:"))
    before = set(os.listdir(root))
    assert ids(worklist.accept_pages(parsed, stored=True)) == ids(worklist.accept_pages(parsed)) == [1, 2, 3, 5]
    new = [n for n in sorted(set(os.listdir(root)) - before) if n.startswith("page")]
    assert [n.rsplit("-", 1)[0] for n in new] == ["page-numbers", "pages"]
    assert spark.read.parquet(f"{root}/{new[0]}").columns == ["run_id", "month", "page", "n_results", "total_pages"]
    bad = landing.parse_landing(_lines(spark, scratch_dir(spark, "test-bad"), [*lines, ("v", _page(1, [1], status=500))]))
    with pytest.raises(Exception, match="unexpected HTTP status 500"):
        worklist.accept_pages(bad, stored=True).collect()


def test_struct_and_variant_bodies_are_the_same_landing(spark):
    doc = F.struct(F.col("k").alias("id"), F.col("t").alias("title"), F.col("d").alias("popularity"), F.array("k", "k").alias("genre_ids"))
    rows = spark.createDataFrame([(1, 'é "q"', 12.0), (2, None, 1.5e-7), (None, "", None), (4, "x", 0.1)], "k bigint, t string, d double")
    back = []
    for as_body in (lambda c: F.parse_json(F.to_json(c)), lambda c: c):
        path = landing.write_landing(rows.select(*landing.envelope(F.lit("/m"), F.lit(200), F.lit("2024-01-01"), as_body(doc), F.col("k"))),
                                     scratch_dir(spark, "test-bodies"))
        back.append(sorted(str((r.request_key, r.i, r.t, r.d, r.g)) for r in landing.read_landing(spark, path).select(
            "request_key", F.variant_get("body", "$.id", "bigint").alias("i"), F.variant_get("body", "$.title", "string").alias("t"),
            F.variant_get("body", "$.popularity", "double").alias("d"), F.variant_get("body", "$.genre_ids", "array<bigint>").alias("g")).collect()))
    assert back[0] == back[1] and len(back[0]) == 4


def test_the_day_of_a_request_is_found_wherever_it_stands(spark):
    lines = [_page(1, [1]), json.dumps({"body": {"request_date": "1999-01-01"}, "request_date": "2024-01-01"}, separators=(",", ":")),
             json.dumps({"endpoint": '/x?q=",\"body\":', "request_date": "2024-01-01", "body": {}}), json.dumps({"endpoint": "/x", "body": {}}),
             json.dumps({"endpoint": "/x", "request_date": None, "body": {"request_date": "1999-01-01"}}, separators=(",", ":"))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    got = {r.i: str(r.d) for r in df.select("i", landing.request_day().alias("d")).collect()}
    assert got == {0: "2024-01-01", 1: "2024-01-01", 2: "2024-01-01", 3: "None", 4: "None"}
