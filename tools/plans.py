"""Print the executed physical plans (after AQE) of the key queries over
stored bronze, reduced to the operators that matter for scale: exchanges,
joins, aggregates, windows and the Parquet ReadSchema.

usage: python tools/plans.py [--sf /root/testdata/sf0.01] > PLANS.md
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = """What to look for (checked each round):

* every de-duplication is `partial_max(struct)` / `partial_min` / partial `HashAggregate` *below* its
  `Exchange`: hot keys are reduced in the map tasks (string payloads and `min(name)` make it a
  `SortAggregate`: map tasks sort their rows);
* in this lazy chain dim_movie joins two outputs already hash-partitioned on `movie_id` (AQE shows a
  broadcast only because details is small at this scale); over written silver both sides are shuffled;
* `ReadSchema` of bronze scans lists single VARIANT paths (`raw_json:struct<0:...,1:...>`), and
  predicates on them reach the scan as `DataFilters` (details_worklist: `raw_json.0 >= 1.0`);
* movies per genre counts the bridge per genre before the join; the data tests of a table are one
  grouped aggregate;
* accept_pages finds the first gap by an anti join on (run, month, page) and joins one stop row per run
  and month, broadcast by AQE from its measured size only;
* the newest ID export and the new fetch runs are found by listings, so the scans list those paths alone
  (`export_worklist`: one file; a daily run: `PartitionFilters` on run_id).
"""

KEEP = re.compile(r"PartitionFilters|Exchange|Join|Aggregate|Window|ReadSchema|TakeOrdered|Generate|Union|AQEShuffleRead|Reused")


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    from pyspark.sql import functions as F
    from cinelake.operators import quality, worklist
    from cinelake.operators.dedupe import latest_per_key
    from cinelake.plans import catalog, discover, jobs
    from cinelake.queries_extra import _write_exports
    from cinelake.session import build_session, scratch_dir
    from cinelake.sources import bronze
    spark = build_session("local[8]", 16)
    root = scratch_dir(spark, "plans")
    tb = catalog.testbed_bronze(spark, a.sf)
    for name, df in zip(bronze.BRONZE_TABLES, (tb.genre, tb.movie, tb.details, tb.credits)):
        bronze.bronze_append(df, f"{root}/bronze/{name}")
    b = jobs.read_bronze(spark, root)
    m = catalog.all_models(b)
    from cinelake.sources import landing, testbed
    pages_path = landing.write_landing(testbed.discover_landing(spark, a.sf), f"{root}/landing/discover")
    li = spark.read.parquet(f"{a.sf}/lineitem.parquet")
    hot = li.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_partkey")))
    cases = {
        "silver_movie": m["silver_movie"],
        "silver_movie_cast": m["silver_movie_cast"],
        "dim_movie": m["dim_movie"],
        "dim_person": m["dim_person"],
        "fct_movies_by_genre": m["fct_movies_by_genre"],
        "details_worklist": worklist.details_worklist(b.movie, b.details),
        "rating_by_genre": discover.rating_by_genre(m["dim_movie"], m["bridge_movie_genre"], m["dim_genre"]),
        "top_popular_movies": discover.top_popular_movies(m["dim_movie"]),
        "quality (dim_movie)": quality.table_tests(m["dim_movie"], quality.DECLARED_TESTS["dim_movie"], "dim_movie"),
        "latest_per_key, hot key": latest_per_key(hot, ["l_partkey"], newest="l_shipdate"),
        "accept_pages (over landed files)": worklist.accept_pages(landing.read_landing(spark, pages_path)),
        "land_movie_rows (one fetch run)": bronze.land_movie_rows(landing.read_landing(spark, pages_path, ["1995-02-01"])),
        "dominant_genre_by_year": discover.dominant_genre_by_year(m["dim_movie"], m["bridge_movie_genre"], m["dim_genre"]),
        "export_worklist (newest file)": worklist.export_worklist(
            bronze.read_id_export(spark, bronze.newest_export(spark, f"{_write_exports(spark, a.sf)}/movie_ids_*")), b.details),
    }
    print("# Physical plans (executed, after AQE)\n")
    print(NOTES)
    print(f"Generated by `python tools/plans.py` at {a.sf} over stored bronze; only exchanges, joins, "
          "aggregates, windows, generators and scan schemas are kept.\n")
    for name, df in cases.items():
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = []
        for ln in plan.split("\n"):
            if not KEEP.search(ln):
                continue
            head, _, schema = ln.rstrip().partition(", ReadSchema: ")
            lines.append(head.split(" Batched:")[0] if schema else head)
            if schema:
                lines.append(" " * (len(head) - len(head.lstrip())) + "   ReadSchema: " + schema)
        lines = [re.sub(r"#\d+L?", "", ln) for ln in lines]
        lines = [re.sub(r"\[plan_id=\d+\]", "", ln) for ln in lines]
        lines = [ln if len(ln) < 220 else ln[:217] + "..." for ln in lines]
        print(f"## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
