"""Every operator and stage on awkward rows: nulls, empty and very long texts, ties, repeated rows, clashing names, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cinelake.llm import decontaminate, html_extract, licenses, packing, pii, quality, secrets, sharding, simhash, toxicity

LONG = "word soup of many words and then some more. " * 8_000
ROWS = [
    (1, "An ordinary text of a few words."), (1, "An ordinary text of a few words."), (2, None), (None, "a text without an id"), (None, None),
    (3, ""), (4, " \n\t "), (5, LONG), (6, "é中\U0001f600 \x00 café x"), (7, "An ordinary text of a few words."),
]
SCHEMA = "doc_id bigint, text string"
# names that operators make themselves, one that differs from an input's name in case only, and one name twice
CLASHES = ["row", "Text", "DOC_ID", "fp", "key", "part", "n", "ids", "spans", "found", "shard", "place", "license", "path2", "fp"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, None), (None, 1), (5, 0), (9, 1)], "doc_id bigint, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "ordinary text of a few"), (1, "ordinary text of a few"), (2, None), (None, "soup of many words"), (3, "")],
                                 "item_id bigint, text string")


def by_text(df, docs_count=len(ROWS)):
    rows = df.collect()
    assert len(rows) == docs_count
    return rows


def operators(labels, benchmark):
    return {
        "quality": quality.clean, "secrets": secrets.scan, "pii": lambda d: pii.protect(d, with_text=True),
        "licenses": lambda d: licenses.scan(d.withColumn("path", F.lit("a/b")) if "path" not in d.columns else d),
        "decontamination": lambda d: decontaminate.decontaminate(d, benchmark), "simhash": simhash.near_duplicates,
        "toxicity": lambda d: toxicity.score_documents(d, labels), "sharding": sharding.shuffle_into_shards,
        "html": lambda d: html_extract.extract(d, "doc_id", "lang", "text"), "packing": packing.pack,
    }


NAMES = ["quality", "secrets", "pii", "licenses", "decontamination", "simhash", "toxicity", "sharding", "html", "packing"]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows_give_one_result_each(name, docs, labels, benchmark):
    rows = operators(labels, benchmark)[name](docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    if name == "packing":
        n = [r for r in rows if r["start"] == 0]
        assert len(n) == len(ROWS)  # every row begins once
        assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 1  # a null text is its end id
    else:
        assert len(rows) == len(ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table_gives_no_rows(name, none, labels, benchmark):
    assert operators(labels, benchmark)[name](none.withColumn("lang", F.lit("x"))).count() == 0


def test_empty_helper_tables(docs, spark):
    no_items = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in decontaminate.decontaminate(docs, no_items).collect()} == {0}
    no_labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["score"] for r in toxicity.score_documents(docs, no_labels).collect()} == {0.0}


def test_defined_results(docs, benchmark):
    got = {(r["doc_id"], r["n_words"]): r for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert got[1, 7]["n_hit"] == 5 and got[1, 7]["items"] == ["1"]
    assert got[2, 0]["items"] == [] and any(k[0] == 5 and r["items"] == ["null"] for k, r in got.items())
    sim = simhash.near_duplicates(docs).collect()
    assert {r["component_id"] for r in sim if r["doc_id"] in (1, 7)} == {1}
    assert {(r["fp"], r["component_id"]) for r in sim if r["doc_id"] in (2, 3, 4)} == {(0, 2)}  # wordless texts are alike
    q = {r["doc_id"]: r for r in quality.clean(docs).collect()}
    assert q[2]["n_words"] == 0 and q[2]["base_failed"] and not q[2]["kept"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_rows_and_empty_tables(name, stage, spark, docs, none, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = [F.lit("en").alias("lang"), F.lit("s").alias("source")]
    full = docs.select("*", *columns, F.lit(3).cast("bigint").alias("n_chars"))
    out = stage(spark, full, str(tmp_path))
    rows = out.collect()
    empty = stage(spark, none.select("*", *columns, F.lit(3).cast("bigint").alias("n_chars")), str(tmp_path))
    assert empty.count() == 0
    if name != "packing":
        assert out.columns == full.columns
    if name == "near_duplicates":
        at = full.columns.index("doc_id")
        assert sorted(str(r[at]) for r in rows) == ["1", "2", "5", "6", "None"]
    if name == "secrets":
        assert len(rows) == len(ROWS)
