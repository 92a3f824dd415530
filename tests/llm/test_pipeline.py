from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import corpus_pipeline
from candlespark.llm import kernel_classifier, staging
from tests.llm import cases


#: Names that stages give to columns of their own.
CLASHING = ["__doc_file", "__doc_row", "doc", "_copies", "_copy", "score", "predicted", "taken", "copies", "place", "component_id", "held_out", "label"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    rows = cases.corpus(seed=4)
    docs = spark.createDataFrame(rows, cases.DOCS)
    docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)]).coalesce(1).write.parquet(f"{at}/documents.parquet")
    marked = [(r[0], int("###" not in (r[1] or "") and "$$$" not in (r[1] or ""))) for r in rows if r[0] is not None]
    spark.createDataFrame(marked, "doc_id long, quality int").coalesce(1).write.parquet(f"{at}/labels.parquet")
    return str(at)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        at = f"{folder}/{name.replace(' ', '-')}"
        out.write.parquet(at)
        before, docs = docs, spark.read.parquet(at)
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    # quality: what stays is what the classifier accepts
    before, after = kept["quality classifier"]
    scores = kernel_classifier.quality_scores(before, spark.read.parquet(f"{folder}/labels.parquet"))
    assert after.count() == scores.filter("predicted = 1").count() < before.count()
    # exact: no text twice but for white space, none lost
    before, after = kept["exact dedup"]
    norm = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
    assert after.count() == after.select(norm).distinct().count() == before.select(norm).distinct().count() < before.count()
    # near: one of each component
    before, after = kept["n-gram Jaccard join"]
    rows = [(i, r.text) for i, r in enumerate(before.collect())]
    assert after.count() == len(set(cases.components(rows, 5, 80).values())) < before.count()
    # mix: whole copies, twice at most
    before, after = kept["mixing sources"]
    times = Counter(r.text for r in after.collect())
    assert max(times.values()) <= 2 and set(times) <= {r.text for r in before.collect()}
    before, after = kept["packing"]
    assert after.count() == before.count()


def test_run_is_its_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() == spark.read.parquet(f"{folder}/packing").count()


def test_every_stage_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], cases.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0, name
        assert name == "packing" or out.columns == docs.columns


def test_rows_of_nulls_alone_pass_every_stage(spark, tmp_path):
    nulls = spark.range(6).selectExpr("CAST(NULL AS LONG) AS doc_id", "CAST(NULL AS STRING) AS text", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "CAST(NULL AS LONG) AS n_chars")
    nulls.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, None), (None, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {name: stage(spark, docs, str(tmp_path)).count() for name, stage in corpus_pipeline.STAGES}
    assert left == {"quality classifier": 6, "exact dedup": 1, "n-gram Jaccard join": 6, "mixing sources": 0, "packing": 6}


@pytest.mark.parametrize("fails", [False, True])
def test_staged_bounds_the_bytes_of_a_batch(spark, fails):
    """Long rows come in small batches, one beyond the bound alone; the session's setting stays its own."""
    before = spark.conf.get(staging.ARROW_BATCH)

    def sizes(batches):
        for batch in batches:
            if fails:
                raise ValueError("on purpose")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    texts = spark.range(0, 300, numPartitions=1).selectExpr("repeat('x', if(id = 150, 100000, 1000)) text")
    if fails:
        with pytest.raises(PySparkException):
            staging.staged(texts.mapInArrow(sizes, "n long"), "test-batches", batch_bytes=10_000)
    else:
        found = [r.n for r in staging.staged(texts.mapInArrow(sizes, "n long"), "test-batches", batch_bytes=10_000).collect()]
        assert sum(found) == 300 and max(found) <= 11
    assert spark.conf.get(staging.ARROW_BATCH) == before
