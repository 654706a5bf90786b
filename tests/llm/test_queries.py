"""The registered queries against their SQL, and the pipeline against its stages done by hand."""

import hashlib

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from checks.compare import difference
from sales_engine.llm import queries

NAMES = [n for n in queries.QUERIES if n not in queries.SQL]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    assert difference(driver.queries()[name](spark, sf_dir), duck, driver.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_each_document(spark, sf_dir, name):
    many = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    got = driver.queries()[name](spark, sf_dir)
    assert got.select("doc_id").distinct().count() == many
    assert name == "op4_tier_packing" or got.count() == many


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows.append((name, docs, after))
        docs = after
    for name, before, after in rows[:-1]:
        assert after.columns == before.columns, name
        assert 0 < after.count() <= before.count()
    _, before, after = rows[1]
    digests = {hashlib.sha256(r.text.encode().lower()).digest() for r in before.select("text").collect()}
    assert after.count() == len(digests)
    _, _, after = rows[3]
    assert all(r.n_chars == len(r.text) for r in after.select("text", "n_chars").collect())
    _, before, after = rows[4]
    assert after.select("doc_id").distinct().count() == before.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == after.count()
