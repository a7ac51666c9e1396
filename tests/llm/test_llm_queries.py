"""The queries of the operators against SQL, and the pipeline against its stages' rules."""

from pathlib import Path

import duckdb
import pytest
from conftest import TABLES
from test_queries import as_text

import corpus_pipeline
from trackmill.llm import decontaminate, mixing, near_dedup, outliers, pii
from trackmill.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    found = QUERIES[name](spark, TABLES).toPandas()
    if name in SQL:
        assert as_text(found) == as_text(database.execute(SQL[name]).df())
    else:
        assert len(found) > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    kept = {r.doc_id for r in outliers.verdicts(docs).collect() if r.kept}
    first = corpus_pipeline.quality_rules(spark, docs, TABLES)
    assert ids(first) == kept and first.columns == docs.columns
    second = corpus_pipeline.near_duplicates(spark, first, TABLES)
    assert ids(second) == {r.doc_id for r in near_dedup.near_duplicates(first).collect() if r.kept}
    third = corpus_pipeline.decontamination(spark, second, TABLES)
    bench = spark.read.parquet(f"{TABLES}/benchmark.parquet")
    assert ids(third) == {r.doc_id for r in decontaminate.contamination(second, bench).collect() if not r.contaminated}
    fourth = corpus_pipeline.personal_data(spark, third, TABLES)
    assert sorted(map(tuple, fourth.collect())) == sorted(map(tuple, pii.with_surrogates(third).collect()))
    copies = {r.doc_id: r.copies for r in mixing.mix(fourth).collect() if r.copies}
    last = [r.doc_id for r in corpus_pipeline.run(spark, TABLES).collect()]
    assert {i: last.count(i) for i in set(last)} == copies
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-dedup", "decontamination", "personal data", "source mix"]
