"""The registered queries: against SQL where there is some, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from basketlens.llm import queries
from tests.compare import difference, open_sql

FOLDER = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{n}" for n in range(1, 14)]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert queries.SQL.keys() <= queries.QUERIES.keys()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    want = open_sql(FOLDER).execute(queries.SQL[name]).df()
    found = queries.QUERIES[name](spark, FOLDER).toPandas()
    if "refers_to" in want:
        found["refers_to"], want["refers_to"] = found["refers_to"].astype("float64"), want["refers_to"].astype("float64")
    assert difference(found, want) is None


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(number)))
        last, docs = docs, spark.read.parquet(str(tmp_path / str(number)))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == last.count()
    assert docs.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
