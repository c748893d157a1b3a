import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if v is None or v != v else round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for file in os.listdir(DATA):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    return db


@needs_data
@pytest.mark.parametrize("name", sorted(entry.SQL))
def test_query_equals_its_sql(spark, database, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    want = database.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


#: Queries on vocabularies of full size; see test_full_vocabulary.py.
WITHOUT_SQL = {"train_bpe_full", "vocab_report_full", "packed_blocks_full", "compare_tokenizers_full"}


def test_all_other_queries_have_sql():
    assert set(entry.QUERIES) - set(entry.SQL) == WITHOUT_SQL


@needs_data
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
