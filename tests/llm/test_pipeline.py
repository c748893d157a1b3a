import os

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from quire.llm import queries

from .plain import components, contamination, without_repeats

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if v is None or v is pd.NA or v != v else round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None)), key=repr)


@needs_data
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(DATA):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), db.execute(queries.SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@needs_data
def test_each_stage_acts_on_what_the_one_before_it_kept(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality rules"](spark, docs, DATA)
    good_rows = {r.doc_id: r.text for r in good.collect()}
    assert good.columns == columns and 0 < len(good_rows) < docs.count()

    single = steps["near duplicates"](spark, good, DATA)
    least = components(list(good_rows.items()), 5)
    single_rows = {r.doc_id: r.text for r in single.collect()}
    assert single.columns == columns and set(single_rows) == {i for i in good_rows if least[i] == i}

    cut = steps["substrings"](spark, single, DATA)
    want = {i: (" ".join(k) if len(k) < len(w) else single_rows[i]) for i, w, k in without_repeats(list(single_rows.items()))}
    cut_rows = {r.doc_id: r.text for r in cut.collect()}
    assert cut.columns == columns and cut_rows == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = steps["decontamination"](spark, cut, DATA)
    clean_rows = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns and clean_rows == {i for i, t in cut_rows.items() if not contamination(t, items)[1]}

    mix = steps["mixing"](spark, clean, DATA)
    assert mix.columns[: len(columns)] == columns and {r.doc_id for r in mix.collect()} <= clean_rows
    assert sorted(map(repr, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(repr, mix.collect()))


def test_clashing_columns_get_names_of_their_own(spark, odd, tmp_path):
    spark.createDataFrame([(1, "zz top")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = odd
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, str(tmp_path))
        assert out.columns[: len(odd.columns)] == odd.columns
    assert len(set(out.columns)) == len(out.columns)
    out.collect()
