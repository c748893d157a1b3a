import pyarrow as pa

from quire.plans import fixtures as fx


def test_labels_are_numbered_without_an_expression_for_each_character(spark, tmp_path, monkeypatch):
    texts = ["abcdef", "", None, "é\U0001f600\x00x", "z"]
    want = {}
    for i, t in enumerate(texts):
        true = None if t is None else [ord(c) for c in t if c != "\x00"]
        want[i] = true, None if true is None else [c if k % 3 == 0 else (true[1:] + [0])[k] for k, c in enumerate(true)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = fx.predictions(spark, str(tmp_path))
    assert {r.doc_id: (r.y_true, r.y_pred) for r in rows.collect()} == want
    assert dict(rows.dtypes) == {"rank": "int", "batch_id": "int", "doc_id": "bigint", "y_pred": "array<int>", "y_true": "array<int>", "loss": "decimal(12,1)"} \
        or dict(rows.dtypes)["loss"] == "double"
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "split(" not in plan
    monkeypatch.setattr(fx, "SLICE_BYTES", 4)
    parts = list(fx._labels(iter([pa.array(texts)])))
    assert len(parts) > 2 and [x for p in parts for x in p.field("y_true").to_pylist()] == [want[i][0] for i in range(5)]
