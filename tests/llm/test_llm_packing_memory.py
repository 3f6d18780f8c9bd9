"""Texts are encoded a few megabytes at a time."""

import pyarrow as pa

from tallyspark.llm import packing


def test_parts_hold_all_rows_and_few_bytes():
    texts = ["a" * 10, None, "b" * 25, "", "c" * 100, "d", "é" * 10, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    parts = list(packing.parts_of(batch, 40))
    assert [p["text"].to_pylist() for p in parts] == [texts[:4], texts[4:5], texts[5:]]
    assert list(packing.parts_of(batch.slice(0, 0))) == []
