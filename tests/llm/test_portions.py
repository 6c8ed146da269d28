"""Long lists of keys are looked up in portions, texts become strings in portions."""

import pyarrow as pa

from playmart.llm import parity_join
from playmart.llm.common import importable, text_slices


def test_postings_are_the_same_in_portions(spark, monkeypatch):
    importable(spark)
    text = " ".join(f"w{i}" for i in range(300))
    docs = spark.createDataFrame([(i, f"{text} {i}" if i % 5 else "") for i in range(12)], "doc_id long, text string")
    sketched = parity_join.sketches(docs, 4, 85)
    whole = sorted(map(tuple, parity_join.shared_postings(sketched).collect()))
    monkeypatch.setattr(parity_join, "SLICE_KEYS", 100)
    assert whole and sorted(map(tuple, parity_join.shared_postings(sketched).collect())) == whole


def test_texts_come_in_portions():
    texts = ["aa", None, "äö", "", "x" * 50, "b"]
    got = list(text_slices(pa.array(["skipped", *texts], pa.string()).slice(1), 6))
    assert [a for a, _ in got] == [0, 4, 5]
    assert [t for _, some in got for t in some] == [t or "" for t in texts]
    assert not list(text_slices(pa.array([], pa.string()), 6))
