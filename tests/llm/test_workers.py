"""What workers keep between tasks."""

import os

import pyarrow as pa

from tallyloom.llm import ordered_minhash as om
from tallyloom.llm import packing, suffixes, toxicity

TEXTS = ["one two three four five six", "", "seven eight nine ten eleven twelve"]


def batch():
    return pa.RecordBatch.from_arrays([pa.array([0, 1, 2]), pa.array([0, 1, 2]), pa.array(TEXTS)], names=["row_id", "doc_id", "text"])


def test_a_task_drops_what_other_operators_keep():
    packing.library_encoder(None).packed(TEXTS)
    sketches = list(om._sketched([batch()]))
    assert packing.library_encoder.cache_info().currsize == 0
    assert len(om._hashes) == 12
    assert [s.to_pylist() for s in om._sketched([batch()])] == [s.to_pylist() for s in sketches]
    assert len(om._hashes) == 12  # its own stays
    list(toxicity._features([pa.RecordBatch.from_arrays([pa.array(TEXTS), pa.array([0, 1, 0], pa.int32())], names=["text", "toxic"])]))
    assert not om._hashes
    assert [s.to_pylist() for s in om._sketched([batch()])] == [s.to_pylist() for s in sketches]


def test_no_worker_keeps_stores_of_two_operators(spark):
    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([len(om._hashes)]), pa.array([packing.library_encoder.cache_info().currsize])], names=["pid", "hashes", "encoders"])

    docs = spark.createDataFrame([(i, TEXTS[i % 3]) for i in range(64)], "doc_id long, text string").repartition(16)
    rows = docs.selectExpr("doc_id row_id", "doc_id", "text")
    kept = lambda: {r.pid: (r.hashes, r.encoders) for r in docs.mapInArrow(held, "pid long, hashes long, encoders long").collect()}.values()
    rows.mapInArrow(om._sketched, om.SKETCH).collect()
    expected = packing.token_pieces(docs).collect()
    assert any(encoders for _, encoders in kept())
    assert not [x for x in kept() if all(x)]
    assert suffixes.repeated_spans(docs).count() == 64
    assert not [x for x in kept() if all(x)]
    assert sorted(packing.token_pieces(docs).collect()) == sorted(expected)
