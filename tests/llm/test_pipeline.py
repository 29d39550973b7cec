"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from sequor.llm.common import load, stored

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = load(spark, SF, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), f"test-{name.replace(' ', '-')}")
        assert docs.columns == load(spark, SF, "documents").columns
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] > 0.5 * counts[0] and counts[4] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() >= counts[4]


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
