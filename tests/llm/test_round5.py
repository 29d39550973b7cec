"""What the driver holds must not grow with the rows."""

import collections
import re

import pytest

from sequor.llm import mixing


@pytest.fixture(scope="module")
def word_docs(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40 + i % 60)), "abc"[i % 3] if i % 7 else None) for i in range(200)]
    return spark.createDataFrame([*rows, rows[5], (None, "no id " * 9, "a"), (300, None, "a")], "doc_id long, text string, source string").repartition(4)


@pytest.mark.parametrize("made", [mixing.taken, mixing.mix, mixing.mixed])
def test_mixing_does_not_broadcast_a_row_per_slot(spark, word_docs, made):
    """Blocks of one word: over 20000 slots, from counts of a few dozen rows."""
    out = made(word_docs, block_words=1)
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w+) \[sk#\d+, block#\d+L\], \[sk#\d+, block#\d+L\]", plan)
    assert joins and set(joins) == {"SortMergeJoin"}
    words = collections.Counter()
    for r in word_docs.collect():
        words[r["source"]] += len((r["text"] or "").split())
    targets = {r["source_size"]: r["target"] for r in mixing.taken(word_docs, block_words=1).select("source_size", "target").distinct().collect()}
    drawn = sum(r["taken"] if made is mixing.taken else len(r["text"].split()) for r in rows)
    assert set(targets) == set(words.values()) and drawn > 20000 and abs(drawn - sum(targets.values())) <= len(targets)
