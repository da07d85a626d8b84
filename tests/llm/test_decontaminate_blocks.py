"""Blocks of op8's patterns hold each benchmark row once."""

from __future__ import annotations

from triage.llm import decontaminate


def test_repeated_benchmark_rows_share_no_block(spark, monkeypatch):
    items = [(k, " ".join(f"w{k}x{i}" for i in range(20))) for k in range(12)]
    bench = spark.createDataFrame(items + items[:1] * 300, "item_id long, text string")
    docs = spark.createDataFrame([(k, t) for k, t in items], "doc_id long, text string")
    blocks, build = [], decontaminate.pattern_groups
    monkeypatch.setattr(decontaminate, "pattern_groups", lambda part, window: (blocks.append(part), build(part, window))[1])
    got = decontaminate.find_passages(docs, bench, block_words=600).collect()
    assert {r.doc_id: r.decon_items for r in got} == {k: [str(k)] for k, _ in items}
    assert sorted(x for b in blocks for x in b) == sorted((str(k), t) for k, t in items)
