"""The pipeline's stages, each against plain Python on its own input."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_near_duplicates import groups, shingles
from triage.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output, as lists of rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).union(docs.limit(1)).union(spark.createDataFrame([(None, None, None, None, None)], docs.schema))
    docs, out = docs.union(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != "token_orc":
            assert after.columns == docs.columns
        rows = after.collect()
        out[name] = (docs.collect(), rows)
        docs = spark.createDataFrame(rows, after.schema)
    return out


def test_toxicity_keeps_clean_documents(spark, stages):
    before, after = stages["toxicity"]
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    kept = {r.doc_id for r in after}
    assert len(toxic & {r.doc_id for r in before} - kept) <= 2 and len(after) < len(before)


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    ids = sorted({r.doc_id: shingles(r.text) for r in before if r.doc_id is not None}.items())
    least = groups([x for _, x in ids])  # 5 words, 0.8 or more; here rows that share an id share their text
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted({ids[i][0] for i in least})
    assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before)


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, x in brute.contamination([(r.doc_id, r.text) for r in before], items).items() if x[4]}
    assert sorted(map(str, (r.doc_id for r in after))) == sorted(str(r.doc_id) for r in before if r.doc_id not in bad)


def test_mix_repeats_documents(stages):
    before, after = stages["mixing"]
    known = {(r.doc_id, r.text) for r in before}
    count = {}
    for r in after:
        assert (r.doc_id, r.text) in known
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert max(count.values()) <= 2
    size = lambda rows: sum(len(brute.WORD.findall(r.text or "")) for r in rows)
    assert size(after) == pytest.approx(1.5 * size(before), rel=0.02)


def test_tokens(stages):
    before, after = stages["token_orc"]
    want = brute.tokens([(r.doc_id, r.text) for r in before], tokenizer_path())
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, after), key=key) == sorted(want, key=key)


def test_columns_that_clash_with_any_stage(spark):
    """Further columns keep their values, whatever their names are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["_y", "_row", "_set", "_lid", "_turn", "_copies", "_at", "_mid", "_round", "decon_items", "decon_n_words", "toxic_score", "size", "taken",
             "component_id", "n_shingles", "key", "point", "region"]
    wide = docs.selectExpr("*", *(f"concat('{n}', doc_id) AS `{n}`" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, wide, SF)
        assert after.columns == wide.columns
        rows = after.collect()
        assert len(rows) > 100 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), name


def test_every_stage_takes_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_entry_lists_the_queries():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
