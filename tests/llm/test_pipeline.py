import importlib

import corpus_pipeline as P

from sluice.llm.common import table


def test_stages_in_order(spark, small):
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    docs = table(spark, small, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in P.STAGES[:-1]:
        docs = P.materialise(stage(spark, docs, small), "step")
        assert docs.columns == columns, name
        after = docs.count()
        assert 0 < after <= before, name
        before = after
    packed = P.STAGES[-1][1](spark, docs, small)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run_takes_effect(spark, small):
    out = P.run(spark, small)
    assert out.select("doc_id").distinct().count() < table(spark, small, "documents").count()
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    found = entry.queries()
    assert "pipeline" in found and sum(n.startswith("op") for n in found) == 13
    assert set(entry.oracle_sql()) <= set(found)
