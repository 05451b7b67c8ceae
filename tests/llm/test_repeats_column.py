from __future__ import annotations

from listenlake.llm import suffix_dedup


def test_the_decision_column_follows_the_400_byte_rule(spark, tmp_path):
    passage = "".join(f"{i:04d}" for i in range(100))
    rows = [(1, "a" + passage), (2, "b" + passage), (3, "c" + passage[:-1]), (4, "short"), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["n_removed"], r["has_repeats"]) for r in suffix_dedup.op1_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (400, True), 2: (400, True), 3: (0, False), 4: (0, False), 5: (0, False)}
