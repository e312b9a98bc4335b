"""The mix reaches the texts by a shuffle at any size, so its disk grows with the input."""

from caseflow.llm import mixing


def test_no_table_of_rows_is_broadcast(spark, capsys):
    docs = spark.createDataFrame([(i, f"a b c {i}", f"s{i % 3}") for i in range(60)],
                                 "doc_id bigint, text string, source string")
    out = mixing.apply_mix(docs)
    out.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
