"""Near-dedup compares a class of a large group to one pivot first."""

from caseflow.llm import near_dedup


def test_first_round_has_one_pair_a_class(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join(words[:5 * i] + [f"x{i}"] + words[5 * i + 1:])) for i in range(25)],
                                 "doc_id bigint, text string")
    seen = []
    old = near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *a: seen.append(pairs.count()) or old(pairs, *a))
    got = near_dedup.link_components(docs).collect()
    assert {r.component_id for r in got} == {0}
    assert 0 < seen[0] <= 25
