"""The pipeline against the operators' own verdicts, stage by stage."""

import os

import pytest

import corpus_pipeline
from caseflow.llm import mixing, near_dedup, pieces, quality
from caseflow.llm.common import labels, stored

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_stages(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    want = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows
        rows = stored(stage(spark, before, SF), "test_stage")
        old = {r["doc_id"]: r for r in before.collect()}
        new = rows.collect()
        if k < 4:
            assert rows.columns == before.columns, name
        if k == 0:
            scores = quality.score(before, labels(spark, SF)).collect()
            want = {r["doc_id"] for r in scores if r["predicted"] == 1}
            assert {r["doc_id"] for r in new} == want
        elif k == 1:
            best = {}
            for r in old.values():
                best[r["text"]] = max(r["doc_id"], best.get(r["text"], -1))
            assert {r["doc_id"] for r in new} == set(best.values())
        elif k == 2:
            kept = near_dedup.link_components(before, corpus_pipeline.NEAR_PERCENT).filter("kept").collect()
            assert {r["doc_id"] for r in new} == {r["doc_id"] for r in kept}
        elif k == 3:
            taken = {r["doc_id"]: r["taken"] for r in mixing.mix(before).collect()}
            words = {}
            for r in new:
                assert r["text"] in old[r["doc_id"]]["text"]
                words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
            assert words == {i: n for i, n in taken.items() if n}
        else:
            assert sorted(map(tuple, new)) == sorted(map(tuple, pieces.encode_digests(before).collect()))


def test_near_copies_link_from_four_fifths_on(spark):
    def shingles(text):
        w = text.lower().split()
        return set(zip(*[w[k:] for k in range(5)], strict=False))

    rows = []
    for g in range(6):  # a text, and copies with g words changed far from each other
        words = [f"g{g}w{k}" for k in range(150)]
        rows.append((2 * g, " ".join(words)))
        for k in range(g):
            words[10 + 20 * k] = f"g{g}x{k}"
        rows.append((2 * g + 1, " ".join(words + [f"g{g}end"])))
    sets = {i: shingles(t) for i, t in rows}
    like = [len(sets[2 * g] & sets[2 * g + 1]) / len(sets[2 * g] | sets[2 * g + 1]) for g in range(6)]
    assert any(0.8 <= x < 0.85 for x in like) and min(like) < 0.8
    want = set(range(0, 12, 2)) | {2 * g + 1 for g in range(6) if like[g] < 0.8}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert {r["doc_id"] for r in got} == want
    assert near_dedup.matches(85) == 90 and near_dedup.matches(80) == 82
