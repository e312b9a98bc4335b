"""The last round of near-dedup: copies with edits of their own, and links by rare shingles."""

import random

import pytest

from caseflow.llm import near_dedup

BASE = [f"w{i}" for i in range(150)]


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def _want(texts, percent):
    sets = []
    for t in texts:
        w = t.split()
        sets.append(set(zip(*[w[k:] for k in range(5)], strict=False)))
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both * 100 >= percent * (len(sets[i]) + len(sets[j]) - both) and comp[i] != comp[j]:
                lo, hi = sorted((comp[i], comp[j]))
                comp = [lo if c == hi else c for c in comp]
    return dict(enumerate(comp))


def test_copies_with_own_edits_are_not_compared_to_each_other(spark, monkeypatch):
    rng = random.Random(3)
    texts = []
    for i in range(120):  # two words of its own, and one of 35 left out, as a few others do
        gone = rng.choice(range(5, 145, 4))
        own = rng.sample([k for k in range(5, 145) if abs(k - gone) > 5], 2)
        texts.append(" ".join(f"own{i}n{k}" if k in own else w for k, w in enumerate(BASE) if k != gone))
    seen = []
    old = near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *a: seen.append(pairs.count()) or old(pairs, *a))
    got = near_dedup.link_components(_docs(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == _want(texts, 85)
    assert seen[-1] <= 4 * len(texts)


@pytest.mark.parametrize("rare", [0, 1, 4, 64])
def test_components_do_not_depend_on_what_is_rare(spark, monkeypatch, rare):
    rng = random.Random(rare)
    texts = []
    for i in range(90):
        words = list(BASE)
        for k in range(rng.choice([1, 2, 3, 4])):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[], [f"own{i}n{k}"], [rng.choice("abc")], [words[at]] * 2])
        texts.append(" ".join(words))
    monkeypatch.setattr(near_dedup, "RARE", rare)
    monkeypatch.setattr(near_dedup, "PIVOT_ROUNDS", 1)
    got = near_dedup.link_components(_docs(spark, texts), 90).collect()
    want = _want(texts, 90)
    assert 1 < len(set(want.values())) < len(texts)
    assert {r.doc_id: r.component_id for r in got} == want
