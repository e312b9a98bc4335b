"""Source divergence against a plain count over small tables."""

import random
import re
from collections import Counter, defaultdict

import pytest

from caseflow.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, counts int, value double"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs, top):
    docs = [(t or "", g or "", s or "") for _, t, g, s, *_ in rows]
    lower = {c: c + 32 for c in range(65, 91)}
    found = [(g, s, Counter(TERM.findall(t.translate(lower)))) for t, g, s in docs]
    out = set()
    for g in {x[0] for x in found}:
        seen, total = Counter(), defaultdict(Counter)
        for lang, s, c in found:
            if lang == g:
                seen.update(set(c))
                total[s].update(c)
        kept = [t for t, n in seen.items() if n >= min_docs]

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in total.items()}
        q = shares(sum(total.values(), Counter()))
        for s in total:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in total if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if total[s][t] and p[s][t] > q[t]]
            for part, some, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, _, item) in enumerate(sorted(some)[:most], 1):
                    out.add((g, s, part, item, -value, rank))
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = ["".join(r.choice("abéßЖ") for _ in range(r.randint(1, 3))) for _ in range(60)] + ["Zürich", "ZÜRICH", "𝒳y"]
    out = [(0, None, None, None), (1, "", "", ""), (1, "dup dup", "en", "a"), (1, "dup dup", "en", "a"),
           (None, "one\x00two three_4five", "en", "b"), (7, "x", "alone", "z"), (8, None, "alone", "y"),
           (9, "Q" * 3000 + " " + "long word " * 300_000, "en", "a"), (10, "  12 !?\x7f\x80", "en", None)]
    for i in range(300):
        lang = r.choice(["en", "en", "de", None])
        source = r.choice(["a", "a", "a", "b", "ç", "Z", None])
        out.append((20 + i, " ".join(r.choice(words) for _ in range(r.randint(0, 40))), lang, source))
    return [(*x, "x", 1, 0.5) for x in out]


@pytest.mark.parametrize("held,dense", [(divergence.HELD, divergence.DENSE), (50, 40)])
def test_against_plain_counts(spark, rows, held, dense, monkeypatch):
    monkeypatch.setattr(divergence.fold, "__defaults__", (held,))
    monkeypatch.setattr(divergence, "AT_ONCE", held // 10)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = divergence.divergences(docs, min_docs=4, top=7, dense=dense)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(x) for x in got.collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, 4, 7)


def test_no_kept_terms_and_no_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(x) for x in divergence.divergences(docs, min_docs=10_000).collect()]
    assert set(got) == plain(rows, 10_000, 50) and all(x[4] == 0 for x in got)
    assert divergence.divergences(docs.limit(0)).count() == 0


def test_shares_are_exact():
    import numpy as np
    r = random.Random(0)
    counts = [r.randint(0, 10**r.randint(1, 14)) for _ in range(2000)]
    totals = [c + r.randint(1, 10**14) for c in counts]
    got = divergence.scaled(np.array(counts), np.array(totals)).tolist()
    assert got == [1 + 10**9 * c // n for c, n in zip(counts, totals, strict=True)]


def test_pieces_of_a_text_cut_no_term():
    text = ("é" * 999 + " ").encode() * 2000
    got = [t for terms in divergence.terms_of(text) for t in terms]
    assert len(got) == 2000 and set(got) == {("é" * 999).encode()}
