"""The operators against brute force on small tables with nulls, empty and
long texts, ties, repeated rows, clashing extra columns, and no rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from caseflow.llm import (exact_dedup, fingerprint, line_templates, mixing, near_dedup, pieces,
                          quality, suffix_dedup, token_files, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, h int"
rng = random.Random(3)
VOCAB = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(150)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def texts():
    base, passage = prose(120, 1), prose(20, 2)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    out = [None, "", " ", "short one", base, base, base.upper(), near, prose(90, 3) + " " + passage,
           passage + "\n" + prose(80, 4), "A\tB\n\n  c  ▁d é😀 \x00 <s>", "Ther " * 60, "Ther " * 40,
           "a" * 300, prose(3000, 5), "don't  stop　now ok <|endoftext|> x"]
    return out + [prose(rng.randint(1, 60), 10 + i) for i in range(20)]


@pytest.fixture(scope="module")
def rows():
    return [(i, t, "en", [None, "a", "b", "c"][i % 4], len(t or ""), "x", 1)
            for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_pieces(docs, none, rows):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    got = {r[0]: tuple(r)[1:] for r in pieces.encode_digests(docs).collect()}
    for i, t, *_ in rows:
        ids = sp.encode(t or "")
        assert got[i] == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))
    enc = pieces.encode(docs)
    back = {r[0]: r[1] for r in pieces.decode(enc).collect()}
    assert all(back[i] == sp.decode(sp.encode(t or "")) for i, t, *_ in rows)
    assert pieces.encode_digests(none).count() == 0


def test_backtracking_is_merging():
    c = pieces.codec(public_tokenizers.path(pieces.MODEL)).pieces
    r = random.Random(0)
    for _ in range(300):
        s = pieces.SPACE + "".join(r.choice("theraniosé") for _ in range(r.randint(1, 14)))
        assert c.backtracked(s) == c.merged(s)


def test_token_files(spark, docs, none, rows, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    path = str(tmp_path / "t")
    token_files.write_tokens(docs, path)
    got = {r[0]: tuple(r)[1:] for r in
           token_files.with_checksums(token_files.read_tokens(spark, path)).collect()}
    at = 0
    for i, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [token_files.END_ID]
        assert got[i] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r[0] for r in token_files.read_documents(spark, path, 3, 5).collect()} == {3, 4, 5}
    token_files.write_tokens(none, str(tmp_path / "e"))
    assert token_files.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_special_tokens_in_all_places():
    import pyarrow as pa
    from tokenizers import Tokenizer
    file = public_tokenizers.path(token_files.TOKENIZER)
    tok, enc = Tokenizer.from_file(file), token_files.TextEncoder(file)
    s, r = "<|endoftext|>", random.Random(7)
    texts = [s, s + s, f" {s} ", f"a {s} b", f"a  {s}  b", f"a\n {s}\n\n b", f"x{s}y {s}", f"{s} x", f"x {s}", f" {s}x",
             f"a   {s}", f"{s}   a", f"a \t {s}", "<|endof text|> <|endoftext", f"word {s}'s don't"]
    texts += ["".join(r.choice(["ab", " ", "  ", s, "\n", "c.", "\u3000", "é"]) for _ in range(r.randint(1, 14)))
              for _ in range(400)]
    for batch in (texts, texts[::-1], [""]):
        got = enc.encode(pa.array(batch), 2).to_pylist()
        assert got == [tok.encode(t, add_special_tokens=False).ids + [2] for t in batch]


def shingles(t, low=True):
    if low:
        t = t.translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*[w[k:] for k in range(5)], strict=False))


def test_fingerprints(spark, docs, rows, none, monkeypatch):
    monkeypatch.setattr(fingerprint, "documents", lambda s, d: docs)
    got = {r["doc_id"]: r for r in fingerprint.op3_fingerprints(spark, "").collect()}
    for k, (i, t, *_) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), sha(edited))
        for near, other in ((r["near_edited"], edited), (r["near_next"], nxt)):
            a, b = shingles(t, False), shingles(other, False)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - true) < 0.25 and 0 <= near <= 1
            assert near == 1.0 or a != b
    assert got[4]["fingerprint"] == got[5]["fingerprint"]
    monkeypatch.setattr(fingerprint, "documents", lambda s, d: none)
    assert fingerprint.op3_fingerprints(spark, "").count() == 0


def components(rows):
    sets = {i: shingles(t or "") for i, t, *_ in rows}
    par = {i: i for i in sets}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                par[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in sets}


def test_near_dedup(spark, docs, rows, none):
    words = prose(100, 77).split()
    r = random.Random(5)
    more = []
    for i in range(100, 160):  # a group of copies with edits of their own
        w = list(words)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(100)] = f"e{r.randrange(10**6)}"
        more.append((i, " ".join(w), "", "a", 0, "", 0))
    every = rows + more
    sets, comp = components(every)
    got = near_dedup.link_components(spark.createDataFrame(every, SCHEMA).repartition(4)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {
        i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}
    kept = near_dedup.keep_rows(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.collect()} == {i for i, *_ in rows if comp[i] == i}
    assert near_dedup.link_components(none).count() == 0


def test_near_dedup_of_an_id_with_several_texts(spark):
    one, other = prose(300, 8), prose(300, 9)
    rows = [(1, one), (1, other), (1, other), (2, one + " end"), (3, other + " end"), (4, prose(300, 10)),
            (None, one), (5, ""), (0, other + " end too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.link_components(docs).collect()}
    assert got == {(0, 0, True), (1, 0, False), (2, 0, False), (3, 0, False), (4, 4, True), (5, 5, True),
                   (None, None, True)}


def test_quality_rejects_by_columns_as_by_scores(spark):
    r = random.Random(2)
    rows, marks = [], []
    for i in range(200):
        good = i % 3 > 0
        text = prose(r.randint(5, 80), i) + "." if good else " ".join(r.choice(["$$$", "AA1", "!!"]) for _ in range(30))
        rows.append((i, None if i == 7 else text, 1.5))
        marks.append((i, int(good)))
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, x double").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    for some in (labels, labels.filter("quality = 1"), labels.filter("quality = 0"), labels.limit(0)):
        want = [row["doc_id"] for row in quality.score(docs, some).collect() if row["predicted"] == 1]
        kept = quality.keep_rows(docs, some)
        assert kept.columns == docs.columns
        assert sorted(row["doc_id"] for row in kept.collect()) == sorted(want)


def test_mixing(spark, docs, rows, none):
    big = [(i, prose(1 + i % 40, i), "", "s" + str(i % 7) if i % 3 else "s0", 0, "", 0)
           for i in range(600)]
    for case in (rows, big):
        got = mixing.mix(spark.createDataFrame(case, SCHEMA)).collect()
        assert len(got) == len(case)
        size = collections.Counter()
        for r in got:
            size[r["source"]] += r["size"]
        names = sorted((s for s in size if s is not None), key=lambda s: s.encode())
        names += [None] * (None in size)
        weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
        want, free, left = {}, set(names), float(sum(size.values()))
        while free:  # share again until no source is above its cap
            level = left / sum(weight[s] for s in free)
            over = {s for s in free if level * weight[s] > 3 * size[s]}
            if not over:
                want |= {s: level * weight[s] for s in free}
                break
            want |= {s: 3.0 * size[s] for s in over}
            left -= sum(3 * size[s] for s in over)
            free -= over
        taken = collections.Counter()
        for r in got:
            assert r["taken"] <= 3 * r["size"] and r["source_size"] == size[r["source"]]
            assert r["target"] == pytest.approx(want[r["source"]])
            taken[r["source"]] += r["taken"]
        for s in names:
            assert abs(taken[s] - want[s]) <= 3 * mixing.BLOCK_WORDS
    one = mixing.mix(docs).collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in
                mixing.apply_mix(docs).collect())
    assert words == sum(r["taken"] for r in one)
    assert mixing.mix(none).count() == 0


def test_seats_go_by_highest_quotients(spark):
    votes = [53, 24, 23, 0, 1000, 7]
    df = spark.createDataFrame([(0, i, v, 10**6, 111) for i, v in enumerate(votes)],
                               "g int, i int, v long, most long, seats long")
    got = {r["i"]: r["won"] for r in mixing.apportion(df, ["g"], "v", "most", "seats", F.col("i"),
                                                       "won").collect()}
    want = collections.Counter()
    for _ in range(111):
        want[max(range(6), key=lambda i: (votes[i] / (2 * want[i] + 1), -i))] += 1
    assert got == {i: want[i] for i in range(6)}


def test_exact_dedup(spark, docs, rows, none):
    verdict, _ = exact_dedup.add_batch(docs, exact_dedup.new_index(spark))
    same = collections.defaultdict(list)
    for i, t, *_ in rows:
        same[t or ""].append(i)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["digest"]) for r in verdict.collect()}
    assert got == {i: (max(same[t or ""]), len(same[t or ""]), sha(t or "")) for i, t, *_ in rows}
    index = exact_dedup.new_index(spark)
    twice = docs.union(docs)
    kept = exact_dedup.keep_rows(twice, index)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == sorted(max(v) for v in same.values())
    again = exact_dedup.DigestIndex(spark, index.path, index.buckets)  # as another session would
    fresh = spark.createDataFrame([(99, "new text", "", "", 0, "", 0)], SCHEMA)
    assert [r[0] for r in exact_dedup.keep_rows(docs.union(fresh), again).collect()] == [99]
    assert exact_dedup.keep_rows(none, exact_dedup.new_index(spark)).count() == 0
    # a job that is lost after the append and run again
    index = exact_dedup.new_index(spark)
    for _ in range(2):
        kept = exact_dedup.keep_rows(docs, index, "monday")
        assert sorted(r[0] for r in kept.collect()) == sorted(max(v) for v in same.values())
    assert exact_dedup.keep_rows(docs, index, "tuesday").count() == 0
    assert index.entries().count() == len(same)


def test_line_templates(spark, none):
    rows = [(i, f"{prose(8, i)}\nPage {i} of {i + 3} for the user\n\n{prose(9, 50 + i)}", "", "", 0, "", 0)
            for i in range(12)] + [(50, None, "", "", 0, "", 0), (51, "Page of rest", "", "", 0, "", 0)]
    got = {r["doc_id"]: r for r in line_templates.drop_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(12):
        assert (got[i]["n_lines"], got[i]["n_dropped"]) == (4, 1) and "Page" not in got[i]["text"]
    assert (got[50]["text"], got[50]["n_dropped"], got[51]["n_dropped"]) == ("", 0, 0)
    assert line_templates.drop_lines(none).count() == 0


def test_suffix_dedup(spark, docs, rows, none):
    got = {r["doc_id"]: tuple(r)[1:] for r in
           suffix_dedup.digests(suffix_dedup.remove_repeats(docs)).collect()}
    seen = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if seen.setdefault(b[s:s + 50], i) < i:
                gone[s:s + 50] = b"\1" * 50
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        assert got[i] == (len(b), sum(gone), spans, sha(left)), i
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_sort_is_lexicographic():
    r = np.random.default_rng(0)
    ctx = r.integers(97, 99, (40, suffix_dedup.CONTEXT), dtype=np.uint8)
    ctx[20:] = ctx[:20]
    s = suffix_dedup.Suffixes(ctx)
    row, at = np.arange(40), np.zeros(40, np.int64)
    order = s.sort(row, at, np.zeros(40, np.int64))
    keys = [ctx[k, :50].tobytes() for k in order]
    assert keys == sorted(keys)


def labelled(spark, column, make):
    rows = [(i, make(i, i % 3 == 0), "", "", 0, "", 0) for i in range(400)] + [(900, None, "", "", 0, "", 0)]
    marks = [(i, int(i % 3 == 0)) for i in range(400)] + [(900, None)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, f"doc_id long, {column} int")


@pytest.mark.parametrize("op,column,folds,fold", [(quality, "quality", 3, 1), (toxicity, "toxic", 5, 0)])
def test_classifiers(spark, none, op, column, folds, fold):
    def make(i, one):
        if op is quality:
            return prose(40, i) + "." if one else " ".join(w + "&&&" for w in prose(40, i).split())
        return prose(20, i) + (" nasty " if one else " ") + prose(20, 1000 + i)

    docs, marks = labelled(spark, column, make)
    got = op.score(docs, marks).collect()
    assert len(got) == 401
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held) >= 0.95 * len(held)
    assert {r["score"] for r in op.score(docs, marks.limit(0)).collect()} == {0.5}
    assert op.score(none, marks).count() == 0


def test_line_templates_of_one_leaf(spark):
    def docs_of(lines):
        rows = [(i, line, "", "", 0, "", 0) for i, line in enumerate(lines)]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    def dropped(lines):
        got = line_templates.drop_lines(docs_of(lines)).collect()
        return {r["doc_id"] for r in got if r["n_dropped"]}

    head = "one two three four "
    tails = [prose(8, 200 + k) for k in range(3)]
    # two recurring lines, and a third that one document repeats
    lines = [head + tails[0]] * 30 + [head + tails[1]] * 20 + ["\n".join([head + tails[2]] * 200)]
    assert dropped(lines) == set(range(50))
    # the same with a varied word
    lines = [head + tails[i % 3] + f" x{i}" for i in range(42)]
    assert dropped(lines) == set(range(42))
    # one document with many lines has one vote
    lines = [head + tails[0] + f" x{i}" for i in range(12)]
    lines += ["\n".join(head + tails[1] + f" y{i}" for i in range(60))]
    assert dropped(lines) == set(range(12))
    # a leaf of varied tails is no template
    lines = [head + " ".join(f"w{i}v{k}" for k in range(8)) for i in range(30)]
    assert dropped(lines) == set()


def test_lines_of_two_documents_recur(spark):
    said = prose(12, 300)
    rows = [(0, said + "\n" + prose(9, 301)), (1, prose(9, 302) + "\n" + said), (2, "seen once " + prose(9, 303)),
            (3, "\n".join(["seen twice in one document"] * 2))]
    rows += [(10 + i, f"At {i} the server {i + 5} was restarted by its owner") for i in range(3)]
    rows += [(20 + i, f"On day {i} nobody {i + 5} came to the old house") for i in range(2)]
    docs = spark.createDataFrame([(*r, "", "", 0, "", 0) for r in rows], SCHEMA)
    got = {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_lines(docs).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0, 10: 1, 11: 1, 12: 1, 20: 0, 21: 0}
