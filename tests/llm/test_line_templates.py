"""Line templates against the same votes taken in plain Python."""

import hashlib
import os
import random
import re
from collections import defaultdict

import pytest
import xxhash

from caseflow.llm import line_templates as lt

SF = "/root/testdata/sf0.001/documents.parquet"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def order(tokens):
    """The hash by which a leaf's lines take their turns."""
    seed = 42
    for t in tokens:
        seed = xxhash.xxh64(t.encode(), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def equal(a, b):
    return sum(x == y for x, y in zip(a, b, strict=True))


def templates(found, seed, size):
    """The lists that a seed's neighbours vote for, by each of three votes."""
    near = [(doc, key, (1, equal(key, seed) >= size * lt.LIKE, is_open)) for key, doc, is_open in found
            if equal(key, seed) >= size * lt.FIXED or size <= lt.DEPTH]
    out = set()
    for v in range(3):
        voters = len({doc for doc, _, votes in near if votes[v]})
        template = []
        for at in range(size):
            by = defaultdict(set)
            for doc, key, votes in near:
                by[key[at]].update([doc] if votes[v] else [])
            n, token = max((len(d), t.encode()) for t, d in by.items())
            template.append(token.decode() if 2 * n >= voters else None)
        known = sum(t is not None for t in template)
        if known and (known >= size * lt.FIXED or size <= lt.DEPTH):
            out.add(tuple(template))
    return out


def plain(rows):
    """The rows' texts without the lines of recurring templates."""
    docs, leaf_of = defaultdict(set), {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = tuple(WORD.findall(line))
            if key:
                docs[key].add(doc)
                leaf_of[key] = (len(key), tuple("<*>" if re.search("[0-9]", t) else t for t in key[:lt.DEPTH]))
    gone = {k for k, d in docs.items() if len(d - {None}) + (None in d) >= lt.SAME_DOCS}
    leaves = defaultdict(list)
    for key in docs:
        leaves[leaf_of[key]].append(key)
    for (size, _), keys in leaves.items():
        if sum(len(docs[k]) for k in keys) < lt.MIN_DOCS or min(len(docs[k]) for k in keys) >= lt.SAME_DOCS or len(keys) < 2:
            continue
        is_open = {k: len(docs[k]) < lt.SAME_DOCS for k in keys}
        pool, at_once = {k for k in keys if is_open[k]}, 1
        while pool:
            found = [(k, d, is_open[k]) for k in keys for d in docs[k]]
            seeds = sorted(pool, key=order)[:at_once]
            new = set()
            for t in set().union(*[templates(found, s, size) for s in seeds]):
                known = sum(x is not None for x in t)
                own = [k for k in keys if equal(k, t) >= known * lt.LIKE]
                if len(set().union(*[docs[k] for k in own])) >= lt.MIN_DOCS:
                    new.update(own)
            gone |= new
            pool -= new | set(seeds)
            is_open.update(dict.fromkeys(new, False))
            at_once *= lt.MORE
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if doc is None or tuple(WORD.findall(x)) not in gone]
        out.append((doc, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(docs):
    from pyspark.sql import functions as F
    rows = lt.drop_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256))
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.mark.skipif(not os.path.isfile(SF), reason="driver test data not present")
def test_all_documents(spark):
    docs = spark.read.parquet(SF)
    want = plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert any(x[2] for x in want) and got(docs) == want


def test_hot_leaf_repeated_ids_nulls_and_long_texts(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abc") for _ in range(2))
    rows = [(i, "\n".join([f"User {i} of the {word()} page {word()} saw {r.randint(1, 9)}",
                           " ".join(word() for _ in range(9)), "", "  \t", f"Error {i} at {word()}"])) for i in range(40)]
    # a third of all lines in one leaf, without a template of their own
    rows += [(100 + i, "\n".join("same four words here " + " ".join(word() for _ in range(4)) for _ in range(3)))
             for i in range(20)]
    rows += [(1, "another text of this id\nUser 7 of the ab page bc saw 3"), (1, rows[1][1]), (2, None), (None, rows[3][1]),
             (300, "one line alone " * 4000), (301, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(docs) == plain(rows)
