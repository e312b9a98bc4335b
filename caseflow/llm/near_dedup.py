"""Operator 4: near-duplicate documents by a signature-coordinate inverted join.

Texts are sets of five-word shingles.  Texts with the same set are one class,
and only one document of a class goes on.  A class has a MinHash signature of
``COORDS`` coordinates and is posted under each (coordinate, value).  Two sets
link from a likeness of ``percent`` on.  At 85 they agree in 109 of 128
coordinates on average, and in fewer than 90 with a probability below 1e-5; at
80 in 102, and in fewer than 82.  ``matches`` gives that number; pairs with as
many equal coordinates are retained and confirmed on their full sets.

*Prefix.*  Coordinates are ordered by how many classes share them, rare ones
first.  Two classes with that many equal coordinates share one of their first
``COORDS - matches + 1``, so only these are posted, and none that only one
class has.
*Skip.*  Full sets give a bound: with u of n shingles found in no other
document, a pair has at most min(n - u) in common.  Classes and pairs whose
bound is below the threshold are skipped, which leaves few in a group of
copies with edits of their own.
*Long posting lists.*  Components are asked for, not all links.  Each list
chooses a pivot (fewest shingles of its own, then at random).  First a class is
compared to the best pivot of its lists alone, which joins most of a group, then
the members of each list that are still in other components to its pivot, and
links join components.  At last all remaining
pairs of different components are compared.  A shingle is rare if at most
``RARE`` of the classes still in question have it.  Two classes have at most
min(common shingles of each) in common besides the rare ones that both have, so
a pair either meets at a rare shingle, with enough left of both lists from there
on, or both reach the threshold by common shingles alone; only the latter are
compared within the posting lists, members outside a list's largest component
against the list.  So no link between different components is lost.  Copies that
differ from what most of their group has are told apart without being compared;
unlinked ones that lie close to it still are, each with each.

Defined results: a null text counts as empty; a text without words links with
nothing; rows that repeat an id are one document; a row with a null id links
with nothing, has a null component and is kept.  An empty table gives an empty
result.  Only ``doc_id`` and ``text`` are read; ``keep_rows`` passes the other
columns through.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.common import SHINGLE_WORDS, documents, ship_package, stored, whole_text
from caseflow.llm.components import components
from caseflow.llm.hashing import mix, shingle_sets
from caseflow.llm.words import bounded
from caseflow.operators.joins import bounded_broadcast

COORDS = 128
MISSED = 1e-5
LIKE_PERCENT = 85
PIVOT_ROUNDS = 2
BROADCAST_IDS = 4_000_000  # ids alone, 16 to 32 bytes each in a task's table
SKIP_ROUNDS = 2
RARE = 64  # classes that have a shingle, up to which its pairs are listed
_A = np.random.default_rng(11).integers(1, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def matches(percent: int) -> int:
    """The most equal coordinates that two sets at the threshold fall short of
    with a probability below MISSED."""
    like, below, m = percent / 100, 0.0, 0
    while True:
        below += math.comb(COORDS, m) * like**m * (1 - like)**(COORDS - m)
        if below >= MISSED or m == COORDS:
            return m
        m += 1


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of each of COORDS hash functions over the set."""
    out = np.full(COORDS, 0xFFFFFFFF, np.uint64)
    for lo in range(0, len(shingles), 4096):
        h = (shingles[lo:lo + 4096, None] * _A[None, :]) >> np.uint64(32)
        np.minimum(out, h.min(axis=0), out=out)
    return out.astype(np.uint32).view(np.int32)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in bounded(whole, "text", 1 << 20):
                sets = shingle_sets([t.encode() for t in b.column("text").to_pylist()], SHINGLE_WORDS)
                keys = [_set_key(s) for s in sets]
                sig = np.concatenate([signature(s) for s in sets])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1) * COORDS, pa.int32()), pa.array(sig))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.binary()), lists],
                    names=["doc_id", "n_shingles", "set_key", "sig"])

    return _texts(docs).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_key binary, sig array<int>")


def _set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def full_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, set_key, shingles) with the sorted distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in bounded(whole, "text", 1 << 20):
                sets = shingle_sets([t.encode() for t in b.column("text").to_pylist()], SHINGLE_WORDS)
                offs = np.cumsum([0] + [len(s) for s in sets])
                lists = pa.ListArray.from_arrays(pa.array(offs, pa.int32()),
                                                 pa.array(np.concatenate(sets).view(np.int64)))
                keys = pa.array([_set_key(s) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), keys, lists],
                                                 names=["doc_id", "set_key", "shingles"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, set_key binary, shingles array<bigint>")


def _keys(sigs: DataFrame) -> DataFrame:
    """(key, id): one row for each coordinate and value."""
    key = F.shiftleft(F.col("pos").cast("bigint"), 32) + F.col("value").cast("bigint")
    return sigs.select("id", F.posexplode("sig").alias("pos", "value")).select(key.alias("key"), "id")


def _alone(items: DataFrame, key: str) -> DataFrame:
    """(id, alone): how many of an id's keys no other id has.  A key with one
    owner names it by its minimum, so nothing is joined back."""
    return (items.groupBy(key).agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id"))
            .filter("c = 1").groupBy("id").agg(F.count(F.lit(1)).alias("alone")))


def _possible(common: Column, n: Column, percent: int) -> Column:
    """Whether ``common`` shingles of ``n`` in the union reach the threshold."""
    return common * 100 >= n * percent


def _pair_bound(a: str, b: str, percent: int) -> Column:
    most = F.least(F.col(f"{a}.shared"), F.col(f"{b}.shared"))
    return _possible(most, F.col(f"{a}.n") + F.col(f"{b}.n") - most, percent)


def _equal_coords() -> Column:
    return F.size(F.filter(F.zip_with("a.sig", "b.sig", lambda x, y: x == y), lambda x: x))


def confirmed(pairs: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that link: enough equal coordinates, then the exact
    likeness of the full sets."""
    kept = (pairs.join(sigs.alias("a"), F.col("u") == F.col("a.id"))
            .join(sigs.alias("b"), F.col("v") == F.col("b.id"))
            .filter(_equal_coords() >= matches(percent)).select("u", "v"))
    kept = stored(kept, "retained")
    both = F.size(F.array_intersect("a.shingles", "b.shingles"))
    return (kept.join(sets.alias("a"), F.col("u") == F.col("a.id"))
            .join(sets.alias("b"), F.col("v") == F.col("b.id"))
            .filter(_possible(both, F.size("a.shingles") + F.size("b.shingles") - both, percent))
            .select("u", "v"))


def _left_sets(left: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, n, comp, often, rare) of the classes that are ``left``: how many of
    its shingles more than RARE of them have, and the others, rarest first.
    Shingles of one component alone are of no use to a link between two."""
    at = (sets.join(left.select("id", "n", "comp").distinct(), "id")
          .select("id", "n", "comp", F.explode("shingles").alias("h")))
    of = (at.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
          .filter("lo <> hi").select("h", "c"))
    few = F.when(F.col("c") <= RARE, F.struct("c", F.xxhash64("h").alias("r"), "h"))
    return (at.join(of, "h").groupBy("id", "n", "comp")
            .agg(F.count_if(F.col("c") > RARE).alias("often"), F.array_sort(F.collect_list(few)).alias("few"))
            .select("id", "n", "comp", "often", F.transform("few", lambda x: x["h"]).alias("rare")))


def _rare_pairs(left_sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of different components that have a rare shingle in common
    and may link.  At the first one of a pair, all others that it has in common
    are further on in both lists, so what follows bounds them."""
    at = (left_sets.select("id", "n", "comp", "often", F.size("rare").alias("m"), F.posexplode("rare").alias("i", "h"))
          .withColumn("rest", F.col("m") - F.col("i"))
          .filter(_possible(F.col("often") + F.col("rest"), F.col("n"), percent))
          .select("h", "id", "n", "comp", "often", "rest"))
    most = F.least("a.often", "b.often") + F.least("a.rest", "b.rest")
    met = at.alias("a").join(at.alias("b"), F.expr("a.h = b.h and a.id > b.id and a.comp <> b.comp")
                             & _possible(most, F.col("a.n") + F.col("b.n") - most, percent))
    return met.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()


def links(docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between classes (id, rep, set_key, n, sig) that give the
    components of all links."""
    first = COORDS - matches(percent) + 1
    lone = _alone(_keys(reps), "key")
    near = reps.join(lone, "id", "left").filter(F.coalesce("alone", F.lit(0)) < first)
    near = stored(near.select("id", "rep", "set_key", "n", "sig"), "near_sigs")
    # a list of ids, so that texts are not shuffled for the few that go on
    wanted = bounded_broadcast(near.select(F.col("rep").alias("doc_id")), BROADCAST_IDS)
    texts = _texts(docs).join(wanted, "doc_id", "left_semi")
    # an id may have other texts, and rows may repeat
    sets = (full_sets(texts).join(near.select("id", F.col("rep").alias("doc_id"), "set_key"), ["doc_id", "set_key"])
            .select("id", "shingles").dropDuplicates(["id"]))
    sets = stored(sets, "full_sets")
    for turn in range(SKIP_ROUNDS):  # what only skipped documents share is no longer shared
        lone = _alone(sets.select("id", F.explode("shingles").alias("h")), "h")
        near = (near.select("id", "n", "sig").join(lone, "id", "left")
                .withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0)))
                .filter(_possible(F.col("shared"), F.col("n"), percent)).select("id", "n", "shared", "sig"))
        near = stored(near, "near_docs")
        sets = stored(sets.join(near.select("id"), "id", "left_semi"), "near_sets")

    # rare coordinates first; those that one class alone has count, but lead nowhere
    keys = _keys(near)
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    ranked = keys.join(often, "key").groupBy("id").agg(F.slice(F.array_sort(F.collect_list(
        F.struct("c", F.xxhash64("key").alias("h"), "key"))), 1, first).alias("prefix"))
    prefixes = stored(ranked.select("id", F.transform(
        F.filter("prefix", lambda p: p["c"] > 1), lambda p: p["key"]).alias("prefix")), "prefixes")
    posted = prefixes.select(F.explode("prefix").alias("key"), "id")
    posted = stored(posted.join(near.select("id", "n", "shared"), "id"), "postings")

    found = None
    for turn in range(PIVOT_ROUNDS + 1):
        if found is None:
            now = posted.withColumn("comp", F.col("id"))
        else:
            comp = components(found).withColumnRenamed("component", "comp")
            now = posted.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        now = stored(now, "postings_now")
        if turn < PIVOT_ROUNDS:
            own = F.when(F.lit(turn == 0), F.col("n") - F.col("shared")).otherwise(F.lit(0))
            best = F.struct(own.alias("own"), F.xxhash64(F.lit(turn), "id").alias("r"), "id", "n",
                            "shared", "comp")
            pivot = now.groupBy("key").agg(F.min(best).alias("b")).select("key", "b.*")
            some = now.alias("a").join(pivot.alias("b"), F.expr("a.key = b.key and a.comp <> b.comp")
                                       & _pair_bound("a", "b", percent))
            if turn == 0:  # later rounds compare what this one leaves apart
                some = (some.groupBy("a.id").agg(F.min(F.struct("b.own", "b.r", "b.id")).alias("p"))
                        .select("id", F.col("p.id").alias("other")))
        else:
            per = now.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
            main = per.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("m"),
                                          F.count(F.lit(1)).alias("comps")).filter("comps > 1")
            left = (now.join(main, "key").join(prefixes, "id").join(near.select("id", "sig"), "id")
                    .select("key", "id", "n", "shared", "comp", F.col("m.comp").alias("main"),
                            "prefix", "sig"))
            left = stored(left, "postings_left")
            left_sets = stored(_left_sets(left, sets), "left_sets")
            rare = _rare_pairs(left_sets, percent)
            # the others link by common shingles alone, if at all
            often = (left_sets.filter(_possible(F.col("often"), F.col("n"), percent))
                     .select("id", F.col("often").alias("shared")))
            left = stored(left.drop("shared").join(often, "id"), "postings_often")
            # a pair comes out of one of its common lists only
            some = left.filter("comp <> main").alias("a").join(
                left.alias("b"), F.expr("a.key = b.key and a.comp <> b.comp "
                                        "and (b.comp = a.main or a.id < b.id)")
                & _pair_bound("a", "b", percent)
                & F.expr("a.key = array_min(array_intersect(a.prefix, b.prefix))")
                & (_equal_coords() >= matches(percent)))
        a, b = ("id", "other") if turn == 0 else ("a.id", "b.id")
        pairs = some.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        pairs = (pairs if turn < PIVOT_ROUNDS else pairs.union(rare)).distinct()
        new = confirmed(pairs, near.select("id", "sig"), sets, percent)
        found = stored(new if found is None else found.union(new), "links")
    return found


def link_components(docs: DataFrame, percent: int = LIKE_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; sets link from a
    likeness of ``percent`` on."""
    ship_package(docs.sparkSession)
    rows = stored(signatures(docs), "signatures")
    known = rows.filter("doc_id is not null and n_shingles > 0")
    # texts with the same set are one class, under a number of its own
    classes = known.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    member = stored(known.select("doc_id", "set_key").distinct().join(classes, "set_key")
                    .select("doc_id", "set_key", "rep", "id"), "members")
    reps = (known.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "set_key"])
            .select("id", F.col("doc_id").alias("rep"), "set_key", F.col("n_shingles").alias("n"), "sig")
            .dropDuplicates(["id"]))
    found = links(docs, stored(reps, "representatives"), percent)
    # an id with several texts ties their classes together
    several = (member.groupBy("doc_id").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("c")).filter("c > 1")
               .join(member, "doc_id").filter("id <> v").select(F.col("id").alias("u"), "v"))
    comp = components(found.union(several))
    comp = stored(comp.union(comp.select("component", "component")).distinct(), "class_components")
    least = (comp.join(classes.select("id", "rep"), "id").groupBy("component")
             .agg(F.min("rep").alias("least")).join(comp, "component").select("id", "least"))
    of = (member.join(least, "id", "left").groupBy("doc_id")
          .agg(F.min(F.coalesce("least", "rep")).alias("component_id")))
    out = rows.select("doc_id", "n_shingles").join(of, "doc_id", "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_rows(docs: DataFrame, percent: int = LIKE_PERCENT) -> DataFrame:
    """The rows of ``docs`` that are kept, one document of each component."""
    gone = link_components(docs, percent).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    gone = bounded_broadcast(stored(gone, "gone"), BROADCAST_IDS)
    return docs.join(gone, docs["doc_id"].cast("bigint") == F.col("__gone"), "left_anti")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(documents(spark, sf_dir), LIKE_PERCENT)
