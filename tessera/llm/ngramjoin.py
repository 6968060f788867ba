"""Operator 11 — n-gram Jaccard self-join by vertical partitioning.

A document's set is its distinct word n-grams (64-bit hashes).  All n-grams have one
global order, rare ones first; the order is cut into fragments, and every set with
it.  The overlap of a pair is counted fragment by fragment, apart from each other,
and summed per pair; pairs of 100 * overlap >= 80 * union are links.

What keeps the pairs few, without losing a link:

* **who can link at all** — a partner shares four fifths of a set, so a set drops out
  once more than a fifth of its n-grams occur in no other text.  This is counted on
  the n-grams of the first ``SHARE`` of the hash range, then exactly on what is left;
  clean documents go here, before any set is kept or ordered;
* **prefixes** — partners share an n-gram in the first fifth of the order of the longer
  set and in the first ninth of the shorter one, with enough n-grams after it;
* **classes** — equal texts are one from the start, and only connectivity is wanted.
  So a prefix n-gram first compares its documents with one of them (the one whose
  n-grams are the most common, later others by hash), and components are formed.
  In the end *every* remaining pair of documents with a common prefix n-gram in
  different components is compared.  Pairs within a component are never made.

N-grams and partners with many rows are joined by broadcasts of provably few keys or
in blocks; nothing is collected but a set's own n-grams.

Defined cases: null, empty and wordless texts have an empty set and link with
nothing; a text with fewer words than n is one n-gram; null ids take part, but name
a component only if nothing else could; equal texts share a component, repeated rows
too (not those without words); an empty table gives no rows; texts are read whole;
columns other than id and text are not read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored, utf8
from tessera.llm.components import components
from tessera.llm.order import HOT_LEAST, HOT_SHARE, looked_up
from tessera.session import broadcast_if_small

WORDS, LIKE = 5, Fraction(4, 5)
SHARE = 0.3  # of the hash range, for the first count
FRAGMENTS = 8
STARS = 4  # rounds of comparing with one document, before all that is left
BLOCK = 2_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _folded(rows: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash from the hashes of consecutive words."""
    total = np.full(len(rows[0]), len(rows), np.uint64)
    for k, row in enumerate(rows):
        total = (total ^ row) * _MIX[k % len(_MIX)]
        total ^= total >> np.uint64(29)
    return total


def ngrams(text: bytes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams; fewer words: the whole sequence."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    width = min(n, len(words))
    rows = [hashes[k: len(words) - width + 1 + k] for k in range(width)]
    return np.unique(_folded(rows).view(np.int64))


def _batches(batches, make, names: list[str], limit: int = 1 << 20):
    """Record batches of ``make(row)``-tuples with no more than about ``limit`` n-grams each."""
    for batch in batches:
        keys, texts = batch.column("key").to_pylist(), utf8(batch.column("text"))
        others = [batch.column(c).to_pylist() for c in names]
        done, held = [], 0
        for k, text in enumerate(texts):
            grams = ngrams(text)
            chosen = make(grams)
            done.append((*[o[k] for o in others], keys[k], len(grams), chosen))
            held += len(chosen)
            if held > limit:
                yield done
                done, held = [], 0
        if done:
            yield done


def _arrow(done: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    grams = [d[-1] for d in done]
    offsets = np.cumsum([0] + [len(g) for g in grams]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(grams).astype(np.int64)))
    return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kind) for k, (_, kind) in enumerate(fields)] + [lists], [f for f, _ in fields] + ["grams"])


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, n, grams): the size of every document's set and the n-grams of the first count; equal texts have one key."""
    rows = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text_col].cast("binary")).alias("key"), docs[text_col].alias("text"))
    cut = np.int64(int(SHARE * (1 << 64)) - (1 << 63))

    def run(batches):
        for batch in batches:
            kind = batch.column("doc_id").type
            for done in _batches([batch], lambda g: g[g < cut], ["doc_id"]):
                yield _arrow(done, [("doc_id", kind), ("key", pa.int64()), ("n", pa.int64())])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, key long, n long, grams array<long>")


def _least(n: Column, share: Fraction) -> Column:
    """ceil(share * n) in whole numbers."""
    return F.floor((n * share.numerator + (share.denominator - 1)) / F.lit(share.denominator)).cast("long")


def candidates_of(found: DataFrame, like: Fraction) -> DataFrame:
    """(key) of the texts whose n-grams may recur elsewhere often enough."""
    grams = found.select("key", F.explode("grams").alias("gram"))
    alone = (grams.groupBy("gram").agg(F.min("key").alias("key"), F.max("key").alias("other")).where("key = other")
             .groupBy("key").agg(F.count(F.lit(1)).alias("alone")))
    texts = found.where("n > 0").groupBy("key").agg(F.min("n").alias("n"))
    left = texts.join(alone, "key", "left").where(F.coalesce("alone", F.lit(0)) <= F.col("n") - _least(F.col("n"), like))
    return stored(left.select("key"), "texts")


def sets_of(docs: DataFrame, keys: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, n, grams): the whole set of each text in ``keys``, once."""
    texts = docs.select(F.xxhash64(docs[text_col].cast("binary")).alias("key"), docs[text_col].alias("text"))
    once = texts.join(broadcast_if_small(keys), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))

    def run(batches):
        for done in _batches(batches, lambda g: g, []):
            yield _arrow(done, [("key", pa.int64()), ("n", pa.int64())])

    return stored(once.mapInArrow(run, "key long, n long, grams array<long>"), "sets")


def ordered(sets: DataFrame, like: Fraction) -> DataFrame:
    """(key, n, common, common_by): each set's n-grams that other sets hold too, in the global order
    (frequency, hash), for sets with enough of them, and how common they are on the whole.  Those that
    nobody else holds come before."""
    grams = sets.select("key", "n", F.explode("grams").alias("gram"))
    shared = stored(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    total = shared.agg(F.sum("df")).first()[0] or 0
    limit = max(HOT_LEAST, total // HOT_SHARE)
    hot = shared.where(F.col("df") > limit)  # fewer than HOT_SHARE rows
    usual = grams.join(F.broadcast(hot.select("gram")), "gram", "left_anti").join(shared.where(F.col("df") <= limit), "gram")
    rows = usual.unionByName(grams.join(F.broadcast(hot), "gram"))
    whole = rows.groupBy("key").agg(F.min("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("common"))  # a set's own n-grams
    enough = whole.where(F.size("common") >= _least(F.col("n"), like))
    return stored(enough.withColumn("common_by", F.aggregate("common", F.lit(0.0), lambda a, c: a + F.log(c["df"])) / F.col("n")), "ordered")


def segments(sets: DataFrame, fragments: int = FRAGMENTS) -> DataFrame:
    """(key, fragment, segment): every set cut where the global order is cut, into stretches of about
    equal numbers of occurrences."""
    def rank(c):
        return c["df"] + (c["gram"] / F.lit(float(1 << 64)) + 0.5)

    marks = sets.select(F.explode("common").alias("c")).agg(
        F.percentile_approx(rank(F.col("c")), [k / fragments for k in range(1, fragments)], F.lit(1000)).alias("m")).first()[0] or []
    bounds = [None, *marks, None]

    def segment(low, high):
        def inside(c):
            keep = F.lit(True) if low is None else rank(c) >= low
            return keep if high is None else keep & (rank(c) < high)
        return F.transform(F.filter("common", inside), lambda c: c["gram"])

    pieces = F.array(*[F.struct(F.lit(k).alias("fragment"), segment(a, b).alias("segment")) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))])
    return stored(sets.select("key", F.explode(pieces).alias("p")).select("key", "p.fragment", "p.segment").where(F.size("segment") > 0), "segments")


def prefixes(sets: DataFrame, like: Fraction) -> DataFrame:
    """(gram, key, n, common_by, rest, first): the n-grams by which a set can meet a partner; ``rest`` n-grams
    follow from there on, ``first``: also as the shorter one."""
    both = 2 * like / (1 + like)
    m = F.size("common").cast("long")
    front = F.slice("common", F.lit(1), (m - _least(F.col("n"), like) + 1).cast("int"))
    ranked = sets.select("key", "n", "common_by", m.alias("m"), F.posexplode(front).alias("k", "c"))
    rest = F.col("m") - F.col("k")
    rows = ranked.select(F.col("c.gram").alias("gram"), "key", "n", "common_by", rest.alias("rest"), (rest >= _least(F.col("n"), both)).alias("first"))
    rows = stored(rows, "prefixes")
    met = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"), F.max("first").alias("any")).where("rows > 1 AND any").select("gram", "rows")
    return stored(looked_up(rows, stored(met, "met"), "gram").where("rows > 1").drop("rows"), "prefixes")


def _pairs(rows: DataFrame, like: Fraction) -> DataFrame:
    """Distinct (u, v, nu, nv), u < v, of (key, n, other, other_n) rows whose sizes allow a link."""
    small, large = F.least("n", "other_n"), F.greatest("n", "other_n")
    swap = F.col("key") > F.col("other")
    fit = rows.where((F.col("key") != F.col("other")) & (small * like.denominator >= large * like.numerator))
    return fit.select(F.least("key", "other").alias("u"), F.greatest("key", "other").alias("v"),
                      F.when(swap, F.col("other_n")).otherwise(F.col("n")).alias("nu"), F.when(swap, F.col("n")).otherwise(F.col("other_n")).alias("nv")).distinct()


def overlaps(pairs: DataFrame, cut: DataFrame, fragments: int = FRAGMENTS) -> DataFrame:
    """(u, v, nu, nv, overlap) of stored pairs: partial overlaps by fragment, summed per pair.

    A key in very many pairs is put on side ``a``; its segments are joined by broadcast."""
    ends = pairs.select(F.col("u").alias("key")).unionAll(pairs.select(F.col("v").alias("key"))).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = stored(ends.where(F.col("n") > max(HOT_LEAST // 2, pairs.count() // 500)).select("key"), "hot-ends")  # fewer than 1,000
    marked = pairs.join(F.broadcast(hot.select(F.col("key").alias("u"), F.lit(True).alias("hot_u"))), "u", "left")
    marked = marked.join(F.broadcast(hot.select(F.col("key").alias("v"), F.lit(True).alias("hot_v"))), "v", "left")
    side = F.coalesce("hot_v", F.lit(False)) & F.col("hot_u").isNull()
    dealt = marked.select("u", "v", "nu", "nv", F.when(side, F.col("v")).otherwise(F.col("u")).alias("a"), F.when(side, F.col("u")).otherwise(F.col("v")).alias("b"),
                          (F.col("hot_u").isNotNull() | F.col("hot_v").isNotNull()).alias("hot"))
    of_b = cut.select(F.col("key").alias("b"), "fragment", F.col("segment").alias("sb"))
    of_a = cut.select(F.col("key").alias("a"), "fragment", F.col("segment").alias("sa"))
    by_fragment = dealt.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    usual = by_fragment.where(~F.col("hot")).join(of_b, ["b", "fragment"]).join(of_a, ["a", "fragment"])
    hot_a = of_a.join(F.broadcast(hot.select(F.col("key").alias("a"))), "a", "left_semi")
    many = by_fragment.where("hot").join(of_b, ["b", "fragment"]).join(broadcast_if_small(hot_a, 1000 * fragments), ["a", "fragment"])
    partial = usual.unionByName(many).select("u", "v", "nu", "nv", F.size(F.array_intersect("sa", "sb")).cast("long").alias("o"))
    return partial.groupBy("u", "v", "nu", "nv").agg(F.sum("o").alias("overlap"))


def _links(pairs: DataFrame, cut: DataFrame, like: Fraction, fragments: int) -> DataFrame:
    union = F.col("nu") + F.col("nv") - F.col("overlap")
    return stored(overlaps(pairs, cut, fragments).where(F.col("overlap") * like.denominator >= union * like.numerator).select("u", "v"), "links")


def classes(sets: DataFrame, like: Fraction = LIKE, fragments: int = FRAGMENTS, stars: int = STARS, block: int = BLOCK) -> DataFrame:
    """(key, class) of the sets (key, n, grams) that link with another: the smallest key that links reach."""
    sets = ordered(sets, like)
    cut = segments(sets, fragments)
    meet = prefixes(sets, like)
    spark = sets.sparkSession
    labels = spark.createDataFrame([], "key long, class long")
    tried = spark.createDataFrame([], "u long, v long")

    for turn in range(stars + 1):
        rows = stored(meet.join(labels, "key", "left").withColumn("class", F.coalesce("class", "key")), "met-rows")
        best = F.struct((F.col("common_by") if turn == 0 else F.xxhash64("key", F.lit(turn))).alias("by"), F.col("key"), F.col("n"))
        main = ["best", "class"] if turn == 0 else ["rows", "best", "class"]
        by_class = rows.groupBy("gram", "class").agg(F.count(F.lit(1)).alias("rows"), F.max(best).alias("best"))
        open_grams = by_class.groupBy("gram").agg(F.count(F.lit(1)).alias("classes"), F.sum("rows").alias("size"),
                                                  F.max(F.struct(*main)).alias("top"))
        open_grams = stored(open_grams.where("classes > 1").select("gram", "size", F.col("top.class").alias("main"), F.col("top.best.key").alias("other"), F.col("top.best.n").alias("other_n")), "open")
        if open_grams.isEmpty():
            break
        outside = looked_up(rows, open_grams, "gram").where("class <> main")
        if turn < stars:
            pairs = _pairs(outside, like)
        else:
            pairs = _rest(rows, stored(outside, "outside"), open_grams, like, block)
        pairs = stored(pairs.join(tried, ["u", "v"], "left_anti"), "pairs")
        found = _links(pairs, cut, like, fragments)
        tried = stored(tried.unionByName(pairs.select("u", "v")), "tried")
        if not found.isEmpty():
            edges = labels.where("key <> class").select(F.col("key").alias("u"), F.col("class").alias("v")).unionByName(found)
            labels = stored(components(edges).select(F.col("node").alias("key"), F.col("component").alias("class")), "labels")
    return labels


def _rest(rows: DataFrame, outside: DataFrame, open_grams: DataFrame, like: Fraction, block: int) -> DataFrame:
    """Every pair in different classes that a common prefix n-gram allows.

    One of the two is outside the n-gram's main class; the other side is dealt to blocks of
    about ``block`` rows."""
    blocks = open_grams.select("gram", F.ceil(F.col("size") / block).cast("long").alias("blocks"))
    right = looked_up(rows, blocks, "gram").where("blocks IS NOT NULL").select(
        "gram", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("at"), F.col("key").alias("other"), F.col("n").alias("other_n"), F.col("rest").alias("other_rest"),
        F.col("first").alias("other_first"), F.col("class").alias("other_class"))
    left = outside.select("gram", "key", "n", "rest", "first", "class", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / block).cast("long") - 1)).alias("at"))
    both = like / (1 + like)
    room = F.least("rest", "other_rest") * both.denominator >= (F.col("n") + F.col("other_n")) * both.numerator
    return _pairs(left.join(right, ["gram", "at"]).where((F.col("class") != F.col("other_class")) & (F.col("first") | F.col("other_first")) & room), like)


def near_duplicates(docs: DataFrame, like: Fraction = LIKE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    found = stored(profiles(docs, id_col, text_col), "profiles", "none")
    texts = candidates_of(found, like)
    labels = classes(sets_of(docs, texts, text_col), like)
    rows = stored(looked_up(found.select("doc_id", "key", "n"), labels, "key").select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("class", "key")).alias("class")), "classed")
    names = stored(rows.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least")), "names")
    return looked_up(rows, names, "class").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
