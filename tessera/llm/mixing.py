"""Operator 4 — mixing sources to target weights.

A document may belong to several sources.  Documents are aggregated by
membership pattern (the set of their sources); a pattern offers its words once
for each repetition, at a cost that grows with the repetition (convex), and every
source asks for its quota.  A min-cost flow routes words from patterns to quotas
with the fewest repetitions.  What the flow takes from a pattern at a repetition
is then filled with whole documents in a seeded order.

Where every document has one source, nothing competes: targets are found by
aggregates over the sources, however many there are.  Where sources overlap, the
pattern sums go to the flow on the driver (at most ``max_patterns``; more is an
error, not a cut).  Selection is distributed: each pattern is cut into hash
buckets (more, the more rows there are), bucket sums give every bucket its place in the seeded order, and the
running sum within a bucket does the rest, so a pattern that holds a third of
all rows is spread over all buckets.  A document enters if its middle lies
within the quota; what that rounding leaves over or short is corrected with
documents no larger than the remainder.

Defined cases: null text has size 0 and is never taken; a null source is a
source of its own, last in order; documents of equal size and repeated rows are
ordered by a hash of all that identifies them, ties share nothing but order; an
empty table gives no rows; only the id, text and source columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import docs_column, stored, whole_rows, word_count
from tessera.llm.order import numbered
from tessera.session import broadcast_if_small

BUCKETS, BUCKET_ROWS = 1024, 20_000  # buckets at least; rows of a bucket on average at most
SEED = 42


def targets(sizes: dict, weights: list[float], share: float = 1.5, cap: float = 2.0, total: float | None = None) -> dict:
    """Words asked for by each source: ``share`` of all words dealt by weight; a source never
    asks for more than ``cap`` times its size, the excess is dealt again among the others.

    ``sizes``: source → words, in the order in which ``weights`` repeat.  ``total``: all words, if
    sources overlap (else the sum of the sizes)."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sizes)}
    open_, rest, out = set(sizes), share * (sum(sizes.values()) if total is None else total), {}
    while open_:
        open_weight = sum(weight[o] for o in sizes if o in open_)
        ask = {s: rest * weight[s] / open_weight for s in open_}
        full = {s for s in open_ if ask[s] > cap * sizes[s]}
        for s in full or open_:
            out[s] = cap * sizes[s] if full else ask[s]
        rest -= sum(out[s] for s in full)
        open_ = open_ - full if full else set()
    return {s: float(out[s]) for s in sizes}


def min_cost_flow(patterns: dict, quota: dict, repetitions: int) -> dict:
    """Flows (pattern, repetition, source) → words that fill the quotas at the least cost.

    ``patterns``: pattern (a tuple of sources) → words.  Word number r of the same words costs
    more than number r - 1 (convex), so the layers are opened in that order; within a layer,
    augmenting paths may hand words that a source took earlier to another source of their
    pattern, which leaves every earlier layer as full as it was.  Cheapest paths first, and no
    path ever gives a cheaper word back, so the cost is minimal."""
    need = {s: float(q) for s, q in quota.items()}
    held: dict = {s: {} for s in quota}  # source → (pattern, repetition) → words
    eps = 1e-6
    for r in range(1, repetitions + 1):
        for p, words in patterns.items():
            left = float(words)
            while left > eps:
                came = {s: ((p, r), None) for s in p}
                queue, goal = list(p), None
                for s in queue:
                    if need[s] > eps:
                        goal = s
                        break
                    for layer, amount in held[s].items():
                        for other in layer[0] if amount > eps else ():
                            if other not in came:
                                came[other] = (layer, s)
                                queue.append(other)
                if goal is None:
                    break
                steps, s = [], goal
                while s is not None:
                    layer, giver = came[s]
                    steps.append((layer, giver, s))
                    s = giver
                amount = min(left, need[goal], *(held[g][layer] for layer, g, _ in steps if g is not None), float("inf"))
                for layer, giver, taker in steps:
                    held[taker][layer] = held[taker].get(layer, 0.0) + amount
                    if giver is not None:
                        held[giver][layer] -= amount
                left -= amount
                need[goal] -= amount
    return {(*layer, s): w for s, own in held.items() for layer, w in own.items() if w > eps}


def _fill(rows: DataFrame, wish: DataFrame) -> DataFrame:
    """``rows`` after one pass: in each pattern the documents that may change (``in`` is not
    ``add``, size at most ``most``) change, in seeded order, as long as their middle lies within
    ``quota`` words of changes.  ``wish`` has one row for each pattern."""
    may = (F.col("in") != F.col("add")) & (F.col("size") > 0) & (F.col("size") <= F.col("most"))
    open_ = rows.join(broadcast_if_small(wish), "pattern").withColumn("cand", F.when(may, F.col("size")).otherwise(0))
    buckets = open_.groupBy("pattern", "bucket").agg(F.sum("cand").alias("words"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("pattern", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("pattern", "bucket").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("start") + F.coalesce(F.sum("cand").over(within), F.lit(0))
    flip = (F.col("cand") > 0) & (at + F.col("cand") / 2 <= F.col("quota"))
    return open_.join(starts, ["pattern", "bucket"]).withColumn("in", F.col("in") != flip).select(*rows.columns)


def plan_of_single_sources(sums: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """(pattern, source, source_size, target) for sources that share no document, as ``targets`` has it.

    A source is full when its size for its weight lies under a mark; each round takes the rest and
    the weights above the mark from one aggregate and raises the mark, until nothing more is full."""
    ranked = numbered(stored(sums.withColumn("all", F.lit("")), "sources"), "all", [F.col("source").asc_nulls_last()], ["pattern", "source", "size"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weight).withColumn("ratio", F.col("size") / weight), "weighted-sources")
    mark = 0.0
    while True:
        full = F.col("ratio") < mark
        row = ranked.agg(F.sum("size").alias("total"), F.coalesce(F.sum(F.when(full, F.col("size"))), F.lit(0)).alias("closed"),
                         F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        rest = share * (row.total or 0) - cap * row.closed
        higher = rest / (row.open * cap) if row.open else mark
        if higher <= mark or ranked.where((F.col("ratio") >= mark) & (F.col("ratio") < higher)).isEmpty():
            break
        mark = higher
    each = rest / row.open if row.open else 0.0
    target = F.when(F.col("ratio") < mark, cap * F.col("size")).otherwise(F.lit(each) * F.col("weight"))
    return ranked.select("pattern", "source", F.col("size").alias("source_size"), target.cast("double").alias("target"))


def _plan_of_overlaps(sums: DataFrame, weights: list[float], share: float, repetitions: int, max_patterns: int) -> DataFrame:
    """(pattern, source, source_size, target, words): the flow's words for each pattern."""
    rows = sums.limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = {tuple(r.sources or ()): r.size for r in rows}
    name = {tuple(r.sources or ()): r.pattern for r in rows}
    sizes: dict = {}
    for p, w in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + w
    sizes = {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}
    quota = targets(sizes, weights, share, float(repetitions), sum(w for p, w in patterns.items() if p))
    words = dict.fromkeys(patterns, 0.0)
    for (p, _, _), n in min_cost_flow(patterns, quota, repetitions).items():
        words[p] += n
    out = [(name[p], p[0] if len(p) == 1 else None, int(sum(sizes[s] for s in p)), float(sum(quota[s] for s in p)), int(patterns[p]), words[p]) for p in patterns]
    return sums.sparkSession.createDataFrame(out, "pattern string, source string, source_size long, target double, size long, words double").coalesce(1)


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, repetitions: int = 2, seed: int = SEED, corrections: int = 2,
        max_patterns: int = 20_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source (of a single membership; else null),
    source_size, target, taken, copies.

    ``source_col`` is one source, or an array of the sources that hold the document."""
    many = docs.schema[source_col].dataType.typeName() == "array"
    members = F.array_sort(F.array_distinct(docs[source_col])) if many else F.array(docs[source_col])
    rows = stored(docs.select(
        docs[id_col].alias("doc_id"), word_count(docs[text_col]).alias("size"),
        F.to_json(F.struct(members.alias("s")), {"ignoreNullFields": "false"}).alias("pattern"), members.alias("sources"),
        F.xxhash64(docs[id_col].cast("string"), F.lit(seed)).alias("order"), F.xxhash64(docs[text_col]).alias("key"),
    ), "mix-sizes")  # narrow: the texts are read once
    buckets = max(BUCKETS, rows.count() // BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("order", "key"), F.lit(buckets)))
    sums = rows.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("size"))
    if many:
        plan = _plan_of_overlaps(sums, weights, share, repetitions, max_patterns)
    else:
        single = plan_of_single_sources(sums.select("pattern", F.col("sources")[0].cast("string").alias("source"), "size"), weights, share, float(repetitions))
        plan = single.withColumn("size", F.col("source_size")).withColumn("words", F.col("target"))
    # a pattern's repetitions fill up in order, so at most one of them is in part
    whole = F.when(F.col("size") > 0, F.floor(F.col("words") / F.col("size") + 1e-9)).otherwise(0).cast("int")
    plan = plan.withColumn("whole", whole).withColumn("part", F.col("words") - F.col("whole") * F.col("size"))
    plan = stored(plan.select("pattern", "source", "source_size", "target", "whole", "part"), "mix-plan")
    taken = rows.drop("sources").withColumn("in", F.lit(False))
    left, most = plan.select("pattern", "part"), F.lit(float("inf"))
    for _ in range(1 + corrections):
        wish = left.select("pattern", F.abs("part").alias("quota"), most.alias("most"), (F.col("part") > 0).alias("add"))
        taken = stored(_fill(taken, wish), "mix-pass")
        got = taken.where("in").groupBy("pattern").agg(F.sum("size").alias("n"))
        left = stored(plan.select("pattern", "part").join(got, "pattern", "left").select("pattern", (F.col("part") - F.coalesce("n", F.lit(0))).alias("part")), "mix-left")
        most = F.abs("part")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("in").cast("int")).otherwise(0)
    return (taken.join(broadcast_if_small(plan.drop("part")), "pattern").withColumn("copies", copies)
            .select("doc_id", "size", "source", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "key"))


def select_documents(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with the columns of ``docs``."""
    mixed = mix(docs, weights, id_col=id_col, text_col=text_col, **kw)
    picked = mixed.where("copies > 0").groupBy("doc_id", "key").agg(F.max("copies").alias("copies"))  # repeated rows have one answer
    rows = whole_rows(docs)  # columns of any name travel along
    same = docs_column("row", id_col).eqNullSafe(F.col("doc_id")) & (F.xxhash64(docs_column("row", text_col)) == F.col("key"))
    return rows.join(picked, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
