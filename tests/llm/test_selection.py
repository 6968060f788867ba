"""Mixing, sharding, line dedup, quality, toxicity, neighbours and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import ann, linededup, mixing, quality, queries, sharding, toxicity
from tests.conftest import SF_MID, SF_SMALL

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def _docs(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")


# -- mixing ---------------------------------------------------------------------------------


def test_targets_fill_up_to_the_cap():
    sizes = {"a": 10, "b": 100, "c": 50, None: 3}
    got = mixing.targets(sizes, [5, 2, 1])
    assert got["a"] == 20 and got[None] == 6
    assert got["b"] / got["c"] == pytest.approx(2) and sum(got.values()) == pytest.approx(1.5 * 163)
    assert mixing.targets({}, [1.0]) == {}


def test_flow_is_feasible_and_cheapest():
    rng = random.Random(5)
    for _ in range(150):
        sources = list("abcd")[: rng.randint(1, 4)]
        patterns = {}
        for _ in range(rng.randint(1, 5)):
            patterns[tuple(sorted(rng.sample(sources, rng.randint(1, len(sources)))))] = rng.randint(1, 6)
        quota = {s: rng.randint(0, 9) for s in sources}
        flow = mixing.min_cost_flow(patterns, quota, 2)
        used, into = Counter(), Counter()
        for (p, r, s), w in flow.items():
            assert s in p
            used[p, r] += w
            into[s] += w
        assert all(used[p, r] <= patterns[p] + 1e-6 for p, r in used) and all(into[s] <= quota[s] + 1e-6 for s in into)
        # Hall: what any set of sources gets is bounded by the words its patterns offer; greedy layers reach
        # the maximum at one repetition and at two, which is the least total cost
        def most(reps):
            best = sum(quota.values())
            for mask in range(1 << len(sources)):
                chosen = {s for k, s in enumerate(sources) if mask >> k & 1}
                best = min(best, sum(quota[s] for s in sources if s not in chosen) + reps * sum(w for p, w in patterns.items() if chosen & set(p)))
            return best
        assert sum(w for (p, r, s), w in flow.items() if r == 1) == pytest.approx(most(1))
        assert sum(flow.values()) == pytest.approx(most(2))


def test_mix_query(spark):
    rows = queries.op4_mixing(spark, SF_MID).collect()
    again = queries.op4_mixing(spark, SF_MID).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    size = {r.doc_id: len(WORDS.findall((r.text or "").encode())) for r in _docs(spark, SF_MID).collect()}
    source = {r.doc_id: r.source for r in _docs(spark, SF_MID).collect()}
    total = Counter()
    for i, s in source.items():
        total[s] += size[i]
    want = mixing.targets({s: total[s] for s in sorted(total)}, [5, 2, 1])
    got = Counter()
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == total[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        got[source[r.doc_id]] += r.taken
    assert all(abs(got[s] - want[s]) <= 0.01 * want[s] for s in want)


def test_mix_overlapping_sources(spark):
    rows = [(i, "w " * (1 + i % 7), ["a"] if i % 3 else ["a", "b"]) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mixing.mix(frame, [1.0, 1.0], share=0.5).collect()
    words = sum(r.size for r in got)
    assert abs(sum(r.taken for r in got) - 0.5 * words) < 10


def test_mix_edges(spark, edge, nothing):
    rows = mixing.mix(edge, queries.MIX_WEIGHTS).collect()
    assert len(rows) == edge.count() and all(r.taken <= 2 * r.size for r in rows)
    picked = mixing.select_documents(edge, queries.MIX_WEIGHTS)
    assert picked.columns == edge.columns and picked.count() == sum(r.copies for r in rows)
    assert mixing.mix(nothing, queries.MIX_WEIGHTS).count() == 0 and mixing.select_documents(nothing, queries.MIX_WEIGHTS).count() == 0


# -- sharding -------------------------------------------------------------------------------


def _shard(i, tree):
    def draw(node, weight):
        h = xxhash.xxh64_intdigest(node.encode(), seed=xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), seed=42))
        return -math.log(((h >> 11) + 0.5) / 2**53) / weight

    def best(options):
        return min(options, key=lambda o: draw(o[0], o[1]))[2] if len(options) > 1 else options[0][2]

    racks = {r: {k: sum(s.values()) for k, s in tree.regions[r].items()} for r in tree.regions}
    region = best([(r, sum(racks[r].values()), r) for r in racks])
    rack = best([(f"{region}/{k}", w, k) for k, w in racks[region].items()])
    return best([(f"{region}/{rack}/{s}", w, s) for s, w in tree.regions[region][rack].items()])


def test_shard_query(spark):
    rows = queries.op5_sharding(spark, SF_MID).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in _docs(spark, SF_MID).collect()}
    tree = sharding.even_tree(8)
    slots = defaultdict(list)
    for r in rows:
        raw = texts.pop(r.doc_id)
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert not texts and all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    assert 0.05 < sum(r.grown_shard == 8 for r in rows) / len(rows) < 0.18
    assert all(_shard(r.doc_id, tree) == r.shard and _shard(r.doc_id, tree.grown()) == r.grown_shard for r in rows[:300])


def test_weights_and_movement(spark):
    tree = sharding.Tree({"x": {"p": {0: 1.0, 1: 3.0}, "q": {2: 2.0}}, "y": {"p": {3: 2.0}, "q": {4: 0.0}}})
    more = sharding.Tree({"x": {"p": {0: 1.0, 1: 5.0}, "q": {2: 2.0}}, "y": {"p": {3: 2.0}, "q": {4: 0.0}}})
    frame = spark.range(40_000).select(sharding.shard_of(F.col("id"), tree).alias("a"), sharding.shard_of(F.col("id"), more).alias("b"))
    pairs = Counter((r.a, r.b) for r in frame.collect())
    share = Counter()
    for (a, _), n in pairs.items():
        share[a] += n / 40_000
    assert all(abs(share[s] - w / 8) < 0.02 for s, w in {0: 1, 1: 3, 2: 2, 3: 2}.items()) and share[4] == 0
    assert all(a == b or b in (0, 1, 2) for a, b in pairs)  # nothing moves into the region that did not change


def test_shard_edges(spark, edge, nothing):
    rows = sharding.assign(edge, sharding.even_tree(8)).collect()
    assert len(rows) == edge.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.doc_id is None}) == 1 and {r.size for r in rows if r.doc_id == 5} == {1}
    assert sharding.assign(nothing, sharding.even_tree(8)).count() == 0


# -- line dedup -----------------------------------------------------------------------------


@pytest.mark.parametrize("sites", [2, 3])
def test_line_edges(spark, edge, nothing, sites):
    rows = {(r.doc_id, r.n_lines): r for r in linededup.report(edge, min_sites=sites).collect()}
    assert rows[8, 2].n_removed == 0 or sites == 2  # the first occurrence stays
    assert rows[9, 2].n_removed == 1 and rows[10, 2].n_removed == 1 and rows[11, 1].n_removed == 1
    assert rows[5, 0].clean_sha256 is None and rows[3, 0].n_removed == 0
    kept = linededup.dedup(edge, min_sites=sites)
    assert kept.columns == edge.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[9] == "other text" and texts[10] == "\nthird" and 11 not in texts and 12 not in texts and texts[3] == ""
    assert linededup.report(nothing).count() == 0 and linededup.dedup(nothing).count() == 0


def test_line_threshold_is_exact(spark):
    rows, n = [], 0
    for line in range(40):  # line k on k + 1 sites, twice on the first
        for site in [*range(line + 1), 0]:
            rows.append((n, f"line number {line}", f"s{site}"))
            n += 1
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for sites in (2, 5, 20):
        got = Counter(r.text for r in linededup.dedup(frame, min_sites=sites).collect())
        assert got == {f"line number {k}": (1 if k + 1 >= sites else k + 2) for k in range(40)}


def test_long_lines_have_their_own_threshold(spark):
    rows = []
    for line in range(12):  # line k on k + 1 sites, three times on the first; even ones have 51 words, odd ones 50
        for site in [*range(line + 1), 0, 0]:
            rows.append((len(rows), f"line{line} " + "w " * (50 if line % 2 == 0 else 49), f"s{site}"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for sites, long_sites in ((5, 2), (5, 4), (3, 9)):
        got = Counter(r.text.split()[0] for r in linededup.dedup(frame, sites, long_sites=long_sites).collect())
        assert got == {f"line{k}": (1 if k + 1 >= (sites if k % 2 else long_sites) else k + 3) for k in range(12)}


def test_pipeline_takes_long_lines_of_few_sources(spark):
    docs = _docs(spark, SF_MID)
    sites = defaultdict(set)
    for r in corpus_pipeline.line_stage(spark, docs, SF_MID).collect():
        for line in (r.text or "").split("\n"):
            line = line.strip(" \t\v\f\r")
            if len(WORDS.findall(line.encode())) > 50:
                sites[line].add(r.source)
    assert sites and max(map(len, sites.values())) == 1


def test_line_plan_is_native(spark):
    plan = linededup.dedup(_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# -- quality --------------------------------------------------------------------------------


def _base(text):
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [x for x in text.split(b"\n") if WORDS.search(x)]
    seen, repeats = set(), 0
    for x in lines:
        repeats += x in seen
        seen.add(x)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(text.count(c.encode()) for c in "#*$%&|<>"), repeats, len(covered)


def test_quality_query(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in _docs(spark, SF_MID).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    good = kept = bad = missed = 0
    for r in queries.op10_quality(spark, SF_MID).collect():
        n, chars, symbols, lines, repeats = _base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (r.base_failed and r.kept)
        if n >= 50 and r.doc_id in labels:
            good, kept = good + labels[r.doc_id], kept + (labels[r.doc_id] and r.kept)
            bad, missed = bad + (1 - labels[r.doc_id]), missed + (not labels[r.doc_id] and r.kept)
    assert kept >= 0.99 * good and missed <= 0.05 * bad


def test_references_equal_brute_force(spark):
    docs = _docs(spark)
    refs = quality.references(docs)
    for lang in refs:
        sums, classes, n = Counter(), np.zeros(7), 0
        for r in docs.where(F.col("lang") == lang).collect():
            words = (r.text or "").encode().lower().split()
            if len(words) < 50:
                continue
            n += 1
            for w, c in quality.common_counts(words).items():
                sums[w] += c / len(words)
            raw = np.bincount(quality.TABLE[np.frombuffer(r.text.encode(), np.uint8)], minlength=8)[:7]
            classes += raw / raw.sum()
        common, hist, char = refs[lang]
        assert hist[:-1] == pytest.approx([sums[w] / n for w in common], abs=1e-5) and char == pytest.approx(classes / n, abs=1e-5)
        assert min(sums[w] for w in common) >= max(v for w, v in sums.items() if w not in set(common)) - 1e-3


def test_divergence():
    p, q = np.array([1.0, 0.0]), np.array([0.0, 1.0])
    assert quality.divergence(p, q) == pytest.approx(1) and quality.divergence(p, p) == 0


def test_quality_edges(spark, edge, nothing):
    refs = quality.references(_docs(spark))
    rows = quality.measure(edge, refs).collect()
    assert len(rows) == edge.count() and all(r.base_failed for r in rows if r.n_words < 50)
    kept = quality.keep(edge, refs)
    assert kept.columns == edge.columns and kept.count() == sum(r.kept for r in rows)
    assert quality.references(nothing) == {} and quality.measure(nothing, {}).count() == 0 and quality.keep(nothing, refs).count() == 0
    assert all(r.kept != r.base_failed for r in quality.measure(edge, {}).collect())


def test_rare_language_is_left_to_the_base_rules(spark):
    docs = _docs(spark, SF_MID).select("doc_id", "text", "lang")
    fr = docs.where("lang = 'fr'").orderBy("doc_id").select("doc_id").limit(5)
    rare = docs.join(fr, "doc_id", "left_semi").withColumn("lang", F.lit("oc"))
    mixed = docs.where("lang <> 'fr'").union(rare)
    refs = quality.references(mixed)
    rows = quality.measure(rare, refs).collect()
    assert "oc" not in refs and refs and len(rows) == 5 and any(r.kept for r in rows)
    assert all(r.kept != r.base_failed and r.word_distance is None for r in rows)
    unstated = quality.measure(rare.withColumn("lang", F.lit(None).cast("string")), refs).collect()
    assert all(r.base_failed or r.word_distance is not None for r in unstated)  # null: the nearest reference


def test_copies_do_not_move_the_reference(spark):
    docs = _docs(spark, SF_MID)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    en = docs.where("lang = 'en'").orderBy("doc_id").collect()
    poor = next(r for r in en if labels.get(r.doc_id) == 0 and not quality.judge(r.text.encode(), "en", {}, quality.Rules())[5])
    copies = spark.range(len(en) // 2).select((F.col("id") + 10**6).alias("doc_id"), *[F.lit(poor[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns[1:]])
    junk = copies.select((F.col("doc_id") * 2).alias("doc_id"), F.repeat(F.concat(F.lit("buy now "), F.col("doc_id").cast("string"), F.lit(" ")), 30).alias("text"), *docs.columns[2:])
    alone, crowded = corpus_pipeline.quality_stage(spark, docs, SF_MID), corpus_pipeline.quality_stage(spark, docs.union(copies), SF_MID)
    good = {r.doc_id for r in alone.collect() if labels.get(r.doc_id) == 1}
    assert len(good) > 100 and good <= {r.doc_id for r in crowded.collect()}
    plain, moved = (quality.references(d, distinct=True) for d in (docs, docs.union(copies).union(junk)))
    assert plain.keys() == moved.keys()
    for lang in plain:  # sums of integers: equal to the last bit
        assert plain[lang][0] == moved[lang][0] and all((a == b).all() for a, b in zip(plain[lang][1:], moved[lang][1:]))


@pytest.mark.parametrize("bits", [1 << 15, quality.FILTER_BITS])
def test_distinct_references_equal_those_of_one_row_each(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "FILTER_BITS", bits)
    docs, rules = _docs(spark, SF_MID), quality.Rules()
    rows = {(r.text, r.lang) for r in docs.collect() if not quality.judge((r.text or "").encode(), r.lang, {}, rules)[5]}
    want, got = quality.references(spark.createDataFrame(list(rows), "text string, lang string")), quality.references(docs, distinct=True)
    assert want.keys() == got.keys() and len(got) == 4
    for lang in want:
        assert want[lang][0] == got[lang][0] and all((a == b).all() for a, b in zip(want[lang][1:], got[lang][1:]))


# -- toxicity -------------------------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    docs, labels = _docs(spark, SF_MID), spark.read.parquet(f"{SF_MID}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    model = toxicity.train(docs, labels.where(half == 0))
    rows = toxicity.score(docs, model).join(labels.where(half == 1).select("doc_id", F.col("toxic").alias("label")), "doc_id").collect()
    bad, good = [r for r in rows if r.label], [r for r in rows if not r.label]
    assert np.mean([r.toxic for r in bad]) > 0.5 and np.mean([r.toxic for r in good]) < 0.05
    assert np.mean([r.severity for r in bad]) > 10 * np.mean([r.severity for r in good])
    assert all(0 <= r.severity <= toxicity.GRADES - 1 for r in rows)


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 600)
    lists = [np.array(sorted({int(f) for f in rng.integers(100, 400, 12)} | set(range(g * 3)))) for g in grades]
    model = toxicity.fit(lists, grades, 4, l1=1e-4)
    assert (np.diff(model.thresholds) >= 0).all()
    weight = np.zeros(toxicity.DIMS)
    weight[model.index] = model.weight
    expected = model.reach(np.array([weight[x].sum() for x in lists])).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.95


def test_toxicity_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (8, None), (99, 1), (9, 0), (9, 1)], "doc_id long, toxic int")
    model = toxicity.train(edge, labels)
    assert toxicity.score(edge, model).count() == edge.count() and toxicity.score(nothing, model).count() == 0
    flat = toxicity.train(edge, labels.where("doc_id = 2"))
    assert len(flat.index) == 0 and len({r.p_toxic for r in toxicity.score(edge, flat).collect()}) == 1
    assert len(toxicity.train(nothing, labels).index) == 0


# -- neighbours -----------------------------------------------------------------------------


@pytest.mark.parametrize("sf", [SF_MID, "/root/testdata/sf0.1"])
def test_recall_against_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toArrow()
    at, x = ann.matrix(table["embedding"].combine_chunks())
    ids = np.asarray(table["vec_id"])[at]
    got = defaultdict(list)
    for r in queries.op7_ann(spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    hits = total = 0
    for k in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[k]) ** 2).sum(axis=1))
        d[ids == ids[k]] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        rows = got[int(ids[k])]
        assert [r.rank for r in rows] == list(range(1, 11)) and all(r.score == pytest.approx(d[ids == r.vec_id][0], rel=1e-12) for r in rows)
        assert [(r.score, r.vec_id) for r in rows] == sorted((r.score, r.vec_id) for r in rows)
        hits, total = hits + len(best & {r.vec_id for r in rows}), total + 10
    assert hits >= 0.9 * total


def test_neighbour_edges(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).tolist(), "x") for i in range(1, 900)]
    rows += [(1000 + i, [1.0] * 8, "x") for i in range(300)] + [(0, [1.0] * 8, "x"), (0, [1.0] * 8, "x")]  # ties, a repeated row
    rows += [(2000, None, "x"), (2100, [0.0] * 8, "x"), (2200, [float("nan")] * 8, "x"), (2300, [None] * 8, "x"), (2400, [1.0] * 5, "x"), (None, [1.0] * 8, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part string")
    monkeypatch.setattr(ann, "CELL", 50)
    monkeypatch.setattr(ann, "QUERIES", 3)
    got = defaultdict(list)
    for r in ann.search(frame, F.pmod(frame["vec_id"], F.lit(100)) == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert set(got) == {0, *range(100, 900, 100), 1000, 1100, 1200}
    assert got[0] == list(range(1000, 1010)) and got[1000] == [0, 0, *range(1001, 1009)]
    few = ann.search(frame.where("vec_id between 95 and 101"), frame["vec_id"] == 100).collect()
    assert sorted(r.vec_id for r in few) == [95, 96, 97, 98, 99, 101]
    assert ann.search(frame.where("vec_id > 1999"), frame["vec_id"] > 0).count() == 0
    assert ann.search(frame.where("vec_id = -1"), frame["vec_id"] > 0).count() == 0


def test_partitions_are_balanced():
    x = np.random.default_rng(1).standard_normal((1024, 16))
    part = ann.balanced_parts(ann.neighbours(x, 10), 16)
    assert set(np.bincount(part).tolist()) == {64}


@pytest.mark.parametrize("repeat", [False, True])
def test_few_valid_vectors_in_a_large_table(spark, monkeypatch, repeat):
    """The sample is drawn from vectors that take part, so a few among many others are still found."""
    monkeypatch.setattr(ann, "SAMPLE", 50)
    rng = np.random.default_rng(4)
    good = [(100 * k, rng.normal(size=4).tolist()) for k in range(40)]
    if repeat:  # one vector, many times over: the sample may hold none of its copies
        good = [(100 * (k % 2), [1.0, 2.0, 3.0, 4.0]) for k in range(400)]
    bad = [(7 + k, [[0.0] * 4, [float("nan")] * 4, None, [1.0, None, 1.0, 1.0], [], [float("inf"), 1.0, 1.0, 1.0]][k % 6]) for k in range(1500)]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>")
    got = ann.search(frame, F.pmod(frame["vec_id"], F.lit(100)) == 0, k=5).collect()
    if repeat:
        assert {(r.query_id, r.vec_id) for r in got} == {(0, 100), (100, 0)}
        return
    vectors = dict(good)
    assert len(got) == 5 * 40
    for r in got:
        ranked = sorted((np.linalg.norm(np.array(v) - vectors[r.query_id]), i) for i, v in vectors.items() if i != r.query_id)
        assert ranked[r["rank"] - 1][1] == r.vec_id


def test_fifty_thousand_sources(spark):
    """More sources than the driver's flow would take: targets by aggregates, as the plain rule has them."""
    rng = random.Random(3)
    sizes = {f"s{k:05d}": rng.choice([0, 1, 3, 20, 400]) for k in range(50_000)}
    frame = spark.createDataFrame([(s, s, n) for s, n in sizes.items()] + [("null", None, 7)], "pattern string, source string, size long")
    want = mixing.targets(sizes | {None: 7}, queries.MIX_WEIGHTS)
    got = {r.source: r.target for r in mixing.plan_of_single_sources(frame, queries.MIX_WEIGHTS, 1.5, 2.0).collect()}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-9) for s in want)


def test_mix_of_many_sources(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 13).cast("int")).alias("text"), F.concat(F.lit("d"), F.col("id") % 21_000).alias("source"))
    rows = mixing.mix(docs, queries.MIX_WEIGHTS).collect()
    assert len(rows) == 30_000 and all(r.taken == r.size * r.copies and r.copies <= 2 for r in rows)
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - t) <= max(largest[s] / 2, 1e-6) + 1e-6 for s, t in target.items())
