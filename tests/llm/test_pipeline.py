"""The corpus pipeline, stage by stage, against brute force."""

import hashlib

import duckdb
import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import quality
from tessera.llm.common import stored
from tessera.llm.linededup import REPORT_SQL
from tessera.llm.queries import MIX_WEIGHTS, WORD_BPE
from tests.conftest import SF_SMALL
from tests.llm.conftest import CLASHES
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_every_stage(spark, tmp_path):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), "test-stage")
        seen.append(docs)
    assert [s.columns for s in seen[:-1]] == [documents.columns] * 4
    rules, lines, near, mix, encoded = [s.toPandas() for s in seen]

    refs = quality.references(documents, distinct=True)  # as the stage has it
    want = {r.doc_id for r in documents.collect() if quality.judge((r.text or "").encode(), r.lang, refs, quality.Rules())[-1]}
    assert set(rules.doc_id) == want

    seen[0].write.parquet(str(tmp_path / "rules"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/rules/*.parquet')")
    report = con.execute(REPORT_SQL).df()
    gone = set(report[(report.n_removed > 0) & (report.n_removed == report.n_lines)].doc_id)
    assert set(lines.doc_id) == want - gone and (lines.n_chars == lines.text.str.len()).all()

    prints = {r.doc_id: plain_fingerprint(r.text) for r in lines.itertuples()}
    classes = plain_components(prints.values())
    least = {}
    for i, f in prints.items():
        least[classes[f]] = min(least.get(classes[f], i), i)
    assert set(near.doc_id) == set(least.values()) and len(near) == len(least)

    assert set(mix.doc_id) <= set(near.doc_id) and mix.doc_id.value_counts().max() <= 2
    size = near.assign(n=near.text.str.split().str.len()).groupby("source").n.sum()
    taken = mix.assign(n=mix.text.str.split().str.len()).groupby("source").n.sum()
    from tessera.llm.mixing import targets

    for s, t in targets({s: int(size[s]) for s in sorted(size.index)}, MIX_WEIGHTS).items():
        assert abs(taken.get(s, 0) - t) <= max(0.05 * t, near[near.source == s].text.str.split().str.len().max() / 2)

    library, texts = Tokenizer.from_file(WORD_BPE), dict(zip(mix.doc_id, mix.text))
    assert sorted(encoded.doc_id) == sorted(mix.doc_id)
    decoded = {r.doc_id: r.decoded_sha256 for r in encoded.itertuples()}
    assert all(decoded[i] == hashlib.sha256(library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False).encode()).hexdigest() for i, t in texts.items())
    assert all(np.array_equal(r.ids, library.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in encoded.itertuples())


def test_edge_tables(spark, edge, nothing):
    for docs in (edge, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF_SMALL), "test-stage")
            assert docs.columns == edge.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()
    for _, stage in corpus_pipeline.STAGES[1:-1]:  # stages after the rules take such rows too
        kept = stage(spark, edge, SF_SMALL)
        assert kept.columns == edge.columns
        assert {r[name] for r in kept.collect() for name in CLASHES} <= {"x"}  # no user column is written over
