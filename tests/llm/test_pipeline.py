"""The pipeline from its documents to its last stage."""

import os

import corpus_pipeline
from kerbside.llm.queries import table
from kerbside.sources.scratch import scratch_root

from helpers import least_id, ngram_sets, parts, words


def test_run_applies_every_stage(spark, sf_dir):
    seen = {}

    def watched(name, stage):
        def apply(spark, docs, sf_dir):
            out = stage(spark, docs, sf_dir)
            seen[name] = ([(r.doc_id, r.text) for r in docs.collect()], docs.columns)
            return out
        return apply

    before = set(os.listdir(scratch_root(spark)))
    stages = corpus_pipeline.STAGES
    try:
        corpus_pipeline.STAGES = [(name, watched(name, stage)) for name, stage in stages]
        pieces = corpus_pipeline.run(spark, sf_dir).collect()
    finally:
        corpus_pipeline.STAGES = stages
    columns = table(spark, sf_dir, "documents").columns
    assert [c for _, c in seen.values()] == [columns] * 5
    rows = [seen[name][0] for name, _ in stages]
    # Rejected documents are gone; every kept one has 50 words.
    assert 0 < len(rows[1]) < len(rows[0]) and set(rows[1]) <= set(rows[0])
    assert min(len(words(t)) for _, t in rows[1]) >= 50
    # Of each group of near copies, found by brute force, the smallest id stays.
    sets = ngram_sets(rows[1])
    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = parts(len(sets), links)
    want = {least_id([rows[1][j][0] for j in range(len(sets)) if root[j] == r]) for r in set(root)}
    assert {i for i, _ in rows[2]} == want and len(rows[2]) == len(want)
    # Later stages keep the documents; words only go, and secrets are replaced.
    assert {i for i, _ in rows[3]} == {i for i, _ in rows[4]} == want
    before_cut, after_cut = dict(rows[2]), dict(rows[3])
    assert all(len(words(after_cut[i])) <= len(words(before_cut[i])) for i in want)
    # The pieces of each document are gapless and whole.
    held = {}
    for r in pieces:
        held.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert set(held) == want
    for spans in held.values():
        spans.sort()
        assert [s[0] for s in spans] == [sum(x[1] for x in spans[:k]) for k in range(len(spans))]
        assert sum(s[1] for s in spans) == spans[0][2]
    # Nothing but the outputs of the stages and the packing's own tables stays behind.
    left = set(os.listdir(scratch_root(spark))) - before
    assert not [n for n in left if n.startswith("block-")]
    assert {n.rsplit("-", 1)[0] for n in left} >= {"quality-rules", "n-gram-join", "substring-dedup", "secret-scan"}
