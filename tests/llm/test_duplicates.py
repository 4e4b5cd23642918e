"""Joins and deduplication against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm import common, fm_index, ngram_join, substrings, vectors

from helpers import corpus, frame, kept_words, least_id, ngram_sets, parts, same


def linked_pairs(rows, threshold=0.8):
    sets = ngram_sets(rows)
    return [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
            and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]


def expected_classes(rows):
    links = linked_pairs(rows)
    root = parts(len(rows), links)
    count = [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    sets = ngram_sets(rows)
    return [(rows[i][0], len(sets[i]), sum(s == sets[i] for s in sets) if sets[i] else 1, count[i],
             least_id([rows[j][0] for j in range(len(rows)) if root[j] == root[i]])) for i in range(len(rows))]


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("block", [ngram_join.BLOCK_NGRAMS, 300])
def test_ngram_join(spark, seed, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_NGRAMS", block)
    rows = corpus(seed, 60)
    got = ngram_join.near_duplicates(frame(spark, rows)).select(
        "doc_id", "n_ngrams", "copies", "n_links", "class_id")
    same(got.collect(), expected_classes(rows))


def test_ngram_join_of_a_hot_group_split_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_NGRAMS", 2_000)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(120):
        body = list(base)
        body[rng.randrange(100)] = f"x{i % 40}"
        rows.append((i, " ".join(body)))
    got = ngram_join.near_duplicates(frame(spark, rows)).select("doc_id", "n_ngrams", "copies", "n_links", "class_id")
    same(got.collect(), expected_classes(rows))



def test_ngram_join_bounds_the_documents_of_a_comparison(spark, monkeypatch):
    most = []

    def block_pairs(*args):
        pairs = common.block_pairs(*args)
        most.append(pairs.groupBy("pair").count().agg({"count": "max"}).first()[0])
        return pairs

    monkeypatch.setattr(ngram_join, "block_pairs", block_pairs)
    shared = " ".join(f"w{i}" for i in range(53))
    rows = [(i, f"{shared} x{i}") for i in range(3_000)]
    got = ngram_join.near_duplicates(frame(spark, rows)).select("doc_id", "n_ngrams", "copies", "n_links", "class_id")
    same(got.collect(), [(i, 50, 1, 2_999, 0) for i in range(3_000)])
    assert most[0] < 2.3 * ngram_join.BLOCK_DOCS


def test_ngram_join_fetches_one_text_of_a_repeated_row(spark, monkeypatch):
    """Rows that share id and text are one node; a comparison gets its text once."""
    got_rows = []
    real = ngram_join._compare

    def _compare(*args):
        def body(batches):
            batches = list(batches)
            seen = sum(b.num_rows for b in batches)
            assert seen < 100, seen
            return real(*args)(iter(batches))
        got_rows.append(1)
        return body

    monkeypatch.setattr(ngram_join, "_compare", _compare)
    words = [f"w{i}" for i in range(80)]
    rows = [(7, " ".join(words))] * 10_000 + [(None, " ".join(words))] * 50 + [(3, " ".join([*words[:79], "other"]))]
    got = ngram_join.near_duplicates(frame(spark, rows)).groupBy("doc_id", "copies", "n_links", "class_id").count()
    same(got.collect(), [(7, 10_050, 10_050, 3, 10_000), (None, 10_050, 10_050, 3, 50), (3, 1, 10_050, 3, 1)])
    assert got_rows


def test_representatives(spark):
    rows = corpus(3, 60)
    kept = ngram_join.representatives(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    root = parts(len(rows), linked_pairs(rows))
    sets = ngram_sets(rows)
    want = []
    for r in set(root):
        members = [rows[i] for i in range(len(rows)) if root[i] == r]
        want.append(min(members, key=lambda m: (m[0] is None, m[0])) if sets[r] else members[0])
    same([(r.doc_id, r.text) for r in kept.collect()], want)


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999 and bands * rows <= 256
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999, 8)


def test_fm_index_finds_every_window():
    rng = random.Random(1)
    for _ in range(120):
        symbols, length = rng.choice([2, 3, 5, 30]), rng.choice([2, 3, 5, 7])
        docs = [[rng.randint(1, symbols - 1) for _ in range(rng.randint(1, 40))] for _ in range(rng.randint(1, 6))]
        queries = [[rng.randint(1, symbols + 1) for _ in range(rng.randint(0, 40))] for _ in range(4)]
        queries += [docs[0], docs[0][3:] + docs[-1][:9]]
        text = [x for d in docs for x in [*d, 0]]
        owner = np.repeat(np.array([rng.randint(0, 50) for _ in docs]), [len(d) + 1 for d in docs])
        index = fm_index.FMIndex(np.array(text), symbols, length, owner)
        query, start, least = fm_index.matches(index, [np.array(q, np.int64) for q in queries])
        there: dict[tuple, int] = {}
        for i in range(len(text) - length + 1):
            key = tuple(text[i:i + length])
            there[key] = min(there.get(key, 99), int(owner[i]))
        assert sorted(zip(query.tolist(), start.tolist())) == [
            (q, i) for q, x in enumerate(queries) for i in range(len(x) - length + 1)
            if tuple(x[i:i + length]) in there]
        assert all(there[tuple(queries[q][s:s + length])] == o for q, s, o in zip(query, start, least))


def test_index_keeps_no_suffix_order():
    """Bytes that stay in an index: far fewer than one 64-bit number a symbol."""
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 4_000, 100_000), 0)
    index = fm_index.FMIndex(text, 4_000, 50, np.zeros(len(text), np.int64))
    bits = [*index.bits, index.full.bits, index.shorter.bits]
    assert sum(b.words.nbytes + b.before.nbytes for b in bits) < 3 * len(text)
    assert not any(isinstance(v, np.ndarray) and len(v) == len(text) and v.itemsize == 8 and v is not index.least
                   for v in vars(index).values())


def test_removal_comes_from_the_backward_search(monkeypatch):
    """Fragments that differ, with windows in common: only the search can tell that they repeat,
    and a fragment streams past earlier ones alone."""
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(70)]
    docs = [[f"a{d}x{i}" for i in range(rng.randint(3, 9))] + shared + [f"b{d}x{i}" for i in range(5)] for d in range(9)]
    seen = []

    def shard(numbers):
        held = {"anchor": [7] * len(docs), "digest": list(range(len(docs))), "least": numbers,
                "words": [" ".join(d).encode() for d in docs]}
        batch = pa.RecordBatch.from_pydict(held)
        out = list(substrings._search(50, 10**6)(iter([batch])))
        return {(r["digest"], w): r["first_doc"] for b in out for r in b.to_pylist()
                for w in range(r["from_window"], r["to_window"] + 1)}

    real = substrings.matches
    monkeypatch.setattr(substrings, "matches", lambda i, q: seen.append((i.n, len(q))) or real(i, q))
    numbers = rng.sample(range(100), len(docs))
    where: dict[tuple, int] = {}
    for d, n in zip(docs, numbers):
        for i in range(len(d) - 49):
            key = tuple(d[i:i + 50])
            where[key] = min(where.get(key, n), n)
    want = {(j, i): where[tuple(d[i:i + 50])] for j, d in enumerate(docs) for i in range(len(d) - 49)}
    earlier = {k for k, n in want.items() if n < numbers[k[0]]}
    assert {k for k, n in shard(numbers).items() if n < numbers[k[0]]} == earlier and earlier
    # The shared windows are found in the first passes and drop out of the later ones.
    assert 1 <= len(seen) <= 4 and all(n < 90 * len(docs) / 2 for n, _ in seen) and seen[-1] <= seen[0]
    monkeypatch.setattr(substrings, "matches", lambda i, q: (np.zeros(0, np.int64),) * 3)
    assert not {k for k, n in shard(numbers).items() if n < numbers[k[0]]}


def test_shards_by_brute_force():
    """Few words and many fragments of one anchor: k-grams are shared where windows aren't."""
    rng = random.Random(9)
    for _ in range(60):
        length = rng.choice([3, 9, 20])
        base = [f"w{rng.randint(0, 3)}" for _ in range(length + 30)]
        texts = []
        for _ in range(rng.randint(1, 40)):
            a = rng.randint(0, 20)
            t = base[a:a + length + rng.randint(0, 10)]
            if rng.random() < 0.5:
                t[rng.randrange(len(t))] = f"w{rng.randint(0, 3)}"
            texts.append(t)
        least = [rng.randint(0, 30) for _ in texts]
        # Equal windows have equal anchors, so each anchor has words of its own here.
        anchor = sorted(rng.randint(0, 2) for _ in texts)
        texts = [[f"{w}of{a}" for w in t] for t, a in zip(texts, anchor)]
        batch = pa.RecordBatch.from_pydict({"anchor": anchor, "digest": list(range(len(texts))), "least": least,
                                            "words": [" ".join(t).encode() for t in texts]})
        got = {(r["digest"], w) for b in substrings._search(length, rng.choice([1, 200, 10**6]))(iter([batch]))
               for r in b.to_pylist() for w in range(r["from_window"], r["to_window"] + 1)
               if r["first_doc"] < least[r["digest"]]}
        low: dict[tuple, int] = {}
        keys = {(j, i): (anchor[j], *t[i:i + length]) for j, t in enumerate(texts) for i in range(len(t) - length + 1)}
        for (j, _), key in keys.items():
            low[key] = min(low.get(key, 99), least[j])
        assert got == {(j, i) for (j, i), key in keys.items() if low[key] < least[j]}


@pytest.mark.parametrize("length, shard_words, crowd", [
    (50, 400_000, 2_000), (50, 500, 1), (8, 300, 2_000), (8, 10_000, 1), (3, 10_000, 2)])
def test_substring_dedup(spark, length, shard_words, crowd):
    rows = corpus(4, 50)
    got = substrings.judged(frame(spark, rows), length, shard_words, crowd).collect()
    same(got, [(i, *k) for (i, _), k in zip(rows, kept_words(rows, length))])


def test_shortened_keeps_rows_columns_and_whole_texts(spark):
    rows = corpus(5, 50)
    docs = frame(spark, rows)
    cut = substrings.shortened(docs)
    assert cut.schema == docs.schema
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in cut.collect()))
    assert len(got) == len(rows)
    whole = {(i, t or "") for (i, t), k in zip(rows, kept_words(rows)) if k[1] == 0}
    assert {(None if none else i, t) for none, i, t in got} >= whole


def vector_rows(n=60, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, dims))
    rows = []
    for i in range(n):
        v = centres[i % 5] + rng.standard_normal(dims) * [0.02, 0.08, 0.12, 1.0][i % 4]
        rows.append((1000 - 7 * i, [float(x) for x in v.astype(np.float32)], int(i % 3) if i % 10 else None))
    rows += [(2000, rows[1][1], rows[1][2]), (2001, [2 * x for x in rows[1][1]], rows[1][2]), (2002, None, 1),
             (2003, [0.0] * dims, 1), (2004, [float("nan")] * dims, 1), (2005, [None] * dims, 1), (2006, [], 1),
             (2007, rows[1][1][:8], rows[1][2]), (None, rows[1][1], rows[1][2]), rows[1]]
    return rows


def vector_truth(rows, threshold=0.98):
    def usable(r):
        return (r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]))
    links = []
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a], rows[b]
            if usable(x) and usable(y) and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, v = np.array(x[1]), np.array(y[1])
                if u @ v / np.sqrt((u @ u) * (v @ v)) >= threshold:
                    links.append((a, b))
    root = parts(len(rows), links)
    out = []
    for i, r in enumerate(rows):
        least = least_id([rows[j][0] for j in range(len(rows)) if root[j] == root[i]])
        out.append((r[0], sum(i in pair for pair in links), least, r[0] is not None and r[0] == least))
    return out


@pytest.mark.parametrize("block", [vectors.BLOCK_VECTORS, 4])
@pytest.mark.parametrize("seed", [0, 1])
def test_vectors(spark, seed, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_VECTORS", block)
    rows = vector_rows(seed=seed)
    got = vectors.near_duplicates(spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, row int, unit string"))
    same(got.collect(), vector_truth(rows))


def test_hadamard():
    x = np.random.default_rng(0).standard_normal((5, 16))
    y = vectors.hadamard(x) / 4
    assert np.allclose(vectors.hadamard(y) / 4, x) and np.allclose((x ** 2).sum(1), (y ** 2).sum(1))


def test_components_of_a_long_chain(spark):
    chain = spark.range(60).selectExpr("id * 7 % 61 AS a", "(id + 1) * 7 % 61 AS b")
    got = dict((r.node, r.root) for r in common.components(chain).collect())
    ids = sorted({x * 7 % 61 for x in range(61)})
    assert got == {i: ids[0] for i in ids if i != ids[0]}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert ngram_join.near_duplicates(none).count() == 0
    assert ngram_join.representatives(none).count() == 0
    assert substrings.judged(none).count() == 0
    assert substrings.shortened(none).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame(
        [], "vec_id long, embedding array<float>, label int")).count() == 0
