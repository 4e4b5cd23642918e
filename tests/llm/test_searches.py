"""Searches and the source audit against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kerbside.llm import divergence, ranked_search, top_vectors

from helpers import corpus, frame, same

ALNUM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOWER))


# --- ranked search -----------------------------------------------------------------------

def brute_search(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort()
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(scored[:k], 1)]
    return out


def items_frame(spark, items):
    return spark.createDataFrame([(*i, "a", 1) for i in items], "item_id long, text string, doc_id string, score int")


def searched(spark, rows, items, k=5):
    return ranked_search.ranked_search(frame(spark, rows).repartition(3), items_frame(spark, items), k).collect()


ITEMS = [(1, None), (2, ""), (3, "nothing-of-this"), (None, "one two"), (7, "ONE one Two AKIA"), (7, "ONE one Two AKIA")]


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("shard, terms_per_block", [(20_000, 16_384), (64, 60)])
def test_ranked_search(spark, seed, shard, terms_per_block, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", terms_per_block)
    rows = corpus(seed, 80)
    items = ITEMS + [(20 + i, " ".join((rows[i][1] or "").split()[:25])) for i in range(0, 40, 5)]
    same(searched(spark, rows, items), brute_search(rows, items, 5))


def test_ranked_search_of_ties_copies_and_a_long_text(spark):
    rng = random.Random(3)
    pool = [f"t{i}" for i in range(30)]
    rows = [(i, "same words here") for i in range(900, 0, -1)]
    rows += [(2000 + i, " ".join(rng.choices(pool, k=rng.randint(1, 30)))) for i in range(300)]
    rows += [(5000, " ".join(rng.choices(pool, k=200_000))), (5001, "x" * 2_000_000), (None, "same words here"),
             (None, None), (4, ""), (5, "same words here")]
    items = [(1, "same words"), (2, " ".join(pool[:12])), (3, "x" * 2_000_000)]
    same(searched(spark, rows, items, 7), brute_search(rows, items, 7))


def test_ranked_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a b")]) == []
    assert searched(spark, [(1, "a b"), (2, None)], []) == []
    assert searched(spark, [(1, None)], [(1, "a b")]) == []


def random_shard(rng, n_docs, n_terms):
    n = rng.integers(50, 400, n_docs)
    lists = [np.sort(rng.choice(n_terms, rng.integers(1, n_terms), replace=False)) for _ in range(n_docs)]
    edges = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    found = np.concatenate(lists)
    return ranked_search.Shard(n, edges, found, rng.geometric(0.3, len(found)), rng.integers(1, 9000, n_terms),
                               n_docs, int(n.sum()))


def test_best_positions_stop_early_and_only_strictly_below_the_kth():
    rng = np.random.default_rng(5)
    shard = random_shard(rng, 4000, 12)
    top = ranked_search.Top(10)
    met = ranked_search.best_position_search(shard, np.array([1, 4]), top, np.arange(4000), np.zeros(4000, bool))
    score = np.zeros(4000, np.int64)
    for t in (1, 4):
        part = slice(shard.start[t], shard.start[t + 1])
        score[shard.doc[part]] += shard.impact[part]
    best = np.lexsort((np.arange(4000), -score))[:10]
    assert top.doc_id.tolist() == best.tolist() and top.score.tolist() == score[best].tolist()
    assert met < 2000
    # A later shard that cannot reach the k-th score is not read at all ...
    top.score = top.score + score.max()
    assert ranked_search.best_position_search(shard, np.array([1, 4]), top, np.arange(4000), np.zeros(4000, bool)) == 0
    # ... one whose bound equals it is: an equal score with a smaller id goes first.
    equal = ranked_search.Shard(np.full(3, 10), np.arange(4), np.zeros(3, int), np.ones(3, int), np.array([500]), 3, 30)
    top = ranked_search.Top(1)
    top.add(equal.impact[:1], np.array([9]), np.zeros(1, bool))
    ranked_search.best_position_search(equal, np.array([0]), top, np.array([5, 3, 4]), np.zeros(3, bool))
    assert top.doc_id.tolist() == [3]


# --- vectors -----------------------------------------------------------------------------

def brute_vectors(rows, k, every):
    whole = []
    for i, (vec_id, values) in enumerate(rows):
        if values is not None and all(v is not None and math.isfinite(v) for v in values):
            whole.append((i, vec_id, [math.floor(256 * v) for v in values]))
    out = []
    for i, query_id, a in whole:
        if query_id is None or query_id % every:
            continue
        scored = []
        for j, vec_id, b in whole:
            if j != i:
                score = sum(x * y for x, y in zip(a, b))
                score = max(-top_vectors.EDGE, min(top_vectors.EDGE, score))
                scored.append((-score, vec_id is None, vec_id or 0, vec_id))
        scored.sort()
        out += [(query_id, r, s[3], -s[0]) for r, s in enumerate(scored[:k], 1)]
    return out


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows],
                                 "vec_id long, embedding array<double>, row long, block string, score int, rank int")


def vector_rows(seed, n, dims):
    rng = np.random.default_rng(seed)
    rows = [(int(i), np.round(rng.normal(0, 0.2, dims), 3).tolist()) for i in rng.permutation(n)]
    hot = rows[0][1]
    rows += [(n + i, hot) for i in range(n // 2)]
    rows += [(0, hot), (50, [0.0] * dims), (None, hot), (100, None), (101, [1.0, None]), (102, [float("nan")] * dims),
             (104, [float("inf")] + [0.0]), (150, []), (151, [0.5]), (200, [-0.0] * (dims + 3)), rows[3]]
    return rows


@pytest.mark.parametrize("rows_per_block, bins", [(8_192, 1_024), (7, 4)])
def test_top_vectors(spark, rows_per_block, bins, monkeypatch):
    monkeypatch.setattr(top_vectors, "BLOCK_ROWS", rows_per_block)
    monkeypatch.setattr(top_vectors, "BLOCK_QUERIES", min(rows_per_block, 1_024))
    rows = vector_rows(1, 120, 6)
    got = top_vectors.top_vectors(vector_frame(spark, rows).repartition(3), 5, 10, bins)
    same(got.collect(), brute_vectors(rows, 5, 10))


def test_top_vectors_of_few_or_no_rows(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [0.5])], [(1, [0.5]), (3, [0.5])], [(0, None)]):
        same(top_vectors.top_vectors(vector_frame(spark, rows)).collect(), brute_vectors(rows, 5, 50))


def test_top_vectors_beyond_exact_doubles(spark):
    big = [1e12, -3.0, 1e-3]
    rows = [(0, big), (50, [1e300, 1.0]), (1, [1e12, 2.0, 5.0]), (2, [-1e12, 7.0]), (3, [1e5, 1e5, 1e5]), (4, [0.1])]
    same(top_vectors.top_vectors(vector_frame(spark, rows), 3).collect(), brute_vectors(rows, 3, 50))


def test_scores_that_leave_a_task_are_counts(spark, monkeypatch):
    """A pass gives at most k steps per query and block of rows, however many rows score alike."""
    rows = [(i, [1.0, 0.5]) for i in range(5_000)]
    blocks = top_vectors.row_blocks(vector_frame(spark, rows).coalesce(1))
    assert blocks.count() == 1
    given = []
    real = top_vectors._refined
    monkeypatch.setattr(top_vectors, "_refined", lambda s, c, k, b: (given.append(c.count()), real(s, c, k, b))[1])
    got = top_vectors.top_vectors(vector_frame(spark, rows).coalesce(1), 3)
    same(got.collect(), brute_vectors(rows[:8], 3, 50)[:0] + [
        (q, r, v, 256 * 256 + 128 * 128) for q in range(0, 5_000, 50)
        for r, v in enumerate([x for x in range(4) if x != q][:3], 1)])
    assert given and max(given) <= 3 * 100


# --- source audit ------------------------------------------------------------------------

def brute_audit(rows, min_docs, top):
    docs = [(lang or "", source or "", Counter(terms(text, LETTERS))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = {t for t in df if df[t] >= min_docs}
        count = {s: Counter() for s in {d[1] for d in own}}
        for _, source, c in own:
            count[source].update({t: n for t, n in c.items() if t in kept})

        def share(c, t):
            return 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        whole = sum(count.values(), Counter())
        for source, c in count.items():
            pairs = [(-sum(abs(share(c, t) - share(o, t)) for t in kept), item.encode(), item)
                     for item, o in count.items() if item != source]
            words = [(share(whole, t) - share(c, t), t.encode(), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:top])):
                out += [(lang, source, part, item, -v, r) for r, (v, _, item) in enumerate(found, 1)]
    return out


def audit_frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, 2, "x", "y", 5, 6) for r in rows],
        "text string, lang string, source string, n long, n_docs long, term string, part string, block long, kept long")


def audit_rows(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcDEFéß漢") for _ in range(rng.randint(1, 22))) for _ in range(60)]
    pool += ["sameprefix" + p for p in pool[:20]] + ["sameprefix", "sameprefixsameprefix"]
    rows = []
    for i in range(150):
        words = rng.choices(pool, k=rng.randint(0, 40))
        rows.append((rng.choice([" ", "-", "1", "\n"]).join(words), rng.choice(["en", "de", None, ""]),
                     rng.choice(["web", "web", "web", "news", "", None, "wikí"])))
    return rows + [(None, "fr", "a"), ("", "fr", "b"), ("solo", "xx", "one"), rows[0], rows[0], (None, None, None)]


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("size, cells", [(4 << 20, 1 << 18), (300, 40)])
def test_audit(spark, seed, size, cells, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", size)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    rows = audit_rows(seed)
    same(divergence.audit(audit_frame(spark, rows).repartition(3), 5, 12).collect(), brute_audit(rows, 5, 12))


def test_audit_of_an_empty_table_and_a_long_text(spark):
    assert divergence.audit(audit_frame(spark, [])).collect() == []
    rows = [("x" * 3_000_000 + " b " + "a b " * 300_000, "en", "long"), ("a b c", "en", "short"), ("b", "en", "other")]
    same(divergence.audit(audit_frame(spark, rows), 2).collect(), brute_audit(rows, 2, 50))


def test_pointers_are_sorted_like_the_terms():
    rng = random.Random(4)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 40))).encode() for _ in range(500)]
    words += [b"a" * n for n in (7, 8, 9, 15, 16, 17)] * 3
    data = np.frombuffer(b" ".join(words), np.uint8)
    start, end = divergence.word_bounds(data, np.array([0, len(data)]))
    order, fresh = divergence.pointer_sort(data, start, end)
    got = [bytes(data[start[i]:end[i]]) for i in order]
    assert got == sorted(words)
    assert fresh.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


