"""Small corpora and brute-force versions for the corpus operators."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = "row long, doc long, node long, pair string, found string, base string, spans string, packed string"


def words(text):
    return WORD.findall(text or "")


def corpus(seed=0, n=40):
    """Documents with copies, near copies, shared passages, secrets and odd rows."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage = [rng.choice(pool) for _ in range(70)]
    texts = []
    for i in range(n):
        body = [rng.choice(pool) for _ in range(rng.randint(1, 260))]
        if i % 4 == 1:
            at = rng.randint(0, len(body))
            body[at:at] = passage
        if i % 5 == 2 and texts:
            body = words(texts[rng.randrange(len(texts))])
            if len(body) > 60:
                body[rng.randrange(len(body))] = "changed"
        text = " ".join(body)
        if i % 6 == 3:
            text = text.replace(" ", "\n", 3) + '  token = "' + "%032x" % rng.getrandbits(128) + '"'
        texts.append(text)
    texts += [None, "", " \n\t ", texts[1], texts[1], "one", "one two three four", "AKIA" + "Z" * 20]
    rows = [(rng.randrange(10_000) * 100 + i, t) for i, t in enumerate(texts)]
    rows.append(rows[3])
    rows.append((None, texts[2]))
    return rows


def frame(spark, rows, clashes=True):
    if not clashes:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(*r, 1, 2, 3, "a", "b", "c", "d", "e") for r in rows],
                                 f"doc_id long, text string, {CLASHES}")


def ngram_sets(rows, n=5):
    found = []
    for _, text in rows:
        w = words(text)
        found.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n
                     else frozenset([tuple(w)] if w else []))
    return found


def parts(n, links):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def least_id(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def kept_words(rows, length=50):
    """(n_words, n_removed, sha256 of what stays) per row."""
    order = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    for key, (_, text) in zip(order, rows):
        w = words(text)
        for k in range(len(w) - length + 1):
            window = tuple(w[k:k + length])
            first[window] = min(first.get(window, float("inf")), key)
    out = []
    for key, (_, text) in zip(order, rows):
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k:k + length])] < key:
                gone[k:k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def same(got, want):
    def order(rows):
        return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert order([tuple(r) for r in got]) == order([tuple(r) for r in want])
