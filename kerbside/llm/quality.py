"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Rules are conjunctions, so their order changes the cost but never the verdict. A bounded sample
gives each rule's cost and the rows it rejects; rules then run by rejections per cost, and a row
leaves the chain at the first rule it fails.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# White space that ends words, characters that count as symbols.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SYMBOL_CLASS = "[#*$%&|<>]"

#: Rows that the order of the rules is judged on. The verdict doesn't depend on it.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000


def words(text: Column) -> Column:
    """Words of a text: runs without ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def word_chars(found: Column) -> Column:
    return F.length(F.array_join(found, "")).cast("long")


def symbols(text: Column) -> Column:
    plain = F.coalesce(text, F.lit(""))
    return (F.length(plain) - F.length(F.regexp_replace(plain, SYMBOL_CLASS, ""))).cast("long")


def capitals(text: Column) -> Column:
    plain = F.coalesce(text, F.lit(""))
    return (F.length(plain) - F.length(F.regexp_replace(plain, "[A-Z]", ""))).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda line: F.length(F.trim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(found: Column, width: int = 3) -> Column:
    """Words covered by windows of ``width`` words that occur twice or more in the text.

    Windows become (hash, place) pairs; after a sort, a pair belongs to a repeated window if it
    has a neighbour with the same hash. The places, sorted, cover ``width`` words each, less
    what the next one covers too.
    """
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - width),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    def starts(pairs: Column) -> Column:
        marked = F.filter(pairs, lambda p, k: F.coalesce(p["h"] == F.get(pairs, k - 1)["h"], F.lit(False))
                          | F.coalesce(p["h"] == F.get(pairs, k + 1)["h"], F.lit(False)))
        return F.sort_array(F.transform(marked, lambda p: p["i"]))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.aggregate(
            bound(pairs, starts), F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(width), i - a["last"])).alias("n"),
                                  i.alias("last")),
            lambda a: a["n"])

    counted = bound(bound(found, hashes),
                    lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(found) <= width, 0).otherwise(counted).cast("long")


@dataclass(frozen=True)
class Rule:
    """``passes`` is an expression over ``text`` and ``found`` (its words)."""
    name: str
    passes: Column


#: Figures by the name that rules use for them, from a text and its words.
FIGURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, found: F.size(found).cast("long"),
    "word_chars": lambda text, found: word_chars(found),
    "n_symbols": lambda text, found: symbols(text),
    "n_dup_lines": lambda text, found: duplicate_lines(text),
    "n_repeat_words": lambda text, found: repeated_words(found),
    "n_lines": lambda text, found: F.size(F.split(F.coalesce(text, F.lit("")), "\n")).cast("long"),
    "n_capitals": lambda text, found: capitals(text),
}


#: Figures that the result lists.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rules(figure: Callable[[str], Column], min_words: int = 50, max_repeat_pct: int = 50,
          min_mean_chars: int = 2, max_mean_chars: int = 20, max_symbols_pct: int = 30,
          min_dup_lines: int = 3, max_dup_lines_pct: int = 30, max_capitals_pct: int = 50) -> list[Rule]:
    """The default rules over figures; the first two are the base. Integers only."""
    n = figure("n_words")
    return [
        Rule("min_words", n >= min_words),
        Rule("repeats", 100 * figure("n_repeat_words") <= max_repeat_pct * n),
        Rule("mean_length", (figure("word_chars") >= min_mean_chars * n)
             & (figure("word_chars") <= max_mean_chars * n)),
        Rule("symbols", 100 * figure("n_symbols") <= max_symbols_pct * n),
        Rule("dup_lines", (figure("n_dup_lines") < min_dup_lines)
             | (100 * figure("n_dup_lines") <= max_dup_lines_pct * figure("n_lines"))),
        Rule("capitals", 100 * figure("n_capitals") <= max_capitals_pct * figure("word_chars")),
    ]


def on_text(name: str) -> Column:
    """A figure worked out where a rule needs it, from columns ``text`` and ``found``."""
    return FIGURES[name](F.col("text"), F.col("found"))


def _with_words(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"text": text, "found": words(text)})


def sampled(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample_rows`` texts chosen over all rows by a hash of the row, fetched once (of
    each at most ``SAMPLE_CHARS`` characters, so the driver holds a bounded amount)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    every = max(1, docs.count() // sample_rows)
    others = [F.col(f"`{c}`") for c, kind in docs.dtypes if c != "text" and "map<" not in kind]
    chosen = docs.where(F.pmod(F.xxhash64(F.length(text), *others), F.lit(every)) == 0) if every > 1 else docs
    rows = [(r.text,) for r in chosen.select(F.substring(text, 1, SAMPLE_CHARS).alias("text")).head(2 * sample_rows)]
    return docs.sparkSession.createDataFrame(rows, "text string")


def costs(sample: DataFrame, chosen: list[Rule], repeats: int = 20) -> dict[str, float]:
    """Relative cost of each rule: its time over the sample, many times in one job, less that of
    a job without a rule. Powers of two, so that noise in the clock doesn't change an order."""
    often = _with_words(sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("_turn")))

    def seconds(passes: Column) -> float:
        taken = []
        for _ in range(2):  # the first run compiles
            start = time.perf_counter()
            often.agg(F.count_if(passes)).collect()
            taken.append(time.perf_counter() - start)
        return taken[-1]

    idle = seconds(F.size("found") >= 0)
    spent = {rule.name: max(seconds(rule.passes) - idle, 1e-3) for rule in chosen}
    return {name: 2.0 ** round(math.log2(t / 1e-3)) for name, t in spent.items()}


def greedy(passed: list[tuple[bool, ...]], chosen: list[Rule], cost: dict[str, float]) -> list[Rule]:
    """Rules by rejections per cost, each judged on the rows that the earlier ones let pass; of
    equals, the cheaper first, then by name."""
    left, rest, order = passed, list(enumerate(chosen)), []
    while rest:
        def worth(entry: tuple[int, Rule]) -> tuple:
            i, rule = entry
            return -sum(not row[i] for row in left) / cost[rule.name], cost[rule.name], rule.name

        best = min(rest, key=worth)
        rest.remove(best)
        order.append(best[1])
        left = [row for row in left if row[best[0]]]
    return order


def ordered(docs: DataFrame, chosen: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order of the cascade, as a sample of the rows suggests it. The
    order changes the cost, never a verdict."""
    sample = sampled(docs, sample_rows)
    rows = _with_words(sample).select(*[F.coalesce(r.passes, F.lit(False)).alias(r.name) for r in chosen]).collect()
    return greedy([tuple(r) for r in rows], chosen, costs(sample, chosen))


def verdict(chosen: list[Rule]) -> Column:
    """One expression that stops at the first failing rule."""
    result = F.lit(True)
    for rule in reversed(chosen):
        result = F.when(rule.passes, result).otherwise(F.lit(False))
    return result


def accepted(docs: DataFrame, **limits: int) -> DataFrame:
    """Rows of ``docs`` (with a ``text`` column, others kept) that pass every rule.

    A null text is empty. Each row is judged on its own: repeated rows share their fate.
    """
    chosen = [r.name for r in ordered(docs, rules(on_text, **limits))]
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
                       F.col("text").cast("string").alias("text"))
    def chain(found: Column) -> Column:
        def figure(name: str) -> Column:
            return FIGURES[name](F.col("text"), found)

        by_name = {r.name: r for r in rules(figure, **limits)}
        return verdict([by_name[name] for name in chosen])

    # The words are bound once; a rule behind the first failing one is not worked out.
    return (held.where(bound(words(F.col("text")), chain))
            .select(*[F.col(f"_row.`{c}`").alias(c) for c in columns]))


def judged(docs: DataFrame, **limits: int) -> DataFrame:
    """Figures and verdict of every row of ``(doc_id, text)``.

    ``base_failed`` is set by the two base rules; ``kept`` needs every rule. A null or blank
    text has no words and fails the base. Rows are judged one by one, so repeated and null
    doc_ids stay as they are. The figures of the result are worked out once, and the cascade
    takes them from their columns; those that only a rule needs are worked out in its turn, for
    rows that passed the rules before it.
    """
    order = [r.name for r in ordered(docs, rules(on_text, **limits))]
    by_name = {r.name: r for r in rules(lambda n: F.col(n) if n in REPORTED else on_text(n), **limits)}
    held = _with_words(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   F.col("text").cast("string").alias("text")))
    figures = held.select("doc_id", "text", "found", *[on_text(name).alias(name) for name in REPORTED])
    return figures.select(
        "doc_id", *REPORTED,
        (~(by_name["min_words"].passes & by_name["repeats"].passes)).alias("base_failed"),
        verdict([by_name[name] for name in order]).alias("kept"))
