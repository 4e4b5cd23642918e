"""Secret scans: patterns plus a randomness test battery, in DataFrame expressions only.

Long runs of encoding characters are candidates. Each gets an inferred encoding and three tests
against uniformly random characters of that alphabet: chi-squared counts, runs above and below
the middle, serial correlation. A corpus-wide false-discovery control (Benjamini-Hochberg, per
length band, since short strings have little power) decides which candidates are *not* random;
the others are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.llm.quality import bound
from kerbside.sources.scratch import written

# Patterns, kinds in their order, alphabets.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MIN_LENGTH = 20
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
#: What a candidate must look like. Letters alone need more characters than letters with digits:
#: at fewer the battery can't tell long words from random letters. (24 digits are hex anyway.)
JUDGED = "[0-9].*[A-Za-z]|[A-Za-z].*[0-9]|^[A-Za-z]{48,}$|^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]{32,}$"
#: Lower ends of the length bands that are controlled one by one.
BANDS = [20, 32, 48, 80]
#: p-values are counted in steps of a hundredth of a decade, down to 1e-20.
STEPS = 2_000

#: Matches that are laid end to end at a time. Affects cost only.
BLOCK = 128

_FOUND = "array<struct<start:int,end:int,part:string>>"
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_SCORED = "array<struct<start:int,kind:int,end:int,band:int,step:int>>"


def _pieces(text: Column, pattern: str, group: int = 0) -> Column:
    """``(gap, hit, part)``: the text before each match, the match, the text of its group; the
    last piece is what follows the last match and has no hit."""
    return F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """``(start, end, part)`` of all matches, in code points; ``part`` is a group's text.

    The pieces between matches and the matches themselves, laid end to end, give the places:
    first within blocks of pieces, then block after block, as an array that grows match by match
    would be copied once a match.
    """
    empty = F.array().cast(_FOUND)

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(
            F.array_append(acc["found"], F.struct(start.alias("start"), end.alias("end"),
                                                  x["part"].alias("part"))).alias("found"),
            end.alias("at"))

    def shift(acc: Column, block: Column) -> Column:
        moved = F.transform(block["found"], lambda m: F.struct(
            (m["start"] + acc["at"]).alias("start"), (m["end"] + acc["at"]).alias("end"), m["part"].alias("part")))
        return F.struct(F.array_append(acc["found"], moved).alias("found"),
                        (acc["at"] + block["at"]).alias("at"))

    def laid(pieces: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int")),
            lambda b: F.aggregate(F.slice(pieces, b * BLOCK + 1, F.lit(BLOCK)),
                                  F.struct(empty.alias("found"), F.lit(0).alias("at")), add))
        return F.flatten(F.aggregate(
            blocks, F.struct(F.array().cast(f"array<{_FOUND}>").alias("found"), F.lit(0).alias("at")),
            shift, lambda acc: acc["found"]))

    hits = F.filter(_pieces(text, pattern, group), lambda x: x["hit"].isNotNull())
    return F.when(F.regexp_like(text, F.lit(pattern)), bound(hits, laid)).otherwise(empty)


def _blanked(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """The text with line ends in place of the characters of each match whose ``group`` has
    ``least`` characters or more."""
    joined = F.array_join(F.transform(_pieces(text, pattern, group), lambda x: F.concat(
        x["gap"], F.when(F.length(x["part"]) >= least, F.repeat(F.lit("\n"), F.length(x["hit"])))
        .otherwise(F.coalesce(x["hit"], F.lit(""))))), "")
    return F.when(F.regexp_like(text, F.lit(pattern)), joined).otherwise(text)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0 (a closed form good to about 1 %)."""
    return 0.5 * F.exp(-0.717 * z - 0.416 * z * z)


def _alphabet(part: Column) -> Column:
    """Alphabet of the narrowest encoding that explains a string."""
    return (F.when(part.rlike("^[0-9]+$"), DIGITS)
            .when(part.rlike("^[a-z]+$"), LOWER)
            .when(part.rlike("^[A-Z]+$"), UPPER)
            .when(part.rlike("^[A-Za-z]+$"), UPPER + LOWER)
            .when(part.rlike("^[0-9a-f]+$"), DIGITS + LOWER[:6])
            .when(part.rlike("^[0-9A-F]+$"), DIGITS + UPPER[:6])
            .when(part.rlike("^[A-Z2-7]+$"), UPPER + DIGITS[2:8])
            .when(part.rlike("^[A-Z0-9]+$"), UPPER + DIGITS)
            .when(part.rlike("^[a-z0-9]+$"), LOWER + DIGITS)
            .when(part.rlike("^[A-Za-z0-9]+$"), UPPER + LOWER + DIGITS)
            .when(part.rlike("^[A-Za-z0-9_-]+$"), UPPER + LOWER + DIGITS + "_-")
            .when(part.rlike("^[A-Za-z0-9+/]+$"), UPPER + LOWER + DIGITS + "+/")
            .otherwise(UPPER + LOWER + DIGITS + "+/_-"))


def p_value(part: Column) -> Column:
    """Bonferroni-combined p-value of the three tests against uniform characters."""
    def tests(alphabet: Column) -> Column:
        places = F.transform(F.filter(F.split(part, ""), lambda c: c != ""),
                             lambda c: (F.instr(alphabet, c) - 1).cast("double"))
        k = F.length(alphabet).cast("double")

        def stats(x: Column) -> Column:
            n = F.size(x).cast("double")
            squares = F.aggregate(
                F.array_distinct(x), F.lit(0.0),
                lambda acc, v: acc + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)))
            chi = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
            steps = F.arrays_zip(F.slice(x, 1, F.size(x) - 1).alias("a"), F.slice(x, 2, F.size(x)).alias("b"))
            changes = F.size(F.filter(steps, lambda s: (s["a"] < k / 2) != (s["b"] < k / 2)))
            runs = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
            middle = (k - 1) / 2
            products = F.aggregate(steps, F.lit(0.0),
                                   lambda acc, s: acc + (s["a"] - middle) * (s["b"] - middle))
            serial = products / ((k * k - 1) / 12 * F.sqrt(n - 1))
            worst = F.least(_tail(F.greatest(chi, F.lit(0.0))), 2 * _tail(F.abs(runs)),
                            2 * _tail(F.abs(serial)))
            return F.least(F.lit(1.0), 3 * worst)

        return bound(places, stats)

    return bound(_alphabet(part), tests)


def _candidates(text: Column) -> Column:
    """Runs outside the pattern spans that look like ``JUDGED``, with length band and p-value
    step. A run that a pattern span cuts is judged by what the span leaves of it."""
    rest = _blanked(_blanked(_blanked(text, ASSIGN, 1, 6), ACCESS), HEX)
    mixed = F.filter(_matches(rest, CANDIDATE), lambda m: m["part"].rlike(JUDGED))

    def scored(m: Column) -> Column:
        size = m["end"] - m["start"]
        band = F.lit(-1)
        for i, low in enumerate(BANDS):
            band = F.when(size >= low, F.lit(i)).otherwise(band)
        step = F.least(F.lit(STEPS), F.floor(-100 * F.log10(F.greatest(p_value(m["part"]), F.lit(1e-30)))))
        return F.struct(m["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"),
                        m["end"].alias("end"), band.alias("band"), step.cast("int").alias("step"))

    return F.transform(mixed, scored).cast(_SCORED)


def _base(text: Column) -> Column:
    def kind(name: str, found: Column) -> Column:
        return F.transform(found, lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(name)).alias("kind"), m["end"].alias("end")))

    assign = F.filter(_matches(text, ASSIGN, 1), lambda m: F.length(m["part"]) >= 6)
    return F.sort_array(F.concat(kind("assign", assign), kind("access", _matches(text, ACCESS)),
                                 kind("hex", _matches(text, HEX)))).cast(_SPAN)


def cutoffs(scored: DataFrame, level: float) -> dict[int, int]:
    """Per band the smallest p-value step at which a candidate counts as not random.

    Counts per step are summed from the smallest p-values on: at most four bands of 2,001
    steps, whatever the number of candidates.
    """
    counts = (scored.select(F.explode("random").alias("c")).groupBy("c.band", "c.step")
              .agg(F.count(F.lit(1)).alias("n")))
    whole = Window.partitionBy("band")
    ranked = counts.withColumns({"k": F.sum("n").over(whole.orderBy(F.desc("step"))),
                                 "m": F.sum("n").over(whole)})
    passed = ranked.where(F.pow(F.lit(10.0), -F.col("step") / 100) <= F.lit(level) * F.col("k") / F.col("m"))
    return {r["band"]: r["step"] for r in passed.groupBy("band").agg(F.min("step").alias("step")).collect()}


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def spans(docs: DataFrame, level: float = 0.01, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` plus ``base`` and ``spans`` (arrays of start, kind number, end).

    ``level`` is the share of false rejections allowed among candidates declared not random: it
    bounds how many secrets are passed over, not how many harmless runs are reported. A random
    run is added where no pattern span lies; what a pattern span leaves of a run is judged on
    its own. Scored rows are written once, as
    the control needs all of them before any can be judged.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    columns = keep if keep is not None else docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), text.alias("text"))
    scored = written(held.select("row", _base(F.col("text")).alias("base"),
                                 _candidates(F.col("text")).alias("random")), "secrets")
    stops = cutoffs(scored, level)
    found = F.array(*[F.lit(stops.get(band, STEPS + 1)) for band in range(len(BANDS))])
    added = F.filter("random", lambda c: (c["step"] < F.get(found, c["band"])) & ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    plain = F.transform(added, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"),
                                                  c["end"].alias("end")))
    return scored.select("row", "base", F.sort_array(F.concat("base", plain.cast(_SPAN))).alias("spans"))


def scanned(docs: DataFrame, level: float = 0.01) -> DataFrame:
    """Counts and spans of every row of ``(doc_id, text)``.

    A null text is empty and has no spans. Rows are scanned one by one, so repeated and null
    doc_ids stay as they are; the battery's control counts every candidate of every row.
    """
    found = spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), level, ["doc_id"])

    def count(name: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(name))).cast("long")

    return found.select(
        F.col("row.doc_id").alias("doc_id"), count("assign").alias("n_assign"),
        count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, level: float = 0.01, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced; all rows and columns stay.

    Spans that overlap are replaced once. Null texts stay null.
    """
    columns = docs.columns
    found = spans(docs, level)

    def cut(text: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            fresh = s["start"] >= acc["at"]
            out = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                                         F.lit(mark))).otherwise(acc["out"])
            return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

        return F.aggregate("spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
                           lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))

    text = F.when(F.size("spans") == 0, F.col("row.text")).otherwise(cut(F.col("row.text")))
    return found.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in columns])
