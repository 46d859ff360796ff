"""Secret scans with DataFrame functions only.

Base rules are regular expressions. Beyond them, long tokens are candidates of a character class
(hex, letters and digits, all base64 characters); a window slides over each, its Shannon entropy
kept up by the counts of the one character that leaves and the one that enters, and the stretch of
windows above the class's threshold is reported, unless the allow-list knows the token as harmless
or a base rule has it already.

A match's place is the length of all that a split by the same expression leaves before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Expressions, the group whose length counts, and its least length.
BASE_RULES = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),  # as [0-9a-f]+ of 16 and more: either matches whole runs
}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WIDTH = 20
#: Least entropy of a window, in bits, by class: the first expression that fits a whole token names it.
CLASSES = (("hex", r"^[0-9A-Fa-f]+$", 3.05), ("alnum", r"^[A-Za-z0-9]+$", 3.75), ("base64", r"^.+$", 3.85))
#: Harmless tokens: words, numbers, words or numbers joined by signs, UUIDs, rulers, placeholders.
ALLOWED = (
    r"^[A-Z]?[a-z]+$|^[A-Z]+$|^[0-9]+$"
    r"|^[+/_=-]*([A-Z]?[a-z]+|[A-Z]+|[0-9]+)([+/_=-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[+/_=-]*$"
    r"|^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
    r"|0123456789|abcdefghij|ABCDEFGHIJ|(?i:example|placeholder|changeme|your[_-])"
)
KINDS = (*BASE_RULES, "entropy")
_BLOCK = 256
_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often ``use`` names it or a function within calls for it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column) -> Column:
    """Sums of all earlier elements, in blocks so that many matches in one text don't cost their square."""

    def short(a):
        zero = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            a, zero, lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out")), lambda s: s["out"]
        )

    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    blocks = lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")), lambda b: F.slice(a, b * _BLOCK + 1, _BLOCK))
    joined = lambda cut: F.flatten(F.zip_with(cut, short(F.transform(cut, total)), lambda b, o: F.transform(short(b), lambda x: x + o)))
    return _bound(values, lambda a: _bound(blocks(a), joined))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, text, group's text) of leftmost non-overlapping matches, in code points."""
    extract = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))

    def placed(found, between):
        both = F.zip_with(between, found, lambda b, m: (F.length(b) + F.length(m)).cast("bigint"))
        starts = F.zip_with(_running(both), between, lambda s, b: s + F.length(b))
        spans = F.zip_with(starts, found, lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("text")))
        counted = extract(group) if group else found
        return F.zip_with(spans, counted, lambda m, g: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"), g.alias("group")))

    between = lambda found: F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    return _bound(extract(0), lambda found: _bound(between(found), lambda b: placed(found, b)))


def _base(text: Column, kind: str) -> Column:
    pattern, group, least = BASE_RULES[kind]
    long_enough = F.filter(_matches(text, pattern, group), lambda m: F.length(m["group"]) >= least)
    spans = F.transform(long_enough, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


#: Fixed value: the characters of a candidate, each numbered by its place.
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: n * log2(n) for n from 0 to WIDTH, in units of 2**-30, so that sums are the same in any order.
_UNIT = 1 << 30
_PLOGP = [0] + [round(n * math.log2(n) * _UNIT) for n in range(1, WIDTH + 1)]


def _plogp(n: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("bigint") for v in _PLOGP)), n + 1)


def _stretch(token: Column, threshold: Column) -> Column:
    """(first, last) start of the windows above ``threshold``, from 0; nulls if there is none.

    Entropy is log2(WIDTH) - sum(n log2 n) / WIDTH over the counts n of a window's characters. One
    fold over the characters keeps the counts and that sum: a step takes the character that leaves
    from them and adds the one that enters, so time is linear in the token's length.
    """
    most = (math.log2(WIDTH) - threshold) * WIDTH * _UNIT
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(_ALPHABET), c))
    leaving = F.concat(F.array_repeat(F.lit(0), WIDTH), F.slice(codes, F.lit(1), F.size(codes) - WIDTH))
    steps = F.zip_with(codes, leaving, lambda e, o: F.struct(e.alias("enters"), o.alias("leaves")))
    null = F.lit(None).cast("int")
    # A letter for each character of the alphabet: A stands for a count of 0, B for 1, and so on.
    start = F.struct(
        F.lit("A" * len(_ALPHABET)).alias("counts"),
        F.lit(0).cast("bigint").alias("sum"), F.lit(-WIDTH).alias("at"), null.alias("first"), null.alias("last"), most.alias("most"),
    )

    def marked(state):
        """first and last with the window that the last step has completed."""
        above = (state["at"] >= 0) & (state["sum"] <= state["most"])
        return F.when(above & state["first"].isNull(), state["at"]).otherwise(state["first"]), F.when(above, state["at"]).otherwise(state["last"])

    def slide(state, step):
        enters, leaves = step["enters"], step["leaves"]
        count = lambda at: F.ascii(F.substr(state["counts"], at, F.lit(1))) - ord("A")
        out = F.when(leaves > 0, count(leaves)).otherwise(1)
        into = count(enters) - (enters == leaves).cast("int")
        less = F.when(leaves > 0, F.overlay(state["counts"], F.char(out + (ord("A") - 1)), leaves, F.lit(1))).otherwise(state["counts"])
        counts = F.overlay(less, F.char(into + (ord("A") + 1)), enters, F.lit(1))
        total = state["sum"] - _plogp(out) + _plogp(out - 1) + _plogp(into + 1) - _plogp(into)
        first, last = marked(state)
        return F.struct(counts.alias("counts"), total.alias("sum"), (state["at"] + 1).alias("at"), first.alias("first"), last.alias("last"), state["most"].alias("most"))

    def ended(state):
        first, last = marked(state)
        return F.struct(first.alias("first"), last.alias("last"))

    return F.aggregate(steps, start, slide, ended)


def _covered(match: Column, spans: Column) -> Column:
    """Whether one of ``spans``, which follow each other and don't overlap, holds ``match``: the last that starts no later, by bisection."""
    steps = F.filter(F.array(*(F.lit(1 << k) for k in range(30, -1, -1))), lambda step: step <= F.size(spans))
    last = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(spans, n + step - 1)["start"] <= match["start"], n + step).otherwise(n))
    return F.coalesce(F.get(spans, last - 1)["end"] >= match["end"], F.lit(False))


def _entropy(text: Column, base: list[Column]) -> Column:
    tokens = F.filter(_matches(text, CANDIDATE), lambda m: ~m["text"].rlike(ALLOWED))
    new = F.filter(tokens, lambda m: ~reduce(lambda a, b: a | b, (_covered(m, spans) for spans in base)))

    def threshold(token):
        return reduce(lambda rest, c: F.when(token.rlike(c[1]), c[2]).otherwise(rest), CLASSES[::-1], F.lit(99.0))

    found = F.transform(new, lambda m: F.struct(m["start"].alias("start"), _stretch(m["text"], threshold(m["text"])).alias("w")))
    found = F.filter(found, lambda m: m["w"]["first"].isNotNull())
    spans = F.transform(
        found,
        lambda m: F.struct((m["start"] + m["w"]["first"]).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"), (m["start"] + m["w"]["last"] + WIDTH).alias("end")),
    )
    return F.when(text.rlike(CANDIDATE), spans).otherwise(F.array().cast(_SPAN))


def _written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans), one row a row of ``docs``.

    spans lists kind:start:end by start, then kind in the order of ``KINDS``, comma-joined; starts
    and ends are code points, end exclusive; base_sha256 hashes that list of the base rules' alone.
    A null text counts as empty: no spans, and the hash of the empty string. Repeated rows and ids are
    scanned each for itself; time is linear in a text's and a token's length, but for sorting the spans and
    looking each token up among its text's base spans by bisection.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("text"))
    found = found.select("doc_id", "text", *(_base(F.col("text"), k).alias(k) for k in BASE_RULES))
    found = found.withColumn("base", F.concat(*BASE_RULES))
    found = found.withColumn("entropy", _entropy(F.col("text"), [F.col(k) for k in BASE_RULES]))
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "entropy")).alias("spans"),
    )
