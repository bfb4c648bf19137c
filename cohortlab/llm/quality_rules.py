"""Quality rules as a short-circuit cascade (DataFrame functions only).

``measure`` times every rule on a bounded sample and counts what it rejects;
``cascade`` then evaluates the rules per row in the order of rejections per
second, in one CASE whose later branches a rejected row never reaches. The
verdict is the conjunction of all rules, so it does not depend on the order
and reruns agree; only the time spent does.

Defined results: a null or blank text has no words and fails the base rule;
repeated rows get equal verdicts; an empty table gives an empty result; other
columns pass through untouched (names starting with ``__q_`` are reserved).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, BLANKS, checkpoint_table, let, text_of, words

SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000
COUNTERS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` builds the condition under which a row fails."""
    name: str
    rejects: Callable[[], Column]


def repeated_window_words(ws: Column, size: int = 3) -> Column:
    """Words lying in ``size``-word windows that occur twice or more in ``ws``.

    Windows are identified by a 64-bit hash of their words; equal ones become
    neighbours in a sort, so a text of n words costs n log n.
    """
    def covered(positions: Column) -> Column:
        steps = F.transform(positions, lambda p, j: F.coalesce(
            F.least(F.get(positions, j + 1) - p, F.lit(size)), F.lit(size)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)

    def twice(s: Column) -> Column:
        hit = F.transform(s, lambda x, j: F.when(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]))
        return let(F.sort_array(F.filter(hit, lambda i: i.isNotNull())), covered)

    def of(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.size(w) - (size - 1))
        windows = F.transform(starts, lambda _, i: F.struct(
            F.xxhash64(*[F.get(w, i + k) for k in range(size)]).alias("h"), i.alias("i")))
        return F.when(F.size(w) <= size, F.lit(0).cast("long")).otherwise(let(F.sort_array(windows), twice))

    return let(ws, of)


def counters(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns ``COUNTERS``, replacing any of those names; each text is
    split once."""
    t = F.col("__q_text")
    d = df.withColumn("__q_text", text_of(text))
    d = d.withColumn("__q_words", words(t))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    d = d.withColumn("__q_lines", lines)
    return d.select(
        *[c for c in df.columns if c not in COUNTERS],
        F.size("__q_words").cast("long").alias("n_words"),
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__q_lines").cast("long").alias("n_lines"),
        (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("__q_words")).alias("n_repeat_words"))


def own_counters(text: str = "text") -> Callable[[str], Column]:
    """The counters as expressions over the text, for rules that are to compute
    only what they need (``default_rules(counter=own_counters())``): a row that an
    earlier rule rejects then never reaches the dearer counters."""
    t = text_of(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    found = {
        "n_words": F.size(words(t)), "word_chars": F.length(F.translate(t, BLANKS, "")),
        "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")), "n_lines": F.size(lines),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeated_window_words(words(t))}
    return lambda name: found[name].cast("long")


def base_rules(counter: Callable[[str], Column] = F.col) -> list[Rule]:
    """The two rules of the base verdict, over the counter columns."""
    c = counter
    return [
        Rule("few_words", lambda: c("n_words") < 50),
        Rule("repeats", lambda: 100 * c("n_repeat_words") > 50 * c("n_words")),
    ]


def default_rules(text: str = "text", counter: Callable[[str], Column] = F.col) -> list[Rule]:
    """Base rules, rules over the counters, and rules that read the text again
    (share of letters, of capitals among them, a word beyond 1,000 characters).
    All compare whole numbers."""
    c = counter

    def letters(cls: str) -> Column:
        return F.length(F.regexp_replace(text_of(text), rf"[^\p{{{cls}}}]+", ""))

    return base_rules(counter) + [
        Rule("symbols", lambda: 10 * c("n_symbols") > 3 * c("n_words")),
        Rule("short_words", lambda: c("word_chars") < 2 * c("n_words")),
        Rule("long_words", lambda: c("word_chars") > 20 * c("n_words")),
        Rule("dup_lines", lambda: 100 * c("n_dup_lines") > 50 * c("n_lines")),
        Rule("few_letters", lambda: 100 * letters("L") < 60 * c("word_chars")),
        Rule("capitals", lambda: 100 * letters("Lu") > 50 * letters("L")),
        Rule("giant_word", lambda: F.exists(F.split(text_of(text), BLANK), lambda w: F.length(w) > 1000)),
    ]


def measure(df: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS,
            prepare: Callable[[DataFrame], DataFrame] | None = None) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) on about ``sample_rows`` random rows. Rows
    are drawn before ``prepare`` adds the columns that the rules read; a rule's
    time holds those that it reads, as the optimiser leaves out the others."""
    total = df.count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = checkpoint_table(df.sample(share, seed=7) if share < 1 else df, "rule_sample")
    sample = sample if prepare is None else prepare(sample)

    def timed(col: Column) -> tuple[float, int]:
        t0 = time.perf_counter()
        n = sample.agg(F.sum(F.when(col, 1).otherwise(0)).alias("n")).first()["n"] or 0
        return time.perf_counter() - t0, n

    idle = min(timed(F.lit(True))[0] for _ in range(2))
    n = max(1, sample.count())
    out = []
    for r in rules:
        seconds, rejected = timed(r.rejects())
        out.append((r, max(seconds - idle, 1e-4), rejected / n))
    return out


def order_rules(measured: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Most rejections per second first."""
    return [r for r, s, share in sorted(measured, key=lambda m: (-m[2] / m[1], m[1], m[0].name))]


def cascade(df: DataFrame, rules: list[Rule], sample_from: DataFrame | None = None,
            sample_rows: int = SAMPLE_ROWS, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds ``kept``: no rule rejects the row. ``sample_from`` (default ``df``) is
    only sampled; it has the columns that the rules read once ``prepare`` (if
    given) has added to it."""
    ordered = order_rules(measure(sample_from if sample_from is not None else df, rules, sample_rows, prepare))
    verdict = None
    for r in ordered:
        cond = F.coalesce(r.rejects(), F.lit(False))
        verdict = F.when(cond, F.lit(False)) if verdict is None else verdict.when(cond, F.lit(False))
    return df.withColumn("kept", F.lit(True) if verdict is None else verdict.otherwise(F.lit(True)))
