"""Secret scans (DataFrame functions only): fixed patterns, and sliding-window
Shannon entropy over candidate strings.

Base kinds (fixed values): ``assign``, ``access`` and ``hex``. Their matches
are leftmost and non-overlapping per kind; matches that are too short drop.

Added kind ``entropy``: a candidate is a run of 20 or more characters of the
base64/URL alphabet that holds a letter and a digit. Its character class
(hexadecimal digits only, or mixed) sets the window's threshold. A window of
20 characters slides over it; the counts of its characters, and with them the
sum of c*log2(c), change by the character that enters and the one that leaves.
Windows at or above the threshold merge into spans. The sum is kept in whole
numbers, so the incremental value equals a fresh one exactly. Candidates on
the allow-list (UUIDs, plain paths, counting runs, EXAMPLE) are suppressed, as
are spans inside a base span.

Spans are code points, end exclusive, sorted by start and then kind.

Defined results: a null text is empty and has no spans; repeated rows get
equal results; an empty table gives an empty result; other columns pass
through (names starting with ``__s_`` are reserved).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_of

# FIXED VALUES: base kinds in the order that breaks ties, with their patterns.
KEYWORDS = r"(?i)(?:password|passwd|secret|token|api_?key)"
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"     # the same runs as AKIA[A-Z0-9]+ of 16 or more characters
HEX = r"[0-9a-f]{32,}"            # the same runs as [0-9a-f]+ of 32 or more characters
KINDS = ("assign", "access", "hex", "entropy")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW
THRESHOLD_BITS = {"hex": 3.0, "mixed": 3.8}
UNIT = 1 << 16
ALLOW = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^/?([a-z_-]+|[0-9]+)(/([a-z_-]+|[0-9]+))*/?$",
    r"(?i)0123456789|abcdefghij|example|placeholder|xxxxxxxx",
)
SPAN = "array<struct<start:int,end:int>>"


def plogp(c: int) -> int:
    """c * log2(c) in units of 2^-16, as a whole number."""
    return round(c * math.log2(c) * UNIT) if c > 1 else 0


def most_plogp(bits: float, window: int = WINDOW) -> int:
    """The largest sum of c*log2(c) of a window whose entropy reaches ``bits``."""
    return math.floor(window * (math.log2(window) - bits) * UNIT)


def matches(text: Column, pattern: str, size_group: int = 0, least: int = 0) -> Column:
    """(start, end, match) of a pattern's matches whose group is long enough.

    Positions come from the lengths of the pieces between the matches."""
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(size_group)).alias("part"),
                         F.split(text, pattern).alias("gap"))
    item = "array<struct<start:int,end:int,hit:string,ok:boolean>>"

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        row = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"),
                       (F.length(x["part"]) >= least).alias("ok"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    run = F.aggregate(found, F.struct(F.lit(0).alias("at"), F.array().cast(item).alias("out")), step,
                      lambda acc: acc["out"])
    return F.when(text.rlike(pattern), F.filter(run, lambda r: r["hit"].isNotNull() & r["ok"])) \
        .otherwise(F.array().cast(item))


def entropy_spans(candidate: Column, limit: Column, window: int = WINDOW) -> Column:
    """Merged spans (within the candidate) of windows of high entropy."""
    # a window holds one character more until the one that leaves is taken out
    table = F.array(*[F.lit(plogp(c)).cast("long") for c in range(window + 2)])
    n = len(ALPHABET)
    zero = F.struct(
        F.array_repeat(F.lit(0), n).alias("counts"), F.lit(0).cast("long").alias("s"),
        F.lit(-1).alias("from_"), F.lit(-1).alias("to_"), F.array().cast(SPAN).alias("out"))

    def replaced(counts, k, by):
        return F.concat(F.slice(counts, F.lit(1), k - 1), F.array(F.get(counts, k - 1) + by),
                        F.slice(counts, k + 1, F.lit(n)))

    def run(codes: Column) -> Column:
        def step(acc, i):
            into, out = F.get(codes, i), F.get(codes, i - window)
            c = F.get(acc["counts"], into - 1)
            grown = F.struct(replaced(acc["counts"], into, 1).alias("counts"),
                             (acc["s"] + F.get(table, c + 1) - F.get(table, c)).alias("s"))

            def leave(g):
                d = F.get(g["counts"], out - 1)
                return F.when(i < window, g).otherwise(F.struct(
                    replaced(g["counts"], out, -1).alias("counts"),
                    (g["s"] - F.get(table, d) + F.get(table, d - 1)).alias("s")))

            def mark(g):
                first, end = i - (window - 1), i + 1
                hot = (first >= 0) & (g["s"] <= limit)
                joins = hot & (first <= acc["to_"])
                opens = hot & (first > acc["to_"])
                closed = F.concat(acc["out"], F.array(F.struct(acc["from_"].alias("start"), acc["to_"].alias("end"))))
                return F.struct(
                    g["counts"].alias("counts"), g["s"].alias("s"),
                    F.when(opens, first).otherwise(acc["from_"]).alias("from_"),
                    F.when(joins | opens, end).otherwise(acc["to_"]).alias("to_"),
                    F.when(opens & (acc["to_"] >= 0), closed).otherwise(acc["out"]).alias("out"))

            return let(let(grown, leave), mark)

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step, lambda acc: F.when(
            acc["to_"] >= 0, F.concat(acc["out"], F.array(F.struct(
                acc["from_"].alias("start"), acc["to_"].alias("end"))))).otherwise(acc["out"]))

    letters = F.filter(F.split(candidate, ""), lambda c: c != "")
    return let(F.transform(letters, lambda c: F.instr(F.lit(ALPHABET), c)), run)


def scan(df: DataFrame, text: str = "text", allow: tuple[str, ...] = ALLOW,
         bits: dict[str, float] | None = None) -> DataFrame:
    """Adds ``__s_found``: array of (start, kind_no, end, kind), sorted."""
    bits = bits or THRESHOLD_BITS
    t = F.col("__s_text")
    d = df.withColumn("__s_text", text_of(text))

    def kind(no: int, spans: Column) -> Column:
        return F.transform(spans, lambda m: F.struct(
            m["start"].alias("start"), F.lit(no).alias("kind_no"), m["end"].alias("end"), F.lit(KINDS[no]).alias("kind")))

    assign = F.when(t.rlike(KEYWORDS), matches(t, ASSIGN, 2, 8))
    d = d.withColumn("__s_base", F.concat(
        F.coalesce(kind(0, assign), F.array()), kind(1, matches(t, ACCESS)), kind(2, matches(t, HEX))))

    def suspicious(m):
        listed = F.lit(False)
        for p in allow:
            listed = listed | m["hit"].rlike(p)
        return m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]") & ~listed

    def windows(m):
        limit = F.when(m["hit"].rlike("^[0-9A-Fa-f]+$"), F.lit(most_plogp(bits["hex"]))) \
            .otherwise(F.lit(most_plogp(bits["mixed"])))
        return F.transform(entropy_spans(m["hit"], limit), lambda s: F.struct(
            (m["start"] + s["start"]).alias("start"), (m["start"] + s["end"]).alias("end")))

    spans = F.flatten(F.transform(F.filter(matches(t, CANDIDATE), suspicious), windows))
    outside = F.filter(spans, lambda s: ~F.exists(
        "__s_base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    d = d.withColumn("__s_found", F.sort_array(F.concat("__s_base", kind(3, outside))))
    return d.drop("__s_text", "__s_base")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts per kind, the base spans' digest, all spans."""
    def of(no):
        return F.size(F.filter("__s_found", lambda s: s["kind_no"] == no)).cast("long")

    base = F.filter("__s_found", lambda s: s["kind_no"] < 3)
    return scan(df, text).select(
        id_col, of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("__s_found")).alias("spans"),
        of(3).alias("n_entropy"))


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``text`` with every found span replaced by ``mark``; overlapping spans
    become one mark, a null text stays null, other columns stay."""
    t = F.col(text)

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        cut = F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, cut).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("__s_found", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))
    return (scan(df, text)
            .withColumn(text, F.when(F.size("__s_found") == 0, t).otherwise(done)).drop("__s_found"))
