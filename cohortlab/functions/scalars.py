"""Scalar column functions.

All are built-in Spark expressions: they stay inside whole-stage codegen and
never leave the JVM.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters that str.strip removes, as far as they occur in ASCII and Latin-1.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"


def strip(c) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(_c(c), F.lit(SPACES))


# X1 ---------------------------------------------------------------------------
def to_float(c) -> Column:
    """Tolerant to-double: unparsable text -> null; NaN -> null.

    ``try_cast`` (not ``cast``) because ANSI mode raises on bad input.
    Deviation: Python also accepts digit separators ("1_000"); Spark does not.
    """
    v = _c(c).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


# X2 / X3 ----------------------------------------------------------------------
def text_flag(c, strict_text: bool = False) -> Column:
    """Normalised flag text: string, trimmed, lower-cased, null -> "".

    Integral-valued doubles are cast to bigint first so a coded answer 1.0
    reads "1" (deliberate deviation; ``strict_text=True`` keeps "1.0").
    """
    col = _c(c)
    if not strict_text:
        d = col.try_cast("double")
        col = F.when(d.isNotNull() & ~F.isnan(d) & (d == F.floor(d)) & (F.abs(d) < 1e15),
                     d.cast("bigint").cast("string")).otherwise(col.cast("string"))
    return F.coalesce(F.lower(strip(col.cast("string"))), F.lit(""))


def normalise_key(c) -> Column:
    """E-mail / role normalisation: strip white space, lower case."""
    return F.lower(strip(_c(c)))


# X10 --------------------------------------------------------------------------
def alias_map(c, mapping: dict | None = None, default: str | None = C.MODEL_ALIAS_DEFAULT) -> Column:
    """Look a lower-cased name up in a literal map; unknown -> ``default``."""
    mapping = mapping or C.MODEL_ALIASES
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    hit = F.try_element_at(m, F.lower(strip(_c(c))))
    return hit if default is None else F.coalesce(hit, F.lit(default))


# X11 / X13 / X20 / X12 ----------------------------------------------------------
def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def minor_units(price) -> Column:
    """Price text/number to integer minor units, truncating (19.99 -> 1998);
    null beyond the range of bigint."""
    return (to_float(price) * 100).try_cast("bigint")


def fixed_text(c, decimals: int) -> Column:
    """A double with a fixed number of decimals, half-even on its exact binary
    value (0.125 -> "0.12", 2.675 -> "2.67"); null for null and NaN.

    Spark rounds the shortest decimal form of a double, in which 2.675 is a
    tie. Here the double is split into two halves whose products with the unit
    are exact, which gives the exact side of the midpoint. From 1e13 on a
    double has too few places for that to matter."""
    x = F.abs(_c(c).cast("double"))
    unit = 10 ** decimals
    wide = x * F.lit(134217729.0)
    hi = wide - (wide - x)
    lo = x - hi

    def beyond(k: int, m: Column) -> Column:
        return (hi * F.lit(float(k)) - m) + lo * F.lit(float(k))

    n = F.floor(x * F.lit(float(unit))).cast("double")
    n = F.when(beyond(unit, n) < 0, n - 1).otherwise(n)
    side = beyond(2 * unit, n * 2 + 1)
    r = F.when(side > 0, n + 1).when(side < 0, n).otherwise(n + F.pmod(n, F.lit(2.0))).cast("bigint")
    text = F.concat(F.floor(r / unit).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((r % unit).cast("string"), decimals, "0"))
    text = F.when(x < 1e13, text).otherwise(F.format_string(f"%.{decimals}f", x))
    return F.when(x.isNotNull() & ~F.isnan(x), F.concat(F.when(_c(c) < 0, "-").otherwise(""), text))


def money_text(c) -> Column:
    return fixed_text(c, 2)


def percent1(c, scale: float = 100.0) -> Column:
    """x * scale rounded half-even to one decimal."""
    return F.bround(_c(c) * scale, 1)


# X14-X17 ------------------------------------------------------------------------
def parse_iso_ts(c) -> Column:
    """ISO-8601 text to timestamp: a date, extended or basic, alone or with a
    time ('T' or a blank, seconds and fraction optional, 'Z' or an offset);
    else null."""
    t = _c(c).cast("string")
    date = r"^(\d{4})-?(\d{2})-?(\d{2})"
    ok = t.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{8})([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    plain = F.regexp_replace(F.regexp_replace(t, date, "$1-$2-$3"), ",", ".")
    plain = F.regexp_replace(plain, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(ok, F.try_to_timestamp(F.when(t.rlike(r"^\d{8}$|^\d{4}-\d{2}-\d{2}$"), F.regexp_replace(t, date, "$1-$2-$3"))
                                         .otherwise(plain)))


def date_part(c, missing: str = C.NOT_AVAILABLE) -> Column:
    return F.coalesce(F.date_format(_c(c), "yyyy-MM-dd"), F.lit(missing))


def minute_part(c, missing: str = C.NOT_AVAILABLE) -> Column:
    return F.coalesce(F.date_format(_c(c), "yyyy-MM-dd HH:mm"), F.lit(missing))


def strict_date(c) -> Column:
    return F.try_to_date(_c(c).cast("string"), "yyyy-MM-dd")


def date_time(d, t) -> Column:
    """A date and an 'HH:mm:ss' time to a timestamp (null when malformed)."""
    return F.try_to_timestamp(F.concat_ws(" ", _c(d).cast("string"), _c(t)),
                              F.lit("yyyy-MM-dd HH:mm:ss"))


def month_start(c) -> Column:
    return F.date_trunc("month", _c(c))


# X18 / X19 ------------------------------------------------------------------------
def title(c) -> Column:
    """Title case: a letter starts a word after white space, "-", "(", "{",
    "[" or "<"; the rest is lower case."""
    parts = F.split(F.lower(_c(c)), r"(?<=[-\s({\[<])")
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")


def type_tag(model_type) -> Column:
    return F.concat(F.lit("liver_"), _c(model_type))


# X21 ---------------------------------------------------------------------------
def explode_list(df: DataFrame, col: str, as_name: str = "item", keep: list | None = None) -> DataFrame:
    keep = keep if keep is not None else [c for c in df.columns if c != col]
    return df.select(*keep, F.posexplode(col).alias("pos", as_name))


# X22 ---------------------------------------------------------------------------
def json_field_or(json_col, path: str, fallback) -> Column:
    """Nested JSON field, else ``fallback`` when absent or empty."""
    v = F.get_json_object(_c(json_col), path)
    return F.coalesce(F.nullif(v, F.lit("")), _c(fallback))


# X23 ---------------------------------------------------------------------------
def json_string_array(items) -> Column:
    """JSON array text of string items (order as given)."""
    return F.to_json(_c(items))


def json_number_array(items, decimals: int = 4) -> Column:
    """JSON array text of numbers printed with a fixed number of decimals."""
    return F.concat(F.lit("["), F.array_join(F.transform(_c(items), lambda x: fixed_text(x, decimals)), ","),
                    F.lit("]"))


# X24 ---------------------------------------------------------------------------
def decode_answers(df: DataFrame, fields: list[str] | None = None, suffix: str = "_label") -> DataFrame:
    """Add a label column per coded field.

    Each field is decoded through a literal map (the code table has a fixed
    bound of ~45 entries), so there is no join and no shuffle. Codes keep their
    numeric value in the original column; unknown codes give null labels.
    """
    fields = [f for f in (fields or list(C.CODED_FIELDS)) if f in df.columns]
    out = {}
    for f in fields:
        m = F.create_map(*[F.lit(x) for code, label in C.CODED_FIELDS[f] for x in (code, label)])
        out[f + suffix] = F.try_element_at(m, F.col(f).try_cast("int"))
    return df.withColumns(out)
