"""Column expressions (X1-X16) and the reusable macro surface (V1).

Every function takes and returns ``Column``s built from Spark's built-in
functions, so they stay inside whole-stage codegen. There is no Python UDF
anywhere in the library.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = "Column | str"

# Null marker of the surrogate-key convention, and the
# payment-type labels (code -> label; anything else is 'EMPTY').
SURROGATE_NULL_MARKER = "_dbt_utils_surrogate_key_null_"
PAYMENT_TYPE_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_TYPE_OTHER = "EMPTY"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c) -> Column:
    return _c(c).cast("string")


def number_text(c) -> Column:
    """Text of a decimal (up to 36 places) without trailing zeros (5.00 is
    '5', 12.50 '12.5'), so a row id does not depend on the declared scale.

    A plain cast writes small values with an exponent when ANSI mode is off.
    Whole numbers and numbers from 1 on never take one, so the text is put
    together from the whole part and from 1 + the rest: the same in both modes."""
    c = _c(c)
    whole = F.floor(F.abs(c))
    rest = F.substring((F.lit(1) + (F.abs(c) - whole)).cast("string"), 2, 40)
    text = F.concat(F.when(c < 0, "-").otherwise(""), whole.cast("string"), rest)
    return F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


# --- row ids -------------------------------------------------------------

def row_hash_text(*cols, sep: str = "") -> Column:
    """md5 hex of the fields' text joined by ``sep``; NULL counts as ''."""
    parts = [F.coalesce(as_text(c), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def row_hash_bytes(*cols, sep: str = "") -> Column:
    """The same digest as 16 raw bytes."""
    return F.unhex(row_hash_text(*cols, sep=sep))


def surrogate_key(*cols) -> Column:
    """md5 of the fields joined by '-', NULL replaced by a fixed marker."""
    parts = [F.coalesce(as_text(c), F.lit(SURROGATE_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# --- casts ---------------------------------------------------------------

def safe_cast(c, to: str) -> Column:
    """NULL instead of an error when the value does not convert."""
    return _c(c).try_cast(to)


# NUMERIC keeps 9 decimal places; 19 digits before them leave room for sums.
NUMERIC = "decimal(28,9)"


def to_numeric(c, money_type: str = NUMERIC) -> Column:
    """Exact decimal."""
    return _c(c).cast(money_type)


def to_ts(c) -> Column:
    """Zone-less timestamp (TIMESTAMP_NTZ), as the stored data is."""
    return _c(c).cast("timestamp_ntz")


def float_then_int(c) -> Column:
    """Text -> float -> integer, rounding halves away from zero (T5)."""
    return F.round(safe_cast(c, "double")).try_cast("bigint")


# --- labels (V1) -----------------------------------------------------------

def payment_type_description(c) -> Column:
    """Payment code (any text) to its label, 'EMPTY' otherwise."""
    code = float_then_int(c)
    out = None
    for k, label in PAYMENT_TYPE_LABELS.items():
        out = F.when(code == k, F.lit(label)) if out is None else out.when(code == k, F.lit(label))
    return out.otherwise(F.lit(PAYMENT_TYPE_OTHER))


def replace_text(c, search: str, repl: str) -> Column:
    """X6."""
    return F.replace(_c(c), F.lit(search), F.lit(repl))


# --- dates ---------------------------------------------------------------

def year_of(c) -> Column:
    return F.year(_c(c))


def quarter_of(c) -> Column:
    return F.quarter(_c(c))


def month_of(c) -> Column:
    return F.month(_c(c))


def year_quarter(c) -> Column:
    """X7: '<year>_Q<quarter>'."""
    return F.concat(year_of(c).cast("string"), F.lit("_Q"), quarter_of(c).cast("string"))


def month_start(c) -> Column:
    """First instant of the month, kept zone-less."""
    return F.date_trunc("month", _c(c)).cast("timestamp_ntz")


def seconds_between(start, end) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def minute_boundaries_between(start, end) -> Column:
    """X11: minute boundaries crossed (00:00:59 -> 00:01:01 is 1)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _c(start)),
                            F.date_trunc("minute", _c(end)))


def on_date(c, day: str, date_col: str | None = None) -> Column:
    """F1 / X12 as a half-open range. ``date_col`` names the table's partition
    column that holds the date of ``c``: it is filtered too, so that only that
    date's partition is read (Spark does not derive that by itself)."""
    start = F.lit(day).cast("timestamp_ntz")
    out = (_c(c) >= start) & (_c(c) < F.timestamp_add("DAY", F.lit(1), start))
    return out & (F.col(date_col) == F.lit(day).cast("date")) if date_col else out


def in_range(c, start: str, end: str, date_col: str | None = None) -> Column:
    """``start <= c < end``; ``date_col`` as in :func:`on_date`."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    out = (_c(c) >= lo) & (_c(c) < hi)
    return out & F.col(date_col).between(lo.cast("date"), hi.cast("date")) if date_col else out


def days_back(as_of: str, n: int) -> Column:
    """``as_of - n days`` as a zone-less timestamp at midnight."""
    return F.date_sub(F.lit(as_of).cast("date"), int(n)).cast("timestamp_ntz")


def growth(cur, prev) -> Column:
    """(cur - prev) / prev; NULL when prev is 0 (ANSI-safe)."""
    return F.try_divide(_c(cur) - _c(prev), _c(prev))


def since(c, start: Column, date_col: str | None = None) -> Column:
    """``c >= start``; ``date_col`` as in :func:`on_date`."""
    out = _c(c) >= start
    return out & (F.col(date_col) >= start.cast("date")) if date_col else out


def json_field_or(props, key: str, default: str = "N/A") -> Column:
    """Value of a JSON key as text; ``default`` only when absent.

    An explicit JSON null stays NULL, as ``dict.get(key, default)`` does.
    """
    m = F.from_json(_c(props), "map<string,string>")
    return F.when(F.map_contains_key(m, F.lit(key)), m[key]).otherwise(F.lit(default))


def distance_band(c, edges: Iterable[float] = (1, 3, 7, 10)) -> Column:
    """label of the band (lo, hi]; first band is '<=e0', last '>eN'."""
    edges = list(edges)
    col = _c(c)
    out = F.when(col <= edges[0], F.lit(f"<={_fmt(edges[0])}"))
    for lo, hi in zip(edges, edges[1:]):
        out = out.when(col <= hi, F.lit(f"{_fmt(lo)}-{_fmt(hi)}"))
    return out.when(col > edges[-1], F.lit(f">{_fmt(edges[-1])}"))


def _fmt(x) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)
