"""Range parsing: messy range text -> typed (low, high) bounds.

All parsers are pure Column expressions (no UDF), so they stay inside
whole-stage codegen and run on batch or streaming DataFrames alike. Each
bound is one small CASE-free expression: filters on derived labels are
pushed below the staging projection by Catalyst, which substitutes these
expressions into every reference, so their size matters.

Text forms understood (see FIXTURES F2):
  "a - b" / "a – b"  -> (a, b)          en dash is normalised first
  "a"                -> (a, a)
  "up - n"           -> (0, n)          only when ``open_low`` is set
  "NaN"              -> (NULL, NULL)    sentinel for "unknown"
  NULL / blank       -> (NULL, NULL)
Bad text (e.g. "35-70") gives NULL bounds, flagged by ``range_parse_error``;
``strict=True`` instead uses an ANSI cast, which raises like the source model.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EN_DASH = "–"
NAN_SENTINEL = "NaN"
_OPEN_LOW = r"^up [-–] (\d+)$"


# a decimal number, NaN or infinity; the cast alone would also take "12f" and "5d"
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)\s*$"


def _to_double(c: Column, strict: bool) -> Column:
    if strict:
        return F.when(c.rlike(_NUMBER) | c.isNull(), c).otherwise(F.lit("not a number")).cast("double")
    return F.regexp_extract(c, _NUMBER, 0).try_cast("double")


def is_blank(raw: Column) -> Column:
    """NULL or only spaces (Spark ``trim`` strips spaces, not tabs)."""
    return raw.isNull() | (F.trim(raw) == "")


def is_present(raw: Column, sentinel: bool = True) -> Column:
    """Measure present: not blank and (optionally) not the 'NaN' sentinel. Never NULL."""
    present = ~is_blank(raw)
    if sentinel:
        present = present & (raw != NAN_SENTINEL)
    return F.coalesce(present, F.lit(False))


def is_open_low(raw: Column) -> Column:
    """'up - n' / 'up – n': an open lower bound."""
    return raw.rlike(_OPEN_LOW)


def parse_range(raw: Column, *, open_low: bool = False, nan: str = "null",
                strict: bool = False) -> tuple[Column, Column]:
    """Parse a double range. Returns (low, high) Columns.

    The text is normalised (en dash -> '-', and with ``open_low`` 'up - n' ->
    '0 - n'), split on ' - ', and the low token is the first part; the high
    token is the second part when the text has a dash, else the first.
    Blank text casts to NULL. ``nan="null"`` maps NaN bounds to NULL (the
    intended meaning of the sentinel); ``"propagate"`` keeps the NaN that a
    literal cast produces for text like "NaN - 8" (exact 'NaN' is NULL in
    both modes).
    """
    norm = F.translate(raw, EN_DASH, "-")
    if open_low:
        norm = F.regexp_replace(norm, r"^up - (\d+)$", "0 - $1")
    parts = F.split(norm, " - ")
    dash = norm.contains("-")
    if strict:
        lo_txt = parts[0]
        hi_txt = F.when(dash, parts[1]).otherwise(parts[0])
    else:
        lo_txt = F.get(parts, 0)
        hi_txt = F.get(parts, dash.cast("int"))
    low, high = _to_double(F.trim(lo_txt), strict), _to_double(F.trim(hi_txt), strict)
    if nan == "null":
        none = F.lit(None).cast("double")
        return F.nanvl(low, none), F.nanvl(high, none)
    if nan == "propagate":
        keep = raw != NAN_SENTINEL
        return F.when(keep, low), F.when(keep, high)
    raise ValueError(f"nan must be 'null' or 'propagate', not {nan!r}")


def parse_years(raw: Column, *, strict: bool = False) -> tuple[Column, Column]:
    """Parse a life-span text to a bigint (low, high) pair.

    low = leading digits. high = with a dash, the digits before the first
    'year'/'years'; without, the leading digits. A regex miss is NULL (not '').
    """
    norm = F.translate(raw, EN_DASH, "-")

    def num(c: Column) -> Column:
        c = F.nullif(c, F.lit(""))
        return c.cast("bigint") if strict else c.try_cast("bigint")

    low = num(F.regexp_extract(norm, r"^(\d+)", 1))
    high = num(F.when(norm.contains("-"), F.regexp_extract(norm, r"(\d+) years?", 1))
               .otherwise(F.regexp_extract(norm, r"^(\d+)", 1)))
    return low, high


def range_parse_error(raw: Column, low: Column, high: Column, sentinel: bool = True) -> Column:
    """True when text is present but neither bound could be read."""
    return is_present(raw, sentinel) & low.isNull() & high.isNull()
