"""Scalar column expressions (C1-C15). All JVM-side built-ins, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour.
# Value blacklists (case-sensitive): gender and age-bucket values dropped.
GENDER_BLACKLIST = ["UNKNOWN", "NULL"]
AGE_BLACKLIST = ["Unknown", "NULL"]
# Characters removed from keywords: colon, bar, newline runs, white space runs.
KEYWORD_STRIP_PATTERN = r":|\||\n+|\s+"
# White space runs inside model names and app categories become underscores.
WHITESPACE_RUN = r"\s+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_ws(x) -> Column:
    """Trim all leading/trailing white space (tabs too, see K9)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def ws_to_underscore(x) -> Column:
    """White space runs to '_'."""
    return F.regexp_replace(_c(x), WHITESPACE_RUN, "_")


def clean_keyword(x) -> Column:
    """C3 + C4: delete ':', '|', newlines and white space, then lower-case."""
    return F.lower(F.regexp_replace(_c(x), KEYWORD_STRIP_PATTERN, ""))


def not_blacklisted(x, values) -> Column:
    """The value, or null when it is one of ``values`` (case-sensitive)."""
    c = _c(x)
    return F.when(~c.isin(*values), c)


def split_ws(x) -> Column:
    """Split on white space runs, dropping empty pieces."""
    return F.filter(F.split(trim_ws(x), r"\s+"), lambda t: t != "")


def safe_abs_double(x) -> Column:
    """String to double (null when unparsable), absolute value."""
    return F.abs(F.expr(f"try_cast({x} as double)") if isinstance(x, str) else x.try_cast("double"))


def set_size_sum(cols) -> Column:
    """Summed set sizes over the namespaces, null arrays count 0."""
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce(F.size(_c(c)), F.lit(0))
    return out


def jaccard(inter, len_a, len_b) -> Column:
    """C11: Jaccard index, 0 when both sets are empty."""
    inter, len_a, len_b = _c(inter), _c(len_a), _c(len_b)
    return (F.when(len_a + len_b == 0, F.lit(0.0))
            .otherwise(inter.cast("double") / (len_a + len_b - inter)))


def pair_count(k) -> Column:
    """k(k-1)/2 with integer division."""
    k = _c(k).cast("long")
    return F.shiftright(k * (k - 1), 1)      # exact: the product is even


def in_open_range(x, lo: str, hi: str) -> Column:
    """Exclusive lexical range lo < x < hi (not ``between``)."""
    c = _c(x)
    return (c > F.lit(lo)) & (c < F.lit(hi))


def day_offset(run_date: str, days: int, fmt: str = "yyyyMMdd") -> Column:
    """C14: run date (yyyyMMdd) shifted by ``days`` and formatted."""
    d = F.to_date(F.lit(run_date), "yyyyMMdd")
    return F.date_format(F.date_add(d, days), fmt)


def safe_divide(a, b) -> Column:
    """Division as double, null on zero or null divisor."""
    return F.try_divide(_c(a).cast("double"), _c(b))


def sanitize_key(x) -> Column:
    """Directory key: null becomes 'null', '/' becomes '-'."""
    return F.regexp_replace(F.coalesce(_c(x).cast("string"), F.lit("null")), "/", "-")
