"""Column expressions whose semantics differ between Spark (ANSI on) and the reference.

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Number text accepted by the loss parser (after commas and spaces are removed).
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


# Fixed value: the characters that Unicode calls white space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_ws(x: ColumnOrName) -> Column:
    """Strip Unicode white space at both ends of a string column (Spark's plain ``trim`` strips blanks only); keeps null.

    A trim of many characters looks each up at every place, so it is left to the strings
    that, without their blanks, don't begin and end with a visible ASCII character
    (told by comparing bytes).
    """
    t = F.trim(_c(x).cast("string"))
    visible = [(end >= F.lit("!")) & (end < F.lit("\x7f")) for end in (t, F.reverse(t))]
    return F.when(visible[0] & visible[1], t).otherwise(F.btrim(t, F.lit(WHITE_SPACE)))


def ieee_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Float division with IEEE results for a zero divisor (±inf, NaN), null-in null-out.

    Spark raises on ``x / 0.0`` under ANSI mode and ``try_divide`` gives null; the
    reference follows IEEE.
    """
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return (
        F.when(b != 0, a / b)
        .when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when((a == 0) | F.isnan(a), F.lit(float("nan")))
        .when(a > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )


def clip_keep_null(x: ColumnOrName, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; null stays null and NaN stays NaN.

    ``least(greatest(x, lo), hi)`` is wrong here: it turns null into ``lo`` and
    Spark orders NaN above every number.
    """
    x = _c(x)
    return (
        F.when(x.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(x), x)
        .when(x < F.lit(lo), F.lit(float(lo)))
        .when(x > F.lit(hi), F.lit(float(hi)))
        .otherwise(x)
    )


def sum0(x: ColumnOrName) -> Column:
    """Sum that is 0.0 for an empty or all-null group (Spark gives null)."""
    return F.coalesce(F.sum(_c(x)), F.lit(0.0))


def parse_loss(x: ColumnOrName) -> Column:
    """Loss text -> double: drop commas and whitespace, null unless it is a number.

    ``try_cast`` alone would accept Java forms such as ``10d``.
    """
    cleaned = F.regexp_replace(_c(x).cast("string"), r"[,\s]", "")
    return F.when(cleaned.rlike(_NUMBER), cleaned.try_cast("double"))


def vendor_years(vendor: ColumnOrName, years: Mapping[str, int]) -> Column:
    """Simulated years of a vendor as double; unknown vendor -> null."""
    expr = F.lit(None).cast("double")
    for name, n in years.items():
        expr = F.when(_c(vendor) == F.lit(name), F.lit(float(n))).otherwise(expr)
    return expr


def rp_bucket(rp: ColumnOrName, oep_points: Iterable[int]) -> Column:
    """Largest configured OEP return period ``p`` with ``rp >= p``; else 0."""
    expr = F.lit(0)
    for p in sorted(oep_points):
        expr = F.when(_c(rp) >= F.lit(p), F.lit(int(p))).otherwise(expr)
    return expr.cast("int")


def any_null(*cols: ColumnOrName) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | _c(c).isNull()
    return out
