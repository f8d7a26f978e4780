"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The season words and their numbers, the month ranges of the
# seasons (meteorological, northern hemisphere) and the placeholder text that
# marks a missing value in the raw catalogue.
SEASON_NUMBER = {"Winter": 1, "Spring": 2, "Summer": 3, "Fall": 4}
SEASON_OF_MONTH = {12: "Winter", 1: "Winter", 2: "Winter",
                   3: "Spring", 4: "Spring", 5: "Spring",
                   6: "Summer", 7: "Summer", 8: "Summer",
                   9: "Fall", 10: "Fall", 11: "Fall"}
UNKNOWN = "Unknown"

# Letters, digits and underscore in any script: Java's \w is ASCII only.
WORD_CLASS = r"\p{L}\p{N}_"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """Text or number to double; text that is not a number becomes null."""
    return col_(c).try_cast("double")


def strip_ws(c) -> Column:
    """Strip leading and trailing white space of every kind (tabs, newlines)."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def clip(c, lo: float, hi: float) -> Column:
    """Bound to [lo, hi]; null stays null (greatest/least alone would skip it)."""
    x = col_(c)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi))))


def r6(c) -> Column:
    """Round to 6 decimals: sums of doubles differ in the last bits between
    engines and runs, so every reported double goes through this."""
    return F.round(col_(c), 6)


def split_list(c, sep: str = ",") -> Column:
    """'a, b' to ['a', 'b'] with every element stripped."""
    return F.transform(F.split(col_(c), sep), lambda x: strip_ws(x))


def season_of(ts) -> Column:
    """Season word of a timestamp's month."""
    m = F.month(col_(ts))
    expr = None
    for month, word in SEASON_OF_MONTH.items():
        expr = F.when(m == month, F.lit(word)) if expr is None else expr.when(m == month, F.lit(word))
    return expr


def season_number(word) -> Column:
    w = col_(word)
    expr = None
    for name, num in SEASON_NUMBER.items():
        expr = F.when(w == name, F.lit(num)) if expr is None else expr.when(w == name, F.lit(num))
    return expr


def dot(a, b) -> Column:
    """Dot product of two equal-length double arrays (JVM-side)."""
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: x * y),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(col_(a), lambda x: x * x),
                              F.lit(0.0), lambda acc, v: acc + v))


def md5_key(*cols) -> Column:
    """Stable hex hash of the given columns, joined by '-'. Used for seeded
    samples and splits that do not depend on partitioning."""
    return F.md5(F.concat_ws("-", *[col_(c).cast("string") for c in cols]))


def hex_threshold(share: float, digits: int = 4) -> str:
    """Hex prefix such that md5 prefixes below it make up `share` of keys."""
    top = 16 ** digits
    v = max(0, min(top, int(round(share * top))))
    if v >= top:
        return "g" * digits  # above every hex digit
    return format(v, f"0{digits}x")
