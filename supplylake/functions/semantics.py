"""Null, NaN, division and rounding rules, decided once.

All helpers return JVM-side Column expressions; nothing here runs Python
per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The whitespace set Python's str.strip() removes for ASCII text.
WHITESPACE = " \t\n\r\u000b\u000c"

# Text tokens pandas.read_csv reads as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL (pandas treats NaN as missing; Spark orders NaN above +inf)."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def strip_ws(c) -> Column:
    """Python ``str.strip()``: plain ``trim`` only removes spaces."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def null_tokens_to_null(c) -> Column:
    c = col_(c)
    return F.when(strip_ws(c).isin(NULL_TOKENS), F.lit(None)).otherwise(c)


def to_number(c) -> Column:
    """``pd.to_numeric(errors='coerce')`` for text: bad text -> NULL, NaN -> NULL.

    Spark accepts Java suffixes ('1d', '2f') that pandas rejects; those are
    nulled, while 'inf' / '-inf' stay infinite as in pandas.
    """
    s = strip_ws(col_(c).cast("string"))
    java_suffix = s.rlike("[dDfF]$") & ~F.lower(s).rlike("^[+-]?inf$")
    v = s.try_cast(T.DoubleType())
    return F.when(java_suffix, F.lit(None).cast("double")).otherwise(nan_to_null(v))


def safe_ratio(num, den, scale: float | None = None, guard: str = "gt") -> Column:
    """``np.where(den > 0 | den != 0, num/den [*scale], 0.0)``.

    Division happens in DOUBLE.  A NULL denominator takes the 0.0 branch.
    """
    num = col_(num).cast("double")
    den = col_(den).cast("double")
    cond = den > 0 if guard == "gt" else den != 0
    q = num / den
    if scale is not None:
        q = q * F.lit(float(scale))
    return F.when(cond, q).otherwise(F.lit(0.0))


def clip_keep_null(c, lo: float, hi: float) -> Column:
    """``Series.clip(lo, hi)``: NULL stays NULL (bare greatest/least would not)."""
    c = col_(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.greatest(F.lit(float(lo)), F.least(c.cast("double"), F.lit(float(hi)))))


def lower_clip(c, lo: float = 0.0) -> Column:
    c = col_(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c.cast("double"), F.lit(float(lo))))


def cut_right(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut(x, [-inf, *edges, inf], labels)``: right-closed bins.

    NULL and -inf fall outside every bin (NULL label); +inf takes the last.
    """
    c = col_(c).cast("double")
    assert len(labels) == len(edges) + 1
    expr = F.when(c.isNull() | (c == F.lit(float("-inf"))), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        expr = expr.when(c <= F.lit(float(edge)), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def round_ieee(c, digits: int) -> Column:
    """Half-away-from-zero rounding by plain double arithmetic.

    Both Spark and the SQL oracle compute ``sign(x)*floor(|x|*10^d + 0.5)/10^d``
    bit-identically, unlike the engines' own ``round`` on DOUBLE.  From
    |x|*10^d = 2^53 on a double has no digits to round: such values, infinities
    and NaN stay as they are (``floor`` would saturate at the BIGINT range).
    """
    c = col_(c).cast("double")
    p = float(10 ** digits)
    scaled = F.abs(c) * F.lit(p)
    rounded = F.signum(c) * F.floor(scaled + F.lit(0.5)).cast("double") / F.lit(p)
    return F.when(F.isnan(c) | (scaled >= F.lit(float(2 ** 53))), c).otherwise(rounded)


def bool_int(pred: Column) -> Column:
    """Boolean -> 0/1 with NULL counted as False (pandas comparison semantics)."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def exact_sum(c, scale: int = 4) -> Column:
    """Order-independent sum of a DOUBLE column holding ``scale`` decimals.

    Finite values are summed as DECIMAL (exact, engine-independent); as in
    pandas, NaN is skipped, an infinity makes the sum infinite and both
    signs make it NaN (a DECIMAL cast of those would raise under ANSI).
    """
    x = col_(c).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    dec = F.sum(F.when(finite, x).cast(T.DecimalType(38, scale))).cast("double")
    pos = F.max((x == F.lit(float("inf"))).cast("int")) == 1
    neg = F.max((x == F.lit(float("-inf"))).cast("int")) == 1
    return (F.when(pos & neg, F.lit(float("nan")))
            .when(pos, F.lit(float("inf")))
            .when(neg, F.lit(float("-inf")))
            .otherwise(dec))


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.NumericType, T.BooleanType))
