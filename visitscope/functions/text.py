"""String and number helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Veltkamp split factor 2**27 + 1 and the largest double below which every
# product of the rounding step still has an exactly representable floor.
_SPLIT = 134217729.0
_EXACT_LIMIT = float(2 ** 53)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Empty text is treated like a missing value."""
    return F.nullif(_col(c), F.lit(""))


def trim_comma(c: Column | str) -> Column:
    """Drop one leading and one trailing comma, nothing more (C11).

    `,,a,,` becomes `,a,`; `,` becomes the empty string.
    """
    c = _col(c)
    head_cut = F.when(F.startswith(c, F.lit(",")), c.substr(F.lit(2), F.length(c))).otherwise(c)
    return F.when(
        F.endswith(head_cut, F.lit(",")),
        head_cut.substr(F.lit(1), F.length(head_cut) - 1),
    ).otherwise(head_cut)


def pad_two(c: Column | str) -> Column:
    """Two-character text is kept; anything else gets one `0` in front.

    Unlike `lpad`, longer text is never cut: `123` becomes `0123`.
    """
    c = _col(c)
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def _split_hi(v: Column) -> Column:
    t = v * F.lit(_SPLIT)
    return t - (t - v)


def round_half_up(c: Column | str, scale: int) -> Column:
    """Round the *exact binary value* of a double half away from zero.

    `1.005` is stored as 1.00499999999999989... and so gives 1.0, and
    `2.675` gives 2.67 -- unlike `F.round`, which rounds the shortest decimal
    text of the double (1.01, 2.68). With p = |x| * 10^scale rounded to a
    double and err its exact rounding error (Dekker's two-product, plain
    double arithmetic, so the expression stays small and inside whole-stage
    codegen), the result rounds up iff frac(p) + err >= 1/2. This is exact
    while p < 2^53; from there on |x| has no binary digit finer than
    half of 10^-scale, and x itself is the nearest double to the
    rounded value.
    Null gives null; NaN and infinities pass through.
    """
    if not 0 <= scale <= 15:
        raise ValueError("scale must be within 0..15")
    x = _col(c).cast("double")
    # Work on a non-null value so the generated code carries no null checks
    # (keeps several of these columns inside one JIT-compilable method).
    a = F.abs(F.coalesce(x, F.lit(0.0)))
    m_value = float(10 ** scale)
    m = F.lit(m_value)
    p = a * m
    n = F.floor(p).cast("double")
    frac = p - n
    a_hi = _split_hi(a)
    a_lo = a - a_hi
    if m_value < 2.0 ** 26:
        # m has at most 26 significant bits: both partial products are exact
        err = (a_hi * m - p) + a_lo * m
    else:
        m_hi = m_value * _SPLIT - (m_value * _SPLIT - m_value)
        m_lo = m_value - m_hi
        err = ((a_hi * F.lit(m_hi) - p) + a_hi * F.lit(m_lo) + a_lo * F.lit(m_hi)) + a_lo * F.lit(m_lo)
    # round up iff frac + err >= 1/2; both sides of the comparison are exact
    # wherever the answer is close (Sterbenz), so the decision is exact
    up = (frac - F.lit(0.5)) >= -err
    k = n + up.cast("double")
    magnitude = F.when(p < F.lit(_EXACT_LIMIT), k / m).otherwise(a)
    # the sign of x restores the sign (and gives null for null input)
    return magnitude * F.signum(x)
