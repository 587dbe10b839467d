"""Column functions: everything here is a native Spark expression.

Spark runs with ANSI arithmetic by default, so casts and sums that may leave
the 64-bit range are written in a form that saturates or wraps instead of
raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space characters, the set trimmed from both ends
# of a field name or label.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Characters of a field name that become the path separator.
REPLACED = " .-,()"
SEPARATOR = "_"

I64_MAX = 9223372036854775807
I64_MIN = -9223372036854775808
_LOW = 4294967295  # low 32 bits

# Largest epoch millisecond that Spark's microsecond timestamps can hold.
_TS_MS_MAX = I64_MAX // 1000


def trim_unicode(c: Column) -> Column:
    """Strip Unicode white space from both ends (plain ``trim`` strips only spaces)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def clean_key(c: Column) -> Column:
    """Trim, then map separators and brackets to the path separator."""
    return F.translate(trim_unicode(c), REPLACED, SEPARATOR * len(REPLACED))


def double_to_i64(c: Column) -> Column:
    """Truncate toward zero, saturate at the 64-bit ends, NaN becomes 0."""
    d = c.cast("double")
    return (
        F.when(F.isnan(d), F.lit(0).cast("bigint"))
        .when(d >= F.lit(float(2**63)), F.lit(I64_MAX))
        .when(d <= F.lit(-float(2**63)), F.lit(I64_MIN))
        .otherwise(d.cast("bigint"))
    )


def _high(c: Column) -> Column:
    return F.shiftright(c, 32)


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_LOW))


def _join_halves(high: Column, low: Column) -> Column:
    return F.shiftleft(high + F.shiftright(low, 32), 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))


def wrap_sub(a: Column, b: Column) -> Column:
    """64-bit two's-complement a - b that never overflows."""
    return _join_halves(_high(a) - _high(b), _low(a) - _low(b))


def wrap_sum(c: Column, over=None) -> Column:
    """64-bit wrapping sum: two half-word sums, so up to 2**31 terms are safe."""
    high, low = F.sum(_high(c)), F.sum(_low(c))
    if over is not None:
        high, low = high.over(over), low.over(over)
    return _join_halves(high, low)


def varint_size(c: Column) -> Column:
    """Bytes of the base-128 form; negative values are huge unsigned ones."""
    size = F.when(c < 0, F.lit(10))
    for n in range(1, 9):
        size = size.when(c < F.lit(1 << (7 * n)), F.lit(n))
    return size.otherwise(F.lit(9))


def ms_to_ts(ms: Column) -> Column:
    """Epoch milliseconds to timestamp; NULL where the instant is outside Spark's range.

    The axis is read as unsigned, so a negative value is a far-future instant.
    """
    return F.when(ms.between(0, _TS_MS_MAX), F.timestamp_millis(ms))


def int_div(c: Column, n: int) -> Column:
    """Integer division that rounds down, for negative values too."""
    return F.call_function("div", c - F.pmod(c, F.lit(n).cast("bigint")), F.lit(n).cast("bigint"))


def ms_to_date(ms: Column) -> Column:
    """UTC calendar date of an epoch-millisecond value, whatever the session zone."""
    day = int_div(ms, 86400000).cast("int")
    in_range = ms.between(0, 253402300799999)  # up to the end of year 9999
    return F.when(in_range, F.date_add(F.lit("1970-01-01").cast("date"), day))


def ntz_to_ms(ts: Column) -> Column:
    """Epoch milliseconds of a zone-less UTC timestamp, rounding down."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return int_div(F.timestamp_diff("MICROSECOND", epoch, ts), 1000)
