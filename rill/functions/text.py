"""Text column functions (all JVM-side built-ins; no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the ASCII whitespace class used to tokenise text.  The SQL
# oracle uses the same class so both engines cut identical tokens.
WHITESPACE = r"[\t\n\x0B\f\r ]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """whitespace tokenisation; empty tokens are removed (P10)."""
    return F.filter(F.split(_col(text), WHITESPACE), lambda t: t != "")


def space_tokens(text) -> Column:
    """split on one literal space, keeping empty pieces."""
    return F.split(_col(text), " ")


def first_part(text, sep: str) -> Column:
    """text before the first occurrence of a literal separator."""
    return F.substring_index(_col(text), sep, 1)


def integer_text(c) -> Column:
    """The integer that a text holds (38 digits at most), else null."""
    return F.when(_col(c).rlike(r"^[+-]?[0-9]+\z"), _col(c).try_cast("decimal(38,0)"))


def hashtags(text, cut: str = ",2021") -> Column:
    """Words starting with ``#`` in the text before ``cut``."""
    words = F.split(first_part(text, cut), " ")
    return F.filter(words, lambda w: w.startswith("#"))


#: Where ``exact_sum`` cuts integers (a power of ten).
_CUT_DIGITS = 20


def exact_sum(v: Column) -> Column:
    """The sum of integers of up to 38 digits as text, null if there is none.

    The sum of such numbers can have more digits than a decimal holds, so what is
    above and below the twentieth digit is added up on its own and put together as
    text.  Exact for up to 10^10 times 10^9 rows."""
    base = F.lit("1" + "0" * _CUT_DIGITS).cast("decimal(21,0)")
    quotient = lambda a: F.call_function("div", a, base).cast("decimal(20,0)")  # noqa: E731  towards zero
    high, low = F.sum(quotient(v)), F.sum((v % base).cast("decimal(21,0)"))
    high, low = (high + quotient(low)).cast("decimal(38,0)"), (low % base).cast("decimal(21,0)")
    # parts of opposite signs: one of the upper goes over to the lower
    step = F.when((high > 0) & (low < 0), -1).when((high < 0) & (low > 0), 1).otherwise(0)
    high, low = high + step, low - step * base
    sign = F.when((high < 0) | (low < 0), "-").otherwise("")
    text = lambda c: F.abs(c).cast("decimal(38,0)").cast("string")
    whole = F.when(high == 0, text(low)).otherwise(F.concat(text(high), F.lpad(text(low), _CUT_DIGITS, "0")))
    return F.concat(sign, whole)
