"""Column helpers that pin down missing-value, division and membership semantics.

All helpers return JVM-side ``Column`` expressions (whole-stage codegen, no
Python UDF). Spark differs from data-frame semantics in several places:

* equality joins drop NULL keys          -> ``null_safe_on`` (NULL matches NULL)
* ``~isin`` on NULL is NULL (row lost)   -> ``not_in`` (NULL row kept)
* ``sum`` skips NULL                     -> ``strict_sum`` (one NULL poisons)
* ``sum`` of all-NULL is NULL            -> ``sum_na_rm`` (0, NaN ignored)
* ANSI ``x/0`` raises                    -> ``ieee_div`` (+-Inf / NaN)
* NaN is not NULL                        -> ``nan_to_null``
* ``cast`` of bad text raises            -> ``to_number`` (bad text -> 0)
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

def _null_double() -> Column:
    return F.lit(None).cast("double")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str | tuple[str, str]]) -> Column:
    """Join condition where NULL keys match each other (``<=>``).

    ``keys`` items are a shared name or a ``(left_name, right_name)`` pair. Spark
    still plans ``<=>`` as an equi-join key (hash/sort-merge/broadcast), so this
    costs no nested loop.
    """
    cond = None
    for k in keys:
        lk, rk = (k, k) if isinstance(k, str) else k
        c = left[lk].eqNullSafe(right[rk])
        cond = c if cond is None else cond & c
    return cond


def not_in(c, values: Iterable) -> Column:
    """``NOT (c IN values)`` that is TRUE for a NULL ``c`` (the row is kept)."""
    return ~F.coalesce(_col(c).isin(list(values)), F.lit(False))


def strict_sum(c) -> Column:
    """Sum that is NULL as soon as one input is NULL (no ``na.rm``).

    Both parts are algebraic, so the aggregate keeps its map-side partial stage.
    """
    c = _col(c)
    return F.when(F.count(c) < F.count(F.lit(1)), _null_double()).otherwise(F.sum(c).cast("double"))


def sum_na_rm(c) -> Column:
    """Sum ignoring NULL and NaN; an all-missing group sums to 0."""
    return F.coalesce(F.sum(nan_to_null(c)), F.lit(0.0))


def ieee_div(n, d) -> Column:
    """IEEE-754 division: x/0 = +-Inf, 0/0 = NaN, NULL operand = NULL.

    The ``otherwise`` branch is only evaluated for non-zero divisors, so ANSI
    mode never raises. NaN is tested first because Spark orders NaN above
    every number (``NaN > 0`` is true).
    """
    n, d = _col(n).cast("double"), _col(d).cast("double")
    # a zero divisor keeps its sign: 1/-0.0 is -Inf
    sign = F.when(d.cast("string").startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    at_zero = (
        F.when(F.isnan(n), F.lit(float("nan")))
        .when(n > 0, sign * F.lit(float("inf")))
        .when(n < 0, sign * F.lit(float("-inf")))
        .when(n == 0, F.lit(float("nan")))
    )
    return F.when(d.isNull() | n.isNull(), _null_double()).when(d == 0, at_zero).otherwise(n / d)


def nan_to_null(c) -> Column:
    """NaN -> NULL; +-Inf and ordinary values pass through."""
    return F.nanvl(_col(c).cast("double"), _null_double())


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Apply ``nan_to_null`` to every floating-point column, keep the rest."""
    return df.select(*[
        nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def parse_number(c) -> Column:
    """Lenient text -> double: NULL for text that is not a number.

    Accepts what a data-frame number parser accepts: decimal and exponent
    forms, ``inf``/``infinity`` in any case with a sign, and hexadecimal
    integers (``0x1A`` = 26). Java's parser also accepts a trailing type suffix
    (``'12d'``); numeric text never ends that way, so such values are rejected.
    """
    text = _col(c).cast("string")
    s = F.regexp_replace(text, r"^\s+|\s+$", "")
    hex_digits = F.ltrim(F.regexp_extract(s, "^[+-]?0[xX]([0-9a-fA-F]+)$", 1), F.lit("0"))
    is_hex = s.rlike("^[+-]?0[xX][0-9a-fA-F]+$")
    # digit by digit, so that any number of digits fits a double
    digits = F.transform(F.split(F.lower(hex_digits), ""), lambda d: F.instr(F.lit("0123456789abcdef"), d) - 1)
    hex_value = F.aggregate(digits, F.lit(0.0), lambda acc, d: acc * 16 + F.greatest(d, F.lit(0)).cast("double"))
    sign = F.when(s.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    # whole numbers, nearly all values, need none of the patterns; read as double, -0 keeps its sign
    return (F.when(text.try_cast("bigint").isNotNull(), text.try_cast("double"))
            .when(s.rlike("(?i)^[+]?inf(inity)?$"), F.lit(float("inf")))
            .when(s.rlike("(?i)^-inf(inity)?$"), F.lit(float("-inf")))
            .when(is_hex & (hex_digits == ""), sign * 0.0)
            .when(is_hex, sign * hex_value)
            .when(s.rlike("[dDfF]$"), _null_double())
            .otherwise(s.try_cast("double")))


def to_number(c) -> Column:
    """Text -> double with every missing outcome (NULL, NaN, bad text) as 0."""
    return F.coalesce(F.nanvl(parse_number(c), F.lit(0.0)), F.lit(0.0))
