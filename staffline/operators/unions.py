"""By-name UNION ALL variants and the column-set algebra they rely on."""

from __future__ import annotations

import functools
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, NumericType, StructType

from .projections import stamp_load_date

log = logging.getLogger(__name__)


class SchemaMismatch(ValueError):
    pass


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    bset = set(b.columns)
    return [c for c in a.columns if c in bset]


def all_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return a.columns + [c for c in b.columns if c not in set(a.columns)]


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in wanted if c not in have]


def _types(df: DataFrame) -> dict[str, DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def types_match(a: DataFrame, b: DataFrame) -> bool:
    """True when there is at least one common column and all of them share a type."""
    cols = common_columns(a, b)
    if not cols:
        return False
    ta, tb = _types(a), _types(b)
    return all(ta[c] == tb[c] for c in cols)


def union_strict(*dfs: DataFrame) -> DataFrame:
    """``rbind``: exactly the same column-name set, aligned by name."""
    first = set(dfs[0].columns)
    for d in dfs[1:]:
        if set(d.columns) != first:
            raise SchemaMismatch(f"column sets differ: {sorted(first ^ set(d.columns))}")
    return functools.reduce(lambda a, b: a.unionByName(b), dfs)


def _compatible(a: DataType, b: DataType) -> bool:
    return a == b or (isinstance(a, NumericType) and isinstance(b, NumericType))


_NUMERIC_RANK = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3, "float": 4, "double": 5}


def _wider(a: DataType, b: DataType) -> DataType:
    """The wider of two numeric types (decimals and unknown ranks widen to double)."""
    ra, rb = _NUMERIC_RANK.get(a.simpleString()), _NUMERIC_RANK.get(b.simpleString())
    if ra is None or rb is None:
        return DoubleType()
    return a if ra >= rb else b


def union_fill_missing(*dfs: DataFrame) -> DataFrame:
    """``bind_rows``: align by name, missing columns -> NULL, numeric types widen,
    any other type clash is an error raised here (not at run time)."""
    seen: dict[str, DataType] = {}
    for d in dfs:
        for f in d.schema.fields:
            t = seen.get(f.name)
            if t is not None and not _compatible(t, f.dataType):
                raise SchemaMismatch(f"column {f.name!r}: {t.simpleString()} vs {f.dataType.simpleString()}")
            seen[f.name] = f.dataType if t is None else (t if t == f.dataType else _wider(t, f.dataType))
    aligned = []
    for d in dfs:
        types = _types(d)
        if all(types[c] == seen[c] for c in d.columns):
            aligned.append(d)  # nothing to cast: no extra projection
            continue
        aligned.append(d.select(*[
            F.col(f"`{c}`").cast(seen[c]).alias(c) if types[c] != seen[c] else F.col(f"`{c}`")
            for c in d.columns
        ]))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def union_contracted(main: DataFrame, other: DataFrame, load_date: str | None = None) -> DataFrame | None:
    """Contracted append: refuse (None) when there is no common column or a
    common column changes type; otherwise fill missing columns with NULL, union
    and stamp the load date."""
    if not types_match(main, other):
        log.warning("contracted union refused: %s", "no common columns" if not common_columns(main, other)
                    else "a common column changes type")
        return None
    cols = all_columns(main, other)
    ta, tb = _types(main), _types(other)
    schema = StructType([f for f in main.schema.fields] + [f for f in other.schema.fields if f.name not in ta])

    def fill(df: DataFrame, types: dict) -> DataFrame:
        return df.select(*[
            F.col(f"`{c}`") if c in types else F.lit(None).cast(schema[c].dataType).alias(c) for c in cols
        ])

    return stamp_load_date(fill(main, ta).unionByName(fill(other, tb)), load_date)


def union_contracted_counted(main: DataFrame, other: DataFrame, load_date: str | None = None):
    """``union_contracted`` plus the two row counts the append reports (rows of
    ``main``, rows of the result) as ``Observation``s on the same plan: they are
    filled by the next action on the result, without an extra job. Returns
    ``(df, main_rows, result_rows)`` or ``(None, None, None)`` when refused."""
    from .aggregates import observe_rows

    counted_main, main_rows = observe_rows(main, "main_rows")
    result = union_contracted(counted_main, other, load_date)
    if result is None:
        return None, None, None
    result, result_rows = observe_rows(result, "result_rows")
    return result, main_rows, result_rows
