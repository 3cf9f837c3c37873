"""Joins with data-frame key semantics (NULL matches NULL) and explicit
broadcast policy.

Broadcast policy: a side is forced to be broadcast only where the code itself
bounds its rows (the dashboard grid, literal frames). Everything else is left
to Catalyst's size-checked auto-broadcast plus AQE's runtime join re-planning
and skew-join splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import null_safe_on
from ..session import landed

KeySpec = Sequence[str | tuple[str, str]]


def _pairs(keys: KeySpec) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in keys]


def inner_null_safe(left: DataFrame, right: DataFrame, keys: KeySpec) -> DataFrame:
    """Inner equi-join, NULL keys match; one copy of each key (left names)."""
    pairs = _pairs(keys)
    l, r = left.alias("l"), right.alias("r")
    joined = l.join(r, null_safe_on(l, r, pairs), "inner")
    right_keys = {rk for _, rk in pairs}
    return joined.select(
        *[F.col(f"l.`{c}`") for c in left.columns],
        *[F.col(f"r.`{c}`") for c in right.columns if c not in right_keys],
    )


def fan_out(left: DataFrame, right: DataFrame, keys: KeySpec) -> DataFrame:
    """Exact size of ``inner_null_safe(left, right, keys)`` before it is run.

    One row per key that both sides hold: the keys, ``left_rows``,
    ``right_rows`` and their product ``rows``; the sum of ``rows`` is the number
    of rows of the join. Both counts are partial aggregates, so hot keys cost nothing.
    """
    pairs = _pairs(keys)
    n = F.count(F.lit(1))
    lefts = left.groupBy(*[F.col(f"`{lk}`") for lk, _ in pairs]).agg(n.alias("left_rows"))
    rights = right.groupBy(*[F.col(f"`{rk}`").alias(lk) for lk, rk in pairs]).agg(n.alias("right_rows"))
    both = inner_null_safe(lefts, rights, [lk for lk, _ in pairs])
    return both.withColumn("rows", F.col("left_rows") * F.col("right_rows"))


#: rows of one key that one task joins, about
ROWS_PER_SPLIT = 500_000


def full_outer_coalesced(left: DataFrame, right: DataFrame, keys: KeySpec, skew_safe: bool = True,
                         rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Full outer join, NULL keys match, key columns coalesced (left names).

    ``skew_safe`` splits keys that are hot on either side, which AQE cannot do
    for a full outer join; the rows are the same. See ``_full_outer_split``.
    """
    if skew_safe:
        return _full_outer_split(left, right, keys, rows_per_split)
    pairs = _pairs(keys)
    lkeys = {lk: rk for lk, rk in pairs}
    right_rest = [c for c in right.columns if c not in lkeys.values()]
    l, r = left.alias("l"), right.alias("r")
    joined = l.join(r, null_safe_on(l, r, pairs), "full")
    out = [F.coalesce(F.col(f"l.`{c}`"), F.col(f"r.`{lkeys[c]}`")).alias(c) if c in lkeys
           else F.col(f"l.`{c}`") for c in left.columns]
    return joined.select(*out, *[F.col(f"r.`{c}`") for c in right_rest])


def _full_outer_split(left: DataFrame, right: DataFrame, keys: KeySpec, rows_per_split: int) -> DataFrame:
    """Full outer join in which every key, hot on one side or on both, is split over tasks.

    Both sides are evaluated once and landed. One aggregate counts the rows of
    each key on both sides: a key that one side lacks gives the unmatched rows of
    the other, and a key of n left and m right rows is cut into a grid of
    ceil(n / rows_per_split) x ceil(m / rows_per_split) cells. Left rows take a
    place on one axis and are copied along the other, right rows the other way
    round, so that every pair meets in exactly one cell. Row numbers of the
    landed files give the places, so a task that is run again deals alike.
    """
    pairs = _pairs(keys)
    names = [lk for lk, _ in pairs]
    right_names = dict((rk, lk) for lk, rk in pairs)
    left_rest = [c for c in left.columns if c not in names]
    right_rest = [c for c in right.columns if c not in right_names]
    # positions instead of names: the sides may share names, and keys may be named like helpers
    l = landed(left.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(names)],
                           *[F.col(f"`{c}`").alias(f"l{i}") for i, c in enumerate(left_rest)]), "full-outer-left")
    r = landed(right.select(*[F.col(f"`{rk}`").cast(left.schema[lk].dataType).alias(f"k{i}") for i, (lk, rk) in enumerate(pairs)],
                            *[F.col(f"`{c}`").alias(f"r{i}") for i, c in enumerate(right_rest)]), "full-outer-right")
    ks = [f"k{i}" for i in range(len(pairs))]
    seen = (l.select(*ks, F.lit(1).alias("in_left"), F.lit(0).alias("in_right"))
            .unionByName(r.select(*ks, F.lit(0).alias("in_left"), F.lit(1).alias("in_right"))))
    size = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / rows_per_split)).cast("long")
    counts = landed(seen.groupBy(*ks).agg(F.sum("in_left").alias("n_left"), F.sum("in_right").alias("n_right"))
                    .withColumns({"cells_left": size("n_left"), "cells_right": size("n_right")}), "full-outer-counts")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        rows = left_null_safe(side.withColumn("row_", F.monotonically_increasing_id()), counts, ks)
        return rows.withColumn(f"at_{own}", F.pmod(F.col("row_"), F.col(f"cells_{own}"))).drop("row_")

    lefts, rights = dealt(l, "left", "right"), dealt(r, "right", "left")
    along = lambda axis: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"cells_{axis}") - 1))
    cells = [*ks, "at_left", "at_right"]
    many = (lefts.filter("n_right > 0").withColumn("at_right", along("right")).select(*cells, *[f"l{i}" for i in range(len(left_rest))]))
    more = (rights.filter("n_left > 0").withColumn("at_left", along("left")).select(*cells, *[f"r{i}" for i in range(len(right_rest))]))
    matched = inner_null_safe(many, more, cells)
    none = lambda frame, c, out: F.lit(None).cast(frame.schema[c].dataType).alias(out)
    ls, rs = [f"l{i}" for i in range(len(left_rest))], [f"r{i}" for i in range(len(right_rest))]
    left_only = lefts.filter("n_right = 0").select(*ks, *ls, *[none(r, c, c) for c in rs])
    right_only = rights.filter("n_left = 0").select(*ks, *[none(l, c, c) for c in ls], *rs)
    rows = matched.select(*ks, *ls, *rs).unionByName(left_only).unionByName(right_only)
    at = {**{k: f"k{i}" for i, k in enumerate(names)}, **{c: f"l{i}" for i, c in enumerate(left_rest)}}
    return rows.select(*[F.col(at[c]).alias(c) for c in left.columns],
                       *[F.col(f"r{i}").alias(c) for i, c in enumerate(right_rest)])


def left_null_safe(left: DataFrame, right: DataFrame, keys: KeySpec) -> DataFrame:
    """Left join, NULL keys match, right key columns dropped (renamed keys allowed)."""
    pairs = _pairs(keys)
    l, r = left.alias("l"), right.alias("r")
    joined = l.join(r, null_safe_on(l, r, pairs), "left")
    right_keys = {rk for _, rk in pairs}
    return joined.select(
        *[F.col(f"l.`{c}`") for c in left.columns],
        *[F.col(f"r.`{c}`") for c in right.columns if c not in right_keys],
    )


def join_with_suffixes(left: DataFrame, right: DataFrame, keys: KeySpec, how: str = "left",
                       suffixes: tuple[str, str] = (".x", ".y")) -> DataFrame:
    """Join that keeps both copies of colliding non-key columns, suffixed."""
    pairs = _pairs(keys)
    lkeys = {lk for lk, _ in pairs}
    rkeys = {rk for _, rk in pairs}
    clash = (set(left.columns) - lkeys) & (set(right.columns) - rkeys)
    l, r = left.alias("l"), right.alias("r")
    joined = l.join(r, null_safe_on(l, r, pairs), how)
    out = []
    for c in left.columns:
        name = c + suffixes[0] if c in clash else c
        if c in lkeys and how in ("full", "outer", "full_outer"):
            rk = dict(pairs)[c]
            out.append(F.coalesce(F.col(f"l.`{c}`"), F.col(f"r.`{rk}`")).alias(name))
        else:
            out.append(F.col(f"l.`{c}`").alias(name))
    for c in right.columns:
        if c in rkeys:
            continue
        out.append(F.col(f"r.`{c}`").alias(c + suffixes[1] if c in clash else c))
    return joined.select(*out)
