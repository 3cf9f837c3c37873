"""File-name helpers for submissions landed one workbook per file or folder."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decoded(c) -> Column:
    """URL-decode a ``_metadata`` path component (``+`` kept literal)."""
    return F.url_decode(F.replace(_col(c), F.lit("+"), F.lit("%2B")))


def base_name(path) -> Column:
    """Last path component of a path string."""
    return F.element_at(F.split(_col(path), "/"), -1)


def provider_from_name(name, marker: str = "24-25", regex: bool = False) -> Column:
    """Text before the first fiscal-year marker, trimmed; the whole name if absent."""
    pattern = marker if regex else re.escape(marker)
    return F.trim(F.element_at(F.split(_col(name), pattern), 1))


def marker_in_name(name, configured: str | None = None) -> Column:
    """The fiscal-year marker of a workbook name, NULL when it has none.

    The configured marker wins when the name holds it; otherwise the first
    ``yy-yy`` of two consecutive years counts (``31-07`` is a date, not a year).
    """
    name = _col(name)
    found = F.regexp_extract_all(name, F.lit(r"(?<![0-9])([0-9]{2}-[0-9]{2})(?![0-9])"), F.lit(1))
    years = F.filter(found, lambda m: (m.substr(1, 2).cast("int") + 1) % 100 == m.substr(4, 2).cast("int"))
    first = F.get(years, F.lit(0))
    return first if configured is None else F.when(name.contains(configured), F.lit(configured)).otherwise(first)


def trimmed(text) -> F.Column:
    """Text without white space around it; nothing is left of a blank one (NULL), as sheet readers do."""
    c = F.col(text) if isinstance(text, str) else text
    return F.nullif(F.btrim(c.cast("string"), F.lit(" \t\r\n")), F.lit(""))
