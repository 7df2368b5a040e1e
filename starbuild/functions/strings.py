"""String helpers (column names and split parts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_name(name: str) -> str:
    """Header normalisation: strip, lower-case, space and dash -> underscore."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def split_part(c: str | Column, sep: str, index: int, trim: bool = True) -> Column:
    """Part ``index`` (0-based) of ``c`` split on the literal ``sep``.

    ``get`` returns NULL for a missing part (``getItem`` raises under ANSI),
    so a one-part value yields NULL for part 1.
    """
    col = F.col(c) if isinstance(c, str) else c
    part = F.get(F.split(col, _regex_quote(sep)), index)
    return F.trim(part) if trim else part


def _regex_quote(s: str) -> str:
    special = set(".^$*+?{}[]\\|()")
    return "".join("\\" + ch if ch in special else ch for ch in s)
