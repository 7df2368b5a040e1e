"""Fact build: attach a dimension key by a left join, then lay out columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.operators.columns import project
from starbuild.operators.joins import hashable_columns, salted_left_join


def attach_dimension_key(fact: DataFrame, dim: DataFrame, on: Sequence[str], key: str,
                         as_name: str | None = None, salt_by: Sequence[str] | None = None,
                         hot: Mapping[int, int] | Sequence[int] = (), salt_buckets: int | None = None) -> DataFrame:
    """Left-join ``dim[key]`` onto ``fact`` by the shared columns ``on``.

    Fact rows with a NULL in any join column keep a NULL key (NULL never
    equals NULL).  Every fact row is kept exactly once provided the dim is
    unique on ``on`` (true for ``combination_dimension``).

    There is one join for every size of ``dim``; Spark broadcasts it or not
    from its bytes.  In case it does not, ``salt_by`` (the fact key's columns)
    spreads fact rows that would pile onto few partitions: rows with a NULL
    flag, which can only hash on their remaining flags, and rows of the ``hot``
    combinations (see ``salted_left_join``).  Without ``salt_by`` every
    column that can be hashed is used; columns of other types (maps) only
    travel along.
    """
    d = dim.select(*[F.col(f"`{c}`").alias(f"_d_{c}") for c in on], F.col(f"`{key}`"))
    out = salted_left_join(fact, d, [(c, f"_d_{c}") for c in on], salt_by or hashable_columns(fact),
                           hot, salt_buckets)
    out = out.drop(*[f"_d_{c}" for c in on])
    if as_name and as_name != key:
        out = out.withColumnRenamed(key, as_name)
    return out


def build_fact(fact: DataFrame, dim: DataFrame, on: Sequence[str], key: str,
               layout: Sequence[tuple[str, str, str | None]],
               salt_by: Sequence[str] | None = None, hot: Mapping[int, int] | Sequence[int] = ()) -> DataFrame:
    """Join the combination key, then select/rename/cast/reorder to ``layout``
    (``(target, source, type)`` triples; ``source`` may be the dim key)."""
    return project(attach_dimension_key(fact, dim, on, key, salt_by=salt_by, hot=hot), layout)
