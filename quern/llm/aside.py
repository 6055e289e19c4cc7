"""Keep a table's own columns out of the way of the columns that an operator adds."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def names_after(df: DataFrame, names: Iterable[str]) -> dict[str, str]:
    """The names that ``set_aside`` gives to the columns of ``df``."""
    taken = {n.lower() for n in names}
    return {c: f"_aside_{i}" if c.lower() in taken else c for i, c in enumerate(df.columns)}


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns of those names renamed, and a function that selects all its columns as they were."""
    new = names_after(df, names)
    moved = df.select(*[F.col(f"`{c}`").alias(n) for c, n in new.items()])
    return moved, lambda out: out.select(*[F.col(f"`{n}`").alias(c) for c, n in new.items()])
