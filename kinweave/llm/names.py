"""Column names of an operator beside whatever columns its input brings along."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def free(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def aside(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns called like ``names`` out of the way, and what gives them their own names back."""
    lower = {n.lower() for n in names}
    moved = {}
    for c in df.columns:
        if c.lower() in lower:
            moved[c] = free(f"{c}_own", df)
            df = df.withColumnRenamed(c, moved[c])

    def back(out: DataFrame) -> DataFrame:
        for c, other in moved.items():
            out = out.drop(c).withColumnRenamed(other, c)
        return out

    return df, back
