"""Names for an operator's own columns that clash with none of the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def private(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores before it as it takes to differ from every column of `df`, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
