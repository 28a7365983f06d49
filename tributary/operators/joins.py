"""How a join is made, by counted rows: Spark guesses a table's size from its files and doesn't see that rows were made from them, so it may broadcast a large one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: a table of up to so many rows may be broadcast.
SMALL = 20_000


def is_small(df: DataFrame) -> bool:
    return df.limit(SMALL + 1).count() <= SMALL


def large(df: DataFrame) -> DataFrame:
    """For a table that grows with the input: sorted and merged, never broadcast."""
    return df.hint("merge")


def sized(df: DataFrame, small: bool | None = None) -> DataFrame:
    """Broadcast if it is small, which is counted unless told, else sorted and merged."""
    return F.broadcast(df) if (is_small(df) if small is None else small) else large(df)
