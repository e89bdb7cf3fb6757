"""Joining event rows with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join event rows with a lookup table of any size.

    Nothing is hinted: adaptive execution broadcasts a lookup that turns out to be within the
    session's own limit in bytes, and otherwise shuffles both sides and splits the partition of a
    hot key. For that the lookup must be a stored table or a projection of one; a result that is
    already partitioned by the keys would be joined without a shuffle of its own.
    """
    return rows.join(lookup, keys, how)
