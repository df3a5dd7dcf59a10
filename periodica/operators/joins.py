"""Key joins for rows whose keys may be very unevenly spread.

Looked-up keys are made unique first. Spark would then join on the layout the aggregate leaves
behind, and the adaptive skew join, which only splits partitions that a join asked for itself,
would not apply. Joining on the key as one struct makes the join ask for its own shuffle on both
sides, so a partition that one hot key has filled is split over many tasks. A small looked-up side
is still broadcast, by its measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.functions.scalars import all_known, all_of

KEY = "_lookup_key"


def key_of(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys as one column; keys with a NULL part are left out and so never match."""
    return df.select(*keys).where(all_known(keys)).distinct().select(key_of(keys).alias(KEY))


def rows_with(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose (composite) key occurs in ``other``; NULL keys never match."""
    return rows.join(unique_keys(other, keys), key_of(keys) == F.col(KEY), "left_semi")


def rows_without(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], condition: Column | None = None
) -> DataFrame:
    """Rows whose key does not occur in ``other``; rows with a NULL key stay.

    With ``condition`` only rows that satisfy it can be dropped.
    """
    on = key_of(keys) == F.col(KEY)
    if condition is not None:
        on = on & F.coalesce(condition, F.lit(False))
    return rows.join(unique_keys(other, keys), on, "left_anti")


def new_rows(rows: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows_without`` for few rows against a large ``held``.

    ``held`` is cut to the keys of ``rows`` first, so that a small ``rows`` is broadcast against it
    and only keys found on both sides are shuffled.
    """
    return rows_without(rows, rows_with(held.select(*keys), rows, keys), keys)


def key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Join condition over a composite key."""
    pairs = [(left[k], right[k]) for k in keys]
    return all_of(*[a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
