"""Merges as DataFrame rewrites: update matched rows, insert unmatched ones.

With plain equality a NULL key never matches, so such source rows are always inserted and such
target rows never updated; ``null_safe=True`` lets NULL match NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns under names of their own: both sides of a merge often stem from one table."""
    return df.withColumnsRenamed({k: f"_key_{k}" for k in keys})


def _match(keys: Sequence[str], null_safe: bool) -> Column:
    """Key equality against a side whose keys went through ``_renamed``."""
    test = None
    for k in keys:
        mine, theirs = F.col(k), F.col(f"_key_{k}")
        one = mine.eqNullSafe(theirs) if null_safe else mine == theirs
        test = one if test is None else test & one
    return test


def _one_per_key(source: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Source rows folded to one per key, carrying how many there were as ``_copies``.

    The fold hash-partitions on the merge key, which the join after it needs anyway, and a key
    with many copies is folded before the shuffle.
    """
    # Only rows with one copy are ever used, so the values may be picked one by one.
    folded = source.groupBy(*keys).agg(
        *[F.any_value(v).alias(f"_new_{v}") for v in values], F.count("*").alias("_copies")
    )
    return _renamed(folded, keys)


def _updated_columns(
    target: DataFrame, keys: Sequence[str], matched_set: Mapping[str, str]
) -> list[Column]:
    """Target columns after the update; several source rows for one target row raise."""
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(
        F.lit(f"several source rows match one target row on ({', '.join(keys)}): "), shown
    )
    out = []
    for field in target.schema:
        column = F.col(field.name)
        if field.name in matched_set:
            new = F.col(f"_new_{matched_set[field.name]}").cast(field.dataType)
            column = (
                F.when(F.col("_copies").isNull(), column)
                .when(F.col("_copies") > 1, F.raise_error(message).cast(field.dataType))
                .otherwise(new)
                .alias(field.name)
            )
        out.append(column)
    return out


def merge_update(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched_set: Mapping[str, str],
    null_safe: bool = False,
) -> DataFrame:
    """Target with the columns of ``matched_set`` (target name: source name) overwritten where
    the key matches. A target row matched by several source rows raises when it is computed.
    """
    folded = _one_per_key(source, on, sorted(set(matched_set.values())))
    joined = target.join(folded, _match(on, null_safe), "left")
    return joined.select(*_updated_columns(target, on, matched_set))


def changed_rows(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched_set: Mapping[str, str],
    null_safe: bool = False,
) -> DataFrame:
    """Only the target rows that match, in their new state."""
    folded = _one_per_key(source, on, sorted(set(matched_set.values())))
    joined = target.join(folded, _match(on, null_safe))
    return joined.select(*_updated_columns(target, on, matched_set))


def unseen_rows(
    target: DataFrame, source: DataFrame, on: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Source rows whose key is not in the target. Copies inside the source are all kept.

    The source is usually small against the target. A plain anti join would have to shuffle the
    whole target; finding the source's keys in it first lets a small source be sent to the
    target's scan instead, and leaves an anti join between two small sides.
    """
    wanted = _renamed(source.select(*on).distinct(), on)
    seen = target.select(*on).join(wanted, _match(on, null_safe), "left_semi").distinct()
    return source.join(_renamed(seen, on), _match(on, null_safe), "left_anti")


def merge_insert_new(
    target: DataFrame, source: DataFrame, on: Sequence[str], null_safe: bool = False
) -> DataFrame:
    fresh = unseen_rows(target, source, on, null_safe)
    return target.unionByName(fresh.select(*target.columns))


def merge_into(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched_set: Mapping[str, str] | None = None,
    insert_new: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Both merge branches in one call."""
    out = (
        merge_update(target, source, on, matched_set, null_safe) if matched_set else target
    )
    if insert_new:
        fresh = unseen_rows(target, source, on, null_safe)
        out = out.unionByName(fresh.select(*target.columns))
    return out
