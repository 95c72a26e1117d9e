"""Incremental writes as joins: insert-only, history, upsert, partial update.

Each takes the target as a frame (or None on a first run) and returns frames, so the same
functions serve batch, streaming and tests. Duplicate handling always goes through a
grouped aggregate: it combines before the shuffle, so one key that holds a third of the
rows costs one row per map task, never one huge group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(src: DataFrame, keys: list[str], order_by: list[str] | None = None
                ) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by all other columns."""
    rest = [c for c in src.columns if c not in keys]
    ordered = (order_by or []) + [c for c in rest if c not in (order_by or [])]
    first = F.min(F.struct(*ordered)).alias("_first")
    return (src.groupBy(*keys).agg(first)
            .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c)
                      for c in src.columns]))


def unseen(src: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the target.

    The target is first reduced to the keys of the source: for a small batch Spark broadcasts those
    keys and reads the target's key columns in place, so a load does not shuffle all of history.
    Then an anti join, not NOT IN: vault keys are hashes of non-null ids, and NOT IN over several
    columns would compare every pair of rows.
    """
    if target is None:
        return src
    known = target.select(*keys).join(src.select(*keys).distinct(), keys, "left_semi")
    return src.join(known, keys, "left_anti")


def insert_if_absent(src: DataFrame, target: DataFrame | None, keys: list[str],
                     order_by: list[str] | None = None) -> DataFrame:
    """Rows to append so that every key of the source exists exactly once."""
    return unseen(one_per_key(src, keys, order_by), target, keys)


def last_per_key(updates: DataFrame, keys: list[str]) -> DataFrame:
    """One update per key, so that none multiplies rows: the largest by all other columns."""
    rest = [c for c in updates.columns if c not in keys]
    if not rest:
        return updates.dropDuplicates(keys)
    return (updates.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_last"))
            .select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c)
                      for c in updates.columns]))


def upsert(target: DataFrame | None, updates: DataFrame, keys: list[str]) -> DataFrame:
    """The target after the merge: matching keys replaced, new keys added.

    Of several updates of a key one is taken (see ``last_per_key``).
    """
    updates = last_per_key(updates, keys)
    if target is None:
        return updates
    kept = target.join(updates.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(updates)


def partial_update(target: DataFrame, updates: DataFrame, keys: list[str],
                   always: dict[str, Column] | None = None) -> DataFrame:
    """Existing rows with the non-null fields of their update; no rows are added.

    ``always`` holds expressions over the merged row for columns such as stamps; they
    see the update's columns under the prefix ``new_``.
    """
    updates = last_per_key(updates, keys)
    changed = [c for c in updates.columns if c not in keys]
    renamed = updates.select(*keys, *[F.col(c).alias(f"new_{c}") for c in changed],
                             F.lit(True).alias("_hit"))
    joined = target.join(renamed, keys, "left")
    out = []
    for name in target.columns:
        if always and name in always:
            value = F.when(F.col("_hit"), always[name]).otherwise(F.col(name))
        elif name in changed:
            value = F.coalesce(F.col(f"new_{name}"), F.col(name))
        else:
            value = F.col(name)
        out.append(value.cast(target.schema[name].dataType).alias(name))
    return joined.select(*out)


def sync_columns(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Target rows in the incoming schema: new columns NULL, gone columns dropped."""
    have = set(target.columns)
    return target.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in incoming.schema.fields])


def append_synced(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both row sets in the incoming schema."""
    return sync_columns(target, incoming).unionByName(incoming)
