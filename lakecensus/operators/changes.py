"""What changed between two runs: row digests, snapshot differences and validity intervals.

A table's rows are compared by a key and by the digest of their other columns, without surrogate
ids and extraction times, which differ in every run. Only keys and two 64-bit hashes a row are
shuffled. Counts, sums and exclusive ors of the hashes merge before the shuffle, so a key that
repeats (or holds half of a table) is compared as a bag of rows, whatever their order, without
gathering them. Keys may be null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# by table: the key that stays the same from run to run, and surrogate columns that don't
KEYS: dict[str, tuple[list[str], list[str]]] = {
    "meta_workspaces": (["workspace_id"], []),
    "meta_workspace_users": (["workspace_id", "display_name"], ["id"]),
    "meta_workspace_items": (["item_id"], []),
    "meta_semantic_models": (["model_id"], []),
    "meta_datasources": (["workspace_id", "source_item_id", "source_item_type", "datasource_type", "shortcut_name", "shortcut_path"],
                         ["datasource_id"]),
    "meta_refresh_schedules": (["schedule_id"], []),
    "meta_refresh_history": (["workspace_id", "model_id", "start_time"], ["refresh_id"]),
    "meta_reports": (["report_id"], []),
    "meta_dataflows": (["dataflow_id"], []),
    "meta_other_assets": (["asset_id"], []),
    "meta_power_queries": (["workspace_id", "model_id", "table_id", "partition_name"], ["query_id"]),
    "meta_access_errors": (["workspace_id", "item_id", "operation"], ["error_id"]),
}
TIMES = ["extracted_at", "valid_from", "valid_to"]


def digests(df: DataFrame, key: list[str], ignore: list[str] = ()) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row's columns beside its key; null and "" differ."""
    rest = sorted(c for c in df.columns if c not in {*key, *ignore, *TIMES})
    parts = [p for c in rest for p in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(0), *parts), F.xxhash64(F.lit(1), *parts)


def snapshot_difference(old: DataFrame, new: DataFrame, key: list[str], ignore: list[str] = ()) -> DataFrame:
    """(key, change, old_rows, new_rows): one row per key; change is added, removed, changed or same."""
    def side(df: DataFrame, which: str) -> DataFrame:
        a, b = digests(df, key, ignore)
        return df.select(*key, F.lit(which).alias("_side"), a.alias("_a"), b.alias("_b"))

    def of(which: str, value: Column) -> Column:
        return F.when(F.col("_side") == which, value)

    bags = side(old, "old").unionByName(side(new, "new")).groupBy(*key).agg(*[
        agg.alias(f"{name}_{which}") for which in ("old", "new") for name, agg in (
            ("_n", F.count(of(which, F.lit(1)))), ("_sum", F.sum(of(which, F.col("_a").cast("decimal(38,0)")))),
            ("_xor", F.bit_xor(of(which, F.col("_b")))))])
    alike = reduce(lambda a, b: a & b, [F.col(f"{n}_old").eqNullSafe(F.col(f"{n}_new")) for n in ("_n", "_sum", "_xor")])
    change = (F.when(F.col("_n_old") == 0, "added").when(F.col("_n_new") == 0, "removed").when(alike, "same").otherwise("changed"))
    return bags.select(*key, change.alias("change"), F.col("_n_old").alias("old_rows"), F.col("_n_new").alias("new_rows"))


def _matching(rows: DataFrame, keys: DataFrame, key: list[str], how: str) -> DataFrame:
    on = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}")) for k in key])
    return rows.alias("r").join(keys.select(*key).alias("k"), on, how)


def changed_rows(old: DataFrame, new: DataFrame, key: list[str], ignore: list[str] = ()) -> DataFrame:
    """The rows behind the difference: those of ``new`` for added and changed keys, those of ``old``
    for removed ones, with ``change`` first."""
    found = snapshot_difference(old, new, key, ignore)
    parts = [_matching(rows, found.where(F.col("change") == change), key, "left_semi").select(F.lit(change).alias("change"), "*")
             for change, rows in (("added", new), ("changed", new), ("removed", old.select(*new.columns)))]
    return reduce(DataFrame.unionByName, parts)


def difference_counts(pairs: dict[str, tuple[DataFrame, DataFrame]], keys: dict = KEYS) -> DataFrame:
    """One row per table: keys added, removed, changed and the same."""
    parts = []
    for table, (old, new) in pairs.items():
        key, ignore = keys[table]
        change = F.col("change")
        parts.append(snapshot_difference(old, new, key, ignore).agg(
            *[F.count_if(change == c).alias(c) for c in ("added", "removed", "changed", "same")]).select(F.lit(table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def close_intervals(history: DataFrame | None, snapshot: DataFrame, at: Column, key: list[str], ignore: list[str] = ()) -> DataFrame:
    """A table's history with the rows of one more run: every row has ``valid_from`` and ``valid_to``
    (null: still valid). Rows of keys that stayed the same keep their interval; those of changed and
    removed keys are closed at ``at``, those of changed and added keys begin there."""
    now = at.cast("timestamp")
    fresh = snapshot.withColumns({"valid_from": now, "valid_to": F.lit(None).cast("timestamp")})
    if history is None:
        return fresh
    past, valid = history.where(F.col("valid_to").isNotNull()), history.where(F.col("valid_to").isNull())
    found = snapshot_difference(valid, snapshot, key, ignore)
    moved = found.where(F.col("change") != "same")
    closed = _matching(valid, moved, key, "left_semi").withColumn("valid_to", now)
    return reduce(DataFrame.unionByName, [
        past, _matching(valid, moved, key, "left_anti").select(*history.columns), closed.select(*history.columns),
        _matching(fresh, moved, key, "left_semi").select(*history.columns)])
