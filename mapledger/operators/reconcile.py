"""Reconciliation of the load logs of the legacy and the new engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.functions.text import base_name, diff_flag, key, map_stem
from mapledger.schemas import MAP_SUFFIX, PACKAGE_SUFFIX, TABLE_PREFIX

_FLAG_KEY = ["audit_id", "pack_id"]
_TABLES = ["legacy_table", "new_table"]


def _database(*tables: DataFrame) -> list[str]:
    """The tracker database as a further key, where all tables name it."""
    return ["tracker_db"] if all("tracker_db" in table.columns for table in tables) else []


def _load_keys(legacy: DataFrame, new: DataFrame) -> list[str]:
    return [*_database(legacy, new), "_file", "_stem"]


def with_tracker_db(packages: DataFrame, clients: DataFrame) -> DataFrame:
    """Packages with the tracker database of their audit and phase, as the client table has it."""
    of_phase = clients.select("audit_name", F.rtrim("phase").alias("_phase"), "tracker_db").distinct()
    return packages.withColumn("_phase", F.rtrim("phase")).join(of_phase, ["audit_name", "_phase"]).drop("_phase")


def _legacy_side(log: DataFrame, collation: str | None) -> DataFrame:
    return log.select(
        *_database(log),
        key("file_name", collation).alias("_file"),
        key(map_stem("map_name", MAP_SUFFIX), collation).alias("_stem"),
        "map_name",
        base_name("map_name").alias("legacy_map"),
        F.col("file_name").alias("_legacy_file"),
        F.concat(F.lit(TABLE_PREFIX), "table_name").alias("legacy_table"),
        F.col("records_read").cast("bigint").alias("legacy_read"),
        F.col("records_written").cast("bigint").alias("legacy_written"),
    )


def _new_side(log: DataFrame, collation: str | None) -> DataFrame:
    return log.select(
        *_database(log),
        key("file_name", collation).alias("_file"),
        key(map_stem("map_name", PACKAGE_SUFFIX), collation).alias("_stem"),
        base_name("map_name").alias("new_package"),
        F.col("file_name").alias("_new_file"),
        F.col("table_name").alias("new_table"),
        F.col("records_read").cast("bigint").alias("new_read"),
        F.col("records_written").cast("bigint").alias("new_written"),
    )


def pair_loads(legacy: DataFrame, new: DataFrame, collation: str | None = None) -> DataFrame:
    """Loads of the same file by the same map in both logs; repeated loads multiply.

    Logs of several clients name their tracker database in `tracker_db`;
    loads then pair within one client only.
    """
    pairs = _legacy_side(legacy, collation).join(_new_side(new, collation).hint("merge"), _load_keys(legacy, new))
    return pairs.select(
        *_database(legacy, new),
        "map_name",
        "legacy_map",
        "new_package",
        F.coalesce("_legacy_file", "_new_file").alias("file_name"),
        *_TABLES,
        "legacy_read",
        "new_read",
        "legacy_written",
        "new_written",
    )


def count_diffs(pairs: DataFrame) -> DataFrame:
    """T5: legacy minus new; unknown if either count is unknown."""
    return pairs.withColumns(
        {
            "read_diff": F.col("legacy_read") - F.col("new_read"),
            "write_diff": F.col("legacy_written") - F.col("new_written"),
        }
    )


def attach_packages(pairs: DataFrame, packages: DataFrame, audit: str | None = None) -> DataFrame:
    """Add the package that loads both tables, of one audit or of all."""
    keys = [*_database(pairs, packages), *_TABLES]
    scoped = _scoped(packages, audit).select(*_FLAG_KEY, "audit_name", *keys)
    return pairs.join(scoped, keys).select(*_FLAG_KEY, "audit_name", *pairs.columns)


def _scoped(packages: DataFrame, audit: str | None) -> DataFrame:
    return packages if audit is None else packages.where(F.col("audit_name") == audit)


def reconcile(
    legacy: DataFrame, new: DataFrame, packages: DataFrame, audit: str | None = None, collation: str | None = None
) -> DataFrame:
    """Each pair of loads with its package and count differences."""
    return attach_packages(count_diffs(pair_loads(legacy, new, collation)), packages, audit)


def detail_flags(details: DataFrame) -> DataFrame:
    """T7 per package: 1 if any of its pairs differs."""
    return details.groupBy(*_FLAG_KEY).agg(
        F.max(diff_flag("read_diff")).alias("_read"), F.max(diff_flag("write_diff")).alias("_write")
    )


def update_flags(flags: DataFrame, details: DataFrame) -> DataFrame:
    """Set the count flags of the packages that have pairs; the others keep theirs."""
    return _apply(flags, detail_flags(details))


def _apply(flags: DataFrame, found: DataFrame) -> DataFrame:
    return flags.join(found, _FLAG_KEY, "left").select(
        *_FLAG_KEY,
        "has_data_difference",
        "has_template_difference",
        F.coalesce("_read", "has_read_difference").alias("has_read_difference"),
        F.coalesce("_write", "has_write_difference").alias("has_write_difference"),
    )


def reconcile_flags(
    flags: DataFrame,
    legacy: DataFrame,
    new: DataFrame,
    packages: DataFrame,
    audit: str | None = None,
    collation: str | None = None,
) -> DataFrame:
    """T9 and T8 in one, without forming the pairs.

    All pairs of a file, map and two tables agree if and only if each side
    holds one and the same known count. So each log is first reduced to its
    smallest and largest counts, and a file loaded a million times by both
    engines joins one row to one row.
    """
    database = _database(legacy, new, packages)
    if not database:
        legacy, new = legacy.drop("tracker_db"), new.drop("tracker_db")
    tables = [*database, *_TABLES]
    wanted = _scoped(packages, audit).select(*_FLAG_KEY, *tables)
    old_side, new_side = _ranges(_legacy_side(legacy, collation), "legacy"), _ranges(_new_side(new, collation), "new")
    by_table = (
        old_side.join(new_side.hint("merge"), _load_keys(legacy, new))
        .groupBy(*tables)
        .agg(F.max(_differs("read")).alias("_read"), F.max(_differs("written")).alias("_write"))
    )
    by_package = by_table.join(wanted, tables).groupBy(*_FLAG_KEY).agg(
        F.max("_read").alias("_read"), F.max("_write").alias("_write")
    )
    return _apply(flags, by_package)


def _ranges(side: DataFrame, engine: str) -> DataFrame:
    table = f"{engine}_table"
    aggregates = [F.count(F.lit(1)).alias(f"{engine}_n")]
    for count in ("read", "written"):
        column = f"{engine}_{count}"
        aggregates += [
            F.min(column).alias(f"{column}_min"),
            F.max(column).alias(f"{column}_max"),
            F.count(column).alias(f"{column}_n"),
        ]
    known = side.where(F.col("_file").isNotNull() & F.col("_stem").isNotNull())
    return known.groupBy(*_database(side), "_file", "_stem", table).agg(*aggregates)


def _differs(count: str) -> Column:
    legacy, new = f"legacy_{count}", f"new_{count}"
    all_known = (F.col(f"{legacy}_n") == F.col("legacy_n")) & (F.col(f"{new}_n") == F.col("new_n"))
    one_value = (
        (F.col(f"{legacy}_min") == F.col(f"{legacy}_max"))
        & (F.col(f"{new}_min") == F.col(f"{new}_max"))
        & (F.col(f"{legacy}_min") == F.col(f"{new}_min"))
    )
    return F.when(all_known & one_value, 0).otherwise(1)
