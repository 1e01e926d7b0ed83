"""Load summary and latest-row-per-key over accumulated runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mapledger.functions.text import key

# --- fixed values: keys whose newest row is kept --------------------------
EVENT_KEY = ["audit_name", "map_id", "event_source", "event_name", "action_name", "parameter_name", "parameter_value"]
HEADER_KEY = ["audit_name", "map_id", "map_name"]
SUMMARY_KEY = ["audit_name", "map_name"]
# --------------------------------------------------------------------------


def ord_column(df: DataFrame) -> Column:
    """Order of a registry row: its own column, or a value that a rerun repeats."""
    if "doc_ord" in df.columns:
        return F.col("doc_ord").cast("bigint")
    return F.xxhash64("audit_name", "map_id", "map_folder", "map_name")


def first_per_key(df: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """The first row of each key.

    Written as `row_number() = 1`, which Spark also applies before the
    exchange: a hot key sends one row per task, not all of its rows.
    """
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def _newest(df: DataFrame, names: list[str], order: list[str], audit: str | None, collation: str | None) -> DataFrame:
    keys = [key(name, collation) for name in names]
    newest_first = [F.col(name).desc() for name in order]
    if audit is None:
        return first_per_key(df, keys, newest_first)
    # the rows of the other audits stay as they are
    others = df.where(~F.col("audit_name").eqNullSafe(audit))
    return first_per_key(for_audit(df, audit), keys, newest_first).unionByName(others)


def for_audit(df: DataFrame, audit: str) -> DataFrame:
    """The rows of one audit, a partition of the stored tables."""
    return df.where(F.col("audit_name") == audit)


def load_summary(log: DataFrame, audit: str | None = None, after_year: int = 2021, run_id: int = 0) -> DataFrame:
    """Per map name the maximum of each column over loads after a year.

    The maxima are independent of one another. Without `audit` the log names
    its audit itself, and all audits are summarised in one pass.
    """
    # a bare column against a constant reaches the file statistics, year(...) does not
    recent = log.where(F.col("load_start") >= F.make_date(F.lit(after_year + 1), F.lit(1), F.lit(1)))
    keys = [F.col("map_name")] if audit else [F.col("audit_name"), F.col("map_name")]
    maxima = recent.groupBy(*keys).agg(
        F.max("file_name").alias("file_name"),
        F.max("sql_server").alias("sql_server"),
        F.max("sql_database").alias("database_name"),
        F.max("table_name").alias("table_name"),
        F.max("load_start").alias("last_load"),
    )
    tagged = maxima.withColumn("audit_name", F.lit(audit)) if audit else maxima
    return tagged.select(
        "audit_name", "map_name", "file_name", "sql_server", "database_name", "table_name", "last_load",
        F.lit(run_id).cast("bigint").alias("run_id"),
    )


def dedupe_events(events: DataFrame, audit: str | None = None, collation: str | None = None) -> DataFrame:
    """Newest row of each distinct event parameter, its value being part of the key."""
    return _newest(events, EVENT_KEY, ["run_id", "doc_ord", "event_ord"], audit, collation)


def dedupe_load_summary(summary: DataFrame, audit: str | None = None, collation: str | None = None) -> DataFrame:
    """Newest summary row of each map name."""
    return _newest(summary, SUMMARY_KEY, ["run_id"], audit, collation)


def dedupe_headers(headers: DataFrame, audit: str | None = None, collation: str | None = None) -> DataFrame:
    """Newest header row of each map."""
    return _newest(headers, HEADER_KEY, ["run_id", "doc_ord"], audit, collation)
