"""Audit registry and map registry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_audits(audits: DataFrame, exclude: str) -> DataFrame:
    """Every audit but one; an audit without a name is dropped too."""
    return audits.where(F.col("audit_name") != exclude)


def scan_registry(registry: DataFrame) -> DataFrame:
    """Active maps; an unknown bit is not active."""
    return registry.where(F.col("active_bit") == 1)


def existing_audits(
    spark: SparkSession, tables: Iterable[tuple[str, str]]
) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """S3: split pairs (audit, registry table) into those whose table is there and the others."""
    present, absent = [], []
    for audit, table in tables:
        (present if spark.catalog.tableExists(table) else absent).append((audit, table))
    return present, absent


def registry_tables(audits: DataFrame, table: str = "map_registry") -> list[tuple[str, str]]:
    """(audit, qualified registry table) for every row of the audit list, in its order.

    An audit with several registries has several rows. The list of audits is
    an index of databases: tens of rows, held by the driver.
    """
    rows = audits.select("audit_name", "registry_db").toLocalIterator()
    return [(row.audit_name, f"{row.registry_db}.{table}") for row in rows]


def registry_all_audits(sources: Mapping[str, DataFrame] | Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """The registries of all audits as one frame, each row tagged with its audit."""
    pairs = sources.items() if isinstance(sources, Mapping) else sources
    return union_all(df.withColumn("audit_name", F.lit(audit)) for audit, df in pairs)


def read_all_audits(spark: SparkSession, audits: DataFrame, exclude: str) -> tuple[DataFrame | None, list[str]]:
    """S1, S3 and S4 in a row: one frame over all registries there are, and the audits of the others.

    A registry that two rows name alike is read once.
    """
    tables = list(dict.fromkeys(registry_tables(scan_audits(audits, exclude))))
    present, absent = existing_audits(spark, tables)
    names = [audit for audit, _ in absent]
    if not present:
        return None, names
    return registry_all_audits([(audit, spark.table(table)) for audit, table in present]), names


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
