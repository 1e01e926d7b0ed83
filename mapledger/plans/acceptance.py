"""Acceptance drill-down: the report for one map, and for many maps at once."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.functions.text import like_contains, same_text, strip_schema
from mapledger.operators.matching import contains_pairs
from mapledger.operators.tablediff import compare_rows, compare_structure, comparison_summary, describe_columns
from mapledger.operators.tablepairs import compare_pairs
from mapledger.schemas import LOAD_LINE_COLUMNS, PACKAGE_OVERVIEW_COLUMNS, TF_SUFFIX
from mapledger.session import stage
from mapledger.sources.tables import scan_load_log

_CLIENT_COLUMNS = ["tracker_db", "legacy_db", "new_db"]


# --- one map --------------------------------------------------------------


def find_client(clients: DataFrame, audit: str, phase: str, match: str = "like") -> DataFrame:
    """Client rows of an audit and phase."""
    found = clients.where(same_text("phase", phase) & like_contains("audit_name", audit, match))
    return found.select("audit_name", "phase", *_CLIENT_COLUMNS)


def _matching_packages(packages: DataFrame, audit: str, phase: str, map_name: str, match: str) -> DataFrame:
    return packages.where(
        same_text("phase", phase)
        & like_contains("audit_name", audit, match)
        & like_contains("legacy_maps", map_name, match)
    )


def find_package(packages: DataFrame, audit: str, phase: str, map_name: str, match: str = "like") -> DataFrame:
    """Load parameters of the map's package: of the last one, and how many there are."""
    return _pick_package(_matching_packages(packages, audit, phase, map_name, match), [])


def _pick_package(found: DataFrame, keys: list[str]) -> DataFrame:
    chosen = found.groupBy(*keys).agg(
        F.max(F.struct("pack_id", "audit_id", "legacy_table", "new_table", "data_file")).alias("p"),
        F.count(F.lit(1)).alias("match_count"),
    )
    return chosen.select(
        *keys,
        F.coalesce("p.pack_id", F.lit("")).alias("pack_id"),
        F.coalesce(strip_schema("p.legacy_table"), F.lit("")).alias("legacy_table"),
        F.coalesce(strip_schema("p.new_table"), F.lit("")).alias("new_table"),
        F.coalesce("p.data_file", F.lit("")).alias("data_file"),
        "match_count",
    )


def package_overview(packages: DataFrame, audit: str, phase: str, map_name: str, match: str = "like") -> DataFrame:
    """U4: every package of the map, eleven columns."""
    return _matching_packages(packages, audit, phase, map_name, match).select(*PACKAGE_OVERVIEW_COLUMNS)


def map_variables(variables: DataFrame, map_name: str, tracker_db: str | None = None) -> DataFrame:
    """Variables of the map, by its exact name, of one tracker database or of all."""
    return _of_database(variables, tracker_db).where(same_text("map_name", map_name))


def _of_database(table: DataFrame, tracker_db: str | None) -> DataFrame:
    return table if tracker_db is None else table.where(same_text("tracker_db", tracker_db))


def _of_client(table: DataFrame, databases: DataFrame, *keys: str) -> DataFrame:
    """Rows of the tracker databases found for a request, where the table says whose they are."""
    if "tracker_db" not in table.columns:
        return table
    bare = databases.select(*keys, _bare("tracker_db")).distinct()
    return table.withColumn("_tracker_db", F.rtrim("tracker_db")).join(bare, [*keys, "_tracker_db"], "left_semi").drop("_tracker_db")


def comparison_flags(flags: DataFrame, pack_id: str) -> DataFrame:
    """Comparison flags of the package."""
    return flags.where(same_text("pack_id", pack_id))


def structure_diffs_if_flagged(flags: DataFrame, diffs: DataFrame, pack_id: str | None = None) -> DataFrame:
    """Structure differences of a package, or of each one, if flagged."""
    return _if_flagged(flags, diffs, "has_template_difference", pack_id)


def data_diffs_if_flagged(flags: DataFrame, diffs: DataFrame, pack_id: str | None = None) -> DataFrame:
    """U8: data differences of a package, or of each one, if flagged."""
    return _if_flagged(flags, diffs, "has_data_difference", pack_id)


def _if_flagged(flags: DataFrame, diffs: DataFrame, flag: str, pack_id: str | None) -> DataFrame:
    if pack_id is not None:
        flags, diffs = comparison_flags(flags, pack_id), comparison_flags(diffs, pack_id)
    return diffs.join(flags.where(F.col(flag) == 1).select("pack_id"), "pack_id", "left_semi")


def load_lines(
    log: DataFrame, engine: str, map_name: str, match: str = "like", tracker_db: str | None = None
) -> DataFrame:
    """Load-log lines whose map name holds the name without its suffix, of one tracker database or of all."""
    lines = _of_database(scan_load_log(log, engine), tracker_db)
    return lines.where(like_contains("map_name", map_name.replace(TF_SUFFIX, ""), match)).select(*LOAD_LINE_COLUMNS)


def special_events(events: DataFrame, audit: str, map_name: str) -> DataFrame:
    """Special events of audit and map, both by their exact name."""
    return events.where(same_text("audit_name", audit) & same_text("map_name", map_name))


def acceptance_report(
    tables: Mapping[str, DataFrame],
    audit: str,
    map_name: str,
    phase: str,
    compare: bool = False,
    match: str = "like",
) -> dict[str, DataFrame]:
    """All sections for one map, as frames that run when they are shown.

    `tables` holds clients, packages, map_variables, comparison_flags,
    structure_diffs, data_diffs, load_log and special_events; with `compare`
    also legacy_data and new_data, the two loaded tables. Where load_log and
    map_variables name their `tracker_db`, only rows of the client's count.
    """
    client = find_client(tables["clients"], audit, phase, match)
    log, variables = (_of_client(tables[name], client) for name in ("load_log", "map_variables"))
    package = find_package(tables["packages"], audit, phase, map_name, match)
    flags = tables["comparison_flags"].join(package.select("pack_id"), "pack_id", "left_semi")
    report = {
        "client": client,
        "package": package,
        "package_overview": package_overview(tables["packages"], audit, phase, map_name, match),
        "map_variables": map_variables(variables, map_name),
        "comparison_flags": flags,
        "structure_diffs": structure_diffs_if_flagged(flags, tables["structure_diffs"]),
        "data_diffs": data_diffs_if_flagged(flags, tables["data_diffs"]),
        "load_lines_legacy": load_lines(log, "legacy", map_name, match),
        "load_lines_new": load_lines(log, "new", map_name, match),
        "special_events": special_events(tables["special_events"], audit, map_name),
    }
    if compare:
        report |= compare_tables(tables["legacy_data"], tables["new_data"])
    return report


def compare_tables(legacy: DataFrame, new: DataFrame) -> dict[str, DataFrame]:
    """D1 to D3 of two tables."""
    spark = legacy.sparkSession
    structure = compare_structure(describe_columns(spark, {"t": legacy}), describe_columns(spark, {"t": new}))
    rows = compare_rows(legacy, new)
    return {
        "compare_structure": structure,
        "compare_rows": rows,
        "comparison_summary": comparison_summary(structure, rows),
    }


# --- many maps ------------------------------------------------------------


def clients_for(requests: DataFrame, clients: DataFrame, match: str = "like") -> DataFrame:
    """U1 for a table of requests (request_id, audit_name, phase, map_name)."""
    asked = requests.select("request_id", _bare("phase"), F.col("audit_name").alias("pattern"))
    pairs = contains_pairs(clients, "audit_name", asked, "pattern", match)
    found = clients.select("*", _bare("phase")).join(pairs.withColumnRenamed("value", "audit_name").hint("merge"), "audit_name")
    return found.join(asked.hint("merge"), ["pattern", "_phase"]).select("request_id", "audit_name", "phase", *_CLIENT_COLUMNS)


def packages_for(requests: DataFrame, packages: DataFrame, match: str = "like") -> DataFrame:
    """All columns of the packages of each request, the basis of U2, U4 and U6 to U8."""
    asked = requests.select(
        "request_id", _bare("phase"), F.col("audit_name").alias("_audit"), F.col("map_name").alias("pattern")
    )
    pairs = contains_pairs(packages, "legacy_maps", asked, "pattern", match)
    found = packages.select("*", _bare("phase")).join(pairs.withColumnRenamed("value", "legacy_maps").hint("merge"), "legacy_maps")
    both = found.join(asked.hint("merge"), ["pattern", "_phase"])
    return both.where(like_contains("audit_name", F.col("_audit"), match)).drop("pattern", "_audit", "_phase")


def _bare(name: str) -> Column:
    """Key of an equality that ignores trailing spaces."""
    return F.rtrim(name).alias(f"_{name}")


def package_overview_for(requests: DataFrame, packages: DataFrame, match: str = "like") -> DataFrame:
    """U4 for a table of requests."""
    return _overview(packages_for(requests, packages, match))


def _overview(found: DataFrame) -> DataFrame:
    return found.select("request_id", *PACKAGE_OVERVIEW_COLUMNS)


def find_package_for(requests: DataFrame, packages: DataFrame, match: str = "like") -> DataFrame:
    """U2 for a table of requests; a request without a package has empty texts and count 0."""
    return _picked(requests, packages_for(requests, packages, match))


def _picked(requests: DataFrame, found: DataFrame) -> DataFrame:
    picked = _pick_package(found, ["request_id"])
    texts = ["pack_id", "legacy_table", "new_table", "data_file"]
    rows = requests.select("request_id").join(picked.hint("merge"), "request_id", "left")
    return rows.na.fill("", texts).na.fill(0, ["match_count"])


def load_lines_for(
    requests: DataFrame, log: DataFrame, engine: str, match: str = "like", databases: DataFrame | None = None
) -> DataFrame:
    """U9 or U10 for a table of requests.

    With `databases` (request_id, tracker_db), the clients found for the
    requests, a log that names its tracker database gives the lines of each
    request's own client only.
    """
    asked = requests.select("request_id", F.replace("map_name", F.lit(TF_SUFFIX), F.lit("")).alias("pattern"))
    named = ["tracker_db"] if databases is not None and "tracker_db" in log.columns else []
    lines = scan_load_log(log, engine).select(*LOAD_LINE_COLUMNS, *named)
    pairs = contains_pairs(lines, "map_name", asked, "pattern", match, ("request_id",))
    matched = pairs.select("request_id", F.col("value").alias("map_name"))
    if named:
        # the client is part of the key, so a text that many clients use does not meet them all
        matched = matched.join(databases.select("request_id", _bare("tracker_db")).distinct(), "request_id")
        lines = lines.withColumn("_tracker_db", F.rtrim("tracker_db"))
        return lines.join(matched, ["map_name", "_tracker_db"]).select("request_id", *LOAD_LINE_COLUMNS)
    return lines.join(matched.hint("merge"), "map_name").select("request_id", *LOAD_LINE_COLUMNS)


def compare_packages(package: DataFrame, open_table: Callable[[str], DataFrame | None]) -> dict[str, DataFrame]:
    """D1 to D3 of the tables of many requests' packages, tagged with `request_id`.

    `package` is the result of U2 for the requests. Each different pair of
    tables is opened and compared once, however many requests share it; only
    the distinct table names come to the driver, which has to open the tables
    anyhow. `open_table` returns None for a table that isn't there: the rows of
    the other one are all differences. A request with neither has no rows.
    """
    spark = package.sparkSession
    name = F.concat_ws(" = ", "legacy_table", "new_table")
    wanted = package.where((F.col("legacy_table") != "") | (F.col("new_table") != ""))
    pairs = {}
    for row in wanted.select(name.alias("pair_id"), "legacy_table", "new_table").distinct().collect():
        sides = tuple(open_table(table) if table else None for table in (row.legacy_table, row.new_table))
        if any(side is not None for side in sides):
            pairs[row.pair_id] = sides
    asked = wanted.select("request_id", name.alias("pair_id"))
    return {section: asked.join(df, "pair_id").drop("pair_id") for section, df in compare_pairs(spark, pairs).items()}


def acceptance_report_all(
    tables: Mapping[str, DataFrame],
    requests: DataFrame,
    match: str = "like",
    open_table: Callable[[str], DataFrame | None] | None = None,
) -> dict[str, DataFrame]:
    """The sections of U12 for a table of requests, tagged with `request_id`.

    The packages of the requests, which five sections read, are written to
    the shared folder once. With `open_table` the tables of the packages are
    compared as well, as U12 does with `compare`; without it nothing returns
    to the driver in between.
    """
    found = stage(packages_for(requests, tables["packages"], match), "packages")
    package = _picked(requests, found)
    client = stage(clients_for(requests, tables["clients"], match), "clients")
    # a request without a package has none to look up
    picked = package.where(F.col("pack_id") != "").select("request_id", _bare("pack_id"))

    def of_package(name: str, wanted: DataFrame) -> DataFrame:
        table = tables[name].withColumn("_pack_id", F.rtrim("pack_id"))
        return wanted.hint("merge").join(table, "_pack_id").select("request_id", *tables[name].columns)

    flags = of_package("comparison_flags", picked)

    def diffs(name: str, flag: str) -> DataFrame:
        return of_package(name, flags.where(F.col(flag) == 1).select("request_id", _bare("pack_id")).distinct())

    def by(name: str, *keys: str) -> DataFrame:
        asked = requests.select("request_id", *map(_bare, keys))
        bare = [f"_{k}" for k in keys]
        found = tables[name].select("*", *map(_bare, keys)).join(asked.hint("merge"), bare).drop(*bare)
        return _of_client(found, client, "request_id")

    return {
        "client": client,
        "package": package,
        "package_overview": _overview(found),
        "map_variables": by("map_variables", "map_name"),
        "comparison_flags": flags,
        "structure_diffs": diffs("structure_diffs", "has_template_difference"),
        "data_diffs": diffs("data_diffs", "has_data_difference"),
        "load_lines_legacy": load_lines_for(requests, tables["load_log"], "legacy", match, client),
        "load_lines_new": load_lines_for(requests, tables["load_log"], "new", match, client),
        "special_events": by("special_events", "audit_name", "map_name"),
    } | (compare_packages(package, open_table) if open_table else {})
