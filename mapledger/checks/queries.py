"""One query for each operator, over whole tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapledger.checks.standins import Inputs
from mapledger.functions import text
from mapledger.operators import history, reconcile, status, tablediff, tablepairs, xmlmeta
from mapledger.plans import acceptance
from mapledger.plans.audit_run import Outputs, run_audit
from mapledger.schemas import EVENT_WIDTHS, MAP_SUFFIX
from mapledger.session import shared_folder
from mapledger.sinks import tables as sinks
from mapledger.sources import documents, registry
from mapledger.sources.tables import scan_load_log

Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: fn(Inputs(spark, folder))

    return {name: bind(fn) for name, fn in QUERIES.items()}


# --- sources --------------------------------------------------------------


@query
def registry_active(i: Inputs) -> DataFrame:
    return registry.scan_registry(i.registry())


@query
def audits_excluding(i: Inputs) -> DataFrame:
    return registry.scan_audits(i.audits(), "BUILDING")


@query
def registry_union(i: Inputs) -> DataFrame:
    columns = ["map_id", "map_folder", "map_name", "active_bit"]
    sources = {"orders": i.registry(), "lines": i.repeated_registry(), "texts": i.text_registry()}
    return registry.registry_all_audits({audit: df.select(*columns) for audit, df in sources.items()})


@query
def missing_files(i: Inputs) -> DataFrame:
    maps = registry.scan_registry(i.maps())
    return documents.missing_files(maps, i.listing()).select("audit_name", "map_id", "tf_path")


@query
def available_maps(i: Inputs) -> DataFrame:
    maps = registry.scan_registry(i.maps())
    return documents.available_maps(maps, i.listing()).select("audit_name", "map_id", "tf_path")


@query
def scan_log(i: Inputs) -> DataFrame:
    return scan_load_log(i.load_log(), "new")


@query
def snapshot_documents(i: Inputs) -> DataFrame:
    out = _fresh_folder(i, "snapshot")
    maps = registry.scan_registry(i.maps())
    documents.snapshot_documents(maps, i.tf_docs(), i.map_docs(), out, run_id=1)
    kept = documents.read_snapshot(i.spark, out, "tf", 1)
    # the copies are as good as the originals
    return xmlmeta.map_headers(maps, kept, run_id=1)


# --- documents ------------------------------------------------------------


@query
def derive_paths(i: Inputs) -> DataFrame:
    return i.maps().select("map_id", "tf_path", "map_path")


@query
def source_connector(i: Inputs) -> DataFrame:
    return xmlmeta.parse_tf(i.tf_docs()).select("path", xmlmeta.source_connector().alias("connector_type"))


@query
def source_options(i: Inputs) -> DataFrame:
    return xmlmeta.parse_tf(i.tf_docs()).select(
        "path", F.explode(xmlmeta.source_options()).alias("option_name", "option_value")
    )


@query
def transformation_options(i: Inputs) -> DataFrame:
    return xmlmeta.parse_tf(i.tf_docs()).select(
        "path", F.explode(xmlmeta.transformation_options()).alias("option_name", "option_value")
    )


@query
def target_output_mode(i: Inputs) -> DataFrame:
    return xmlmeta.parse_tf(i.tf_docs()).select("path", xmlmeta.target_output_mode().alias("output_mode"))


@query
def pivot_options(i: Inputs) -> DataFrame:
    return xmlmeta.pivot_options(xmlmeta.parse_tf(i.tf_docs())).drop("content", "tf")


@query
def map_headers(i: Inputs) -> DataFrame:
    return xmlmeta.map_headers(i.maps(), i.tf_docs(), run_id=1)


@query
def filter_events(i: Inputs) -> DataFrame:
    return xmlmeta.filter_events(i.maps(), i.tf_docs(), run_id=1)


@query
def source_events(i: Inputs) -> DataFrame:
    return xmlmeta.source_events(i.maps(), i.map_docs(), run_id=1)


@query
def target_events(i: Inputs) -> DataFrame:
    return xmlmeta.target_events(i.maps(), i.map_docs(), run_id=1)


@query
def map_level_events(i: Inputs) -> DataFrame:
    return xmlmeta.map_level_events(i.maps(), i.map_docs(), run_id=1)


@query
def map_events_union(i: Inputs) -> DataFrame:
    return xmlmeta.map_events(i.maps(), i.tf_docs(), i.map_docs(), run_id=1)


@query
def event_text_lines(i: Inputs) -> DataFrame:
    return xmlmeta.map_level_events(i.text_registry(), i.text_docs(), run_id=1)


@query
def source_fields(i: Inputs) -> DataFrame:
    return xmlmeta.source_fields(i.map_docs())


@query
def target_fields(i: Inputs) -> DataFrame:
    return xmlmeta.target_fields(i.map_docs())


@query
def document_errors(i: Inputs) -> DataFrame:
    few_siblings = i.map_docs().join(
        documents.available_maps(i.maps(), i.listing()).select(F.col("map_path").alias("path")), "path", "left_semi"
    )
    return xmlmeta.document_errors(i.maps(), i.broken_tf_docs(), few_siblings)


@query
def unread_elements(i: Inputs) -> DataFrame:
    return xmlmeta.unread_elements(i.layout_tf_docs(), i.layout_map_docs())


@query
def document_layouts(i: Inputs) -> DataFrame:
    return xmlmeta.document_errors(i.maps(), i.layout_tf_docs(), i.layout_map_docs())


@query
def nested_events(i: Inputs) -> DataFrame:
    found = xmlmeta.event_parameters(xmlmeta.parse_map(i.layout_map_docs()), ("Map",))
    return found.select("path", F.posexplode("Map")).select("path", F.col("pos").alias("place"), "col.*")


@query
def overlong_values(i: Inputs) -> DataFrame:
    narrow = {**EVENT_WIDTHS, "event_name": 6, "map_folder": 5}
    found = text.overlong_values(i.event_history(), narrow)
    return found.select("map_folder", "event_name", F.array_join("overlong_columns", ",").alias("overlong"))


# --- status ---------------------------------------------------------------


@query
def status_upsert(i: Inputs) -> DataFrame:
    return status.upsert_status(i.known_status(), i.repeated_registry())


@query
def status_unavailable(i: Inputs) -> DataFrame:
    return status.mark_unavailable(i.status(), documents.missing_files(i.maps(), i.listing()))


@query
def flag_not_loaded(i: Inputs) -> DataFrame:
    return status.flag_not_loaded(i.status(), i.summary())


@query
def flag_not_loaded_with_null(i: Inputs) -> DataFrame:
    return status.flag_not_loaded(i.status(), i.summary(with_null=True))


@query
def flag_not_loaded_one_audit(i: Inputs) -> DataFrame:
    return status.flag_not_loaded(i.status(), i.summary(), audit="Audit 2-HIGH")


@query
def flag_not_loaded_in_order(i: Inputs) -> DataFrame:
    names = i.table("orders").select("o_orderpriority").distinct()
    order = names.select(
        F.concat(F.lit("Audit "), "o_orderpriority").alias("audit_name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("ord"),
    )
    return status.flag_not_loaded(i.status(), i.swapped_summary(), audit_order=order)


@query
def normalize_path(i: Inputs) -> DataFrame:
    path = text.as_tf_path(text.normalize_path("map_name"))
    return i.engine_log("legacy").select("file_name", "map_name", path.alias("normal_path"))


# --- history --------------------------------------------------------------


@query
def load_summary(i: Inputs) -> DataFrame:
    return history.load_summary(i.audit_log(), after_year=1998, run_id=1)


@query
def load_summary_recent(i: Inputs) -> DataFrame:
    return history.load_summary(i.event_log(), audit="Audit events")


@query
def dedupe_events(i: Inputs) -> DataFrame:
    return history.dedupe_events(i.event_history())


@query
def dedupe_events_one_audit(i: Inputs) -> DataFrame:
    return history.dedupe_events(i.event_history(), audit="Audit R")


@query
def dedupe_events_collated(i: Inputs) -> DataFrame:
    mixed = F.when(F.col("event_ord") > 3, F.upper("event_name")).otherwise(F.concat("event_name", F.lit(" ")))
    rows = i.event_history().withColumn("event_name", mixed).drop("map_folder")
    return history.dedupe_events(rows, collation="UTF8_LCASE_RTRIM").groupBy(
        "audit_name", "map_id", "event_source", "action_name", "parameter_name", "parameter_value"
    ).agg(F.count(F.lit(1)).alias("kept"), F.max("run_id").alias("newest_run"))


@query
def dedupe_load_summary(i: Inputs) -> DataFrame:
    return history.dedupe_load_summary(i.summary_history())


@query
def dedupe_headers(i: Inputs) -> DataFrame:
    return history.dedupe_headers(i.header_history())


@query
def latest_headers(i: Inputs) -> DataFrame:
    return history.dedupe_headers(xmlmeta.map_headers(i.maps(), i.tf_docs(), run_id=1))


# --- reconciliation -------------------------------------------------------


@query
def base_name(i: Inputs) -> DataFrame:
    return i.engine_log("legacy").select("file_name", "map_name", text.base_name("map_name").alias("base_name"))


@query
def map_stem(i: Inputs) -> DataFrame:
    return i.engine_log("legacy").select("file_name", text.map_stem("map_name", MAP_SUFFIX).alias("stem"))


@query
def pair_loads(i: Inputs) -> DataFrame:
    return reconcile.pair_loads(i.engine_log("legacy"), i.engine_log("new"))


@query
def count_diffs(i: Inputs) -> DataFrame:
    return reconcile.count_diffs(_pairs(i)).select("file_name", "legacy_map", "read_diff", "write_diff")


@query
def diff_flag(i: Inputs) -> DataFrame:
    return reconcile.count_diffs(_pairs(i)).select(
        "file_name",
        "legacy_map",
        text.diff_flag("read_diff").alias("read_flag"),
        text.diff_flag("write_diff").alias("write_flag"),
    )


@query
def attach_packages(i: Inputs) -> DataFrame:
    pairs = _pairs(i).select("file_name", "legacy_table", "new_table")
    return reconcile.attach_packages(pairs, i.packages(), audit="EUROPE")


@query
def reconcile_details(i: Inputs) -> DataFrame:
    return reconcile.reconcile(i.engine_log("legacy"), i.engine_log("new"), i.packages())


@query
def update_flags(i: Inputs) -> DataFrame:
    return reconcile.update_flags(i.supplier_flags(), reconcile_details(i))


@query
def reconcile_flags(i: Inputs) -> DataFrame:
    return reconcile.reconcile_flags(
        i.supplier_flags(), i.engine_log("legacy"), i.engine_log("new"), i.packages()
    )


@query
def reconcile_flags_one_audit(i: Inputs) -> DataFrame:
    return reconcile.reconcile_flags(
        i.supplier_flags(), i.engine_log("legacy"), i.engine_log("new"), i.packages(), audit="ASIA"
    )


def _pairs(i: Inputs) -> DataFrame:
    return reconcile.pair_loads(i.engine_log("legacy"), i.engine_log("new"))


# --- acceptance report ----------------------------------------------------


@query
def strip_schema(i: Inputs) -> DataFrame:
    return i.engine_log("new").select("file_name", text.strip_schema("table_name").alias("table_name"))


@query
def find_client(i: Inputs) -> DataFrame:
    return acceptance.find_client(i.clients(), "_1", "7")


@query
def find_package(i: Inputs) -> DataFrame:
    return acceptance.find_package(i.order_packages(), "Audit 2", "O", "shared_1_.tf.xml")


@query
def find_package_none(i: Inputs) -> DataFrame:
    return acceptance.find_package(i.order_packages(), "Audit", "O", "no such map")


@query
def package_overview(i: Inputs) -> DataFrame:
    return acceptance.package_overview(i.order_packages(), "-", "F", "shared_1__.tf.xml")


@query
def map_variables(i: Inputs) -> DataFrame:
    return acceptance.map_variables(i.variables(), "user_8.tf.xml")


@query
def comparison_flags(i: Inputs) -> DataFrame:
    return acceptance.comparison_flags(i.order_flags(), "7")


@query
def structure_diffs_if_flagged(i: Inputs) -> DataFrame:
    return acceptance.structure_diffs_if_flagged(i.order_flags(), i.line_diffs())


@query
def data_diffs_if_flagged(i: Inputs) -> DataFrame:
    return acceptance.data_diffs_if_flagged(i.order_flags(), i.line_diffs())


@query
def load_lines_legacy(i: Inputs) -> DataFrame:
    return acceptance.load_lines(i.load_log(), "legacy", "part_1_.tf.xml")


@query
def load_lines_new(i: Inputs) -> DataFrame:
    return acceptance.load_lines(i.load_log(), "new", "part_1_.tf.xml")


@query
def load_lines_literal(i: Inputs) -> DataFrame:
    return acceptance.load_lines(i.load_log(), "new", "part_1.tf.xml", match="literal")


@query
def special_events(i: Inputs) -> DataFrame:
    return acceptance.special_events(i.special_events(), "Audit error", "user_8.tf.xml")


@query
def clients_for_requests(i: Inputs) -> DataFrame:
    return acceptance.clients_for(i.client_requests(), i.clients())


@query
def package_overview_for_requests(i: Inputs) -> DataFrame:
    return acceptance.package_overview_for(i.requests(), i.order_packages())


@query
def find_package_for_requests(i: Inputs) -> DataFrame:
    return acceptance.find_package_for(i.requests(), i.order_packages())


@query
def load_lines_for_requests(i: Inputs) -> DataFrame:
    return acceptance.load_lines_for(i.load_requests(), i.load_log(), "legacy")


@query
def acceptance_report_all(i: Inputs) -> DataFrame:
    tables = {
        "clients": i.clients(),
        "packages": i.order_packages(),
        "map_variables": i.order_variables(),
        "comparison_flags": i.order_flags(),
        "structure_diffs": i.line_diffs(),
        "data_diffs": i.line_diffs(),
        "load_log": i.shared_log(),
        "special_events": i.order_events(),
    }
    report = acceptance.acceptance_report_all(tables, i.requests())
    counts = [
        df.groupBy("request_id").agg(F.count(F.lit(1)).alias("line_count")).withColumn("section", F.lit(section))
        for section, df in report.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- table comparison -----------------------------------------------------


@query
def compare_structure(i: Inputs) -> DataFrame:
    fields = xmlmeta.both_fields(i.map_docs()).selectExpr(
        "path AS table_name", "field_name AS column_name", "data_type", "ordinal", "if(side = 'source', 'a', 'b') AS mark"
    )
    return tablediff.compare_sides(fields)


@query
def compare_rows(i: Inputs) -> DataFrame:
    return tablediff.compare_rows(i.table("orders"), i.changed_orders())


@query
def compare_rows_lineitem(i: Inputs) -> DataFrame:
    lines = i.table("lineitem")
    return tablediff.compare_rows(lines, lines.where("l_quantity < 45").unionByName(lines.where("l_tax = 0")))


@query
def comparison_summary(i: Inputs) -> DataFrame:
    return tablediff.comparison_summary(compare_structure(i), compare_rows(i))


@query
def compare_rows_by_bucket(i: Inputs) -> DataFrame:
    return tablepairs.compare_rows_by_bucket(i.table("lineitem"), i.changed_lines())


@query
def compare_pairs_rows(i: Inputs) -> DataFrame:
    found = tablepairs.compare_pairs_rows(i.spark, i.table_pairs())
    names, cells = F.array_join("columns", "|"), F.array_join("cells", "|", "NULL")
    return found.select("pair_id", names.alias("names"), cells.alias("cells"), "count_a", "count_b")


@query
def compare_pairs_summary(i: Inputs) -> DataFrame:
    return tablepairs.compare_pairs(i.spark, i.table_pairs())["comparison_summary"]


# --- whole run ------------------------------------------------------------


def _fresh_folder(i: Inputs, name: str) -> str:
    return os.path.join(shared_folder(i.spark), f"mapledger-{uuid.uuid4().hex}", name)


_runs: dict[tuple[str, str], Outputs] = {}


def _two_runs(i: Inputs) -> Outputs:
    """The same audit run twice: the second one finds everything known.

    The four queries below look at the four tables of one such pair of runs.
    """
    session = (i.spark.sparkContext.applicationId, i.folder)
    if session not in _runs:
        _runs[session] = _run_twice(i, Outputs(_fresh_folder(i, "run")))
    return _runs[session]


def _run_twice(i: Inputs, outputs: Outputs) -> Outputs:
    tf_docs = i.tf_docs(i.listing())
    for run_id in (1, 2):
        run_audit(i.spark, i.maps(), tf_docs, i.map_docs(), i.order_log(), outputs, run_id, after_year=1996)
    return outputs


@query
def audit_run_status(i: Inputs) -> DataFrame:
    return sinks.read_status(i.spark, _two_runs(i).map_status)


@query
def audit_run_headers(i: Inputs) -> DataFrame:
    return sinks.latest_headers(i.spark, _two_runs(i).map_header)


@query
def audit_run_events(i: Inputs) -> DataFrame:
    return sinks.latest_events(i.spark, _two_runs(i).map_events)


@query
def audit_run_load_summary(i: Inputs) -> DataFrame:
    return sinks.latest_load_summary(i.spark, _two_runs(i).load_summary)
