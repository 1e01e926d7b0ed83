"""Declared schemas: the relational tables and the two XML document layouts."""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values: option names of a transformation document -------------
SOURCE_OPTION_COLUMNS = {
    "code_page": "codepage",
    "record_separator": "recsep",
    "field_separator": "fldsep",
    "field_start_delimiter": "fldsdelim",
    "field_end_delimiter": "fldedelim",
    "header": "header",
    "start_offset": "soffset",
    "layout_mismatch": "layoutmismatch",
}
GLOBAL_OPTION_COLUMNS = {
    "truncation_handling": "truncationhandling",
    "overflow_handling": "overflowhandling",
}
# --- fixed values: names written to the event table ----------------------
FILTER_EVENT = ("SourceFilter", "Filter", "Filter Source")
SOURCE_EVENT, TARGET_EVENT, MAP_EVENT = "Source", "Target", "Map"
# --- fixed values: document and package file name endings ----------------
TF_SUFFIX, MAP_SUFFIX, PACKAGE_SUFFIX = ".tf.xml", ".map.xml", ".dtsx"
TABLE_PREFIX = "dbo."
# -------------------------------------------------------------------------

MAP_IDENTITY = ["audit_name", "map_id", "map_folder", "map_name"]

HEADER_COLUMNS = [
    "connector_type",
    "code_page",
    "record_separator",
    "field_separator",
    "field_start_delimiter",
    "field_end_delimiter",
    "header",
    "start_offset",
    "truncation_handling",
    "overflow_handling",
    "layout_mismatch",
    "output_mode",
]
EVENT_COLUMNS = [
    "event_source",
    "event_name",
    "action_name",
    "parameter_name",
    "parameter_value",
]
LOAD_LINE_COLUMNS = [
    "data_group",
    "file_name",
    "map_name",
    "table_name",
    "s_file_name",
    "records_read",
    "records_written",
    "file_size",
    "sql_database",
]
PACKAGE_OVERVIEW_COLUMNS = [
    "pack_id",
    "audit_name",
    "new_package",
    "phase",
    "connector_type",
    "package_status",
    "legacy_table",
    "new_table",
    "legacy_status",
    "new_status",
    "job_name",
]


def _ddl(strings: list[str], *rest: str) -> str:
    return ", ".join([f"{name} STRING" for name in strings] + list(rest))


TABLES: dict[str, str] = {
    "audits": _ddl(["audit_name", "server", "registry_db", "tracker_db"]),
    "map_registry": _ddl(MAP_IDENTITY, "active_bit INT"),
    "load_log": _ddl(
        ["audit_name", "tracker_db", "engine", "data_group", "file_name", "map_name", "table_name", "s_file_name", "sql_server", "sql_database"],
        "records_read BIGINT",
        "records_written BIGINT",
        "file_size BIGINT",
        "load_start TIMESTAMP_NTZ",
    ),
    "map_status": _ddl(MAP_IDENTITY, "is_available INT", "not_in_load_log INT"),
    "map_header": _ddl(MAP_IDENTITY + HEADER_COLUMNS, "run_id BIGINT", "doc_ord BIGINT"),
    "map_events": _ddl(MAP_IDENTITY + EVENT_COLUMNS, "run_id BIGINT", "doc_ord BIGINT", "event_ord BIGINT"),
    "load_summary": _ddl(
        ["audit_name", "map_name", "file_name", "sql_server", "database_name", "table_name"],
        "last_load TIMESTAMP_NTZ",
        "run_id BIGINT",
    ),
    "map_fields": _ddl(
        [*MAP_IDENTITY, "side", "field_name", "data_type", "data_length"], "ordinal BIGINT", "run_id BIGINT"
    ),
    "document_errors": _ddl(["kind", "path", "problem"]),
    "map_variables": _ddl(["tracker_db", "map_name", "variable_name", "variable_value"]),
    "special_events": _ddl(["audit_name", "map_name", "event_name", "event_value"]),
    "structure_diffs": _ddl(["pack_id", "table_name", "column_name", "difference"]),
    "data_diffs": _ddl(["pack_id", "table_name", "row_key", "difference"]),
    "clients": _ddl(["audit_name", "phase", "tracker_db", "legacy_db", "new_db"]),
    "packages": _ddl(
        [
            "audit_id",
            "pack_id",
            "audit_name",
            "new_package",
            "phase",
            "connector_type",
            "package_status",
            "legacy_table",
            "new_table",
            "legacy_status",
            "new_status",
            "job_name",
            "legacy_maps",
            "data_file",
        ]
    ),
    "comparison_flags": _ddl(
        ["audit_id", "pack_id"],
        "has_data_difference INT",
        "has_template_difference INT",
        "has_read_difference INT",
        "has_write_difference INT",
    ),
}

# Widths of the one table whose column sizes are declared.
EVENT_WIDTHS = {
    "audit_name": 50,
    "map_id": 10,
    "map_folder": 100,
    "map_name": 255,
    "event_source": 255,
    "event_name": 255,
    "action_name": 255,
    "parameter_name": 255,
}


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


# XML layouts. Every level is an array, so that a repeated block is kept
# whole; `_text` as value tag keeps the text apart from a `value` attribute.
XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "valueTag": "_text",
    "ignoreSurroundingSpaces": "false",
}

_OPTIONS = "ARRAY<STRUCT<Option: ARRAY<STRUCT<_name: STRING, _value: STRING>>>>"


TF_DOCUMENT = f"""
    TransformationOptions {_OPTIONS},
    TransformationSources ARRAY<STRUCT<TransformationSource: ARRAY<STRUCT<
        _connectorname: STRING, TransformationSourceOptions: {_OPTIONS}>>>>,
    TransformationTargets ARRAY<STRUCT<TransformationTarget: ARRAY<STRUCT<_outputmode: STRING>>>>,
    _malformed STRING
"""

# enough to have a document read to its end
WELL_FORMED = "_none STRING, _malformed STRING"

# Fragments of one element each (operators/xmltree.py)
FILTER_ELEMENT = "F: STRUCT<_language: STRING, _text: STRING>"
EVENT_ELEMENTS = """
    Event: STRUCT<_name: STRING>, Action: STRUCT<_name: STRING>, Parameter: STRUCT<_name: STRING, _text: STRING>"""
FIELD_ELEMENTS = "Field: STRUCT<_name: STRING>, Datatype: STRUCT<_dataalias: STRING, _datalength: STRING>"
