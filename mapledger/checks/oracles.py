"""The same results in plain SQL, straight from the given tables.

`{name}` in a statement stands for the stand-in of that name; the stand-ins
a statement uses are put before it as common table expressions.
"""

from __future__ import annotations

import re

SHARE = r"\\files.example\share" + "\\"
AUDITS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_PRIORITY = "'Audit ' || o_orderpriority"
_EVENT_KEY = "audit_name, map_id, event_source, event_name, action_name, parameter_name, parameter_value"
_IDENTITY = "audit_name, map_id, map_folder, map_name"

_COMPARED = {
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "region": "r_regionkey r_name",
}


def _names(table: str) -> str:
    return f"'{_COMPARED[table].replace(' ', '|')}'"


def _cells(table: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({name} AS VARCHAR), 'NULL')" for name in _COMPARED[table].split())


STANDINS = {
    "registry": rf"""
        SELECT {_PRIORITY} AS audit_name, CAST(o_orderkey AS VARCHAR) AS map_id,
               'Y:\maps\c' || o_custkey AS map_folder, 'order_' || o_orderkey || '.tf.xml' AS map_name,
               CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_totalprice >= 20000 THEN 1 END AS active_bit,
               o_orderkey AS doc_ord, o_totalprice >= 50000 AS has_file,
               'Y:\maps\c' || o_custkey || '\order_' || o_orderkey || '.tf.xml' AS tf_path,
               'Y:\maps\c' || o_custkey || '\order_' || o_orderkey || '.map.xml' AS map_path,
               o_orderpriority AS pri, o_orderstatus AS sta, o_custkey AS cust, CAST(1 AS BIGINT) AS run_id
        FROM orders""",
    "text_registry": r"""
        SELECT 'Audit ' || lang AS audit_name, CAST(doc_id AS VARCHAR) AS map_id, 'Y:\texts\' || source AS map_folder,
               doc_id || '.tf.xml' AS map_name, 1 AS active_bit, doc_id AS doc_ord, lang, text
        FROM documents""",
    "repeated_registry": r"""
        SELECT 'Audit ' || l_returnflag AS audit_name,
               CASE WHEN l_discount > 0 THEN CAST(l_orderkey AS VARCHAR) END AS map_id,
               'Y:\maps\p' || l_partkey AS map_folder, 'line_' || l_linenumber || '.tf.xml' AS map_name,
               1 AS active_bit, l_partkey * 10 + l_linenumber AS doc_ord
        FROM lineitem""",
    "status": rf"""
        SELECT {_PRIORITY} AS audit_name, CAST(o_orderkey AS VARCHAR) AS map_id,
               CASE WHEN o_totalprice >= 10000 THEN 'Y:\maps\c' || o_custkey END AS map_folder,
               'order_' || o_orderkey || '.tf.xml' AS map_name,
               CASE WHEN o_orderstatus = 'F' THEN 0 END AS is_available,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END AS not_in_load_log, o_orderstatus, o_totalprice
        FROM orders""",
    "known_status": """
        SELECT * REPLACE ('Audit ' || CASE o_orderstatus WHEN 'P' THEN 'R' ELSE 'A' END AS audit_name)
        FROM {status}""",
    "headers": """
        SELECT audit_name, map_id, map_folder, map_name,
               CASE WHEN pri <> '3-MEDIUM' THEN pri || ' (Delimited)' END AS connector_type,
               CASE WHEN pri <> '3-MEDIUM' THEN 'ANSI' END AS code_page,
               CASE WHEN pri <> '3-MEDIUM' THEN 'LF' END AS record_separator,
               CASE WHEN pri <> '3-MEDIUM' THEN '<&' || sta END AS field_separator,
               CAST(NULL AS VARCHAR) AS field_start_delimiter, CAST(NULL AS VARCHAR) AS field_end_delimiter,
               CASE WHEN pri <> '3-MEDIUM' THEN sta END AS header,
               CASE WHEN pri <> '3-MEDIUM' THEN ' ' || cust || ' ' END AS start_offset,
               map_id AS truncation_handling, pri AS overflow_handling,
               CASE WHEN pri <> '3-MEDIUM' THEN sta END AS layout_mismatch, 'Replace ' || sta AS output_mode,
               run_id, doc_ord, active_bit, has_file, tf_path
        FROM {registry}""",
    "filter_rows": """
        SELECT r.*, 'SourceFilter' AS event_source, 'Filter' AS event_name, 'Filter Source' AS action_name,
               f.parameter_name, f.parameter_value, f.event_ord
        FROM {registry} r, LATERAL (
            SELECT 'SQL' AS parameter_name, 'o_custkey < ' || cust || ' & 1' AS parameter_value, CAST(0 AS BIGINT) AS event_ord
            WHERE pri <> '3-MEDIUM'
            UNION ALL SELECT '007', ' <Script x> & ' || pri || ' ', 1 WHERE pri <> '3-MEDIUM'
            UNION ALL SELECT 'empty', NULL, 2 WHERE pri <> '3-MEDIUM'
            UNION ALL SELECT 'target', 't' || cust, CASE WHEN pri <> '3-MEDIUM' THEN 3 ELSE 0 END) f""",
    "document_rows": """
        SELECT r.*, e.*, row_number() OVER (PARTITION BY doc_ord ORDER BY n) - 1 + 4294967296 AS event_ord,
               row_number() OVER (PARTITION BY doc_ord, event_source ORDER BY n) - 1 + 4294967296 AS section_ord
        FROM {registry} r, LATERAL (
            SELECT 1 AS n, 'Source' AS event_source, 'AfterEveryRecord' AS event_name, pri AS action_name,
                   'count' AS parameter_name, ' ' || cust || ' ' AS parameter_value
            UNION ALL SELECT 2, 'Source', 'AfterEveryRecord', pri, 'empty', NULL
            UNION ALL SELECT 3, 'Source', 'second', 'a', 'p', '1 < 2' WHERE sta = 'F'
            UNION ALL SELECT 4, 'Target', 'BeforePut', 'Put', 'row', '007' || cust
            UNION ALL SELECT 5, 'Map', 'OnStart', 'Set', sta, pri
            UNION ALL SELECT 6, 'Map', 'OnStart', 'Log', 'key', map_id) e""",
    "all_events": f"""
        SELECT {_IDENTITY}, event_source, event_name, action_name, parameter_name, parameter_value,
               run_id, doc_ord, event_ord, active_bit, has_file FROM {{filter_rows}}
        UNION ALL
        SELECT {_IDENTITY}, event_source, event_name, action_name, parameter_name, parameter_value,
               run_id, doc_ord, event_ord, active_bit, has_file FROM {{document_rows}}""",
    "event_history": """
        SELECT 'Audit ' || l_returnflag AS audit_name, CAST(l_suppkey AS VARCHAR) AS map_id, 'f' || l_orderkey AS map_folder,
               'm' || l_suppkey || '.tf.xml' AS map_name,
               CASE l_linestatus WHEN 'O' THEN 'Source' ELSE 'Target' END AS event_source,
               'event ' || l_linenumber AS event_name, 'Map' AS action_name,
               CASE WHEN l_tax > 0 THEN 'size' END AS parameter_name,
               CASE WHEN l_discount > 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS parameter_value,
               l_orderkey AS run_id, l_partkey AS doc_ord, CAST(l_linenumber AS BIGINT) AS event_ord
        FROM lineitem""",
    "header_history": """
        SELECT 'Audit ' || l_returnflag AS audit_name, CAST(l_suppkey AS VARCHAR) AS map_id, 'f' || l_orderkey AS map_folder,
               'm' || l_linenumber || '.tf.xml' AS map_name, 'connector ' || l_linestatus AS connector_type,
               CAST(l_partkey AS VARCHAR) AS code_page, 'record_separator' AS record_separator,
               'field_separator' AS field_separator, 'field_start_delimiter' AS field_start_delimiter,
               'field_end_delimiter' AS field_end_delimiter, 'header' AS header, 'start_offset' AS start_offset,
               'truncation_handling' AS truncation_handling, 'overflow_handling' AS overflow_handling,
               'layout_mismatch' AS layout_mismatch, l_linestatus AS output_mode, l_orderkey AS run_id,
               l_partkey * 2 + CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS doc_ord
        FROM lineitem""",
    "summary_history": """
        SELECT 'Audit ' || l_returnflag AS audit_name,
               CASE WHEN l_tax > 0 THEN 'part_' || l_partkey || '.map.xml' END AS map_name, 'load_' || l_orderkey AS file_name,
               'server' || l_linestatus AS sql_server, 'db' || l_suppkey AS database_name, 't' || l_linenumber AS table_name,
               l_shipdate AS last_load,
               ((l_orderkey * 1000000 + l_suppkey) * 10 + l_linenumber) * 2 + CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS run_id
        FROM lineitem""",
    "log": r"""
        SELECT l_returnflag AS data_group, 'load_' || l_orderkey || '_' || l_linenumber || '.txt' AS file_name,
               's_' || l_orderkey AS s_file_name, 'server' || l_returnflag AS sql_server, 'db' || l_linestatus AS sql_database,
               CAST(floor(l_extendedprice) AS BIGINT) AS file_size, l_shipdate AS load_start,
               l_quantity, l_discount, l_linenumber, l_partkey, l_suppkey
        FROM lineitem""",
    "legacy_log": r"""
        SELECT *, CASE WHEN l_quantity > 1 THEN 'Y:\maps\s' || l_suppkey || '\part_' || l_partkey || '.map.xml' END AS map_name,
               'T_' || l_suppkey AS table_name, CAST(l_quantity AS BIGINT) AS records_read,
               CAST(l_quantity AS BIGINT) AS records_written
        FROM {log}""",
    "new_log": r"""
        SELECT *, 'Y:\pkg\part_' || l_partkey || '.dtsx' AS map_name, 'dbo.N_' || l_suppkey AS table_name,
               CAST(l_quantity AS BIGINT) + CASE WHEN l_linenumber = 1 AND l_quantity < 3 THEN 1 ELSE 0 END AS records_read,
               CASE WHEN l_discount > 0 OR l_quantity < 49 THEN CAST(l_quantity AS BIGINT) END AS records_written
        FROM {log}""",
    "pairs": r"""
        SELECT a.map_name, split_part(a.map_name, '\', -1) AS legacy_map, split_part(s.map_name, '\', -1) AS new_package,
               coalesce(a.file_name, s.file_name) AS file_name, 'dbo.' || a.table_name AS legacy_table,
               s.table_name AS new_table, a.records_read AS legacy_read, s.records_read AS new_read,
               a.records_written AS legacy_written, s.records_written AS new_written
        FROM {legacy_log} a JOIN {new_log} s
          ON a.file_name = s.file_name
         AND replace(split_part(a.map_name, '\', -1), '.map.xml', '') = replace(split_part(s.map_name, '\', -1), '.dtsx', '')""",
    "packages": """
        SELECT n_name AS audit_id, CAST(s_suppkey AS VARCHAR) AS pack_id, r_name AS audit_name,
               'dbo.T_' || s_suppkey AS legacy_table, 'dbo.N_' || s_suppkey AS new_table
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "details": """
        SELECT audit_id, pack_id, audit_name, p.*, legacy_read - new_read AS read_diff, legacy_written - new_written AS write_diff
        FROM {packages} JOIN {pairs} p USING (legacy_table, new_table)""",
    "supplier_flags": """
        SELECT n_name AS audit_id, id.prefix || s_suppkey AS pack_id,
               CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS has_data_difference,
               CASE WHEN s_acctbal > 8000 THEN 1 ELSE 0 END AS has_template_difference,
               9 AS has_read_difference, 8 AS has_write_difference
        FROM supplier JOIN nation ON n_nationkey = s_nationkey, (VALUES (''), ('idle ')) AS id(prefix)""",
    "order_packages": r"""
        SELECT 'A' || o_custkey AS audit_id, CAST(o_orderkey AS VARCHAR) AS pack_id, 'Audit ' || o_orderpriority AS audit_name,
               'order_' || o_orderkey || '.dtsx' AS new_package, o_orderstatus AS phase,
               CASE WHEN o_totalprice > 200000 THEN 'Delimited' ELSE 'Fixed' END AS connector_type,
               'status ' || o_orderstatus AS package_status, 'dbo.T_' || o_custkey AS legacy_table,
               'dbo.N_' || o_orderkey AS new_table, 'loaded' AS legacy_status,
               CASE o_orderstatus WHEN 'F' THEN 'loaded' ELSE 'waiting' END AS new_status, 'job ' || o_orderpriority AS job_name,
               'shared_' || o_custkey || '.tf.xml;order_' || o_orderkey || '.tf.xml' AS legacy_maps,
               '\\files.example\data\' || o_orderkey AS data_file
        FROM orders""",
    "clients": """
        SELECT c_mktsegment || '_' || c_custkey AS audit_name, CAST(c_nationkey AS VARCHAR) AS phase,
               'tracker' || c_custkey AS tracker_db, 'legacy' || c_custkey AS legacy_db, 'new' || c_custkey AS new_db
        FROM customer""",
    "requests": """
        SELECT CAST(c_custkey AS VARCHAR) AS request_id, 'Audit' AS audit_name,
               CASE WHEN c_acctbal > 5000 THEN 'O' ELSE 'F' END AS phase, 'shared_' || c_custkey || '.tf.xml' AS map_name
        FROM customer""",
    "requested": """
        SELECT r.request_id, p.* FROM {requests} r JOIN {order_packages} p
          ON p.phase = r.phase AND p.legacy_maps LIKE '%' || r.map_name || '%' AND p.audit_name LIKE '%' || r.audit_name || '%'""",
    "picked": """
        SELECT r.request_id, coalesce(max(pack_id), '') AS pack_id,
               coalesce(replace(arg_max(legacy_table, pack_id), 'dbo.', ''), '') AS legacy_table,
               coalesce(replace(arg_max(new_table, pack_id), 'dbo.', ''), '') AS new_table,
               coalesce(arg_max(data_file, pack_id), '') AS data_file, count(pack_id) AS match_count
        FROM {requests} r LEFT JOIN {requested} p USING (request_id) GROUP BY r.request_id""",
    "order_flags": """
        SELECT 'A' || o_custkey AS audit_id, CAST(o_orderkey AS VARCHAR) AS pack_id,
               CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS has_data_difference,
               CASE o_orderpriority WHEN '2-HIGH' THEN 1 ELSE 0 END AS has_template_difference,
               0 AS has_read_difference, 1 AS has_write_difference
        FROM orders""",
    "line_diffs": """
        SELECT CAST(l_orderkey AS VARCHAR) AS pack_id, 'column ' || l_linenumber AS column_name,
               l_returnflag || l_linestatus AS problem
        FROM lineitem""",
    "flagged_summary": rf"""
        SELECT 'Audit ' || CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN '3-MEDIUM'
                                WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN '1-URGENT'
                                ELSE o_orderpriority END AS audit_name,
               CASE WHEN o_orderpriority <> '5-LOW'
                    THEN '{SHARE}maps\c' || o_custkey || '\order_' || o_orderkey || '.tf.xml' END AS path
        FROM orders WHERE o_totalprice >= 100000""",
    "structure": """
        SELECT 'Y:\\maps\\c' || o_custkey || '\\order_' || o_orderkey || '.map.xml' AS table_name, c.*
        FROM orders, LATERAL (
            SELECT 'o_custkey' AS column_key, 'o_custkey' AS column_a, 'O_CUSTKEY' AS column_b, o_orderstatus AS type_a, 'F' AS type_b,
                   CAST(1 AS BIGINT) AS ordinal_a, CAST(1 AS BIGINT) AS ordinal_b, 'type' AS problem
            WHERE o_orderstatus <> 'F'
            UNION ALL SELECT lower('bare ' || o_orderstatus), 'bare ' || o_orderstatus, NULL, NULL, NULL, 2, NULL, 'only in a'
            UNION ALL SELECT 'extra', NULL, 'extra', NULL, 'text', NULL, 2, 'only in b') c""".replace("\\\\", "\\"),
    "row_counts": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               CAST(sum(a) AS BIGINT) AS count_a, CAST(sum(b) AS BIGINT) AS count_b
        FROM (SELECT *, 1 AS a, 0 AS b FROM orders
              UNION ALL
              SELECT * REPLACE (CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_orderpriority END AS o_orderpriority), 0, 1
              FROM orders WHERE o_totalprice >= 5000
              UNION ALL SELECT *, 0, 1 FROM orders WHERE o_totalprice < 15000)
        GROUP BY ALL HAVING sum(a) <> sum(b)""",
    "changed_lines": """
        SELECT * REPLACE (CASE WHEN l_linenumber = 2 AND l_quantity = 50 THEN NULL ELSE l_discount END AS l_discount)
        FROM lineitem WHERE NOT (l_tax = 0 AND l_quantity = 1)""",
    "pair_counts": f"""
        SELECT 'orders' AS pair_id, {_names("orders")} AS names, {_cells("orders")} AS cells, count_a, count_b FROM {{row_counts}}
        UNION ALL
        SELECT 'lines', {_names("lineitem")}, cells, CAST(sum(a) AS BIGINT), CAST(sum(b) AS BIGINT)
        FROM (SELECT {_cells("lineitem")} AS cells, 1 AS a, 0 AS b FROM lineitem
              UNION ALL SELECT {_cells("lineitem")}, 0, 1 FROM {{changed_lines}})
        GROUP BY ALL HAVING sum(a) <> sum(b)
        UNION ALL
        SELECT 'customer', 'c_custkey|c_name|c_nationkey', concat_ws('|', c_custkey, c_name, c_nationkey), 1, 0
        FROM customer WHERE NOT coalesce(c_acctbal > 0, FALSE)
        UNION ALL SELECT 'supplier', {_names("supplier")}, {_cells("supplier")}, 1, 0 FROM supplier
        UNION ALL SELECT 'region', {_names("region")}, {_cells("region")}, 0, 1 FROM region
        UNION ALL SELECT 'nation', '', '', (SELECT count(*) FROM nation), (SELECT count(*) FROM region)""",
}

_LOG_PATH = rf"replace(map_folder || '\' || map_name, 'Y:\', '{SHARE}')"
_LOADED = (
    rf"SELECT '{SHARE}maps\c' || o_custkey || '\order_' || o_orderkey || '.tf.xml' AS path FROM orders WHERE o_totalprice >= 100000"
)
_STATUS = f"{_IDENTITY}, is_available"
_EVENT_COLUMNS = "event_source, event_name, action_name, parameter_name, parameter_value"
_LINES = "data_group, file_name, map_name, table_name, s_file_name, records_read, records_written, file_size, sql_database"
_HEADER = (
    "audit_name, map_id, map_folder, map_name, connector_type, code_page, record_separator, field_separator,"
    " field_start_delimiter, field_end_delimiter, header, start_offset, truncation_handling, overflow_handling,"
    " layout_mismatch, output_mode, run_id, doc_ord"
)
_OVERVIEW = (
    "pack_id, audit_name, new_package, phase, connector_type, package_status, legacy_table, new_table,"
    " legacy_status, new_status, job_name"
)


def _newest(table: str, keys: str, order: str, where: str = "TRUE") -> str:
    return f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {{{table}}} WHERE {where})
        WHERE rn = 1"""


def _section(source: str) -> str:
    return f"""SELECT {_IDENTITY}, {_EVENT_COLUMNS}, run_id, doc_ord, section_ord AS event_ord
               FROM {{document_rows}} WHERE event_source = '{source}'"""


def _flags(details: str) -> str:
    return f"""
        SELECT f.audit_id, f.pack_id, has_data_difference, has_template_difference,
               coalesce(d.r, has_read_difference) AS has_read_difference,
               coalesce(d.w, has_write_difference) AS has_write_difference
        FROM {{supplier_flags}} f LEFT JOIN (
            SELECT audit_id, pack_id, max(CASE WHEN read_diff = 0 THEN 0 ELSE 1 END) AS r,
                   max(CASE WHEN write_diff = 0 THEN 0 ELSE 1 END) AS w
            FROM {details} GROUP BY ALL) d ON d.audit_id = f.audit_id AND d.pack_id = f.pack_id"""


def _in_order() -> str:
    parts = []
    for turn, audit in enumerate(AUDITS, 1):
        seen = ", ".join(f"'Audit {name}'" for name in AUDITS[:turn])
        parts.append(f"""
            SELECT {_STATUS}, CASE WHEN {_LOG_PATH} NOT IN (SELECT path FROM {{flagged_summary}} WHERE audit_name IN ({seen}))
                                   THEN 1 ELSE not_in_load_log END AS not_in_load_log
            FROM {{status}} WHERE audit_name = 'Audit {audit}'""")
    return " UNION ALL ".join(parts)


_SUMMARY = """max(file_name) AS file_name, max(sql_server) AS sql_server, max(sql_database) AS database_name,
              max(table_name) AS table_name, max(load_start) AS last_load"""

_SHARED_LOG = r"""(SELECT CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE 'legacy' END AS engine,
    'Y:\maps\' || o_orderpriority || '\shared_' || o_custkey || '.map.xml' AS map_name FROM orders)"""


def _section_count(section: str, rows: str) -> str:
    return f"SELECT request_id, count(*) AS line_count, '{section}' AS section FROM ({rows}) GROUP BY request_id"


def _report() -> str:
    lines = f"""SELECT request_id FROM {{requests}} r JOIN {_SHARED_LOG} l
                ON l.map_name LIKE '%' || replace(r.map_name, '.tf.xml', '') || '%' AND l.engine = '%s'"""
    diffs = "SELECT p.request_id FROM {picked} p JOIN {order_flags} f USING (pack_id) JOIN {line_diffs} d USING (pack_id) WHERE f.%s = 1"
    sections = {
        "client": """SELECT request_id FROM {requests} r JOIN {clients} c
                     ON c.phase = r.phase AND c.audit_name LIKE '%' || r.audit_name || '%'""",
        "package": "SELECT request_id FROM {picked}",
        "package_overview": "SELECT request_id FROM {requested}",
        "map_variables": """SELECT request_id FROM {requests} r JOIN orders ON r.map_name = 'shared_' || o_custkey || '.tf.xml'""",
        "comparison_flags": "SELECT request_id FROM {picked} JOIN {order_flags} USING (pack_id)",
        "structure_diffs": diffs % "has_template_difference",
        "data_diffs": diffs % "has_data_difference",
        "load_lines_legacy": lines.replace("%s", "legacy"),
        "load_lines_new": lines.replace("%s", "new"),
        "special_events": """SELECT request_id FROM {requests} r JOIN orders ON r.map_name = 'shared_' || o_custkey || '.tf.xml'
                             AND r.audit_name = CASE WHEN o_orderstatus = 'O' THEN 'Audit' ELSE 'Audit x' END""",
    }
    return " UNION ALL ".join(_section_count(name, rows) for name, rows in sections.items())


_RUN_STATUS = f"""
    SELECT {_IDENTITY}, CASE WHEN NOT has_file THEN 0 END AS is_available,
           CASE WHEN tf_path NOT IN (
               SELECT 'Y:\\maps\\c' || o_custkey || '\\order_' || o_orderkey || '.tf.xml' FROM orders
               WHERE o_totalprice >= 120000 AND year(o_orderdate) > 1996) THEN 1 END AS not_in_load_log
    FROM {{registry}} WHERE active_bit = 1""".replace("\\\\", "\\")

STATEMENTS = {
    "registry_active": "SELECT audit_name, map_id, map_folder, map_name, active_bit, doc_ord FROM {registry} WHERE active_bit = 1",
    "audits_excluding": """
        SELECT * FROM (SELECT CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS audit_name, c_name AS server,
                              'registry' || c_custkey AS registry_db, 'tracker' || c_nationkey AS tracker_db FROM customer)
        WHERE audit_name <> 'BUILDING'""",
    "registry_union": """
        SELECT map_id, map_folder, map_name, active_bit, 'orders' AS audit_name FROM {registry}
        UNION ALL SELECT map_id, map_folder, map_name, active_bit, 'lines' FROM {repeated_registry}
        UNION ALL SELECT map_id, map_folder, map_name, active_bit, 'texts' FROM {text_registry}""",
    "missing_files": "SELECT audit_name, map_id, tf_path FROM {registry} WHERE active_bit = 1 AND NOT has_file",
    "available_maps": "SELECT audit_name, map_id, tf_path FROM {registry} WHERE active_bit = 1 AND has_file",
    "scan_log": f"SELECT {_LINES}, sql_server, load_start FROM {{new_log}}",
    "snapshot_documents": f"SELECT {_HEADER} FROM {{headers}} WHERE active_bit = 1",
    "derive_paths": "SELECT map_id, tf_path, map_path FROM {registry}",
    "source_connector": "SELECT tf_path AS path, connector_type FROM {headers}",
    "source_options": """
        SELECT tf_path AS path, o.* FROM {registry}, LATERAL (
            SELECT 'codepage' AS option_name, 'ANSI' AS option_value UNION ALL SELECT 'recsep', 'LF'
            UNION ALL SELECT 'fldsep', '<&' || sta UNION ALL SELECT 'fldsdelim', NULL UNION ALL SELECT 'header', sta
            UNION ALL SELECT 'soffset', ' ' || cust || ' ' UNION ALL SELECT 'Layoutmismatch', '9'
            UNION ALL SELECT 'layoutmismatch', sta) o
        WHERE pri <> '3-MEDIUM'""",
    "transformation_options": """
        SELECT tf_path AS path, o.* FROM {registry}, LATERAL (
            SELECT 'truncationhandling' AS option_name, map_id AS option_value UNION ALL SELECT 'overflowhandling', pri) o""",
    "target_output_mode": "SELECT tf_path AS path, output_mode FROM {headers}",
    "pivot_options": """
        SELECT tf_path AS path, code_page, record_separator, field_separator, field_start_delimiter, field_end_delimiter,
               header, start_offset, truncation_handling, overflow_handling, layout_mismatch FROM {headers}""",
    "map_headers": f"SELECT {_HEADER} FROM {{headers}}",
    "latest_headers": f"SELECT {_HEADER} FROM {{headers}}",
    "filter_events": f"SELECT {_IDENTITY}, {_EVENT_COLUMNS}, run_id, doc_ord, event_ord FROM {{filter_rows}}",
    "source_events": _section("Source"),
    "target_events": _section("Target"),
    "map_level_events": _section("Map"),
    "map_events_union": f"SELECT {_IDENTITY}, {_EVENT_COLUMNS}, run_id, doc_ord, event_ord FROM {{all_events}}",
    "event_text_lines": f"""
        SELECT {_IDENTITY}, 'Map' AS event_source, 'text' AS event_name, lang AS action_name,
               CAST(i AS VARCHAR) AS parameter_name,
               CASE WHEN trim(lines[i]) <> '' THEN lines[i] END AS parameter_value,
               CAST(1 AS BIGINT) AS run_id, doc_ord, i - 1 + 4294967296 AS event_ord
        FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i
              FROM (SELECT *, string_split(text, chr(10)) AS lines FROM {{text_registry}}))""",
    "source_fields": """
        SELECT map_path AS path, f.* FROM {registry}, LATERAL (
            SELECT CAST(1 AS BIGINT) AS ordinal, 'o_custkey' AS field_name, sta AS data_type, CAST(cust AS VARCHAR) AS data_length
            UNION ALL SELECT 2, 'bare ' || sta, NULL, NULL) f""",
    "target_fields": """
        SELECT map_path AS path, f.* FROM {registry}, LATERAL (
            SELECT CAST(1 AS BIGINT) AS ordinal, 'O_CUSTKEY' AS field_name, 'F' AS data_type, CAST(cust AS VARCHAR) AS data_length
            UNION ALL SELECT 2, 'extra', 'text', NULL) f""",
    "document_errors": """
        SELECT 'tf' AS kind, tf_path AS path, CASE sta WHEN 'F' THEN 'malformed' ELSE 'unreadable' END AS problem
        FROM {registry} WHERE sta <> 'O'
        UNION ALL SELECT 'map', map_path, 'missing' FROM {registry} WHERE NOT has_file""",
    "unread_elements": r"""
        SELECT 'tf' AS kind, concat('Y:\maps\c', o_custkey, '\order_', o_orderkey, '.tf.xml') AS path, 'TransformationSource' AS element,
               CAST(2 AS BIGINT) AS in_text, CAST(0 AS BIGINT) AS read
        FROM orders WHERE o_orderstatus = 'O'
        UNION ALL
        SELECT 'map', concat('Y:\maps\c', o_custkey, '\order_', o_orderkey, '.map.xml'),
               CASE o_orderstatus WHEN 'F' THEN 'Parameter' ELSE 'Field' END, CASE o_orderstatus WHEN 'F' THEN 2 ELSE 3 END, 1
        FROM orders WHERE o_orderstatus <> 'O'""",
    "document_layouts": r"""
        SELECT CASE o_orderstatus WHEN 'O' THEN 'tf' ELSE 'map' END AS kind,
               concat('Y:\maps\c', o_custkey, '\order_', o_orderkey, CASE o_orderstatus WHEN 'O' THEN '.tf.xml' ELSE '.map.xml' END) AS path,
               'layout' AS problem
        FROM orders""",
    "nested_events": r"""
        SELECT concat('Y:\maps\c', o_custkey, '\order_', o_orderkey, '.map.xml') AS path, place, 'Map' AS event_source,
               CASE o_orderstatus WHEN 'O' THEN o_orderpriority ELSE 'e' END AS event_name, action_name, parameter_name,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR)
                    WHEN place = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '<O' END AS parameter_value
        FROM orders JOIN (VALUES ('O', 0, 'outer', 'p'), ('O', 1, 'outer', 'q'), ('O', 2, 'inner', 'q'), ('F', 0, 'a', 'p'))
             AS rows(status, place, action_name, parameter_name) ON o_orderstatus = status""",
    "overlong_values": """
        SELECT map_folder, event_name,
               concat_ws(',', CASE WHEN length(map_folder) > 5 THEN 'map_folder' END, 'event_name') AS overlong
        FROM {event_history} WHERE length(event_name) > 6""",
    "status_upsert": f"""
        SELECT {_STATUS}, not_in_load_log FROM {{known_status}}
        UNION ALL
        SELECT {_IDENTITY}, NULL, NULL FROM (
            SELECT *, row_number() OVER (PARTITION BY audit_name, map_id ORDER BY doc_ord) AS rn
            FROM {{repeated_registry}} r WHERE map_id IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM {{known_status}} k WHERE k.map_id = r.map_id AND k.audit_name = r.audit_name))
        WHERE rn = 1
        UNION ALL SELECT {_IDENTITY}, NULL, NULL FROM {{repeated_registry}} WHERE map_id IS NULL""",
    "status_unavailable": f"""
        SELECT {_IDENTITY}, CASE WHEN o_totalprice < 50000 THEN 0 ELSE is_available END AS is_available, not_in_load_log
        FROM {{status}}""",
    "flag_not_loaded": f"""
        SELECT {_STATUS}, CASE WHEN {_LOG_PATH} NOT IN ({_LOADED}) THEN 1 ELSE not_in_load_log END AS not_in_load_log
        FROM {{status}}""",
    "flag_not_loaded_with_null": f"""
        SELECT {_STATUS}, CASE WHEN {_LOG_PATH} NOT IN ({_LOADED} UNION ALL SELECT NULL FROM orders WHERE o_totalprice < 100000)
                               THEN 1 ELSE not_in_load_log END AS not_in_load_log
        FROM {{status}}""",
    "flag_not_loaded_one_audit": f"""
        SELECT {_STATUS}, CASE WHEN {_LOG_PATH} NOT IN ({_LOADED}) AND audit_name = 'Audit 2-HIGH'
                               THEN 1 ELSE not_in_load_log END AS not_in_load_log
        FROM {{status}}""",
    "flag_not_loaded_in_order": _in_order(),
    "normalize_path": rf"""
        SELECT file_name, map_name, replace(replace(map_name, 'Y:\', '{SHARE}'), 'map.xml', 'tf.xml') AS normal_path
        FROM {{legacy_log}}""",
    "load_summary": f"""
        SELECT 'Audit ' || data_group AS audit_name, map_name, {_SUMMARY}, CAST(1 AS BIGINT) AS run_id
        FROM {{legacy_log}} WHERE year(load_start) > 1998 GROUP BY ALL""",
    "load_summary_recent": f"""
        SELECT 'Audit events' AS audit_name, map_name, {_SUMMARY}, CAST(0 AS BIGINT) AS run_id
        FROM (SELECT CASE WHEN value > 1 THEN 'user_' || user_id || '.map.xml' END AS map_name, 'file ' || event_id AS file_name,
                     event_type AS sql_server, props AS sql_database, 't' || user_id AS table_name, ts AS load_start FROM events)
        WHERE year(load_start) > 2021 GROUP BY map_name""",
    "dedupe_events": _newest("event_history", _EVENT_KEY, "run_id DESC, doc_ord DESC, event_ord DESC"),
    "dedupe_events_one_audit": _newest(
        "event_history", _EVENT_KEY, "run_id DESC, doc_ord DESC, event_ord DESC", "audit_name = 'Audit R'"
    )
    + " UNION ALL SELECT * FROM {event_history} WHERE audit_name <> 'Audit R'",
    "dedupe_events_collated": """
        SELECT audit_name, map_id, event_source, action_name, parameter_name, parameter_value,
               count(*) AS kept, max(run_id) AS newest_run
        FROM (SELECT audit_name, map_id, event_source, event_name, action_name, parameter_name, parameter_value,
                     max(run_id) AS run_id FROM {event_history} GROUP BY ALL)
        GROUP BY ALL""",
    "dedupe_load_summary": _newest("summary_history", "audit_name, map_name", "run_id DESC"),
    "dedupe_headers": _newest("header_history", "audit_name, map_id, map_name", "run_id DESC, doc_ord DESC"),
    "base_name": r"SELECT file_name, map_name, split_part(map_name, '\', -1) AS base_name FROM {legacy_log}",
    "map_stem": r"SELECT file_name, replace(split_part(map_name, '\', -1), '.map.xml', '') AS stem FROM {legacy_log}",
    "pair_loads": "SELECT * FROM {pairs}",
    "count_diffs": """
        SELECT file_name, legacy_map, legacy_read - new_read AS read_diff, legacy_written - new_written AS write_diff FROM {pairs}""",
    "diff_flag": """
        SELECT file_name, legacy_map, CASE WHEN legacy_read - new_read = 0 THEN 0 ELSE 1 END AS read_flag,
               CASE WHEN legacy_written - new_written = 0 THEN 0 ELSE 1 END AS write_flag FROM {pairs}""",
    "attach_packages": """
        SELECT audit_id, pack_id, audit_name, file_name, legacy_table, new_table
        FROM {packages} JOIN {pairs} USING (legacy_table, new_table) WHERE audit_name = 'EUROPE'""",
    "reconcile_details": "SELECT * FROM {details}",
    "update_flags": _flags("{details}"),
    "reconcile_flags": _flags("{details}"),
    "reconcile_flags_one_audit": _flags("{details} WHERE audit_name = 'ASIA'"),
    "strip_schema": "SELECT file_name, replace(table_name, 'dbo.', '') AS table_name FROM {new_log}",
    "find_client": "SELECT * FROM {clients} WHERE phase = '7' AND audit_name LIKE '%_1%'",
    "find_package": """
        SELECT coalesce(max(pack_id), '') AS pack_id,
               coalesce(replace(arg_max(legacy_table, pack_id), 'dbo.', ''), '') AS legacy_table,
               coalesce(replace(arg_max(new_table, pack_id), 'dbo.', ''), '') AS new_table,
               coalesce(arg_max(data_file, pack_id), '') AS data_file, count(*) AS match_count
        FROM {order_packages} WHERE phase = 'O' AND audit_name LIKE '%Audit 2%' AND legacy_maps LIKE '%shared_1_.tf.xml%'""",
    "find_package_none": """
        SELECT '' AS pack_id, '' AS legacy_table, '' AS new_table, '' AS data_file, count(*) AS match_count
        FROM {order_packages} WHERE phase = 'O' AND legacy_maps LIKE '%no such map%'""",
    "package_overview": f"""
        SELECT {_OVERVIEW} FROM {{order_packages}}
        WHERE phase = 'F' AND audit_name LIKE '%-%' AND legacy_maps LIKE '%shared_1__.tf.xml%'""",
    "map_variables": """
        SELECT 'user_' || user_id || '.tf.xml' AS map_name, event_type AS variable_name, props AS variable_value
        FROM events WHERE 'user_' || user_id || '.tf.xml' = 'user_8.tf.xml'""",
    "comparison_flags": "SELECT * FROM {order_flags} WHERE pack_id = '7'",
    "structure_diffs_if_flagged": """
        SELECT * FROM {line_diffs} WHERE pack_id IN (SELECT pack_id FROM {order_flags} WHERE has_template_difference = 1)""",
    "data_diffs_if_flagged": """
        SELECT * FROM {line_diffs} WHERE pack_id IN (SELECT pack_id FROM {order_flags} WHERE has_data_difference = 1)""",
    "load_lines_legacy": f"SELECT {_LINES} FROM {{legacy_log}} WHERE map_name LIKE '%part_1_%'",
    "load_lines_new": f"SELECT {_LINES} FROM {{new_log}} WHERE map_name LIKE '%part_1_%'",
    "load_lines_literal": f"SELECT {_LINES} FROM {{new_log}} WHERE contains(map_name, 'part_1')",
    "special_events": """
        SELECT 'Audit ' || event_type AS audit_name, 'user_' || user_id || '.tf.xml' AS map_name, event_id, props AS parameter_value
        FROM events WHERE event_type = 'error' AND 'user_' || user_id || '.tf.xml' = 'user_8.tf.xml'""",
    "clients_for_requests": """
        SELECT CAST(r.c_custkey AS VARCHAR) AS request_id, c.* FROM customer r JOIN {clients} c
          ON c.phase = CAST(r.c_nationkey AS VARCHAR) AND c.audit_name LIKE '%_' || r.c_custkey || '%'""",
    "package_overview_for_requests": f"SELECT request_id, {_OVERVIEW} FROM {{requested}}",
    "find_package_for_requests": "SELECT * FROM {picked}",
    "load_lines_for_requests": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS request_id, {_LINES}
        FROM {{legacy_log}} JOIN (
            SELECT DISTINCT map_name AS name, p_partkey FROM (SELECT DISTINCT map_name FROM {{legacy_log}})
            JOIN part ON map_name LIKE '%part_' || p_partkey || '%') ON map_name = name""",
    "acceptance_report_all": _report(),
    "compare_structure": "SELECT * FROM {structure}",
    "compare_rows": "SELECT * FROM {row_counts}",
    "compare_rows_lineitem": """
        SELECT * EXCLUDE (a, b), CAST(sum(a) AS BIGINT) AS count_a, CAST(sum(b) AS BIGINT) AS count_b
        FROM (SELECT *, 1 AS a, 0 AS b FROM lineitem
              UNION ALL SELECT *, 0, 1 FROM lineitem WHERE l_quantity < 45
              UNION ALL SELECT *, 0, 1 FROM lineitem WHERE l_tax = 0)
        GROUP BY ALL HAVING sum(a) <> sum(b)""",
    "comparison_summary": """
        SELECT CAST(c > 0 AS INTEGER) AS has_template_difference, CAST(a + b > 0 AS INTEGER) AS has_data_difference,
               c AS column_differences, a AS rows_only_in_a, b AS rows_only_in_b
        FROM (SELECT (SELECT count(*) FROM {structure}) AS c,
                     CAST(coalesce(sum(greatest(count_a - count_b, 0)), 0) AS BIGINT) AS a,
                     CAST(coalesce(sum(greatest(count_b - count_a, 0)), 0) AS BIGINT) AS b FROM {row_counts})""",
    "compare_rows_by_bucket": """
        SELECT * EXCLUDE (a, b), CAST(sum(a) AS BIGINT) AS count_a, CAST(sum(b) AS BIGINT) AS count_b
        FROM (SELECT *, 1 AS a, 0 AS b FROM lineitem UNION ALL SELECT *, 0, 1 FROM {changed_lines})
        GROUP BY ALL HAVING sum(a) <> sum(b)""",
    "compare_pairs_rows": "SELECT * FROM {pair_counts}",
    "compare_pairs_summary": """
        SELECT pair_id, CAST(c > 0 AS INTEGER) AS has_template_difference, CAST(a + b > 0 AS INTEGER) AS has_data_difference,
               CAST(c AS BIGINT) AS column_differences, a AS rows_only_in_a, b AS rows_only_in_b
        FROM (SELECT p.pair_id, any_value(p.c) AS c,
                     CAST(coalesce(sum(greatest(count_a - count_b, 0)), 0) AS BIGINT) AS a,
                     CAST(coalesce(sum(greatest(count_b - count_a, 0)), 0) AS BIGINT) AS b
              FROM (VALUES ('orders', 0), ('lines', 0), ('customer', 4), ('part', 0), ('supplier', 4), ('region', 2),
                           ('nation', 5)) p(pair_id, c)
              LEFT JOIN {pair_counts} r ON r.pair_id = p.pair_id GROUP BY p.pair_id)""",
    "audit_run_status": _RUN_STATUS,
    "audit_run_headers": f"""
        SELECT {_HEADER.replace(" run_id", " CAST(2 AS BIGINT) AS run_id")} FROM {{headers}} WHERE active_bit = 1 AND has_file""",
    "audit_run_events": f"""
        SELECT {_IDENTITY}, {_EVENT_COLUMNS}, CAST(2 AS BIGINT) AS run_id, doc_ord, event_ord
        FROM {{all_events}} WHERE active_bit = 1 AND has_file""",
    "audit_run_load_summary": r"""
        SELECT 'Audit ' || o_orderpriority AS audit_name, 'Y:\maps\c' || o_custkey || '\order_' || o_orderkey || '.map.xml' AS map_name,
               'file ' || o_orderkey AS file_name, o_orderstatus AS sql_server, 'db' || o_custkey AS database_name,
               't' || o_custkey AS table_name, o_orderdate AS last_load, CAST(2 AS BIGINT) AS run_id
        FROM orders WHERE o_totalprice >= 120000 AND year(o_orderdate) > 1996""",
}

_NAME = re.compile(r"\{([a-z_]+)\}")


def oracle_sql() -> dict[str, str]:
    return {name: _expand(body) for name, body in STATEMENTS.items()}


def _expand(body: str) -> str:
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name not in order:
                visit(STANDINS[name])
                order.append(name)

    visit(body)
    ctes = [f"{name} AS ({_NAME.sub(r'\1', STANDINS[name])})" for name in order]
    with_clause = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
    return with_clause + _NAME.sub(r"\1", body).strip()
