"""Inputs of the audit, derived by Spark from the given benchmark tables.

Row-wise only: every registry row, document and log line comes from one row
of a large table, so their number grows with it and nothing is grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapledger.functions.text import derive_paths
from mapledger.session import spread


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _spread(self, name: str) -> DataFrame:
        """Rows of a table dealt out to all cores, as making a document of a row is much work.

        As finely as a shuffle is, so that no task grows with the table alone.
        """
        tasks = max(self.spark.sparkContext.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return self.table(name).repartition(tasks)

    # --- registry ---------------------------------------------------------

    def registry(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "concat('Audit ', o_orderpriority) AS audit_name",
            "CAST(o_orderkey AS STRING) AS map_id",
            r"concat('Y:\\maps\\c', o_custkey) AS map_folder",
            "concat('order_', o_orderkey, '.tf.xml') AS map_name",
            "CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_totalprice >= 20000 THEN 1 END AS active_bit",
            "o_orderkey AS doc_ord",
        )

    def maps(self) -> DataFrame:
        return derive_paths(self.registry())

    def known_status(self) -> DataFrame:
        """Status rows of some of the maps of `repeated_registry`."""
        return self.status("CASE o_orderstatus WHEN 'P' THEN 'R' ELSE 'A' END")

    def repeated_registry(self) -> DataFrame:
        """A map named by several rows, and rows without an id."""
        return self.table("lineitem").selectExpr(
            "concat('Audit ', l_returnflag) AS audit_name",
            "CASE WHEN l_discount > 0 THEN CAST(l_orderkey AS STRING) END AS map_id",
            r"concat('Y:\\maps\\p', l_partkey) AS map_folder",
            "concat('line_', l_linenumber, '.tf.xml') AS map_name",
            "1 AS active_bit",
            "l_partkey * 10 + l_linenumber AS doc_ord",
        )

    def audits(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS audit_name",
            "c_name AS server",
            "concat('registry', c_custkey) AS registry_db",
            "concat('tracker', c_nationkey) AS tracker_db",
        )

    def status(self, audit: str = "o_orderpriority") -> DataFrame:
        """Maps known from earlier runs, some of them flagged."""
        return self.table("orders").selectExpr(
            f"concat('Audit ', {audit}) AS audit_name",
            "CAST(o_orderkey AS STRING) AS map_id",
            r"CASE WHEN o_totalprice >= 10000 THEN concat('Y:\\maps\\c', o_custkey) END AS map_folder",
            "concat('order_', o_orderkey, '.tf.xml') AS map_name",
            "CASE WHEN o_orderstatus = 'F' THEN 0 END AS is_available",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END AS not_in_load_log",
        )

    def listing(self) -> DataFrame:
        """Transformation documents that exist; orders of small value have none."""
        return self.maps().join(
            self.table("orders").where("o_totalprice >= 50000").selectExpr("o_orderkey AS doc_ord"), "doc_ord"
        ).select(F.col("tf_path").alias("path"))

    # --- documents --------------------------------------------------------

    def _order_documents(self, path: str, content: Column, listing: DataFrame | None = None) -> DataFrame:
        folder = F.concat(F.lit("Y:\\maps\\c"), "o_custkey", F.lit("\\order_"), "o_orderkey", F.lit(path))
        if listing is not None:  # no text is made of what is not listed
            listed = spread(self.table("orders").withColumn("path", folder), "path").join(listing, "path", "left_semi")
            return listed.select("path", content.alias("content"))
        # documents are many times larger than the rows they are made of
        return self._spread("orders").select(folder.alias("path"), content.alias("content"))

    def tf_docs(self, listing: DataFrame | None = None) -> DataFrame:
        """Two sources for open orders, none for medium priority, a repeated
        option, one without a value, filters of several tags, and CDATA; all,
        or those of a listing."""
        stale = F.when(
            F.col("o_orderstatus") == "O",
            F.lit(
                '<TransformationSource connectorname="Stale"><TransformationSourceOptions>'
                '<Option name="codepage" value="stale"/><Option name="nullind" value="x"/>'
                "</TransformationSourceOptions></TransformationSource>"
            ),
        ).otherwise("")
        source = F.format_string(
            '<TransformationSource name="s" connectorname="%s (Delimited)"><TransformationSourceOptions>'
            '<Option name="codepage" value="ANSI"/><Option name="recsep" value="LF"/>'
            '<Option name="fldsep" value="&lt;&amp;%s"/><Option name="fldsdelim"/>'
            '<Option name="header" value="False"/><Option name="header" value="%s"/>'
            '<Option name="soffset" value=" %d "/><Option name="Layoutmismatch" value="9"/>'
            '<Option name="layoutmismatch" value="%s"/></TransformationSourceOptions>'
            "<DataAccess><FilterExpressions>"
            '<FilterExpression language="SQL">o_custkey &lt; %d &amp; 1</FilterExpression>'
            '<Script language="007"><![CDATA[ <Script x> & %s ]]></Script>'
            '<FilterExpression language="empty"/><FilterExpression>no language %s</FilterExpression>'
            "</FilterExpressions></DataAccess></TransformationSource>",
            "o_orderpriority", "o_orderstatus", "o_orderstatus", "o_custkey", "o_orderstatus",
            "o_custkey", "o_orderpriority", "o_orderstatus",
        )
        sources = F.when(F.col("o_orderpriority") == "3-MEDIUM", "").otherwise(F.concat(stale, source))
        return self._order_documents(
            ".tf.xml",
            F.concat(
                F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<Transformation version="1"><TransformationOptions>'),
                F.format_string(
                    '<Option name="truncationhandling" value="%s"/><Option name="overflowhandling" value="first"/>'
                    '<Option name="overflowhandling" value="%s"/></TransformationOptions><TransformationSources>',
                    F.col("o_orderkey").cast("string"), F.col("o_orderpriority"),
                ),
                sources,
                F.format_string(
                    '</TransformationSources><TransformationTargets><TransformationTarget outputmode="Append"/>'
                    '<TransformationTarget outputmode="Replace %s"><DataAccess><FilterExpressions>'
                    '<FilterExpression language="target">t%d</FilterExpression></FilterExpressions></DataAccess>'
                    "</TransformationTarget></TransformationTargets></Transformation>",
                    "o_orderstatus", "o_custkey",
                ),
            ),
            listing,
        )

    def map_docs(self) -> DataFrame:
        """Events without actions, actions without parameters, an empty
        parameter, outer spaces, and a field without a data type."""
        source = F.format_string(
            '<MapSource><MapSchema><RecordLayout><Field name="o_custkey"><Datatype dataalias="%s" datalength="%d"/>'
            '</Field><Field name="bare %s"/></RecordLayout></MapSchema><RecordLayoutEvents>'
            '<Event name="AfterEveryRecord"><Action name="%s"><Parameter name="count"> %d </Parameter>'
            '<Parameter name="empty"/></Action><Action name="none"/></Event><Event name="idle"/>'
            "</RecordLayoutEvents></MapSource>",
            "o_orderstatus", "o_custkey", "o_orderstatus", "o_orderpriority", "o_custkey",
        )
        # a second source for finished orders
        sources = F.concat(
            source,
            F.when(
                F.col("o_orderstatus") == "F",
                F.lit(
                    '<MapSource><RecordLayoutEvents><Event name="second"><Action name="a"><Parameter name="p">'
                    "1 &lt; 2</Parameter></Action></Event></RecordLayoutEvents></MapSource>"
                ),
            ).otherwise(""),
        )
        target = F.format_string(
            '<MapTarget><MapSchema><RecordLayout><Field name="O_CUSTKEY"><Datatype dataalias="F" datalength="%d"/>'
            '</Field><Field name="extra"><Datatype dataalias="text"/></Field></RecordLayout></MapSchema>'
            '<RecordLayoutEvents><Event name="BeforePut"><Action name="Put"><Parameter name="row">007%d</Parameter>'
            "</Action></Event></RecordLayoutEvents></MapTarget>",
            "o_custkey", "o_custkey",
        )
        events = F.format_string(
            '<MapEvents><Event name="OnStart"><Action name="Set"><Parameter name="%s">%s</Parameter></Action>'
            '<Action name="Log"><Parameter name="key">%d</Parameter></Action></Event></MapEvents>',
            "o_orderstatus", "o_orderpriority", "o_orderkey",
        )
        return self._order_documents(
            ".map.xml",
            F.concat(
                F.lit("<Map><MapSources>"), sources, F.lit("</MapSources><MapTargets>"), target,
                F.lit("</MapTargets>"), events, F.lit("</Map>"),
            ),
        )

    def broken_tf_docs(self) -> DataFrame:
        """Finished orders end too early, partial ones have no readable text."""
        status = F.col("o_orderstatus")
        good = F.format_string('<Transformation author="%s"/>', "o_orderpriority")
        text = F.when(status == "F", F.concat(F.lit("<Outer>"), good)).when(status == "O", good)
        return self._order_documents(".tf.xml", text)

    def layout_tf_docs(self) -> DataFrame:
        """The sources of open orders stand in a wrapper; a comment and CDATA name elements that are none."""
        sources = F.format_string(
            '<TransformationSources><TransformationSource connectorname="%s"/><!-- <TransformationSource/> -->'
            "<TransformationSource><![CDATA[<TransformationTarget>]]></TransformationSource></TransformationSources>",
            "o_orderpriority",
        )
        wrapped = F.concat(F.lit("<Extra>"), sources, F.lit("</Extra>"))
        content = F.when(F.col("o_orderstatus") == "O", wrapped).otherwise(sources)
        return self._order_documents(".tf.xml", F.concat(F.lit("<Transformation>"), content, F.lit("</Transformation>")))

    def layout_map_docs(self) -> DataFrame:
        """Nested actions in a wrapper, a parameter outside of any event, or a second schema of one source."""
        nested = F.format_string(
            '<MapEvents><Event name="%s"><Wrap><Action name="outer"><Parameter name="p">%d</Parameter><Action name="inner">'
            '<Parameter name="q">&lt;%s</Parameter></Action></Action></Wrap></Event></MapEvents>',
            "o_orderpriority", "o_orderkey", "o_orderstatus",
        )
        stray = F.format_string(
            '<MapEvents><Parameter name="stray"/><Event name="e"><Action name="a"><Parameter name="p">%d</Parameter></Action></Event>'
            "<!-- <Parameter/> --></MapEvents>",
            "o_custkey",
        )
        later = F.format_string(
            '<MapSources><MapSource><MapSchema><RecordLayout><Field name="%s"/></RecordLayout></MapSchema>'
            '<MapSchema><RecordLayout><Field name="late"/><Field name="later"/></RecordLayout></MapSchema></MapSource></MapSources>',
            "o_orderpriority",
        )
        status = F.col("o_orderstatus")
        content = F.when(status == "O", nested).when(status == "F", stray).otherwise(later)
        return self._order_documents(".map.xml", F.concat(F.lit("<Map>"), content, F.lit("</Map>")))

    def text_docs(self) -> DataFrame:
        """Mapping documents that hold the whole of each text, a parameter for each line."""
        text = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        lines = F.transform(
            F.split(text, "\n"),
            lambda line, i: F.concat(F.lit('<Parameter name="'), i + 1, F.lit('">'), line, F.lit("</Parameter>")),
        )
        content = F.concat(
            F.lit('<Map><MapEvents><Event name="text"><Action name="'), "lang", F.lit('">'),
            F.array_join(lines, ""), F.lit("</Action></Event></MapEvents></Map>"),
        )
        return self._spread("documents").select(
            F.concat(F.lit("Y:\\texts\\"), "source", F.lit("\\"), "doc_id", F.lit(".map.xml")).alias("path"), content.alias("content")
        )

    def text_registry(self) -> DataFrame:
        return derive_paths(
            self.table("documents").selectExpr(
                "concat('Audit ', lang) AS audit_name",
                "CAST(doc_id AS STRING) AS map_id",
                r"concat('Y:\\texts\\', source) AS map_folder",
                "concat(doc_id, '.tf.xml') AS map_name",
                "1 AS active_bit",
                "doc_id AS doc_ord",
            )
        )

    # --- history ----------------------------------------------------------

    def event_history(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('Audit ', l_returnflag) AS audit_name",
            "CAST(l_suppkey AS STRING) AS map_id",
            "concat('f', l_orderkey) AS map_folder",
            "concat('m', l_suppkey, '.tf.xml') AS map_name",
            "CASE l_linestatus WHEN 'O' THEN 'Source' ELSE 'Target' END AS event_source",
            "concat('event ', l_linenumber) AS event_name",
            "'Map' AS action_name",
            "CASE WHEN l_tax > 0 THEN 'size' END AS parameter_name",
            "CASE WHEN l_discount > 0 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS parameter_value",
            "l_orderkey AS run_id",
            "l_partkey AS doc_ord",
            "CAST(l_linenumber AS BIGINT) AS event_ord",
        )

    def header_history(self) -> DataFrame:
        """Header rows of many runs; the newest one of a map is its state."""
        strings = "record_separator field_separator field_start_delimiter field_end_delimiter header start_offset"
        strings += " truncation_handling overflow_handling layout_mismatch"
        return self.table("lineitem").selectExpr(
            "concat('Audit ', l_returnflag) AS audit_name",
            "CAST(l_suppkey AS STRING) AS map_id",
            "concat('f', l_orderkey) AS map_folder",
            "concat('m', l_linenumber, '.tf.xml') AS map_name",
            "concat('connector ', l_linestatus) AS connector_type",
            "CAST(l_partkey AS STRING) AS code_page",
            *[f"'{name}' AS {name}" for name in strings.split()],
            "l_linestatus AS output_mode",
            "l_orderkey AS run_id",
            "l_partkey * 2 + CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS doc_ord",
        )

    # --- load logs --------------------------------------------------------

    def load_log(self) -> DataFrame:
        """Both engines' logs; the new one miscounts first lines and forgets some counts."""
        common = [
            "l_returnflag AS data_group",
            "concat('load_', l_orderkey, '_', l_linenumber, '.txt') AS file_name",
            "concat('s_', l_orderkey) AS s_file_name",
            "concat('server', l_returnflag) AS sql_server",
            "concat('db', l_linestatus) AS sql_database",
            "CAST(floor(l_extendedprice) AS BIGINT) AS file_size",
            "l_shipdate AS load_start",
        ]
        legacy = self.table("lineitem").selectExpr(
            "'legacy' AS engine",
            *common,
            r"CASE WHEN l_quantity > 1 THEN concat('Y:\\maps\\s', l_suppkey, '\\part_', l_partkey, '.map.xml') END AS map_name",
            "concat('T_', l_suppkey) AS table_name",
            "CAST(l_quantity AS BIGINT) AS records_read",
            "CAST(l_quantity AS BIGINT) AS records_written",
        )
        new = self.table("lineitem").selectExpr(
            "'new' AS engine",
            *common,
            r"concat('Y:\\pkg\\part_', l_partkey, '.dtsx') AS map_name",
            "concat('dbo.N_', l_suppkey) AS table_name",
            "CAST(l_quantity AS BIGINT) + CASE WHEN l_linenumber = 1 AND l_quantity < 3 THEN 1 ELSE 0 END AS records_read",
            "CASE WHEN l_discount > 0 OR l_quantity < 49 THEN CAST(l_quantity AS BIGINT) END AS records_written",
        )
        return legacy.unionByName(new)

    def engine_log(self, engine: str) -> DataFrame:
        return self.load_log().where(F.col("engine") == engine)

    def audit_log(self) -> DataFrame:
        """Load log of all audits, for the summary by map name."""
        return self.engine_log("legacy").withColumn("audit_name", F.concat(F.lit("Audit "), "data_group"))

    def event_log(self) -> DataFrame:
        """Loads of recent years."""
        return self.table("events").selectExpr(
            "CASE WHEN value > 1 THEN concat('user_', user_id, '.map.xml') END AS map_name",
            "concat('file ', event_id) AS file_name",
            "event_type AS sql_server",
            "props AS sql_database",
            "concat('t', user_id) AS table_name",
            "ts AS load_start",
        )

    def summary(self, with_null: bool = False) -> DataFrame:
        """Maps seen in the load log, named by their mapping documents."""
        keep = "true" if with_null else "o_totalprice >= 100000"
        return self.table("orders").where(keep).selectExpr(
            "concat('Audit ', o_orderpriority) AS audit_name",
            r"CASE WHEN o_totalprice >= 100000 THEN concat('\\\\files.example\\share\\maps\\c', o_custkey, '\\order_', o_orderkey, '.map.xml') END AS map_name",
            "o_orderkey AS run_id",
        )

    def summary_history(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('Audit ', l_returnflag) AS audit_name",
            "CASE WHEN l_tax > 0 THEN concat('part_', l_partkey, '.map.xml') END AS map_name",
            "concat('load_', l_orderkey) AS file_name",
            "concat('server', l_linestatus) AS sql_server",
            "concat('db', l_suppkey) AS database_name",
            "concat('t', l_linenumber) AS table_name",
            "l_shipdate AS last_load",
            "((l_orderkey * 1000000 + l_suppkey) * 10 + l_linenumber) * 2 + CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS run_id",
        )

    # --- packages and report tables ---------------------------------------

    def packages(self) -> DataFrame:
        """The package that loads the two tables of each supplier."""
        nations = self.table("nation").join(
            self.table("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
        )
        suppliers = self.table("supplier").withColumnRenamed("s_nationkey", "n_nationkey")
        return suppliers.join(nations, "n_nationkey").selectExpr(
            "n_name AS audit_id",
            "CAST(s_suppkey AS STRING) AS pack_id",
            "r_name AS audit_name",
            "concat('dbo.T_', s_suppkey) AS legacy_table",
            "concat('dbo.N_', s_suppkey) AS new_table",
        )

    def supplier_flags(self) -> DataFrame:
        """Flags of the packages, and of as many that load nothing."""
        suppliers = self.table("supplier").join(
            self.table("nation").withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey"
        )
        flags = [
            "CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS has_data_difference",
            "CASE WHEN s_acctbal > 8000 THEN 1 ELSE 0 END AS has_template_difference",
            "9 AS has_read_difference",
            "8 AS has_write_difference",
        ]
        loading = suppliers.selectExpr("n_name AS audit_id", "CAST(s_suppkey AS STRING) AS pack_id", *flags)
        idle = suppliers.selectExpr("n_name AS audit_id", "concat('idle ', s_suppkey) AS pack_id", *flags)
        return loading.unionByName(idle)

    def order_packages(self) -> DataFrame:
        """A package for each order, for the drill-down report."""
        return self.table("orders").selectExpr(
            "concat('A', o_custkey) AS audit_id",
            "CAST(o_orderkey AS STRING) AS pack_id",
            "concat('Audit ', o_orderpriority) AS audit_name",
            "concat('order_', o_orderkey, '.dtsx') AS new_package",
            "o_orderstatus AS phase",
            "CASE WHEN o_totalprice > 200000 THEN 'Delimited' ELSE 'Fixed' END AS connector_type",
            "concat('status ', o_orderstatus) AS package_status",
            "concat('dbo.T_', o_custkey) AS legacy_table",
            "concat('dbo.N_', o_orderkey) AS new_table",
            "'loaded' AS legacy_status",
            "CASE o_orderstatus WHEN 'F' THEN 'loaded' ELSE 'waiting' END AS new_status",
            "concat('job ', o_orderpriority) AS job_name",
            "concat('shared_', o_custkey, '.tf.xml;order_', o_orderkey, '.tf.xml') AS legacy_maps",
            r"concat('\\\\files.example\\data\\', o_orderkey) AS data_file",
        )

    def clients(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "concat(c_mktsegment, '_', c_custkey) AS audit_name",
            "CAST(c_nationkey AS STRING) AS phase",
            "concat('tracker', c_custkey) AS tracker_db",
            "concat('legacy', c_custkey) AS legacy_db",
            "concat('new', c_custkey) AS new_db",
        )

    def client_requests(self) -> DataFrame:
        """Wildcards in the arguments: `_` is any character."""
        return self.table("customer").selectExpr(
            "CAST(c_custkey AS STRING) AS request_id",
            "concat('_', c_custkey) AS audit_name",
            "CAST(c_nationkey AS STRING) AS phase",
            "'' AS map_name",
        )

    def requests(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "CAST(c_custkey AS STRING) AS request_id",
            "'Audit' AS audit_name",
            "CASE WHEN c_acctbal > 5000 THEN 'O' ELSE 'F' END AS phase",
            "concat('shared_', c_custkey, '.tf.xml') AS map_name",
        )

    def load_requests(self) -> DataFrame:
        return self.table("part").selectExpr(
            "CAST(p_partkey AS STRING) AS request_id",
            "concat('part_', p_partkey, '.tf.xml') AS map_name",
        )

    def order_flags(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "concat('A', o_custkey) AS audit_id",
            "CAST(o_orderkey AS STRING) AS pack_id",
            "CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS has_data_difference",
            "CASE o_orderpriority WHEN '2-HIGH' THEN 1 ELSE 0 END AS has_template_difference",
            "0 AS has_read_difference",
            "1 AS has_write_difference",
        )

    def line_diffs(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "CAST(l_orderkey AS STRING) AS pack_id",
            "concat('column ', l_linenumber) AS column_name",
            "concat(l_returnflag, l_linestatus) AS problem",
        )

    def variables(self) -> DataFrame:
        return self.table("events").selectExpr(
            "concat('user_', user_id, '.tf.xml') AS map_name", "event_type AS variable_name", "props AS variable_value"
        )

    def special_events(self) -> DataFrame:
        return self.table("events").selectExpr(
            "concat('Audit ', event_type) AS audit_name",
            "concat('user_', user_id, '.tf.xml') AS map_name",
            "event_id",
            "props AS parameter_value",
        )

    def changed_orders(self) -> DataFrame:
        """Orders after a migration: some changed, some lost, some doubled."""
        orders = self.table("orders")
        kept = orders.where("o_totalprice >= 5000").withColumn(
            "o_orderpriority", F.expr("CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_orderpriority END")
        )
        return kept.unionByName(orders.where("o_totalprice < 15000"))

    def changed_lines(self) -> DataFrame:
        """Line items after a migration: two of a kind changed, a few lost."""
        changed = F.expr("CASE WHEN l_linenumber = 2 AND l_quantity = 50 THEN NULL ELSE l_discount END")
        return self.table("lineitem").where("NOT (l_tax = 0 AND l_quantity = 1)").withColumn("l_discount", changed)

    def table_pairs(self) -> dict:
        """Tables before and after a migration, of many schemas."""
        customer = self.table("customer")
        moved = customer.where("c_acctbal > 0").select(
            F.lit("new").alias("origin"), "c_nationkey", F.col("c_custkey").cast("decimal(18,0)").alias("C_CUSTKEY"), "c_name"
        )
        return {
            "orders": (self.table("orders"), self.changed_orders()),
            "lines": (self.table("lineitem"), self.changed_lines()),
            "customer": (customer, moved),
            "part": (self.table("part"), self.table("part")),
            "supplier": (self.table("supplier"), None),
            "region": (None, self.table("region")),
            "nation": (self.table("nation"), self.table("region")),
        }

    def swapped_summary(self) -> DataFrame:
        """Some maps are logged by the audit that follows their own."""
        return self.table("orders").where("o_totalprice >= 100000").selectExpr(
            "concat('Audit ', CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN '3-MEDIUM'"
            " WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN '1-URGENT' ELSE o_orderpriority END) AS audit_name",
            r"CASE WHEN o_orderpriority <> '5-LOW' THEN concat('Y:\\maps\\c', o_custkey, '\\order_', o_orderkey, '.map.xml') END AS map_name",
            "o_orderkey AS run_id",
        )

    def order_log(self) -> DataFrame:
        """Load log whose maps are those of the registry; small orders are never loaded."""
        return self.table("orders").where("o_totalprice >= 120000").selectExpr(
            "concat('Audit ', o_orderpriority) AS audit_name",
            r"concat('Y:\\maps\\c', o_custkey, '\\order_', o_orderkey, '.map.xml') AS map_name",
            "concat('file ', o_orderkey) AS file_name",
            "o_orderstatus AS sql_server",
            "concat('db', o_custkey) AS sql_database",
            "concat('t', o_custkey) AS table_name",
            "o_orderdate AS load_start",
        )

    def order_variables(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "concat('shared_', o_custkey, '.tf.xml') AS map_name", "o_orderstatus AS variable_name"
        )

    def order_events(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "CASE WHEN o_orderstatus = 'O' THEN 'Audit' ELSE 'Audit x' END AS audit_name",
            "concat('shared_', o_custkey, '.tf.xml') AS map_name",
            "o_orderkey AS event_id",
        )

    def shared_log(self) -> DataFrame:
        """Log lines of the maps that the packages share."""
        return self.table("orders").selectExpr(
            "CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE 'legacy' END AS engine",
            "o_orderpriority AS data_group",
            "concat('file ', o_orderkey) AS file_name",
            r"concat('Y:\\maps\\', o_orderpriority, '\\shared_', o_custkey, '.map.xml') AS map_name",
            "concat('t', o_custkey) AS table_name",
            "o_orderstatus AS s_file_name",
            "o_custkey AS records_read",
            "o_custkey AS records_written",
            "o_orderkey AS file_size",
            "'db' AS sql_database",
        )
