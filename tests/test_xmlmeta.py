"""Hand-made documents for the cases that decide the extraction."""

import pytest
from pyspark.sql import functions as F

from mapledger.functions.text import derive_paths
from mapledger.operators import xmlmeta
from mapledger.schemas import GLOBAL_OPTION_COLUMNS, SOURCE_OPTION_COLUMNS

def tf(sources="", targets="", options=""):
    return (
        f"<Transformation><TransformationOptions>{options}</TransformationOptions>"
        f"<TransformationSources>{sources}</TransformationSources>"
        f"<TransformationTargets>{targets}</TransformationTargets></Transformation>"
    )


def source(options="", filters="", connector="c"):
    return (
        f'<TransformationSource connectorname="{connector}"><TransformationSourceOptions>{options}'
        f"</TransformationSourceOptions><DataAccess><FilterExpressions>{filters}</FilterExpressions></DataAccess>"
        "</TransformationSource>"
    )


@pytest.fixture
def headers(spark):
    def run(document):
        docs = spark.createDataFrame([("p", document)], "path STRING, content STRING")
        found = xmlmeta.header_fields(xmlmeta.parse_tf(docs)).drop("path").collect()
        return [{k: v for k, v in row.asDict().items() if v is not None} for row in found]

    return run


@pytest.fixture
def filters(spark):
    def run(document):
        docs = spark.createDataFrame([("p", document)], "path STRING, content STRING")
        found = xmlmeta.filter_expressions(docs).collect()
        return [(item["_language"], item["_text"]) for row in found for item in row.filters if item["_language"] is not None]

    return run


def test_every_header_column(headers):
    def options(columns):
        return "".join(f'<Option name="{option}" value="&quot;{column}"/>' for column, option in columns.items())

    document = tf(
        source(options(SOURCE_OPTION_COLUMNS) + '<Option name="unrelated" value="x"/>', connector="Text (Lines)"),
        '<TransformationTarget outputmode="Append"><TransformationTargetOptions><Option name="header" value="7"/>'
        "</TransformationTargetOptions></TransformationTarget>",
        options(GLOBAL_OPTION_COLUMNS),
    )
    wanted = {column: f'"{column}' for column in SOURCE_OPTION_COLUMNS | GLOBAL_OPTION_COLUMNS}
    assert headers(document) == [wanted | {"connector_type": "Text (Lines)", "output_mode": "Append"}]


def test_last_source_and_last_target_count(headers):
    document = tf(
        source('<Option name="codepage" value="A"/><Option name="recsep" value="LF"/>', connector="one")
        + source('<Option name="codepage" value="B"/><Option name="codepage"/>', connector="two"),
        '<TransformationTarget outputmode="Append"/><TransformationTarget outputmode="Replace"/>',
        '<Option name="overflowhandling" value="1"/><Option name="overflowhandling" value="3"/>',
    )
    # the repeated option without a value hides the earlier one
    assert headers(document) == [{"connector_type": "two", "output_mode": "Replace", "overflow_handling": "3"}]


def test_document_without_source_or_target(headers):
    assert headers("<Transformation/>") == [{}]
    assert headers(tf()) == [{}]


def test_option_names_are_case_sensitive_and_values_keep_spaces(headers):
    options = '<Option name="Header" value="True"/><Option name="soffset" value=" 1 "/>'
    assert headers(tf(source(options))) == [{"connector_type": "c", "start_offset": " 1 "}]


@pytest.mark.parametrize("document", ["<a><b></a>", "", "plain text", None])
def test_malformed_documents_give_no_header(headers, document):
    assert headers(document) == []


def test_option_maps(spark):
    document = tf(source('<Option name="a" value="1"/><Option name="b"/><Option name="a" value="2"/>'))
    docs = spark.createDataFrame([(document,)], "content STRING")
    parsed = xmlmeta.parse_tf(docs)
    assert parsed.select(xmlmeta.source_options()).first()[0] == {"a": "2", "b": None}
    assert parsed.select(xmlmeta.transformation_options()).first()[0] == {}


def test_filters_of_any_tag_in_document_order(filters):
    found = filters(
        tf(
            source(
                filters='<A language="x">1 &lt; 2</A><B.b language="007"> spaces </B.b><A>no language</A>'
                '<A language="empty"/><C language="c"><![CDATA[<A a>b & c]]> &amp; more</C>'
            ),
            '<TransformationTarget><DataAccess><FilterExpressions><D language="t">target</D></FilterExpressions>'
            "</DataAccess></TransformationTarget>",
        )
    )
    assert found == [("x", "1 < 2"), ("007", " spaces "), ("empty", None), ("c", "<A a>b & c & more"), ("t", "target")]


def test_filters_of_odd_names_and_depth(filters):
    odd = '<_F language="a">1</_F><DataAccess language="b">2</DataAccess><TransformationSource language="c"> </TransformationSource>'
    odd += "<FilterExpressions language='d'>4<inner/>tail</FilterExpressions><N.1-x language='e>f'>5</N.1-x>"
    block = f"<DataAccess><FilterExpressions>{odd}</FilterExpressions></DataAccess>"
    wanted = [("a", "1"), ("b", "2"), ("c", " "), ("d", "4"), ("e>f", "5")]
    assert filters(f"<Transformation><Any><Where>{block}</Where></Any></Transformation>") == wanted
    assert filters(f"<?xml version='1.0'?><!-- <DataAccess> --><!DOCTYPE T [<!ENTITY x 'y'>]><T><![CDATA[<DataAccess>]]>{block}</T>") == wanted
    # not in a data access, or the root itself
    assert filters(f"<T><FilterExpressions>{odd}</FilterExpressions></T>") == []
    assert filters(block) == []


def test_filters_absent(filters):
    assert filters(tf(source())) == []
    assert filters("<Transformation>FilterExpressions</Transformation>") == []
    assert filters("<FilterExpressions>") == []


def endpoint(fields="", events=""):
    return (
        f"<MapSchema><RecordLayout>{fields}</RecordLayout></MapSchema><RecordLayoutEvents>{events}</RecordLayoutEvents>"
    )


@pytest.fixture
def events(spark):
    def run(document):
        docs = spark.createDataFrame([("p", document)], "path STRING, content STRING")
        found = xmlmeta.event_parameters(xmlmeta.parse_map(docs)).collect()
        return [tuple(event) for row in found for section in ("Source", "Target", "Map") for event in row[section]]

    return run


def test_events_of_all_levels(events):
    one = '<Event name="{0}"><Action name="a"><Parameter name="p">{0}</Parameter></Action></Event>'
    document = (
        f"<Map><MapEvents>{one.format('m')}</MapEvents><MapTargets><MapTarget>{endpoint(events=one.format('t'))}"
        f"</MapTarget></MapTargets><MapSources><MapSource>{endpoint(events=one.format('s1'))}</MapSource>"
        f"<MapSource>{endpoint(events=one.format('s2'))}</MapSource></MapSources></Map>"
    )
    assert events(document) == [
        ("Source", "s1", "a", "p", "s1"),
        ("Source", "s2", "a", "p", "s2"),
        ("Target", "t", "a", "p", "t"),
        ("Map", "m", "a", "p", "m"),
    ]


def test_events_without_parameters_vanish(events):
    document = (
        '<Map><MapEvents><Event name="e"/><Event name="f"><Action name="a"/></Event>'
        '<Event name="g"><Action name="b"><Parameter name="p"/><Parameter name="q"> x\n </Parameter></Action>'
        "</Event></MapEvents></Map>"
    )
    assert events(document) == [("Map", "g", "b", "p", None), ("Map", "g", "b", "q", " x\n ")]


def test_events_at_any_depth(events):
    parameter = '<Wrap><Parameter name="p{0}">v{0}</Parameter></Wrap>'
    nested = f'<Actions><Action name="outer">{parameter.format(1)}<Action name="inner">{parameter.format(2)}</Action>{parameter.format(3)}</Action></Actions>'
    event = f'<Event name="e">{nested}</Event>'
    wanted = [("outer", "p1"), ("outer", "p2"), ("outer", "p3"), ("inner", "p2")]
    for block in (
        f"<MapSources><MapSource><RecordLayoutEvents>{event}</RecordLayoutEvents></MapSource></MapSources>",
        f"<MapTargets><MapTarget><RecordLayoutEvents>{event}</RecordLayoutEvents></MapTarget></MapTargets>",
        f"<MapEvents>{event}</MapEvents>",
    ):
        found = events(f"<Root><Map>{block}</Map></Root>")
        assert [(a, p) for _, _, a, p, _ in found] == wanted and {v for *_, v in found} == {"v1", "v2", "v3"}
    # an event that isn't directly in its block doesn't count, nor does a block that is the root
    assert events(f"<Map><MapEvents><Events>{event}</Events></MapEvents></Map>") == []
    assert events(f"<MapEvents>{event}</MapEvents>") == []


def test_texts_of_parameters(events):
    texts = [" ", "\n\t", "a<!-- c -->b", "<![CDATA[<x> ]]>&#233;&lt;", "x<Parameter name='q'>in</Parameter>y", "", "&#10;", "a\r\nb"]
    parameters = "".join(f"<Parameter name='{i}'>{t}</Parameter>" for i, t in enumerate(texts)) + "<Parameter name='8' />"
    found = events(f"<Map><MapEvents><Event name='&amp;e'><Action name=\"a > 'b'\">{parameters}</Action></Event></MapEvents></Map>")
    assert {(e, a) for _, e, a, _, _ in found} == {("&e", "a > 'b'")}
    values = {p: v for *_, p, v in found}
    assert [values.get(str(i)) for i in range(9)] == [" ", "\n\t", "ab", "<x> é<", "x", None, "\n", "a\nb", None] and values["q"] == "in"


def test_long_text_stays_whole(events):
    text = "word &amp; " * 30_000
    found = events(f'<Map><MapEvents><Event name="e"><Action name="a"><Parameter name="p">{text}</Parameter></Action></Event></MapEvents></Map>')
    assert found == [("Map", "e", "a", "p", text.replace("&amp;", "&"))]


def test_fields(spark, rows):
    fields = '<Field name="a"><Datatype dataalias="int" datalength="4"/></Field><Field name="b"/>'
    document = f"<Map><MapSources><MapSource>{endpoint(fields)}<MapSchema><RecordLayout><Field name='later'/></RecordLayout></MapSchema></MapSource></MapSources></Map>"
    docs = spark.createDataFrame([("p", document)], "path STRING, content STRING")
    assert rows(xmlmeta.source_fields(docs)) == [("p", 1, "a", "int", "4"), ("p", 2, "b", None, None)]
    assert rows(xmlmeta.target_fields(docs)) == []


def test_fields_at_any_depth(spark, rows):
    inner = '<Field name="c"><Props><Datatype dataalias="int" datalength="4"/><Datatype dataalias="no"/></Props></Field>'
    fields = f'<Fields><Field name="a"><Field name="b"/></Field>{inner}</Fields>'
    schema = f"<MapSchema><RecordLayouts><RecordLayout>{fields}</RecordLayout><RecordLayout><Field name='d'/></RecordLayout></RecordLayouts></MapSchema>"
    document = f"<R><Map><MapTargets><MapTarget><X/>{schema}<MapSchema><RecordLayout><Field name='no'/></RecordLayout></MapSchema></MapTarget></MapTargets></Map></R>"
    docs = spark.createDataFrame([("p", document)], "path STRING, content STRING")
    wanted = [("p", 1, "a", None, None), ("p", 2, "b", None, None), ("p", 3, "c", "int", "4"), ("p", 4, "d", None, None)]
    assert rows(xmlmeta.target_fields(docs)) == wanted
    assert rows(xmlmeta.source_fields(docs)) == []
    assert rows(xmlmeta.both_fields(docs).where("side = 'target'").drop("side")) == wanted


def test_document_errors(spark, rows):
    registry = derive_paths(
        spark.createDataFrame([("A", "1", "d", "a.tf.xml"), ("A", "2", "d", "b.tf.xml")], "audit_name STRING, map_id STRING, map_folder STRING, map_name STRING")
    )
    schema = "path STRING, content STRING"
    tf_docs = spark.createDataFrame([("d\\a.tf.xml", "<a/>"), ("d\\b.tf.xml", "<a>")], schema)
    map_docs = spark.createDataFrame([("d\\b.map.xml", None)], schema)
    assert rows(xmlmeta.document_errors(registry, tf_docs, map_docs)) == [
        ("map", "d\\a.map.xml", "missing"),
        ("map", "d\\b.map.xml", "unreadable"),
        ("tf", "d\\b.tf.xml", "malformed"),
    ]


def test_one_parser_call_for_each_document(spark):
    docs = spark.createDataFrame([("p", tf())], "path STRING, content STRING")
    plan = xmlmeta.header_fields(xmlmeta.parse_tf(docs))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1


def test_registry_join(spark, rows):
    registry = derive_paths(
        spark.createDataFrame(
            [("A", "1", "d", "a.tf.xml"), ("B", "2", "d", "a.tf.xml"), ("B", "3", "d", "b.tf.xml"), ("B", None, None, "c")],
            "audit_name STRING, map_id STRING, map_folder STRING, map_name STRING",
        )
    )
    tf_docs = spark.createDataFrame([("d\\a.tf.xml", tf(source(filters='<F language="l">x</F>')))], "path STRING, content STRING")
    headers = xmlmeta.map_headers(registry, tf_docs)
    assert rows(headers.select("audit_name", "map_id", "connector_type")) == [("A", "1", "c"), ("B", "2", "c")]
    events = xmlmeta.filter_events(registry, tf_docs)
    assert rows(events.select("map_id", "parameter_name", "parameter_value")) == [("1", "l", "x"), ("2", "l", "x")]
    # nothing is counted while the query is built, or gathered in one partition
    assert "SinglePartition" not in headers._jdf.queryExecution().executedPlan().toString()
