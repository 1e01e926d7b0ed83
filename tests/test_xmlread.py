"""Events and fields read in one pass of a document against those read from numbered tags."""

import random

import pyarrow as pa
import pytest

from mapledger.operators import xmlmeta, xmlread
from mapledger.operators.nesting import MAP_ROLES

EVENT = '<Event name="e &lt;"><Action name="a"><Parameter name=" p ">%s<x/>late</Parameter><Parameter/></Action></Event>'
TEXTS = ["", " ", "\r\n", " a ", "1 &lt; 2", "<![CDATA[ <b> ]]>", "<![CDATA[ ]]>", "a<!-- c -->b", "&#32;&#65;", " ", "é\U0001f600"]
ODD = [
    '<Map><x:MapEvents xmlns:x="u">%s</x:MapEvents></Map>',
    '<!DOCTYPE Map [<!ENTITY own "v">]><Map><MapEvents>%s</MapEvents></Map>',
    "<Map><MapEvents>%s</MapEvents></Map> behind",
    "<MapEvents>%s</MapEvents>",
    "<Map><MapEvents>%s</MapEvents>",
]


def test_rows_are_those_of_the_places(spark):
    bodies = [EVENT % text for text in TEXTS]
    nested = EVENT % ("x</Parameter><Action><Parameter name='q'>y</Parameter></Action><Parameter>" + bodies[3])
    ends = "<Map><MapSources><MapSource><RecordLayoutEvents>%s</RecordLayoutEvents></MapSource></MapSources><MapEvents>%s</MapEvents></Map>"
    documents = [ends % (body, other) for body, other in zip(bodies, [*bodies[1:], nested], strict=True)]
    documents += [odd % bodies[4] for odd in ODD] + [None]
    docs = spark.createDataFrame([(str(n), d) for n, d in enumerate(documents)], "path STRING, content STRING")
    read, parsed = (
        {row.path: row for row in xmlmeta.event_parameters(parse(docs)).collect()} for parse in (xmlmeta.read_map, xmlmeta.parse_map)
    )
    assert read == parsed and sum(len(row.Map) for row in read.values()) > 20
    known = xmlmeta.read_map(docs).where("map.rows IS NOT NULL AND map.tokens IS NULL").count()
    assert known >= len(TEXTS)


VALUES = ["", " ", " a ", "&lt;&amp;&#9;", "a\nb", "é", "1"]
NAMES = [*MAP_ROLES, *["MapSource", "MapSchema", "RecordLayout", "Field", "Action", "Parameter"] * 2, "x"]
INSIDE = {
    "MapSources": ["MapSource"], "MapTargets": ["MapTarget"], "MapSource": ["MapSchema", "RecordLayoutEvents"], "MapSchema": ["RecordLayout"],
    "RecordLayout": ["Field"], "Field": ["Datatype"], "RecordLayoutEvents": ["Event"], "MapEvents": ["Event"], "Event": ["Action"], "Action": ["Parameter"],
}
INSIDE["MapTarget"] = INSIDE["MapSource"]


def random_element(rng, name, depth):
    attributes = "".join(f' {a}="{rng.choice(VALUES)}"' for a in ("name", "dataalias", "datalength") if rng.random() < 0.5)
    usual = INSIDE.get(name, NAMES)
    children = [rng.choice(usual if rng.random() < 0.8 else NAMES) for _ in range(rng.randint(1, 3) if depth else 0)]
    content = "".join(rng.choice(["", "t"]) + random_element(rng, child, depth - 1) for child in children)
    return f"<{name}{attributes}>{content}</{name}>" if content else f"<{name}{attributes}/>"


@pytest.mark.parametrize("seed", [1, 2])
def test_fields_and_counts_are_those_of_the_places(spark, seed):
    """Wherever elements stand: nested sources, later schemas, several layouts, the root as a source."""
    rng = random.Random(seed)
    roots = ["Map"] * 8 + ["MapSources", "MapSource", "MapEvents"]
    documents = []
    for n in range(150):
        tops = rng.choices(["MapSources", "MapTargets", "MapEvents", "MapSource"], k=3)
        root = rng.choice(roots)
        documents.append(f"<{root}>{''.join(random_element(rng, top, 7) for top in tops)}</{root}>")
    documents += [odd % documents[0] for odd in ODD] + [None, "", "<Map"]
    docs = spark.createDataFrame([(n, d) for n, d in enumerate(documents)], "path INT, content STRING")
    fields = [xmlmeta._field_arrays(parse(docs), xmlmeta.SIDES) for parse in (xmlmeta.read_map_fields, xmlmeta.parse_map)]
    read, placed = ({row.path: (row.source, row.target) for row in found.collect()} for found in fields)
    assert read == placed and sum(len(side) for sides in read.values() for side in sides) > 300
    names = ("n_parameters", "n_fields")
    counts = [xmlmeta.read_map_counts(docs).selectExpr("path", *[f"coalesce(map.rows.{n}, map.places.{n})" for n in names])]
    counts.append(xmlmeta.parse_map(docs).selectExpr("path", *[f"map.places.{n}" for n in names]))
    malformed = {row.path for row in xmlmeta.parse_map(docs).where("map._malformed IS NOT NULL").collect()}
    read, placed = ({tuple(row) for row in found.collect() if row.path not in malformed} for found in counts)
    assert read == placed
    events = [xmlmeta.event_parameters(parse(docs)).collect() for parse in (xmlmeta.read_map, xmlmeta.parse_map)]
    assert sorted(events[0]) == sorted(events[1])
    plain = xmlmeta.read_map_fields(docs).where("map.rows IS NOT NULL AND map.tokens IS NULL").count()
    assert plain >= 150


TF = "<Transformation><TransformationSources>%s</TransformationSources></Transformation>"
FILTERS = '<DataAccess><FilterExpressions><F language="SQL">%s</F><G/></FilterExpressions></DataAccess>'
TF_SOURCES = [
    '<TransformationSource connectorname="c">' + FILTERS % " 1 &lt; 2 " + "</TransformationSource>", "", FILTERS % "<![CDATA[<TransformationSource>]]>",
    "text<TransformationSource>" + FILTERS % " " + "</TransformationSource>text", "<TransformationSource/><!-- <TransformationSource/> -->",
    '<TransformationSource connectorname="c" connectorname="d">' + FILTERS % "twice" + "</TransformationSource>",
    "<x:TransformationSource>" + FILTERS % "&#32;" + "</x:TransformationSource>", "<TransformationSource>" + FILTERS % "open",
]


def test_documents_parsed_once_give_the_same(spark, rows):
    """Rows made of `extract_tf` and `extract_map` against those made of the documents, also of odd ones."""
    sources = [TF % source for source in TF_SOURCES]
    sources += [None, "", " ", "no tag", sources[0] + " behind", '<!DOCTYPE Transformation [<!ENTITY own "v">]>' + TF % (FILTERS % "&own;")]
    fields = '<MapSources><MapSource><MapSchema><RecordLayout><Field name="f"><Datatype dataalias="d"/></Field></RecordLayout></MapSchema></MapSource></MapSources>'
    mappings = ["<Map>" + fields + "<MapEvents>" + EVENT % text + "</MapEvents></Map>" for text in TEXTS] + [odd % (EVENT % "1") for odd in ODD] + [None, "", "no tag"]
    tf_docs, map_docs = (
        spark.createDataFrame([(f"{n}.{kind}", d) for n, d in enumerate(documents)], "path STRING, content STRING")
        for kind, documents in (("tf", sources), ("map", mappings))
    )
    maps = spark.range(20).selectExpr(
        "'A' AS audit_name", "string(id) AS map_id", "'f' AS map_folder", "'m' AS map_name", "id || '.tf' AS tf_path", "id || '.map' AS map_path", "id AS doc_ord"
    )
    read = xmlmeta.extract_tf(tf_docs), xmlmeta.extract_map(map_docs)

    def results(tf, mapping):
        return {
            "headers": rows(xmlmeta.map_headers(maps, tf)), "events": rows(xmlmeta.map_events(maps, tf, mapping)),
            "fields": rows(xmlmeta.map_fields(maps, mapping)), "errors": rows(xmlmeta.document_errors(maps, tf, mapping)),
            "unread": rows(xmlmeta.unread_elements(tf, mapping).selectExpr("*")),
        }

    expected = results(tf_docs, map_docs)
    assert results(*read) == expected
    assert all(expected.values()) and any(row[4] == "SourceFilter" for row in expected["events"])


HEADER = (
    '<Transformation><TransformationOptions><Option name="truncationhandling" value="t"/></TransformationOptions><TransformationSources>'
    '<TransformationSource connectorname="old"/><TransformationSource connectorname="c"><TransformationSourceOptions>'
    '<Option name="codepage" value="a"/><Option name="codepage"/><Option value="x"/><Option name="recsep" value=" &lt;&#10; "/></TransformationSourceOptions>'
    '</TransformationSource></TransformationSources><TransformationTargets><TransformationTarget outputmode="m"/></TransformationTargets></Transformation>'
)
CHANGES = [
    ("", ""), ('"m"', "'é'"), ("<TransformationSource ", "<transformationsource "), ("connectorname=", "ConnectorName="), ("<Option ", "<option "),
    ("/></TransformationOptions>", "/> text </TransformationOptions>"), ("<TransformationSources>", "<TransformationSources>\n <!-- c --> \n"),
    ("<TransformationSources>", "\n<TransformationSources>\n"), ("<TransformationTargets>", "<TransformationTargets><![CDATA[ ]]>"), ("</TransformationTargets>", "<?p x?></TransformationTargets>"),
    ('name="codepage"', 'Name="codepage"'), ('value="a"', 'value="a" other="1"'), ("<Transformation>", '<?xml version="1.0" encoding="UTF-8"?>\n<Transformation>'),
    ("<Transformation>", '<?xml version="1.1"?><Transformation>'), ("<Transformation>", '<?xml version="1.0" encoding="ISO-8859-1"?><Transformation>'),
    ("<Transformation>", "﻿<Transformation>"), ("<Transformation>", '<Transformation a="%s">' % ("v" * 3000)), ("<Transformation>", "<Transformation><_malformed/>"),
    ("</Transformation>", "</Transformation><more/>"), ("connectorname=", "_connectorname="), ("<Transformation>", "<Transformation><%s/>" % ("n" * 1200)),
    ("<Transformation>", "<Transformation>" + '<TransformationSources/>text<TransformationTargets>t</TransformationTargets>'), ("</TransformationSource>", ""),
    ("<Transformation>", "<Transformation>" + "<d>" * 200 + "</d>" * 200), ("<Transformation>", "<Transformation><é/>"), ("<Transformation>", "<Transformation>\U0001f600"),
]


def test_headers_are_those_of_the_schema(spark):
    """Headers, problems and counts from one pass against Spark's parser alone, on odd documents; plain ones never reach that parser."""
    documents = [HEADER.replace(old, new) for old, new in CHANGES]
    documents.append(HEADER.replace("&#10;", "").replace("><", ">\r\n\t <"))
    docs = spark.createDataFrame([(str(n), d) for n, d in enumerate(documents)], "path STRING, content STRING")
    parsed = xmlmeta.parse_tf(docs)
    expected = parsed.select("path", *xmlmeta._findings("tf", xmlmeta._tf_sections()))
    extracted = xmlmeta.extract_tf(docs)
    assert sorted(extracted.select("path", "problem", "counts").collect()) == sorted(expected.collect())
    headers = {row.path: row for row in xmlmeta.header_fields(extracted).collect()}
    assert headers == {row.path: row for row in xmlmeta.header_fields(parsed).collect()}
    assert headers["0"].connector_type == "c" and headers["0"].code_page is None and headers["0"].record_separator == " <\n "
    known = xmlread.tf_text_places(pa.array(documents)).to_pylist()
    assert [n for n, one in enumerate(known) if one and one["headers"]] == [0, 11, 12, 19, len(CHANGES)]


def test_documents_joined_to_maps_once(spark, rows):
    """A document of two maps, one of none, and maps without a name of their audit."""
    tf = [("A", "1", HEADER), ("A", "2", "<Transformation><w>" + HEADER + "</w></Transformation>"), ("B", "1", "<broken"), (None, "3", "<broken"), ("A", "4", "<broken"), ("A", "2", "<broken")]
    mapping = [("A", "1m", "<Map><MapEvents>" + EVENT % "1" + "</MapEvents></Map>"), ("A", "2m", "<Map><Parameter/></Map>"), (None, "3m", "<Map/>")]
    tf_docs, map_docs = (spark.createDataFrame(some, "audit_name STRING, path STRING, content STRING") for some in (tf, mapping))
    maps = spark.createDataFrame(
        [("A", str(n), "f", "m", path, f"{path}m", n) for n, path in enumerate("1122")] + [("B", "9", "f", "m", "1", "1m", 9), (None, "8", "f", "m", "3", "3m", 8)],
        "audit_name STRING, map_id STRING, map_folder STRING, map_name STRING, tf_path STRING, map_path STRING, doc_ord BIGINT",
    )
    read = xmlmeta.extract_tf(tf_docs), xmlmeta.extract_map(map_docs)
    joined = [xmlmeta.with_maps(maps, found, path) for found, path in zip(read, ("tf_path", "map_path"), strict=True)]

    def results(tf, mapping):
        found = [xmlmeta.map_headers(maps, tf), xmlmeta.map_events(maps, tf, mapping), xmlmeta.map_fields(maps, mapping)]
        return [rows(df) for df in [*found, xmlmeta.document_errors(maps, tf, mapping), xmlmeta.unread_elements(tf, mapping)]]

    assert results(*joined) == results(*read)
    assert len(results(*joined)[3]) == 6
    plan = xmlmeta.map_headers(maps, joined[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
