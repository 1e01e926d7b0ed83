"""Elements located by numbering, against a tree that is walked, and what is left unread."""

import random
import xml.etree.ElementTree as ET

import pytest

from mapledger.operators import nesting, xmlmeta

NAMES = [*nesting.MAP_ROLES, "Other"]


def walked(document):
    """Paths of names for each parameter's (section, event, action) and each field's (side, layout), by walking the tree."""
    root, events, fields = ET.fromstring(document), [], []

    def walk(node, path):
        here = [*path, node]
        tags = [n.tag for n in here]
        if node.tag == "Parameter":
            for i, event in enumerate(here):
                for k, around in enumerate((["MapSource", "RecordLayoutEvents"], ["MapTarget", "RecordLayoutEvents"], ["MapEvents"])):
                    if event.tag == "Event" and i > len(around) and tags[i - len(around) : i] == around:
                        events.extend((k, event.get("name"), a.get("name"), node.get("name")) for a in here[i + 1 : -1] if a.tag == "Action")
        if node.tag == "Field":
            for i, source in enumerate(here[:-1]):
                for k, (parent, child) in enumerate((("MapSources", "MapSource"), ("MapTargets", "MapTarget"))):
                    schema = here[i + 1]
                    if i > 1 and source.tag == child and tags[i - 1] == parent and source.find("MapSchema") is schema:
                        kind = node.find(".//Datatype")
                        fields.extend((k, l.get("name"), node.get("name"), None if kind is None else kind.get("name")) for l in here[i + 2 : -1] if l.tag == "RecordLayout")
        for child in node:
            walk(child, here)

    walk(root, [])
    return sorted(events, key=repr), sorted(fields, key=repr)


def made(rng, depth, counter, names):
    counter[0] += 1
    name, number = rng.choice(names), counter[0]
    inside = "".join(made(rng, depth - 1, counter, names) for _ in range(rng.randint(0, 3))) if depth else ""
    return f'<{name} name="{number}"/>' if not inside and rng.random() < 0.5 else f'<{name} name="{number}">{inside}</{name}>'


@pytest.mark.parametrize("seed", range(4))
def test_places_against_a_walked_tree(spark, seed):
    rng = random.Random(seed)
    likely = [
        ["MapEvents", "Event", "Action", "Parameter", "Parameter", "Other"], ["MapSource", "RecordLayoutEvents", "Event", "Action", "Parameter"],
        ["MapSources", "MapSource", "MapSchema", "RecordLayout", "Field", "Datatype"], NAMES,
    ][seed]
    documents = {f"p{n}": f"<Map>{''.join(made(rng, 7, [0], likely) for _ in range(3))}</Map>" for n in range(60)}
    rows = xmlmeta.parse_map(spark.createDataFrame(list(documents.items()), "path STRING, content STRING")).select("path", "map").collect()
    some = 0
    for row in rows:
        name = lambda at: None if at is None else ET.fromstring(f"{row.map.tokens[at].split('>')[0].rstrip('/')}/>").get("name")
        events = sorted(((p.section, name(p.event), name(p.action), name(p.parameter)) for p in row.map.places.parameters), key=repr)
        fields = sorted(((p.side, name(p.layout), name(p.field), name(p.datatype)) for p in row.map.places.fields), key=repr)
        assert (events, fields) == walked(documents[row.path])
        some += len(events) + len(fields)
    assert some


@pytest.mark.parametrize("document", ["<a/>", "<Field/>", "<MapEvents><Event><Action><Parameter/></Action></Event></MapEvents>"])
def test_documents_with_little_in_them(spark, document):
    docs = spark.createDataFrame([("p", document), ("q", None), ("r", "<a>"), ("s", "<a/>")], "path STRING, content STRING")
    assert xmlmeta.event_parameters(xmlmeta.parse_map(docs)).where("size(Map) + size(Source) + size(Target) > 0").isEmpty()
    assert xmlmeta.both_fields(docs).isEmpty()


def test_ampersands_in_texts(spark):
    document = (
        "<m><MapEvents><Event name='e&amp;x;'><Action name='a&#65;'><Parameter name='p'>1 &amp;x; &lt; <![CDATA[&x; & z]]></Parameter>"
        "<Parameter name='q'>2</Parameter></Action></Event></MapEvents></m>"
    )
    docs = spark.createDataFrame([("p", document)], "path STRING, content STRING")
    found = xmlmeta.event_parameters(xmlmeta.parse_map(docs)).first().Map
    assert [tuple(e)[1:] for e in found] == [("e&x;", "aA", "p", "1 &x; < &x; & z"), ("e&x;", "aA", "q", "2")]


def test_wide_documents(spark):
    wide = "".join(f'<Parameter name="p{n}">{n}</Parameter>' for n in range(20_000))
    docs = spark.createDataFrame([("p", f'<m><MapEvents><Event name="e"><Action name="a">{wide}</Action></Event></MapEvents></m>')], "path STRING, content STRING")
    found = xmlmeta.event_parameters(xmlmeta.parse_map(docs)).first().Map
    assert [e.parameter_value for e in found] == [str(n) for n in range(20_000)]
    assert xmlmeta.unread_elements(docs.limit(0), docs).isEmpty()
