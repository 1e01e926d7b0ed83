"""What plain XML documents say of their parameters, fields and filters, by one pass of a parser over each.

The rows are those of the places found by numbering tags (operators/nesting.py)
and read from fragments (operators/xmltree.py), at a small part of their time.
A document that the parser here may see otherwise (declared entities, text
behind the root, namespaces) gives null and is left to them.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable
from xml.etree import ElementTree

import pyarrow as pa

from mapledger.schemas import EVENT_COLUMNS, GLOBAL_OPTION_COLUMNS, HEADER_COLUMNS, MAP_EVENT, SOURCE_EVENT, SOURCE_OPTION_COLUMNS, TARGET_EVENT

PARAMETER_ROWS = "ARRAY<STRUCT<section: INT, event_name: STRING, action_name: STRING, parameter_name: STRING, parameter_value: STRING>>"
FIELD_ROWS = "ARRAY<STRUCT<side: INT, field_name: STRING, data_type: STRING, data_length: STRING>>"
MAP_COUNTS = "STRUCT<n_parameters: INT, n_fields: INT>"
_SIDE_ROWS = "ARRAY<STRUCT<field_name: STRING, data_type: STRING, data_length: STRING>>"
MAP_ROWS = (
    f"STRUCT<events: ARRAY<STRUCT<{', '.join(f'{name}: STRING' for name in EVENT_COLUMNS)}>>, source: {_SIDE_ROWS}, target: {_SIDE_ROWS},"
    " n_parameters: INT, n_fields: INT, sound: BOOLEAN>"
)
FILTER_ROWS = "ARRAY<STRUCT<_language: STRING, _text: STRING>>"
TF_ROWS = f"STRUCT<headers: STRUCT<{', '.join(f'{name}: STRING' for name in HEADER_COLUMNS)}>, filters: {FILTER_ROWS}, n_sources: INT, n_targets: INT>"

_PARAMETER_COLUMNS = [("section", pa.int32()), *((name, pa.string()) for name in ("event_name", "action_name", "parameter_name", "parameter_value"))]
_FIELD_COLUMNS = [("side", pa.int32()), *((name, pa.string()) for name in ("field_name", "data_type", "data_length"))]
_FILTER_COLUMNS = [("_language", pa.string()), ("_text", pa.string())]
_EVENT_COLUMNS = [(name, pa.string()) for name in EVENT_COLUMNS]
_HEADER_COLUMNS = [(name, pa.string()) for name in HEADER_COLUMNS]

# limits of Spark's parser that a text of this length, words and equals signs stays below
_LENGTH, _WORD, _EQUALS = 1 << 17, 1000, 5000
_DECLARATION = re.compile(
    rb"""<\?xml[ \t\r\n]+version=(["'])1\.0\1(?:[ \t\r\n]+encoding=(["'])(?:UTF|utf)-8\2)?(?:[ \t\r\n]+standalone=(["'])(?:yes|no)\3)?[ \t\r\n]*\?>"""
)
# characters beyond ASCII in a tag, where names may hold other ones, or beyond the first plane anywhere
_FOREIGN = re.compile(rb"<[^<>]*[\x80-\xff]|[\xf0-\xff]")


class _Unsure(Exception):
    """The two parsers may differ here."""


def _tree(data: bytes) -> ElementTree.Element:
    # a prefix that is not declared is an error of the parser
    if b"<!DOCTYPE" in data or b"xmlns" in data:
        raise _Unsure
    return ElementTree.XML(data, ElementTree.XMLParser(encoding="utf-8"))


def _alike(data: bytes) -> bool:
    """Whether a text that is well-formed to the parser here is sure to be so to Spark's."""
    return (
        len(data) < _LENGTH
        and data.startswith(b"<")
        and (not data.startswith(b"<?xml") or _DECLARATION.match(data) is not None)
        and (data.isascii() or _FOREIGN.search(data) is None)
        and data.count(b"=") < _EQUALS
        and max(map(len, data.split())) < _WORD
    )


def _apart(found: list[ElementTree.Element], name: str) -> bool:
    """Whether no element of that name stands within another of those found."""
    return len(found) < 2 or sum(1 for one in found for _ in one.iter(name)) == len(found)


def _in_order(root: ElementTree.Element, found: list[ElementTree.Element], name: str) -> list[ElementTree.Element]:
    if len(found) < 2:
        return found
    wanted = set(found)
    return [element for element in root.iter(name) if element in wanted]


def _events(root: ElementTree.Element) -> list[list[ElementTree.Element]]:
    """The events of each section; what the root itself holds as a source, a target or a list of events doesn't count."""
    sections = []
    for name in (*_ENDS, "MapEvents"):
        tops = [top for top in root.iter(name) if top is not root]
        holders = tops if name == "MapEvents" else [layout for end in tops for layout in end if layout.tag == "RecordLayoutEvents"]
        found = [event for holder in holders for event in holder if event.tag == "Event"]
        sections.append(found if _apart(tops, name) else _in_order(root, found, "Event"))
    return sections


def _parameters(root: ElementTree.Element) -> list:
    """(section, event, action, parameter) of every action around a parameter."""
    return [
        (section, event, action, parameter)
        for section, events in enumerate(_events(root))
        for event in events
        for action in event.iter("Action")
        for parameter in action.iter("Parameter")
    ]


def _parameter_rows(found: list) -> list:
    return [(section, event.get("name"), action.get("name"), one.get("name"), one.text or None) for section, event, action, one in found]


def _read_parameters(data: bytes) -> list:
    return _parameter_rows(_parameters(_tree(data)))


def _schemas(root: ElementTree.Element) -> list[list[ElementTree.Element]]:
    """The first schema of each source, and of each target."""
    sides = []
    for name in _ENDS:
        holders = [holder for holder in root.iter(f"{name}s") if holder is not root]
        ends = [end for holder in holders for end in holder if end.tag == name]
        first = (end.find("MapSchema") for end in (ends if _apart(holders, f"{name}s") else _in_order(root, ends, name)))
        sides.append([schema for schema in first if schema is not None])
    return sides


def _fields(root: ElementTree.Element) -> list:
    """(side, field) of every layout around a field."""
    return [
        (side, field)
        for side, schemas in enumerate(_schemas(root))
        for schema in schemas
        for layout in schema.iter("RecordLayout")
        for field in layout.iter("Field")
    ]


def _field_rows(found: list) -> list:
    rows = []
    for side, field in found:
        datatype = next(field.iter("Datatype"), _NO_DATATYPE)
        rows.append((side, field.get("name"), datatype.get("dataalias"), datatype.get("datalength")))
    return rows


def _read_fields(data: bytes) -> list:
    return _field_rows(_fields(_tree(data)))


def _counts(parameters: list, fields: list) -> tuple[int, int]:
    """Different parameters and fields among those found."""
    return len({found[-1] for found in parameters}), len({found[-1] for found in fields})


def _read_counts(data: bytes) -> tuple[int, int]:
    root = _tree(data)
    return _counts(_parameters(root), _fields(root))


def _read_map(data: bytes) -> tuple[list, list, list, int, int, bool]:
    """Events, fields of both sides and their numbers, of one tree."""
    root = _tree(data)
    parameters, fields = _parameters(root), _fields(root)
    events = [(_SECTIONS[section], *row) for section, *row in _parameter_rows(parameters)]
    sides = [], []
    for side, *row in _field_rows(fields):
        sides[side].append(row)
    return events, *sides, *_counts(parameters, fields), _alike(data)


# what holds a source or target, in the order of their sections and sides
_ENDS = ("MapSource", "MapTarget")
_SECTIONS = (SOURCE_EVENT, TARGET_EVENT, MAP_EVENT)
_NO_DATATYPE = ElementTree.Element("Datatype")


def _read_filters(data: bytes) -> list:
    return _filter_rows(_tree(data))


def _filter_rows(root: ElementTree.Element) -> list:
    blocks = [block for access in root.iter("DataAccess") if access is not root for block in access if block.tag == "FilterExpressions"]
    nested = len(blocks) > 1 and any(inner is not block and inner in blocks for block in blocks for inner in block.iter("FilterExpressions"))
    if nested:  # their children are listed in the order of the document
        children = {child for block in blocks for child in block}
        found = [element for element in root.iter() if element in children]
    else:
        found = [child for block in blocks for child in block]
    return [(child.get("language"), child.text or None) for child in found]


def _children(element: ElementTree.Element, name: str, blank: bool) -> list[ElementTree.Element]:
    """Children of that name; Spark's parser may see others where names differ in case only or texts stand beside them."""
    found, texts = [], [element.text]
    for child in element:
        tag, tail = child.tag, child.tail
        if tag == name:
            found.append(child)
        elif tag not in _TF_NAMES and (tag[0] == "_" or tag.lower() in _FOLDED):
            raise _Unsure
        if tail:
            texts.append(tail)
    if any(text and (not blank or text.strip(" \t\r\n")) for text in texts):
        raise _Unsure
    return found


def _attributes(element: ElementTree.Element) -> dict:
    found = element.attrib
    if not found.keys() <= _TF_ATTRIBUTES and any(key.lower() in _TF_ATTRIBUTES for key in found.keys() - _TF_ATTRIBUTES):
        raise _Unsure
    return found


def _options(holders: list[ElementTree.Element], blank: bool) -> dict:
    """Options by name; the last one of a name counts."""
    found = {}
    for holder in holders:
        for option in _children(holder, "Option", blank):
            if len(option) or option.text:
                _children(option, "", blank)
            attributes = option.attrib
            name, value = attributes.get("name"), attributes.get("value")
            if len(attributes) > (name is not None) + (value is not None):
                _attributes(option)
            found[name] = value
    return found


def _headers(root: ElementTree.Element, data: bytes) -> tuple[tuple, int, int]:
    """Header columns, and the numbers of sources and targets."""
    if not _alike(data) or b"<!--" in data or data.count(b"<?") > data.startswith(b"<?xml"):
        raise _Unsure
    blank = b"<![CDATA[" not in data and b"&#" not in data
    ends = []
    for name, child in (("TransformationSources", "TransformationSource"), ("TransformationTargets", "TransformationTarget")):
        ends.append([end for holder in _children(root, name, blank) for end in _children(holder, child, blank)])
    sources, targets = ends
    inside = [_children(source, "TransformationSourceOptions", blank) for source in sources]
    for target in targets:
        _children(target, "", blank)
    options = [_options(holders, blank) for holders in inside]
    own, common = options[-1] if options else {}, _options(_children(root, "TransformationOptions", blank), blank)
    connectors, modes = [_attributes(one).get("connectorname") for one in sources], [_attributes(one).get("outputmode") for one in targets]
    read = {name: own.get(option) for name, option in SOURCE_OPTION_COLUMNS.items()}
    read |= {name: common.get(option) for name, option in GLOBAL_OPTION_COLUMNS.items()}
    read |= {"connector_type": connectors[-1] if connectors else None, "output_mode": modes[-1] if modes else None}
    return tuple(read[name] for name in HEADER_COLUMNS), len(sources), len(targets)


def _read_tf(data: bytes) -> tuple[tuple | None, list, int | None, int | None]:
    """Headers, filters and the numbers of sources and targets, of one tree; no headers where Spark's parser might read others."""
    root = _tree(data)
    try:
        headers, sources, targets = _headers(root, data)
    except _Unsure:
        headers = sources = targets = None
    return headers, _filter_rows(root), sources, targets


# elements and attributes that headers are read from; Spark's parser may look names up without case
_TF_NAMES = {"TransformationOptions", "TransformationSources", "TransformationSource", "TransformationSourceOptions", "TransformationTargets", "TransformationTarget", "Option"}
_FOLDED = {name.lower() for name in _TF_NAMES}
_TF_ATTRIBUTES = {"connectorname", "outputmode", "name", "value"}


def _each(contents: pa.Array, read: Callable) -> list:
    found = []
    # trees have no cycles, and collections go through all the rows that are kept
    collects = gc.isenabled()
    gc.disable()
    try:
        for data in contents.cast(pa.binary()).to_pylist():
            try:
                found.append(None if data is None else read(data))
            except (ElementTree.ParseError, _Unsure):
                found.append(None)
    finally:
        if collects:
            gc.enable()
    return found


def _listed(rows: list[list], columns: list, absent: list[bool] | None = None) -> pa.ListArray:
    offsets = [0]
    for some in rows:
        offsets.append(offsets[-1] + len(some))
    flat = list(zip(*[row for some in rows for row in some], strict=True)) or [()] * len(columns)
    arrays = [pa.array(values, kind) for values, (_, kind) in zip(flat, columns, strict=True)]
    mask = None if absent is None else pa.array(absent, pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, [name for name, _ in columns]), mask=mask)


def parameter_text_places(contents: pa.Array) -> pa.Array:
    """Parameters of mapping documents in the order of their places."""
    found = _each(contents, _read_parameters)
    return _listed([one or [] for one in found], _PARAMETER_COLUMNS, [one is None for one in found])


def field_text_places(contents: pa.Array) -> pa.Array:
    """Fields of the source and target schemas of mapping documents in the order of their places."""
    found = _each(contents, _read_fields)
    return _listed([one or [] for one in found], _FIELD_COLUMNS, [one is None for one in found])


def count_text_places(contents: pa.Array) -> pa.Array:
    """How many parameters and fields of mapping documents have a place."""
    found = _each(contents, _read_counts)
    columns = [pa.array([one and one[k] for one in found], pa.int32()) for k in (0, 1)]
    return pa.StructArray.from_arrays(columns, ["n_parameters", "n_fields"], mask=pa.array([one is None for one in found], pa.bool_()))


def map_text_places(contents: pa.Array) -> pa.Array:
    """All of the three above, each mapping document parsed once; `sound` where Spark's parser need not be asked."""
    found = _each(contents, _read_map)
    lists = [_listed([one[k] if one else [] for one in found], columns) for k, columns in enumerate((_EVENT_COLUMNS, _FIELD_COLUMNS[1:], _FIELD_COLUMNS[1:]))]
    rest = [pa.array([one and one[k] for one in found], kind) for k, kind in ((3, pa.int32()), (4, pa.int32()), (5, pa.bool_()))]
    names = ["events", *("source", "target"), "n_parameters", "n_fields", "sound"]
    return pa.StructArray.from_arrays([*lists, *rest], names, mask=pa.array([one is None for one in found], pa.bool_()))


def tf_text_places(contents: pa.Array) -> pa.Array:
    """Headers, filters and counts of transformation documents, each parsed once; no headers where Spark's parser is to be asked."""
    found = _each(contents, _read_tf)
    headers = [one[0] if one else None for one in found]
    unknown = (None,) * len(_HEADER_COLUMNS)
    values = list(zip(*[row or unknown for row in headers], strict=True)) or [()] * len(unknown)
    columns = [pa.array(some, kind) for some, (_, kind) in zip(values, _HEADER_COLUMNS, strict=True)]
    known = pa.StructArray.from_arrays(columns, HEADER_COLUMNS, mask=pa.array([row is None for row in headers], pa.bool_()))
    filters = _listed([one[1] if one else [] for one in found], _FILTER_COLUMNS)
    counts = [pa.array([one and one[k] for one in found], pa.int32()) for k in (2, 3)]
    return pa.StructArray.from_arrays(
        [known, filters, *counts], ["headers", "filters", "n_sources", "n_targets"], mask=pa.array([one is None for one in found], pa.bool_())
    )


def filter_text_places(contents: pa.Array) -> pa.Array:
    """Language and text of the filters of transformation documents."""
    found = _each(contents, _read_filters)
    return _listed([one or [] for one in found], _FILTER_COLUMNS, [one is None for one in found])
