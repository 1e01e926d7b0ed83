"""Header, event and field rows from parsed XML documents.

Documents are parsed where they are read; what travels to the registry join
is one narrow row per document. Repeated blocks unfold after the join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.operators import nesting, xmlread, xmltree
from mapledger.operators.history import ord_column
from mapledger.schemas import (
    EVENT_COLUMNS,
    EVENT_ELEMENTS,
    FIELD_ELEMENTS,
    FILTER_ELEMENT,
    FILTER_EVENT,
    GLOBAL_OPTION_COLUMNS,
    HEADER_COLUMNS,
    MAP_EVENT,
    MAP_IDENTITY,
    SOURCE_EVENT,
    SOURCE_OPTION_COLUMNS,
    TARGET_EVENT,
    TF_DOCUMENT,
    WELL_FORMED,
    XML_OPTIONS,
)

_EVENT = "STRUCT<event_source: STRING, event_name: STRING, action_name: STRING, parameter_name: STRING, parameter_value: STRING>"
# filter rows come before the rows of the map document of the same map
_MAP_DOCUMENT_ORD = 1 << 32


# --- parsing --------------------------------------------------------------


def parse_tf(docs: DataFrame) -> DataFrame:
    """Add `tf`, the parsed transformation document."""
    return docs.select("*", _parsed_once(F.from_xml("content", TF_DOCUMENT, XML_OPTIONS)).alias("tf"))


def parse_map(docs: DataFrame) -> DataFrame:
    """Add `map`: what is malformed, the tags of the mapping document, and the places of its parameters and fields."""
    return _with_places(docs, "map", nesting.MAP_ROLES, nesting.map_places, nesting.MAP_PLACES)


def read_map(docs: DataFrame) -> DataFrame:
    """As `parse_map`, with `map.rows`, the parameters read in one pass of each plain document; tags and places of the others only."""
    return _read_map(docs, xmlread.parameter_text_places, xmlread.PARAMETER_ROWS)


def read_map_fields(docs: DataFrame) -> DataFrame:
    """As `read_map`, with the fields as `map.rows`."""
    return _read_map(docs, xmlread.field_text_places, xmlread.FIELD_ROWS)


def read_map_counts(docs: DataFrame) -> DataFrame:
    """As `read_map`, with the numbers of parameters and fields as `map.rows`."""
    return _read_map(docs, xmlread.count_text_places, xmlread.MAP_COUNTS)


def _read_map(docs: DataFrame, read: Callable, rows: str) -> DataFrame:
    return _with_places(docs, "map", nesting.MAP_ROLES, nesting.map_places, nesting.MAP_PLACES, F.arrow_udf(read, rows))


def _sound() -> Column:
    """As the parser would answer for a well-formed document."""
    return F.struct(F.lit(None).cast("string").alias("_none"), F.lit(None).cast("string").alias("_malformed"))


def _with_places(
    docs: DataFrame, name: str, roles: list[str], locate: Callable, places: str, read: Callable | None = None
) -> DataFrame:
    if read is not None:
        rows = docs.select("*", read("content").alias("_rows"))
        checked = F.from_xml("content", WELL_FORMED, XML_OPTIONS)
        if "sound" in getattr(rows.schema["_rows"].dataType, "names", ()):
            checked = F.when(F.col("_rows.sound"), _sound()).otherwise(checked)
        return _with_rows(rows, docs.columns, name, roles, locate, places, checked)
    checked = F.from_xml("content", WELL_FORMED, XML_OPTIONS)
    cut = docs.select("*", _parsed_once(F.struct(checked.alias("checked"), xmltree.tokens("content").alias("tokens"))).alias("_cut"))
    cut = cut.withColumns({"_tokens": F.col("_cut.tokens"), "_checked": F.col("_cut.checked")})
    sound = F.col("_checked").isNotNull() & F.col("_checked._malformed").isNull()
    marks = _parsed_once(F.when(sound, xmltree.marks("_tokens", roles)).otherwise(F.array().cast("array<int>")))
    cut = cut.select(*docs.columns, "_tokens", "_checked", marks.alias("_marks"))
    located = F.arrow_udf(locate, places)
    parsed = F.struct(F.col("_checked._malformed").alias("_malformed"), F.col("_tokens").alias("tokens"), located("_marks").alias("places"))
    return cut.select(*docs.columns, F.when(F.col("_checked").isNotNull(), parsed).alias(name))


def _with_rows(
    found: DataFrame, kept: list[str], name: str, roles: list[str], locate: Callable, places: str, checked: Column
) -> DataFrame:
    found = found.select("*", _parsed_once(checked).alias("_checked"))
    sound = F.col("_checked").isNotNull() & F.col("_checked._malformed").isNull()
    open_ones = sound & F.col("_rows").isNull()
    cut = found.select("*", _parsed_once(F.when(open_ones, xmltree.tokens("content"))).alias("_tokens"))
    marks = _parsed_once(F.when(F.col("_tokens").isNotNull(), xmltree.marks("_tokens", roles)).otherwise(F.array().cast("array<int>")))
    cut = cut.select(*kept, "_checked", "_rows", "_tokens", marks.alias("_marks"))
    parsed = F.struct(
        F.col("_checked._malformed").alias("_malformed"), F.col("_rows").alias("rows"), F.col("_tokens").alias("tokens"),
        F.arrow_udf(locate, places)("_marks").alias("places"),
    )
    return cut.select(*kept, F.when(F.col("_checked").isNotNull(), parsed).alias(name))


def extract_tf(docs: DataFrame) -> DataFrame:
    """All that is taken from transformation documents, each parsed once: `problem`, `counts`, `headers` and `filters`.

    The operators below take such rows in place of documents.
    """
    read = docs.select("*", F.arrow_udf(xmlread.tf_text_places, xmlread.TF_ROWS)("content").alias("_read"))
    known = F.col("_read.headers").isNotNull()
    # Spark's parser takes the documents that the other one has no headers of
    rest = read.withColumnsRenamed({"content": "_text"}).withColumn("content", F.when(~known | F.col("_read").isNull(), F.col("_text")))
    wide = _wide_headers(parse_tf(rest))
    headers = F.coalesce("_read.headers", F.when(well_formed("tf"), F.struct(*HEADER_COLUMNS))).alias("headers")
    sections = {element: F.coalesce(f"_read.{number}", size) for number, (element, size) in zip(("n_sources", "n_targets"), _tf_sections().items(), strict=True)}
    # what the schema of the headers can read to its end is well-formed; the rest is read again for its filters
    wanted = F.when(F.contains("content", F.lit("FilterExpressions")), F.col("content")).alias("content")
    kept = wide.select(*_document_key(docs), *_findings("tf", sections, "_text"), headers, wanted, F.col("_read.filters").alias("_rows"))
    checked = F.when(F.col("headers").isNotNull(), _sound()).when(F.col("content").isNotNull(), F.from_xml("content", WELL_FORMED, XML_OPTIONS))
    columns = [*_document_key(docs), "problem", "counts", "headers"]
    found = _with_rows(kept, columns, "tf", nesting.TF_ROLES, nesting.filter_places, nesting.TF_PLACES, checked)
    return found.select(*columns, F.when(well_formed("tf"), _filters("tf")).alias("filters"))


def extract_map(docs: DataFrame) -> DataFrame:
    """All that is taken from mapping documents, each parsed once: `problem`, `counts`, `events` and `fields` of both sides.

    The operators below take such rows in place of documents.
    """
    parsed = _read_map(docs, xmlread.map_text_places, xmlread.MAP_ROWS)
    events = F.coalesce("map.rows.events", _parameters(F.col("map.places.parameters")))
    fields = F.struct(*[F.coalesce(f"map.rows.{side}", _placed_fields(side)).alias(side) for side in SIDES])
    return parsed.select(
        *_document_key(docs), *_findings("map", _map_elements()),
        F.when(well_formed("map"), events).alias("events"), F.when(well_formed("map"), fields).alias("fields"),
    )


def _has_rows(parsed: DataFrame, name: str) -> bool:
    return "rows" in parsed.schema[name].dataType.fieldNames()


def _parsed_once(parsed: Column, wanted: Column | None = None) -> Column:
    """One row for each document, or none where it is not wanted.

    As the output of a generator the document is parsed once. A filter on a
    plain column would move below it and repeat the parser call.
    """
    document = F.array(parsed)
    return F.explode(document if wanted is None else F.when(wanted, document))


def well_formed(parsed: str) -> Column:
    return F.col(parsed).isNotNull() & F.col(f"{parsed}._malformed").isNull()


def _all(items: Column, child: str) -> Column:
    """The children of that name over all items, in document order."""
    lists = F.transform(items, lambda item: item[child])
    return F.flatten(F.filter(lists, lambda found: found.isNotNull()))


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


# --- transformation document ---------------------------------------------


def _sources(tf: str) -> Column:
    return _all(F.col(f"{tf}.TransformationSources"), "TransformationSource")


def _targets(tf: str) -> Column:
    return _all(F.col(f"{tf}.TransformationTargets"), "TransformationTarget")


def source_connector(tf: str = "tf") -> Column:
    """Connector of the last source."""
    return _last(_sources(tf))["_connectorname"]


def target_output_mode(tf: str = "tf") -> Column:
    """Output mode of the last target."""
    return _last(_targets(tf))["_outputmode"]


def _source_option_list(tf: str) -> Column:
    return _all(_last(_sources(tf))["TransformationSourceOptions"], "Option")


def _global_option_list(tf: str) -> Column:
    return _all(F.col(f"{tf}.TransformationOptions"), "Option")


def _as_map(options: Column) -> Column:
    named = F.filter(options, lambda o: o["_name"].isNotNull())
    names = F.array_distinct(F.transform(named, lambda o: o["_name"]))
    return F.map_from_arrays(names, F.transform(names, lambda name: _option(named, name)))


def _option(options: Column, name: Column) -> Column:
    return _last(F.filter(options, lambda o: o["_name"] == name))["_value"]


def source_options(tf: str = "tf") -> Column:
    """Options of the last source by name; a repeated name keeps its last value."""
    return _as_map(_source_option_list(tf))


def transformation_options(tf: str = "tf") -> Column:
    """Options of the whole transformation by name."""
    return _as_map(_global_option_list(tf))


def pivot_options(docs: DataFrame, tf: str = "tf") -> DataFrame:
    """One column for each reported option, NULL where it is absent."""
    listed = docs.withColumns({"_source": _source_option_list(tf), "_global": _global_option_list(tf)})
    columns = {name: _option(F.col("_source"), F.lit(o)) for name, o in SOURCE_OPTION_COLUMNS.items()}
    columns |= {name: _option(F.col("_global"), F.lit(o)) for name, o in GLOBAL_OPTION_COLUMNS.items()}
    return listed.withColumns(columns).drop("_source", "_global")


def header_fields(parsed: DataFrame) -> DataFrame:
    """The twelve header columns of every well-formed transformation document."""
    if "headers" in parsed.columns:
        return parsed.where(F.col("headers").isNotNull()).select(*_document_key(parsed), "headers.*")
    return _wide_headers(parsed.where(well_formed("tf"))).select(*_document_key(parsed), *HEADER_COLUMNS)


def _wide_headers(parsed: DataFrame) -> DataFrame:
    return pivot_options(parsed.withColumns({"connector_type": source_connector(), "output_mode": target_output_mode()}))


def map_headers(registry: DataFrame, tf_docs: DataFrame, run_id: int = 0) -> DataFrame:
    """One header row for each map with a readable transformation document."""
    parsed = tf_docs if "headers" in tf_docs.columns else parse_tf(tf_docs)
    return attach_headers(registry, header_fields(parsed), run_id)


def attach_headers(registry: DataFrame, headers: DataFrame, run_id: int) -> DataFrame:
    joined = _with_documents(registry, headers, "tf_path")
    return joined.select(*MAP_IDENTITY, *HEADER_COLUMNS, *_run_columns(run_id))


# --- source filters -------------------------------------------------------


def filter_expressions(docs: DataFrame) -> DataFrame:
    """Filter elements of every document that has any: `filters`, an array of (language, text) in document order.

    A filter is any child of the filter block of a data access, of a source or a target.
    """
    if "filters" in docs.columns:
        return docs.where(F.size("filters") > 0).select(*_document_key(docs), "filters")
    some = docs.where(F.contains("content", F.lit("FilterExpressions")))
    parsed = _with_places(some.select(*_document_key(docs), "content"), "tf", nesting.TF_ROLES, nesting.filter_places, nesting.TF_PLACES, _read_filters())
    some = parsed.where(well_formed("tf")).select(*_document_key(docs), _filters("tf").alias("filters"))
    return some.where(F.size("filters") > 0)


def _read_filters() -> Callable:
    return F.arrow_udf(xmlread.filter_text_places, xmlread.FILTER_ROWS)


def _filters(tf: str) -> Column:
    numbers, tokens = F.col(f"{tf}.places"), F.col(f"{tf}.tokens")
    fragments = F.transform(numbers, lambda at: xmltree.fragment(xmltree.with_text(F.get(tokens, at), "F")))
    blanks = F.transform(numbers, lambda at: xmltree.blank_text(F.get(tokens, at)))
    read = F.arrays_zip(xmltree.read(fragments, FILTER_ELEMENT).alias("read"), blanks.alias("blank"))
    items = F.transform(
        read, lambda r: F.struct(r["read"]["F"]["_language"].alias("_language"), F.coalesce(r["read"]["F"]["_text"], r["blank"]).alias("_text"))
    )
    return F.coalesce(f"{tf}.rows", items)


def filter_events(registry: DataFrame, tf_docs: DataFrame, run_id: int = 0) -> DataFrame:
    """One event row for each filter that states its language."""
    return attach_filters(registry, filter_expressions(tf_docs), run_id)


def attach_filters(registry: DataFrame, filters: DataFrame, run_id: int) -> DataFrame:
    joined = _with_documents(registry, filters, "tf_path")
    stated = F.filter("filters", lambda item: item["_language"].isNotNull())
    rows = joined.select(*MAP_IDENTITY, *_run_columns(run_id), F.posexplode(stated).alias("pos", "item"))
    source, event, action = (F.lit(name) for name in FILTER_EVENT)
    return rows.select(
        *MAP_IDENTITY,
        source.alias("event_source"),
        event.alias("event_name"),
        action.alias("action_name"),
        F.col("item._language").alias("parameter_name"),
        F.col("item._text").alias("parameter_value"),
        "run_id",
        "doc_ord",
        F.col("pos").cast("bigint").alias("event_ord"),
    )


# --- mapping document -----------------------------------------------------


# the sections an event may stand in, by their numbers in the places
_SECTIONS = (SOURCE_EVENT, TARGET_EVENT, MAP_EVENT)


def _parameters(places: Column) -> Column:
    """Parameters of all actions of all events; an event or action without any adds nothing."""

    def fragment(place: Column) -> Column:
        event, action, parameter = (F.get("map.tokens", place[kind]) for kind in ("event", "action", "parameter"))
        return xmltree.fragment(xmltree.alone(event, "Event"), xmltree.alone(action, "Action"), xmltree.with_text(parameter, "Parameter"))

    beside = F.transform(
        places, lambda place: F.struct(place["section"].alias("section"), xmltree.blank_text(F.get("map.tokens", place["parameter"])).alias("blank"))
    )
    read = xmltree.read(F.transform(places, fragment), EVENT_ELEMENTS)
    names = F.array(*[F.lit(name) for name in _SECTIONS])
    return F.transform(
        F.arrays_zip(read.alias("read"), beside.alias("beside")),
        lambda r: F.struct(
            F.get(names, r["beside"]["section"]).alias("event_source"),
            r["read"]["Event"]["_name"].alias("event_name"),
            r["read"]["Action"]["_name"].alias("action_name"),
            r["read"]["Parameter"]["_name"].alias("parameter_name"),
            F.coalesce(r["read"]["Parameter"]["_text"], r["beside"]["blank"]).alias("parameter_value"),
        ),
    )


def event_parameters(parsed: DataFrame, sections: tuple[str, ...] = _SECTIONS) -> DataFrame:
    """A column of event rows for each section of every mapping document, in one pass; by event, then by action.

    Actions and parameters may stand at any depth; a parameter within nested
    actions is listed for each of them.
    """
    rows = [_of_section(section).alias(section) for section in sections]
    if "events" in parsed.columns:
        read = parsed.where(F.col("events").isNotNull()).withColumnRenamed("events", "_events")
        return read.select(*_document_key(parsed), *rows)
    wanted = [_SECTIONS.index(section) for section in sections]
    places = F.filter("map.places.parameters", lambda place: place["section"].isin(wanted))
    events = _parameters(places)
    if _has_rows(parsed, "map"):
        events = F.coalesce(_named_sections("map.rows"), events)
    read = parsed.where(well_formed("map")).select(*_document_key(parsed), _parsed_once(events).alias("_events"))
    return read.select(*_document_key(parsed), *rows)


def _named_sections(rows: Column | str) -> Column:
    names = F.array(*[F.lit(name) for name in _SECTIONS])
    return F.transform(rows, lambda r: F.struct(F.get(names, r["section"]).alias("event_source"), *[r[name].alias(name) for name in EVENT_COLUMNS[1:]]))


def _of_section(section: str) -> Column:
    return F.filter("_events", lambda e: e["event_source"] == section)


def document_events(
    registry: DataFrame, map_docs: DataFrame, sections: tuple[str, ...] = _SECTIONS, run_id: int = 0
) -> DataFrame:
    if "events" in map_docs.columns and sections == _SECTIONS:  # they stand in this order
        read = map_docs.where(F.col("events").isNotNull()).select(*_document_key(map_docs), "events")
        return _attach(registry, read, F.col("events"), run_id)
    parsed = map_docs if "events" in map_docs.columns else read_map(map_docs)
    return attach_events(registry, event_parameters(parsed, sections), run_id)


def attach_events(registry: DataFrame, events: DataFrame, run_id: int) -> DataFrame:
    return _attach(registry, events, F.concat(*[section for section in _SECTIONS if section in events.columns]), run_id)


def _attach(registry: DataFrame, events: DataFrame, in_order: Column, run_id: int) -> DataFrame:
    joined = _with_documents(registry, events, "map_path")
    rows = joined.select(*MAP_IDENTITY, *_run_columns(run_id), F.posexplode(in_order).alias("pos", "item"))
    return rows.select(
        *MAP_IDENTITY,
        *[F.col(f"item.{name}").alias(name) for name in EVENT_COLUMNS],
        "run_id",
        "doc_ord",
        (F.col("pos") + F.lit(_MAP_DOCUMENT_ORD)).alias("event_ord"),
    )


def source_events(registry: DataFrame, map_docs: DataFrame, run_id: int = 0) -> DataFrame:
    """Parameters of the source record events."""
    return document_events(registry, map_docs, (SOURCE_EVENT,), run_id)


def target_events(registry: DataFrame, map_docs: DataFrame, run_id: int = 0) -> DataFrame:
    """Parameters of the target record events."""
    return document_events(registry, map_docs, (TARGET_EVENT,), run_id)


def map_level_events(registry: DataFrame, map_docs: DataFrame, run_id: int = 0) -> DataFrame:
    """X11: parameters of the events of the map itself."""
    return document_events(registry, map_docs, (MAP_EVENT,), run_id)


def map_events(registry: DataFrame, tf_docs: DataFrame, map_docs: DataFrame, run_id: int = 0) -> DataFrame:
    """Filters, then source, target and map events, each document read once."""
    return filter_events(registry, tf_docs, run_id).unionByName(document_events(registry, map_docs, run_id=run_id))


def _field_arrays(parsed: DataFrame, sides: tuple[str, ...]) -> DataFrame:
    """A column of field structs for each side of every mapping document, in one pass."""
    if "fields" in parsed.columns:
        return parsed.where(F.col("fields").isNotNull()).select(*_document_key(parsed), *[F.col(f"fields.{side}") for side in sides])

    def rows(side: str) -> Column:
        fields = _placed_fields(side)
        return F.coalesce(_named_fields("map.rows", side), fields) if _has_rows(parsed, "map") else fields

    return parsed.where(well_formed("map")).select(*_document_key(parsed), *[rows(side).alias(side) for side in sides])


def _with_fields(docs: DataFrame) -> DataFrame:
    return docs if "fields" in docs.columns else read_map_fields(docs)


def _named_fields(rows: Column | str, side: str) -> Column:
    own = F.filter(rows, lambda r: r["side"] == SIDES.index(side))
    return F.transform(own, lambda r: F.struct(*[r[name].alias(name) for name in ("field_name", "data_type", "data_length")]))


def _placed_fields(side: str) -> Column:

    def fragment(place: Column) -> Column:
        field, datatype = F.get("map.tokens", place["field"]), F.get("map.tokens", place["datatype"])
        return xmltree.fragment(xmltree.alone(field, "Field"), F.coalesce(xmltree.alone(datatype, "Datatype"), F.lit("")))

    places = F.filter("map.places.fields", lambda place: place["side"] == SIDES.index(side))
    return F.transform(xmltree.read(F.transform(places, fragment), FIELD_ELEMENTS), lambda r: F.struct(
        r["Field"]["_name"].alias("field_name"), r["Datatype"]["_dataalias"].alias("data_type"), r["Datatype"]["_datalength"].alias("data_length")
    ))


SIDES = ("source", "target")


def both_fields(docs: DataFrame) -> DataFrame:
    """X13 and X14 at once, each document parsed once: the fields with their `side`, source or target."""
    arrays = _field_arrays(_with_fields(docs), SIDES)
    tagged = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("fields")) for side in SIDES])
    sides = arrays.select(*_document_key(docs), F.explode(tagged).alias("one")).select(*_document_key(docs), "one.*")
    return sides.select(*_document_key(docs), "side", F.posexplode("fields")).select(
        *_document_key(docs), "side", (F.col("pos") + 1).cast("bigint").alias("ordinal"), "col.*"
    )


def map_fields(registry: DataFrame, map_docs: DataFrame, run_id: int = 0) -> DataFrame:
    """X13 and X14 with the maps the documents belong to."""
    arrays = _field_arrays(_with_fields(map_docs), SIDES)
    tagged = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("fields")) for side in SIDES])
    joined = _with_documents(registry, arrays.select(*_document_key(map_docs), tagged.alias("sides")), "map_path")
    sides = joined.select(*MAP_IDENTITY, F.explode("sides").alias("one")).select(*MAP_IDENTITY, "one.*")
    rows = sides.select(*MAP_IDENTITY, "side", F.posexplode("fields"))
    return rows.select(
        *MAP_IDENTITY, "side", "col.*", (F.col("pos") + 1).cast("bigint").alias("ordinal"), F.lit(run_id).cast("bigint").alias("run_id")
    )


def _fields(docs: DataFrame, side: str) -> DataFrame:
    arrays = _field_arrays(_with_fields(docs), (side,))
    rows = arrays.select(*_document_key(docs), F.posexplode(side))
    return rows.select(*_document_key(docs), (F.col("pos") + 1).cast("bigint").alias("ordinal"), "col.*")


def source_fields(map_docs: DataFrame) -> DataFrame:
    """Fields of the source schemas; a field without a data type has NULL there."""
    return _fields(map_docs, "source")


def target_fields(map_docs: DataFrame) -> DataFrame:
    """Fields of the target schemas."""
    return _fields(map_docs, "target")


# --- quarantine -----------------------------------------------------------


def unread_elements(tf_docs: DataFrame, map_docs: DataFrame) -> DataFrame:
    """What well-formed documents hold and the extraction leaves out: `in_text` elements of a name, and those `read`.

    Two independent counts for each document: opened tags in the text, and
    the elements that the rows were made of. They differ where a section
    stands elsewhere than expected, say in a wrapper.
    """
    sound = _parsed_documents(tf_docs, map_docs).where("problem IS NULL").where(F.exists("counts", _differs))
    return _once(sound).select("kind", "path", F.inline("counts")).where("in_text <> read")


def _differs(count: Column) -> Column:
    return count["in_text"] != count["read"]


def _once(found: DataFrame) -> DataFrame:
    """Each document once, also where it was joined to several maps."""
    several = found.where(F.col("document").isNotNull()).dropDuplicates(["kind", "document"])
    return found.where(F.col("document").isNull()).unionByName(several)


def _parsed_documents(tf_docs: DataFrame, map_docs: DataFrame) -> DataFrame:
    """(kind, path, problem, counts, document) of every document, each parsed once; `document` numbers those that may come with several maps."""

    def checked(kind: str, docs: DataFrame, parse: Callable, read: dict[str, Column]) -> DataFrame:
        found = docs if "counts" in docs.columns else parse(docs).select("path", *_findings(kind, read))
        number = F.col("document") if "document" in found.columns else F.lit(None).cast("bigint").alias("document")
        return found.select(F.lit(kind).alias("kind"), "path", "problem", "counts", number)

    tf = checked("tf", tf_docs, parse_tf, _tf_sections())
    return tf.unionByName(checked("map", map_docs, read_map_counts, _map_elements()))


def _findings(kind: str, read: dict[str, Column], content: str = "content") -> list[Column]:
    """`problem` and `counts` of a parsed document."""
    found = [
        F.struct(
            F.lit(name).alias("element"), xmltree.count_tags(content, name).alias("in_text"),
            F.coalesce(column, F.lit(0)).cast("bigint").alias("read"),
        )
        for name, column in read.items()
    ]
    problem = F.when(F.col(content).isNull(), "unreadable").when(F.col(f"{kind}._malformed").isNotNull(), "malformed")
    return [problem.alias("problem"), F.array(*found).alias("counts")]


def _tf_sections() -> dict[str, Column]:
    return {"TransformationSource": F.size(_sources("tf")), "TransformationTarget": F.size(_targets("tf"))}


def _map_elements() -> dict[str, Column]:
    return {
        element: F.coalesce(f"map.rows.{number}", f"map.places.{number}") for element, number in (("Parameter", "n_parameters"), ("Field", "n_fields"))
    }


def document_errors(registry: DataFrame, tf_docs: DataFrame, map_docs: DataFrame) -> DataFrame:
    """Documents that cannot be read or parsed, or not as a whole (`layout`), and maps without the sibling document."""
    layout = F.when(F.exists("counts", _differs), "layout")
    bad = _parsed_documents(tf_docs, map_docs).select("kind", "path", F.coalesce("problem", layout).alias("problem"), "document")
    bad = _once(bad.where(F.col("problem").isNotNull())).drop("document")
    siblings = registry.join(tf_docs.select(F.col("path").alias("tf_path")), "tf_path", "left_semi")
    absent = siblings.join(map_docs.select(F.col("path").alias("map_path")), "map_path", "left_anti")
    absent = absent.select(F.lit("map").alias("kind"), F.col("map_path").alias("path"), F.lit("missing").alias("problem"))
    return bad.unionByName(absent.distinct())


# --- registry join --------------------------------------------------------


_JOINED = "has_map"


def with_maps(registry: DataFrame, extracted: DataFrame, path: str) -> DataFrame:
    """Extracted rows with the maps of their documents, joined once for all operators; a document without a map stays, for its errors."""
    numbered = extracted.withColumn("document", F.monotonically_increasing_id())
    return numbered.join(_maps(registry, path).withColumn(_JOINED, F.lit(True)), _document_key(extracted), "left")


def _maps(registry: DataFrame, path: str) -> DataFrame:
    return registry.select(*MAP_IDENTITY, F.col(path).alias("path"), ord_column(registry).alias("doc_ord"))


def _document_key(docs: DataFrame) -> list[str]:
    if _JOINED in docs.columns:
        return [*MAP_IDENTITY, "path", "doc_ord", _JOINED]
    return [name for name in ("audit_name", "path") if name in docs.columns]


def _with_documents(registry: DataFrame, extracted: DataFrame, path: str) -> DataFrame:
    """Inner join on the path; a registry that measures small goes to the documents, which then are not shuffled.

    Rows of `with_maps` have been joined before.
    """
    if _JOINED in extracted.columns:
        return extracted.where(_JOINED)
    return extracted.join(_maps(registry, path), _document_key(extracted))


def _run_columns(run_id: int) -> list[Column]:
    return [F.lit(run_id).cast("bigint").alias("run_id"), F.col("doc_ord")]
