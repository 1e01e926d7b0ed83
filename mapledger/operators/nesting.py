"""Where the elements of documents stand, by numbering their tags.

A running sum over the steps of the tags gives each element its level, and the
last element opened one level up before it is its parent. All documents of a
batch are numbered together on arrays, in time proportional to their tags. (A
fold in Spark's array functions copies what it has gathered at each step, so it
takes time by the square of a document.)
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# what a tag is: its name's number among the roles (0: any other) times this, plus its step and 1
STEPS = 3
MAP_ROLES = [
    "MapSources", "MapSource", "MapTargets", "MapTarget", "MapSchema", "RecordLayout", "RecordLayoutEvents", "MapEvents",
    "Event", "Action", "Parameter", "Field", "Datatype",
]
TF_ROLES = ["DataAccess", "FilterExpressions"]
PARAMETER_PLACES = "ARRAY<STRUCT<section: INT, event: INT, action: INT, parameter: INT>>"
FIELD_PLACES = "ARRAY<STRUCT<side: INT, source: INT, layout: INT, field: INT, datatype: INT>>"
MAP_PLACES = f"STRUCT<parameters: {PARAMETER_PLACES}, fields: {FIELD_PLACES}, n_parameters: INT, n_fields: INT>"
TF_PLACES = "ARRAY<INT>"


@dataclass
class Elements:
    """Elements of some documents in order: document, number of the tag, role, level (the root has 1) and parent (-1: none)."""

    doc: np.ndarray
    at: np.ndarray
    role: np.ndarray
    level: np.ndarray
    parent: np.ndarray

    def role_of(self, i: np.ndarray) -> np.ndarray:
        return np.where(i >= 0, self.role[i], -1)

    def parent_of(self, i: np.ndarray) -> np.ndarray:
        return np.where(i >= 0, self.parent[i], -1)


def number(tags: pa.ListArray) -> Elements:
    """Elements of well-formed documents, of which each is a list of its tags (null: neither opens nor closes)."""
    lengths = np.array(tags.value_lengths().fill_null(0))
    flat = tags.flatten().fill_null(1 - 2 * STEPS).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    step = np.where(flat >= 0, flat % STEPS - 1, 0)
    opened = np.cumsum(step)
    kept = np.flatnonzero((flat >= 0) & (step >= 0))
    doc, at, role, step = doc[kept], at[kept], flat[kept] // STEPS, step[kept]
    level = opened[kept] + (step == 0)
    # documents and levels as one number; the elements of one keep their order
    width = int(level.max(initial=0)) + 1
    row, place = doc * width + level, np.arange(len(kept))
    can_hold = np.flatnonzero(step == 1)
    holders = can_hold[np.argsort(row[can_hold], kind="stable")]
    keys = row[holders] * (len(kept) + 1) + holders
    found = np.searchsorted(keys, (row - 1) * (len(kept) + 1) + place) - 1
    parent = np.where(found >= 0, holders[found], -1) if len(holders) else np.full(len(kept), -1)
    parent[(parent >= 0) & (row[parent] != row - 1)] = -1
    return Elements(doc, at, role, level, parent)


def _climb(e: Elements, starts: np.ndarray, between: int, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(top, between, start) for every element with `top` >= 0 around a start and every one of the role `between` in between."""
    found = [], [], []
    pairs, middles = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    current, alive = e.parent[starts], np.arange(len(starts))
    while len(alive):
        inside = current >= 0
        current, alive = current[inside], alive[inside]
        here = e.role[current] == between
        pairs.append(alive[here])
        middles.append(current[here])
        reached = np.full(len(starts), -1)
        hit = top[current] >= 0
        if hit.any():
            reached[alive[hit]] = current[hit]
            start, middle = np.concatenate(pairs), np.concatenate(middles)
            ends = reached[start] >= 0
            for part, values in zip(found, (reached[start[ends]], middle[ends], starts[start[ends]]), strict=True):
                part.append(values)
        current = e.parent[current]
    return tuple(np.concatenate([*part, np.zeros(0, np.int64)]) for part in found)


def _listed(n: int, doc: np.ndarray, columns: dict[str, np.ndarray], missing: int | None = None) -> pa.ListArray:
    """A list of structs for each document, sorted by all columns."""
    order = np.lexsort((*reversed(columns.values()), doc))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)
    arrays = [pa.array(values[order].astype(np.int32), mask=values[order] == missing if missing is not None else None) for values in columns.values()]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(arrays, list(columns)))


def map_places(tags: pa.Array) -> pa.Array:
    """Parameters and fields of mapping documents, as the numbers of the tags that describe them.

    A parameter counts for each action and event around it (sections 0:
    source, 1: target, 2: map), a field for each record layout of the first
    schema of its source (sides 0: source, 1: target), with the first data
    type within it. Beside them the numbers of distinct ones that were found.
    """
    e, n, role = number(tags), len(tags), {name: k + 1 for k, name in enumerate(MAP_ROLES)}
    up = e.parent
    over, above, higher = e.role_of(up), e.role_of(e.parent_of(up)), e.parent_of(up)
    section = np.full(len(up), -1)
    for k, name in enumerate(("MapSource", "MapTarget")):
        section[(over == role["RecordLayoutEvents"]) & (above == role[name]) & (e.level > 3)] = k
    section[(over == role["MapEvents"]) & (e.level > 2)] = 2
    section[e.role != role["Event"]] = -1
    event, action, parameter = _climb(e, np.flatnonzero(e.role == role["Parameter"]), role["Action"], section)
    parameters = _listed(
        n, e.doc[event], {"section": section[event], "event": e.at[event], "action": e.at[action], "parameter": e.at[parameter]}
    )

    side = np.full(len(up), -1)
    schemas = np.flatnonzero((e.role == role["MapSchema"]) & (up >= 0))
    first = schemas[np.unique(up[schemas], return_index=True)[1]]
    for k, (parent, child) in enumerate((("MapSources", "MapSource"), ("MapTargets", "MapTarget"))):
        side[first[(over[first] == role[child]) & (above[first] == role[parent]) & (e.level[first] > 3)]] = k
    fields = np.flatnonzero(e.role == role["Field"])
    schema, layout, field = _climb(e, fields, role["RecordLayout"], side)
    datatype = np.full(len(up), np.iinfo(np.int32).max)
    inner = np.flatnonzero(e.role == role["Datatype"])
    outer = e.parent[inner]
    while len(inner):
        inner, outer = inner[outer >= 0], outer[outer >= 0]
        typed = e.role[outer] == role["Field"]
        np.minimum.at(datatype, outer[typed], e.at[inner[typed]])
        outer = e.parent[outer]
    columns = {"side": side[schema], "source": e.at[up[schema]], "layout": e.at[layout], "field": e.at[field], "datatype": datatype[field]}
    listed = _listed(n, e.doc[schema], columns, missing=np.iinfo(np.int32).max)
    counts = [np.bincount(e.doc[np.unique(found)], minlength=n).astype(np.int32) for found in (parameter, field)]
    return pa.StructArray.from_arrays([parameters, listed, *map(pa.array, counts)], ["parameters", "fields", "n_parameters", "n_fields"])


def filter_places(tags: pa.Array) -> pa.Array:
    """Numbers of the tags of filters: children, of any name, of the filter block of a data access below the root."""
    e, n = number(tags), len(tags)
    blocks = e.role_of(e.parent) == TF_ROLES.index("FilterExpressions") + 1
    access = e.role_of(e.parent_of(e.parent)) == TF_ROLES.index("DataAccess") + 1
    found = np.flatnonzero(blocks & access & (e.level > 3))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(e.doc[found], minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(e.at[found].astype(np.int32)))
