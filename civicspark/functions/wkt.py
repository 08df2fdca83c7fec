"""Well-known text of a whole Arrow batch to nested coordinates in one pass.

All texts of a batch are one byte array.  Its characters fall into brackets, commas and tokens;
bracket depth is a prefix sum over them.  A keyword opens a geometry at its depth, in collections
of any nesting too; the depth of a bracket below its keyword tells whether it opens a polygon
or a ring, and prefix sums of those openings give each point its polygon and its ring.  The
offsets of the nested lists are the places where these numbers change.  No text is looked at by
itself.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

#: Geometry keywords and the bracket depth of their points.
POINT_DEPTH = {"POINT": 1, "LINESTRING": 1, "MULTIPOINT": 1, "POLYGON": 2, "MULTILINESTRING": 2, "MULTIPOLYGON": 3, "GEOMETRYCOLLECTION": 0}
#: Words that may follow a keyword.
_ORDINATES, _EMPTY = ("Z", "M", "ZM"), "EMPTY"

# What a character or token is, and which may follow which within a text.
_OPEN, _CLOSE, _COMMA, _NUMBER, _WORD, _NONE = range(6)
_FOLLOWS = np.zeros((6, 6), bool)
for _before, _after in (
    (_OPEN, (_OPEN, _NUMBER, _WORD)), (_CLOSE, (_CLOSE, _COMMA)), (_COMMA, (_OPEN, _NUMBER, _WORD)),
    (_NUMBER, (_NUMBER, _COMMA, _CLOSE)), (_WORD, (_OPEN, _WORD)), (_NONE, (_COMMA, _CLOSE)),
):
    _FOLLOWS[_before, list(_after) + ([_NONE] if _before in (_WORD, _OPEN, _COMMA) else [])] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r\x0b\x0c")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(ord("A"), ord("Z") + 1)) + list(range(ord("a"), ord("z") + 1))] = True

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
GEOMETRY = "struct<kind:string,parts:array<array<array<struct<x:double,y:double>>>>>"


def _base(word: str) -> str:
    """A keyword without ordinates written against it, as in POINTZ."""
    for end in ("ZM", "Z", "M"):
        if word.endswith(end) and word[: -len(end)] in POINT_DEPTH:
            return word[: -len(end)]
    return word


def _numbers(tokens: pa.Array) -> np.ndarray:
    """Doubles; NaN where a token is no number."""
    plain = pc.utf8_ltrim(tokens, "+")
    try:
        return pc.cast(plain, pa.float64()).to_numpy(zero_copy_only=False)
    except pa.ArrowInvalid:
        fits = pc.match_substring_regex(tokens, r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
        return pc.cast(pc.if_else(fits, plain, pa.scalar(None, pa.string())), pa.float64()).to_numpy(zero_copy_only=False)


def _nested(offsets: np.ndarray, values: pa.Array, gone: np.ndarray | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=None if gone is None else pa.array(gone))


def parse_texts(column: pa.Array) -> pa.Array:
    """A struct of kind and parts for each text; see ``parse_wkt`` for what they hold."""
    n = len(column)
    texts = pc.fill_null(column.cast(pa.string()), "")
    _, ends, raw = texts.buffers()
    bounds = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    chars = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    row = np.repeat(np.arange(n), np.diff(bounds))
    size = len(chars)

    opens, closes, commas = (chars == ord(c) for c in "(),")
    depth = np.cumsum(opens.astype(np.int32) - closes)
    before = np.concatenate([[0], depth])
    depth = depth - before[bounds[:-1]][row]
    bad = np.zeros(n, bool)
    bad[row[depth < 0]] = True
    bad |= before[bounds[1:]] != before[bounds[:-1]]

    # Tokens: runs of other characters, cut at the ends of a text.
    inside = ~(opens | closes | commas | _BLANK[chars])
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    neighbour = np.concatenate([[False], inside, [False]])
    start = np.flatnonzero(inside & (~neighbour[:-2] | edge[:-1]))
    end = np.flatnonzero(inside & (~neighbour[2:] | edge[1:])) + 1
    ticks = np.stack([start, end], 1).ravel().astype(np.int32)
    every = pa.StringArray.from_buffers(max(0, len(ticks) - 1), pa.py_buffer(ticks), pa.py_buffer(chars.tobytes())) if len(ticks) else pa.array([], pa.string())
    is_word = _LETTER[chars[start]]
    words = pc.utf8_upper(every.take(pa.array(2 * np.flatnonzero(is_word)))).dictionary_encode()
    names, code, word_at = words.dictionary.to_pylist(), words.indices.to_numpy(), start[is_word]
    is_empty = np.array([w == _EMPTY for w in names], bool)[code]
    is_key = ~is_empty & ~np.array([w in _ORDINATES for w in names], bool)[code]

    # Geometries: a keyword each.  Unknown ones are read as a list of points.
    key_at, key_depth = word_at[is_key], depth[word_at[is_key]] if size else np.zeros(0, np.int32)
    below = np.array([POINT_DEPTH.get(_base(w), 1) for w in names], np.int32)[code][is_key]
    kind = np.array([_base(w) for w in names], object)[code][is_key]

    def geometry_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The geometry a place belongs to, and whether it has one in its own text."""
        g = np.searchsorted(key_at, places, "right") - 1
        has = g >= 0
        has[has] = row[key_at[g[has]]] == row[places[has]]
        return np.maximum(g, 0), has

    # The order of brackets, commas and tokens.
    marks = np.concatenate([np.flatnonzero(opens | closes | commas), start])
    sort = np.full(size, _NUMBER)
    sort[opens], sort[closes], sort[commas] = _OPEN, _CLOSE, _COMMA
    sort[word_at] = np.where(is_empty, _NONE, _WORD)
    marks.sort()
    what, whose = sort[marks], row[marks]
    same = whose[1:] == whose[:-1]
    bad[whose[1:][same & ~_FOLLOWS[what[:-1], what[1:]]]] = True
    firsts, lasts = np.concatenate([[True], ~same])[: len(marks)], np.concatenate([~same, [True]])[: len(marks)]
    bad[whose[firsts & (what != _WORD)]] = True
    bad[whose[lasts & (what != _CLOSE) & (what != _NONE)]] = True
    bad[row[commas & (depth == 0)]] = True

    # Points: numbers without a bracket or comma between them.
    number_at = start[~is_word]
    value = _numbers(every.take(pa.array(2 * np.flatnonzero(~is_word))))
    apart = np.cumsum(opens | closes | commas)[number_at] if size else np.zeros(0, np.int64)
    new = np.ones(len(number_at), bool)
    new[1:] = (apart[1:] != apart[:-1]) | (row[number_at][1:] != row[number_at][:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(number_at)))
    at, of = number_at[first], row[number_at[first]]
    bad[of[many < 2]] = True
    bad[row[number_at[np.isnan(value)]]] = True
    x, y = value[first], value[np.minimum(first + 1, max(0, len(value) - 1))]

    g, has = geometry_of(at)
    if len(key_at):
        relative = depth[at] - key_depth[g]
        fits = relative == below[g]
        fits |= (kind[g] == "MULTIPOINT") & (relative == 2)
        bad[of[~has | ~fits]] = True
        # Openings of polygons and rings; only those of a MULTIPOLYGON open polygons.
        open_at = np.flatnonzero(opens)
        og, _ = geometry_of(open_at)
        opened = depth[open_at] - key_depth[og]
        many_polygons = below[og] == 3
        polygons = np.concatenate([[0], np.cumsum(many_polygons & (opened == 2))])
        rings = np.concatenate([[0], np.cumsum((many_polygons & (opened == 3)) | ((below[og] == 2) & (opened == 2)))])
        seen = np.searchsorted(open_at, at, "right")
        polygon, ring = polygons[seen], rings[seen]
    else:
        bad[of] = True
        polygon = ring = np.zeros(len(at), np.int64)

    keep = ~bad[of]
    g, polygon, ring, of = g[keep], polygon[keep], ring[keep], of[keep]
    points = pa.StructArray.from_arrays([pa.array(x[keep]), pa.array(y[keep])], fields=list(_POINT))
    new_polygon = np.ones(len(g), bool)
    new_polygon[1:] = (g[1:] != g[:-1]) | (polygon[1:] != polygon[:-1])
    new_ring = new_polygon.copy()
    new_ring[1:] |= ring[1:] != ring[:-1]
    ring_at = np.flatnonzero(new_ring)
    polygon_at = np.flatnonzero(new_polygon[ring_at])
    per_row = np.bincount(of[ring_at[polygon_at]], minlength=n)
    in_rings = _nested(np.append(ring_at, len(g)), points)
    in_polygons = _nested(np.append(polygon_at, len(ring_at)), in_rings)
    parts = _nested(np.concatenate([[0], np.cumsum(per_row)]), in_polygons, bad)

    # The kind: the words before the first bracket, without EMPTY.
    opened_at = np.full(n, size)
    np.minimum.at(opened_at, row[opens], np.flatnonzero(opens))
    head = (word_at < opened_at[row[word_at]]) & ~is_empty
    spoken = words.dictionary.take(pa.array(code)) if len(code) else pa.array([], pa.string())
    head_at, head_row = np.flatnonzero(head), row[word_at[head]]
    nth = np.arange(len(head_row)) - np.searchsorted(head_row, head_row)
    named = []
    for k in (0, 1):
        index = np.full(n, -1)
        index[head_row[nth == k]] = head_at[nth == k]
        named.append(pc.if_else(pa.array(index >= 0), spoken.take(pa.array(np.maximum(index, 0))) if len(spoken) else pa.nulls(n, pa.string()), pa.scalar(None, pa.string())))
    kinds = pc.coalesce(pc.binary_join_element_wise(*named, " "), named[0])

    has_empty = np.zeros(n, bool)
    has_empty[row[word_at[is_empty]]] = True
    no_geometry = (opened_at == size) & (~has_empty | bad)
    no_geometry |= pc.is_null(column).to_numpy(zero_copy_only=False)
    return pa.StructArray.from_arrays([kinds, parts], names=["kind", "parts"], mask=pa.array(no_geometry))


# Executors get this module with the function, not by import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
