"""Array / map / JSON column functions.

Maps are built inside the row that holds the page, with higher-order functions,
so building a page's map never needs a shuffle.  Duplicate keys are collapsed
explicitly (last wins, as a Python dict assignment does); the session-wide
``spark.sql.mapKeyDedupPolicy`` is never changed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import let

ColumnOrName = Column | str

MAP_SCHEMA = "map<string,string>"

# Grammar of a flat dict literal (E8): keys are strings, values strings, numbers or the constants.
_STRING = r"""(?:[rRuU]?+(?:'(?:[^'\\\n]++|\\.)*+'|"(?:[^"\\\n]++|\\.)*+"))"""
_DIGITS = "[0-9](?:_?[0-9])*+"
_NUMBER = rf"""(?:[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?)"""
_VALUE = rf"(?:{_STRING}|(?:True|False|None|true|false|null)\b|{_NUMBER})"
#: One step of the walk: an entry with what opens the dict before it and what closes it after it.
_STEP = rf"(?s)\G(?:\A\s*\{{|(?!\A))\s*{_STRING}\s*:\s*{_VALUE}\s*(?:\}}\s*\z|,(?:\s*\}}\s*\z)?)"
_ENTRY = rf"(?s)\A\s*\{{?\s*({_STRING})\s*:\s*({_VALUE})"
_EMPTY = r"\A\s*\{\s*\}\s*\z"
_CODES = r"(?:\\u[0-9a-fA-F]{4})+"
_PIECE = rf"(?s){_CODES}|\\U[0-9a-fA-F]{{8}}|\\x[0-9a-fA-F]{{2}}|\\[0-7]{{1,3}}|\\.|[^\\]+"
# Python's and JSON's escapes of one character.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "a": "\a", "v": "\v", "\n": "",
            "\\": "\\", "'": "'", '"': '"', "/": "/"}


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_wins_entries(entries: ColumnOrName) -> Column:
    """Keep, for each key, the entry that comes last; order by first occurrence.

    ``entries`` is ``array<struct<key, value>>`` in document order.  Sorting by
    (key, position) makes the pass O(n log n) per row instead of O(n^2).
    """
    indexed = F.transform(_c(entries), lambda x, i: F.struct(
        x["key"].alias("key"), i.alias("pos"), x["value"].alias("value")))

    def collapse(by_key: Column) -> Column:
        n = F.size(by_key)
        last = F.filter(by_key, lambda x, i: (i + 1 == n) | (F.get(by_key, i + 1)["key"] != x["key"]))
        first_pos = F.filter(by_key, lambda x, i: (i == 0) | (F.get(by_key, i - 1)["key"] != x["key"]))
        # Re-order kept entries by each key's first position (dict insertion order).
        keyed = F.zip_with(first_pos, last, lambda f, l: F.struct(
            f["pos"].alias("pos"), l["key"].alias("key"), l["value"].alias("value")))
        return F.transform(F.array_sort(keyed),
                           lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))
    return let(F.array_sort(indexed), collapse)


def entries_to_map(entries: ColumnOrName) -> Column:
    """Duplicate-free entries -> map; empty array -> empty map."""
    return F.map_from_entries(last_wins_entries(entries))


def zip_map(keys: ColumnOrName, values: ColumnOrName) -> Column:
    """``dict(zip(keys, values))``: shorter list wins, last duplicate key wins."""
    def build(k: Column, v: Column) -> Column:
        n = F.least(F.size(k), F.size(v))
        pairs = F.zip_with(F.slice(k, 1, n), F.slice(v, 1, n),
                           lambda a, b: F.struct(a.alias("key"), b.alias("value")))
        return F.when(n > 0, entries_to_map(pairs)).otherwise(F.create_map().cast(MAP_SCHEMA))
    return let(keys, lambda k: let(values, lambda v: build(k, v)))


def or_empty(m: ColumnOrName) -> Column:
    """Absent map -> ``{}``."""
    return F.coalesce(_c(m), F.create_map().cast(MAP_SCHEMA))


def map_json(m: ColumnOrName) -> Column:
    """Map serialised as JSON text (``{}`` when absent)."""
    return F.to_json(or_empty(m))


def canonical_entries(m: ColumnOrName) -> Column:
    """E5: order-free comparison form of a map: entries sorted by key."""
    return F.array_sort(F.map_entries(_c(m)))


def _unescaped(body: Column) -> Column:
    """Text between the quotes of a string literal, its escapes undone; an unknown escape stays as written."""
    def utf32(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")

    def piece(p: Column) -> Column:
        out = (F.when(p.rlike(r"\A\\u[0-9a-fA-F]{4}"),
                      F.decode(F.unhex(F.regexp_replace(p, r"\\u", "")), "UTF-16BE"))
               .when(p.rlike(r"\A\\U[0-9a-fA-F]{8}"), utf32(F.substring(p, 3, 8)))
               .when(p.rlike(r"\A\\x[0-9a-fA-F]{2}"), utf32(F.substring(p, 3, 2)))
               .when(p.rlike(r"\A\\[0-7]"), utf32(F.conv(F.substring(p, 2, 3), 8, 16))))
        for name, text in _ESCAPES.items():
            out = out.when(p == F.lit("\\" + name), F.lit(text))
        return out.otherwise(p)
    return F.when(F.instr(body, "\\") == 0, body).otherwise(
        F.array_join(F.transform(F.regexp_extract_all(body, F.lit(_PIECE), 0), piece), ""))


def _atom(text: Column) -> Column:
    """One key or value: strings unquoted, constants as JSON writes them, numbers as written."""
    body = F.regexp_extract(text, r"""(?s)\A[rRuU]?['"](.*)['"]\z""", 1)
    return (F.when(text.rlike(r"""\A[rR]['"]"""), body)
            .when(text.rlike(r"""\A[uU]?['"]"""), let(body, _unescaped))
            .when(text.isin("None", "null"), F.lit(None))
            .when(text.isin("True", "False", "true", "false"), F.lower(text))
            .otherwise(F.replace(text, F.lit("_"), F.lit(""))))


def dict_literal(c: ColumnOrName) -> Column:
    """A Python dict literal or a JSON object -> ``struct<value: map<string,string>, error: string>``.

    The entries are walked one after the other, each where the one before ended.  Keys are strings; values are
    strings (either quote, ``r`` and ``u`` prefixes, Python's and JSON's escapes), numbers (as written, without
    underscores) or ``True False None`` (``true``, ``false``, null).  The last of equal keys wins.  A JSON object
    that nests is read as JSON, inner objects as their text.  Anything else is refused: ``value`` is null and
    ``error`` is ``empty`` (no text but white space) or ``not_a_dict@<n>``, ``n`` being how many characters
    were read before the walk stopped.  A null cell is a null value without an error.
    """
    def entry(step: Column) -> Column:
        return F.struct(_atom(F.regexp_extract(step, _ENTRY, 1)).alias("key"),
                        _atom(F.regexp_extract(step, _ENTRY, 2)).alias("value"))

    def read(text: Column, steps: Column, done: Column) -> Column:
        walked = (done == F.length(text)) & F.get(steps, F.size(steps) - 1).rlike(r"\}\s*\z")
        nested = F.when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.from_json(text, MAP_SCHEMA))
        value = (F.when(text.rlike(_EMPTY), F.create_map().cast(MAP_SCHEMA))
                 .when(walked, entries_to_map(F.transform(steps, entry)))
                 .when(text.rlike(r"\A\s*\{"), nested))
        error = F.when(text.rlike(r"\A\s*\z"), F.lit("empty")).otherwise(
            F.concat(F.lit("not_a_dict@"), done.cast("string")))
        return let(value, lambda v: F.struct(
            v.alias("value"), F.when(v.isNull() & text.isNotNull(), error).alias("error")))
    return let(c, lambda text: let(F.regexp_extract_all(text, F.lit(_STEP), 0), lambda steps: let(
        F.coalesce(F.length(F.array_join(steps, "")), F.lit(0)), lambda done: read(text, steps, done))))


def parse_dict_literal(c: ColumnOrName) -> Column:
    """The map of ``dict_literal``; null where the text is refused."""
    return dict_literal(c)["value"]
