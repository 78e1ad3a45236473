"""Character references of HTML as column expressions.

They are decoded after extraction, in a single pass (so ``&amp;lt;`` becomes ``&lt;``), for the named entities
of HTML 4 and ``apos`` and for every decimal or hexadecimal reference (its ``;`` may be missing).
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import let

ColumnOrName = Column | str

ENTITY_RE = r"&(#[0-9]++|#[xX][0-9a-fA-F]++|[a-zA-Z][a-zA-Z0-9]{1,31}(?=;));?"


def _named_map() -> Column:
    """The named entities as a map; one constant, folded when the plan is made."""
    named = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
    return F.from_json(F.lit(json.dumps(named)), "map<string,string>")


def _entity_char(name: Column) -> Column:
    named = F.try_element_at(_named_map(), name)
    hexa = F.lower(F.substring(name, 2, 1)) == "x"
    digits = F.regexp_replace(F.when(hexa, F.substring(name, 3, F.length(name))).otherwise(
        F.substring(name, 2, F.length(name))), "^0+", "")
    # Up to eight digits fit; a value that is no character becomes U+FFFD, as in HTML.
    short = F.when(F.length(digits).between(1, 8), digits).otherwise(F.lit("0"))
    code = F.when(hexa, F.conv(short, 16, 10)).otherwise(short).cast("bigint")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    code_hex = F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(0xFFFD))), 8, "0")
    numeric = F.decode(F.unhex(code_hex), "UTF-32")
    return (F.when(F.substring(name, 1, 1) == "#", numeric)
            .otherwise(F.coalesce(named, F.concat(F.lit("&"), name, F.lit(";")))))


def decode_entities(text: ColumnOrName) -> Column:
    """Single-pass decoding of named and numeric character references."""
    def decode(t: Column) -> Column:
        names = F.regexp_extract_all(t, F.lit(ENTITY_RE), 1)

        def join(parts: Column) -> Column:
            tail = F.slice(parts, 2, F.size(parts) - 1)
            pieces = F.zip_with(names, tail, lambda n, p: F.concat(_entity_char(n), p))
            return F.concat(F.get(parts, 0), F.array_join(pieces, ""))
        return F.when(t.contains("&"), let(F.split(t, ENTITY_RE, -1), join)).otherwise(t)
    return let(text, decode)


def first_text(texts: ColumnOrName) -> Column:
    """The first of the texts found, decoded; null when there is none."""
    return decode_entities(F.get(texts, 0))


def decoded(texts: ColumnOrName) -> Column:
    """All texts found, decoded."""
    return F.transform(texts, decode_entities)
