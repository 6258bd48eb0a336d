"""HTML in column functions: tags with their places, elements by depth, attributes, text.

A page stays one row: tags are found by one pattern, their places are the summed lengths of what lies between, and a fold over them counts
open elements.  Nothing is shuffled and nothing is parsed by Python.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.text import ws_collapse

#: A comment, or a tag whose quoted attribute values may hold any character.
TAG = r"""<!--(?s:.*?)-->|</?[a-zA-Z](?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
NAME = r"(?s)^<(/?)([a-zA-Z][a-zA-Z0-9]*)"


def bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once; lambdas would work out an expression again at each use."""
    return F.transform(F.array(value), body)[0]


def tags(page: Column) -> Column:
    """array<struct<gap, tag, close, name>>: every tag or comment in order, with the length of the text before it; name is '' for comments."""
    p = F.lit(TAG)
    found = F.regexp_extract_all(page, p, F.lit(0))
    between = F.slice(F.split(page, TAG, -1), F.lit(1), F.size(F.split(page, TAG, -1)) - 1)
    return F.zip_with(between, found, lambda gap, t: F.struct(
        F.length(gap).alias("gap"), t.alias("tag"), t.startswith("</").alias("close"), F.lower(F.regexp_extract(t, NAME, 2)).alias("name")))


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of an attribute of a tag; '' where it has none."""
    place = rf"""(?is)^<[a-z][a-z0-9]*(?:\s+[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*?\s+{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
    value = F.regexp_extract(tag, place, 1)
    return bound(F.regexp_replace(value, r"""^["']|["']\z""", ""), decoded)


def has_class(tag: Column, *names: str) -> Column:
    words = F.split(attribute(tag, "class"), r"\s+")
    found = F.lit(True)
    for name in names:
        found = found & F.array_contains(words, name)
    return found


_NAMED = {f"&{name};": chr(code) for name, code in html.entities.name2codepoint.items()} | {"&apos;": "'"}


def decoded(text: Column) -> Column:
    """Text with character references replaced: decimal, hexadecimal, and the named ones of HTML 4; others stay as they are."""
    pattern = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
    hexed = lambda n: F.when((n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise("�")
    named = F.from_json(F.lit(json.dumps(_NAMED)), "map<string, string>")  # a constant, and one literal in the plan

    def one(r: Column) -> Column:
        number = F.when(r.rlike("^&#[xX]"), F.conv(F.regexp_extract(r, "([0-9a-fA-F]+);", 1), 16, 10)).otherwise(F.regexp_extract(r, "([0-9]+);", 1)).cast("long")
        return F.when(r.startswith("&#"), bound(number, hexed)).otherwise(F.coalesce(F.try_element_at(named, r), r))

    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), one)
    joined = F.array_join(F.zip_with(F.split(text, pattern, -1), F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    return F.when(text.contains("&"), joined).otherwise(text)


def text_of(part: Column) -> Column:
    """The text of a piece of a page: tags as spaces, references decoded, white space as one space, none at the ends."""
    return ws_collapse(bound(F.regexp_replace(part, TAG, " "), decoded))


def elements(page: Column, name: str, where=None, unclosed: bool = False) -> Column:
    """Verbatim source of every element ``name``, outermost ones first to last; ``where`` is a condition on its start tag.

    Elements of the same name nest; one that is never closed is left out, or with ``unclosed`` reaches to the end.
    """
    at = lambda s, t: s["at"] + t["gap"]
    after = lambda s, t: at(s, t) + F.length(t["tag"])
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("from"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        mine = t["name"] == name
        opens = mine & ~t["close"] & ((s["depth"] > 0) | (F.lit(True) if where is None else where(t["tag"])))
        closes = mine & t["close"] & (s["depth"] > 0)
        ends = closes & (s["depth"] == 1)
        return F.struct(
            after(s, t).alias("at"), F.when(opens, s["depth"] + 1).when(closes, s["depth"] - 1).otherwise(s["depth"]).alias("depth"),
            F.when(opens & (s["depth"] == 0), at(s, t)).otherwise(s["from"]).alias("from"),
            F.when(ends, F.array_append(s["out"], F.struct(s["from"].alias("s"), after(s, t).alias("e")))).otherwise(s["out"]).alias("out"),
        )

    end = lambda s: F.when(s["depth"] > 0, F.array_append(s["out"], F.struct(s["from"].alias("s"), F.length(page).alias("e")))).otherwise(s["out"])
    found = F.aggregate(tags(page), start, step, end if unclosed else lambda s: s["out"])
    return F.transform(found, lambda x: F.substring(page, x["s"] + 1, x["e"] - x["s"]))


def children(part: Column, *names: str) -> Column:
    """array<struct<name, tag, source>>: the direct children of an element that have one of the names, in order.

    A cell or row ends at its end tag, at the next sibling of these names, or with the element; elements between are counted by depth
    of nested tables, so cells of a table inside a cell are no children of the row.
    """
    item = "struct<name:string,tag:string,source:string>"
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("tables"), F.lit(-1).alias("from"), F.lit("").alias("name"), F.lit("").alias("tag"), F.array().cast(f"array<{item}>").alias("out"),
    )

    def step(inner: Column, s: Column, t: Column) -> Column:
        at = s["at"] + t["gap"]
        table = t["name"] == "table"
        tables = F.when(table & ~t["close"], s["tables"] + 1).when(table & (s["tables"] > 0), s["tables"] - 1).otherwise(s["tables"])
        mine = t["name"].isin(*names) & (s["tables"] == 0)
        done = mine & (s["from"] >= 0)
        source = F.substring(inner, s["from"] + 1, at + F.when(t["close"], F.length(t["tag"])).otherwise(0) - s["from"])
        return F.struct(
            (at + F.length(t["tag"])).alias("at"), tables.alias("tables"),
            F.when(mine & ~t["close"], at).when(done, F.lit(-1)).otherwise(s["from"]).alias("from"),
            F.when(mine & ~t["close"], t["name"]).otherwise(s["name"]).alias("name"), F.when(mine & ~t["close"], t["tag"]).otherwise(s["tag"]).alias("tag"),
            F.when(done, F.array_append(s["out"], F.struct(s["name"].alias("name"), s["tag"].alias("tag"), source.alias("source")))).otherwise(s["out"]).alias("out"),
        )

    last = lambda inner, s: F.when(s["from"] >= 0, F.array_append(s["out"], F.struct(s["name"].alias("name"), s["tag"].alias("tag"), F.substring(inner, s["from"] + 1, F.length(inner)).alias("source")))).otherwise(s["out"])
    content = F.regexp_replace(part, rf"(?s)^(?:{TAG})|(?i:</[a-z][a-z0-9]*\s*>)\z", "")
    return bound(content, lambda inner: F.aggregate(tags(inner), start, lambda s, t: step(inner, s, t), lambda s: last(inner, s)))


def start_tags(page: Column, name: str) -> Column:
    """The start tags of elements without content, such as ``input``, in order."""
    return F.transform(F.filter(tags(page), lambda t: (t["name"] == name) & ~t["close"]), lambda t: t["tag"])
