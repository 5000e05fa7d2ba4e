"""Markup as a tag stream with depths, in Spark expressions.

``parse`` turns a page into its tokens (tags, comments, scripts, text) and its
elements. Tags are sorted by name and place; a running count of opened minus
closed ones, taken by doubling strides, gives every tag its level, and an
element ends at the next tag of its name and level: where its depth returns.
All of it is array functions on one row (n log n), so nothing is shuffled and
no Python runs.

Rules of HTML that matter here: attribute values may be quoted either way or
not at all, and may hold '>'; names count without case; void elements have no
inside; a paragraph ends at the next paragraph tag; an element that nothing
closes ends with the element around it; scripts, styles and comments hold no
text. Character references are decoded in text and attribute values.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.arrays import let, running_sums

TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\z)|<[!?][^>]*+(?:>|\z)"
         r"|</?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-z][^>]*+(?:>|\z)|[^<]++|<")
TAG_NAME = r"(?i)^</?([a-z][^\s/>]*+)"
ATTRIBUTE = r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'=<>`]++)))?"
ATTRIBUTE_NAME = r"^[^\s=]++"
WITHOUT_TEXT = ("script", "style")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
FLAT = ("p",)           # ended by the next tag of their name

# ---- character references ----------------------------------------------------
REFERENCE = r"&#[0-9]++;?|&#[xX][0-9a-fA-F]++;?|&[A-Za-z][A-Za-z0-9]*+;?|[^&]++|&"
# References that count without their semicolon, longest first.
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
REPLACEMENT = "�"


def _numbered(code: Column) -> Column:
    """Character of a code point. Numbers of the C1 controls mean the
    characters of Windows-1252; what is no character becomes U+FFFD."""
    western = {i: bytes([i]).decode("cp1252", "replace") for i in range(0x80, 0xA0)}
    known = F.from_json(F.lit(json.dumps({str(i): c for i, c in western.items() if c != REPLACEMENT})),
                        "map<string,string>")
    wrong = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(wrong, REPLACEMENT).when(code.between(0x80, 0x9F), F.coalesce(known[code.cast("string")], plain)
                                           ).otherwise(plain)


def _decoded_piece(p: Column) -> Column:
    named = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    hexadecimal = F.regexp_extract(p, "^&#[xX]0*+([0-9a-fA-F]++)", 1)
    decimal = F.regexp_extract(p, "^&#0*+([0-9]++)", 1).try_cast("bigint")
    number = F.when(F.length(hexadecimal) > 8, F.lit(None)).when(
        hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("bigint")).when(
        p.rlike("^&#[xX]"), F.lit(0)).otherwise(decimal)
    bare = F.regexp_extract(p, f"^&({_BARE})", 1)
    by_name = F.coalesce(named[F.substr(p, F.lit(2))],
                         F.when(bare != "", F.concat(named[bare], F.substr(p, F.length(bare) + 2))), p)
    return F.when(~p.startswith("&") | (p == "&"), p).when(p.startswith("&#"), _numbered(number)).otherwise(by_name)


def decode_references(text: Column) -> Column:
    """Text with its named and numeric character references decoded."""
    pieces = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), _decoded_piece)
    return F.when(F.instr(text, "&") > 0, F.array_join(pieces, "")).otherwise(text)


# ---- the tag stream ----------------------------------------------------------

def _tag(raw: Column, pos: Column) -> Column:
    name = F.lower(F.regexp_extract(raw, TAG_NAME, 1))
    step = (F.when(name.isin("", *WITHOUT_TEXT, *VOID), 0).when(raw.startswith("</"), -1).otherwise(1))
    return F.struct(name.alias("name"), pos.alias("pos"), step.alias("step"), raw.alias("raw"))


def _ends(tags: Column) -> Column:
    """Opened elements in order: pos, end (NULL if nothing closes it), name,
    raw. ``tags``: opening and closing tags."""
    ordered = F.array_sort(tags)
    levelled = let(ordered, lambda t: let(running_sums(F.transform(t, lambda x: x["step"])), lambda depth: F.array_sort(
        F.transform(t, lambda x, i: F.struct(
            x["name"].alias("name"),
            F.when(x["name"].isin(*FLAT), 0).otherwise(F.get(depth, i) + F.when(x["step"] == 1, 0).otherwise(1))
            .alias("level"), x["pos"].alias("pos"), x["step"].alias("step"), x["raw"].alias("raw"))))))
    ended = let(levelled, lambda t: F.transform(t, lambda x, i: let(F.get(t, i + 1), lambda y: F.struct(
        x["pos"].alias("pos"),
        F.when((x["name"] == y["name"]) & (x["level"] == y["level"]), y["pos"]).alias("end"),
        x["name"].alias("name"), x["raw"].alias("raw"), x["step"].alias("step")))))
    return F.array_sort(F.filter(ended, lambda x: x["step"] == 1))


def parse(html: Column) -> Column:
    """struct(raw, text, els): the tokens as written, their texts ('' for
    tags), and the elements in order of their opening tags, each struct(pos,
    end, name, raw, attrs): its opening tag is token ``pos``, its inside the
    tokens up to ``end``. A NULL page has no tokens."""
    tokens = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TOKEN), F.lit(0))

    def document(raw: Column) -> Column:
        text = F.transform(raw, lambda r: F.when((F.length(r) > 1) & r.startswith("<"), F.lit("")).otherwise(
            decode_references(r)))
        return let(F.transform(raw, _tag), lambda tags: let(_ends(F.filter(tags, lambda t: t["step"] != 0)), lambda e: F.struct(
            raw.alias("raw"), text.alias("text"), _clipped(e, _voids(tags), F.size(raw)).alias("els"))))

    return let(tokens, document)


def _voids(tags: Column) -> Column:
    return F.transform(F.filter(tags, lambda t: t["name"].isin(*VOID)), lambda t: F.struct(
        t["pos"].alias("pos"), (t["pos"] + 1).alias("end"), t["name"].alias("name"), t["raw"].alias("raw")))


def _clipped(elements: Column, voids: Column, size: Column) -> Column:
    """Elements that nothing closes, and flat ones, end with the element around."""
    sure = F.filter(elements, lambda c: c["end"].isNotNull() & ~c["name"].isin(*FLAT))
    whole = let(sure, lambda around: F.transform(elements, lambda x: F.struct(
        x["pos"].alias("pos"),
        F.when(x["end"].isNull() | x["name"].isin(*FLAT), F.least(F.coalesce(x["end"], size), F.coalesce(F.array_min(
            F.transform(F.filter(around, lambda c: (c["pos"] < x["pos"]) & (c["end"] > x["pos"])),
                        lambda c: c["end"])), size))).otherwise(x["end"]).alias("end"),
        x["name"].alias("name"), x["raw"].alias("raw"))))
    return F.transform(F.array_sort(F.concat(whole, voids)), lambda x: F.struct(
        x["pos"].alias("pos"), x["end"].alias("end"), x["name"].alias("name"), x["raw"].alias("raw"),
        attributes(x["raw"]).alias("attrs")))


def attributes(raw: Column) -> Column:
    """Attributes of an opening tag in order: array of struct(name, value);
    names in lower case, values decoded, '' where there is none."""
    def read(a: Column) -> Column:
        return F.struct(F.lower(F.regexp_extract(a, ATTRIBUTE_NAME, 0)).alias("name"), decode_references(
            F.regexp_replace(a, ATTRIBUTE, "$2$3$4")).alias("value"))

    inner = F.regexp_replace(raw, TAG_NAME, "")
    return F.transform(F.regexp_extract_all(inner, F.lit(ATTRIBUTE), F.lit(0)), read)


def value_of(attrs: Column, name: str) -> Column:
    """Value of an attribute, NULL without it (the first of that name counts)."""
    return F.get(F.filter(attrs, lambda a: a["name"] == name), F.lit(0))["value"]


def attribute(element: Column, name: str) -> Column:
    return value_of(element["attrs"], name)


def inside(doc: Column, element: Column) -> Column:
    """The document that an element's inside is."""
    at, size = element["pos"] + 1, element["end"] - element["pos"] - 1
    els = F.filter(doc["els"], lambda x: (x["pos"] >= at) & (x["pos"] < element["end"]))
    return F.struct(
        F.slice(doc["raw"], at + 1, size).alias("raw"), F.slice(doc["text"], at + 1, size).alias("text"),
        F.transform(els, lambda x: F.struct(
            (x["pos"] - at).alias("pos"), (F.least(x["end"], element["end"]) - at).alias("end"),
            x["name"].alias("name"), x["raw"].alias("raw"), x["attrs"].alias("attrs"))).alias("els"))


def text_of(doc: Column, element: Column | None = None) -> Column:
    """Text of an element (default: of the whole document), all descendants'."""
    if element is None:
        return F.array_join(doc["text"], "")
    return F.array_join(F.slice(doc["text"], element["pos"] + 2, element["end"] - element["pos"] - 1), "")


def written(doc: Column) -> Column:
    return F.array_join(doc["raw"], "")


def elements(doc: Column, *names: str, where: Callable[[Column], Column] | None = None) -> Column:
    """Elements of the given names (any, if none) for which ``where`` holds."""
    def fits(x: Column) -> Column:
        named = x["name"].isin(*names) if names else F.lit(True)
        return named & F.coalesce(where(x), F.lit(False)) if where else named

    return F.filter(doc["els"], fits)


def within(doc: Column, element: Column, ancestor: Callable[[Column], Column]) -> Column:
    """Whether an element lies in one for which ``ancestor`` holds."""
    return F.exists(doc["els"], lambda a: (a["pos"] < element["pos"]) & (a["end"] > element["pos"]) & ancestor(a))


def first_text(doc: Column, found: Column) -> Column:
    """Text of the first of the found elements; '' without one."""
    return let(F.get(found, F.lit(0)), lambda x: F.when(x.isNotNull(), text_of(doc, x)).otherwise(F.lit("")))
