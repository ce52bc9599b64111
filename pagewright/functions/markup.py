"""Column functions on HTML source: tokens, attributes and entities."""
from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.text import col, let

# --- fixed values: the token grammar ---
HIDDEN = (r"(?is)<(?:!--.*?-->|script\b[^>]*>.*?(?:</script\s*>|\z)"
          r"|style\b[^>]*>.*?(?:</style\s*>|\z))")
TAG = (r"<[a-zA-Z/!?][^>=]*+"
       r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)[^>=]*+)*+>")
TOKEN = TAG + r"|[^<]+|<"
ATTRIBUTE = r"([a-zA-Z_:@][^\s=/>\"']*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "source", "track", "wbr"]

# Named entities come from the standard library table, as one literal map, the usual ones
# first: a literal map is searched in order.
_USUAL = ["amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "middot;"]
_NAMES = _USUAL + [k for k in html5 if k.endswith(";") and k not in _USUAL]
_NAMED = "\u0002".join(f"{k}\u0001{html5[k]}" for k in _NAMES)


def visible_source(html) -> Column:
    """The page without comments, scripts and style sheets."""
    return F.regexp_replace(col(html), HIDDEN, "")


def split_tokens(html) -> Column:
    """Tags and text runs in document order."""
    return F.regexp_extract_all(visible_source(html), F.lit(TOKEN), F.lit(0))


def tag_name(token) -> Column:
    t = col(token)
    return F.when(t.startswith("<"), F.nullif(
        F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1)), F.lit("")))


def token_kind(token, name) -> Column:
    """text, close, decl, void or open; plain prefix tests, text runs first."""
    t = col(token)
    return (F.when(~t.startswith("<") | (t == "<"), "text").when(t.startswith("</"), "close")
            .when(t.startswith("<!") | t.startswith("<?"), "decl")
            .when(col(name).isin(VOID_TAGS) | t.endswith("/>"), "void").otherwise("open"))


def attribute_map(token) -> Column:
    """Decoded attributes of a tag; a repeated attribute keeps its last value."""
    def found(i):
        return F.regexp_extract_all(col(token), F.lit(ATTRIBUTE), F.lit(i))

    names = F.transform(found(1), lambda n: F.lower(n))
    values = F.transform(found(2), lambda v: decode_entities(
        F.regexp_replace(v, r"(?s)^([\"'])(.*)\1\z", "$2")))

    def as_map(pairs):
        keys = F.array_distinct(pairs["n"])

        def last_value(k):
            return F.element_at(F.filter(F.arrays_zip(pairs["n"].alias("n"), pairs["v"].alias("v")),
                                         lambda p: p["n"] == k), -1)["v"]

        return F.when(F.size(keys) == F.size(pairs["n"]), F.map_from_arrays(pairs["n"], pairs["v"])) \
                .otherwise(F.map_from_arrays(keys, F.transform(keys, last_value)))

    return let(F.struct(names.alias("n"), values.alias("v")), as_map)


def decode_entities(text) -> Column:
    """Numeric and named character references; texts without ``&`` pass untouched."""
    t = col(text)
    named = F.str_to_map(F.lit(_NAMED), F.lit("\u0002"), F.lit("\u0001"))

    def one(ref: Column) -> Column:
        body = F.regexp_extract(ref, r"^&#?(.*);$", 1)
        code = (F.when(body.rlike("^[xX]"), F.conv(F.substring(body, 2, 8), 16, 10))
                .otherwise(F.substring(body, 1, 9))).cast("long")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return (F.when(ref.startswith("&#"), F.when(valid, char).otherwise(F.lit("�")))
                .otherwise(F.coalesce(named[F.substring(ref, 2, 40)], ref)))

    # split at the references and put the decoded ones back in between: one pass, so that
    # "&amp;lt;" becomes "&lt;" and is not decoded twice
    pattern = r"&(?:#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,8}|[a-zA-Z][a-zA-Z0-9]{1,38});"
    refs = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    between = F.split(t, pattern, -1)
    joined = F.array_join(F.zip_with(between, F.concat(F.transform(refs, one), F.array(F.lit(""))),
                                     lambda a, b: F.concat(a, b)), "")
    return F.when(t.contains("&"), joined).otherwise(t)


def visible_text(html) -> Column:
    """Text of a page without markup, entities decoded, stripped."""
    bare = F.regexp_replace(visible_source(html), TAG, "")
    return F.regexp_replace(decode_entities(bare), r"(?U)^\s+|\s+\z", "")
