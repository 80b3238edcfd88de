"""Reading text, links and labelled fields out of raw HTML with SQL regexes."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import bound

#: The named character references of HTML, from Python's own table; ``amp`` comes last in ``unescape``.
NAMED = {f"&{name}": letter for name, letter in html5.items() if name.endswith(";") and name.lower() != "amp;"}

_HREF = r"""(?is)<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _numbered(ref: Column) -> Column:
    """The letter of a numeric reference; a replacement mark where there is none."""
    digits = F.regexp_replace(ref, "[&#xX;]", "")
    hexadecimal = F.lower(F.substring(ref, 3, 1)) == "x"
    code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("bigint")
    known = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(known, letter).otherwise(F.lit("\ufffd"))


def unescape(c: Column) -> Column:
    """Replace character references: numeric ones and all named ones, ``&amp;`` last.

    The text is searched once, then rewritten once per distinct reference in it.
    """
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")  # a constant, so it is parsed once in the plan

    def letter(ref: Column) -> Column:
        numbered = F.startswith(ref, F.lit("&#"))
        return F.when(numbered, _numbered(ref)).otherwise(F.coalesce(F.try_element_at(names, ref), ref))

    def rewritten(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)))
        done = F.aggregate(found, text, lambda acc, ref: F.replace(acc, ref, letter(ref)))
        return F.when(F.contains(text, F.lit("&")), F.regexp_replace(done, "&(?:amp|AMP);", "&")).otherwise(text)

    return bound(c, rewritten)


# The repeats are bounded, as each takes stack; what is left of a longer tag ends at its first ``>``.
_TAG = r"""(?s)</?[A-Za-z!](?:[^>=]++|=++\s*+(?:"[^"]*+"|'[^']*+')|=++){0,200}+[^>]*>"""


def _live(c: Column) -> Column:
    """The page without scripts, styles and comments, which may hold text that looks like tags."""
    text = F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</(?:script|style)\s*>", " ")
    return F.regexp_replace(text, r"(?s)<!--.*?-->", " ")


def visible_text(c: Column) -> Column:
    """The text a reader sees, pieces joined by one space. Quoted attribute values may hold ``>``."""
    text = F.regexp_replace(_live(c), _TAG, " ")
    return F.btrim(F.regexp_replace(unescape(text), r"(?U)\s+", " "))


def hrefs(c: Column) -> Column:
    """All ``href`` values of ``a`` tags, in page order; anchors without one are skipped."""
    tags = F.regexp_extract_all(_live(c), F.lit(_HREF), F.lit(0))
    return F.transform(
        tags,
        lambda tag: unescape(
            F.concat(*[F.regexp_extract(tag, _HREF, i) for i in (1, 2, 3)])
        ),
    )


_ELEMENT = "struct<no: int, depth: int, tag: string, html: string>"


def elements(c: Column, tag: str) -> Column:
    """``no, depth, tag, html`` of every ``tag`` element in page order: its opening tag and inner HTML.

    Elements may stand in elements of the same name; each goes to its own closing
    tag, or to the end of the page if it has none. The tags of this name are folded
    over a stack of open elements.
    """
    mark = rf"(?is)</?{tag}(?=[\s/>])[^>]*>"

    def fold(page: Column) -> Column:
        tags, pieces = F.regexp_extract_all(page, F.lit(mark), F.lit(0)), F.split(page, mark, -1)
        steps = F.zip_with(tags, F.slice(pieces, F.lit(2), F.size(pieces)), lambda t, p: F.struct(t.alias("t"), p.alias("p")))
        none = F.array().cast(f"array<{_ELEMENT}>")
        start = F.struct(none.alias("open"), none.alias("done"), F.lit(0).alias("n"))

        def step(state: Column, s: Column) -> Column:
            open_, done, n = state["open"], state["done"], state["n"]
            longer = lambda e: F.struct(
                e["no"].alias("no"), e["depth"].alias("depth"), e["tag"].alias("tag"), F.concat(e["html"], s["t"], s["p"]).alias("html")
            )
            own = F.struct(n.alias("no"), F.size(open_).alias("depth"), s["t"].alias("tag"), s["p"].alias("html"))
            opened = F.struct(F.concat(F.transform(open_, longer), F.array(own)).alias("open"), done.alias("done"), (n + 1).alias("n"))
            outer = F.transform(F.slice(open_, F.lit(1), F.greatest(F.size(open_) - 1, F.lit(0))), longer)
            closed = F.struct(outer.alias("open"), F.concat(done, F.slice(open_, -1, 1)).alias("done"), n.alias("n"))
            return F.when(~F.startswith(s["t"], F.lit("</")), opened).when(F.size(open_) > 0, closed).otherwise(state)

        # An element that was never closed ends with the page.
        return F.aggregate(steps, start, step, lambda state: F.array_sort(F.concat(state["done"], state["open"])))

    return bound(_live(c), fold)


def blocks(c: Column, tag: str) -> Column:
    """The inner HTML of every ``tag`` element, nested ones too, in page order."""
    return F.transform(elements(c, tag), lambda e: e["html"])


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of an opening tag; empty without it."""
    pattern = rf"""(?is)^<[^\s>]+\b[^>]*?\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def blocks_with_class(c: Column, tag: str, name: str) -> Column:
    """The inner HTML of every ``tag`` element that carries the class ``name``."""
    own = F.filter(elements(c, tag), lambda e: F.array_contains(F.split(_attribute(e["tag"], "class"), r"\s+"), name))
    return F.transform(own, lambda e: e["html"])


def block_with_id(c: Column, tag: str, name: str) -> Column:
    """The inner HTML of the first ``tag`` element with this id; null if there is none or it is empty."""
    own = F.filter(elements(c, tag), lambda e: _attribute(e["tag"], "id") == name)
    return F.nullif(F.try_element_at(own, F.lit(1))["html"], F.lit(""))


def first_block_text(c: Column, tag: str) -> Column:
    """The visible text of the first ``tag`` element; null if there is none."""
    return F.nullif(visible_text(F.try_element_at(blocks(c, tag), F.lit(1))), F.lit(""))


def strong_hrefs(c: Column) -> Column:
    """Links that stand inside ``strong`` elements only, those of nested ones once."""
    outer = F.filter(elements(c, "strong"), lambda e: e["depth"] == 0)
    return F.flatten(F.transform(outer, lambda e: hrefs(e["html"])))


def labelled_block(c: Column, label: str) -> Column:
    """The inner HTML of the ``dd`` that follows the ``dt`` with this label; null without it."""
    rest = F.regexp_extract(_live(c), rf"(?is)<dt\b[^>]*>\s*{label}\s*</dt\s*>(.*)", 1)
    return F.nullif(F.try_element_at(blocks(rest, "dd"), F.lit(1)), F.lit(""))
