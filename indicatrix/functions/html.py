"""Field extraction from page text with regular expressions, one page per row.

Scripts, styles and comments are cut first. Nested blocks are found by counting opening and closing tags,
so a block ends where its own closing tag stands.
"""

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from .text import normalise, strip

#: All standard named character references, by name without ``&``; most end in ``;``, the oldest also stand without it.
REFERENCES = {name: char for name, char in html5.items()}
_BARE = "|".join(sorted((n for n in REFERENCES if not n.endswith(";")), key=lambda n: (-len(n), n)))


def without_inert(html: Column) -> Column:
    """Drop comments, scripts and styles, whose text may look like markup."""
    return F.regexp_replace(
        html, r"(?is)<!--.*?-->|<script(?:\s[^>]*)?>.*?</script\s*>|<style(?:\s[^>]*)?>.*?</style\s*>", "")


def _once(value: Column, body) -> Column:
    """Use a computed value several times in ``body`` while computing it once per row."""
    return F.transform(F.array(value), body)[0]


def unescape(c: Column) -> Column:
    """Decode numeric and named character references, also those without ``;`` that pages may use. Codes that are no
    character stay as they are."""
    table = F.from_json(F.lit(json.dumps(REFERENCES)), "map<string,string>")

    def decode(piece):
        digits = F.regexp_extract(piece, r"^#(\d{1,7});?", 1)
        hexa = F.regexp_extract(piece, r"^#[xX]([0-9a-fA-F]{1,6});?", 1)
        code = (F.when(digits != "", digits.try_cast("int"))
                .when(hexa != "", F.conv(hexa, 16, 10).try_cast("int")))
        char = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF),
                      F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        name = F.regexp_extract(piece, r"^[A-Za-z][A-Za-z0-9]*;", 0)
        bare = F.regexp_extract(piece, rf"^(?:{_BARE})", 0)
        named = F.when(name != "", table[name])
        return (F.when(char.isNotNull(), F.concat(char, F.regexp_replace(piece, r"^#[xX]?[0-9a-fA-F]*;?", "")))
                .when(named.isNotNull(), F.concat(named, F.substr(piece, F.length(name) + 1)))
                .when(bare != "", F.concat(table[bare], F.substr(piece, F.length(bare) + 1)))
                .otherwise(F.concat(F.lit("&"), piece)))

    def join(pieces):
        return F.concat(pieces[0], F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decode), ""))
    return F.when(F.contains(c, F.lit("&")), _once(F.split(c, "&"), join)).otherwise(c)


def whole_text_of(fragment: Column) -> Column:
    """Text of a fragment: tags removed, references decoded."""
    return unescape(F.regexp_replace(fragment, r"(?s)<[^>]*>", ""))


def text_of(fragment: Column) -> Column:
    """Visible text of a fragment, ends stripped."""
    return strip(whole_text_of(fragment))


def elements(html: Column, tag: str) -> Column:
    """Every element of a tag that does not nest in itself, with its opening tag."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>"), F.lit(0))


def first_element(html: Column, tag: str) -> Column:
    found = F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", 0)
    return F.nullif(found, F.lit(""))


def attribute(element: Column, name: str) -> Column:
    """Attribute of the element's opening tag, null when it has none."""
    opening = F.regexp_extract(element, r"(?s)^<[^>]*>", 0)
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    value = F.concat(F.regexp_extract(opening, pattern, 1), F.regexp_extract(opening, pattern, 2))
    return F.when(opening.rlike(pattern), unescape(value))


def has_class(element: Column, name: str) -> Column:
    classes = F.split(normalise(attribute(element, "class")), " ")
    return F.coalesce(F.array_contains(classes, F.lit(name)), F.lit(False))


def with_block(df: DataFrame, html: str, into: str, tag: str, name: str, value: str) -> DataFrame:
    """Add the inner HTML of the first ``<tag name="...value...">``, nested same-named tags included; null if absent.

    The steps are columns of their own, so that each is computed once per page.
    """
    opening = rf"""(?is)(?=<{tag}\s[^>]*?\b{name}\s*=\s*["'](?:[^"']*\s)?{value}(?:\s[^"']*)?["'][^>]*>)"""
    tags = rf"(?i)(?=<{tag}[\s>])|(?=</{tag}\s*>)"

    def step(acc, piece):
        change = (F.when(piece.rlike(rf"(?i)^<{tag}[\s>]"), F.lit(1))
                  .when(piece.rlike(rf"(?i)^</{tag}\s*>"), F.lit(-1)).otherwise(F.lit(0)))
        depth = acc["depth"] + change
        open_ = acc["open"] & (depth > 0)
        return F.struct(depth.alias("depth"), open_.alias("open"),
                        (acc["kept"] + F.when(open_, F.lit(1)).otherwise(F.lit(0))).alias("kept"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(True).alias("open"), F.lit(0).alias("kept"))
    # The leading blank makes the block the second part wherever it stands.
    found = df.withColumn("__at", F.get(F.split(F.concat(F.lit(" "), F.col(html)), opening, 2), F.lit(1)))
    found = found.withColumn("__pieces", F.split("__at", tags))
    found = found.withColumn("__kept", F.aggregate("__pieces", start, step)["kept"])
    inner = F.regexp_replace(F.array_join(F.slice("__pieces", F.lit(1), F.col("__kept")), ""), r"(?s)^<[^>]*>", "")
    return found.withColumn(into, inner).drop("__at", "__pieces", "__kept")


def table_rows(html: Column) -> Column:
    return elements(html, "tr")


_CELL = r"""(?is)<td\s[^>]*?data-label\s*=\s*["']([^"']*)["'][^>]*>.*?</td\s*>"""


def with_cells(df: DataFrame, row: str) -> DataFrame:
    """Add ``__labels`` and ``__cells``: all labelled cells of a row, found in one pass over each."""
    return (df.withColumn("__labels", F.regexp_extract_all(F.col(row), F.lit(_CELL), F.lit(1)))
            .withColumn("__cells", F.regexp_extract_all(F.col(row), F.lit(_CELL), F.lit(0))))


def labelled_cell(label: str) -> Column:
    """The first cell with this label in a row prepared by ``with_cells``, null when it has none."""
    return F.get("__cells", F.nullif(F.array_position("__labels", F.lit(label)), F.lit(0)).cast("int") - 1)


def links(html: Column) -> Column:
    """Targets of all anchors that have one, in page order."""
    return F.filter(F.transform(elements(html, "a"), lambda a: attribute(a, "href")), lambda h: h.isNotNull())


def paragraphs(html: Column) -> Column:
    """Texts of all paragraphs in page order. A paragraph ends at its closing tag or where the next one starts."""
    pieces = F.split(html, r"(?i)<p(?:\s[^>]*)?>")
    bodies = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces), F.lit(1)))
    return F.transform(bodies, lambda b: whole_text_of(F.split(b, r"(?i)</p\s*>")[0]))
