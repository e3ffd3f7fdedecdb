"""Elements of page text at their true depth, as one column.

``element_table`` walks over a page's tags once, with the stack of elements that are open, and gives every element of the page
with the characters it spans. Whatever is asked afterwards (the rows of a table, an item's first link, a block's third element)
is a filter of that array and a slice of the text, so elements that hold others of their own kind stay whole.

A closing tag ends the nearest open element of its name and all that were opened in it; one without such an element is ignored.
Elements that are never closed end with the element around them. Void elements hold nothing.
"""

from pyspark.sql import Column, functions as F

from .html import unescape, whole_text_of
from .text import normalise, strip

# HTML's void elements.
VOID = "area base br col embed hr img input link meta param source track wbr".split()


def _tokens(tags) -> str:
    """Pattern of a tag and the text after it up to the next, or of text before the first. Groups: the tag, its name."""
    name = r"[a-zA-Z][^\s/>]*+" if tags is None else rf"(?:{'|'.join(tags)})(?=[\s/>])"
    values = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
    other = rf"(?:[^<]++|<(?!/?{name}))"
    return rf"(?is)(</?({name}){values}>){other}*+|{other}++|<"


_ELEMENT = "struct<start:int,inner:int,stop:int,end:int,tag:string,opening:string>"
_OPEN = "struct<start:int,inner:int,tag:string,opening:string>"
_TEXT, _START, _CLOSE, _EMPTY = range(4)


def element_table(html: Column, tags=None) -> Column:
    """All elements in page order: ``start`` and ``end`` of the element, ``inner`` and ``stop`` of what it holds, ``tag`` in
    lower case, ``opening`` tag. Places are characters from 0, ends exclusive. Comments and scripts should be cut before.

    With ``tags`` (lower case) only these are looked at, the rest is text; then an element that is never closed ends with the
    nearest of these around it.
    """
    def token(text, tag_and_name):
        tag, name = tag_and_name["tag"], F.lower(tag_and_name["name"])
        kind = (F.when(name == "", _TEXT).when(F.startswith(tag, F.lit("</")), _CLOSE).when(name.isin(VOID), _EMPTY)
                .otherwise(_START))
        return F.struct(kind.alias("kind"), name.alias("name"), F.length(text).alias("size"), F.length(tag).alias("own"), tag.alias("tag"))

    def ended(e, stop, end):
        return F.struct(e["start"].alias("start"), e["inner"].alias("inner"), stop.alias("stop"), end.alias("end"),
                        e["tag"].alias("tag"), e["opening"].alias("opening"))

    def state(at, names, stack, out):
        return F.struct(at.alias("at"), names.alias("names"), stack.alias("stack"), out.alias("out"))

    def step(acc, t):
        at, names, stack, out = (acc[x] for x in ("at", "names", "stack", "out"))
        after, inner = at + t["size"], at + t["own"]
        opened = F.struct(at.alias("start"), inner.alias("inner"), t["name"].alias("tag"), t["tag"].alias("opening"))
        empty = F.struct(at.alias("start"), inner.alias("inner"), inner.alias("stop"), inner.alias("end"),
                         t["name"].alias("tag"), t["tag"].alias("opening"))
        depth = F.array_position(names, t["name"]).cast("int")
        popped = F.transform(F.slice(stack, F.lit(1), depth), lambda e, i: ended(
            e, at, F.when(e["tag"] == t["name"], inner).otherwise(at)))  # the one it closes is the only one of its name
        return (F.when(t["kind"] == _START, state(after, F.concat(F.array(t["name"]), names), F.concat(F.array(opened), stack), out))
                .when((t["kind"] == _CLOSE) & (F.get(names, F.lit(0)) == t["name"]),
                      state(after, F.slice(names, F.lit(2), F.size(names)), F.slice(stack, F.lit(2), F.size(stack)),
                            F.concat(out, F.array(ended(F.get(stack, F.lit(0)), at, inner)))))
                .when((t["kind"] == _CLOSE) & (depth > 0),
                      state(after, F.slice(names, depth + 1, F.size(names)), F.slice(stack, depth + 1, F.size(stack)),
                            F.concat(out, popped)))
                .when(t["kind"] == _EMPTY, state(after, names, stack, F.concat(out, F.array(empty))))
                .otherwise(state(after, names, stack, out)))

    def finish(acc):
        left = F.transform(acc["stack"], lambda e: ended(e, acc["at"], acc["at"]))
        return F.sort_array(F.concat(acc["out"], left))

    texts, own, names = (F.regexp_extract_all(html, F.lit(_tokens(tags)), F.lit(i)) for i in range(3))
    tokens = F.zip_with(texts, F.arrays_zip(own.alias("tag"), names.alias("name")), token)
    zero = state(F.lit(0), F.array().cast("array<string>"), F.array().cast(f"array<{_OPEN}>"), F.array().cast(f"array<{_ELEMENT}>"))
    return F.aggregate(tokens, zero, step, finish)


def attribute_of(element: Column, name: str) -> Column:
    """An attribute of an element, references decoded; null when it has none."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(element["opening"], pattern, i) for i in (1, 2, 3)])
    return F.when(element["opening"].rlike(pattern), unescape(value))


def _is(element: Column, attribute: str, value: str) -> Column:
    """Whether an element has this value of an attribute; of a class, whether it is one of its classes."""
    found = attribute_of(element, attribute)
    same = F.array_contains(F.split(normalise(found), " "), F.lit(value)) if attribute == "class" else found == value
    return F.contains(element["opening"], F.lit(value)) & F.coalesce(same, F.lit(False))


def find_all(elements: Column, tag: str = None, within: Column = None, **attributes) -> Column:
    """Elements of a tag, inside another one, with the given attributes, in page order. ``_`` stands for ``-`` in names."""
    def wanted(e):
        good = F.lit(True) if tag is None else e["tag"] == tag
        if within is not None:
            good = good & (e["start"] >= within["inner"]) & (e["end"] <= within["stop"])
        for name, value in attributes.items():
            good = good & _is(e, name.replace("_", "-").rstrip("-"), value)
        return good
    return F.filter(elements, wanted)


def find(elements: Column, tag: str = None, within: Column = None, **attributes) -> Column:
    """The first such element, null if there is none."""
    return F.get(find_all(elements, tag, within, **attributes), F.lit(0))


def inner_html(html: Column, element: Column) -> Column:
    return F.substring(html, element["inner"] + 1, element["stop"] - element["inner"])


def whole_text(html: Column, element: Column) -> Column:
    """All text in an element, references decoded."""
    return whole_text_of(inner_html(html, element))


def text(html: Column, element: Column) -> Column:
    """All text in an element, ends stripped."""
    return strip(whole_text(html, element))
