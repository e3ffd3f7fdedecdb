"""Main text of web pages by wrapper induction: what all pages of a host share is its template, what varies is content.

Every page becomes a tree of its block elements, without those that never hold an article (menus, footers, forms, scripts,
...: the fixed lists below), runs of like siblings folded into one node. The trees of a host's pages are aligned by simple tree
matching and merged into its wrapper. A node of a wrapper knows the texts that all pages with this node have in it, how much of
its text is linked, and up to ``SUPPORT`` different pages it was found on. Merging is associative: tasks merge the pages they
read, then the wrappers of a host are merged in two rounds, so a host with a third of all pages is no task's burden.

To extract, a page's tree is aligned with its host's wrapper. Texts that are constant in a node around them are template and go; so do
lists that are mostly links, where a page names no article or main part of its own; every other text is content, in page order.
"""

from __future__ import annotations

import functools
import html as references
import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A text is template where so many different pages at least have it; pages are told apart by their longest text.
SUPPORT = 6
#: Siblings from which all of one kind are folded together; depth below which elements are not told apart; likeness to be folded.
SIBLINGS, DEPTH, LIKENESS = 48, 60, 0.6
#: Share of linked text from which a list is a menu.
LINKED = 0.75
#: Nodes a task holds before it sends its wrappers on; shards of a host's wrappers in the first round; bytes that are broadcast.
HELD, SHARDS, SENT = 200_000, 64, 16_000_000

# HTML's elements by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre search section summary table tbody td
    tfoot th thead tr ul caption""".split())
BREAKS = BLOCKS | {"br", "hr"}
NEVER = set("""nav aside footer script style noscript template iframe object embed svg canvas button select textarea dialog menu head
    title audio video map applet noembed noframes xmp datalist search""".split())
REGIONS = {"article", "main"}
CLOSED_BY = {  # an element that starts ends these, up to those
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
# Words in class names, identifiers and roles of parts that are not the article.
READERS = set("comment comments commentlist disqus reply replies respond discussion".split())
ASIDES = set("related recommended recommendations teaser teasers sidebar widget widgets aside complementary".split())
PARTS = READERS | ASIDES | set("""nav navbar navigation menu menus menubar topbar toolbar breadcrumb breadcrumbs footer contentinfo header
    masthead banner notice notices cookie cookies consent gdpr alert popup modal overlay ad ads adv advert adverts advertisement
    advertising sponsor sponsored promo promotion share sharing social newsletter subscribe subscription signup login search
    pagination pager skip copyright""".split())
#: Words before which a part's name says how the page is laid out, not what the element is.
LAYOUT = {"has", "with", "no", "without", "is", "hide", "show", "open", "closed"}

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*|[^>]*)>|[!?/][^>]*(?:>|\Z))""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}


@functools.lru_cache(maxsize=10_000)
def _tags_of(names: frozenset) -> re.Pattern:
    """Comments, raw elements and the tags of these elements alone: what can end a part that holds no content."""
    named = "|".join(sorted(names | RAW))
    return re.compile(rf"""<(?:!--.*?(?:-->|\Z)|(/?)({named})(?=[\s/>])([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*|[^>]*)>)""", re.S | re.I)


class Node:
    """A node of a page or wrapper. ``texts``: hashes of the texts in it; of a wrapper, of those that all its pages have in it."""

    __slots__ = ("label", "texts", "seen", "pages", "chars", "linked", "links", "children", "into")

    def __init__(self, label, texts=(), seen=(), pages=1, chars=0, linked=0, links=0, children=()):
        self.label, self.texts, self.seen, self.pages = label, set(texts), set(seen), pages
        self.chars, self.linked, self.links, self.children, self.into = chars, linked, links, list(children), None

    def plain(self):
        return (self.label, tuple(self.texts), tuple(self.seen), self.pages, self.chars, self.linked, self.links,
                tuple(c.plain() for c in self.children))

    @classmethod
    def of(cls, plain):
        return cls(*plain[:7], [cls.of(c) for c in plain[7]])

    def walk(self):
        yield self
        for child in self.children:
            yield from child.walk()

    def size(self):
        return 1 + sum(c.size() for c in self.children)

    def shape(self):
        return f"{self.label}({''.join(c.shape() for c in self.children)})" if self.children else f"{self.label};"


def matching(a: Node, b: Node) -> int:
    """Nodes of the largest matching of two trees that keeps order and ancestry (simple tree matching)."""
    if a.label != b.label:
        return 0
    return 1 + (_table(a.children, b.children)[-1][-1] if a.children and b.children else 0)


def _table(xs: list[Node], ys: list[Node]) -> list[list[int]]:
    rows = [[0] * (len(ys) + 1)]
    for x in xs:
        above, row = rows[-1], [0]
        for j, y in enumerate(ys):
            best = max(above[j + 1], row[j])
            if x.label == y.label:
                best = max(best, above[j] + matching(x, y))
            row.append(best)
        rows.append(row)
    return rows


def aligned(xs: list[Node], ys: list[Node]) -> list[tuple[Node | None, Node | None]]:
    """Children of two matched nodes in order: pairs that are matched, and the rest by themselves."""
    if [x.label for x in xs] == [y.label for y in ys] and len({x.label for x in xs}) == len(xs):
        return list(zip(xs, ys, strict=True))
    rows, out, i, j = _table(xs, ys), [], len(xs), len(ys)
    while i or j:
        if i and j and xs[i - 1].label == ys[j - 1].label and rows[i][j] > max(rows[i - 1][j], rows[i][j - 1]):
            i, j = i - 1, j - 1
            out.append((xs[i], ys[j]))
        elif j and (not i or rows[i][j] == rows[i][j - 1]):
            j -= 1
            out.append((None, ys[j]))
        else:
            i -= 1
            out.append((xs[i], None))
    return out[::-1]


def merge(a: Node, b: Node, within: bool) -> Node:
    """``b`` into ``a``: parts of one page are added up (``within``), those of different pages keep the texts they share."""
    a.texts = a.texts | b.texts if within else a.texts & b.texts
    a.seen = set(sorted(a.seen | b.seen)[:SUPPORT])
    a.pages = a.pages if within else a.pages + b.pages
    a.chars, a.linked, a.links = a.chars + b.chars, a.linked + b.linked, a.links + b.links
    a.children = [x if y is None else y if x is None else merge(x, y, within) for x, y in aligned(a.children, b.children)]
    if within:
        b.into = a
    if len(a.children) > SIBLINGS:
        _fold_all(a)
    return a


def _fold_all(node: Node) -> None:
    kinds: dict[str, Node] = {}
    for child in node.children:
        if child.label in kinds:
            merge(kinds[child.label], child, True)
        else:
            kinds[child.label] = child
    node.children = list(kinds.values())


def fold(node: Node) -> None:
    """Neighbouring children of one kind whose trees are alike become one."""
    out: list[Node] = []
    for child in node.children:
        last = out[-1] if out else None
        if last is not None and last.label == child.label and (
                not (last.children or child.children)
                or 2 * matching(last, child) >= LIKENESS * (last.size() + child.size())):
            merge(last, child, True)
        else:
            out.append(child)
    node.children = out
    if len(out) > SIBLINGS:
        _fold_all(node)


def part_of(tag: str, attributes: str, in_region: bool) -> str | None:
    """What kind of part an element is, if it may not belong to the article: never, readers, aside or part."""
    if tag in NEVER:
        return "never"
    if tag == "form":
        return "part"
    if tag == "header":
        return None if in_region else "part"
    if tag in ("html", "body", "main") or not attributes:
        return None
    kind = None
    for name, *values in _NAMES.findall(attributes):
        for word in "".join(values).split():
            pieces = [p.lower() for p in _PIECES.findall(word)]
            found = [p for p in pieces if p in PARTS]
            if not found or pieces[0] in LAYOUT:
                continue
            if any(p in READERS for p in found):
                return "readers"
            if in_region and found == ["header"]:
                continue
            kind = "aside" if kind == "aside" or any(p in ASIDES for p in found) else "part"
    return kind


class Page:
    """A parsed page: its candidates for content in page order, and the tree of the elements that hold them."""

    def __init__(self, html: str):
        self.blocks: list[list] = []  # text, node, parts it lies in, whether in a region, linked characters, links
        self.root = Node("html")
        self._parse(html)
        self._choose()

    def _parse(self, html: str) -> None:
        stack = [["html", self.root, (), False]]  # tag, node, parts, in a region
        parts: list[str] = []
        held, linked, links, in_link, at = [], 0, 0, False, 0

        def ended():
            nonlocal held, linked, links
            text = " ".join("".join(held).split()) if held else ""
            if text:
                _, node, own, region = stack[-1]
                self.blocks.append([text, node, own, region, linked, links])
            held, linked, links = [], 0, 0

        def said(text):
            nonlocal linked
            text = references.unescape(text) if "&" in text else text
            held.append(text)
            if in_link:
                linked += len(text.strip())

        never = 0  # the depth of the stack at which a part that is never content began
        tags = _TAG
        while True:
            found = tags.search(html, at)
            if found is None:
                if not never:
                    said(html[at:])
                break
            start, end = found.span()
            if start > at and not never:
                said(html[at:start])
            at = end
            closing, tag, attributes = found.group(1, 2, 3)
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                if tag == "a":
                    in_link = False
                depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == tag), 0)
                if depth:
                    if not never:
                        ended()
                    del stack[depth:]
                    if depth <= never:
                        never, tags = 0, _TAG
                elif tag in BREAKS and not never:
                    ended()
                continue
            if tag in RAW and not attributes.endswith("/"):
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else len(html)
                if tag in BREAKS and not never:
                    ended()
                continue
            if tag in VOID:
                if tag in BREAKS and not never:
                    ended()
                continue
            if tag in BLOCKS:
                if not never:
                    ended()
                ends = None
                if stack[-1][0] == "p":
                    ends = len(stack) - 1
                if tag in CLOSED_BY:
                    closes, until = CLOSED_BY[tag]
                    for d in range(len(stack) - 1, 0, -1):
                        if stack[d][0] in until:
                            break
                        if stack[d][0] in closes:
                            ends = d
                if ends:
                    del stack[ends:]
                    if ends <= never:
                        never, tags = 0, _TAG
                if tag in ("html", "body") and len(stack) > 1:
                    continue
            _, node, own, region = stack[-1]
            if tag == "a":
                in_link = True
                links += 1
            if never:
                stack.append([tag, node, own, region])
                continue
            kind = part_of(tag, attributes, region)
            if tag in REGIONS and own and kind is None:
                own = tuple(p for p in own if tag != "main" and parts[p] in ("readers", "aside"))
            if kind == "never":
                stack.append([tag, node, own, region])
                never, tags = len(stack) - 1, _tags_of(frozenset(x[0] for x in stack))
                continue
            if tag not in BLOCKS and kind is None:
                continue
            if tag not in BLOCKS:  # a named part inside a line
                ended()
            if kind is not None:
                parts.append(kind)
                own = (*own, len(parts) - 1)
            if len(stack) <= DEPTH and tag not in ("html",):
                child = Node(tag if kind is None else f"{tag}.{kind}")
                node.children.append(child)
                node = child
            stack.append([tag, node, own, region or (tag in REGIONS and kind is None)])
        ended()
        self.parts = parts

    def _choose(self) -> None:
        """Leave out what lies in parts other than the article; a part with most of the text is none, unless readers wrote it."""
        total, within = 0, [0] * len(self.parts)
        for text, _, own, *_ in self.blocks:
            total += len(text)
            for p in own:
                within[p] += len(text)
        out = {p for p, kind in enumerate(self.parts) if kind == "readers" or 2 * within[p] <= total}
        blocks = [b for b in self.blocks if not out.intersection(b[2])]
        regions = [b for b in blocks if b[3]]
        self.region = bool(regions)
        self.blocks = regions or blocks
        self.hashes = [xxhash.xxh3_64_intdigest(b[0].encode("utf-8", "replace")) for b in self.blocks]
        longest = max(zip(map(len, (b[0] for b in self.blocks)), self.hashes, strict=True), default=(0, 0))[1]
        for (text, node, _, _, linked, links), mark in zip(self.blocks, self.hashes, strict=True):
            node.texts.add(mark)
            node.chars, node.linked, node.links = node.chars + len(text), node.linked + linked, node.links + links
        self._prune(self.root, {longest})

    def _prune(self, node: Node, seen: set) -> bool:
        node.children = [c for c in node.children if self._prune(c, seen)]
        node.seen = set(seen)
        node.texts.update(*(c.texts for c in node.children))
        fold(node)
        return bool(node.texts)

    def node_of(self, block) -> Node:
        node = block[1]
        while node.into is not None:
            node = node.into
        return node


def _zip(a: Node, b: Node) -> None:
    """Merge two trees of one shape, node by node."""
    a.texts &= b.texts
    if len(a.seen) < SUPPORT:
        a.seen |= b.seen
    a.pages, a.chars, a.linked, a.links = a.pages + b.pages, a.chars + b.chars, a.linked + b.linked, a.links + b.links
    for x, y in zip(a.children, b.children, strict=True):
        _zip(x, y)


def _joined(trees) -> Node:
    """The wrapper of several trees, the largest first, so that the others find their places in it."""
    trees = sorted(trees, key=lambda t: (-t.pages, t.shape()))
    wrapper = trees[0]
    for tree in trees[1:]:
        merge(wrapper, tree, False)
    return wrapper


_NAMES_OUT = ["host", "shard", "pages", "wrapper"]
_SCHEMA = "host string, shard int, pages long, wrapper binary"


def _sent(found):
    rows = list(found)
    for at in range(0, len(rows), 200):
        some = rows[at:at + 200]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in some], pa.string()), pa.array([r[1] for r in some], pa.int32()),
             pa.array([r[2].pages for r in some], pa.int64()),
             pa.array([pickle.dumps(r[2].plain(), protocol=5) for r in some], pa.binary())], _NAMES_OUT)


def _partial(shards: int, most: int):
    """The wrappers of the pages a task reads, by host; pages whose trees have one shape are merged node by node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, nodes = TaskContext.get().partitionId() % shards, {}, 0
        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                tree = Page(html.as_py() or "").root
                shapes, shape = held.setdefault(host, {}), tree.shape()
                if shape in shapes:
                    _zip(shapes[shape], tree)
                else:
                    shapes[shape] = tree
                    nodes += tree.size() + sum(len(n.texts) for n in tree.walk())
                if nodes > most:
                    yield from _sent((h, shard, _joined(s.values())) for h, s in held.items())
                    held, nodes = {}, 0
        yield from _sent((h, shard, _joined(s.values())) for h, s in held.items())
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers sorted by host and shard to one each."""
    key, wrapper = None, None
    for batch in batches:
        for host, shard, data in zip(batch.column("host").to_pylist(), batch.column("shard").to_pylist(), batch.column("wrapper"), strict=True):
            tree = Node.of(pickle.loads(data.as_buffer()))
            if (host, shard) == key:
                wrapper = merge(wrapper, tree, False)
            else:
                if key is not None:
                    yield from _sent([(*key, wrapper)])
                key, wrapper = (host, shard), tree
    if key is not None:
        yield from _sent([(*key, wrapper)])


class _Wrapper:
    """A host's wrapper, ready for extraction: per shape of page, which texts are template and which nodes are menus."""

    def __init__(self, data: bytes):
        self.root, self.shapes = Node.of(pickle.loads(data)), {}

    def _visit(self, node: Node, own: Node | None, template: frozenset, menu: bool, out: list) -> None:
        if own is not None:
            if node.label not in ("html", "body"):
                chars, linked, links = (sum(getattr(n, k) for n in own.walk()) for k in ("chars", "linked", "links"))
                menu = menu or (links >= 2 * own.pages and linked >= LINKED * chars)
            template = template | own.texts if len(own.seen) >= SUPPORT else template
        out.append((template, menu))
        pairs = aligned(node.children, own.children) if own is not None else [(c, None) for c in node.children]
        for x, y in pairs:
            if x is not None:
                self._visit(x, y, template, menu, out)

    def rules(self, root: Node) -> list:
        """For the nodes of a page in order: the template's texts, and whether a menu."""
        shape = root.shape()
        if shape not in self.shapes:
            if len(self.shapes) > 1_000:
                self.shapes.clear()
            out: list = []
            self._visit(root, self.root, frozenset(), False, out)
            self.shapes[shape] = out
        return self.shapes[shape]


def main_text(html: str | None, wrapper: _Wrapper | None = None) -> str:
    """The content of a page: candidates that its host's wrapper does not tell to be template or menu."""
    page = Page(html or "")
    if wrapper is None:
        return " ".join(b[0] for b in page.blocks)
    rules = dict(zip(map(id, page.root.walk()), wrapper.rules(page.root), strict=True))
    kept = []
    for block, mark in zip(page.blocks, page.hashes, strict=True):
        texts, menu = rules[id(page.node_of(block))]
        if mark not in texts and (page.region or not menu):
            kept.append(block[0])
    return " ".join(kept)


def _extract(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, _Wrapper] = {}
        for batch in batches:
            texts = []
            for host, html, data in zip(batch.column("__host").to_pylist(), batch.column("__html"), batch.column("__wrapper"), strict=True):
                wrapper = known.get(host)
                if wrapper is None and data.is_valid:
                    if len(known) > 500:
                        known.clear()
                    wrapper = known[host] = _Wrapper(data.as_buffer())
                texts.append(main_text(html.as_py(), wrapper))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(texts, pa.string()),
                                              pa.array(list(map(len, texts)), pa.int64())], [*columns, "text", "n_chars"])
    return run


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user and port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def induce(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """Per host that pages name: host, pages, wrapper (bytes). All pages count, whatever their number."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).where("host <> ''")
    first = rows.mapInArrow(_partial(SHARDS, HELD), _SCHEMA).repartition("host", "shard").sortWithinPartitions("host", "shard")
    first = first.mapInArrow(_merged, _SCHEMA).withColumn("shard", F.lit(0))
    last = first.repartition("host").sortWithinPartitions("host").mapInArrow(_merged, _SCHEMA)
    return stored(last.drop("shard"), "wrappers")


def extract(pages: DataFrame, wrappers: DataFrame, *, html: str = "html", url: str = "url", keep: tuple = ("page_id", "url")) -> DataFrame:
    """``keep``, text and n_chars of every page.

    A text is one line per page: the texts of its blocks, white space as one blank, references decoded, joined by a blank. Null
    and empty pages, and pages without an article, have the empty text. A page whose address names no host, and hosts of which
    fewer than ``SUPPORT`` different pages are known, have no template: only the fixed rules hold. Pages that repeat are each
    extracted. Elements left open end with the page. An empty table gives an empty result.
    """
    rows = pages.select(*keep, host_of(F.col(url)).alias("__host"), F.col(html).alias("__html"))
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host")), F.lit(0)).alias("bytes"),
                        F.coalesce(F.sum("pages"), F.lit(0)).alias("pages")).first()
    side = wrappers.select(F.col("host").alias("__of"), F.col("wrapper").alias("__wrapper"), "pages")
    on = F.col("__host") == F.col("__of")
    if size["bytes"] <= SENT:
        joined = rows.join(F.broadcast(side), on, "left")
    else:  # fewer than 200 hosts have more than half a percent of all pages each; pages without a host meet nothing
        hot = F.col("pages") > size["pages"] // 200
        large = rows.join(F.broadcast(side.where(hot)), on, "left")
        rest = large.where("__wrapper is null and __host <> ''").drop("__of", "__wrapper", "pages")
        joined = (large.where("__wrapper is not null or __host = ''")
                  .unionByName(rest.join(side.where(~hot), on, "left")))
    joined = joined.select(*keep, "__host", "__html", "__wrapper")
    kept = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return joined.mapInArrow(_extract(list(keep)), f"{kept}, text string, n_chars long")


def page_texts(pages: DataFrame, *, html: str = "html", url: str = "url", keep: tuple = ("page_id", "url")) -> DataFrame:
    """The main texts of pages, by the wrappers of their own hosts."""
    return extract(pages, induce(pages, html=html, url=url), html=html, url=url, keep=keep)
