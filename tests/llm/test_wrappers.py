"""Main texts of pages whose article is known, and wrappers that do not depend on how pages are dealt."""

import pickle
import random

import pytest

from indicatrix.llm.wrappers import Node, Page, aligned, induce, main_text, matching, merge, page_texts

SCHEMA = "page_id long, url string, html string, text string, pages int"
WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt".split()


def sentence(r, n=12):
    return " ".join(r.choice(WORDS) for _ in range(n)) + f" {r.randint(0, 10**9)}."


def menu(r, n=5):
    return "<ul>" + "".join(f'<li><a href="/{i}">{r.choice(WORDS)} {r.randint(0, 99)}</a></li>' for i in range(n)) + "</ul>"


def named(i):
    """A page with an article element, and every kind of part around and in it."""
    r = random.Random(i)
    title, first, second = sentence(r, 4), sentence(r), sentence(r, 20)
    page = f"""<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t="</p><article>x";</script></head>
      <body class="has-sidebar"><header><h1>The Site</h1>{menu(r)}</header><div class="cookie-notice">We use cookies {i}</div>
      <article class="post-{i}"><h1>{title}</h1><div class="share-buttons"><a href="#">Share</a></div>
      <p>Written for all readers</p><p><b>{first}<br><p>{second}</p>
      <form><label>Mail</label><input><button>Go</button></form><aside>{sentence(r)}</aside>
      <p>Caf&eacute; &amp;&#32;bar &#x41;&nbsp;end {i}</p><section id="comments"><p>{sentence(r, 90)}</p></section></article>
      <div class="sidebar">{sentence(r)}</div><!-- <article>no</article> --><footer>&copy; {i}</footer></body></html>"""
    return page, f"{title} {first} {second}"


def unnamed(i):
    """A page without article elements or telling names: template and content differ only in what varies."""
    r = random.Random(1000 + i)
    title, paragraphs = sentence(r, 5), [sentence(r, 15) for _ in range(2 + i % 4)]
    extra = f"<table><tr><td>{sentence(r)}<td>{sentence(r)}</table>" if i % 3 == 0 else ""
    cells = [c.split("<td>")[-1].replace("</table>", "") for c in extra.split("<td>")[1:]]
    page = f"""<html><body><div>Great Company Limited</div><div>{menu(r, 3 + i % 3)}</div>
      <div><h2>{title}</h2>{"".join(f"<p>{p}</p>" for p in paragraphs)}{extra}<p>Read more on our site</p></div>
      <div><span>All rights reserved</span></div></body></html>"""
    return page, " ".join([title, *paragraphs, *cells])


def rows():
    out, want = [], {}
    for i in range(40):
        page, text = named(i)
        out.append((i, f"https://user@A.example:80/{i}?q=1", page, "clash", 1))
        want[i] = f"{text} Café & bar A end {i}"
        page, text = unnamed(i)
        out.append((100 + i, f"http://b.example/{i}", page, "clash", 1))
        want[100 + i] = text
    return out, want


def test_matching_counts_nodes_in_order():
    def tree(spec):
        return Node(spec[0], children=[tree(c) for c in spec[1:]])
    a = tree(("div", ("h1",), ("ul", ("li",), ("li",)), ("p",)))
    b = tree(("div", ("ul", ("li",)), ("h1",), ("p",), ("p",)))
    assert matching(a, b) == 4 and matching(a, a) == 6 and matching(a, tree(("p",))) == 0
    pairs = [(x and x.label, y and y.label) for x, y in aligned(a.children, b.children)]
    assert [p for p in pairs if None not in p] == [("ul", "ul"), ("p", "p")]
    assert len([x for x, _ in pairs if x]) == 3 and len([y for _, y in pairs if y]) == 4


def test_texts_are_the_articles(spark):
    data, want = rows()
    out = page_texts(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert {r["page_id"]: r["text"] for r in out} == want
    assert all(r["n_chars"] == len(r["text"]) for r in out) and out[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}


@pytest.mark.parametrize("parts", [1, 7])
def test_large_wrappers_are_joined(spark, monkeypatch, parts):
    from indicatrix.llm import wrappers

    monkeypatch.setattr(wrappers, "SENT", 10)
    monkeypatch.setattr(wrappers, "HELD", 50)
    data, want = rows()
    out = wrappers.page_texts(spark.createDataFrame(data, SCHEMA).repartition(parts)).collect()
    assert {r["page_id"]: r["text"] for r in out} == want


def test_copies_are_no_template(spark):
    """Pages of one host that are copies of each other, or nearly, keep their text."""
    page, text = named(1)
    data = [(i, "http://c.example/", page.replace("cookies 1", f"cookies {i}"), "", 0) for i in range(30)]
    wanted = " ".join(["lorem ipsum", text, "Written", "for"])
    out = page_texts(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(out) == 30 and all(text.split(".")[0] in r["text"] and "Written for all readers" in r["text"] for r in out), wanted


def test_odd_pages(spark):
    pages = [None, "", "plain text", "<p>a<p>b", "<article>", "<article><p>x</p><nav>menu", "<script>never ends <p>x", "a < b &lt c",
             "<div class='ad'>buy</div><p>k</p><p>l l</p>", "<div>" * 5_000 + "deep" + "</div>" * 5_000, "<main><p>m</p></main><p>n</p>",
             '<a title="x>quote<p>y', "<table><tr><td>1<td>2<tr><td>3</table>", "<ul><li>one<li>two</ul>",
             "<p>" + "word " * 300_000 + "</p>", "<p>x</p><h2>y</h2>" * 5_000, "&#0;&#xD800;&bogus;"]
    want = ["", "", "plain text", "a b", "", "x", "", "a < b < c", "k l l", "deep", "m", None, "1 2 3", "one two",
            ("word " * 300_000).strip(), ("x y " * 5_000).strip(), "��&bogus;"]
    data = [(i, None if i % 2 else "no address", p, "", 0) for i, p in enumerate(pages)] * 2
    out = page_texts(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(out) == 2 * len(pages)
    for r in out:
        if want[r["page_id"]] is not None:
            assert r["text"] == want[r["page_id"]], r["page_id"]
    assert page_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_wrappers_do_not_depend_on_the_split(spark):
    data, _ = rows()

    def known(parts):
        out = {}
        for r in induce(spark.createDataFrame(data, SCHEMA).repartition(parts)).collect():
            tree = Node.of(pickle.loads(r["wrapper"]))
            out[r["host"]] = (r["pages"], sorted((n.label, tuple(sorted(n.texts)), n.pages) for n in tree.walk() if n.texts))
        return out
    assert known(1) == known(6) and set(known(1)) == {"a.example", "b.example"}


def test_merging_keeps_what_pages_share():
    trees = [Page(unnamed(i)[0]).root for i in range(8)]
    wrapper = trees[0]
    for tree in trees[1:]:
        wrapper = merge(wrapper, tree, False)
    assert wrapper.pages == 8 and main_text(None) == ""
