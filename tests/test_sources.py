import pytest
from pyspark.sql import functions as F

from indicatrix.functions import dom, html as H
from indicatrix.sources import delimited as DL, pages as W, payloads as P, snapshots as N

from fixtures import rows


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_read_table(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'Code,A,A\r\n1,"x\ny",z\r\n', "utf-8-sig")
    df = DL.read_table(spark, path)
    assert df.columns[0] == "Code" and len(set(df.columns)) == 3
    assert rows(df) == [("1", "x\ny", "z")]
    assert DL.read_table(spark, path, infer=True).schema["Code"].dataType.simpleString() == "int"
    with pytest.raises(ValueError, match="CSV"):
        DL.read_table(spark, "book.xlsx")
    with pytest.raises(ValueError, match="txt"):
        DL.read_table(spark, "book.txt")


def test_read_sheet(spark, tmp_path):
    path = write(tmp_path / "s.csv", 'Banner,,\n,,\n"1.\nSociety (S)", Two ,\n,,\nx,"a,b",\ny,c,d\n', "utf-8-sig")
    df = DL.read_sheet(spark, path, header_line=2, first_line=4, numbered=True)
    assert df.columns == ["Society (S)", "Two", "unnamed_2"]
    assert rows(df) == [("x", "a,b", None), ("y", "c", "d")]
    assert DL.read_sheet(spark, path, 2, 4, first_column=1, last_column=2).columns == ["Two"]
    write(tmp_path / "u.csv", "a,b\n")
    with pytest.raises(ValueError, match="single file"):
        DL.read_sheet(spark, str(tmp_path / "*.csv"), 0, 1)


def test_nested_payload(spark, tmp_path):
    write(tmp_path / "p.json", """{"data": [
      {"id": "k", "years": "all", "data": [{"id": "D1", "data": [{"year": 2020, "value": true}, {"year": 2021, "value": 7}]},
                                           {"id": "D2", "data": []}]},
      {"id": "m", "years": "all", "data": []}]}""")
    payload = P.read_json(spark, str(tmp_path / "p.json"), P.NESTED_SCHEMA)
    assert rows(P.flatten_nested(payload)) == sorted([
        ("k", "D1", 2020, "true"), ("k", "D1", 2021, "7"), ("k", "D2", None, None), ("m", None, None, None)], key=repr)
    write(tmp_path / "q.json", '{"data": [{"id": "k", "years": "a", "data": []}, {"id": "l", "years": "b", "data": []}]}')
    with pytest.raises(Exception, match="Unexpected values in years"):
        P.flatten_nested(P.read_json(spark, str(tmp_path / "q.json"), P.NESTED_SCHEMA)).collect()


def test_documents_object_or_array(spark, tmp_path):
    write(tmp_path / "1.json", '[{"code": "D1", "documents": [{"name": "n", "document_type": "t", "year": 2020, "url": "u"}]}]')
    write(tmp_path / "2.json", '{"code": "D2", "documents": [{"name": "m", "document_type": "t", "year": 2021, "url": "v"}]}')
    df = P.flatten_documents(P.read_json(spark, str(tmp_path), P.DOCUMENTS_SCHEMA))
    assert rows(df, "entity_id", "url") == [("D1", "u"), ("D2", "v")]


def test_pages_and_maps_and_csv(spark):
    pages = spark.createDataFrame([([(1, "a"), (2, "b")],), ([(3, "c")],)], "results array<struct<id: int, n: string>>")
    assert rows(P.page_results(pages)) == [(1, "a"), (2, "b"), (3, "c")]
    maps = spark.createDataFrame([('{"137506": {"AFG": {"2010": 0.5, "2011": 0.6}, "ALB": {}}}',)], "body string")
    assert rows(P.flatten_maps(maps, "body")) == [("137506", "AFG", "2010", 0.5), ("137506", "AFG", "2011", 0.6)]
    csv = spark.createDataFrame([('n,y\nstring,number\n"a ""b""\nc, d",1,extra\n\r\nlast,2\n',)], "csv string")
    assert rows(P.embedded_csv(csv, "csv", "n STRING, y INT")) == [('a "b"\nc, d', 1), ("last", 2)]


def test_metadata_and_rows_pages(spark, tmp_path):
    write(tmp_path / "p1.json", '[{"page": 1, "pages": 2},\n [{"date": "2020", "value": 1.5, "country": {"id": "A"}}, {"date": "2021", "value": null}]]')
    write(tmp_path / "p2.json", '[{"page": 2, "pages": 2}, [{"date": "2022", "value": 3}]]')
    df = P.page_element_rows(P.read_page_texts(spark, str(tmp_path)), "value",
                             "date STRING, value DOUBLE, country STRUCT<id: STRING>")
    assert rows(df, "date", "value", "country.id") == sorted([
        ("2020", 1.5, "A"), ("2021", None, None), ("2022", 3.0, None)], key=repr)
    cut = spark.createDataFrame([('[{"page": 1}, [{"date": "2020"',)], "value string")
    with pytest.raises(Exception):
        P.page_element_rows(cut, "value", "date STRING").collect()


def test_snapshot_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ("x", [1, 2]))], "id int, s struct<a: string, b: array<int>>")
    N.write_snapshot(df, str(tmp_path), "raw")
    back = N.read_snapshot(spark, str(tmp_path), "raw")
    assert back.schema.simpleString() == df.schema.simpleString() and rows(back) == rows(df)


def html_column(spark, text):
    return spark.createDataFrame([("u", text)], "url string, html string")


def test_text_and_references(spark):
    df = html_column(spark, " <b>a</b> &amp;lt; &#233;&#xE9; &nbsp;&#38;lt; &bogus; &#99999999; ")
    assert df.select(H.text_of(F.col("html"))).first()[0] == "a &lt; éé  &lt; &bogus; &#99999999;"


def test_inert_and_links_and_paragraphs(spark):
    df = html_column(spark, """<script>var t="</p><a href='no'>";</script><!-- <a href="no2"> --><p>one<b> x</b><p class="q">two &amp; three</p>tail
      <a class="k" href='/1'>1</a><a>none</a><A HREF="/2?a&amp;b">2</A>""")
    clean = H.without_inert(F.col("html"))
    assert df.select(H.links(clean)).first()[0] == ["/1", "/2?a&b"]
    assert df.select(H.paragraphs(clean)).first()[0] == ["one x", "two & three"]


def test_block_is_balanced(spark):
    df = html_column(spark, """<div class="a"><div class="x want y">1<div>2<div>3</div></div>4</div>5</div><div class="want">6</div>""")
    assert H.with_block(df, "html", "b", "div", "class", "want").first()["b"] == "1<div>2<div>3</div></div>4"
    assert H.with_block(df, "html", "b", "div", "class", "wan").first()["b"] is None
    at_start = html_column(spark, "<div class='want'>in</div>out")
    assert H.with_block(at_start, "html", "b", "div", "class", "want").first()["b"] == "in"
    unclosed = html_column(spark, "<div class='want'>in<div>more")
    assert H.with_block(unclosed, "html", "b", "div", "class", "want").first()["b"] == "in<div>more"


def test_download_link_count_is_checked(spark):
    good = """<div class="download-links"><div class="download-links__links-content"><a href="/f.pdf">f</a></div></div>"""
    assert rows(W.download_links(html_column(spark, good))) == [("u", "/f.pdf")]
    for bad in (good.replace("<a", "<a href='/2'>2</a><a"), "<p>nothing</p>"):
        with pytest.raises(Exception, match="Expected one download link at u"):
            W.download_links(html_column(spark, bad)).collect()


def test_presence_and_law_pages(spark):
    listing = html_column(spark, """<ul class="list"><li class="item">Elsewhere</li></ul><div id="blockRegionalList">
      <ul class="list"><li class="item keyOperations"> <a href="/afg">Afghanistan</a> </li><li class="item">Albania</li>
      <li class="other">x</li></ul></div>""")
    assert rows(W.presence_listing(listing)) == sorted([
        ("Afghanistan", True, "/afg", True), ("Albania", False, None, False)], key=repr)
    intro = html_column(spark, '<div class="block-introduction"><div class="i"><h2>T</h2><p>The <b>text</b> </p></div></div>')
    assert rows(W.introductions(intro)) == [("u", "The text")]
    assert rows(W.introductions(html_column(spark, "<p>no</p>"))) == [("u", None)]
    options = html_column(spark, """<select data-drupal-selector="edit-country"><option value="All">Any</option>
      <option value="11">Albania</option><option value="921"> Twice </option><option value="12">Twice</option></select>""")
    assert rows(W.law_listing(options, "node/", [("Twice", "921")])) == [
        ("Albania", "11", "node/11"), ("Twice", "12", "node/12")]
    details = html_column(spark, """<p>no</p><div class="field--name-field-paragraphs"><div><p>a</p></div><p>b</p></div><p>no</p>""")
    assert rows(W.law_descriptions(details)) == [("u", "a\nb")]
    assert rows(W.law_descriptions(html_column(spark, "<p>no</p>"))) == [("u", None)]


def test_character_references(spark):
    from html import unescape
    from indicatrix.functions import html as H
    texts = ["&uuml;&euro;&ntilde; a", "&copy 2020 &copyright", "&amp;lt; &#38;lt; &#x41&#66;", "&nothing; & &; &&amp;", "plain",
             "&NotEqualTilde;&hellip;&AMP;", "R&D &lt", "&#8364;5 &#128512;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(H.unescape(F.col("t"))).collect()] == [unescape(t) for t in texts]


def test_listing_scope(spark):
    from indicatrix.sources import pages as W
    row = "<tr><td data-label='Title'><a href='/e'>&Uuml;ber</a></td><td data-label='Location'>A</td></tr>"
    def page(inner):
        return spark.createDataFrame([(f"<table class='views-table'><thead>{row}</thead>{inner}</table>",)], "html string")
    got = W.evaluation_listing(page(f"<tbody>{row}</tbody>"), "h").collect()
    assert [(r.title, r.country, r.url) for r in got] == [("Über", "A", "h/e")]
    with pytest.raises(Exception, match="without a Title"):
        W.evaluation_listing(page("<tbody><tr><td data-label='Location'>A</td></tr></tbody>"), "h").collect()
    lists = "<div id='blockRegionalList'><ul class='list x'><li class='item'>In</li></ul><ul><li class='item'>Out</li></ul></div>"
    assert [r.country for r in W.presence_listing(spark.createDataFrame([(lists,)], "html string")).collect()] == ["In"]


def test_paragraphs_keep_their_blanks(spark):
    from indicatrix.functions import html as H
    df = spark.createDataFrame([("<p> a <b>b</b> </p><p>c",)], "h string")
    assert df.select(H.paragraphs(F.col("h"))).first()[0] == [" a b ", "c"]


def test_evaluation_chain_stands_once_in_the_plan(spark):
    from fixtures import registry
    from indicatrix.plans import datasets as D
    raw = spark.createDataFrame([("Albania, Global", "t")], "country string, title string")
    plan = D.evaluations(raw, registry(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Palestinian Territory") <= 1


def element_rows(spark, html, tags=None):
    table = html_column(spark, html).select("html", F.explode(dom.element_table(F.col("html"), tags)).alias("e"))
    return [tuple(r) for r in table.select("e.tag", dom.inner_html(F.col("html"), F.col("e"))).collect()]


def test_elements_at_their_true_depth(spark):
    html = """x < y<ul class="list"><li class="item">A<ul><li>sub</li></ul></li><LI class='item x' title="1>2">B<br>c</LI></ul></i><p>é<p>z"""
    assert element_rows(spark, html) == [
        ("ul", """<li class="item">A<ul><li>sub</li></ul></li><LI class='item x' title="1>2">B<br>c</LI>"""),
        ("li", "A<ul><li>sub</li></ul>"), ("ul", "<li>sub</li>"), ("li", "sub"), ("li", "B<br>c"), ("br", ""),
        ("p", "é<p>z"), ("p", "z")]
    assert element_rows(spark, html, ["li"]) == [("li", "A<ul><li>sub</li></ul>"), ("li", "sub"), ("li", "B<br>c")]
    assert element_rows(spark, "<div><ul><li>a</div>b</li>") == [("div", "<ul><li>a"), ("ul", "<li>a"), ("li", "a")]
    assert element_rows(spark, "") == [] == element_rows(spark, None) == element_rows(spark, "no tags")


def test_many_nested_elements(spark):
    deep = "<div>" * 300 + "x" + "</div>" * 300
    assert [t for _, t in element_rows(spark, deep, ["div"])][-2:] == ["<div>x</div>", "x"]
    wide = "<ul>" + "<li>a<b>c</b></li>" * 2_000 + "</ul>"
    found = element_rows(spark, wide)
    assert len(found) == 4_001 and found[-2:] == [("li", "a<b>c</b>"), ("b", "c")]


def test_nested_lists_lose_no_item(spark):
    pages = html_column(spark, """<div id="blockRegionalList"><ul class="list"><li class="item"><a href="/a?x&amp;y">A</a><ul><li>sub</li></ul></li>
      <li class="item keyOperations">B<ul class="list"><li class="item">C</li></ul></li></ul></div>""")
    assert rows(W.presence_listing(pages), "country", "url", "key_operation") == sorted([
        ("Asub", "/a?x&y", False), ("BC", None, True), ("C", None, False), ("C", None, False)], key=repr)
