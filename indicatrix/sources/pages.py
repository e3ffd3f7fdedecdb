"""Landed web pages (``url``, ``html``) to rows.

Each page's elements are found once, at their true depth, in a column of their own; every field is then a filter of them.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dom, html as H
from ..functions.text import strip


def parsed(pages: DataFrame, block: tuple, *tags: str) -> DataFrame:
    """Pages with ``__html``, what the wanted block (tag, attribute, value) holds without scripts and comments, null where a page
    has none, and ``__elements``, the block's elements of these tags (all if none are given) in page order."""
    cleaned = pages.withColumn("__page", H.without_inert(F.col("html")))
    found = H.with_block(cleaned, "__page", "__html", *block).drop("__page")
    return found.withColumn("__elements", dom.element_table(F.col("__html"), tags or None))


def _find(tag: str = None, within: str = None, **attributes) -> Column:
    return dom.find(F.col("__elements"), tag, None if within is None else F.col(within), **attributes)


def _find_all(tag: str = None, within: str = None, **attributes) -> Column:
    return dom.find_all(F.col("__elements"), tag, None if within is None else F.col(within), **attributes)


def evaluation_listing(pages: DataFrame, home: str) -> DataFrame:
    """Rows of the listing table: one per ``<tr>`` in the body of a table of class views-table. A row without a Title raises."""
    table = parsed(pages, ("table", "class", "views-table"), "table", "tbody", "tr", "td", "a")
    body = table.withColumn("body", _find("tbody"))
    rows = body.select("__html", "__elements", F.explode(F.when(F.col("body").isNotNull(), _find_all("tr", "body"))).alias("row"))
    rows = rows.withColumn("cells", _find_all("td", "row"))
    rows = rows.withColumn("labels", F.transform("cells", lambda c: dom.attribute_of(c, "data-label")))

    def cell(label):
        return F.get("cells", F.nullif(F.array_position("labels", F.lit(label)), F.lit(0)).cast("int") - 1)
    message = F.concat(F.lit("Listing row without a Title: "), F.substring(dom.inner_html(F.col("__html"), F.col("row")), 1, 200))
    rows = rows.withColumn("title_cell", F.when(cell("Title").isNull(), F.raise_error(message)).otherwise(cell("Title")))
    labels = {"country": "Location", "categories": "Category", "evaluation_type": "Type", "organization": "Organization",
              "date": "Date", "management_response": "Management response"}
    link = dom.attribute_of(_find("a", "title_cell"), "href")
    texts = rows.select(dom.text(F.col("__html"), F.col("title_cell")).alias("title"), F.concat(F.lit(home), link).alias("url"),
                        *[dom.text(F.col("__html"), cell(label)).alias(c) for c, label in labels.items()])

    def listed(column):
        return F.transform(F.split(column, ","), strip).alias(column)
    return texts.select("country", "title", *[listed(c) for c in ("categories", "evaluation_type", "organization")],
                        "date", "management_response", "url")


def download_links(pages: DataFrame) -> DataFrame:
    """The single download link of each detail page. Another number of links is an error."""
    area = parsed(pages, ("div", "class", "download-links"), "div", "a")
    links = area.withColumn("links", _find("div", class_="download-links__links-content"))
    found = links.select("url", F.when(F.col("links").isNotNull(), _find_all("a", "links")).alias("anchors"))
    wrong = F.concat(F.lit("Expected one download link at "), F.col("url"))
    one = F.coalesce(F.size("anchors") == 1, F.lit(False))
    return found.select("url", F.when(one, dom.attribute_of(F.col("anchors")[0], "href"))
                        .otherwise(F.raise_error(wrong)).alias("document_url"))


def join_details(listing: DataFrame, details: DataFrame, how: str = "left", key: str = "url") -> DataFrame:
    """Listing rows with what was extracted from their detail pages."""
    return listing.join(details, key, how)


def presence_listing(pages: DataFrame) -> DataFrame:
    """Items of the regional lists (``ul`` of class list): name, link, presence (has a link), key operation (has that class).

    Items and lists inside others count as well, each with all that it holds.
    """
    block = parsed(pages, ("div", "id", "blockRegionalList"), "ul", "li", "a")
    lists = block.select("__html", "__elements", F.explode(_find_all("ul", class_="list")).alias("list"))
    items = lists.select("__html", "__elements", F.explode(_find_all("li", "list", class_="item")).alias("item"))
    items = items.withColumn("url", dom.attribute_of(_find("a", "item"), "href"))
    classes = F.split(dom.attribute_of(F.col("item"), "class"), r"\s+")
    return items.select(
        dom.text(F.col("__html"), F.col("item")).alias("country"), F.col("url").isNotNull().alias("presence"), "url",
        F.coalesce(F.array_contains(classes, F.lit("keyOperations")), F.lit(False)).alias("key_operation"))


def introductions(pages: DataFrame) -> DataFrame:
    """Text of the third element inside each page's introduction block, null where there is none."""
    third = parsed(pages, ("div", "class", "block-introduction")).withColumn("third", F.get("__elements", F.lit(2)))
    return third.select("url", F.nullif(dom.text(F.col("__html"), F.col("third")), F.lit("")).alias("description"))


def law_listing(pages: DataFrame, node_prefix: str, duplicates=()) -> DataFrame:
    """Country options of the selection list, the first (a prompt) skipped, listed duplicates left out."""
    lists = parsed(pages, ("select", "data-drupal-selector", "edit-country"), "option")
    rows = lists.select("__html", F.posexplode("__elements").alias("pos", "option")).where("pos > 0")
    out = rows.select(dom.whole_text(F.col("__html"), F.col("option")).alias("country"),
                      dom.attribute_of(F.col("option"), "value").alias("law_id"))
    for listed_name, listed_id in duplicates:
        out = out.where(~(strip(F.col("country")).eqNullSafe(listed_name) & F.col("law_id").eqNullSafe(listed_id)))
    return out.withColumn("url", F.concat(F.lit(node_prefix), F.col("law_id")))


def law_descriptions(pages: DataFrame) -> DataFrame:
    """All paragraph texts of the page's paragraphs block, joined with newlines; null without the block."""
    cleaned = pages.withColumn("__page", H.without_inert(F.col("html")))
    block = H.with_block(cleaned, "__page", "block", "div", "class", "field--name-field-paragraphs")
    return block.select("url", F.array_join(H.paragraphs(F.col("block")), "\n").alias("description"))
