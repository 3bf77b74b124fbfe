"""Cached web pages as a source: embedded JSON, cards, label-value pages, sitemaps, archives.

Pages come as ``url, html``. Everything that built-in expressions can do stays in
them; only the walk through JSON of unknown depth and HTML tags runs in Python, by
Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, folder: str, encoding: str = "UTF-8") -> DataFrame:
    """``path, html`` of every file in a folder of cached pages; one row a file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(folder)
    return files.select("path", F.decode("content", encoding).alias("html"))


def embedded_json(html: Column) -> Column:
    """The JSON text of the page's data script, or NULL."""
    found = F.regexp_extract(html, r'(?s)id="__NEXT_DATA__"[^>]*>\s*(\{.*?\})\s*</script>', 1)
    return F.nullif(found, F.lit(""))


def _first_list(node, key: str, depth: int):
    if depth < 0:
        return None
    if isinstance(node, list):
        if len(node) > 2 and isinstance(node[0], dict) and key in node[0]:
            return node
        children = node
    elif isinstance(node, dict):
        children = node.values()
    else:
        return None
    for child in children:
        found = _first_list(child, key, depth - 1)
        if found is not None:
            return found
    return None


def find_items(pages: DataFrame, key: str = "realEstate", depth: int = 14) -> DataFrame:
    """``url, pos, item``: the items, as JSON, of the first list (more than two long) whose first item has ``key``.

    Pages without JSON, with broken JSON or without such a list give no row.
    """

    @F.pandas_udf("array<string>")
    def items(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            try:
                found = _first_list(json.loads(text), key, depth) if text else None
            except ValueError:
                found = None
            out.append([json.dumps(x, ensure_ascii=False, sort_keys=True) for x in found or []])
        return pd.Series(out)

    return pages.select("url", F.posexplode(items(embedded_json(F.col("html")))).alias("pos", "item"))


ITEM = "realEstate struct<id:bigint,title:string,typology:struct<name:string>,properties:array<struct<price:struct<value:bigint>,surface:string,rooms:string,typology:struct<name:string>,photos:array<struct<id:bigint>>>>>, seo struct<url:string>"


def item_records(items: DataFrame) -> DataFrame:
    """Flat records of items: the first property counts; type and url have fallbacks."""
    x = F.from_json("item", ITEM)
    p = F.get(x["realEstate"]["properties"], 0)
    return items.select(
        x["realEstate"]["id"].cast("string").alias("source_id"),
        F.coalesce(x["seo"]["url"], F.concat(F.lit("/annunci/"), x["realEstate"]["id"].cast("string"), F.lit("/"))).alias("url"),
        x["realEstate"]["title"].alias("title"),
        F.lower(F.coalesce(p["typology"]["name"], x["realEstate"]["typology"]["name"])).alias("typology"),
        p["price"]["value"].alias("price"), p["surface"].alias("surface_raw"), p["rooms"].alias("rooms"),
        F.to_json(F.transform(p["photos"], lambda y: y["id"])).alias("photo_ids"),
    ).where(F.col("source_id").isNotNull())


class _Cards(HTMLParser):
    """Texts and links of each element that matches a selector (tag, class or both), nested tags included."""

    def __init__(self, selector: str):
        super().__init__(convert_charrefs=True)
        self.tag, _, self.cls = selector.partition(".")
        self.cards: list[dict] = []
        self.depth = 0
        self.field = ""

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        void = tag in ("img", "br", "input", "meta", "link", "hr")
        if self.depth == 0 and (not self.tag or tag == self.tag) and (not self.cls or self.cls in classes):
            self.cards.append({"texts": [], "links": [], "images": [], "classes": []})
            self.depth = 1
            return
        if self.depth:
            if tag == "a" and a.get("href"):
                self.cards[-1]["links"].append(a["href"])
            if tag == "img":
                self.cards[-1]["images"].append(a.get("alt") or "")
            self.field = classes[0] if classes else tag
            self.depth += 0 if void else 1

    def handle_endtag(self, tag):
        if self.depth and tag not in ("img", "br", "input", "meta", "link", "hr"):
            self.depth -= 1

    def handle_data(self, data):
        text = " ".join(data.split())
        if self.depth and text:
            self.cards[-1]["texts"].append(text)
            self.cards[-1]["classes"].append(self.field)


def cards(pages: DataFrame, selectors: list[str]) -> DataFrame:
    """``url, pos, texts, classes, links, images`` of a page's cards: of the candidate selectors the first that hits wins."""

    @F.pandas_udf("array<struct<texts:array<string>,classes:array<string>,links:array<string>,images:array<string>>>")
    def parse(htmls: pd.Series) -> pd.Series:
        out = []
        for html in htmls:
            found: list[dict] = []
            for selector in selectors:
                parser = _Cards(selector)
                parser.feed(html or "")
                if parser.cards:
                    found = parser.cards
                    break
            out.append(found)
        return pd.Series(out)

    return pages.select("url", F.posexplode(parse("html")).alias("pos", "c")).select("url", "pos", "c.*")


def classify_texts(texts: Column) -> dict[str, Column]:
    """Rooms, size and floor of sibling texts by their unit words; the first of each wins."""
    first = lambda pattern: F.get(F.filter(texts, lambda t: F.lower(t).rlike(pattern)), 0)
    return {"rooms": first(r"\b(local|vani|camer)"), "size": first(r"(m²|m2|\bmq\b)"), "floor": first(r"\b(piano|terra|rialzato)\b")}


def label_values(html: Column, labels: list[str]) -> dict[str, Column]:
    """Values of "Label: value" pairs: tags become bars, the value ends at the next bar."""
    flat = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " "), "<[^>]+>", "|"), r"[|\s]*\|[|\s]*", "|")
    return {label: F.nullif(F.trim(F.regexp_extract(flat, rf"(?i)\|\s*{label}\s*:?\s*\|?\s*:?\s*([^|]+)", 1)), F.lit("")) for label in labels}


def segments(html: Column, marker: str) -> Column:
    """Cards of a page cut at a marker pattern: from one marker to the next; what stands before the first is none."""
    parts = F.split(F.regexp_replace(html, f"({marker})", "\u0001$1"), "\u0001", -1)
    return F.slice(parts, F.lit(2), F.size(parts))


def merge_windows(windows: DataFrame, key: str, pos: str, fields: list[str]) -> DataFrame:
    """One row a key: of each field the first value, by position, that is neither NULL, empty nor zero."""
    good = lambda c: F.col(c).isNotNull() & ~F.col(c).cast("string").isin("", "0", "0.0")
    return windows.groupBy(key).agg(*[F.min_by(c, F.when(good(c), F.col(pos))).alias(c) for c in fields])


def bind_by_reference(records: DataFrame, links: DataFrame, record_ref: str, link_url: str) -> DataFrame:
    """Records joined to the links whose tail carries their printed reference: bound by key, never by position."""
    keyed = links.withColumn("_ref", F.ltrim(F.regexp_extract(link_url, r"[-_/](\d{2,9})(?:\.[a-z]+)?/?$", 1), F.lit("0"))).where("_ref <> ''")
    own = records.withColumn("_ref", F.ltrim(F.regexp_replace(record_ref, r"\D", ""), F.lit("0")))
    return own.join(keyed, "_ref", "left").drop("_ref")


def sitemap_locations(xml: Column) -> Column:
    return F.transform(F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1)), F.trim)


def walk_sitemaps(maps: DataFrame, roots: DataFrame, depth: int = 2) -> DataFrame:
    """``url`` of all pages that the sitemaps reach from ``roots``: indexes recurse to ``depth``, none is read twice.

    ``maps`` holds ``url, xml`` of the sitemap files, ``roots`` their ``url``.
    """
    known = maps.select("url", F.col("xml").contains("<sitemapindex").alias("index"), sitemap_locations(F.col("xml")).alias("locs"))
    level, pages = roots.select("url").distinct(), None
    visited = level
    for _ in range(depth + 1):
        opened = level.join(known, "url")
        out = opened.where("NOT index").select(F.explode("locs").alias("url"))
        pages = out if pages is None else pages.unionByName(out)
        level = opened.where("index").select(F.explode("locs").alias("url")).distinct().join(visited, "url", "left_anti")
        visited = visited.unionByName(level)
    return pages.distinct()


def archive_anchors(captures: DataFrame) -> DataFrame:
    """``captured, max_id, n_ids``: the greatest listing number of every archived capture (columns captured, html)."""
    ids = F.transform(F.regexp_extract_all("html", F.lit(r"/annunci/(\d{6,})"), F.lit(1)), lambda x: x.cast("long"))
    return captures.select("captured", F.explode(F.array_distinct(ids)).alias("id")).groupBy("captured").agg(F.max("id").alias("max_id"), F.count("*").alias("n_ids"))


def gallery(pages: DataFrame, deny: str = "logo|icon|sprite|avatar", most: int = 8) -> DataFrame:
    """``url, image, place``: pictures of a page. Links with a query or a denied word are dropped, sizes and
    "-scaled" set aside; the shortest link stands for its key; the first ``most`` in page order (a gallery limit)."""
    found = F.regexp_extract_all("html", F.lit(r'(?i)(?:src|href)="([^"]+\.(?:jpe?g|png|webp))"'), F.lit(1))
    rows = pages.select("url", F.posexplode(found).alias("pos", "image")).where(~F.col("image").contains("?") & ~F.lower("image").rlike(deny))
    key = F.regexp_replace("image", r"(?:-\d+x\d+|-scaled)(?=\.[A-Za-z]+$)", "")
    one = rows.groupBy("url", key.alias("key")).agg(F.min("pos").alias("pos"), F.min_by("image", F.struct(F.length("image"), "image")).alias("image"))
    ranked = one.groupBy("url").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "image"))), 1, most).alias("g"))  # a page's own pictures
    return ranked.select("url", F.posexplode("g").alias("place", "p")).select("url", F.col("p.image").alias("image"), "place")


def recovered_size(mq: Column, text: Column) -> Column:
    """A missing size from detail text, by two patterns in order, within 15 to 3000; a known size stays."""
    number = lambda pattern: F.replace(F.regexp_extract(text, pattern, 1), F.lit("."), F.lit("")).try_cast("int")
    found = F.coalesce(number(r"(?i)superficie[^0-9]{0,20}(\d{1,3}(?:\.\d{3})*|\d+)\s*(?:mq|m²|m2)"), number(r"(?i)\b(\d{1,3}(?:\.\d{3})*|\d+)\s*(?:mq|m²|m2)\b"))
    return F.coalesce(mq, F.when(found.between(15, 3000), found))


def detail_record(html: Column) -> dict[str, Column]:
    """Area from the breadcrumb, price, size; the price counts as withheld only where none is found."""
    text = F.regexp_replace(html, "<[^>]+>", " ")
    price = F.replace(F.regexp_extract(text, r"€\s*(\d{1,3}(?:\.\d{3})+|\d+)", 1), F.lit("."), F.lit("")).try_cast("long")
    area = F.nullif(F.trim(F.regexp_extract(html, r'(?s)class="breadcrumb[^"]*".*?<a[^>]*>[^<]*</a>\s*<a[^>]*>([^<]+)</a>', 1)), F.lit(""))
    size = F.regexp_extract(text, r"(?i)(\d+)\s*(?:mq|m²|m2)", 1).try_cast("int")
    return {"area": area, "price": price, "mq": size, "price_withheld": price.isNull() & F.lower(text).rlike("riservat|su richiesta")}
