"""Parsers, writers and streams over pages, files and events that are made from the tables: what goes in must come out."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagliaio.functions.prose import headline_surface, mended_euro, result_count, translated_reason, type_conflict, unescaped
from pagliaio.plans.registry import LISTINGS, Plan, listings
from pagliaio.session import ensure_checkpoint_dir
from pagliaio.sources import files, pages, sinks
from pagliaio.streaming import deduplicated, sessions, windowed_counts
from pagliaio.tables import load, rec_name

plan = Plan()
QUERIES, SQL = plan.queries, plan.sql

#: Listings on a page of results.
PAGE = 20


def _folder(spark) -> str:
    """A new folder where all executors can write."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/files-{uuid.uuid4()}"


def _result_pages(spark, d):
    """``url, html``: pages of results, the data of their listings inside a script."""
    rows = listings(spark, d, "url", "title", "typology", "price", "surface_raw", "photo_count").where(F.col("source_id").rlike("^[0-9]+$"))
    place = F.row_number().over(W.partitionBy("source").orderBy("source_id")) - 1
    property_ = F.struct(F.struct(F.col("price").alias("value")).alias("price"), F.col("surface_raw").alias("surface"))
    item = F.struct(
        F.struct(F.col("source_id").cast("long").alias("id"), "title", F.struct(F.col("typology").alias("name")).alias("typology"), F.array(property_).alias("properties")).alias("realEstate"),
        F.when(F.col("source_id").cast("long") % 2 == 1, F.struct("url")).alias("seo"),
    )
    made = rows.withColumn("page", F.floor(place / PAGE)).select("source", "page", "source_id", item.alias("item"))
    page = made.groupBy("source", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("source_id", "item"))), lambda x: x["item"]).alias("results"))  # twenty items at most
    body = F.to_json(F.struct(F.struct(F.array(F.struct(F.struct(F.col("results")).alias("x"))).alias("deep")).alias("props")))
    return page.select(F.concat_ws("/", "source", "page").alias("url"), F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), body, F.lit("</script></html>")).alias("html"))


_PAGED = f"{LISTINGS}, p AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY source_id) - 1) // {PAGE} AS page FROM l WHERE regexp_matches(source_id, '^[0-9]+$')), g AS (SELECT source, page FROM p GROUP BY ALL HAVING count(*) > 2)"


@plan.query("src_02", f"WITH {_PAGED} SELECT source || '/' || page AS url, TRUE AS has_data FROM p GROUP BY source, page")
def src_02(spark, d):
    """The data script of each page."""
    return _result_pages(spark, d).select("url", pages.embedded_json(F.col("html")).isNotNull().alias("has_data"))


@plan.query("src_03", f"WITH {_PAGED} SELECT source || '/' || page AS url, count(*) AS items FROM p JOIN g USING (source, page) GROUP BY source, page")
def src_03(spark, d):
    """Lists of more than two items, wherever they stand in the data."""
    return pages.find_items(_result_pages(spark, d)).groupBy("url").agg(F.count("*").alias("items"))


@plan.query("src_04", f"WITH {_PAGED} SELECT CAST(CAST(source_id AS BIGINT) AS VARCHAR) AS source_id, CASE WHEN CAST(source_id AS BIGINT) % 2 = 1 AND url IS NOT NULL THEN url ELSE '/annunci/' || CAST(CAST(source_id AS BIGINT) AS VARCHAR) || '/' END AS url, title, lower(typology) AS typology, price, surface_raw FROM p JOIN g USING (source, page)")
def src_04(spark, d):
    """Items as flat records, with fallbacks for type and address."""
    return pages.item_records(pages.find_items(_result_pages(spark, d))).select("source_id", "url", "title", "typology", "price", "surface_raw")


def _card_pages(spark, d):
    """One page a site: a card for each of its agency pages."""
    rows = load(spark, d, "agency_site_listings").where("mq > 0 AND title IS NOT NULL").select("site", "url", "mq").distinct()
    card = F.format_string('<div class="card"><a href="%s">scheda</a><span class="d">%d locali</span><span class="d">%d mq</span><span class="d">piano terra</span></div>', "url", F.col("mq") % 7, "mq")
    return rows.groupBy("site").agg(F.array_join(F.array_sort(F.collect_list(card)), "").alias("html")).select(F.col("site").alias("url"), "html")  # a site's own page


@plan.query("src_06", "SELECT site AS url, url AS link FROM (SELECT DISTINCT site, url, mq FROM agency_site_listings WHERE mq > 0 AND title IS NOT NULL)")
def src_06(spark, d):
    """Cards by the first selector that hits."""
    found = pages.cards(_card_pages(spark, d), ["li.item", "div.card"])
    return found.select("url", F.get("links", 0).alias("link"))


@plan.query("src_07", "SELECT url AS link, (mq % 7) || ' locali' AS rooms, mq || ' mq' AS size, 'piano terra' AS floor FROM (SELECT DISTINCT site, url, mq FROM agency_site_listings WHERE mq > 0 AND title IS NOT NULL)")
def src_07(spark, d):
    """Rooms, size and floor of a card by their unit words."""
    found = pages.cards(_card_pages(spark, d), ["li.item", "div.card"])
    return found.select(F.get("links", 0).alias("link"), *[c.alias(k) for k, c in pages.classify_texts(F.col("texts")).items()])


@plan.query("src_08", f"WITH {LISTINGS} SELECT rec, comune AS area, CAST(price AS VARCHAR) AS price FROM l WHERE regexp_matches(comune, '^[A-Za-z-]+$')")
def src_08(spark, d):
    """Label and value pairs of a page."""
    rows = listings(spark, d, "comune", "price").where(F.col("comune").rlike("^[A-Za-z-]+$"))
    html = F.concat(F.lit("<dl><dt>Comune:</dt><dd>"), "comune", F.lit("</dd><dt>Prezzo</dt><dd>"), F.coalesce(F.col("price").cast("string"), F.lit("")), F.lit("</dd></dl>"))
    values = pages.label_values(F.col("html"), ["Comune", "Prezzo"])
    return rows.select("rec", html.alias("html")).select("rec", values["Comune"].alias("area"), values["Prezzo"].alias("price"))


@plan.query("src_10", "SELECT source || '/' || source_id AS rec, min_by(price, seen_at) FILTER (price IS NOT NULL AND price <> 0) AS price FROM (SELECT source, source_id, seen_at, max(price) AS price FROM price_history WHERE seen_at IS NOT NULL GROUP BY ALL) GROUP BY source, source_id")
def src_10(spark, d):
    """Windows of one record merged: of each field the first value that is there."""
    windows = load(spark, d, "price_history").where("seen_at IS NOT NULL").groupBy(rec_name().alias("rec"), "seen_at").agg(F.max("price").alias("price"))
    return pages.merge_windows(windows, "rec", "seen_at", ["price"])


@plan.query("src_11", "WITH a AS (SELECT DISTINCT url, ltrim(regexp_extract(url, '[-_/]([0-9]{2,9})(?:[.][a-z]+)?/?$', 1), '0') AS r FROM agency_site_listings), b AS (SELECT DISTINCT ref, ltrim(regexp_replace(ref, '[^0-9]', '', 'g'), '0') AS r FROM agency_site_listings WHERE ref IS NOT NULL) SELECT b.ref, a.url FROM b LEFT JOIN a ON a.r = b.r AND a.r <> ''")
def src_11(spark, d):
    """Record blocks bound to links by their printed reference."""
    site = load(spark, d, "agency_site_listings")
    return pages.bind_by_reference(site.where("ref IS NOT NULL").select("ref").distinct(), site.select("url").distinct(), "ref", "url").select("ref", "url")


@plan.query("src_12", "SELECT DISTINCT url FROM agency_site_listings WHERE url IS NOT NULL AND site IS NOT NULL")
def src_12(spark, d):
    """All pages that the sitemaps reach: an index of the sites, a map for each site."""
    site = load(spark, d, "agency_site_listings").where("url IS NOT NULL AND site IS NOT NULL")
    maps = site.groupBy("site").agg(F.concat(F.lit("<urlset>"), F.array_join(F.transform(F.collect_set("url"), lambda u: F.concat(F.lit("<loc> "), u, F.lit(" </loc>"))), ""), F.lit("</urlset>")).alias("xml")).withColumnRenamed("site", "url")  # a sitemap file holds a site's pages
    index = site.agg(F.concat(F.lit("<sitemapindex><loc>root</loc>"), F.array_join(F.transform(F.collect_set("site"), lambda u: F.concat(F.lit("<loc>"), u, F.lit("</loc>"))), ""), F.lit("</sitemapindex>")).alias("xml"), F.concat(F.lit("map-of-"), F.min("site")).alias("url")).select("url", "xml")
    return pages.walk_sitemaps(maps.unionByName(index), index.select("url"))


@plan.query("src_13", "SELECT source AS captured, max(CAST(source_id AS BIGINT)) AS max_id, count(DISTINCT CAST(source_id AS BIGINT)) AS n_ids FROM listings WHERE regexp_matches(source_id, '^[0-9]{6,}$') GROUP BY source")
def src_13(spark, d):
    """The greatest number in each archived capture."""
    ids = load(spark, d, "listings").where(F.col("source_id").rlike("^[0-9]{6,}$")).select("source", "source_id").distinct()
    # A capture is a page; here one for each thousand numbers.
    part = F.pmod(F.hash("source_id"), F.lit(64))
    captures = ids.groupBy(F.col("source").alias("captured"), part).agg(F.array_join(F.transform(F.collect_list("source_id"), lambda i: F.concat(F.lit("/annunci/"), i)), " ").alias("html")).select("captured", "html")
    return pages.archive_anchors(captures)


_SIZE_1, _SIZE_2 = r"(?i)superficie[^0-9]{0,20}(\d{1,3}(?:\.\d{3})*|\d+)\s*(?:mq|m²|m2)", r"(?i)\b(\d{1,3}(?:\.\d{3})*|\d+)\s*(?:mq|m²|m2)\b"
_READ = lambda p: f"TRY_CAST(replace(regexp_extract(coalesce(description, ''), '{p}', 1), '.', '') AS INTEGER)"


@plan.query("src_23", f"WITH {LISTINGS}, v AS (SELECT rec, mq, coalesce({_READ(_SIZE_1)}, {_READ(_SIZE_2)}) AS found FROM l) SELECT rec, coalesce(mq, CASE WHEN found BETWEEN 15 AND 3000 THEN found END) AS size FROM v")
def src_23(spark, d):
    """Missing sizes filled from the detail text."""
    return listings(spark, d, "mq", "description").select("rec", pages.recovered_size(F.col("mq"), F.coalesce("description", F.lit(""))).alias("size"))


@plan.query("src_24", f"WITH {LISTINGS} SELECT rec, comune AS area, price, mq, price IS NULL AS withheld FROM l WHERE regexp_matches(comune, '^[A-Za-z-]+$') AND mq > 0 AND (price IS NULL OR price >= 0)")
def src_24(spark, d):
    """Detail pages: area from the breadcrumb, price, size, withheld only without a price."""
    rows = listings(spark, d, "comune", "price", "mq").where(F.col("comune").rlike("^[A-Za-z-]+$") & (F.col("mq") > 0) & (F.col("price").isNull() | (F.col("price") >= 0)))
    html = F.concat(F.lit('<div class="breadcrumb"><a>Home</a> <a>'), "comune", F.lit("</a></div> trattativa riservata "), F.coalesce(F.concat(F.lit("€ "), F.col("price").cast("string")), F.lit("")), F.lit(" superficie "), F.col("mq").cast("string"), F.lit(" mq"))
    made = rows.select("rec", html.alias("html"))
    r = pages.detail_record(F.col("html"))
    return made.select("rec", r["area"].alias("area"), r["price"].alias("price"), r["mq"].alias("mq"), r["price_withheld"].alias("withheld"))


@plan.query("src_01", "SELECT site AS url, count(*) AS cards FROM (SELECT DISTINCT site, url, mq FROM agency_site_listings WHERE mq > 0 AND title IS NOT NULL) GROUP BY site")
def src_01(spark, d):
    """A folder of cached pages, one file each, read back and parsed."""
    out = _folder(spark)
    made = _card_pages(spark, d).select(F.concat(F.lit("<!--"), "url", F.lit("-->"), "html").alias("value"), F.col("url").alias("site"))
    made.write.partitionBy("site").text(out)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(out)
    html = read.select(F.decode("content", "UTF-8").alias("html")).withColumn("url", F.regexp_extract("html", "^<!--(.*?)-->", 1))
    return pages.cards(html, ["div.card"]).groupBy("url").agg(F.count("*").alias("cards"))


_BANDS = "SELECT DISTINCT comune, zona_code, tipologia, CAST(min_eur_m2 AS DOUBLE) AS lo, CAST(max_eur_m2 AS DOUBLE) AS hi FROM omi_bands WHERE min_eur_m2 IS NOT NULL AND max_eur_m2 IS NOT NULL AND NOT contains(comune || zona_code || tipologia, ';')"


@plan.query("src_14", _BANDS)
def src_14(spark, d):
    """A file of bands under a caption line, its delimiter and columns found out (SRC-15), decimals the Italian way."""
    from pagliaio.functions.numbers import italian_decimal

    out = _folder(spark)
    bands = load(spark, d, "omi_bands").where("min_eur_m2 IS NOT NULL AND max_eur_m2 IS NOT NULL AND NOT contains(concat(comune, zona_code, tipologia), ';')")
    number = lambda c: F.replace(F.col(c).cast("decimal(20,6)").cast("string"), F.lit("."), F.lit(","))
    lines = bands.select(F.lit(2).alias("k"), F.concat_ws(";", "comune", "zona_code", "tipologia", number("min_eur_m2"), number("max_eur_m2")).alias("value")).distinct()
    head = spark.createDataFrame([(0, "Quotazioni;;"), (1, "Comune_descrizione;Zona;Descr_Tipologia;Compr_min;Compr_max")], "k int, value string")
    head.unionByName(lines).coalesce(1).sortWithinPartitions("k", "value").select("value").write.option("encoding", "ISO-8859-1").text(out)
    values = files.sniff_csv(spark, out)
    found = files.guess_columns(values.columns, {"comune": ["comune_descrizione"], "zona_code": ["zona"], "tipologia": ["tipologia"], "lo": ["compr_min"], "hi": ["compr_max"]})
    return values.select(*[(italian_decimal(F.col(c)) if k in ("lo", "hi") else F.col(c)).alias(k) for k, c in found.items()])


@plan.query("src_17", "SELECT zona_code AS \"LinkZona\", min(trim(regexp_replace(zona_descr, '^''+|''+$', '', 'g'))) AS zona FROM omi_bands WHERE zona_code IS NOT NULL AND zona_descr IS NOT NULL GROUP BY zona_code")
def src_17(spark, d):
    """Labels of the zones without quotes, one each."""
    zones = load(spark, d, "omi_bands").where("zona_code IS NOT NULL AND zona_descr IS NOT NULL")
    return files.zone_labels(zones.select(F.col("zona_code").alias("LinkZona"), F.concat(F.lit("'"), "zona_descr", F.lit("'")).alias("Zona_Descr")))


@plan.query("src_19", "SELECT ord, verdict, len(ids) AS n FROM verified_clusters")
def src_19(spark, d):
    """A side file written as JSON and read by an explicit schema; a missing one is an empty table."""
    out, schema = _folder(spark), "ord long, verdict string, ids array<string>"
    load(spark, d, "verified_clusters").select("ord", "verdict", "ids").write.json(out)
    missing = files.read_side_json(spark, f"{out}-absent", schema)
    return spark.read.schema(schema).json(out).unionByName(missing).select("ord", "verdict", F.size("ids").cast("long").alias("n"))


_EXPORT = f"WITH {LISTINGS} SELECT rec, price, mq FROM l WHERE price IS NOT NULL"


@plan.query("snk_01", _EXPORT)
def snk_01(spark, d):
    """Sorted CSV with a header, read back."""
    out = _folder(spark)
    sinks.write_csv(listings(spark, d, "price", "mq").where("price IS NOT NULL").select("rec", "price", "mq"), out, [F.desc("price"), "rec"])
    return spark.read.schema("rec string, price long, mq int").option("header", True).csv(out)


@plan.query("snk_02", _EXPORT)
def snk_02(spark, d):
    """CSV and JSON in fixed columns and total order; the JSON side (SNK-03), read back. A second run writes the same (GATE-01)."""
    out = _folder(spark)
    sinks.write_deterministic(listings(spark, d, "price", "mq").where("price IS NOT NULL"), out, ["rec", "price", "mq"], ["rec"])
    return spark.read.schema("rec string, price long, mq int").json(f"{out}/json")


@plan.query("gate_01", "SELECT 0 AS different")
def gate_01(spark, d):
    """Two exports of the same rows in another partitioning are the same lines in the same places."""
    rows, texts = listings(spark, d, "price", "mq").select("rec", "price", "mq"), []
    for parts in (3, 7):
        out = _folder(spark)
        sinks.write_deterministic(rows.repartition(parts), out, ["rec", "price", "mq"], ["rec"])
        texts.append(spark.read.option("wholetext", True).text(f"{out}/json").select(F.sha2("value", 256).alias("digest")).distinct())
    return texts[0].exceptAll(texts[1]).agg(F.count("*").cast("int").alias("different"))


@plan.query("snk_06", "SELECT semester, count(*) AS n FROM omi_bands GROUP BY semester")
def snk_06(spark, d):
    """Partitions deleted and inserted again: only those that come are replaced."""
    out, bands = _folder(spark), load(spark, d, "omi_bands")
    last = bands.agg(F.max("semester")).first()[0]
    sinks.replace_partitions(bands.unionByName(bands.where(F.col("semester") == last)), out, ["semester"])
    sinks.replace_partitions(bands.where(F.col("semester") == last), out, ["semester"])
    return spark.read.parquet(out).groupBy(F.col("semester").cast("string").alias("semester")).agg(F.count("*").alias("n"))


@plan.query("str_12", f"WITH {LISTINGS} SELECT rec, CASE WHEN regexp_matches(lower(coalesce(typology_raw, '')), 'villa|rustic|casale|terratett|appart|locale|terren') THEN 'field' WHEN regexp_matches(lower(coalesce(caption, '')), 'villa|rustic|casale|terratett|appart|locale|terren') THEN 'caption' ELSE 'unknown' END AS origin FROM l")
def str_12(spark, d):
    """Type by the field; by the caption only where the field yields nothing; else unknown."""
    says = lambda c: F.lower(F.coalesce(c, F.lit(""))).rlike("villa|rustic|casale|terratett|appart|locale|terren")
    origin = F.when(says("typology_raw"), "field").when(says("caption"), "caption").otherwise("unknown")
    return listings(spark, d, "typology_raw", "caption").select("rec", origin.alias("origin"))


@plan.query("str_23", "SELECT DISTINCT surface_basis, replace(replace(surface_basis || ' €', 'â‚¬', '€'), 'â' || chr(130) || '¬', '€') AS mended FROM omi_bands")
def str_23(spark, d):
    """A euro sign read in the wrong encoding, mended."""
    broken = F.concat("surface_basis", F.lit(" â‚¬"))
    return load(spark, d, "omi_bands").select("surface_basis", mended_euro(broken).alias("mended")).distinct()


@plan.query("str_26", "SELECT DISTINCT verdict, CASE verdict WHEN 'confirmed' THEN 'confermato' WHEN 'rejected' THEN 'respinto' WHEN 'inconclusive' THEN 'incerto' END AS text FROM verified_clusters")
def str_26(spark, d):
    """Reasons by their prefix; one that nobody translated is an error."""
    known = {"confirmed": "confermato", "rejected": "respinto", "inconclusive": "incerto"}
    return load(spark, d, "verified_clusters").select("verdict", translated_reason(F.col("verdict"), known).alias("text")).distinct()


@plan.query("str_22_entities", "SELECT DISTINCT title, replace(title, '&', '&') AS text FROM agency_site_listings WHERE title IS NOT NULL AND NOT contains(title, '&')")
def str_22_entities(spark, d):
    """Escaped titles resolved again."""
    escaped = F.replace(F.replace(F.replace("title", F.lit("<"), F.lit("&lt;")), F.lit("à"), F.lit("&agrave;")), F.lit("'"), F.lit("&#39;"))
    rows = load(spark, d, "agency_site_listings").where("title IS NOT NULL AND NOT contains(title, '&')").select("title", escaped.alias("e")).distinct()
    return rows.select("title", unescaped("e").alias("text"))


@plan.query("num_16", f"WITH {LISTINGS} SELECT rec, mq + coalesce(mq_commercial, 0) * 0.5e0 AS surface FROM l WHERE mq > 0")
def num_16(spark, d):
    """Surface times coefficient over the primary parts."""
    part = lambda s, c, primary: F.struct(F.coalesce(F.col(s).cast("double"), F.lit(0.0)).alias("surface"), F.lit(c).alias("coefficient"), F.lit(primary).alias("is_primary"))
    parts = F.array(part("mq", 1.0, True), part("mq_commercial", 0.5, True), part("vani", 10.0, False))
    return listings(spark, d, "mq", "mq_commercial", "vani").where("mq > 0").select("rec", headline_surface(parts).alias("surface"))


@plan.query("txt_04", f"WITH {LISTINGS} SELECT rec, CASE WHEN contains(lower(title), 'villa') AND typology <> 'villa' THEN 'villa' END AS other FROM l WHERE typology IS NOT NULL AND title IS NOT NULL")
def txt_04(spark, d):
    """Another type than the field's, where exactly one is named."""
    said = F.when(F.contains(F.lower("title"), F.lit("villa")), F.array(F.lit("villa"))).otherwise(F.array().cast("array<string>"))
    return listings(spark, d, "typology", "title").where("typology IS NOT NULL AND title IS NOT NULL").select("rec", type_conflict(F.col("typology"), said).alias("other"))


@plan.query("txt_07", f"WITH {LISTINGS} SELECT source, count(*)::INTEGER AS n FROM l GROUP BY source")
def txt_07(spark, d):
    """The number of results that a page states."""
    counts = listings(spark, d).groupBy("source").agg(F.count("*").alias("n"))
    return counts.select("source", result_count(F.concat(F.translate(F.format_number("n", 0), ",", "."), F.lit(" risultati per la ricerca"))).alias("n"))


@plan.query("cdc_05", f"WITH {LISTINGS} SELECT 1 AS runs, count(*) AS n FROM l")
def cdc_05(spark, d):
    """One instant for all rows of a run."""
    return listings(spark, d).withColumn("run_at", F.current_timestamp()).agg(F.countDistinct("run_at").cast("int").alias("runs"), F.count("*").alias("n"))


def _streamed(spark, stream, mode: str):
    """A stream run once over what is there; its result as files in the folder that executors share, none of it in the driver."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream_{uuid.uuid4().hex}"
    epochs = []

    def write(batch, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{epoch}")
        epochs.append(epoch)

    stream.writeStream.outputMode(mode).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    if not epochs:  # nothing came
        return spark.createDataFrame([], stream.schema)
    # A complete result replaces the one before.
    return spark.read.parquet(*[f"{folder}/{e}" for e in (sorted({*epochs}) if mode == "append" else [max(epochs)])])


def _events(spark, d):
    schema = load(spark, d, "events").schema
    # As a pattern it may be one file or a folder of them.
    return spark.readStream.schema(schema).parquet(f"{d}/[e]vents.parquet")


@plan.query("stream_windows", "SELECT event_type, count(*) AS windows, sum(n)::BIGINT AS n FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, CAST(ts AS TIMESTAMP)) AS w, count(*) AS n FROM events GROUP BY ALL) GROUP BY event_type")
def stream_windows(spark, d):
    """Hourly windows of a stream of events."""
    return _streamed(spark, windowed_counts(_events(spark, d)), "complete").groupBy("event_type").agg(F.count("*").alias("windows"), F.sum("n").alias("n"))


@plan.query("stream_sessions", "WITH g AS (SELECT user_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events) SELECT user_id, sum(new)::BIGINT AS sessions, count(*) AS n FROM g GROUP BY user_id")
def stream_sessions(spark, d):
    """Sessions of a stream, half an hour apart."""
    return _streamed(spark, sessions(_events(spark, d)), "complete").groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("n"))


@plan.query("stream_distinct", "SELECT count(DISTINCT event_id) AS n FROM events")
def stream_distinct(spark, d):
    """Repeated events dropped inside the watermark."""
    return _streamed(spark, deduplicated(_events(spark, d)).select("event_id"), "append").agg(F.count("*").alias("n"))
