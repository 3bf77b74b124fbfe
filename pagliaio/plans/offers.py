"""Projections, filters and scalar functions over listings, pages, bands and documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagliaio.functions.numbers import digits_joined, first_whole, italian_decimal, relative_to_first, relative_to_max, relative_to_min
from pagliaio.functions.text import area_key, hash_bits, is_street, plain_url, public_street, slug, street_bare, street_joined, tail_ref, type_class
from pagliaio.functions.text import HOUSE_NUMBER, LOOSE_END, STREET_OPENERS, STREET_WORDS, TYPE_SYNONYMS, _ACCENTED, _PLAIN
from pagliaio.plans.registry import LISTINGS, Plan, half_up, half_up_sql, listings
from pagliaio.tables import broadcast_if_small, load, rec_name

plan = Plan()
QUERIES, SQL = plan.queries, plan.sql

FOLD = lambda c: f"translate({c}, '{_ACCENTED}', '{_PLAIN}')"
AREA = lambda c: f"regexp_replace(lower({FOLD(f'coalesce({c}, chr(0))')}), '[^a-z0-9]', '', 'g')"
URL = lambda c: f"regexp_replace(regexp_replace(regexp_replace(lower({c}), '^https?://(www[.])?', ''), '[?#].*$', ''), '/+$', '')"
# Words by which auctions are known.
AUCTION = r"(?i)\b(aste|asta)\b"
AUCTION_TEXT = r"(?i)asta (giudiziari|telematic)|vendita giudiziari|procedura esecutiva|tribunale di"


@plan.query("src_20", f"WITH {LISTINGS} SELECT source, source_id, comune, price, mq FROM l")
def src_20(spark, d):
    """Table scan ordered by key."""
    return listings(spark, d, "comune", "price", "mq").select("source", "source_id", "comune", "price", "mq").orderBy("source", "source_id")


@plan.query("src_05", "SELECT source, source_id, count(*) AS n_rows, min(first_seen) AS first_seen FROM listings GROUP BY source, source_id")
def src_05(spark, d):
    """Harvest dedupe: one row per key with the number of rows it stands for."""
    return load(spark, d, "listings").groupBy("source", "source_id").agg(F.count("*").alias("n_rows"), F.min("first_seen").alias("first_seen"))


@plan.query(
    "src_09",
    r"""WITH c AS (SELECT doc_id, string_split(regexp_replace(text, '(Riferimento|Reference|Objektnummer)', chr(1) || '\1', 'g'), chr(1)) AS cards FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, len(cards) AS n_cards, list_max(list_transform(cards, lambda x: length(x))) AS longest FROM c""",
)
def src_09(spark, d):
    """Cards of a page: the text from one marker to the next."""
    marked = F.regexp_replace("text", "(Riferimento|Reference|Objektnummer)", "\u0001$1")
    cards = F.split(marked, "\u0001", -1)
    return load(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.size(cards).alias("n_cards"), F.array_max(F.transform(cards, F.length)).alias("longest"))


@plan.query(
    "src_16",
    f"""SELECT DISTINCT {AREA('comune')} AS area, zona_code, replace(zona_descr, chr(39), '') AS zona, tipologia, stato, semester, min_eur_m2, max_eur_m2
    FROM omi_bands WHERE min_eur_m2 IS NOT NULL AND max_eur_m2 IS NOT NULL""",
)
def src_16(spark, d):
    """Band load: area key, label without quotes, rows without bounds dropped, repeats collapsed."""
    bands = load(spark, d, "omi_bands").where(F.col("min_eur_m2").isNotNull() & F.col("max_eur_m2").isNotNull())
    return bands.select(area_key(F.col("comune")).alias("area"), "zona_code", F.replace("zona_descr", F.lit("'"), F.lit("")).alias("zona"), "tipologia", "stato", "semester", "min_eur_m2", "max_eur_m2").distinct()


@plan.query(
    "src_21",
    """SELECT vec_id, format('{:016x}', list_aggregate(list_transform(embedding, lambda x, i: CASE WHEN x > 0 THEN CAST(1 AS HUGEINT) << CAST(i - 1 AS HUGEINT) ELSE 0 END), 'sum')::UBIGINT) AS bits FROM embeddings""",
)
def src_21(spark, d):
    """Sign hash of a vector in hex: bit i says whether component i is positive, the last of 64 in the sign bit."""
    bit = F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    bits = F.aggregate(bit, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    return load(spark, d, "embeddings").select("vec_id", F.lower(F.lpad(F.hex(bits), 16, "0")).alias("bits"))


@plan.query(
    "src_22",
    """WITH u AS (SELECT DISTINCT url_alt AS url, regexp_replace(url_alt, '-[0-9]+[.]html$', '') AS k FROM url_alt WHERE url_alt NOT LIKE '%?%')
    SELECT k AS canonical, min_by(url, (length(url), url)) AS url, count(*) AS n FROM u GROUP BY k""",
)
def src_22(spark, d):
    """One link per canonical key: the shortest, ties by text."""
    urls = load(spark, d, "url_alt").select(F.col("url_alt").alias("url")).where(~F.col("url").contains("?")).distinct()
    keyed = urls.withColumn("canonical", F.regexp_replace("url", "-[0-9]+[.]html$", ""))
    return keyed.groupBy("canonical").agg(F.min_by("url", F.struct(F.length("url"), "url")).alias("url"), F.count("*").alias("n"))


@plan.query("flt_01", f"WITH {LISTINGS} SELECT count(*) FILTER (coalesce(typology, '') IN ('progetto', 'terreno')) AS excluded, count(*) FILTER (coalesce(typology, '') NOT IN ('progetto', 'terreno')) AS kept FROM l")
def flt_01(spark, d):
    """Types that aren't compared, counted rather than dropped in silence; a missing type is kept."""
    out = F.coalesce("typology", F.lit("")).isin("progetto", "terreno")
    return listings(spark, d, "typology").agg(F.count_if(out).alias("excluded"), F.count_if(~out).alias("kept"))


@plan.query(
    "flt_02",
    rf"WITH {LISTINGS} SELECT rec, regexp_matches(coalesce(agency_name, ''), '{AUCTION}') AS by_name, regexp_matches(coalesce(caption, '') || ' ' || coalesce(description, ''), '{AUCTION_TEXT}') AS by_text FROM l",
)
def flt_02(spark, d):
    """Auction rows, by the seller's name or by the text."""
    text = F.concat(F.coalesce("caption", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    return listings(spark, d, "agency_name", "caption", "description").select("rec", F.coalesce("agency_name", F.lit("")).rlike(AUCTION).alias("by_name"), text.rlike(AUCTION_TEXT).alias("by_text"))


def resellers(listings_: DataFrame, names: DataFrame) -> DataFrame:
    """``seller, reseller``: sellers whose name stands in ``names`` (seller) or holds a word for auctions."""
    sellers = listings_.where(F.col("agency_name").isNotNull()).select(F.lower(F.trim("agency_name")).alias("seller")).distinct()
    listed = names.select(F.lower(F.trim("seller")).alias("seller"), F.lit(True).alias("listed")).distinct()
    return sellers.join(listed, "seller", "left").select("seller", (F.coalesce("listed", F.lit(False)) | F.col("seller").rlike(AUCTION)).alias("reseller"))


@plan.query("flt_03", rf"WITH {LISTINGS}, s AS (SELECT DISTINCT lower(trim(agency_name)) AS seller FROM l WHERE agency_name IS NOT NULL), n AS (SELECT DISTINCT lower(trim(agency_name)) AS seller FROM l WHERE regexp_matches(coalesce(caption, '') || ' ' || coalesce(description, ''), '{AUCTION_TEXT}')) SELECT seller, seller IN (SELECT seller FROM n WHERE seller IS NOT NULL) OR regexp_matches(seller, '{AUCTION}') AS reseller FROM s")
def flt_03(spark, d):
    """Sellers that resell auctions, by a table of names or a word of the name; the table here: sellers whose texts speak of auctions."""
    rows = listings(spark, d, "agency_name", "caption", "description")
    text = F.concat(F.coalesce("caption", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    return resellers(rows, rows.where(text.rlike(AUCTION_TEXT)).select(F.col("agency_name").alias("seller")))


@plan.query(
    "flt_04",
    f"""WITH s AS (SELECT DISTINCT {AREA('comune')} AS k FROM omi_bands),
    p AS (SELECT DISTINCT url, {AREA('coalesce(comune, comune_raw)')} AS k FROM agency_site_listings),
    c AS (SELECT p.url, s.k AS scope, CASE WHEN p.k = s.k THEN 0 WHEN starts_with(p.k, s.k) THEN 1 ELSE 2 END AS how FROM p JOIN s ON p.k <> '' AND (p.k = s.k OR starts_with(p.k, s.k) OR starts_with(s.k, left(p.k, 12))))
    SELECT url, min_by(scope, (how, scope)) AS scope FROM c GROUP BY url""",
)
def flt_04(spark, d):
    """Scope of a page: equal key, else key that begins with the scope, else scope that begins with the key."""
    scope = load(spark, d, "omi_bands").select(area_key(F.col("comune")).alias("scope")).distinct()
    pages = load(spark, d, "agency_site_listings").select("url", area_key(F.coalesce("comune", "comune_raw")).alias("k")).where("k <> ''").distinct()
    how = F.when(F.col("k") == F.col("scope"), 0).when(F.startswith("k", "scope"), 1).otherwise(2)
    # Every way of matching agrees on the first three letters, so they make an equi-join of it.
    return (
        pages.withColumn("h", F.substring("k", 1, 3)).join(scope.withColumn("h", F.substring("scope", 1, 3)), "h")
        .where((F.col("k") == F.col("scope")) | F.startswith("k", "scope") | F.startswith(F.col("scope"), F.substring("k", 1, 12)))
        .groupBy("url").agg(F.min_by("scope", F.struct(how, "scope")).alias("scope"))
    )


def resolved_aliases(keys: DataFrame, aliases: DataFrame, anywhere: bool = False) -> DataFrame:
    """``k, resolved``: the target of the first alias (alias, target, ord) that opens the key, or stands anywhere in it; a key without one stays.

    An alias table is a hand-kept list; it is broadcast where it is small.
    """
    meets = F.contains(F.col("k"), F.col("alias")) if anywhere else F.startswith("k", "alias")
    hits = keys.join(broadcast_if_small(aliases.where("alias <> ''")), meets, "left")
    return hits.groupBy("k").agg(F.min_by("target", "ord").alias("t")).select("k", F.coalesce("t", "k").alias("resolved"))


_ALIAS = f"WITH a AS (SELECT DISTINCT left({AREA('comune')}, 5) AS alias, {AREA('comune')} AS target, dense_rank() OVER (ORDER BY {AREA('comune')}) AS ord FROM omi_bands), k AS (SELECT DISTINCT {AREA('comune')} AS k FROM listings)"


def _alias_table(spark, d):
    """First letters of the scope's areas, standing for the area; earlier areas first."""
    areas = load(spark, d, "omi_bands").select(area_key(F.col("comune")).alias("target")).distinct()
    return areas.select(F.left("target", F.lit(5)).alias("alias"), "target", F.col("target").alias("ord"))


@plan.query("flt_05", f"{_ALIAS} SELECT k, coalesce((SELECT min_by(target, ord) FROM a WHERE alias <> '' AND starts_with(k, alias)), k) AS resolved FROM k")
def flt_05(spark, d):
    """Aliases by prefix, the first in order; a key without one stays."""
    return resolved_aliases(load(spark, d, "listings").select(area_key(F.col("comune")).alias("k")).distinct(), _alias_table(spark, d))


@plan.query("flt_05_text", f"WITH a AS (SELECT DISTINCT {AREA('comune')} AS alias FROM omi_bands), k AS (SELECT DISTINCT {AREA('title')} AS k FROM listings) SELECT k, coalesce((SELECT min(alias) FROM a WHERE alias <> '' AND contains(k, alias)), k) AS resolved FROM k")
def flt_05_text(spark, d):
    """Aliases anywhere in free text, only those in scope."""
    areas = load(spark, d, "omi_bands").select(area_key(F.col("comune")).alias("alias")).distinct().selectExpr("alias", "alias AS target", "alias AS ord")
    return resolved_aliases(load(spark, d, "listings").select(area_key(F.col("title")).alias("k")).distinct(), areas, anywhere=True)


@plan.query("flt_06", f"WITH {LISTINGS} SELECT rec, {half_up_sql('price::DOUBLE / mq')} AS unit_price FROM l WHERE price > 0 AND mq > 0 AND price::DOUBLE / mq BETWEEN 150 AND 12000")
def flt_06(spark, d):
    """Rows whose unit price lies in a plausible range."""
    unit = F.col("price").cast("double") / F.col("mq")
    return listings(spark, d, "price", "mq").where((F.col("price") > 0) & (F.col("mq") > 0)).where(unit.between(150, 12000)).select("rec", half_up(unit).alias("unit_price"))


@plan.query("flt_07", "SELECT DISTINCT url, coalesce(is_rent, 0) = 1 OR coalesce(price < 10000, FALSE) AS rent, price IS NOT NULL OR mq IS NOT NULL OR coalesce(price_withheld, 0) = 1 AS usable FROM agency_site_listings")
def flt_07(spark, d):
    """Rents, and pages that say enough to be used."""
    rent = (F.coalesce("is_rent", F.lit(0)) == 1) | F.coalesce(F.col("price") < 10000, F.lit(False))
    usable = F.col("price").isNotNull() | F.col("mq").isNotNull() | (F.coalesce("price_withheld", F.lit(0)) == 1)
    return load(spark, d, "agency_site_listings").select("url", rent.alias("rent"), usable.alias("usable")).distinct()


def without_opted_out(listings_: DataFrame, optout: DataFrame) -> DataFrame:
    """Listings that no entry of ``optout`` (name: a source or a rec) takes out."""
    names = optout.select("name").distinct()
    return listings_.join(names.withColumnRenamed("name", "rec"), "rec", "left_anti").join(names.withColumnRenamed("name", "source"), "source", "left_anti")


@plan.query("flt_11", f"WITH {LISTINGS}, o AS (SELECT source || '/' || source_id AS name FROM url_alt WHERE match_route = 'ref' UNION SELECT source FROM l GROUP BY source HAVING count(*) FILTER (price_withheld = 1) * 8 > count(*)) SELECT rec FROM l WHERE source NOT IN (SELECT name FROM o) AND rec NOT IN (SELECT name FROM o)")
def flt_11(spark, d):
    """Opt-out by source or by listing; the table here: sources that withhold many prices, and listings linked by reference."""
    rows = listings(spark, d, "price_withheld")
    sources = rows.groupBy("source").agg((F.count_if(F.col("price_withheld") == 1) * 8 > F.count("*")).alias("out")).where("out").select(F.col("source").alias("name"))
    single = load(spark, d, "url_alt").where("match_route = 'ref'").select(rec_name().alias("name"))
    return without_opted_out(rows, sources.unionByName(single)).select("rec")


@plan.query("flt_12", f"WITH {LISTINGS} SELECT rec FROM l WHERE photo_count > 0 AND NOT EXISTS (SELECT 1 FROM photo_hashes p WHERE p.source || '/' || p.source_id = l.rec)")
def flt_12(spark, d):
    """Work queue: listings with pictures that have no hash yet."""
    done = load(spark, d, "photo_hashes").select(F.concat_ws("/", "source", "source_id").alias("rec")).distinct()
    return listings(spark, d, "photo_count").where("photo_count > 0").join(done, "rec", "left_anti").select("rec")


@plan.query("flt_13", "SELECT DISTINCT url, CASE WHEN regexp_matches(url, 'terreno|lotto') THEN 'out' WHEN regexp_matches(url, 'villa|casa|appart|locale|rustico|schiera|terra') THEN 'in' ELSE 'unknown' END AS scope FROM agency_site_listings")
def flt_13(spark, d):
    """Triage of links by words of the slug: in, out or unknown."""
    scope = F.when(F.col("url").rlike("terreno|lotto"), "out").when(F.col("url").rlike("villa|casa|appart|locale|rustico|schiera|terra"), "in").otherwise("unknown")
    return load(spark, d, "agency_site_listings").select("url", scope.alias("scope")).distinct()


@plan.query("flt_14", f"WITH {LISTINGS} SELECT source, count(*) AS n, count(*) FILTER (length(description) > 40) AS described, count(*) FILTER (length(caption) > 10) AS captioned FROM l GROUP BY source")
def flt_14(spark, d):
    """Text coverage per source."""
    return listings(spark, d, "description", "caption").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.length("description") > 40).alias("described"), F.count_if(F.length("caption") > 10).alias("captioned"))


@plan.query(
    "flt_15",
    r"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(replace(text, chr(10), ' '), '.{0,60}\bprezzo\b')) AS hit FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, count(*) FILTER (NOT contains(lower(hit), 'trattativa')) AS bare, count(*) AS uses FROM h GROUP BY doc_id""",
)
def flt_15(spark, d):
    """Uses of a term without an excusing word in the 60 characters before it."""
    hits = F.regexp_extract_all(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(r"(?U).{0,60}\bprezzo\b"), F.lit(0))
    rows = load(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.explode(hits).alias("hit"))
    return rows.groupBy("doc_id").agg(F.count_if(~F.contains(F.lower("hit"), F.lit("trattativa"))).alias("bare"), F.count("*").alias("uses"))


@plan.query("str_01", f"SELECT DISTINCT comune, {AREA('comune')} AS area FROM listings WHERE comune IS NOT NULL")
def str_01(spark, d):
    return load(spark, d, "listings").where(F.col("comune").isNotNull()).select("comune", area_key(F.col("comune")).alias("area")).distinct()


@plan.query(
    "str_02",
    f"""SELECT DISTINCT address_raw, nullif(list_aggregate(list_filter(regexp_split_to_array(regexp_replace(lower({FOLD('address_raw')}), '[^a-z0-9 ]', '', 'g'), ' +'), lambda w: w <> '' AND NOT regexp_matches(w, '^[0-9]+$')), 'string_agg', ''), '') AS street
    FROM listings WHERE address_raw IS NOT NULL""",
)
def str_02(spark, d):
    return load(spark, d, "listings").where(F.col("address_raw").isNotNull()).select("address_raw", street_joined(F.col("address_raw")).alias("street")).distinct()


_BARE = f"""coalesce(list_aggregate(list_filter(regexp_split_to_array(regexp_replace(lower({FOLD("coalesce(address_raw, '')")}), '[^a-z0-9]+', ' ', 'g'), ' +'),
  lambda w: length(w) > 1 AND w NOT IN ({", ".join(f"'{w}'" for w in STREET_WORDS)}) AND NOT regexp_matches(w, '^[0-9]+[a-z]?$')), 'string_agg', ' '), '')"""


@plan.query("str_03", f"SELECT DISTINCT address_raw, {_BARE} AS street FROM listings WHERE address_raw IS NOT NULL")
def str_03(spark, d):
    return load(spark, d, "listings").where(F.col("address_raw").isNotNull()).select("address_raw", street_bare(F.col("address_raw")).alias("street")).distinct()


@plan.query("str_05", r"SELECT DISTINCT title, regexp_replace(split_part(regexp_extract(title, ' (in|a) (.*)$', 2), ',', 1), ' [0-9]+$', '') AS place FROM listings WHERE title IS NOT NULL")
def str_05(spark, d):
    """Place named by a title sentence, number dropped."""
    place = F.regexp_replace(F.split_part(F.regexp_extract("title", " (in|a) (.*)$", 2), F.lit(","), F.lit(1)), " [0-9]+$", "")
    return load(spark, d, "listings").where(F.col("title").isNotNull()).select("title", place.alias("place")).distinct()


_STREET6 = "split_part(translate(trim(regexp_replace(coalesce(address_raw, ''), '[ \t\r\n]+', ' ', 'g')), ';', ','), ',', 1)"
_STREET6 = f"trim(regexp_replace(regexp_replace({_STREET6}, '{HOUSE_NUMBER}', '', 'g'), '{LOOSE_END}', ''))"


@plan.query("str_06", f"SELECT DISTINCT address_raw, {_STREET6} AS street FROM listings")
def str_06(spark, d):
    return load(spark, d, "listings").select("address_raw", public_street(F.col("address_raw")).alias("street")).distinct()


@plan.query("str_07", f"SELECT DISTINCT address_raw, contains(coalesce(address_raw, ''), ' ') AND split_part(lower(coalesce(address_raw, '')), ' ', 1) IN ({', '.join(f'{chr(39)}{w}{chr(39)}' for w in STREET_OPENERS)}) AS is_street FROM listings")
def str_07(spark, d):
    return load(spark, d, "listings").select("address_raw", is_street(F.col("address_raw")).alias("is_street")).distinct()


@plan.query("str_09", "SELECT DISTINCT typology, CASE " + " ".join(f"WHEN lower(trim(typology)) = '{k}' THEN '{v}'" for k, v in TYPE_SYNONYMS.items()) + " ELSE lower(trim(typology)) END AS class FROM listings")
def str_09(spark, d):
    return load(spark, d, "listings").select("typology", type_class(F.col("typology")).alias("class")).distinct()


_CLASSES = [("schiera", "schiera"), ("terratett", "terratetto"), ("terra-tetto", "terratetto"), ("villa", "villa"), ("rustic", "rustico"), ("casale", "rustico"), ("colonic", "rustico"), ("locale", "appartamento"), ("appart", "appartamento"), ("terren", "terreno")]


@plan.query("str_10", "SELECT DISTINCT title, CASE " + " ".join(f"WHEN contains(lower(title), '{k}') THEN '{v}'" for k, v in _CLASSES) + " END AS class FROM agency_site_listings")
def str_10(spark, d):
    """Ordered keywords to class: the first needle in rule order."""
    low, cls = F.lower("title"), None
    for needle, value in _CLASSES:
        cls = F.when(F.contains(low, F.lit(needle)), value) if cls is None else cls.when(F.contains(low, F.lit(needle)), value)
    return load(spark, d, "agency_site_listings").select("title", cls.alias("class")).distinct()


@plan.query("str_11", f"WITH {LISTINGS} SELECT rec, CASE WHEN typology IS NOT NULL THEN typology WHEN typology_raw IS NOT NULL THEN lower(typology_raw) ELSE 'unknown' END AS class, CASE WHEN typology IS NOT NULL THEN 'source' WHEN typology_raw IS NOT NULL THEN 'label' ELSE 'none' END AS origin FROM l")
def str_11(spark, d):
    """Class with its provenance."""
    origin = F.when(F.col("typology").isNotNull(), "source").when(F.col("typology_raw").isNotNull(), "label").otherwise("none")
    return listings(spark, d, "typology", "typology_raw").select("rec", F.coalesce("typology", F.lower("typology_raw"), F.lit("unknown")).alias("class"), origin.alias("origin"))


@plan.query("str_13", f"WITH {LISTINGS} SELECT rec, CASE WHEN regexp_matches(lower(coalesce(macrozone, zona_raw, '')), 'centro storico|^centro') THEN 'centro' WHEN regexp_matches(lower(coalesce(macrozone, zona_raw, '')), 'semicentro|periferi') THEN 'periferia' WHEN coalesce(macrozone, zona_raw) IS NULL THEN NULL ELSE 'altro' END AS zone FROM l")
def str_13(spark, d):
    text = F.lower(F.coalesce("macrozone", "zona_raw", F.lit("")))
    zone = F.when(text.rlike("centro storico|^centro"), "centro").when(text.rlike("semicentro|periferi"), "periferia").when(F.coalesce("macrozone", "zona_raw").isNull(), None).otherwise("altro")
    return listings(spark, d, "macrozone", "zona_raw").select("rec", zone.alias("zone"))


@plan.query("str_14", "SELECT DISTINCT zona_code, CASE upper(left(zona_code, 1)) WHEN 'B' THEN 'centrale' WHEN 'C' THEN 'semicentrale' WHEN 'D' THEN 'periferica' WHEN 'E' THEN 'suburbana' WHEN 'R' THEN 'rurale' END AS class FROM omi_bands")
def str_14(spark, d):
    first = F.upper(F.left("zona_code", F.lit(1)))
    cls = F.when(first == "B", "centrale").when(first == "C", "semicentrale").when(first == "D", "periferica").when(first == "E", "suburbana").when(first == "R", "rurale")
    return load(spark, d, "omi_bands").select("zona_code", cls.alias("class")).distinct()


# Parts of a seller's name that tell no sellers apart, taken out in this order.
SELLER_JUNK = ("immobiliare", "agenzia", "studio", "s.r.l.", "srl", "s.a.s.", "sas", "snc", "& c.", "gruppo", "real estate", "sansepolcro", "anghiari", "arezzo")
_SELLER = reduce(lambda sql, junk: f"replace({sql}, '{junk}', ' ')", SELLER_JUNK, "lower(agency_name)")


@plan.query("str_15", f"SELECT DISTINCT agency_name, coalesce(nullif(trim(regexp_replace({_SELLER}, ' +', ' ', 'g')), ''), trim(lower(agency_name))) AS seller FROM listings WHERE agency_name <> ''")
def str_15(spark, d):
    """Seller's name without what tells no sellers apart; the whole name in lower case where nothing is left."""
    bare = reduce(lambda c, junk: F.replace(c, F.lit(junk), F.lit(" ")), SELLER_JUNK, F.lower("agency_name"))
    bare = F.trim(F.regexp_replace(bare, " +", " "))
    return load(spark, d, "listings").where("agency_name <> ''").select("agency_name", F.coalesce(F.nullif(bare, F.lit("")), F.trim(F.lower("agency_name"))).alias("seller")).distinct()


@plan.query("str_16", f"WITH {LISTINGS} SELECT rec, regexp_replace(regexp_replace(lower({FOLD('concat_ws(chr(45), coalesce(typology, chr(120)), CAST(mq AS VARCHAR), source, source_id)')}), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM l")
def str_16(spark, d):
    parts = F.concat_ws("-", F.coalesce("typology", F.lit("x")), F.col("mq").cast("string"), "source", "source_id")
    return listings(spark, d, "typology", "mq").select("rec", slug(parts).alias("slug"))


@plan.query("str_17", f"SELECT DISTINCT url, {URL('url')} AS plain FROM listings")
def str_17(spark, d):
    return load(spark, d, "listings").select("url", plain_url(F.col("url")).alias("plain")).distinct()


@plan.query("str_18", f"SELECT DISTINCT url, regexp_extract(regexp_replace({URL('url')}, '[.][a-z]+$', ''), '(?:^|[-_/])([0-9]{{3,9}})$', 1) AS ref FROM agency_site_listings")
def str_18(spark, d):
    return load(spark, d, "agency_site_listings").select("url", tail_ref(F.col("url")).alias("ref")).distinct()


@plan.query("str_19", "SELECT DISTINCT url, coalesce(nullif(trim(ref), ''), 'u' || left(sha1(url), 10)) AS surrogate FROM agency_site_listings")
def str_19(spark, d):
    return load(spark, d, "agency_site_listings").select("url", F.coalesce(F.nullif(F.trim("ref"), F.lit("")), F.concat(F.lit("u"), F.left(F.sha1("url"), F.lit(10)))).alias("surrogate")).distinct()


@plan.query("str_20", "SELECT DISTINCT photo_ids, regexp_replace(photo_ids, '[^A-Za-z0-9]+', '-', 'g') AS safe FROM listings WHERE photo_ids IS NOT NULL")
def str_20(spark, d):
    return load(spark, d, "listings").where(F.col("photo_ids").isNotNull()).select("photo_ids", F.regexp_replace("photo_ids", "[^A-Za-z0-9]+", "-").alias("safe")).distinct()


@plan.query("str_21", r"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', ' ', 'g'), '<[^>]+>', '|', 'g'), '[ \t\r\n]+', ' ', 'g'), ' ') AS flat FROM documents WHERE text IS NOT NULL")
def str_21(spark, d):
    """Markup flattened: scripts and comments removed, tags to bars, white space squeezed."""
    s = F.regexp_replace("text", r"(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", " ")
    s = F.regexp_replace(F.regexp_replace(s, "<[^>]+>", "|"), "[ \t\r\n]+", " ")
    return load(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.trim(s).alias("flat"))


@plan.query("str_24", f"WITH {LISTINGS} SELECT rec, '€ ' || replace(format('{{:,}}', price), ',', '.') AS price_text, strftime(CAST(left(first_seen, 10) AS DATE), '%d/%m/%Y') AS since FROM l WHERE price IS NOT NULL AND first_seen IS NOT NULL")
def str_24(spark, d):
    """Numbers and dates written out the Italian way."""
    price = F.concat(F.lit("€ "), F.translate(F.format_number("price", 0), ",", "."))
    return listings(spark, d, "price", "first_seen").where("price IS NOT NULL AND first_seen IS NOT NULL").select("rec", price.alias("price_text"), F.date_format(F.left("first_seen", F.lit(10)).cast("date"), "dd/MM/yyyy").alias("since"))


@plan.query("str_25", r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda w: w <> '')) AS words FROM documents WHERE text IS NOT NULL")
def str_25(spark, d):
    return load(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.size(F.filter(F.split("text", "[ \t\r\n]+"), lambda w: w != "")).alias("words"))


_NUM = "regexp_replace(surface_raw, '[^0-9,.]', '', 'g')"


@plan.query("num_01", f"SELECT DISTINCT surface_raw, TRY_CAST(split_part(replace({_NUM}, '.', ''), ',', 1) AS BIGINT) AS v FROM listings WHERE surface_raw IS NOT NULL")
def num_01(spark, d):
    return load(spark, d, "listings").where(F.col("surface_raw").isNotNull()).select("surface_raw", digits_joined(F.col("surface_raw")).alias("v")).distinct()


@plan.query("num_02", "SELECT DISTINCT surface_raw, TRY_CAST(replace(regexp_extract(surface_raw, '([0-9]{1,3}(?:[.][0-9]{3})+|[0-9]+)', 1), '.', '') AS BIGINT) AS v FROM listings WHERE surface_raw IS NOT NULL")
def num_02(spark, d):
    return load(spark, d, "listings").where(F.col("surface_raw").isNotNull()).select("surface_raw", first_whole(F.col("surface_raw")).alias("v")).distinct()


@plan.query("num_03", "SELECT DISTINCT surface_raw, TRY_CAST(replace(replace(trim(surface_raw), '.', ''), ',', '.') AS DOUBLE) AS v FROM listings WHERE surface_raw IS NOT NULL")
def num_03(spark, d):
    return load(spark, d, "listings").where(F.col("surface_raw").isNotNull()).select("surface_raw", italian_decimal(F.col("surface_raw")).alias("v")).distinct()


@plan.query("num_04", "SELECT DISTINCT surface_raw, regexp_extract(split_part(surface_raw, '|', 1), '([0-9.,]+)', 1) AS net, regexp_extract(surface_raw, '(?:commerciale|comm[.]le) ([0-9.,]+)', 1) AS weighted FROM listings WHERE surface_raw IS NOT NULL")
def num_04(spark, d):
    """The figure before the bar and the one behind the label."""
    return load(spark, d, "listings").where(F.col("surface_raw").isNotNull()).select("surface_raw", F.regexp_extract(F.split_part("surface_raw", F.lit("|"), F.lit(1)), "([0-9.,]+)", 1).alias("net"), F.regexp_extract("surface_raw", "(?:commerciale|comm[.]le) ([0-9.,]+)", 1).alias("weighted")).distinct()


@plan.query("num_05", "SELECT DISTINCT price_bracket, len(regexp_extract_all(price_bracket, '[0-9][0-9.]*')) > 1 OR regexp_matches(lower(price_bracket), 'meno di|tra|oltre|fino a') AS is_range FROM listings WHERE price_bracket IS NOT NULL")
def num_05(spark, d):
    numbers = F.regexp_extract_all("price_bracket", F.lit("[0-9][0-9.]*"), F.lit(0))
    return load(spark, d, "listings").where(F.col("price_bracket").isNotNull()).select("price_bracket", ((F.size(numbers) > 1) | F.lower("price_bracket").rlike("meno di|tra|oltre|fino a")).alias("is_range")).distinct()


@plan.query("num_06", f"WITH {LISTINGS} SELECT rec, {half_up_sql('(price - price_previous)::DOUBLE / nullif(price_previous, 0) * 100')} AS cut_pct FROM l WHERE price IS NOT NULL AND price_previous IS NOT NULL")
def num_06(spark, d):
    cut = (F.col("price") - F.col("price_previous")).cast("double") / F.nullif("price_previous", F.lit(0)) * 100
    return listings(spark, d, "price", "price_previous").where("price IS NOT NULL AND price_previous IS NOT NULL").select("rec", half_up(cut).alias("cut_pct"))


_LO, _HI = half_up_sql("mq * 0.72e0"), half_up_sql("mq * 0.85e0")


@plan.query("num_08", f"WITH {LISTINGS}, s AS (SELECT rec, price, {_LO} AS size_lo, {_HI} AS size_hi FROM l WHERE price > 0 AND mq > 0) SELECT rec, size_lo, size_hi, {half_up_sql('price / nullif(size_hi, 0)')} AS unit_lo, {half_up_sql('price / nullif(size_lo, 0)')} AS unit_hi FROM s")
def num_08(spark, d):
    """Interval arithmetic: both size bounds are rounded first, the unit price is taken from them crosswise."""
    s = listings(spark, d, "price", "mq").where("price > 0 AND mq > 0").select("rec", "price", half_up(F.col("mq") * F.lit(0.72)).alias("size_lo"), half_up(F.col("mq") * F.lit(0.85)).alias("size_hi"))
    return s.select("rec", "size_lo", "size_hi", half_up(F.col("price") / F.nullif("size_hi", F.lit(0.0))).alias("unit_lo"), half_up(F.col("price") / F.nullif("size_lo", F.lit(0.0))).alias("unit_hi"))


@plan.query(
    "num_15",
    f"""WITH {LISTINGS}, p AS (SELECT rec, mq::DOUBLE AS a, mq_commercial::DOUBLE AS b FROM l WHERE mq > 0 AND mq_commercial > 0)
    SELECT rec, {half_up_sql('(greatest(a, b) - least(a, b)) / least(a, b)', 4)} AS to_min, {half_up_sql('abs(a - b) / greatest(a, b)', 4)} AS to_max, {half_up_sql('abs(a - b) / a', 4)} AS to_first FROM p""",
)
def num_15(spark, d):
    """Three spreads that must not be mixed up: relative to the least, the greatest and the first."""
    a, b = F.col("mq").cast("double"), F.col("mq_commercial").cast("double")
    return listings(spark, d, "mq", "mq_commercial").where("mq > 0 AND mq_commercial > 0").select("rec", half_up(relative_to_min(a, b), 4).alias("to_min"), half_up(relative_to_max(a, b), 4).alias("to_max"), half_up(relative_to_first(a, b), 4).alias("to_first"))


@plan.query("dat_02", "SELECT DISTINCT dom_method, CASE WHEN contains(dom_method, ':') THEN regexp_extract(dom_method, '([^:]*)$', 1) END AS confidence FROM listings")
def dat_02(spark, d):
    return load(spark, d, "listings").select("dom_method", F.when(F.contains("dom_method", F.lit(":")), F.regexp_extract("dom_method", "([^:]*)$", 1)).alias("confidence")).distinct()


@plan.query("dat_05", f"WITH {LISTINGS} SELECT rec, coalesce(left(last_seen, 10), (SELECT left(max(fetched_at), 10) FROM l)) AS lastmod FROM l")
def dat_05(spark, d):
    """Row date, else the date of the corpus."""
    rows = listings(spark, d, "last_seen", "fetched_at")
    corpus = rows.agg(F.left(F.max("fetched_at"), F.lit(10)).alias("c")).scalar()
    return rows.select("rec", F.coalesce(F.left("last_seen", F.lit(10)), corpus).alias("lastmod"))


@plan.query("arr_01", f"WITH {LISTINGS} SELECT rec, CASE WHEN photo_ids IS NULL OR photo_ids IN ('', '[]') THEN 0 ELSE len(CAST(TRY_CAST(photo_ids AS JSON) AS VARCHAR[])) END AS n FROM l")
def arr_01(spark, d):
    """Pictures of a JSON text column; NULL, '' and '[]' are the same none."""
    parsed = F.from_json("photo_ids", "array<string>")
    return listings(spark, d, "photo_ids").select("rec", F.coalesce(F.when(F.size(parsed) >= 0, F.size(parsed)), F.lit(0)).alias("n"))


@plan.query("arr_02", "SELECT ord, list_transform(list_filter(list_zip(ids, range(len(ids))), lambda x: list_position(ids, x[1]) = x[2] + 1), lambda x: x[1])[1:12] AS members FROM verified_clusters")
def arr_02(spark, d):
    """Distinct in order, at most twelve."""
    return load(spark, d, "verified_clusters").select("ord", F.slice(F.array_distinct("ids"), 1, 12).alias("members"))


@plan.query("arr_03", "SELECT DISTINCT lower(dhash) AS dhash, bit_count(('0x' || lower(dhash))::UBIGINT)::INTEGER AS ones FROM photo_hashes")
def arr_03(spark, d):
    return load(spark, d, "photo_hashes").select(F.lower("dhash").alias("dhash"), F.bit_count(hash_bits(F.col("dhash"))).alias("ones")).distinct()


@plan.query("arr_04", "SELECT ord, '[' || list_aggregate(list_transform(ids, lambda x: '\"' || x || '\"'), 'string_agg', ',') || ']' AS json FROM verified_clusters")
def arr_04(spark, d):
    return load(spark, d, "verified_clusters").select("ord", F.to_json("ids").alias("json"))


_SURVEY = [("energy", "classe energetica|energy class"), ("rooms", "vani|rooms"), ("floor", "piano|floor"), ("heating", "riscaldamento|heating|heizung"), ("garden", "giardino|garden|garten"), ("year", "anno di costruzione|built in|baujahr"), ("reference", "riferimento|reference|objektnummer")]


@plan.query("txt_06", " UNION ALL ".join(f"SELECT '{n}' AS field, count(*) FILTER (regexp_matches(lower(text), '{p}')) AS n, count(text) AS of FROM documents" for n, p in _SURVEY))
def txt_06(spark, d):
    """Which details texts mention, all patterns in one pass."""
    counts = load(spark, d, "documents").agg(F.count("text").alias("of"), *[F.count_if(F.lower("text").rlike(p)).alias(n) for n, p in _SURVEY])
    return counts.select("of", F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("n")) for n, _ in _SURVEY])).alias("r")).select("r.field", "r.n", "of")


@plan.query("gate_05", "SELECT count(*) AS violations FROM listings WHERE NOT starts_with(coalesce(url, ''), 'http')")
def gate_05(spark, d):
    return load(spark, d, "listings").agg(F.count_if(~F.startswith(F.coalesce("url", F.lit("")), F.lit("http"))).alias("violations"))


@plan.query("gate_06", f"WITH {LISTINGS} SELECT url, count(*) AS n FROM l GROUP BY url HAVING count(*) > 1")
def gate_06(spark, d):
    return listings(spark, d, "url").groupBy("url").agg(F.count("*").alias("n")).where("n > 1")
