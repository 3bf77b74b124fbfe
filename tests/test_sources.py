import json
import zipfile

from pyspark.sql import functions as F

from pagliaio.operators.changes import insert_absent, observed_changes, upsert
from pagliaio.operators.graph import components
from pagliaio.operators.similarity import near_hashes
from pagliaio.sources import files, pages, sinks


def data_page(items):
    return f'<html><script id="__NEXT_DATA__" type="application/json">{json.dumps({"props": {"deep": [{"x": {"results": items}}]}})}</script></html>'


def item(i, price=None, typ=None):
    return {"realEstate": {"id": i, "title": f"Casa {i}", "typology": {"name": "Villa"}, "properties": [{"price": {"value": price}, "surface": "90 m²", "typology": {"name": typ} if typ else None, "photos": [{"id": 7}, {"id": 8}]}]}, "seo": {"url": f"/a/{i}"} if i % 2 else None}


def test_embedded_items(spark):
    rows = [("p", data_page([item(1, 100, "Attico"), item(2), item(3)])), ("short", data_page([item(1), item(2)])), ("broken", '<script id="__NEXT_DATA__">{"a": </script>'), ("none", None)]
    df = spark.createDataFrame(rows, "url string, html string")
    got = pages.item_records(pages.find_items(df)).orderBy("source_id").collect()
    assert [(r.source_id, r.url, r.typology, r.price, r.photo_ids) for r in got] == [("1", "/a/1", "attico", 100, "[7,8]"), ("2", "/annunci/2/", "villa", None, "[7,8]"), ("3", "/a/3", "villa", None, "[7,8]")]


def test_cards_and_texts(spark):
    html = '<div class="card"><a href="/x/1">Casa</a><span class="d">3 locali</span><span class="d">90 m²</span><span class="d">piano 2</span><img alt="Studio"></div><div class="card"><p>solo</p></div>'
    df = spark.createDataFrame([("u", html), ("e", "")], "url string, html string")
    rows = pages.cards(df, ["li.item", "div.card"]).withColumns({k: v for k, v in pages.classify_texts(F.col("texts")).items()}).orderBy("pos").collect()
    assert [(r.pos, list(r.links), r.rooms, r["size"], r.floor) for r in rows] == [(0, ["/x/1"], "3 locali", "90 m²", "piano 2"), (1, [], None, None, None)]
    assert list(rows[0].images) == ["Studio"]


def test_label_pages_and_windows(spark):
    html = "<dl><dt>Comune:</dt><dd>Fontecrina</dd><dt>Prezzo</dt><dd>€ 100.000</dd></dl>"
    df = spark.createDataFrame([("u", html)], "url string, html string")
    assert df.select(*[c.alias(k) for k, c in pages.label_values(F.col("html"), ["Comune", "Prezzo", "Bagni"]).items()]).first() == ("Fontecrina", "€ 100.000", None)
    parts = spark.createDataFrame([("Rif. 1 a Rif. 2 b",)], "html string").select(pages.segments(F.col("html"), r"Rif\. ").alias("s")).first().s
    assert parts == ["Rif. 1 a ", "Rif. 2 b"]
    w = spark.createDataFrame([("k", 1, None, 0), ("k", 2, "a", 5), ("k", 3, "b", 6)], "url string, pos int, t string, n int")
    assert pages.merge_windows(w, "url", "pos", ["t", "n"]).first() == ("k", "a", 5)
    rec = spark.createDataFrame([("Rif. 0012", 1)], "ref string, x int")
    links = spark.createDataFrame([("https://a/b-12.html",), ("https://a/none",)], "url string")
    assert pages.bind_by_reference(rec, links, "ref", "url").first().url == "https://a/b-12.html"


def test_sitemaps_and_archives(spark):
    maps = spark.createDataFrame([("root", "<sitemapindex><loc>m1</loc><loc>root</loc></sitemapindex>"), ("m1", "<urlset><loc>a</loc><loc> b </loc></urlset>")], "url string, xml string")
    roots = spark.createDataFrame([("root",)], "url string")
    assert sorted(r.url for r in pages.walk_sitemaps(maps, roots).collect()) == ["a", "b"]
    caps = spark.createDataFrame([("d1", "/annunci/123456 /annunci/999999/ /annunci/12")], "captured string, html string")
    assert pages.archive_anchors(caps).first() == ("d1", 999999, 2)
    g = spark.createDataFrame([("u", '<img src="/a-100x50.jpg"><img src="/logo.png"><img src="/a.jpg"><img src="/b.webp?x=1"><img src="/c-scaled.jpg">')], "url string, html string")
    assert [(r.image, r.place) for r in pages.gallery(g).orderBy("place").collect()] == [("/a.jpg", 0), ("/c-scaled.jpg", 1)]
    t = spark.createDataFrame([(None, "Superficie: 120 mq"), (50, "99 mq"), (None, "9 mq"), (None, None)], "mq int, t string")
    assert [r[0] for r in t.select(pages.recovered_size(F.col("mq"), F.col("t"))).collect()] == [120, 50, None, None]
    d = spark.createDataFrame([('<div class="breadcrumb"><a>Home</a> <a>Fontecrina</a></div> trattativa riservata 80 mq',)], "html string")
    got = d.select(*[c.alias(k) for k, c in pages.detail_record(F.col("html")).items()]).first()
    assert (got.area, got.price, got.mq, got.price_withheld) == ("Fontecrina", None, 80, True)


def test_band_file(spark, tmp_path):
    path = tmp_path / "X_VALORI.csv"
    path.write_bytes("Quotazioni;;\nComune_descrizione;Zona;LinkZona;Descr_Tipologia;Stato;Compr_min;Compr_max;Sup_NL_compr\nCITTÀ ALTA;B1;L1;Abitazioni civili;NORMALE;1.400;1,5;L\nALTROVE;B1;L1;x;y;1;2;L\nCITTÀ ALTA;C1;L2;x;y;;2;N\n".encode("latin-1"))
    (tmp_path / "X_ZONE.csv").write_bytes(b"LinkZona;Zona_Descr;a;b;c\nL1;'CENTRO';1;2;3\n")
    values = files.sniff_csv(spark, str(path))
    found = files.guess_columns(values.columns, {"comune": ["comune_descrizione"], "zona_code": ["Zona"], "link": ["linkzona"], "tipologia": ["tipologia"], "stato": ["stato"], "min": ["compr_min"], "max": ["compr_max"], "basis": ["sup_nl"], "none": ["zzz"]})
    assert found["tipologia"] == "Descr_Tipologia" and found["none"] is None
    labels = files.zone_labels(files.sniff_csv(spark, files.companion(str(path))))
    rows = files.load_bands(values, labels, found, ["cittaalta"], "2025-S2").collect()
    assert [(r.comune, r.min_eur_m2, r.max_eur_m2, r.zona_descr) for r in rows] == [("cittaalta", 1400.0, 1.5, "CENTRO")]


def test_zones_and_side_files(spark, tmp_path):
    kml = '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>FONTE (VT)</name><Placemark><ExtendedData><Data name="CODZONA"><value>B1</value></Data></ExtendedData><Polygon><outerBoundaryIs><LinearRing><coordinates>0,0,0 1,0,0 1,1,0</coordinates></LinearRing></outerBoundaryIs><innerBoundaryIs><LinearRing><coordinates>0.2,0.1 0.3,0.1 0.3,0.2</coordinates></LinearRing></innerBoundaryIs></Polygon></Placemark></Document></kml>'
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("a.kml", kml)
    r = files.read_zones(spark, str(tmp_path / "z.zip")).first()
    assert (r.comune, r.zona_code, len(r.outer_ring), len(r.holes)) == ("FONTE", "B1", 3, 1)
    assert files.read_side_json(spark, str(tmp_path / "absent.json"), "id long").collect() == []
    (tmp_path / "side.json").write_text('[{"id": 1}, {"id": 2}]')
    assert files.read_side_json(spark, str(tmp_path / "side.json"), "id long").count() == 2
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "p.html").write_text("<p>x</p>")
    assert pages.read_pages(spark, str(tmp_path / "c")).first().html == "<p>x</p>"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", "s1"), (1, None, "s2")], "id int, t string, part string")
    for k in ("one", "two"):
        sinks.write_deterministic(df.repartition(3), str(tmp_path / k), ["id", "t"], ["id"])
    one, two = ([p.read_bytes() for p in sorted((tmp_path / k).rglob("part-*"))] for k in ("one", "two"))
    assert one == two and b'{"id":1,"t":null}' in one[1]
    sinks.write_csv(df, str(tmp_path / "csv"), [F.col("id").desc()])
    assert next((tmp_path / "csv").glob("part-*")).read_text().splitlines()[:2] == ["id,t,part", "2,b,s1"]
    out = str(tmp_path / "parts")
    sinks.replace_partitions(df, out, ["part"])
    sinks.replace_partitions(df.where("part = 's1'").withColumn("id", F.lit(9)), out, ["part"])
    assert {(r.id, r.part) for r in spark.read.parquet(out).collect()} == {(9, "s1"), (1, "s2")}


def test_keyed_tables(spark):
    now = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, extra string")
    new = spark.createDataFrame([("a", 5, 1), ("a", 6, 2), ("c", 7, 1), (None, 8, 1)], "k string, v int, seq int")
    assert {(r.k, r.v, r.extra) for r in upsert(now, new, ["k"], [F.col("seq")]).collect()} == {("a", 6, None), ("b", 2, "y"), ("c", 7, None), (None, 8, None)}
    assert {(r.k, r.v) for r in insert_absent(now, new.where("k IS NOT NULL"), ["k"], [F.col("seq")]).collect()} == {("a", 1), ("b", 2), ("c", 7)}
    seen = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, 5), ("a", 4, 6), ("a", 5, None)], "k string, at int, v int")
    assert [r.event for r in observed_changes(seen, ["k"], "v", "at").orderBy("at").collect()] == ["new", "unchanged", "unchanged", "change", "unchanged"]


def test_components_and_hashes(spark):
    edges = [("c", "b"), ("b", "a"), ("x", "y"), ("y", "y"), (None, "a"), ("z", "z")] + [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)]
    got = {r.member: r.component for r in components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"} | {f"n{i:03d}": "n000" for i in range(41)}
    import random

    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(20)]
    values = list({*base, *(b ^ sum(1 << i for i in rnd.sample(range(64), d)) for b in base for d in (1, 3, 5, 6)), 2**64 - 1})
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= 5}
    df = spark.createDataFrame([(v,) for v in signed + [None] + signed[:3]], "h long")
    assert {(r.h1, r.h2) for r in near_hashes(df, "h", 5).collect()} == want
