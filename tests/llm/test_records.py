import pytest

from pagliaio.llm.addresses import LIMIT, Gazetteer, comune_name, parse_address, roman, same_address_pairs, street_cost
from pagliaio.llm.matching import match_pages, page_comune, page_street, property_type
from pagliaio.llm.personal import Document, exact_bounds, find_personal, lex, redact, sentences, sure_pieces, train

KNOWN = Gazetteer({"fontecrina", "borgo-semprino", "san-quirzo-in-selva"}, {"59316": "fontecrina"})


def same(a, b):
    x, y = (parse_address(t, "fontecrina", KNOWN) for t in (a, b))
    return bool(x and y and x[:3] == y[:3] and street_cost(x[3], x[4], y[3], y[4]) <= LIMIT)


@pytest.mark.parametrize(
    "a, b",
    [
        ("Via Brumaldo Quartevaci, 14", "59316 Fontecrina, V. B. Quartevaci n. 14"),
        ("Via Brumaldo Quartevaci 14/A", "14 A, via Quartevaci Brumaldo, Fontecrina, VT, 59316, Italia, Fontecrina,"),
        ("Loc. Casvettolo civ. 85/C - Fontecrina (VT)", "Fraz. Casvetolo 85c"),
        ("VIA XXIX VENMAZZAVO N. 7BIS", "via 29 Venmazzavo, 7 bis (tel +39 0900 757955)"),
        ("Via della Serdozzonta, n° 24, c/o Luca Rossi", "d. Serdozzonta 24"),
        ("L. Ranvivveni 74", "Str. Lupo Ranvivveni n. 74"),
        ("Via Po, 3", "v. Po 3"),
        ("Via Ugo 3", "v. Ugo n. 3, Fontecrina"),
    ],
)
def test_one_place(a, b):
    assert same(a, b)


@pytest.mark.parametrize(
    "a, b",
    [
        ("Via Brumaldo Quartevaci, 14", "Via Brumaldo Quartevaci, 15"),
        ("Via Brumaldo Quartevaci, 14", "Via Brumaldo Quartevaci, 14/A"),
        ("Via Brumaldo Quartevaci, 14", "Corso Brumaldo Quartevaci, 14"),
        ("Via della Serdozzonta 3", "Via della Rindazzama 3"),
        ("Via Brumaldo Quartevaci, s.n.c.", "Via Brumaldo Quartevaci, s.n.c."),
    ],
)
def test_two_places(a, b):
    assert not same(a, b)


def test_numerals_and_names():
    assert [roman(x) for x in ("xxix", "iv", "abc", "", "iiii")] == [29, 4, None, None, None]
    assert comune_name("San Quirzo  in Selva") == comune_name("SAN-QUIRZO-IN-SELVA") == "san-quirzo-in-selva"


def test_address_pairs(spark):
    rows = [
        ("a/1", "fontecrina", "Via Brumaldo Quartevaci, 14"), ("a/2", "Fontecrina", "V. B. Quartevacci n. 14"), ("a/3", None, "via Quartevaci Brumaldo 14, 59316"),
        ("a/4", "borgo-semprino", "Via Brumaldo Quartevaci, 14"), ("a/5", "fontecrina", None), ("a/6", "fontecrina", ""), ("a/7", "fontecrina", "Centro"), ("a/8", None, "Via Brumaldo Quartevaci, 14"),
        ("d/1", "fontecrina", "Via Po, 3"), ("d/2", "fontecrina", "v. Po 3"), ("d/3", "fontecrina", "Via Re 3"), ("d/4", "fontecrina", "Via Ugo 3"), ("d/5", "fontecrina", "v. Ugo 3"),
        ("c/1", "fontecrina", "Via Altra Strada 3, 59316"), ("a/9", "fontecrina", "x" * 50_000 + " 3"), ("b/1", "fontecrina", "Via Brumaldo Quartevaci, 14"), ("b/1", "fontecrina", "Via Brumaldo Quartevaci, 14"),
    ]
    df = spark.createDataFrame(rows, "rec string, comune string, address_raw string").selectExpr("*", "cast(null as string) as zona_raw", "'' as title", "cast(null as string) as caption", "1 as pid", "'x' as words")
    got = {(r.rec_a, r.rec_b) for r in same_address_pairs(df).collect()}
    group = ["a/1", "a/2", "a/3", "b/1"]
    assert got == {(x, y) for x in group for y in group if x < y} | {("d/1", "d/2"), ("d/4", "d/5")}
    assert same_address_pairs(df.where("false")).collect() == []


def test_page_titles():
    street = lambda t: (page_street(t, "fontecrina", KNOWN) or [None] * 5)[1:]
    assert street("V. Tullando Gamtondagni n 73c: trilocale, Fontecrina") == ("73", "c", "via", ("tullando", "gamtondagni"))
    assert street("Fontecrina terra-tetto Via 2 Valtellalo")[3] == ("2", "valtellalo")
    assert street("Casa ind. con stufa a pellet, VIA Laura Lannallanti")[3] == ("laura", "lannallanti")
    assert street("appartamento in vendita in via Zeliero Nicretrassi")[3] == ("zeliero", "nicretrassi")
    assert street("App.to con 2 vani")[3] is None
    assert page_comune(None, "Borgo Semprin.", None, KNOWN) == "borgo-semprino"
    assert page_comune(None, "Comune di Fontecrina", None, KNOWN) == page_comune(None, "Fontecrina - zona collinare", None, KNOWN) == "fontecrina"
    assert property_type("Terra-cielo a schiera") == "villetta" and property_type(None) == ""


LISTING = "rec string, comune string, typology string, typology_raw string, price long, mq int, mq_commercial int, surface_raw string, address_raw string, title string, caption string, description string, zona_raw string, vani double"
PAGE = "url string, is_rent int, price long, mq int, comune string, comune_raw string, title string"


def test_matches(spark):
    base = lambda rec, price, mq, address, typ="appartamento", raw=None: (rec, "fontecrina", typ, None, price, mq, None, raw, address, None, None, None, None, 3.0)
    rows = [base(f"z/{i}", 50_000 + 1370 * i, 40 + i, f"Via Nome{chr(97 + i % 26)} Cognome{chr(97 + i % 26)}{chr(97 + i // 26)}, {i}") for i in range(200)]
    rows += [base("a/1", 123_450, 80, None), base("a/2", 98_000, None, "Via Laura Lannallanti 7", raw="861 sq ft"), base("a/3", None, 80, "via L. Lannallanti"), base("a/4", 98_000, 80, "Via Laura Lannallanti 9"), base("a/5", 98_000, 80, "Via Laura Lannallanti", "villa"), (*base("a/6", None, None, None)[:1], None, *[None] * 12)]
    pages = [("u1", 0, 123_450, 80, None, "Fontecrin.", "App.to con 3 vani"), ("u2", 0, 97_000, 80, "fontecrina", None, "Bilocale con stufa, VIA Laura Lannallanti 7"), ("u3", 0, None, None, None, None, None)]
    L = spark.createDataFrame(rows, LISTING)
    P = spark.createDataFrame(pages, PAGE)
    links = spark.createDataFrame([], "rec string, url string")
    got = {(r.rec, r.url): r.confidence for r in match_pages(L, P, links).collect()}
    assert {k for k, v in got.items() if v >= 0.5} == {("a/1", "u1"), ("a/2", "u2"), ("a/3", "u2")}
    assert match_pages(L.where("false"), P, links).collect() == [] == match_pages(L, P.where("false"), links).collect()


TEXT = "Chiedere di Luca Rossi, vicino di casa. Tel. +39 399 56 39 967. Scrivere a l.rossi[at]posta.example. P.IVA 47995230002. Il venditore risiede in Via Nome Cognome n. 5. Annuncio n. 89862867762. Zona Via Altra Strada, tranquilla."


def test_sure_pieces_and_redaction():
    spans = sure_pieces(TEXT, "description", KNOWN)
    assert sorted((k, TEXT[s:e]) for s, e, k in spans) == [
        ("address", "Via Nome Cognome n. 5"), ("email", "l.rossi[at]posta.example"), ("id_number", "47995230002"), ("person", "Luca Rossi"), ("phone", "+39 399 56 39 967"),
    ]
    assert redact(TEXT, spans).startswith("Chiedere di [PERSON], vicino di casa. Tel. [PHONE]. Scrivere a [EMAIL].")
    assert redact(None, []) is None and redact("", []) == ""
    start = lambda raw: [(raw[s:][:6], k) for s, e, k in sure_pieces(raw, "address_raw", KNOWN)]
    assert start("59316 Fontecrina, civ. 29bis Loc. Narlirgamo") == [("civ. 2", "address")]
    assert start("San Quirzo in Selva, Luca Rossi 4, citofono Ada Neri") == [("Luca R", "address"), ("Ada Ne", "person")]
    assert start("Via Nome Cognome, s.n.c.") == []
    assert exact_bounds([(0, 4, "person")], lex(TEXT, "description", KNOWN)) == []


def test_sentences_keep_hits_whole():
    doc = Document([("parola " * 46 + "Chiedere di Luca Rossi " + "parola " * 200, "description")], KNOWN)
    (k, a, b), *_ = doc.places
    text = doc.texts[0][0]
    assert any("Luca Rossi" in text[doc.tokens[k][a].start() : doc.tokens[k][b - 1].end()] for k, a, b in doc.places)
    assert sum(b - a for _, a, b in doc.places) < 120
    assert Document([("", "description"), ("niente", "address_raw")], KNOWN).places == []


def test_skip_edges_change_labels():
    """A name without any context is found through its other mention; without the skip weights it isn't."""
    names = [f"{a}{b}" for a in ("Ald", "Bern", "Corr", "Dem", "Ern", "Fab", "Guid", "Leon") for b in ("ino", "elio", "ardo")]
    records = [[(f"Chiedere di {n} {names[-i]}osi per le visite. Scrivere alla signora. {n} {names[-i]}osi vive altrove.", "description")] for i, n in enumerate(names)]
    records += [[(f"Palazzina Quieta {i} da vedere. Palazzina Quieta bella. palazzina quieta.", "description")] for i in range(24)]
    field = train(records, KNOWN)
    assert field.skip[0, 1 + 3] > 0  # equal tokens of persons attract each other
    texts = [("Zelindo Trafforni vive altrove. Zelindo Traforni risponde. Chiedere di Zelindo Trafforni per le visite.", "description")]
    with_skips = field.spans([Document(texts, KNOWN)])[0][0]
    field.skip[:] = 0.0
    without = field.spans([Document(texts, KNOWN)])[0][0]
    people = lambda spans: {s for s, _, k in spans if k == "person"}
    assert len(people(with_skips)) >= len(people(without)) and Document(texts, KNOWN).edges
    belief = lambda f: f.beliefs([Document(texts, KNOWN)])[0][0][0, 7]
    plain = belief(field)
    field.skip[:, 4] = 2.0
    assert belief(field) > plain


def test_field_on_held_out_rows(spark):
    """The trained field agrees with what form and context leave no doubt about, on rows outside its sample."""
    rows = spark.read.parquet("/root/testdata/sf0.01/listings.parquet").selectExpr("concat(source,'/',source_id) as rec", "comune", "description", "address_raw", "agency_name").dropDuplicates(["rec"])
    extra = spark.createDataFrame([("x/1", None, None, None, None), ("x/2", "fontecrina", "", " ", None), ("x/3", "fontecrina", TEXT + " bla" * 30_000 + " " + TEXT, None, "x")], rows.schema)
    got = {r.rec: r for r in find_personal(rows.unionByName(extra), training_texts=900).collect()}
    names = Gazetteer({comune_name(r.comune) for r in rows.select("comune").distinct().collect() if r.comune}, {})
    hit = miss = 0
    for r in rows.collect():
        for field in ("description", "address_raw"):
            want = {(s, k) for s, _, k in sure_pieces(r[field], field, names)} if r[field] else set()
            have = {(f.span_start, f.kind) for f in got[r.rec].found if f.field == field}
            hit, miss = hit + len(want & have), miss + len(want - have)
    assert hit > 1000 and miss <= 0.02 * hit
    assert got["x/1"].found == [] and got["x/1"].description is None
    assert got["x/2"].found == [] and got["x/2"].description == ""
    assert len([f for f in got["x/3"].found if f.kind == "email"]) == 2
    assert find_personal(rows.where("false")).collect() == []
