"""Unit conversion and snapshot comparison against brute force, with odd inputs."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagliaio.operators.snapshots import snapshot_changes
from pagliaio.operators.units import PRICE, SURFACE, convert_prices, convert_surfaces, declared_unit, parse_number, parse_surface, parse_unit
from pagliaio.tables import current_state, instant, utc_date_text


@pytest.mark.parametrize(
    "text, amount, unit",
    [
        ("1.819 p.q. (piedi)", 168.99, "p²"), ("are 1,05", 105, "are"), ("0 ha 53 are 66 ca", 5366, "ha"), ("acri 1.47", 5948.88, "acri"), ("328 ca", 328, "ca"), ("ca. 175 centiare", 175, "centiare"),
        ("0.6270 hectares", 6270, "hectares"), ("ha 0.42.04", 4204, "ha"), ("34595 ft²", 3213.98, "ft²"), ("883 sq.ft.", 82.03, "ft²"), ("1,238 sqft", 115.01, "sqft"), ("35,43 a", 3543, "a"),
        ("71 sq yd", 59.37, "yd²"), ("61 yard quadrate", 51.0, "yard²"), ("5.005 mq", 5005, "m²"), ("115 m2", 115, "m²"), ("99 mq.", 99, "m²"), ("176 metri quadri", 176, "m²"), ("169", 169, None), ("ca. 80 mq", 80, "m²"), ("80 mq ca.", 80, "m²"),
        ("", None, None), ("n.d.", None, None),
    ],
)
def test_surfaces(text, amount, unit):
    got, name = parse_surface(text)
    assert name == unit and (got is None) == (amount is None) and (amount is None or abs(got - amount) < 0.01)


@pytest.mark.parametrize(
    "text, factor",
    [("€/sq ft", 1 / 0.09290304), ("EUR per are (100 mq)", 0.01), ("k€/mq", 1000), ("migliaia di euro al mq", 1000), ("(mila EUR/m²)", 1000), ("EUR per yard quadrata", 1 / 0.83612736), ("(euro al piede quadrato)", 1 / 0.09290304), ("€/ara", 0.01), ("€/mq", 1), ("euro al metro quadro", 1)],
)
def test_price_units(text, factor):
    assert abs(parse_unit(text, PRICE)[0] / factor - 1) < 1e-9
    assert parse_unit("banana", PRICE) is None and parse_unit("banana", SURFACE) is None


@given(st.integers(1, 10**6), st.sampled_from([("ft²", 0.09290304), ("sq yd", 0.83612736), ("are", 100.0), ("ettari", 1e4), ("acri", 4046.8564224), ("mq", 1.0)]), st.booleans())
@settings(max_examples=200, deadline=None)
def test_whole_figures_round_trip(n, unit, dotted):
    name, size = unit
    figure = f"{n:,}".replace(",", ".") if dotted else str(n)
    assert abs(parse_surface(f"{figure} {name}")[0] - n * size) < 1e-6 * n * size
    assert parse_number(figure) == n


def test_declared_units():
    assert declared_unit(None, "", "Misure in sq ft.")[0] == pytest.approx(0.09290304)
    assert declared_unit("Superficie indicata in piedi quadrati. Altro.")[0] == pytest.approx(0.09290304)
    assert declared_unit("La superficie è di 269 m², quella netta di 191 m².") is None


def test_convert_surfaces_odd_rows(spark):
    rows = [
        ("a", "90 sqft | commerciale 12 mq", 90, 12, None), ("b", "700", 700, None, "Size given in square feet."), ("c", None, 50, None, None), ("d", None, None, None, None),
        ("e", "", None, 70, "Misure in sq ft."), ("f", "x" * 100_000, 1, None, None), ("g", "75 mq", None, None, "Misure in sq ft."),
    ]
    df = spark.createDataFrame(rows, "rec string, surface_raw string, mq int, mq_commercial int, description string").selectExpr("*", "cast(null as string) as caption", "'' as title", "'clash' as figure", "1 as unit")
    got = {(r.rec, r.figure): (round(r.amount, 2), r.unit, r.stated) for r in convert_surfaces(df).collect()}
    assert got == {
        ("a", "net"): (8.36, "sqft", "text"), ("a", "commercial"): (12.0, "m²", "text"), ("b", "net"): (65.03, "feet²", "elsewhere"), ("c", "net"): (50.0, "m²", "none"),
        ("e", "commercial"): (6.5, "ft²", "elsewhere"), ("g", "net"): (75.0, "m²", "text"),
    }
    assert convert_surfaces(df.where("false")).collect() == []
    bands = spark.createDataFrame([(1.0, 2.0, "N k€/mq"), (None, 5.0, None), (3.0, None, ""), (4.0, 4.0, "L")], "min_eur_m2 double, max_eur_m2 double, surface_basis string")
    assert [(r.factor, r.min_converted, r.max_converted) for r in convert_prices(bands).collect()] == [(1000.0, 1000.0, 2000.0), (1.0, None, 5.0), (1.0, 3.0, None), (1.0, 4.0, 4.0)]


def test_current_state_ties_and_repeats(spark):
    rows = [("s", "1", "2026-01-01T00:00:00Z", 5), ("s", "1", "2026-01-02 00:00:00", 6), ("s", "1", "2026-01-02T01:00:00+02:00", 7), ("s", "1", "2026-01-02 00:00:00", 6), (None, "1", "2026-01-01", 1), ("s", "2", None, None)]
    df = spark.createDataFrame(rows, "source string, source_id string, fetched_at string, price int")
    assert {(r.rec, r.price) for r in current_state(df, ["price"]).collect()} == {("s/1", 6), ("s/2", None)}


def test_instants(spark):
    texts = ["2026-01-04T23:53:26-05:00", "2026-01-04 22:00:00", "2026-01-05T00:30:00+01:00", "2026-01-04T20:00:00.123456Z", "junk", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(utc_date_text(instant(F.col("t"))).alias("d"))
    assert [r.d for r in df.collect()] == ["2026-01-05", "2026-01-04", "2026-01-04", "2026-01-04", None, None, None]


def brute(rows):
    runs = sorted({r[1] for r in rows if r[1] is not None})
    state = {}
    for key, run, at, value in rows:
        if run is not None:
            old = state.get((key, run))
            rank = (at is not None, at, value is not None, value)
            if old is None or tuple(x or 0 for x in rank) >= tuple(x or 0 for x in old[0]):
                state[(key, run)] = (rank, value)
    out = set()
    for before, after in zip(runs, runs[1:]):
        a, b = ({k: v[1] for (k, r), v in state.items() if r == run} for run in (before, after))
        out |= {(k, after, "added") for k in b.keys() - a.keys()} | {(k, after, "removed") for k in a.keys() - b.keys()}
        out |= {(k, after, "changed") for k in a.keys() & b.keys() if a[k] != b[k]}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_snapshots_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["k1", "k2", "k3", "k4", None]), rnd.choice(["r1", "r2", "r3", None]), rnd.randrange(1, 4), rnd.choice([1, 2, None])) for _ in range(30)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "id string, run string, at int, price int").selectExpr("*", "1 as h", "2 as k0", "3 as next")
    got = {(r.id, r.run, r.change_kind) for r in snapshot_changes(df, ["id"], ["price"], "run", "at").collect()}
    assert got == brute(rows)


def test_snapshots_of_nothing_and_one_run(spark):
    schema = "id string, run string, at int, price int"
    assert snapshot_changes(spark.createDataFrame([], schema), ["id"], ["price"], "run", "at").collect() == []
    assert snapshot_changes(spark.createDataFrame([("a", "r", 1, 1)], schema), ["id"], ["price"], "run", "at").collect() == []
