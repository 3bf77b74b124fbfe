"""What the address pairs write between their steps."""

from pagliaio.llm import addresses


def test_bands_and_places_are_written_short(spark, monkeypatch):
    written, cut = [], addresses.cut_lineage
    monkeypatch.setattr(addresses, "cut_lineage", lambda df: written.append(dict(df.dtypes)) or cut(df))
    row = lambda rec, address: (rec, "Tregnana", address, None, None, None)
    rows = spark.createDataFrame([row("a", "Via Roma 1"), row("b", "via Roma n. 1"), row("c", "Via Garibaldi 3"), row("d", "Via Garibbaldi 3"), row("e", "Via Garibaldi 4")], "rec string, comune string, address_raw string, zona_raw string, title string, caption string")
    assert sorted(map(tuple, addresses.same_address_pairs(rows).collect())) == [("a", "b"), ("c", "d")]
    assert not any("band" in columns for columns in written)  # one row a word, not one a band
    assert all(kind == "bigint" for columns in written for name, kind in columns.items() if name in ("pid", "p1", "p2"))
