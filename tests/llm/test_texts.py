import random

import pytest

from pagliaio.llm.encoding import decode_corpus, encode_corpus
from pagliaio.llm.leakage import common_subsequence, leaked_items, matching_words
from pagliaio.llm.lookalikes import TABLE, look_alike_pairs, one_form

ODD = [
    None, "", " ", "  \n\n  ", "it's we'll I'M don'T", "a  b   c \t d\n", "x" * 40_000, "１２ ｆｕｌｌ　ｗｉｄｔｈ", "naïve café é ​ zero", "цена дома 45 м²", "😀🏡 emoji 🇮🇹", "<|endoftext|> plain",
    "\x85next line nbsp", "ends with space ", "'s 'S ’s", "\U0001fae8 Ᲊ new letters", "１½²³", "combining à̖ ö",
]


def test_ids_equal_the_public_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("ab ' \n.,1²éа ") for _ in range(60)) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as ids", "'x' as word")
    encoded = encode_corpus(df)
    got = {r.doc_id: list(r.ids) for r in encoded.collect()}
    assert set(got) == set(range(len(texts)))
    for i, text in enumerate(texts):
        assert got[i] == (t.encode(text, add_special_tokens=False).ids if text else []), (i, text)
    assert {r.doc_id: r.text for r in decode_corpus(encoded).collect()} == {i: x or "" for i, x in enumerate(texts)}


def test_encoding_of_repeated_and_missing_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "x")], "doc_id long, text string")
    assert sorted(len(r.ids) for r in encode_corpus(df).collect()) == [1, 2, 2]
    assert encode_corpus(df.where("false")).collect() == []


def test_forms():
    assert one_form("Ｃａｓа é​ ﬁne\r\n") == "Casa é fine\n"
    assert one_form("e​́") == one_form("é") == "é"
    assert one_form("ό") == one_form("ó") == one_form("ό") == "ó"
    assert one_form("è") != one_form("e") and one_form("m²") == "m²" and one_form("½") == "½"
    assert one_form(None) is None and one_form("") == ""
    for source in TABLE:
        assert one_form(one_form(source)) == one_form(source)
    long = "Largo а́ " * 20_000
    assert one_form(long) == "Largo á " * 20_000


def test_look_alike_pairs(spark):
    rows = [(1, "casa"), (2, "cаsa"), (3, "cаsa"), (4, "casa"), (5, "cása"), (6, None), (7, ""), (8, " "), (9, " "), (2, "cаsa")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' as f", "1 as t")
    got = {(r.doc_a, r.doc_b) for r in look_alike_pairs(df).collect()}
    assert got == {(1, 2), (1, 3), (2, 4), (3, 4)}
    assert look_alike_pairs(df.where("false")).collect() == []


def brute(docs, items):
    out = set()
    for d, text in docs:
        doc = matching_words(text).split()
        for i, item in items:
            words = matching_words(item).split()
            if words:
                step = max(1, len(words) // 2)
                lows = range(-(len(words) // step + 3) * step, len(doc) + step, step)
                if any(2 * common_subsequence(words, list(enumerate(doc)), low, low + 2 * step) >= len(words) for low in lows):
                    out.add((d, i))
    return out


def test_leaks_against_brute_force(spark):
    rnd = random.Random(5)
    common, rare = [f"w{i}" for i in range(25)], [f"r{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(common if rnd.random() < 0.5 else rare) for _ in range(rnd.choice([6, 30, 90, 300])))) for i in range(12)]
    docs = []
    for d in range(120):
        words = [rnd.choice(common) for _ in range(rnd.randrange(0, 200))]
        quoted = items[rnd.randrange(12)][1].split()
        share = rnd.choice([0, 0.2, 0.35, 0.7, 1.0])
        start = rnd.randrange(0, max(1, int(len(quoted) * (1 - share)) + 1))
        part = quoted[start : start + int(len(quoted) * share)]
        part = [w if rnd.random() < 0.93 else "altered" for w in part]
        if rnd.random() < 0.15:
            rnd.shuffle(part)
        docs.append((d, " ".join(words[:50] + part + words[50:])))
    docs += [(500, None), (501, ""), (502, items[0][1].upper().replace("W", "Ｗ")), (0, docs[0][1])]
    edge = [(90, None), (91, "")]
    D = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as term")
    I = spark.createDataFrame(items + edge, "item_id long, text string").selectExpr("*", "2 as n")
    got = {(r.doc_id, r.item_id): r for r in leaked_items(D, I).collect()}
    assert set(got) == brute(docs, items)
    assert got[(502, 0)].exact
    assert leaked_items(D.where("false"), I).collect() == [] == leaked_items(D, I.where("false")).collect()
