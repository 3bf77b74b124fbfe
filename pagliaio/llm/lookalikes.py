"""One consistent form for text that looks the same: a longest-match transducer.

The transducer's table is precomputed from rules and small fixed lists and checked
for conflicts when the module is loaded: every source has one target, and every
target maps to itself. It reads grapheme clusters (a base with its combining
marks, zero-width characters in between ignored) from left to right and rewrites
each longest match in one pass.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagliaio.session import cut_lineage

# Letters of other scripts that look like a Latin letter, with that letter.
LOOKALIKES = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ӏ": "I",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    "Օ": "O", "օ": "o", "Ս": "U", "ս": "u", "ո": "n", "հ": "h", "ց": "g", "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "K": "K", "Å": "Å",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
}
# Spaces that show as a space, characters that don't show, hyphens that show as "-".
SPACES = "\t               　"
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩︀︎️﻿"
HYPHENS = "‐‑"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}

_MARKS = "̀-ͯ᪰-᫿᷀-᷿⃐-⃿\u3099\u309a\uff9e\uff9f"
#: Characters of the blocks that Unicode itself defines as another character in a certain width or typeface,
#: or as Roman numerals written with letters.
_STYLED = [(0x2100, 0x2150), (0x2160, 0x2180), (0xFF01, 0xFFEF), (0x1D400, 0x1D800), (0x1FBF0, 0x1FBFA)]


def _plain_form(ch: str) -> str:
    """The character that ``ch`` is in full or half width, or in a mathematical typeface; itself otherwise."""
    kind, _, codes = unicodedata.decomposition(ch).partition(" ")
    if kind in ("<wide>", "<narrow>", "<font>") or kind == "<compat>" and 0x2160 <= ord(ch) < 0x2180:
        return "".join(chr(int(c, 16)) for c in codes.split())
    return ch


def _base(ch: str) -> str:
    return LOOKALIKES.get(ch) or "".join(LOOKALIKES.get(c, c) for c in _plain_form(ch))


def _cluster(text: str) -> str:
    """Canonical composition of a cluster over the mapped base."""
    parts = unicodedata.normalize("NFD", text)
    return unicodedata.normalize("NFC", "".join(_base(c) for c in parts if c not in INVISIBLE))


def compile_table() -> dict[str, str]:
    table: dict[str, str] = {}

    def put(source: str, target: str) -> None:
        if table.setdefault(source, target) != target:
            raise ValueError(f"two targets for {source!r}")

    for ch in SPACES:
        put(ch, " ")
    for ch in INVISIBLE:
        put(ch, "")
    for ch in HYPHENS:
        put(ch, "-")
    for source, target in (LOOKALIKES | LIGATURES).items():
        put(source, unicodedata.normalize("NFC", target))
    for low, high in _STYLED:
        for ch in map(chr, range(low, high)):
            if ch not in table and (target := unicodedata.normalize("NFC", _base(ch))) != ch:
                put(ch, target)
    put("\r\n", "\n")
    for low, high in ((0xC0, 0x250), (0x370, 0x530), (0x1E00, 0x2000)):  # precomposed letters over a mapped base
        for code in range(low, high):
            ch = chr(code)
            if ch not in table and unicodedata.decomposition(ch) and (target := _cluster(ch)) != ch:
                put(ch, target)
    for source, target in table.items():
        again = "".join(table.get(c, c) for c in target)
        if again != target:
            raise ValueError(f"the target of {source!r} is itself mapped")
    return table


TABLE = compile_table()
# Beyond the basic plane whole blocks are named: a class of single characters is searched one by one there.
_SINGLES = "".join(re.escape(c) for c in TABLE if len(c) == 1 and c <= "\uffff") + "".join(f"{chr(low)}-{chr(high - 1)}" for low, high in _STYLED if low > 0xFFFF)
_ANY = re.compile(f"[{_SINGLES}{_MARKS}]|\r\n")
_MATCH = re.compile(f"\r\n|[^{_MARKS}](?:[{re.escape(INVISIBLE)}]*[{_MARKS}])+|[{_SINGLES}]", re.S)
_memo: dict[str, str] = {}


def _rewrite(m: re.Match) -> str:
    s = m.group()
    t = TABLE.get(s)
    if t is None:
        t = _memo.get(s)
        if t is None:
            t = _cluster(s) if s[0] not in INVISIBLE else _cluster(s.lstrip(INVISIBLE))
            if len(_memo) < 100_000:
                _memo[s] = t
    return t


def one_form(text: str | None) -> str | None:
    """The consistent form; NULL stays NULL, the empty text stays empty."""
    if not text or text.isascii() and "\r" not in text and "\t" not in text or not _ANY.search(text):
        return text
    return _MATCH.sub(_rewrite, text)


def one_form_column(col: Column | str) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([one_form(t) for t in texts], dtype=object)

    return run(col)


def look_alike_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_a, doc_b`` (doc_a < doc_b): different strings that come out in the same form.

    NULL and blank texts are in no pair; exact copies of one string are no pair of
    their own, but each copy pairs with every different look-alike. Only digests are
    shuffled. Classes of equal strings are paired first and expanded afterwards, so a
    string with many copies is never compared with itself.
    """
    forms = docs.where(F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(text).alias("t"), one_form_column(text).alias("f"))
    # The corpus is read and rewritten once: what follows works on the digests.
    digests = cut_lineage(forms.where(F.trim(F.regexp_replace("f", r"\s+", " ")) != "").select("doc", F.sha2("t", 256).alias("t"), F.sha2("f", 256).alias("f")))
    # A form with one string has least = greatest: most documents end here, map-side.
    mixed = digests.groupBy("f").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where(F.col("lo") != F.col("hi")).select("f")
    members = digests.join(mixed, "f", "left_semi").distinct()
    classes = members.select("f", "t").distinct()
    pairs = classes.select("f", F.col("t").alias("t1")).join(classes.select("f", F.col("t").alias("t2")), "f").where(F.col("t1") < F.col("t2")).select("t1", "t2")
    left = members.select(F.col("t").alias("t1"), F.col("doc").alias("a"))
    right = members.select(F.col("t").alias("t2"), F.col("doc").alias("b"))
    return (
        pairs.join(left, "t1").join(right, "t2").where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()
    )
