"""Evaluation texts leaking into a corpus: a positional inverted index.

The corpus is turned into postings ``(term, doc_id, pos)`` of the terms that the
test items use. For every item its rarest positions are looked up; offset-adjusted
hits (document position minus item position) that fall into one band are counted,
and bands with enough distinct hits are verified by the longest common
subsequence of item and band. The number of rare positions is chosen so that a
document with half of the item cannot be missed: of any ``ceil(n/2)`` positions at
least ``k`` are among the ``n - ceil(n/2) + k`` rarest.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagliaio.llm.lookalikes import one_form
from pagliaio.session import cut_lineage
from pagliaio.tables import broadcast_if_small

_WORD = re.compile(r"[^\W_]+")
_BROKEN = re.compile("[ÂÃÄÅÎÏÐÑâ][\u0080-¿Œ-Ÿˆ˜–-›€™]{1,2}")


def _mend(m: re.Match) -> str:
    try:
        return m.group().encode("cp1252").decode("utf-8")
    except UnicodeError:
        return m.group()


def words_of(text: str | None) -> list[str]:
    """Words in matching form: one look, no case, no accents, entities and broken encodings resolved."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    text = one_form(text)
    plain = text.isascii()
    if not plain:
        text = _BROKEN.sub(_mend, text)
    if "-" in text and "\n" in text:
        text = re.sub(r"(?<=\w)-\s*\n\s*(?=\w)", "", text)
    text = text.lower() if plain else text.casefold()
    if not plain:
        text = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return _WORD.findall(text)


def matching_words(text: str | None) -> str:
    """The words of ``words_of``, parted by single spaces."""
    return " ".join(words_of(text))


def matching_words_column(col: Column | str) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([matching_words(t) for t in texts], dtype=object)

    return run(col)


def common_subsequence(item: list, hits: list[tuple[int, object]], low: int, high: int) -> int:
    """Longest common subsequence (Hunt-Szymanski) of the item and the words at ``hits``.

    Only hits whose offset, position in the document minus position in the item,
    lies in ``[low, high)`` count.
    """
    where: dict[object, list[int]] = {}
    for pos, term in sorted(hits, reverse=True):
        where.setdefault(term, []).append(pos)
    tails: list[int] = []
    for i, word in enumerate(item):
        for p in where.get(word, ()):
            if low <= p - i < high:
                k = bisect_left(tails, p)
                if k == len(tails):
                    tails.append(p)
                else:
                    tails[k] = p
    return len(tails)


#: Words of the items, counted once an item, that one pass over the corpus is to look up. Items are dealt to passes by
#: hash, half of this to each on average.
TERMS_PER_PASS = 500_000


def _index(docs: DataFrame, vocabulary: dict[str, int], doc_id: str, text: str, ready: bool) -> DataFrame:
    """``doc_id, pos, term``: per document the places and numbers of the words in ``vocabulary``; ``ready`` texts are in matching form."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("struct<pos:array<int>,term:array<int>>")
    def postings(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        number = known.value.get
        for texts in batches:
            places, terms = [], []
            for text in texts:
                ids = np.array([number(w, -1) for w in (text.split(" ") if ready else words_of(text))], dtype=np.int32)
                at = np.flatnonzero(ids >= 0)
                places.append(at.astype(np.int32))
                terms.append(ids[at])
            yield pd.DataFrame({"pos": places, "term": terms})

    rows = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), postings(text).alias("p"))
    return rows.where(F.size("p.pos") > 0).select("doc_id", "p.pos", "p.term")


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = 0.5) -> DataFrame:
    """``doc_id, item_id, matched, n_words, exact``: documents with ``share`` or more of an item's words in order and close together.

    Close together means that the words' offsets against the item lie in one band
    one item long (bands start every half item): half an item of words may be
    inserted or left out in between. NULL and wordless texts match nothing; repeated
    documents or items give one row each pair of ids. Items of one or two words count
    like others. ``exact`` says that all words stand in order without others between.
    The work per candidate is bounded by the item's length, not the document's.
    """
    tokens = (
        items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull())
        .select(F.col(item_id).alias("item_id"), F.split(matching_words_column(item_text), " ").alias("w"))
        .where(F.element_at("w", 1) != "")
        .withColumn("n", F.size("w"))
    )
    tokens = cut_lineage(tokens.groupBy("item_id").agg(F.max(F.struct("n", "w")).alias("t")).select("item_id", "t.n", "t.w"))
    total = tokens.agg(F.coalesce(F.sum(F.size(F.array_distinct("w"))), F.lit(0))).first()[0]
    if total <= TERMS_PER_PASS:
        return _leaks_of(docs, tokens, doc_id, text, share, False)
    # Several passes read the corpus in matching form, which is made once.
    ready = cut_lineage(docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), matching_words_column(text).alias("text")))
    passes = -(-2 * total // TERMS_PER_PASS)
    parts = [_leaks_of(ready, tokens.where(F.pmod(F.hash("item_id"), F.lit(passes)) == k), "doc_id", "text", share, True) for k in range(passes)]
    return reduce(DataFrame.unionByName, parts)


def _leaks_of(docs: DataFrame, tokens: DataFrame, doc_id: str, text: str, share: float, ready: bool) -> DataFrame:
    spark = docs.sparkSession
    words = sorted(r.w for r in tokens.select(F.explode("w").alias("w")).distinct().collect())  # bounded by the pass
    vocabulary = {w: i for i, w in enumerate(words)}
    numbers = spark.createDataFrame(pd.DataFrame({"word": words, "term": range(len(words))}), "word string, term int")
    spots = tokens.select("item_id", "n", F.posexplode("w").alias("ipos", "word")).join(F.broadcast(numbers), "word").drop("word")
    index = cut_lineage(_index(docs, vocabulary, doc_id, text, ready))
    counts = index.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.coalesce("df", F.lit(0)), "ipos"))
    half = F.ceil(F.col("n") * F.lit(share)).cast("int")
    k = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(0.1)).cast("int"))
    rare = (
        spots.join(counts, "term", "left").withColumn("rank", rank - 1).withColumn("k", k).withColumn("kept", F.least(F.col("n"), F.col("n") - half + F.col("k")))
        .where(F.col("rank") < F.col("kept"))
        # Distinct hits are counted in two bit sets of 64; longer items wrap, and their bound falls accordingly.
        .withColumn("bit", F.col("rank") % 128)
        .withColumn("need", F.ceil(F.col("k") / F.ceil(F.col("kept") / F.lit(128))).cast("int"))
        .select("item_id", "n", "ipos", "term", "bit", "need")
    )
    # Bands are one item long and start every half item, so any run of half an item's drift lies in one.
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 2)).cast("int")
    band = F.floor((F.col("pos") - F.col("ipos")) / step).cast("int")
    postings = index.select("doc_id", F.explode(F.arrays_zip("pos", "term")).alias("p")).select("doc_id", "p.pos", "p.term")
    hits = postings.join(broadcast_if_small(rare), "term").select("doc_id", "item_id", "n", "need", "bit", F.explode(F.array(band, band - 1)).alias("band"))
    one = lambda low: F.bit_or(F.when((F.col("bit") >= low) & (F.col("bit") < low + 64), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") - low)).otherwise(F.lit(0).cast("long")))
    found = (
        hits.groupBy("doc_id", "item_id", "n", "need", "band").agg(one(0).alias("b0"), one(64).alias("b1"))
        .where(F.bit_count("b0") + F.bit_count("b1") >= F.col("need"))
        .withColumn("lo", F.col("band") * step)
        .withColumn("hi", F.col("lo") + 2 * step + F.col("n"))
        .select("doc_id", "item_id", "band", "n", "lo", "hi")
    )
    found = cut_lineage(found)
    # Only candidates' postings move: cut to the band before they are brought together with the item.
    near = index.join(broadcast_if_small(found.select("doc_id").distinct()), "doc_id", "left_semi").join(found, "doc_id")
    # A hit travels as one long, position above term: arrays of structs would become dicts in Python.
    packed = F.zip_with("pos", "term", lambda p, t: p.cast("long") * F.lit(1 << 31) + t)
    cut = F.filter(packed, lambda h: (h >= F.col("lo").cast("long") * F.lit(1 << 31)) & (h < F.col("hi").cast("long") * F.lit(1 << 31)))
    coded = spots.groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ipos", "term"))), lambda x: x["term"]).alias("w"))
    windows = near.select("doc_id", "item_id", "n", "lo", cut.alias("hits")).join(broadcast_if_small(coded), "item_id")
    # The item's words that the band doesn't hold are in no common subsequence: most bands end here.
    there = F.col("n") - F.size(F.array_except("w", F.transform("hits", lambda h: h.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))))
    windows = windows.where(there >= F.col("n") * F.lit(share))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, item, low, n, words, hits in zip(*(batch[c] for c in ("doc_id", "item_id", "lo", "n", "w", "hits"))):
                words, hits = words.tolist(), list(zip((hits >> 31).tolist(), (hits & 0x7FFFFFFF).tolist()))
                matched = common_subsequence(words, hits, low, low + 2 * max(1, n // 2))
                if matched >= n * share:
                    rows.append((doc, item, matched, n, matched == n and _contiguous(words, hits)))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "matched", "n_words", "exact"])

    kinds = dict(windows.dtypes)
    rows = windows.select("doc_id", "item_id", "lo", "n", "w", "hits").mapInPandas(verify, f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, matched int, n_words int, exact boolean")
    return rows.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("n_words").alias("n_words"), F.max("exact").alias("exact"))


def _contiguous(words: list, hits: list[tuple[int, object]]) -> bool:
    at = dict(hits)
    return any(all(at.get(p + i) == w for i, w in enumerate(words)) for p, t in hits if t == words[0])
