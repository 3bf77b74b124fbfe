"""Encoding a corpus with a public byte-level BPE tokenizer: a distinct-word table.

Documents are split into words in Spark, every distinct word is encoded once, and
the ids are joined back by position. Words that hold more than a ten-thousandth of
all positions are at most ten thousand; they are joined by broadcast, so that no
join task gets all places of a frequent word. Decoding joins ids with pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagliaio.session import cut_lineage

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: the published splitting rule of this vocabulary, in Java and in regex syntax.
_RULE = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|%s+(?!%s)|%s+"
JAVA_RULE = _RULE % (r"\p{IsWhite_Space}", r"\p{IsWhite_Space}", r"\P{IsWhite_Space}", r"\p{IsWhite_Space}")
PYTHON_RULE = _RULE % (r"\s", r"\s", r"\S", r"\s")

#: A word is frequent from this share of all positions: at most 1/share words are.
FREQUENT_SHARE = 1e-4


def read_vocabulary(folder: str = TOKENIZERS, name: str = VOCABULARY) -> bytes:
    with open(f"{folder}/{name}", "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in raw.splitlines() if line)}


@lru_cache(maxsize=2)
def _encoder(raw: bytes):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=PYTHON_RULE, mergeable_ranks=parse_ranks(raw), special_tokens={})


def _split(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row, doc, words``. Characters that this JVM's Unicode tables don't know yet are split in Python."""
    texts = docs.where(F.col(doc_id).isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc"), F.col(text).alias("t"))

    @F.pandas_udf("array<string>")
    def in_python(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import regex

        rule = regex.compile(PYTHON_RULE)
        for texts in batches:
            yield pd.Series([rule.findall(t) for t in texts], dtype=object)

    unknown = F.coalesce(F.col("t").rlike(r"\p{Cn}"), F.lit(False))
    known = texts.where(~unknown).select("row", "doc", F.regexp_extract_all(F.coalesce("t", F.lit("")), F.lit(JAVA_RULE), F.lit(0)).alias("words"))
    return known.unionByName(texts.where(unknown).select("row", "doc", in_python("t").alias("words")))


def encode_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: bytes | None = None) -> DataFrame:
    """``doc_id, ids``: the ids of every document, without special tokens.

    NULL and empty texts get the empty list. Every row of the input gives one row,
    also where a doc_id is repeated; rows without doc_id are left out. Words of any
    length are encoded whole.
    """
    spark = docs.sparkSession
    raw = spark.sparkContext.broadcast(vocabulary or read_vocabulary())
    # Cut before the words are laid out: one row a document, read again for the table and for the positions.
    words = cut_lineage(_split(docs, doc_id, text)).select("row", "doc", F.posexplode_outer("words").alias("pos", "word"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = _encoder(raw.value)._encode_single_piece
        for batch in batches:
            yield pd.DataFrame({"word": batch["word"], "n": batch["n"], "ids": [piece(w.encode("utf-8")) for w in batch["word"]]})

    counts = words.where(F.col("word").isNotNull()).groupBy("word").agg(F.count("*").alias("n"))
    table = cut_lineage(counts.mapInPandas(encode, "word string, n long, ids array<int>"))
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = table.where(F.col("n") > max(1, int(total * FREQUENT_SHARE))).select("word", "ids")
    rare = table.where(F.col("n") <= max(1, int(total * FREQUENT_SHARE))).select("word", F.col("ids").alias("rare_ids"))
    first = words.join(F.broadcast(frequent), "word", "left")
    settled = F.col("ids").isNotNull() | F.col("word").isNull()
    joined = first.where(settled).select("row", "doc", "pos", "ids").unionByName(
        first.where(~settled).select("row", "doc", "pos", "word").join(rare, "word").select("row", "doc", "pos", F.col("rare_ids").alias("ids"))
    )
    pieces = joined.groupBy("row", "doc").agg(F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("pos", "ids")))).alias("p"))
    return pieces.select(F.col("doc").alias(doc_id), F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))


def decode_corpus(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids", vocabulary: bytes | None = None) -> DataFrame:
    """``doc_id, text`` from ids through a join with the vocabulary's pieces; the empty list gives the empty text."""
    spark = encoded.sparkSession
    ranks = parse_ranks(vocabulary or read_vocabulary())
    pieces = spark.createDataFrame(pd.DataFrame({"id": list(ranks.values()), "piece": [k.hex() for k in ranks]}), "id int, piece string")
    places = encoded.select(F.col(doc_id).alias("doc"), F.posexplode_outer(ids).alias("pos", "id"))
    # The vocabulary has a fixed size of about 50,000 rows.
    joined = places.join(F.broadcast(pieces), "id", "left").groupBy("doc").agg(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("pos", "piece")))).alias("p"))
    hexed = F.array_join(F.transform("p", lambda x: x["piece"]), "")
    return joined.select(F.col("doc").alias(doc_id), F.decode(F.unhex(hexed), "UTF-8").alias("text"))
