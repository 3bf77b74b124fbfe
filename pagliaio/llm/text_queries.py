"""Queries of the text problems: encoding, leakage and look-alike texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagliaio.llm.encoding import decode_corpus, encode_corpus
from pagliaio.llm.leakage import leaked_items
from pagliaio.llm.lookalikes import look_alike_pairs, one_form_column
from pagliaio.tables import load


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document by byte_bpe_50k; NULL and empty texts have the empty list."""
    return encode_corpus(load(spark, sf_dir, "documents"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus decoded from its ids: equal to the texts, NULL as the empty text."""
    return decode_corpus(p8_ids(spark, sf_dir))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of an evaluation item, in order and close together."""
    return leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaked items with the number of words that match and whether the quotation is exact."""
    return leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents that read the same but are not the same string."""
    return look_alike_pairs(load(spark, sf_dir, "documents"))


def p10_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text in the one consistent form."""
    return load(spark, sf_dir, "documents").select("doc_id", one_form_column("text").alias("form"))


QUERIES = {"p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_found": p9_found, "p9_report": p9_report, "p10_found": p10_found, "p10_forms": p10_forms}

SQL: dict[str, str] = {
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
