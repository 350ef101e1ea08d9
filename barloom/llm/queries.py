"""Queries p6 to p8 over the documents."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import leaks, persons, tokens

#: Folder of the public vocabularies; the setting spark.barloom.tokenizers or this variable names another.
TOKENIZERS = os.environ.get("BARLOOM_TOKENIZERS", "/opt/tokenizers")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _ranks(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.barloom.tokenizers', TOKENIZERS)}/byte_bpe_50k.tiktoken"


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_documents(_table(spark, folder, "documents"), _ranks(spark))


def p6_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again: its text, empty for a null one."""
    return tokens.decode_documents(p6_ids(spark, folder), _ranks(spark))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "eval_items")).select("doc_id", "item_id")


def p7_leaking_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every affected document with the items it leaks."""
    return leaks.leaking_documents(leaks.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "eval_items")))


def p7_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the spans that leak."""
    return leaks.remove_leaks(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return persons.find_mentions(_table(spark, folder, "documents"), _table(spark, folder, "person_names")).select("doc_id", "kind", "start_at")


def p8_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its mentions replaced by placeholders."""
    return persons.replace_mentions(_table(spark, folder, "documents"), _table(spark, folder, "person_names"))


QUERIES = {f.__name__: f for f in (p6_ids, p6_decoded, p7_found, p7_leaking_documents, p7_cleaned, p8_found, p8_replaced)}
#: The rest cannot be expressed in SQL; tests hold it against brute force.
ORACLES: dict[str, str] = {"p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
