"""The corpus pipeline: quality rules, near duplicates, secrets, mixture, packing.

Each stage reads all that the stage before it kept and is written as Parquet
before the next. Null texts and texts of few words fall to the quality rules;
rows with a null doc_id pass all stages. An empty table gives no rows.

Repeated rows are judged alike by the quality rules; of all rows of one doc_id,
as of all members of a class, near duplicates keep one, the least text of the
least id. Ties of the mixture go by hash and id. Very long texts pass whole
through all stages, and further columns, whatever their names, stay until the
last stage, whose columns are its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waymark.llm import line_rules, mixing, near_dedup, packing, queries, secret_scan
from waymark.llm.text import table
from waymark.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the base rules and the line field keep."""
    return line_rules.kept_documents(docs, line_rules.fit_field(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each class, once."""
    return near_dedup.first_of_each(docs, written(near_dedup.near_duplicates(docs), "classes"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents; masks what the forest calls secret."""
    found = written(secret_scan.candidates(docs), "candidates")
    model = secret_scan.fit(secret_scan.labelled_by_name(found), secret_scan.learn_dictionary(docs))
    return secret_scan.masked(docs, secret_scan.scan(found, model))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, dealt by weights; a leaf below its share is read up to twice, one above it in part."""
    mixed = mixing.mix(docs, queries.MIXTURE, percent=100, max_epochs=2, seed=7)
    return mixed.select("document.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which training sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules), ("near duplicates", near_duplicates), ("secret scans", secret_scans),
    ("source mixture", source_mixture), ("packing", packed),
]

#: Line fields, sketches and forests have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
