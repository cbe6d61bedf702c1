"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and is written as a table before the
next one starts; all but the last return the columns of the documents they got, whatever
these are named.  Stages accept nulls in any column, empty and long texts, repeated rows
and empty tables; what each operator makes of them is told in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontamination, language_id, near_dedup, packing, personal_data
from shelfmark.llm.common import make_importable, read_table, stored
from shelfmark.llm.queries import SEQUENCE, SEQUENCE_END, tokenizer_path

def _new_name(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it; Spark ignores case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents are in, by more than
    the noise of the method.  Without any label there is nothing to judge by and all stay."""
    make_importable(spark)
    prototypes = language_id.fit(docs)
    if not prototypes:
        return docs
    to = _new_name("language", docs.columns)
    found = language_id.identify(docs, prototypes, to=to)
    known = (F.col(to)["lang_pred"] != language_id.UNDETERMINED) & (F.col(to)["score"] >= language_id.LEAST_SCORE)
    return found.where(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    row = _new_name("row", docs.columns)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())  # docs is a stored table
    found = near_dedup.near_duplicates(numbered, row=row)
    stay = found.where("stays").select(F.col("row").alias(row))
    return numbered.join(stay, row, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind."""
    out = personal_data.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with the sequence and offset of each."""
    return packing.packed_documents(docs, tokenizer_path("byte_bpe_50k.json"), SEQUENCE_END, SEQUENCE)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

# Learned profiles, components and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
