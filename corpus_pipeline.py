"""Corpus pipeline: five stages over ``documents``, each written and reread.

Toxic documents go, one document of each near-duplicate group stays, documents
that hold benchmark passages go, personal data is redacted, and what is left is
packed into training sequences.  All stages but the last return the columns
they were given; an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.llm import decontaminate, packing, pii, setjoin, toxicity
from mensura.llm.common import prepare, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove the documents that the classifier chain rejects.

    Null and empty texts stay.  Every row is judged by itself.
    """
    prepare(spark)
    links, cut = toxicity.train(staged(toxicity.sample_of(docs, table(spark, sf_dir, "labels")), "pipeline-labelled"))
    scored = toxicity.score(docs.select(F.col("text").alias("_judged"), F.struct(*docs.columns).alias("_row")),
                            links, cut, text_col="_judged", keep=("_row",))
    return scored.where(~F.col("rejected")).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group that similar texts join, once.

    Wordless texts and rows without an id belong to no group and stay;
    repeated rows become one.
    """
    prepare(spark)
    stay = setjoin.similar_documents(docs).where("doc_id = class_id").select(F.col("doc_id").alias("_stays")).distinct()
    nameless = docs.where("doc_id IS NULL")
    named = docs.where("doc_id IS NOT NULL").join(stay, F.col("doc_id") == F.col("_stays"), "left_semi")
    return named.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).drop("_text").unionByName(nameless)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove the documents of which benchmark windows make up a twentieth or
    more.  Every row is judged by its own text, also rows without an id or
    with the id of another."""
    prepare(spark)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select(F.col("doc_id").alias("_id"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_h1")) & (F.hash(docs["text"]) == F.col("_h2"))
    return docs.join(bad, same, "left_anti")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind in brackets."""
    prepare(spark)
    found = pii.find(docs.select(F.col("text").alias("_searched"), F.struct(*docs.columns).alias("_row")),
                     pii.train(docs), keep=("_row",), text_col="_searched")
    new = {"text": F.col("redacted_text"), "n_chars": F.char_length("redacted_text").cast("long")}
    return found.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids, placed in training sequences."""
    prepare(spark)
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact),
    ("packing", pack),
]

#: The trained stages and the packing can't be expressed in SQL; the tests
#: compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
