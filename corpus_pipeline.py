"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Quality classifier, line dedup, n-gram Jaccard join, benchmark decontamination, mixing to target weights. Each
stage works on all documents its predecessor kept. All but the last return the columns of ``documents``; the
last adds the place of each document in the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainloom.llm import contamination, jaccard, lines, mixing, quality
from chainloom.llm.common import marked, stored, table
from chainloom.llm.queries import TARGETS
from chainloom.session import configure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects; it is fitted on the given documents and all labels."""
    configure(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).where("score >= 0.3").select(*COLUMNS)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of line runs; a document that consisted of them goes."""
    configure(spark)
    out = lines.dedup_lines(docs.select(*COLUMNS))
    return (
        out.where("n_removed = 0 or n_removed < n_lines")
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("bigint"))
        .select(*COLUMNS)
    )


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.8 or more) the one of smallest id stays."""
    configure(spark)
    docs = docs.select(*COLUMNS)
    groups = jaccard.jaccard_join(docs, size=5, num=8, den=10)
    copies = stored(groups.where("component_id < doc_id").select("doc_id").distinct(), "jaccard-copies")
    # few documents go, so texts are not shuffled to find them
    seen = marked(docs, copies, ["doc_id"])
    others = seen.where("not maybe").select(*COLUMNS)
    return others.unionByName(seen.where("maybe").join(copies, "doc_id", "left_anti").select(*COLUMNS))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a test item."""
    configure(spark)
    return contamination.decontaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their slot in the mix; sort by (slot, seq) to read it."""
    configure(spark)
    return mixing.mix_sources(docs.select(*COLUMNS), TARGETS)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", unrepeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("mixing sources", mixed),
]

#: A compression classifier can't be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
