"""From documents to packed training sequences, in stages.

Each stage is (name, function): the function takes the session, the documents that the
stages before it kept, and the folder of the tables, and returns what it keeps with all
columns, but for the last, which returns the pieces of the packed sequences.

A row is known by its id and its text together, so ids that are null or repeated do no
harm: rows of one id with different texts are judged apart. The classifier judges a row
where it is read. The other stages remove rows by the list of what they drop, which goes
out in blocks of bounded size, so that no text is shuffled to drop others; only a list of
more blocks than may be held at once is joined by shuffling.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.decontamination import contamination
from isobar.llm.exact_dedup import exact_groups
from isobar.llm.ngram_join import near_duplicates
from isobar.llm.quality import good_documents
from isobar.llm.queries import learned_labels, packed
from isobar.storage import materialise, scratch_path, scratch_scope

#: Dropped rows sent out in a block, some 50 MB as a hash table, and blocks held at once.
BLOCK, BLOCKS = 500_000, 8

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _known(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column that knows a row, and its name."""
    name = "_row"
    while name in docs.columns:
        name = f"_{name}"
    return docs.withColumn(name, F.struct("doc_id", F.xxhash64("text").alias("text_key"))), name


def _without(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows in the one column of ``dropped``."""
    gone = materialise(dropped.select(F.col(row).alias("gone")).distinct(), "dropped")
    blocks = max(1, ceil(gone.count() / BLOCK))
    if blocks > BLOCKS:
        return docs.join(gone.hint("merge"), docs[row].eqNullSafe(gone["gone"]), "left_anti").drop(row)
    for block in range(blocks):
        own = gone if blocks == 1 else gone.where(F.pmod(F.xxhash64("gone"), F.lit(blocks)) == block)
        docs = docs.join(F.broadcast(own), docs[row].eqNullSafe(own["gone"]), "left_anti")
    return docs.drop(row)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is good enough."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return good_documents(docs, labels, learned_labels())


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the smallest id."""
    rows, row = _known(docs)
    once = _without(rows, row, exact_groups(rows, id_col=row).where("not kept"))
    # Rows with one id and one text are still there as often as they came.
    once, row = _known(once)
    repeated = materialise(once.groupBy(row).count().where("count > 1").select(F.col(row).alias("again")), "repeated")
    if repeated.isEmpty():
        return once.drop(row)
    same = once[row].eqNullSafe(repeated["again"])
    first = once.join(repeated, same, "left_semi").dropDuplicates([row])
    return once.join(repeated, same, "left_anti").unionByName(first).drop(row)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    rows, row = _known(docs)
    classes = near_duplicates(rows, id_col=row, links=False)
    return _without(rows, row, classes.where(~F.col(row).eqNullSafe(F.col("class_id"))))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    rows, row = _known(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(rows, row, contamination(rows, items, id_col=row).where("contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL expresses the classifier, the n-gram groups by MinHash or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
