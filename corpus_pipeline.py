"""From raw documents to packed training sequences, in stages that each write a table and read it back.

Quality rules drop documents they reject; of each group of near copies one stays; documents that contain a benchmark
item go; personal data is replaced; what is left is packed. No stage has SQL: hashes, trained models and token ids decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesdq.llm import contamination, identifiers, jaccard, packing, quality, shared

#: Most rows of decisions (8 bytes each) that are broadcast; beyond, documents are shuffled to them.
BROADCAST_DECISIONS = 4_000_000
#: Near copies share this percentage of their shingles of so many words; op9's own contract (3 words, 90) binds only op9.
COPY_WIDTH, COPY_PERCENT = 5, 80


def _kept(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``shared.row_key`` is not among the places of ``rejected``: of one doc_id, also null, each text by itself."""
    name = shared.fresh(docs, "rejected_place")
    rejected = shared.stored(rejected.select(F.col("place").alias(name)).distinct(), "rejected")
    small = rejected.count() <= BROADCAST_DECISIONS
    return docs.join(F.broadcast(rejected) if small else rejected, shared.row_key() == F.col(name), "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep, with all their columns, whatever these are called.

    A null or empty text fails the rules and goes. Rows that repeat are judged alike; of rows that share an id, null or not, each is
    judged by its own text. No rows give none.
    """
    shared.ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.quality_rules(docs.withColumn("place", shared.row_key()), labels, key="place")
    return _kept(docs, judged.where("not kept"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies (0.8 of five-word shingles): one with the least doc_id, or any if all are null.

    Rows with an empty set link with nothing. Of rows that repeat doc_id and text one stays; a doc_id may stay with several texts. Columns stay,
    whatever they are called. No rows give none.
    """
    shared.ship(spark)
    joined = jaccard.placed_components(docs, COPY_PERCENT, COPY_WIDTH)
    kept = _kept(docs, joined.where("place <> component_place"))
    place, name, own = shared.row_key(), shared.fresh(docs, "repeated_place"), shared.fresh(docs, "own_place")
    repeated = kept.groupBy(place.alias(name)).count().where("count > 1").select(name)
    repeated = shared.stored(repeated, "repeated")
    if repeated.isEmpty():
        return kept
    same = place == F.col(name)
    once = kept.join(repeated, same, "left_semi").withColumn(own, place).dropDuplicates([own]).drop(own)
    return kept.join(repeated, same, "left_anti").unionByName(once)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item (0.8 of its five-word shingles), with all their columns, whatever these are called.

    A null or empty text contains none and stays, as do texts shorter than five words. Rows are judged each by its own text. No rows
    give none; without items all stay.
    """
    shared.ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(docs, contamination.contained_items(docs.withColumn("place", shared.row_key()), items, key="place"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data in their texts replaced by its kind, and n_chars, if there is such a column, counted anew.

    Null and empty texts and all other columns stay as they are. Rows that repeat are treated alike. No rows give none.
    """
    shared.ship(spark)
    return identifiers.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, as ``packing.digests`` gives them: of each row all ids, in order.

    A null or empty text is the end mark alone. Rows that repeat are packed each; a null doc_id stays null. Columns but doc_id and text are
    left out. No rows give none. The order of rows, and so what shares a sequence, is that in which the input's files are read.
    """
    shared.ship(spark)
    return packing.digests(packing.concatenate_and_cut(docs))


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", personal_data_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
