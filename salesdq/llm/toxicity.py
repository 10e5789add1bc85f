"""A score of toxicity, learned from confirmed toxic documents and unlabelled text.

Non-negative positive-unlabelled learning: the risk of a classifier is estimated from two samples only, confirmed documents (P) and
documents of unknown kind (U), and the share of toxic documents, the class prior. On clean text the risk is that on U less the prior
times that on P taken for clean; as no risk is negative, an estimate below zero is overfitting, and training steps back from it.

The classifier is linear in the words that a document has (hashed, in lower case, without signs). A bounded sample teaches it, in the
driver; every document is scored by its whole text, in the tasks that read it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdq.llm import words as W

#: Bytes of texts as words are split from: A-Z in lower case, and a space for every other sign of ASCII.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[:128] = [c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(128)]


@dataclass(frozen=True)
class Model:
    """bits: words are hashed into 2 to the bits buckets. confirmed, unlabelled: most rows of P and of U that teach; most_words: rows
    with more different words teach nothing. lift: standard deviations by which a bucket must be met more often in P than in U to
    count. prior: share of toxic documents where the labels name no clean ones. decay: weight of the squared weights in
    the loss. steps, rate: of the descent. slack, back: risk below zero that is let pass, and the rate of steps back from it."""

    bits: int = 18
    confirmed: int = 6000
    unlabelled: int = 12000
    most_words: int = 3000
    lift: float = 3.0
    prior: float = 0.05
    decay: float = 5e-5
    steps: int = 300
    rate: float = 0.1
    slack: float = 0.0
    back: float = 1.0


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray  # one for each bucket
    bias: float


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept back: crc32 of the id as text, modulo 5, is 0. A null id counts as an empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


# --- features


def word_buckets(texts: pa.Array, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """By slices of rows: first and behind-last row, and for each word its row in the slice and its bucket."""
    data, offsets = W.buffers(texts)
    plain = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(PLAIN[data]))
    for w in W.split(plain):
        yield w.first, w.last, w.row, (w.hashes >> np.uint64(64 - bits)).astype(np.int64)


def _distinct(row: np.ndarray, bucket: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's different buckets, in order."""
    both = np.unique((row.astype(np.int64) << bits) | bucket)
    return both >> bits, both & ((1 << bits) - 1)


# --- learning


def learned(rows: np.ndarray, buckets: np.ndarray, confirmed: np.ndarray, prior: float, model: Model) -> Classifier:
    """A classifier from documents given as (row, bucket) pairs; ``confirmed`` says for each row whether it belongs to P, others to U.

    With logistic loss, full batches and a fixed start, so the same rows in the same order give the same weights.
    """
    n, n_p, n_u = len(confirmed), int(confirmed.sum()), int((~confirmed).sum())
    met = np.bincount(buckets[confirmed[rows]], minlength=1 << model.bits)
    expected = np.bincount(buckets[~confirmed[rows]], minlength=1 << model.bits) * (n_p / n_u)
    chosen = np.flatnonzero(met - expected >= model.lift * np.sqrt(expected + 1))
    place = np.full(1 << model.bits, -1)
    place[chosen] = np.arange(len(chosen))
    of = place[buckets]
    rows, of = rows[of >= 0], of[of >= 0]
    in_p, in_u = np.where(confirmed, prior / n_p, 0.0), np.where(confirmed, 0.0, 1.0 / n_u)
    w, b = np.zeros(len(chosen)), np.log(prior / (1 - prior))
    first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, model.steps + 1):
        z = np.bincount(rows, w[of], n) + b
        toxic = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        softplus = np.logaddexp(0, z)  # loss of taking a row for clean
        clean_risk = ((in_u - in_p) * softplus).sum()
        if clean_risk >= -model.slack:
            slope = (in_u - in_p) * toxic + in_p * (toxic - 1)
        else:  # step back: raise the part that overfits
            slope = -model.back * (in_u - in_p) * toxic
        change = np.append(np.bincount(of, slope[rows], len(chosen)) + model.decay * w, slope.sum())
        first = 0.9 * first + 0.1 * change
        second = 0.999 * second + 0.001 * change * change
        move = model.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    weights = np.zeros(1 << model.bits, np.float32)
    weights[chosen] = w
    return Classifier(weights, float(b))


def _sample(documents: DataFrame, labels: DataFrame, model: Model) -> DataFrame:
    """Rows that teach: doc_id, text and confirmed; none of them held out.

    Ids are drawn first, by least hash, from narrow columns; their rows are then found in one pass over the texts, and drawn once more by
    hash, as an id may have any number of rows. Drawn ids are bounded by the model, 8 bytes each, so they are broadcast.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("id"), "toxic").where("id is not null and toxic = 1")
    usable = usable.where(~held_out(F.col("id"))).select("id").distinct()
    drawn = F.xxhash64(F.lit(13), F.col("id"))
    confirmed = usable.orderBy(drawn, "id").limit(model.confirmed).withColumn("confirmed", F.lit(True))
    every = documents.select(F.col("doc_id").cast("long").alias("id")).where("id is not null").where(~held_out(F.col("id"))).distinct()
    unknown = every.orderBy(drawn, "id").limit(model.unlabelled).withColumn("confirmed", F.lit(False))
    chosen = confirmed.unionByName(unknown)
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "text", "confirmed")


def _taught(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row, bucket) of the sample, and which rows are confirmed, in an order that depends on the rows alone."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for start, end, row, bucket in word_buckets(batch.column("text"), model.bits):
                row, bucket = _distinct(row, bucket, model.bits)
                sizes = np.bincount(row, minlength=end - start)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32)))
                known = [batch.column(c).slice(start, end - start) for c in ("doc_id", "confirmed")]
                fits = pa.array(sizes <= model.most_words)
                yield pa.RecordBatch.from_arrays([c.filter(fits) for c in (*known, lists)], ["doc_id", "confirmed", "buckets"])

    rows = sample.mapInArrow(run, "doc_id long, confirmed boolean, buckets array<int>")
    order = [F.xxhash64(F.lit(13), F.col("doc_id")), F.xxhash64("buckets"), "doc_id"]
    kinds = ((True, model.confirmed), (False, model.unlabelled))
    taken = [rows.where(F.col("confirmed") == kind).orderBy(*order).limit(most).select("confirmed", "buckets") for kind, most in kinds]
    table = taken[0].unionByName(taken[1]).toArrow().combine_chunks()
    confirmed = np.asarray(table.column("confirmed").combine_chunks()) if len(table) else np.zeros(0, bool)
    confirmed = confirmed.astype(bool)
    lists = [np.asarray(x, np.int64) for x in table.column("buckets").to_pylist()]
    sizes = [len(x) for x in lists]
    order = np.lexsort((np.arange(len(lists)), ~confirmed))
    rows = np.repeat(np.arange(len(lists)), [sizes[i] for i in order])
    return rows, np.concatenate([*(lists[i] for i in order), np.zeros(0, np.int64)]), confirmed[order]


def class_prior(labels: DataFrame, model: Model) -> float:
    """Share of toxic ids among the labelled ones that are not held out; the model's where no id is labelled clean, or none toxic."""
    each = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id").cast("long")))
    each = each.groupBy("doc_id").agg(F.max(F.col("toxic") == 1).cast("long").alias("toxic"))
    r = each.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    return r["t"] / r["n"] if 0 < r["t"] < r["n"] else model.prior


def taught(documents: DataFrame, labels: DataFrame, model: Model = Model()) -> Classifier:
    """The classifier that confirmed rows and unlabelled ones teach; without any of either it gives every text the prior."""
    prior = class_prior(labels, model)
    rows, buckets, confirmed = _taught(_sample(documents, labels, model), model)
    if not 0 < confirmed.sum() < len(confirmed):
        return Classifier(np.zeros(1 << model.bits, np.float32), float(np.log(prior / (1 - prior))))
    return learned(rows, buckets, confirmed, prior, model)


# --- scoring


def scores(texts: pa.Array, classifier: Classifier) -> np.ndarray:
    """For each text the logistic value of its different words' weights: 0 to 1, by whole texts."""
    bits = len(classifier.weights).bit_length() - 1
    out = [np.zeros(0)]
    for start, end, row, bucket in word_buckets(texts, bits):
        counts = classifier.weights[bucket] != 0
        row, bucket = _distinct(row[counts], bucket[counts], bits)
        z = np.bincount(row, classifier.weights[bucket].astype(np.float64), end - start) + classifier.bias
        out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return np.concatenate(out)


def toxicity(documents: DataFrame, labels: DataFrame, model: Model = Model()) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1) and predicted (1 from a score of 0.5).

    A null or empty text, or one without words, scores what the classifier gives no words. A null doc_id is held out and teaches nothing.
    Rows that repeat are scored each. An id with several labels is confirmed if one of them is toxic; null labels say nothing. Without
    confirmed rows all texts score the prior. An empty table gives no rows. Other columns are left out.
    """
    spark = documents.sparkSession
    known = spark.sparkContext.broadcast(taught(documents, labels, model))  # 4 bytes for each bucket

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            score = scores(batch.column("text"), known.value)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id").cast("long")).alias("held_out")
    )
    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, taught by the labels."""
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity(documents, labels)
