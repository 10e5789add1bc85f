"""Removal of passages that repeat an earlier document's, located by sharded Aho-Corasick automata.

A window is WINDOW consecutive words. Each window is filed under its anchor, the least hash of its ANCHOR-word runs, so
equal windows share an anchor, and neighbouring windows mostly do. Anchors met in one text only are dropped at once. The rest are
shards: all stretches of documents filed under an anchor meet in one place, where the windows that recur are confirmed word by
word and compiled into an automaton, and the stretches are streamed through it for every occurrence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdq.llm import shared
from salesdq.llm import words as W

WINDOW, ANCHOR = 13, 5
#: Distinct stretches that one automaton serves, unless a single anchor has more.
SHARD_STRETCHES = 10_000
EMPTY = hashlib.sha256(b"").hexdigest()


def _anchors(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor, row, first word within the row, and number of windows."""
    n = len(w.hashes) - WINDOW + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4
    h = W.combined(w.hashes, ANCHOR)
    span = WINDOW - ANCHOR + 1
    least, width = h, 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = np.flatnonzero(w.row[:n] == w.row[WINDOW - 1 :])
    least, row = least[at], w.row[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(at)))
    return least[first].view(np.int64), row[first], (at - w.begins()[row])[first], counts


def _kept(w: W.Words, keep: np.ndarray) -> list[str]:
    """SHA-256 of each row's kept words, joined by one space."""
    rows = w.last - w.first
    starts, ends, row = w.starts[keep], w.ends[keep], w.row[keep]
    if not len(starts):
        return [EMPTY] * rows
    inner = np.ones(len(starts), bool)
    inner[0], inner[1:] = False, row[1:] == row[:-1]
    edges = np.zeros(len(w.data) + 1, np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    inside = np.cumsum(edges[:-1]).astype(bool)
    data = w.data.copy()
    data[starts[inner] - 1] = 0x20  # white space stands before any word but a row's first
    inside[starts[inner] - 1] = True
    joined = data[inside].tobytes()
    sizes = np.bincount(row, weights=ends - starts + inner, minlength=rows).astype(np.int64)
    cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return [hashlib.sha256(joined[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]


def _anchor_rows(source: DataFrame) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "key"))
            for w in W.split(batch.column("text")):
                anchor, row, start, n = _anchors(w)
                columns = [anchor, ids[w.first + row], keys[w.first + row], start.astype(np.int32), n.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "doc_id", "key", "start", "n"])

    return source.mapInArrow(run, "anchor long, doc_id long, key long, start int, n int")


def _facts(source: DataFrame) -> DataFrame:
    """Per row: doc_id, key of the text, number of words, and the digest of all of them."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for w in W.split(batch.column("text")):
                own = [batch.column(c).slice(w.first, w.last - w.first) for c in ("doc_id", "key")]
                columns = [*own, pa.array(w.counts()), pa.array(_kept(w, np.ones(len(w.starts), bool)), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_words", "whole"])

    return source.mapInArrow(run, "doc_id long, key long, n_words long, whole string")


def _stretches(candidates: DataFrame) -> DataFrame:
    """Per run of windows with a recurring anchor: the anchor, the document, its first word and the words, joined by a space."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids, keys, runs = (batch.column(c).to_pylist() for c in ("doc_id", "key", "runs"))
            for w in W.split(batch.column("text")):
                begins, out = w.begins(), []
                for i in range(w.last - w.first):
                    for r in runs[w.first + i]:
                        a = begins[i] + r["start"]
                        b = a + r["n"] + WINDOW - 1
                        words = w.data[w.starts[a] : w.ends[b - 1]].tobytes()
                        out.append((r["anchor"], ids[w.first + i], keys[w.first + i], r["start"], words))
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 3, pa.int32(), pa.binary()))]
                    yield pa.RecordBatch.from_arrays(columns, ["anchor", "doc_id", "key", "start", "words"])

    return candidates.mapInArrow(run, "anchor long, doc_id long, key long, start int, words binary")


def occurrences(stretches: dict[bytes, list[tuple[int, int, int]]]) -> Iterator[tuple[int, int, int, int]]:
    """Runs of words (document, key, first word, number) covered by windows that are also in a smaller document.

    stretches: words of a stretch, and all its places as (document, key, first word).
    """
    import ahocorasick

    numbers: dict[bytes, int] = {}
    texts = [(tuple([numbers.setdefault(x, len(numbers)) for x in words.split()]), places) for words, places in stretches.items()]
    least: dict[tuple, int] = {}
    again: set[tuple] = set()
    for ids, places in texts:
        low, many = min(p[0] for p in places), any(p[0] != places[0][0] for p in places)
        for i in range(len(ids) - WINDOW + 1):
            window = ids[i : i + WINDOW]
            owner = least.setdefault(window, low)
            if many or owner != low:
                again.add(window)
                if low < owner:
                    least[window] = low
    if not again:
        return
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window in again:
        automaton.add_word(window, least[window])
    automaton.make_automaton()
    for ids, places in texts:
        found = [(end - WINDOW + 1, owner) for end, owner in automaton.iter(ids)]
        for doc, key, start in places:
            first = last = -1
            for at, owner in found:
                if owner >= doc:
                    continue
                if at > last:
                    if first >= 0:
                        yield doc, key, start + first, last - first
                    first = at
                last = at + WINDOW
            if first >= 0:
                yield doc, key, start + first, last - first


def _located(stretches: DataFrame, parts: int) -> DataFrame:
    """Covered runs of words, shard by shard: the anchors of a partition in order, cut into shards of SHARD_STRETCHES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[tuple[int, int, int]]] = {}
        now = None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, [pa.int64()] * 4)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "start", "n"])

        for b in batches:
            for anchor, doc, key, start, words in zip(*(c.to_pylist() for c in b.columns)):
                if anchor != now:
                    if len(held) >= SHARD_STRETCHES:
                        yield batch(list(occurrences(held)))
                        held = {}
                    now = anchor
                held.setdefault(b" ".join(words.split()), []).append((doc, key, start))
        yield batch(list(occurrences(held)))

    return stretches.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(run, "doc_id long, key long, start long, n long")


def _removed(candidates: DataFrame) -> DataFrame:
    """Number of removed words and digest of the kept ones, of documents with ``covered`` runs."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            covered = batch.column("covered").to_pylist()
            for w in W.split(batch.column("text")):
                keep, begins = np.ones(len(w.starts), bool), w.begins()
                for i in range(w.last - w.first):
                    for r in covered[w.first + i]:
                        keep[begins[i] + r["start"] : begins[i] + r["start"] + r["n"]] = False
                gone = np.bincount(w.row[~keep], minlength=w.last - w.first)
                own = [batch.column(c).slice(w.first, w.last - w.first) for c in ("doc_id", "key")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(gone), pa.array(_kept(w, keep), pa.string())], ["doc_id", "key", "gone", "rest"])

    return candidates.mapInArrow(run, "doc_id long, key long, gone long, rest string")


def without_repeats(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by one space).

    A word is removed if it is covered by a window whose words also begin a window in a document with a smaller doc_id.
    Of equal texts only the smallest doc_id is searched; the others are wholly removed, or wholly kept if too short for a window.
    A null or empty text has no words. Rows that repeat a doc_id do not repeat each other, but are judged against smaller ids, each by
    its own text. A null doc_id is neither smaller nor larger: its text is kept. Other columns are left out.
    """
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("key", F.xxhash64("text"))
    known = source.where("doc_id is not null and text is not null")
    facts = shared.stored(_facts(source), "facts")
    first = facts.groupBy("key").agg(F.min("doc_id").alias("least"))
    rows = _anchor_rows(known)
    recurring = rows.groupBy("anchor").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a < b").select("anchor")
    hits = rows.join(recurring, "anchor").join(first.withColumnRenamed("least", "doc_id"), ["key", "doc_id"])
    runs = hits.groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "n", "anchor")).alias("runs"))
    runs = shared.stored(runs, "runs")
    parts, row = shared.partitions(documents), ["doc_id", "key"]
    # texts are shuffled once: their table keeps the partitions for the second join
    candidates = known.repartition(parts, *row).join(runs, row).dropDuplicates(row)
    candidates, table = shared.bucketed(candidates, "candidates", row, parts)
    covered = _located(_stretches(candidates), parts).repartition(parts, *row)
    covered = covered.groupBy(*row).agg(F.collect_set(F.struct("start", "n")).alias("covered"))
    removed = shared.stored(_removed(candidates.drop("runs").join(covered, row)), "removed")
    source.sparkSession.sql(f"DROP TABLE {table}")
    removed = removed.select(F.col("doc_id").alias("id"), F.col("key").alias("k"), "gone", "rest")
    joined = facts.join(first, "key", "left").join(removed, (F.col("doc_id") == F.col("id")) & (F.col("key") == F.col("k")), "left")
    copy = (F.col("doc_id") > F.col("least")) & (F.col("n_words") >= WINDOW)
    return joined.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("rest", "whole")).alias("kept_sha256"),
    )


def op6_repeated_passages(spark, sf_dir: str) -> DataFrame:
    """All documents without the passages that repeat an earlier document's."""
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
