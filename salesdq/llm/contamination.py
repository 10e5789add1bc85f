"""Search for short test items inside long documents: MinHash over segments of a size that fits the items."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdq.llm import shared
from salesdq.llm import words as W

WIDTH = 5
THRESHOLD = 0.8
BINS = 256
#: The largest item, in shingles, of each size class; the next class goes eight times as far.
LEAST_CLASS = 64
#: Items of so few shingles are looked up by all of them: a minimum might hide their only common ones.
WHOLE = 8
#: Bytes of items that are sent to the documents; more of them are a table that documents meet in joins.
ITEM_BYTES = 8 << 20
#: Bits (a power of two) of what tells the tasks which hashes may be an item's: 8 MB.
SIEVE_BITS = 1 << 26
WHOLE_CLASS = -1


def size_class(n_shingles: int) -> int:
    """The least c with n_shingles <= LEAST_CLASS * 8**c."""
    c = 0
    while n_shingles > LEAST_CLASS * 8**c:
        c += 1
    return c


def _minima(hashes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation MinHash: of each group the least hash in each of BINS bins, as (group, hash) of non-empty bins.

    The bin is the hash modulo BINS, so a hash names its bin, and equal minima are equal hashes.
    """
    order = np.lexsort((hashes, hashes % np.uint64(BINS), group))
    h, g = hashes[order], group[order]
    cell = g.astype(np.int64) * BINS + (h % np.uint64(BINS)).astype(np.int64)
    least = np.flatnonzero(np.diff(cell, prepend=-1))
    return g[least], h[least]


def item_keys(shingles: np.ndarray) -> tuple[int, np.ndarray]:
    """Size class of an item and the hashes it is looked up by: minima, or all of the smallest items."""
    if len(shingles) <= WHOLE:
        return WHOLE_CLASS, shingles
    return size_class(len(shingles)), _minima(shingles, np.zeros(len(shingles), np.int64))[1]


def item_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Place and distinct shingles, in order, of each item that has some."""
    for w in W.split(texts, lower=True):
        at, h = w.shingles(WIDTH)
        owners, first = np.unique(w.row[at] + w.first, return_index=True)  # in order
        for i, own in zip(owners.tolist(), np.split(h, first[1:])):
            yield i, np.unique(own)


class Items:
    """Test items by the hashes they are looked up by, for each size class."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        self.sets, self.lists = {}, defaultdict(lambda: defaultdict(list))
        for i, shingles in item_sets(pa.array([t for _, t in rows], pa.string())):
            self.sets[i] = shingles
            c, keys = item_keys(shingles)
            for x in keys:
                self.lists[c][int(x)].append(i)
        self.ids = [k for k, _ in rows]
        self.keys = {c: np.array(sorted(x), np.uint64) for c, x in self.lists.items()}


def _member(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return keys[place] == values


def _document_keys(w: W.Words, at: np.ndarray, h: np.ndarray, classes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size class rows and hashes that items of it may be looked up by.

    Documents are partitioned by size: those of up to twice a class's largest item are one segment; longer ones are
    cut into segments of that size, each overlapping half of the next, so that an item lies whole in one and
    makes up enough of it for the Jaccard similarity to stay high.
    """
    row = w.row[at]
    place = at - w.begins()[row]
    for c in classes:
        if c == WHOLE_CLASS:
            yield c, row, h
            continue
        step = LEAST_CLASS * 8**c
        for shift in (0, 1):
            # segment s holds shingles step * s to step * (s + 2) - 1, so a shingle lies in s and s - 1
            segment = place // step - shift
            ok = segment >= 0
            groups, group = np.unique(row[ok].astype(np.int64) << 32 | segment[ok] // 2 * 2 + shift, return_inverse=True)
            # shift 0 gathers segments with even numbers, shift 1 those with odd ones
            g, m = _minima(h[ok], group)
            yield c, groups[g] >> 32, m


def _candidates(w: W.Words, at: np.ndarray, h: np.ndarray, items: Items) -> set[tuple[int, int]]:
    """Rows and items that share a minimum, or any shingle with one of the smallest items."""
    found = set()
    for c, row, m in _document_keys(w, at, h, items.keys):
        hit = _member(m, items.keys[c])
        for x, r in zip(m[hit].tolist(), row[hit].tolist()):
            found.update((r, i) for i in items.lists[c][x])
    return found


def _sent(source: DataFrame, rows: list[tuple[int, str | None]], threshold: float, key: str) -> DataFrame:
    """The pairs by sending all items to the documents."""
    sent = source.sparkSession.sparkContext.broadcast(rows)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(sent.value)
        for batch in parts:
            keys, pairs = batch.column("key"), []
            for w in W.split(batch.column("text"), lower=True):
                at, h = w.shingles(WIDTH)
                if not len(at) or not index.sets:
                    continue
                candidates = _candidates(w, at, h, index)
                bounds = np.searchsorted(w.row[at], np.arange(w.last - w.first + 1))
                for r, i in sorted(candidates):
                    wanted = index.sets[i]
                    share = np.isin(wanted, h[bounds[r] : bounds[r + 1]]).mean()
                    if share >= threshold:
                        pairs.append((keys[w.first + r].as_py(), index.ids[i], float(share)))
            if pairs:
                columns = [pa.array(c, t) for c, t in zip(zip(*pairs), (pa.int64(), pa.int64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, [key, "item_id", "containment"])

    return source.mapInArrow(run, f"{key} long, item_id long, containment double")


def _joined(source: DataFrame, items: DataFrame, threshold: float, key: str) -> DataFrame:
    """The pairs by joins: items and documents meet in the hashes they are looked up by, candidates in their shingles.

    A text stands for all documents that have it. What a task passes on of a document are hashes that the sieves let through.
    """
    spark = source.sparkSession
    text = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.col("text")).alias("b"))
    numbered = items.select("item_id", "text", F.monotonically_increasing_id().alias("item"))

    def items_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows = [(i, *item_keys(shingles), shingles) for i, shingles in item_sets(batch.column("text"))]
            own = [batch.column(c).take(pa.array([r[0] for r in rows], pa.int64())) for c in ("item_id", "item")]
            lists = [pa.array([r[j].view(np.int64) for r in rows], pa.list_(pa.int64())) for j in (2, 3)]
            yield pa.RecordBatch.from_arrays([*own, pa.array([r[1] for r in rows], pa.int32()), *lists], ["item_id", "item", "class", "keys", "shingles"])

    table = shared.stored(numbered.mapInArrow(items_of, "item_id long, item long, class int, keys array<long>, shingles array<long>"), "items")
    classes = sorted(r[0] for r in table.select("class").distinct().collect())  # one for each power of eight
    looked_up = table.select("item", "class", F.explode("keys").alias("h"))
    wanted = table.select("item", F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
    sieves = [spark.sparkContext.broadcast(W.sieve(x.select("h"), SIEVE_BITS)) for x in (looked_up, wanted)]

    def hashes(sieve, keyed: bool):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in parts:
                for w in W.split(batch.column("text"), lower=True):
                    at, h = w.shingles(WIDTH)
                    found = _document_keys(w, at, h, classes) if keyed else [(0, w.row[at], h)]
                    for c, row, m in found:
                        good = W.sifted(m.view(np.int64), sieve.value)
                        own = batch.column("t").take(pa.array(w.first + row[good]))
                        columns = [own, pa.array(np.full(good.sum(), c, np.int32)), pa.array(m[good].view(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, ["t", "class", "h"])

        return run

    kind = "t struct<a: long, b: long>, class int, h long"
    texts = source.where("text is not null").select(text.alias("t"), "text")
    met = texts.mapInArrow(hashes(sieves[0], True), kind).join(looked_up, ["class", "h"])
    pairs = shared.stored(met.select("t", "item").distinct(), "pairs")
    chosen = texts.join(pairs.select("t").distinct(), "t", "left_semi")
    shingles = chosen.mapInArrow(hashes(sieves[1], False), kind).select("t", "h").distinct()
    both = pairs.join(wanted, "item").join(shingles, ["t", "h"]).groupBy("t", "item", "n").agg(F.count("*").alias("k"))
    share = (F.col("k") / F.col("n")).alias("containment")
    good = both.select("t", "item", share).where(F.col("containment") >= threshold).join(table.select("item", "item_id"), "item")
    return source.select(F.col("key").alias(key), text.alias("t")).join(good, "t").select(key, "item_id", "containment")


def contained_items(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs of a document and an item of which it contains at least ``threshold``: (doc key, item_id, containment).

    Containment is the share of the item's distinct shingles (WIDTH words, A-Z in lower case) that the document has anywhere.
    Candidates share a MinHash minimum with the item in some segment; each is then verified on all shingles.
    A segment has at most half as many shingles as bins in the least size class and four times as many in the others, so a common
    shingle is a minimum of both with a probability of about 0.8 or 0.25. An item of nine shingles, one of which may be
    missing, is overlooked in some five of a million cases, larger ones more rarely; items of up to WHOLE shingles never.

    The items are the query set. Up to ITEM_BYTES they are sent to the documents, which are streamed where they are read; nothing of
    them is shuffled, and copies or hot passages cost no more. More of them are a table, which the documents meet in joins: a
    second pass reads the candidates, however many items there are. The pairs are the same.
    An item of fewer than WIDTH words, or null, has no shingle and is in no document. A document without shingles
    contains nothing. Repeated documents or items give their pairs again. Null keys stay null. Other columns are left out.
    """
    source = documents.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(16))).first()[0] or 0
    if size > ITEM_BYTES:
        return _joined(source, items, threshold, key)
    return _sent(source, [tuple(r) for r in items.collect()], threshold, key)


def op8_benchmark_containment(spark, sf_dir: str) -> DataFrame:
    """All documents that contain a benchmark item, by item."""
    documents, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contained_items(documents, items)
