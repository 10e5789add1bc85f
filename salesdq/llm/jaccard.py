"""Similarity join of documents on word shingles, by set size: subsets for small sets, inverted lists for large ones.

Two sets link when their Jaccard similarity is at least PERCENT / 100; callers may give another width and percentage. Equal sets are one node throughout, so a group of copies
counts once, however large. Small sets enumerate their subsets of a few elements less; large sets meet in
inverted lists of their rarest elements. Where the boundary lies, the costs of both ways decide, as a sample shows them. In a list two
sets are candidates if their sizes, their places in the list's order, and the bits in which short sums of their elements differ
leave a similarity of PERCENT / 100 possible; each of these bounds is exact, so no link is lost, and hardly another pair passes.
Candidates are verified on whole sets: first each set with one candidate, which joins most groups of near copies at once; then
what is still apart in a cluster of candidates, in blocks, by list scans. So neither pairs nor a list or cluster of any size are ever
laid out as rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesdq.llm import shared
from salesdq.llm import words as W
from salesdq.llm.graph import connected_components
from salesdq.llm.tokens import ranges
from salesdq.plans import join_many_to_one

WIDTH, PERCENT = 3, 90
#: One text in so many (by its hash) shows which elements are frequent and what lists cost. An element met FREQUENT times there is
#: frequent; of the most frequent, MOST_FREQUENT at most (16 bytes each) are sent to the tasks. They only order the elements and deal out lists: links
#: depend on neither.
SAMPLED, FREQUENT, MOST_FREQUENT = 64, 4, 1 << 18
#: Sets of a list, of a cluster, or around one candidate that are compared in one group; elements of a group of whole sets.
LIST_SETS, BLOCK_SETS, STAR_SETS, BLOCK_ELEMENTS = 10_000, 1500, 250, 1 << 18
#: Most elements less in a subset.
MOST_LESS = 2
#: Percentage from which signatures have half as many bits: unrelated sets of n elements then differ in n / 4 bits or more, linked ones in n / 9.
NARROW = 90
#: Cost of a recurring row of a list, and of a pair compared there, in rows shuffled.
RECURRING, COMPARED = 3.0, 0.01
#: Rows of (document, groups) that are broadcast at most, some 60 bytes each; beyond, documents are shuffled to them.
BROADCAST_MEMBERS = 1_000_000
#: 64-bit words of signatures that are compared at a time.
SLICE_WORDS = 1 << 20

SETS = (
    "doc_id long, place long, n long, key long, elements array<long>, blocks array<int>, signature binary, subsets array<long>"
)


def prefix(n, percent: int = PERCENT):
    """How many of the first elements two linked sets must share one of: n - ceil(percent * n / 100) + 1."""
    return n - (percent * n + 99) // 100 + 1


def apart(union: int, percent: int) -> int:
    """In how many elements two linked sets of this union differ at most."""
    return (100 - percent) * union // 100


def least_linked(percent: int) -> int:
    """Smallest size of a set that can link with a different one."""
    return next(n for n in range(1, 101) if 100 * n >= percent * (n + 1))


@dataclass(frozen=True)
class Plan:
    """How sets meet: links of a union up to ``edge`` by subsets, of a larger one by lists; frequent elements come last in the order.

    frequent: sorted elements, rank: their order from the rarest, blocks: in how many blocks their lists are dealt.
    """

    percent: int
    edge: int
    frequent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    blocks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def less(self) -> int:
        return apart(self.edge, self.percent)

    @property
    def least_listed(self) -> int:
        """Smallest size of a set that can be in a link of a union beyond the edge."""
        return max(least_linked(self.percent), (self.percent * (self.edge + 1) + 99) // 100)


def furthest_edge(percent: int) -> int:
    """Largest union whose links differ in MOST_LESS elements at most."""
    return (100 * (MOST_LESS + 1) - 1) // (100 - percent) if percent < 100 else 0


def cheapest_edge(percent: int, listed: dict[int, tuple[int, float]]) -> int:
    """The edge up to which subsets cost less than lists.

    listed: for each size the sampled sets and what their lists cost in rows. A set of n elements costs a row for each subset of up to
    as many elements less as links of the edge may differ in; sets near the edge take part in both.
    """

    def cost(edge: int) -> float:
        plan, total = Plan(percent, edge), 0.0
        for n, (sets, in_lists) in listed.items():
            if n <= edge:
                total += sets * sum(comb(n, j) for j in range(plan.less + 1))
            if n >= plan.least_listed:
                total += in_lists
        return total

    return min(range(furthest_edge(percent) + 1), key=lambda edge: (cost(edge), edge))


def _sets(w: W.Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of all rows in order of (row, element), their rows, and each row's size."""
    at, h = w.shingles(width)
    row, rows, counts, begins = w.row[at], w.last - w.first, w.counts(), w.begins()
    for short in range(1, width):  # the whole sequence as one
        these = np.flatnonzero(counts == short)
        if len(these):
            whole = W.combined(w.hashes, short)[begins[these]] ^ np.uint64(short)
            row, h = np.concatenate([row, these]), np.concatenate([h, W.mixed(whole)])
    h = h >> np.uint64(1)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new], np.bincount(row[new], minlength=rows)


def _keys(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key of each row's set, and each element's part in it: keys are sums of parts."""
    part = W.mixed(h + np.uint64(0x9E3779B97F4A7C15))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes], part


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _signatures(h: np.ndarray, n: np.ndarray, percent: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Short sums of sets: n bits or more (a power of two, 64 at least), each of which says whether an odd number of elements fall on it.

    Two sets differ in at least as many elements as their sums differ in bits; a sum is folded to half its bits by combining its
    halves. From NARROW percent on, linked sets differ in so few elements that sums of half as many bits tell others apart. Returns the
    bytes of all rows and each row's number of bytes.
    """
    wanted = n / 2 if percent >= NARROW else n
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(wanted, 1))).astype(np.int64)) * (n > 0)
    begins = np.cumsum(bits) - bits
    row = np.repeat(np.arange(len(n)), n)
    at = begins[row] + (h.astype(np.int64) & (bits[row] - 1))
    odd = np.bincount(at, minlength=int(bits.sum())) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little"), bits // 8


def _subsets(key: np.ndarray, part: np.ndarray, n: np.ndarray, wanted: np.ndarray, less: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the subsets of up to ``less`` elements less, the set itself included, of the wanted rows; and their number by row."""
    begins, out, counts = np.cumsum(n) - n, [], np.zeros(len(n), np.int64)
    for i in np.flatnonzero(wanted):
        own = part[begins[i] : begins[i] + n[i]]
        keys = [key[i : i + 1], key[i] - own][: less + 1]
        if less > 1:
            first, second = np.triu_indices(len(own), 1)
            keys.append(key[i] - own[first] - own[second])
        out += keys
        counts[i] = sum(map(len, keys))
    return np.concatenate([np.zeros(0, np.uint64), *out]), counts


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), shared.row_key().alias("place"))


def planned(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH, sampled: int = SAMPLED) -> Plan:
    """Frequent elements and the boundary, from the different texts whose hash falls on one value in ``sampled``."""
    edge = furthest_edge(percent)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for w in W.split(batch.column("text"), lower=True):
                h, row, n = _sets(w, width)
                first = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n) < prefix(n, percent)[row]
                columns = [pa.array(h.view(np.int64)), pa.array(n[row]), pa.array(first)]
                yield pa.RecordBatch.from_arrays(columns, ["e", "n", "first"])

    digest = F.xxhash64(F.col("text").cast("string"))
    texts = documents.where("text is not null").select(F.col("text").cast("string").alias("text"), digest.alias("digest"))
    texts = texts.where(F.pmod("digest", F.lit(sampled)) == 0).dropDuplicates(["digest"]).select("text")
    rows = shared.stored(texts.mapInArrow(run, "e long, n long, first boolean"), "sample")
    counts = rows.groupBy("e").agg(F.count("*").alias("c")).where("c > 1")
    counts = shared.stored(counts, "sample-counts")
    levels = counts.where(f"c >= {FREQUENT}").groupBy("c").agg(F.count("*").alias("k")).orderBy(F.desc("c")).limit(MOST_FREQUENT).collect()
    kept, least = 0, None
    for r in levels:  # the most frequent, as many as are sent
        if kept + r["k"] > MOST_FREQUENT:
            break
        kept, least = kept + r["k"], r["c"]
    found = counts.where(F.col("c") >= least).orderBy("c", "e").toArrow() if least else None
    frequent = np.asarray(found.column("e"), np.int64) if least else np.zeros(0, np.int64)
    met = np.asarray(found.column("c"), np.int64) if least else np.zeros(0, np.int64)

    small = rows.where(f"n between {least_linked(percent)} and {edge}").groupBy("e", "n", "first").agg(F.count("*").alias("k"))
    alone = F.coalesce("c", F.lit(1))  # in the sample; all in all, met so many times as often if it recurs there at all
    each = 1 + F.when(alone > 1, RECURRING + COMPARED * alone * sampled / 2).otherwise(0.0)
    cost = F.sum(F.when(F.col("first"), F.col("k") * each).otherwise(0.0))
    listed = small.join(counts, "e", "left").groupBy("n").agg((F.sum("k") / F.col("n")).alias("sets"), cost.alias("cost")).collect()
    order = np.argsort(frequent)
    blocks = np.maximum(1, -(-met * sampled // LIST_SETS))
    chosen = cheapest_edge(percent, {r["n"]: (r["sets"], r["cost"]) for r in listed})
    return Plan(percent, chosen, frequent[order], order, blocks[order])


def shingle_sets(documents: DataFrame, plan: Plan, width: int = WIDTH) -> DataFrame:
    """Per row: doc_id, place (hash of doc_id and text), set size n and key. For sets that are listed: their first elements, frequent ones
    with the blocks of their lists (others: 0), and the signature. For small sets: the keys of subsets."""
    broadcast = documents.sparkSession.sparkContext.broadcast(plan)  # 24 bytes for each frequent element

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = broadcast.value
        for batch in parts:
            ids, places = batch.column("doc_id"), batch.column("place")
            for w in W.split(batch.column("text"), lower=True):
                h, row, n = _sets(w, width)
                key, part = _keys(h, n)
                listed = n >= plan.least_listed
                mine = listed[row]
                e, rows, m = h[mine], row[mine], np.where(listed, n, 0)
                signature, size = _signatures(e, m, plan.percent)
                rank, blocks = _ranked(e.view(np.int64), plan)
                order = np.lexsort((rank, rows))  # stable: by hash among the others
                e, rows, blocks = e[order], rows[order], blocks[order]
                wanted = np.where(listed, prefix(n, plan.percent), 0)
                first = np.arange(len(e)) - (np.cumsum(m) - m)[rows] < wanted[rows]
                subsets, subset_counts = _subsets(key, part, n, (n > 0) & (n <= plan.edge), plan.less)
                columns = [x.slice(w.first, w.last - w.first) for x in (ids, places)]
                columns += [pa.array(n), pa.array(key.view(np.int64)), _lists(e[first].view(np.int64), wanted)]
                columns += [_lists(blocks[first].astype(np.int32), wanted), _binaries(signature, size), _lists(subsets.view(np.int64), subset_counts)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SETS.split(", ")])

    return _texts(documents).mapInArrow(run, SETS)


def _ranked(e: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Each element's rank among the frequent ones (others: -1) and the blocks of its list (others: 0)."""
    rank, blocks = np.full(len(e), -1), np.zeros(len(e), np.int64)
    if len(plan.frequent):
        at = np.minimum(np.searchsorted(plan.frequent, e), len(plan.frequent) - 1)
        met = plan.frequent[at] == e
        rank[met], blocks[met] = plan.rank[at[met]], plan.blocks[at[met]]
    return rank, blocks


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


# --- candidates


def _listed(large: DataFrame, percent: int) -> DataFrame:
    """Rows of the lists, dealt to groups (e, band, i, j): key, n, signature, at (place in the set's own order) and side.

    In the list of an element that is not frequent a set stays only if the next one or the one before in order of size is near enough to its
    own size for a link; most chance meetings end here, before they take up a row with a signature. A list of one block is one group. A longer one is dealt
    to bands of sizes and to pairs of blocks: sets of sizes that may link lie in one band or in neighbouring ones, and a set takes part in
    its own band's groups and, as a lower one, in the next one's. Two rows of a group meet elsewhere if both are lower (side below 0),
    or if they are of one block in a group of two (equal sides above 0).
    """
    entries = large.select("key", "n", F.posexplode(F.arrays_zip("elements", "blocks")).alias("at", "x"))
    entries = entries.select("key", "n", "at", F.col("x.elements").alias("e"), F.col("x.blocks").alias("blocks"))
    rows = shared.stored(_near_in_size(entries.where("blocks = 0"), percent).unionByName(entries.where("blocks > 0")), "entries")
    dealt = F.col("blocks") > 1
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(log(100 / percent) * 1.000001)).cast("int")
    rows = rows.withColumn("band", F.when(dealt, band).otherwise(0))
    rows = rows.withColumn("mine", F.expr("cast(pmod(xxhash64(key), greatest(blocks, 1)) as int)"))
    rows = rows.withColumn("lower", F.explode(F.when(dealt, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, greatest(blocks, 1) - 1)")))
    i, j = F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")
    side = F.when(F.col("lower"), -1 - F.col("mine")).otherwise(F.when(F.col("mine") == F.col("other"), 0).otherwise(1 + F.col("mine")))
    rows = rows.select("e", (F.col("band") + F.col("lower").cast("int")).alias("band"), i, j, "key", "n", "at", side.alias("side"))
    return rows.join(large.select("key", "signature"), "key")


def _near_in_size(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (e, n, ...) that have another one of the same e whose n differs so little that the two may link."""
    order = Window.partitionBy("e").orderBy("n")
    below = F.coalesce(100 * F.lag("n").over(order) >= percent * F.col("n"), F.lit(False))
    above = F.coalesce(100 * F.col("n") >= percent * F.lead("n").over(order), F.lit(False))
    return rows.withColumn("met", below | above).where("met").drop("met")


def _passing(x: np.ndarray, y: np.ndarray, n: np.ndarray, at: np.ndarray, size: np.ndarray, begin: np.ndarray, words: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs (x, y), n of x at least that of y, may be links by place and signature."""
    total = n[x] + n[y]
    enough = lambda overlap: (100 + percent) * overlap >= percent * total
    good = enough(np.minimum(n[x] - at[x], n[y] - at[y]))  # if this is the first element that they share
    for wide, narrow in {*zip(size[x[good]].tolist(), size[y[good]].tolist())}:
        these = np.flatnonzero(good & (size[x] == wide) & (size[y] == narrow))
        a = words[begin[x[these]][:, None] + np.arange(wide)]
        b = words[begin[y[these]][:, None] + np.arange(narrow)]
        while a.shape[1] > narrow:
            half = a.shape[1] // 2
            a = a[:, :half] ^ a[:, half:]
        differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        good[these] = (100 + percent) * ((total[these] - differ) // 2) >= percent * total[these]
    return good


def _united(group: np.ndarray, n: np.ndarray, at: np.ndarray, side: np.ndarray, key: np.ndarray, signature: list[bytes], percent: int):
    """Of the entries of some whole groups: (label, first) for each, places of the least entry that candidates connect it with, and of the
    first entry that is its own candidate; both its own where there is none."""
    order = np.lexsort((key, n, group))
    group, n, at, side, key = group[order], n[order], at[order], side[order], key[order]
    words = np.frombuffer(b"".join(signature[i] for i in order), np.uint64)
    size = np.array([len(signature[i]) // 8 for i in order], np.int64)
    begin = np.cumsum(size) - size
    m = len(order)
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    start = np.repeat(heads, np.diff(np.append(heads, m)))
    # the first entry of the own group that is not too small
    need = (percent * n + 99) // 100
    base = group * (int(n.max()) + 1)
    start = np.maximum(start, np.searchsorted(base + n, base + need, side="left"))
    counts = np.arange(m) - start
    label, first = np.arange(m), np.arange(m)
    done, begins = 0, np.concatenate([[0], np.cumsum(counts)])
    most = max(1, SLICE_WORDS // max(1, int(size.max())))
    while done < begins[-1]:
        place = np.arange(done, min(done + most, begins[-1]))
        done = int(place[-1]) + 1
        x = np.searchsorted(begins, place, side="right") - 1
        y = start[x] + place - begins[x]
        open_ = (label[x] != label[y]) & ~((side[x] < 0) & (side[y] < 0)) & ((side[x] != side[y]) | (side[x] <= 0))
        x, y = x[open_], y[open_]
        good = _passing(x, y, n, at, size, begin, words, percent)
        x, y = x[good], y[good]
        np.minimum.at(first, x, y)
        while len(x):
            low = np.minimum(label[x], label[y])
            np.minimum.at(label, label[x], low)
            np.minimum.at(label, label[y], low)
            label[:] = label[label]
            rest = label[x] != label[y]
            x, y = x[rest], y[rest]
    while (label != label[label]).any():
        label = label[label]
    return key, key[label], key[first]


def _candidates(rows: DataFrame, percent: int, into: int) -> DataFrame:
    """(a, b, direct): b is connected with a by candidates of one list; direct ones are candidates themselves."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compared(table: pa.Table) -> pa.RecordBatch:
            columns = {c: np.asarray(table.column(c).combine_chunks()) for c in ("g", "n", "at", "side", "key")}
            _, group = np.unique(columns["g"], return_inverse=True)
            signature = table.column("signature").to_pylist()
            key, label, first = _united(group, columns["n"], columns["at"], columns["side"], columns["key"], signature, percent)
            direct = first != key
            through = (label != key) & (label != first)
            out = [np.concatenate([key[direct], key[through]]), np.concatenate([first[direct], label[through]])]
            flags = np.arange(len(out[0])) < direct.sum()
            return pa.RecordBatch.from_arrays([*map(pa.array, out), pa.array(flags)], ["a", "b", "direct"])

        for batch in parts:
            if not batch.num_rows:
                continue
            g = np.asarray(batch.column("g"))
            last = int(np.searchsorted(g, g[-1]))
            held.append(batch.slice(0, last))
            if last:
                yield compared(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(last))
        if sum(b.num_rows for b in held):
            yield compared(pa.Table.from_batches(held))

    keys = ["e", "band", "i", "j"]
    dealt = rows.withColumn("g", F.xxhash64(*keys)).repartition(into, "g").sortWithinPartitions("g")
    return dealt.select("g", "n", "at", "side", "key", "signature").mapInArrow(run, "a long, b long, direct boolean")


# --- verification


def _links(sizes: np.ndarray, elements: np.ndarray, fixed: int, known: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A forest of the links of the sets behind the first ``fixed`` ones with all before them; known: sets that are connected already.

    Each set's overlaps with all earlier ones are counted along the lists of its elements.
    """
    m = len(sizes)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(elements, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = elements[order][1:] != elements[order][:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    begins = np.append(np.flatnonzero(new), len(order))
    owners, ends, out = owner[order], np.cumsum(sizes), []
    _, parent = np.unique(known, return_index=True)
    parent = parent[np.unique(known, return_inverse=True)[1]].tolist()

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x in range(max(fixed, 1), m):
        mine = number[ends[x] - sizes[x] : ends[x]]
        met = owners[ranges(begins[mine], begins[mine + 1] - begins[mine])]
        both = np.bincount(met[met < x], minlength=x)
        for y in np.flatnonzero(100 * both >= percent * (sizes[:x] + sizes[x] - both)).tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((x, y))
    return out


GROUPS = "array<struct<c: long, i: int, j: int, fixed: boolean>>"


def _compared(documents: DataFrame, members: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) within groups of whole sets; members: place, key, known and the groups (c, i, j, fixed) that a set goes to."""

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # of repeated rows with one place a task sends the first
        for batch in parts:
            wanted, known = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "known"))
            for w in W.split(batch.column("text"), lower=True):
                h, _, n = _sets(w, width)
                key, _ = _keys(h, n)
                ends, out = np.cumsum(n), []
                for i in range(len(n)):
                    k = wanted[w.first + i]
                    if key.view(np.int64)[i] == k and k not in sent:  # another key: the places clash
                        sent.add(k)
                        own = h[ends[i] - n[i] : ends[i]].tobytes()
                        to = batch.column("groups")[w.first + i].as_py()
                        out += [(g["c"], g["i"], g["j"], g["fixed"], k, known[w.first + i], own) for g in to]
                if out:
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, ["c", "i", "j", "fixed", "key", "known", "own"])

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}
        pairs: list[tuple[int, int]] = []

        def close() -> None:
            order = sorted(held, key=lambda k: not held[k][0])  # fixed ones first
            arrays = [np.frombuffer(held[k][2], np.uint64) for k in order]
            fixed = sum(held[k][0] for k in order)
            if len(order) > max(fixed, 1):
                sizes, known = np.array([len(x) for x in arrays], np.int64), np.array([held[k][1] for k in order], np.int64)
                pairs.extend((order[a], order[b]) for a, b in _links(sizes, np.concatenate(arrays), fixed, known, percent))
            held.clear()

        def taken() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in (zip(*pairs) if pairs else ([], []))]
            pairs.clear()
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        for batch in parts:
            for c, i, j, fixed, k, known, own in zip(*(x.to_pylist() for x in batch.columns)):
                if (c, i, j) != group:
                    close()
                    group = (c, i, j)
                held[k] = (fixed, known, own)
            if len(pairs) > 10_000:
                yield taken()
        close()
        yield taken()

    small = members.count() <= BROADCAST_MEMBERS
    source = documents.select(F.col("text").cast("string").alias("text"), shared.row_key().alias("place"))
    chosen = source.join(F.broadcast(members) if small else members, "place").select("text", "key", "known", "groups")
    spread = chosen.mapInArrow(sets, "c long, i int, j int, fixed boolean, key long, known long, own binary")
    groups = spread.repartition(shared.partitions(documents), "c", "i", "j").sortWithinPartitions("c", "i", "j")
    return groups.mapInArrow(compare, "a long, b long")


def _blocks(sets: Column, elements: Column, most: int) -> Column:
    return F.greatest(F.ceil(sets / F.lit(most)), F.ceil(elements / F.lit(BLOCK_ELEMENTS))).cast("int")


def _stars(direct: DataFrame, classes: DataFrame) -> DataFrame:
    """Groups of sets around one candidate: each set (fixed) goes to its own, which goes to as many groups as its sets need."""
    hubs = direct.groupBy("a").agg(F.min("b").alias("hub"))
    sized = hubs.join(classes.select(F.col("key").alias("a"), "n"), "a")
    salts = sized.groupBy("hub").agg(_blocks(F.count("*"), F.sum("n"), STAR_SETS).alias("salts"))
    rays = hubs.join(salts, "hub").select(
        F.col("a").alias("key"), F.struct(F.col("hub").alias("c"), F.expr("cast(pmod(xxhash64(a), salts) as int)").alias("i"), F.lit(0).alias("j"), F.lit(True).alias("fixed")).alias("g")
    )
    centers = salts.select(F.col("hub").alias("key"), F.explode(F.expr("sequence(0, salts - 1)")).alias("i"), "hub")
    centers = centers.select("key", F.struct(F.col("hub").alias("c"), "i", F.lit(0).alias("j"), F.lit(False).alias("fixed")).alias("g"))
    members = rays.unionByName(centers).groupBy("key").agg(F.collect_list("g").cast(GROUPS).alias("groups"))
    return members.join(classes.select("key", "place"), "key").select("place", "key", F.col("key").alias("known"), "groups")


def _open_clusters(clusters: DataFrame, found: DataFrame, classes: DataFrame) -> DataFrame:
    """Groups of sets whose cluster of candidates is still in several parts: the largest part (fixed) against the others, and these against
    each other, in pairs of blocks."""
    parts = clusters.join(found.select("node", F.col("component").alias("known")), "node", "left")
    parts = parts.select(F.col("node").alias("key"), F.col("component").alias("c"), F.coalesce("known", "node").alias("known"))
    parts = parts.join(classes.select("key", "place", "n"), "key")
    sizes = parts.groupBy("c", "known").agg(F.count("*").alias("m"), F.sum("n").alias("e"))
    of = sizes.groupBy("c").agg(F.max(F.struct("m", "known", "e")).alias("top"), F.sum("m").alias("all_m"), F.sum("e").alias("all_e"), F.count("*").alias("parts"))
    of = of.where("parts > 1").select(
        "c", F.col("top.known").alias("top"), _blocks(F.col("all_m") - F.col("top.m"), F.col("all_e") - F.col("top.e"), BLOCK_SETS).alias("p"),
        _blocks(F.col("top.m"), F.col("top.e"), BLOCK_SETS).alias("q"),
    )
    dealt = join_many_to_one(parts, of, "c", bound=clusters).withColumn("fixed", F.col("known") == F.col("top"))
    mine = F.when(F.col("fixed"), F.expr("p + cast(pmod(xxhash64(key), q) as int)")).otherwise(F.expr("cast(pmod(xxhash64(key), p) as int)"))
    dealt = dealt.withColumn("mine", mine).withColumn("last", F.when(F.col("fixed"), F.col("p") - 1).otherwise(F.col("p") + F.col("q") - 1))
    groups = F.expr("transform(sequence(0, last), o -> named_struct('c', c, 'i', least(mine, o), 'j', greatest(mine, o), 'fixed', fixed))")
    return dealt.select("place", "key", "known", groups.cast(GROUPS).alias("groups"))


def _subset_links(small: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of sets that have a subset in common: each with the smallest set of that subset, which of all is closest to it."""
    rows = small.select("key", "n", F.posexplode("subsets").alias("at", "subset"))
    less = F.when(F.col("at") == 0, 0).when(F.col("at") <= F.col("n"), 1).otherwise(2)
    rows = rows.select(F.col("key").alias("a"), F.col("n"), (F.col("n") - less).alias("c"), "subset")
    least = rows.groupBy("subset").agg(F.min(F.struct("n", "a")).alias("least"), F.count("*").alias("k")).where("k > 1")
    least = least.select("subset", F.col("least.n").alias("m"), F.col("least.a").alias("b"))
    joined = join_many_to_one(rows, least, "subset", bound=small)
    return joined.where(f"a <> b and 100 * c >= {percent} * (n + m - c)").select("a", "b")


def jaccard_components(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH, sampled: int = SAMPLED) -> DataFrame:
    """Per row: doc_id, n_shingles (size of its set) and component_id (least doc_id reachable by links).

    A set holds the distinct shingles of ``width`` words (A-Z in lower case); a text of fewer words is one element; a null
    text or one without words has an empty set, links with nothing and is its own component. Repeated rows have equal sets. A null
    doc_id takes part, but is nobody's component_id unless all of its component are null. Other columns are left out.
    """
    return placed_components(documents, percent, width, sampled).select("doc_id", "n_shingles", "component_id")


def placed_components(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH, sampled: int = SAMPLED) -> DataFrame:
    """``jaccard_components`` with place, each row's ``shared.row_key``, and component_place, that of one row of its component:
    a row with the least doc_id, or any if all are null; a row with an empty set has its own."""
    plan = planned(documents, percent, width, sampled)
    sets = shared.stored(shingle_sets(documents, plan, width), "sets")
    # the place of a row with the least doc_id, or of any if all are null: there the text is found again
    place = F.coalesce(F.min_by("place", "doc_id"), F.min("place")).alias("place")
    classes = sets.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), place)
    classes = shared.stored(classes, "classes")
    large = shared.stored(sets.where(F.size("elements") > 0).select("key", "n", "elements", "blocks", "signature").dropDuplicates(["key"]), "large")
    near = shared.stored(_candidates(_listed(large, percent), percent, shared.partitions(documents)).distinct(), "candidates")
    verified = _compared(documents, _stars(near.where("direct"), classes), percent, width)
    small = sets.where(F.size("subsets") > 0).select("key", "n", "subsets").dropDuplicates(["key"])
    links = shared.stored(verified.unionByName(_subset_links(small, percent)), "links")
    found = connected_components(links, "parts")
    clusters = connected_components(near.select("a", "b"), "clusters")
    members = shared.stored(_open_clusters(clusters, found, classes), "open")
    more = shared.stored(_compared(documents, members, percent, width), "more")
    if not more.isEmpty():
        found = connected_components(links.unionByName(more), "all")
    labelled = classes.join(found.withColumnRenamed("node", "key"), "key", "left")
    labelled = labelled.select("key", "least", "place", F.coalesce("component", "key").alias("component"))
    first = F.coalesce(F.min_by("place", "least"), F.min("place")).alias("component_place")
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"), first)
    answer = join_many_to_one(labelled.select("key", "component"), least, "component", bound=classes)
    answer = shared.stored(answer.select(F.col("key").alias("k"), "component_id", "component_place"), "answer")
    joined = sets.join(answer, (F.col("n") > 0) & (F.col("key") == F.col("k")), "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    first = F.when(F.col("n") > 0, F.col("component_place")).otherwise(F.col("place")).alias("component_place")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), "place", first)


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Sizes and components of all documents."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
