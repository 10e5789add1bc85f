"""How filters interact: for every order of a set of filters, what each step removes, in every part of the documents.

Each document gets a mask of the filters it fails; per part only the counts of the masks that occur go on. Over these stands a
decision diagram: a level for each filter, an edge for passing and one for failing it, and at each node the documents below it. From one
order to the next two neighbouring levels are swapped, which touches these two levels only; the path on which all filters pass
then gives the order's steps. So a part's work depends on its masks, not on its documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdq.llm import shared
from salesdq.plans import null_safe_lookup

GAPS = "\t\n\x0b\x0c\r"
SIGNS = "#$%&*|"
#: Filters of one audit at most: all orders of eight are 40,320 for each part.
MOST_FILTERS = 8
COUNTS = ("n", "good", "toxic")
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
    "toxic_lost long, shapley long"
)


# --- decision diagrams


class Node:
    """Documents below it, and its two children: ``low`` for those that pass the level's filter, ``high`` for those that fail it."""

    __slots__ = ("counts", "high", "low")

    def __init__(self, counts: tuple[int, ...], low: Node | None = None, high: Node | None = None):
        self.counts, self.low, self.high = counts, low, high


class Diagram:
    """Counts of masks as a diagram without skipped levels: at each level equal functions are one node."""

    def __init__(self, order: Sequence[int], masks: dict[int, tuple[int, ...]]):
        """order: the filters' bits from the top level down; masks: counts of each mask that occurs."""
        self.order, width = list(order), len(next(iter(masks.values())))
        self.levels: list[list[Node]] = [[] for _ in self.order]
        leaves: dict[tuple[int, ...], Node] = {}
        tables: list[dict[tuple[int, int], Node]] = [{} for _ in self.order]

        def build(level: int, below: dict[int, tuple[int, ...]]) -> Node:
            if level == len(self.order):
                counts = next(iter(below.values()), (0,) * width)  # one mask at most is left
                return leaves.setdefault(counts, Node(counts))
            bit = 1 << self.order[level]
            low = build(level + 1, {m: c for m, c in below.items() if not m & bit})
            high = build(level + 1, {m: c for m, c in below.items() if m & bit})
            return self._node(tables[level], self.levels[level], low, high)

        self.root = build(0, masks)

    @staticmethod
    def _node(table: dict[tuple[int, int], Node], level: list[Node], low: Node, high: Node) -> Node:
        key = (id(low), id(high))
        if key not in table:
            table[key] = Node(tuple(a + b for a, b in zip(low.counts, high.counts)), low, high)
            level.append(table[key])
        return table[key]

    def swap(self, i: int) -> None:
        """Exchange levels ``i`` and ``i + 1``: the upper nodes stay where they are and get new children; other levels are not touched."""
        table: dict[tuple[int, int], Node] = {}
        lower: list[Node] = []
        for node in self.levels[i]:
            passed, failed = node.low, node.high
            node.low = self._node(table, lower, passed.low, failed.low)
            node.high = self._node(table, lower, passed.high, failed.high)
        self.levels[i + 1] = lower
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def path(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the path on which all pass: the filter, the counts of those that pass and of those that fail here."""
        node = self.root
        for bit in self.order:
            yield bit, node.low.counts, node.high.counts
            node = node.low

    def alone(self) -> dict[int, int]:
        """Documents that fail one filter only, by filter."""
        out, node = {}, self.root
        for level, bit in enumerate(self.order):
            only = node.high
            for _ in self.order[level + 1 :]:
                only = only.low
            out[bit] = only.counts[0]
            node = node.low
        return out


def plain_changes(n: int) -> Iterator[int]:
    """Places i whose exchange with i + 1, one after the other, leads through all orders of ``n`` things."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1)
        change = next(inner, None)
        if change is None:
            return
        yield change + 1
        yield from range(n - 1)
        change = next(inner, None)
        if change is None:
            return
        yield change


def steps(names: Sequence[str], masks: dict[int, tuple[int, ...]]) -> list[tuple]:
    """Rows (filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part."""
    diagram = Diagram(range(len(names)), masks)
    alone, orders = diagram.alone(), [(diagram.order.copy(), list(diagram.path()))]
    for i in plain_changes(len(names)):
        diagram.swap(i)
        orders.append((diagram.order.copy(), list(diagram.path())))
    failing, shapley = dict.fromkeys(alone, 0), dict.fromkeys(alone, 0)
    for order, path in orders:
        failing[order[0]] = path[0][2][0]  # the first filter removes all that fail it
        for bit, _, failed in path:
            shapley[bit] += failed[0]
    return [
        ("".join(names[b] for b in order), step, low[0], high[0], failing[bit] - high[0], alone[bit], *high[1:], shapley[bit])
        for order, path in orders
        for step, (bit, low, high) in enumerate(path, 1)
    ]


# --- masks


def failures(text: Column) -> list[Column]:
    """Whether a text fails: A under 200 words, B under half its words distinct, C over 3 % capitals A-Z, D one of the signs."""
    words = F.array_remove(F.split(F.translate(text, GAPS, " " * len(GAPS)), " "), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * F.length(text), text.rlike(f"[{SIGNS}]")]


def _mask(conditions: Sequence[Column], first: int = 0) -> Column:
    return sum((F.when(c, F.lit(1 << (first + i))).otherwise(F.lit(0)) for i, c in enumerate(conditions)), F.lit(0))


def mask_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good and toxic: documents of each part by the filters A to E they fail (bits 0 to 4).

    E fails a document whose text some smaller doc_id has anywhere in the table. Texts are told apart by their SHA-256. A null text is
    empty; a null lang is the part ''. A null doc_id is no smaller id, has none and has no labels; equal rows count each. A document is good
    (toxic) if any label of its id has quality (toxic) 1. Other columns are left out.

    A text's copies, however many, are summed up by (text, part, id) and then by (text, part) in the tasks that read them, so no task
    holds them all; the least id of a text is found among its parts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        _mask(failures(text)).cast("byte").alias("mask"),
    )
    named = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    named = named.agg(F.max(F.col("quality") == 1).cast("long").alias("good"), F.max(F.col("toxic") == 1).cast("long").alias("toxic"))
    sums = [F.sum(c).alias(c) for c in COUNTS]
    each = read.groupBy("digest", "part", "mask", "doc_id").agg(F.count("*").alias("n"))
    labelled = null_safe_lookup(each, named, "doc_id", spread_by=["digest", "part"])
    each = labelled.withColumns({c: F.col("n") * F.coalesce(c, F.lit(0).cast("long")) for c in COUNTS[1:]})
    # of a text and part: all rows, and those of its least id, and those without one, none of which fail E on their own account
    counts = F.struct(*COUNTS)
    with_id = F.col("doc_id").isNotNull()
    by_part = each.groupBy("digest", "part", "mask").agg(
        *sums,
        F.min(F.when(with_id, F.struct("doc_id", *COUNTS))).alias("first"),
        F.max(F.when(~with_id, counts)).alias("nameless"),  # one row at most: they are summed up above
    )
    least = by_part.withColumn("least", F.expr("min(first.doc_id) over (partition by digest)"))  # a row for each part
    zero = F.lit(0).cast("long")
    passing = {
        c: F.when(F.col("first.doc_id") == F.col("least"), F.col("first")[c]).otherwise(zero) + F.coalesce(F.col("nameless")[c], zero)
        for c in COUNTS
    }
    split = least.select(
        "part",
        F.explode(
            F.array(
                F.struct(F.col("mask").cast("int").alias("mask"), *[passing[c].alias(c) for c in COUNTS]),
                F.struct((F.col("mask") + 16).cast("int").alias("mask"), *[(F.col(c) - passing[c]).alias(c) for c in COUNTS]),
            )
        ).alias("s"),
    )
    return split.select("part", "s.*").where("n > 0").groupBy("part", "mask").agg(*sums)


def audit(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row for each part, order of the filters and step; counts: part, mask, n, good and toxic, a row for each part and mask.

    Bit i of a mask says that filter ``names[i]`` fails. No counts give no rows. A part has at most as many rows as there are masks, so one
    task holds a part, and parts are spread over tasks.
    """
    if not 0 < len(names) <= MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"name 1 to {MOST_FILTERS} different filters")
    names = list(names)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                masks = {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in row["masks"]}
                columns = list(zip(*((row["part"], *s) for s in steps(names, masks))))
                types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [x.split()[0] for x in STEPS.split(", ")])

    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("masks"))
    return by_part.mapInArrow(run, STEPS)


def op12_filter_orders(spark, sf_dir: str) -> DataFrame:
    """All orders of five filters over all documents, by lang."""
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(shared.stored(mask_counts(documents, labels), "masks"), "ABCDE")


#: The same in DuckDB's SQL: every order against every mask.
SQL = r"""
with recursive texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    min(doc_id) over (partition by coalesce(text, '')) as least from documents),
marks as (
  select doc_id, coalesce(max(case when quality = 1 then 1 end), 0) as good, coalesce(max(case when toxic = 1 then 1 end), 0) as toxic
  from labels where doc_id is not null group by doc_id),
failed as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    case when len(words) < 200 then 1 else 0 end
    + case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end
    + case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) then 4 else 0 end
    + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
    + case when coalesce(texts.doc_id > least, false) then 16 else 0 end as mask
  from texts left join marks using (doc_id)),
counts as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by part, mask),
letters as (select substr('ABCDE', i, 1) as letter, (1 << (i - 1))::bigint as bit from range(1, 6) t(i)),
orders as (
  select '' as filter_order, 0::bigint as used
  union all
  select filter_order || letter, used | bit from orders join letters on used & bit = 0 and length(filter_order) < 5),
steps as (
  select filter_order, step, letter, bit,
    (select coalesce(bit_or(e.bit), 0) from letters e where instr(filter_order, e.letter) < step) as earlier
  from (select filter_order from orders where length(filter_order) = 5), range(1, 6) t(step), letters
  where substr(filter_order, step, 1) = letter),
audit as (
  select part, filter_order, step, letter,
    coalesce(sum(n) filter (mask & (earlier | bit) = 0), 0) as kept,
    coalesce(sum(n) filter (mask & earlier = 0 and mask & bit <> 0), 0) as removed,
    coalesce(sum(n) filter (mask & earlier <> 0 and mask & bit <> 0), 0) as redundant,
    coalesce(sum(n) filter (mask = bit), 0) as unique_fails,
    coalesce(sum(good) filter (mask & earlier = 0 and mask & bit <> 0), 0) as good_lost,
    coalesce(sum(toxic) filter (mask & earlier = 0 and mask & bit <> 0), 0) as toxic_lost
  from counts, steps group by part, filter_order, step, letter)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint as shapley
from audit
"""
