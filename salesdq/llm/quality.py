"""Quality rules: counts of a text's words, signs and repeats, and a likelihood ratio of its hashed n-grams.

Everything is built from Spark's own functions; no row passes through Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdq.llm import shared
from salesdq.plans import null_safe_lookup

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Most rows of labels (16 bytes each) that are broadcast; beyond, documents are shuffled to them.
BROADCAST_LABELS = 4_000_000
MICRO = 1_000_000


@dataclass(frozen=True)
class Model:
    """buckets: hashed n-grams. prior: n-grams by which a bucket is drawn to the raw corpus' share. spared: share of the trusted
    documents kept back that may fall below the threshold. min_words, max_repeat_percent: the base rules."""

    buckets: int = 1 << 18
    prior: int = 5
    spared: float = 0.002
    min_words: int = 20
    max_repeat_percent: int = 30


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def base_counts(df: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to rows with ``text`` and ``words``.

    Words in repeated windows: windows are hashed (by pairs of pairs of pairs), sorted by hash in their own row, and a
    window that equals a neighbour covers its words; each covers those up to the next one's first, eight at most.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = sum((F.length(text) - F.length(F.replace(text, F.lit(s), F.lit(""))) for s in SYMBOLS), F.lit(0))
    df = df.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": symbols.cast("long"),
            "lines": lines,
            "w1": F.transform("words", lambda x: F.xxhash64(x)),
        }
    )
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    for step in (1, 2, 4):
        df = df.withColumn(f"w{2 * step}", F.transform(f"w{step}", lambda x, i: F.xxhash64(x, F.get(f"w{step}", i + step))))
    df = df.withColumn("windows", F.slice("w8", F.lit(1), F.greatest(F.size("w8") - (WINDOW - 1), F.lit(0))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("by_hash", F.when(repeats, F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    twice = F.filter("by_hash", lambda x, i: (x["h"] == F.get("by_hash", i - 1)["h"]) | (x["h"] == F.get("by_hash", i + 1)["h"]))
    df = df.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.transform("at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - x, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop(
        "lines", "w1", "w2", "w4", "w8", "windows", "by_hash", "at"
    )


def _bucket(gram: Column, buckets: int) -> Column:
    return (F.crc32(gram.cast("binary")) % F.lit(buckets)).cast("int")


def _grams(df: DataFrame, buckets: int) -> DataFrame:
    """A row for each word: the buckets of the word and of it with the next word (null behind the last)."""
    rows = df.select("*", F.posexplode_outer("words").alias("i", "word"))
    pair = F.concat("word", F.lit(" "), F.get("words", F.col("i") + 1))
    return rows.withColumns({"one": _bucket(F.col("word"), buckets), "two": _bucket(pair, buckets)})


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents all of whose labels call them good and not toxic; even ids teach the model, odd ids set the threshold."""
    good = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
    good = good.agg(F.min(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return good.where("good and not toxic").select("label_id", (F.col("label_id") % 2 == 0).alias("teaches"))


def quality_rules(documents: DataFrame, labels: DataFrame, model: Model = Model(), key: str | None = None) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, score (mean log-likelihood ratio in millionths) and kept.

    Unigrams and bigrams are hashed into buckets. The raw multinomial counts those of all documents, the target those of
    trusted documents with an even id; a bucket weighs ln((t + prior) / (r * T / R + prior)), rounded to millionths, so
    sums are exact in any order. A document's score is the mean weight of its n-grams, rounded down. It is kept if the base rules
    pass and the score reaches the threshold: the score, in thousandths, that all but the share ``spared`` of the
    trusted documents with an odd id reach. Without any of those, the base rules decide.

    A null text has no words and fails the base rules. Rows that repeat are judged each; a null doc_id is an unlabelled document. Null labels are
    not trusted. Other columns are left out, but for ``key`` if given. Empty documents give no rows; without trusted documents the weights are those of an
    empty target.
    """
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([key] if key else []))
    source = source.withColumn("words", words(F.col("text")))
    trusted = trusted_ids(labels)
    small = labels.select("doc_id").count() <= BROADCAST_LABELS
    teachers = trusted.where("teaches").select("label_id")
    if small:
        flagged = source.join(F.broadcast(teachers), F.col("doc_id") == F.col("label_id"), "left")
    else:  # null ids are dealt out, a hot one is left to the adaptive split
        ids = teachers.select(F.col("label_id").alias("doc_id"), "label_id")
        flagged = null_safe_lookup(source, ids, "doc_id", spread_by=[F.monotonically_increasing_id()])
    taught = F.col("label_id").isNotNull().cast("long").alias("taught")
    grams = _grams(flagged.select("words", taught).where(F.size("words") > 0), model.buckets)
    each = grams.select("taught", F.explode(F.array("one", "two")).alias("bucket")).where("bucket is not null")
    counts = shared.stored(each.groupBy("bucket").agg(F.count("*").alias("r"), F.sum("taught").alias("t")), "counts")
    totals = counts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("tt"), F.coalesce(F.sum("r"), F.lit(1)).alias("rr")).first()
    expected = F.col("r") * F.lit(float(totals["tt"])) / F.lit(float(totals["rr"]))
    weight = F.round(F.log((F.col("t") + F.lit(float(model.prior))) / (expected + F.lit(float(model.prior)))) * MICRO).cast("long")
    weights = counts.select("bucket", weight.alias("w"))

    counted = base_counts(source.withColumn("row", F.monotonically_increasing_id()))
    kept_columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *([key] if key else [])]
    # bounded by the number of buckets: 12 bytes each
    first = F.broadcast(weights.select(F.col("bucket").alias("one"), F.col("w").alias("w_one")))
    second = F.broadcast(weights.select(F.col("bucket").alias("two"), F.col("w").alias("w_two")))
    scored = _grams(counted.select("row", "words", *kept_columns), model.buckets).select("row", *kept_columns, "one", "two")
    scored = scored.join(first, "one", "left").join(second, "two", "left")
    both = F.coalesce("w_one", F.lit(0)) + F.coalesce("w_two", F.lit(0))
    scored = scored.groupBy("row").agg(F.sum(both).alias("total"), *[F.first(c).alias(c) for c in kept_columns])
    failed = (F.col("n_words") < model.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * model.max_repeat_percent)
    score = F.floor(F.col("total") / F.greatest(2 * F.col("n_words") - 1, F.lit(1)))
    scored = shared.stored(scored.select(*kept_columns, failed.alias("base_failed"), score.cast("long").alias("score")), "scores")

    checks = scored.where("not base_failed").join(trusted.where("not teaches"), F.col("doc_id") == F.col("label_id"))
    levels = checks.groupBy(F.floor(F.col("score") / 1000).alias("level")).agg(F.count("*").alias("n"))
    share = F.expr("sum(n) over (order by level) / sum(n) over ()")  # a row for each thousandth met
    least = levels.select("level", share.alias("s")).where(F.col("s") > model.spared).agg(F.min("level")).first()[0]
    verdict = ~F.col("base_failed") & (F.lit(True) if least is None else F.col("score") >= int(least) * 1000)
    return scored.withColumn("kept", verdict)


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents, taught by the labels."""
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality_rules(documents, labels)


#: The same in DuckDB's SQL. CRC-32 is computed there bit by bit from its polynomial.
SQL = r"""
with docs as (
  select row_number() over () as k, doc_id, coalesce(text, '') as text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents),
lines as (
  select k, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from docs),
flat as (
  select k, unnest(ws) as w, unnest(range(len(ws))) as i, unnest(range(len(ws))) + 1 as j, ws from docs),
windows as (select k, i, array_to_string(ws[i + 1:i + 8], chr(0)) as v from flat where i + 8 <= len(ws)),
twice as (select k, unnest(list(i)) as i from windows group by k, v having count(*) > 1),
covered as (select k, count(distinct i + o) as n from twice, range(8) t(o) group by k),
grams as (
  select k, w as g from flat union all
  select k, w || ' ' || ws[i + 2] from flat where i + 2 <= len(ws)),
hex_bytes as (select g, hex(encode(g)) as h from (select distinct g from grams)),
hashed as (
  select g, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(len(h) // 2), lambda i:
    (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)),
    lambda c, b: xor(c >> 8, list_reduce(list_prepend(xor(c, b) & 255, range(8)),
      lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))), 4294967295) % 262144 as bucket
  from hex_bytes),
trusted as (
  select doc_id from labels where doc_id is not null group by doc_id having bool_and(quality = 1) and not bool_or(toxic = 1)),
counts as (
  select bucket, count(*) as r, count(t.doc_id) as t
  from grams join hashed using (g) join docs using (k) left join trusted t on t.doc_id = docs.doc_id and t.doc_id % 2 = 0
  group by bucket),
weights as (
  select bucket, round(ln((t + 5.0::double) / (r * (sum(t) over ())::double / (sum(r) over ())::double + 5.0::double)) * 1000000)::bigint as w
  from counts),
totals as (select k, sum(w) as total from grams join hashed using (g) join weights using (bucket) group by k),
scores as (
  select docs.k, doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
    floor(coalesce(total, 0)::double / greatest(2 * len(ws) - 1, 1))::bigint as score
  from docs join lines using (k) left join covered using (k) left join totals using (k)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from scores),
levels as (
  select floor(score / 1000.0) as level, count(*) as n from judged
  join trusted using (doc_id) where not base_failed and doc_id % 2 = 1 group by 1),
shares as (select level, sum(n) over (order by level) / sum(n) over () as s from levels),
least as (select min(level) * 1000 as score from shares where s > 0.002)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed, judged.score,
  not base_failed and coalesce(judged.score >= least.score, true) as kept
from judged, least
"""
