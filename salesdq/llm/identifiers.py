"""Personal data in texts: four kinds by their form, and more by the contexts in which those are found.

Bootstrapping: the spans found by form are seeds. The words before a span are its pattern. Patterns and the values they
introduce make a graph; Spark scores it round by round until nothing changes: a pattern is trusted for a kind if nearly all that follows it, in all
documents, is known to be of that kind, and a trusted pattern's unknown values of a plausible form become known.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdq.llm import shared
from salesdq.llm import words as W

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = "0123456789"
#: A word that may be an identifier of any kind: at least six characters, one of them a digit. Stops around it are left out.
VALUE = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?\"'()[]<>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Forms of one kind: an e-mail's at sign in other writing, and its domain; groups of digits; groups of hexadecimal digits.
AT = re.compile(r"\x20{0,2}(?:@|[(\[{<]\x20?(?:at|AT|@)\x20?[)\]}>])\x20{0,2}(?=[A-Za-z0-9])|\x20{1,2}(?:at|AT)\x20{1,2}(?=[A-Za-z0-9-]+(?:\.|\x20?[(\[{]|\x20dot\x20))")
LABELS = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[{]\x20?(?:dot|DOT|\.)\x20?[)\]}]\x20?|\x20(?:dot|DOT)\x20)[A-Za-z0-9-]+)*")
ENDING = re.compile(r"\.[A-Za-z]{2,}(?=[.,;:!?\"')\]>]*(?:[\x20\x09-\x0D]|$))")
GROUPS = re.compile(r"(?<![^\x20\x09-\x0D(\[<\"'])[+(]{0,2}[0-9](?:[\x20()./-]{0,3}[0-9])*(?![A-Za-z0-9])")
HEXES = re.compile(r"(?<![^\x20\x09-\x0D(\[<\"'])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![^\x20\x09-\x0D.,;)\]>\"'])")
LEAST_DIGITS = 5
EMAIL_FORM, IP_FORM, NUMBER_FORM, ANY_FORM = 1, 2, 4 | 8, 15
LEAST_VALUES, CONFIDENCE = 3, 0.8
#: Bits (a power of two) of what tells the tasks which pairs of words may be patterns: 4 MB.
SIEVE_BITS = 1 << 25
#: Documents with added spans that are broadcast at most, some 100 bytes each; beyond, documents are shuffled to them.
BROADCAST_ADDED = 500_000

SPANS = "array<struct<kind:int,start:int,end:int>>"
CANDIDATES = "array<struct<pattern:string,value:string,kind:int,form:int,start:int,end:int>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches. The part before an @ is all of the run of its characters, back to the previous match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Each run of numbers joined by single dots gives its numbers by fours."""
    for m in DOTTED.finditer(text):
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = len(".".join(four))
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, start + size
            start += size + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all four kinds, in order; places are code points. Time is linear in the text."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if any(c in text for c in DIGITS):
        out += [(1, a, b) for a, b in _ips(text)]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c in DIGITS for c in m.group()) <= 15:
                    out.append((3, *m.span()))
    return out


def _before(text: str, start: int) -> str:
    """The two whole words before a place, however long and far, A-Z in lower case; empty if there are fewer."""
    size = 120
    while True:
        words = WORD.findall(text[max(0, start - size) : start])
        if len(words) > 2 or size >= start:  # the first of three may be cut
            return " ".join(words[-2:]).encode().lower().decode() if len(words) >= 2 else ""
        size *= 2


def _obscured(text: str) -> Iterator[tuple[int, int]]:
    """What may be an e-mail address in other writing: words around an at sign, and words that end like a domain."""
    done = 0
    for m in AT.finditer(text):
        start = m.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        start += len(text[start : m.start()]) - len(text[start : m.start()].lstrip(EDGES))
        found = LABELS.match(text, m.end())
        if start < m.start() and found and not (m.group().strip().isalpha() and found.group().replace("-", "").isalnum()):
            yield start, found.end()
            done = found.end()
    done = 0
    for m in ENDING.finditer(text):
        start = m.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        start += len(text[start : m.start()]) - len(text[start : m.start()].lstrip(EDGES))
        if start < m.start():
            yield start, m.end()
        done = m.end()


def _groups(text: str) -> Iterator[tuple[int, int]]:
    """Groups of digits that may be a number, of any length."""
    for m in GROUPS.finditer(text):
        if sum(c in DIGITS for c in m.group()) >= LEAST_DIGITS:
            yield m.span()


def _plausible(text: str) -> list[tuple[int, int, int]]:
    """(start, end, form) of all that may be an identifier, in order: a bit of form for each kind; the longest of those with one start."""
    found = []
    if any(c in text for c in DIGITS):
        for m in VALUE.finditer(text):
            word = m.group()
            if len(word) >= 6 and any(c in word for c in DIGITS):
                core = word.strip(EDGES)
                start = m.start() + len(word) - len(word.lstrip(EDGES))
                if len(core) >= 6:
                    found.append((start, start + len(core), ANY_FORM))
        found += [(a, b, NUMBER_FORM) for a, b in _groups(text)]
    if ":" in text:
        found += [(*m.span(), IP_FORM) for m in HEXES.finditer(text) if any(c not in ":" for c in m.group())]
    found += [(a, b, EMAIL_FORM) for a, b in _obscured(text)]
    out: dict[int, tuple[int, int]] = {}
    for start, end, form in found:
        other = out.get(start, (0, 0))
        out[start] = max(end, other[0]), form | other[1]
    return [(a, *out[a]) for a in sorted(out)]


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int, int, int]]:
    """(pattern, value, kind, form, start, end) of base spans, and of all else of a plausible form with kind -1."""
    taken = sorted((a, b) for _, a, b in spans)
    found, i = [], 0
    for start, end, form in _plausible(text):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if not (i < len(taken) and taken[i][0] < end):
            found.append((-1, form, start, end))
    rows = [(_before(text, a), text[a:b], k, f, a, b) for k, f, a, b in [*((k, 0, a, b) for k, a, b in spans), *found]]
    return [r for r in rows if r[0]]


def _source(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))


def _found(source: DataFrame) -> DataFrame:
    """Per row its base spans and candidates, with a row number that is fixed once written."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in parts:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            spans = [base_spans(t) for t in texts]
            more = [candidates(t, s) for t, s in zip(texts, spans)]
            rows = pa.array(np.arange(row, row + len(texts)))
            row += len(texts)
            span_type = pa.list_(pa.struct([(x, pa.int32()) for x in ("kind", "start", "end")]))
            more_type = pa.list_(pa.struct([("pattern", pa.string()), ("value", pa.string()), *[(x, pa.int32()) for x in ("kind", "form", "start", "end")]]))
            as_dicts = [[dict(zip(("kind", "start", "end"), s)) for s in sorted(x)] for x in spans]
            more_dicts = [[dict(zip(("pattern", "value", "kind", "form", "start", "end"), s)) for s in x] for x in more]
            columns = [rows, batch.column("doc_id"), batch.column("key"), pa.array(as_dicts, span_type), pa.array(more_dicts, more_type)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "key", "spans", "more"])

    return source.mapInArrow(run, f"row long, doc_id long, key long, spans {SPANS}, more {CANDIDATES}")


def _pair_hashes(patterns: DataFrame) -> DataFrame:
    """pattern, and the hash of its two words as texts have it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            names = batch.column("pattern")
            for w in W.split(names):
                at, h = w.shingles(2)  # one for each pattern
                yield pa.RecordBatch.from_arrays([names.take(pa.array(w.first + w.row[at])), pa.array(h.view(np.int64))], ["pattern", "h"])

    return patterns.mapInArrow(run, "pattern string, h long")


def _followed(source: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often each pattern stands before a word, in all texts: (pattern, total).

    Tasks count the pairs of words that they read and pass on those that the sieve lets through: the patterns' own, and of
    all others the more, the fuller the sieve is. These meet the patterns in a join, so nothing but the sieve is sent around.
    """
    hashes = shared.stored(_pair_hashes(patterns), "patterns")
    sent = source.sparkSession.sparkContext.broadcast(W.sieve(hashes, SIEVE_BITS))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = sent.value
        for batch in parts:
            for w in W.split(batch.column("text"), lower=True):
                at, h = w.shingles(2)
                h = h[np.append(w.row[1:], -1)[at + 1] == w.row[at]].view(np.int64)  # those that a word follows
                h, counts = np.unique(h[W.sifted(h, sieve)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(counts)], ["h", "n"])

    counts = source.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("total"))
    return hashes.join(counts, "h").select("pattern", "total")


def _bootstrapped(found: DataFrame, source: DataFrame) -> DataFrame:
    """Spans that trusted patterns add: (row, kind, start, end)."""
    graph = found.select("row", F.explode("more").alias("c")).select("row", "c.*")
    counts = graph.groupBy("pattern", "value").agg(F.max("kind").alias("kind"), F.max("form").alias("form"), F.count("*").alias("n"))
    wide = counts.groupBy("pattern").agg(F.count("*").alias("values")).where(F.col("values") >= LEAST_VALUES)
    edges = shared.stored(counts.join(wide.select("pattern"), "pattern"), "edges")
    if edges.isEmpty():
        return found.sparkSession.createDataFrame([], "row long, kind int, start int, end int")
    totals = shared.stored(_followed(source, edges.select("pattern").distinct()), "followed")
    seeds = edges.where("kind >= 0").select("value", "kind").distinct()
    fits = F.expr("shiftright(form, kind) & 1 = 1")
    before = None
    while True:
        known = edges.select("pattern", "value", "n").join(seeds, "value")
        scores = known.groupBy("pattern", "kind").agg(F.sum("n").alias("hits"), F.count("*").alias("values"))
        scores = scores.where(F.col("values") >= LEAST_VALUES).join(totals, "pattern")
        trusted = scores.where(F.col("hits") >= CONFIDENCE * F.col("total")).groupBy("pattern").agg(F.min("kind").alias("kind"))
        trusted = shared.stored(trusted, "trusted")
        state = trusted.agg(F.count("*"), F.sum(F.xxhash64("pattern", "kind").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        new = edges.where("kind < 0").select("pattern", "value", "form").join(trusted, "pattern").where(fits)
        new = new.groupBy("value").agg(F.min("kind").alias("kind"))
        grown = seeds.unionByName(new.join(seeds.select("value"), "value", "left_anti"))
        seeds = shared.stored(grown, "seeds")
    more = graph.where("kind < 0").drop("kind").join(trusted, "pattern").where(fits)
    return more.select("row", "kind", "start", "end").distinct()


def personal_spans(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` and ``added`` spans (kind as place in KINDS, start, end), sorted by kind and start.

    The base follows the four forms. A pattern is the two words before a span; it is trusted if it stands before at least LEAST_VALUES
    different known values of one kind and these are at least CONFIDENCE of all words it stands before, in all texts.
    What follows a trusted pattern is added under its kind, and known from then on, if it is a word of at least six characters with a
    digit or has a form of that kind: an e-mail's at sign written otherwise or a word that ends like a domain, groups of
    LEAST_DIGITS digits or more, hexadecimal groups. Rounds go on until the trusted patterns stay. What is added never overlaps the base. A null or empty text has no spans. Repeated rows count each; null doc_ids stay null. Other columns are left out.
    """
    source = _source(documents)
    found = shared.stored(_found(source), "spans")
    added = _bootstrapped(found, source).groupBy(F.col("row").alias("r"))
    added = added.agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    joined = found.join(added, F.col("row") == F.col("r"), "left")
    return joined.select("doc_id", F.col("spans").alias("base"), F.coalesce("added", F.array().cast(SPANS)).alias("added"))


def _is(kind: int):
    return lambda s: s["kind"] == kind


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(text: str | None, spans: list[dict] | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping ones together, by the first one's kind."""
    out, done = [], 0
    for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= done:
            out += [text[done : s["start"]], f"<{KINDS[s['kind']].upper()}>"]
        done = max(done, s["end"])
    return None if text is None else "".join([*out, text[done:]])


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with personal data replaced, and n_chars counted anew if there is such a column.

    Null texts, other columns and rows without personal data stay as they are. Base spans are found again where a text is
    read; only added ones are brought to it, by doc_id and text, so rows that repeat a doc_id keep apart.
    """
    source = _source(documents)
    found = shared.stored(_found(source), "spans")
    added = _bootstrapped(found, source).join(found.select("row", "doc_id", "key"), "row")
    id_, key, more_ = (shared.fresh(documents, f"added_{x}") for x in ("id", "key", "spans"))
    added = added.groupBy(F.col("doc_id").alias(id_), F.col("key").alias(key))
    added = shared.stored(added.agg(F.collect_set(F.struct("kind", "start", "end")).alias(more_)), "added")
    small = added.count() <= BROADCAST_ADDED
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64(F.col("text").cast("string")) == F.col(key))
    joined = documents.join(F.broadcast(added) if small else added, same, "left").drop(id_, key)
    schema = documents.schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = []
            for text, more in zip(batch.column("text").to_pylist(), batch.column(more_).to_pylist()):
                spans = [dict(zip(("kind", "start", "end"), s)) for s in base_spans(text or "")] + (more or [])
                texts.append(redact(text, spans))
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    out = joined.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in schema.names else out


def op10_personal_data(spark, sf_dir: str) -> DataFrame:
    """Spans of all documents, as counts, digest and text."""
    found = personal_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [F.size(F.filter("base", _is(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    every = F.sort_array(F.concat("base", "added"))
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans")
    )
