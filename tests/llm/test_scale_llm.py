"""What the operators do on hot keys, on both sides of their switches, and on texts of some MB."""

import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators_llm import brute_links, replaced, texts

import corpus_pipeline
from salesdq.llm import contamination, html_text, identifiers, jaccard, quality, repeats, sharding, shared, tokens, warc
from salesdq.llm import words as W

SF_DIR = "/root/testdata/sf0.001"


# --- 1: sharding

def place(rows):
    return sorted((str(r["doc_id"]), str(r["text"]), str(r["place"]), r["shard"], r["slot"]) for r in rows)


@pytest.mark.parametrize("broadcasts", [True, False])
def test_shards_depend_on_no_switch_and_no_partitions(spark, corpus, monkeypatch, broadcasts):
    rows = [(None, None, "a")] * 3000 + [(1, "same text", "a")] * 500 + [(i, f"text {i % 50}", "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, place string")
    if not broadcasts:
        monkeypatch.setattr(sharding, "BROADCAST_BUCKETS", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = [sharding.shuffle_to_shards(df.repartition(n), shared.folder(spark, "t"), 5, bucket_bytes=20_000) for n in (2, 7)]
        first, second = (place(x.collect()) for x in out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert first == second == SEEN.setdefault("shards", first)
    assert Counter(r[:3] for r in first) == Counter((str(i), str(t), p) for i, t, p in rows)
    assert sorted(out[0].columns) == ["doc_id", "place", "shard", "slot", "text"]
    for shard, n in Counter(r[3] for r in first).items():
        assert sorted(r[4] for r in first if r[3] == shard) == list(range(n)) and n == 1300


SEEN: dict = {}


def test_copies_are_spread_over_buckets(spark, corpus):
    """Half of all rows are equal: no bucket, and so no part of the result, gets many more of them than its share."""
    rows = [(None, None)] * 4000 + [(i, f"text {i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shuffle_to_shards(df, shared.folder(spark, "t"), 16, bucket_bytes=30_000).collect()
    copies = Counter(r["shard"] for r in out if r["doc_id"] is None)
    assert set(Counter(r["shard"] for r in out).values()) == {500}
    assert len(copies) == 16 and max(copies.values()) < 350 and min(copies.values()) > 150


def test_rows_with_maps_are_no_copies(spark, corpus):
    df = spark.sql("select 1L as doc_id, 'x' as text, map('k', id) as m from range(100)").select("doc_id", "text")
    out = sharding.shuffle_to_shards(df, shared.folder(spark, "t"), 3, bucket_bytes=500)
    assert out.count() == 100


# --- 2: archives

def chunk_batches(payload, chars=warc.CHUNK_CHARS):
    n = max(1, -(-len(payload) // chars))
    for k in range(n):
        columns = [pa.array([7]), pa.array(["u"]), pa.array([5]), pa.array([n]), pa.array([k]), pa.array([payload[k * chars : (k + 1) * chars]]),
                   pa.array([len(payload)]), pa.array(["D"]), pa.array(["response"]), pa.array([None], pa.int64())]
        names = ["page_id", "url", "payload_key", "chunks", "k", "chunk", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        yield pa.RecordBatch.from_arrays(columns, names)


def test_archives_hold_no_more_than_a_chunk():
    payload = "x" * 40_000_000
    assert len(list(warc.archive_texts(chunk_batches("x")))) == len(list(warc.carried_digests(chunk_batches("x")))) == 1  # all is imported
    tracemalloc.start()
    try:
        tracemalloc.reset_peak()
        assert [r[2] for r in warc.carried_digests(chunk_batches(payload))] == [len(payload)]
        assert sum(sum(map(len, b.column("value").to_pylist())) for b in warc.archive_texts(chunk_batches(payload))) > len(payload)
        assert tracemalloc.get_traced_memory()[1] < 4_000_000
    finally:
        tracemalloc.stop()


def test_chunks_are_cut_at_characters(spark, corpus):
    payloads = ["", "a", "é" * 70_000, "𝄞x\r\n" * 50_000, "z" * warc.CHUNK_CHARS, "z" * (warc.CHUNK_CHARS + 1)]
    df = spark.createDataFrame(list(enumerate(payloads)), "page_id long, payload string").repartition(3)
    rows = warc.chunk_table(df).collect()
    for i, text in enumerate(payloads):
        own = sorted((r["k"], r["chunk"]) for r in rows if r["page_id"] == i)
        assert "".join(c for _, c in own) == text and [k for k, _ in own] == list(range(len(own)))
        assert {r["chunks"] for r in rows if r["page_id"] == i} == {len(own)} and all(len(c) <= warc.CHUNK_CHARS for _, c in own)


# --- 4: pages

ODD_PAGES = {
    "open quotes": "<a '", "open double quotes": '<a "', "mixed quotes": "<a '\"", "nested blocks": "<div>", "crossed": "<b>x</i>", "unclosed lists": "<li><b>",
    "bare brackets": "<", "comments": "<!--", "declarations": "<!x", "scripts": "<script>", "script ends": "<script></script", "drawings": "<svg>", "drawing ends": "</svg",
    "paragraphs": "<p><i>", "cells": "<td><u>", "anchors": "<a href=x>", "references": "&amp", "classes": "<div class=\"content", "ends": "</div>", "attributes": "<p class=",
}


@pytest.mark.parametrize("kind", ODD_PAGES)
def test_odd_markup_takes_linear_time(kind):
    unit, took = ODD_PAGES[kind], []
    for size in (125_000, 1_000_000):
        page = "<article><p>first words of it</p>" + unit * (size // len(unit))
        start = time.perf_counter()
        tree = html_text.Tree(page)
        rows, _ = html_text.features([tree])
        tree.decode(html_text.rule_margins(rows))
        took.append(time.perf_counter() - start)
    assert took[1] < 20 and took[1] < 24 * took[0] + 0.5, took


def test_tags_end_at_the_first_bracket_outside_quotes():
    page = "<a b='>' c=\">\">x<b '>y<i>z"
    ends = html_text.TagEnds(page)
    assert page[: ends.after(2) + 1] == "<a b='>' c=\">\">"
    at = page.index("<b")
    assert ends.after(at + 2) == -1  # its quote never closes
    assert page[ends.after(page.index("<i") + 2)] == ">"


def test_teaching_depends_on_no_partitions(spark, corpus):
    pages = [(i % 7, "u", f"<nav>menu {i}</nav><article><p>{'word ' * (20 + i)}</p><p>more text, {i}</p></article><footer>end</footer>") for i in range(60)]
    pages += [(None, "u", pages[0][2]), (3, "u", None), (4, "u", "<article>" + "x" * (300 << 10) + "</article>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    row = html_text.features([html_text.Tree(pages[5][2])])[0]
    margins = [html_text.train(df.repartition(n), n_pages=20).margins(row) for n in (1, 5)]
    assert (margins[0] == margins[1]).all()


# --- 5, 10 and the pipeline: switches, names, empty tables

def clash(spark):
    names = ("place", "rejected_place", "repeated_place", "own_place", "added", "added_id", "added_key", "added_spans", "key", "row", "words", "r", "h", "n", "hot")
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    base = [f"{x}{k}" for x in "ab" for k in range(60)]
    rows = [(1, " ".join(base)), (2, replaced(base, {7}, "z")), (3, " ".join(reversed(base)) + " mail me@mail.example.org now"), (4, item), (5, "short"), (1, " ".join(base)), (None, None)]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(i, t, 0, *names) for i, t in rows], schema).repartition(2), names


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns_of_any_name(spark, corpus, k):
    docs, names = clash(spark)
    out = corpus_pipeline.STAGES[k][1](spark, docs, SF_DIR)
    rows = out.collect()
    assert out.columns == docs.columns and all(r[n] == n for r in rows for n in names)
    left = {0: {1, 2, 3, 4}, 1: {1, 3, 4, 5, None}, 2: {1, 2, 3, 5, None}, 3: {1, 2, 3, 4, 5, None}}[k]
    assert {r["doc_id"] for r in rows} == left and len(rows) == {0: 5, 1: 5, 2: 6, 3: 7}[k]


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_tables(spark, corpus, k):
    docs = spark.createDataFrame([], "doc_id long, text string, source string, n_chars long")
    out = corpus_pipeline.STAGES[k][1](spark, docs, SF_DIR)
    assert out.count() == 0 and (k == 4 or out.columns == docs.columns)


def test_stages_are_the_same_without_broadcasts(spark, corpus, monkeypatch):
    docs, _ = clash(spark)
    run = lambda: [sorted(str(tuple(r)) for r in stage(spark, docs, SF_DIR).collect()) for _, stage in corpus_pipeline.STAGES[:4]]
    want = run()
    for module, name in ((corpus_pipeline, "BROADCAST_DECISIONS"), (quality, "BROADCAST_LABELS"), (identifiers, "BROADCAST_ADDED"), (jaccard, "BROADCAST_MEMBERS")):
        monkeypatch.setattr(module, name, -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pattern_counts_are_those_of_all_texts(spark, corpus, monkeypatch):
    rows = [(i, t) for i, t in texts(corpus)] + [(i, f"see Client mail: u{i}@x.org and client  MAIL: v{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    patterns = spark.createDataFrame([("client mail:",), ("alpha0 beta1",), ("never there",), ("é ü",)], "pattern string")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

    def count(pattern):
        pairs = (w for _, t in rows for w in [[x for x in (t or "").translate(lower).replace("\t", " ").replace("\n", " ").split(" ") if x]])
        return sum(f"{a} {b}" == pattern for w in pairs for a, b in zip(w, w[1:-1]))

    want = {p: n for (p,) in patterns.collect() if (n := count(p))}
    assert want["client mail:"] == 100
    for bits in (1 << 25, 64):  # a full sieve lets all pairs through
        monkeypatch.setattr(identifiers, "SIEVE_BITS", bits)
        assert dict(map(tuple, identifiers._followed(identifiers._source(df), patterns).collect())) == want


def test_whole_long_numbers_are_redacted(spark, corpus):
    rows = [(i, f"text {i} here. our phone: +49 30 1234 {5670 + i} and") for i in range(40)] + [(99, "see our phone: 12345678901234567890123456 today")]
    got = {r["doc_id"]: r["text"] for r in identifiers.redacted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[99] == "see our phone: <PHONE> today"


# --- 6: repeated passages

def test_a_very_frequent_anchor_loses_no_window(spark, corpus):
    rng = random.Random(1)
    phrase = [f"p{k}" for k in range(16)]
    rows = [(i, [f"u{rng.randint(0, 30)}" for _ in range(12)] + phrase[: rng.randint(9, 16)] + [f"v{rng.randint(0, 3)}" for _ in range(12)]) for i in range(80)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(3)
    seen, want = {}, {}
    for i, w in rows:
        windows = [tuple(w[k : k + 13]) for k in range(len(w) - 12)]
        want[i] = len({k + j for k, x in enumerate(windows) if seen.get(x, i) < i for j in range(13)})
        for x in windows:
            seen.setdefault(x, i)
    assert {r["doc_id"]: r["n_removed"] for r in repeats.without_repeats(df).collect()} == want and sum(want.values()) > 500
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("candidates_")]


# --- 9: Jaccard join

def test_frequent_elements_change_no_link(spark, corpus, monkeypatch):
    """All texts sampled, lists dealt to bands and blocks, and clusters verified in many small groups."""
    rows = texts(corpus)
    for k in range(40):  # near copies of three texts, some of them of each other's near copies
        base = [f"l{k % 3}w{j}" for j in range(120)]
        rows.append((2000 + k, replaced(base, range(k, 120, 25 + k), f"o{k}x")))
    rows += [(3000 + k, " ".join([f"t{j}" for j in range(30)] + [f"own{k}"])) for k in range(30)]  # a template
    rows += [(3100 + k, " ".join(f"t{j}" for j in range(k, 12 + k % 4))) for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    monkeypatch.setattr(jaccard, "LIST_SETS", 4)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    monkeypatch.setattr(jaccard, "STAR_SETS", 2)
    for percent, width in ((80, 5), (90, 3)):
        plan = jaccard.planned(df, percent, width, sampled=1)
        assert len(plan.frequent) > 20 and plan.blocks.max() > 3
        got = Counter(map(tuple, jaccard.jaccard_components(df, percent, width, sampled=1).collect()))
        assert got == brute_links(rows, percent, width)


def corpora(spark):
    """Short texts that have nothing in common, and short texts of few common words."""
    plain = [(i, " ".join(f"w{i}x{j}" for j in range(6 + i % 14))) for i in range(300)]
    plain += [(1000 + i, plain[i][1] + " more") for i in range(300)]
    rng = random.Random(2)
    common = [(i, " ".join(rng.choice("ab") for _ in range(6 + i % 14))) for i in range(600)]
    return [(rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) for rows in (plain, common)]


def test_costs_decide_the_boundary(spark, corpus):
    edges = []
    for rows, df in corpora(spark):
        edges.append(jaccard.planned(df, 80, 3, sampled=1).edge)
        want = brute_links(rows, 80, 3)
        assert Counter(map(tuple, jaccard.jaccard_components(df, 80, 3, sampled=1).collect())) == want
        for edge in (0, 9, jaccard.furthest_edge(80)):  # one element less, and two
            pinned = lambda percent, listed, e=edge: e
            original, jaccard.cheapest_edge = jaccard.cheapest_edge, pinned
            try:
                assert Counter(map(tuple, jaccard.jaccard_components(df, 80, 3, sampled=1).collect())) == want
            finally:
                jaccard.cheapest_edge = original
    assert edges[0] != edges[1]


def test_boundary_follows_the_costs():
    dear, cheap = {n: (100, 100_000.0) for n in range(4, 15)}, {n: (100, 50.0) for n in range(4, 15)}
    assert jaccard.cheapest_edge(80, cheap) == 0 and jaccard.Plan(80, jaccard.cheapest_edge(80, dear)).less == 2
    assert jaccard.furthest_edge(80) == 14 and jaccard.furthest_edge(90) == 29
    assert jaccard.Plan(80, 9).less == 1 and jaccard.Plan(80, 14).less == 2 and jaccard.Plan(90, 19).less == 1 and jaccard.Plan(90, 20).less == 2
    assert jaccard.least_linked(80) == 4 and jaccard.least_linked(90) == 9


def test_common_phrases_make_no_large_groups(spark, corpus):
    """Some thousand unrelated texts that share phrases: candidates stay few, at the pipeline's own law."""
    rng = random.Random(5)
    phrases = [" ".join(f"ph{p}w{j}" for j in range(12)) for p in range(12)]
    rows = []
    for i in range(3000):
        own = [f"d{i}w{j}" for j in range(60)]
        for p in rng.sample(phrases, 3):
            own.insert(rng.randint(0, 60), p)
        rows.append((i, " ".join(own)))
    rows += [(5000 + i, rows[i][1] + " end") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    plan = jaccard.planned(df, 80, 5)
    large = jaccard.shingle_sets(df, plan, 5).select("key", "n", "elements", "blocks", "signature").dropDuplicates(["key"])
    near = jaccard._candidates(jaccard._listed(shared.stored(large, "large"), 80), 80, 8).collect()
    groups = {}
    for a, b, _ in near:
        groups.setdefault(a, set()).add(b)
    assert sum(map(len, groups.values())) <= 30 and max(map(len, groups.values())) <= 2
    got = jaccard.jaccard_components(df, 80, 5)
    assert got.where("doc_id <> component_id").count() == 20


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[: int(rng.integers(0, n + 1))], rng.integers(0, 1 << 62, int(rng.integers(0, 200))).astype(np.uint64)])
        sums = []
        for x in (a, b):
            data, size = jaccard._signatures(x, np.array([len(x)]))
            sums.append(np.frombuffer(data.tobytes(), np.uint64) if len(x) else np.zeros(1, np.uint64))
        x, y = sums if len(sums[0]) >= len(sums[1]) else sums[::-1]
        while len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        apart = len(set(a.tolist()) ^ set(b.tolist()))
        assert int(np.bitwise_count(x ^ y).sum()) <= apart


# --- texts of some MB

def test_sums_of_narrow_links_have_half_the_bits():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n, off = int(rng.integers(150, 400)), int(rng.integers(0, 12))
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[off:], rng.integers(0, 1 << 62, off).astype(np.uint64)])
        other = rng.integers(0, 1 << 62, n).astype(np.uint64)
        wide = jaccard._signatures(a, np.array([n]))[1][0]
        sums = []
        for x in (a, b, other):
            data, size = jaccard._signatures(x, np.array([n]), 90)
            assert 2 * size[0] == wide
            sums.append(np.frombuffer(data.tobytes(), np.uint64))
        assert int(np.bitwise_count(sums[0] ^ sums[1]).sum()) <= 2 * off
        assert int(np.bitwise_count(sums[0] ^ sums[2]).sum()) > 0.11 * n


def test_sets_of_far_sizes_do_not_stay_in_a_list(spark):
    """Of element 1 no two sizes can link, of 2 the middle ones can, of 3 equal ones can; 4 stands alone and 5 is frequent."""
    sizes = {1: [20, 40, 100, 300], 2: [20, 90, 100, 300], 3: [50, 50], 4: [70], 5: [30, 90]}
    rows = [(100 * e + i, n, [e], [int(e == 5)], bytes(8)) for e, ns in sizes.items() for i, n in enumerate(ns)]
    large = spark.createDataFrame(rows, "key long, n long, elements array<long>, blocks array<int>, signature binary")
    got = jaccard._listed(large, 90).select("e", "n").collect()
    assert sorted(map(tuple, got)) == [(2, 90), (2, 100), (3, 50), (3, 50), (5, 30), (5, 90)]


def test_batches_for_python_end_at_bytes(spark):
    """Long texts reach a worker a few MB at a time, and the session's setting is as before."""
    def sizes(parts):
        for batch in parts:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["b"])

    before = {name: spark.conf.get(name, None) for name in shared.WRITING}
    texts = spark.range(0, 3000, numPartitions=1).select(F.repeat(F.lit("word "), 2000).alias("text"))
    got = [r["b"] for r in shared.stored(texts.mapInArrow(sizes, "b long"), "sizes").collect()]
    assert sum(got) >= 30_000_000 and max(got) < 10_000_000
    assert before == {name: spark.conf.get(name, None) for name in shared.WRITING}


def test_tables_of_an_encoder_stay_small():
    memo = tokens.Memo()
    assert memo.keys.nbytes + memo.first.nbytes + memo.size.nbytes <= 34_000_000


def test_words_of_a_long_text(spark, corpus):
    text = " ".join(f"w{i % 5000}" for i in range(400_000))
    rows = [(1, text), (2, text + " end"), (3, "other " * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert {r[0]: r[2] for r in map(tuple, jaccard.jaccard_components(df, 80, 5).collect())} == {1: 1, 2: 1, 3: 3}
    out = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in repeats.without_repeats(df).collect()}
    assert out == {1: (400_000, 0), 2: (400_001, 400_000), 3: (300_000, 0)}
    assert {r["doc_id"] for r in quality.quality_rules(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()} == {1, 2, 3}
    assert sum(len(w.starts) for w in W.split(pa.array([text]))) == 400_000
    clean = identifiers.redacted(df.limit(1)).first()["text"]
    assert len(clean) in (len(text), len(text) + 4, len(rows[2][1]))


# --- 8: contamination

def test_items_sent_and_items_in_a_table_find_the_same(spark, corpus, monkeypatch):
    long = [(900 + i, " ".join([*(f"f{i}x{k}" for k in range(4000)), *(f"q{i}w{k}" for k in range(20)), *(f"g{i}x{k}" for k in range(999))])) for i in range(5)]
    docs = spark.createDataFrame(long + long[:2], "doc_id long, text string").unionByName(corpus.select("doc_id", "text"))
    items = [(i, " ".join(f"Q{i}W{k}" for k in range(20))) for i in range(5)] + [(0, "Q0W0 q0w1 q0w2 q0w3 q0w4")]
    items += [(20 + k, " ".join(f"f{k % 5}x{j}" for j in range(97 * k, 97 * k + 5 + k % 30))) for k in range(40)]
    items += [(7, "too short"), (8, None), (None, " ".join(f"f3x{k}" for k in range(600))), (11, " ".join(f"f3x{k}" for k in range(300)) + " and others")]
    table = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    run = lambda d, t: Counter(tuple(r) for r in contamination.contained_items(d, t).collect())
    want = run(docs, table)
    assert sum(want.values()) > 50 and any(i is None for _, i, _ in want)
    monkeypatch.setattr(contamination, "ITEM_BYTES", -1)
    for bits in (1 << 26, 64):
        monkeypatch.setattr(contamination, "SIEVE_BITS", bits)
        assert run(docs, table) == want
    assert not run(docs.limit(0), table) and not run(docs, table.limit(0))
