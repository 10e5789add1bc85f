"""Each operator against a brute-force version, on documents that hold every odd case."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from salesdq.llm import (
    bestfit, contamination, graph, html_text, identifiers, jaccard, packing, quality, repeats, sharding, shared, tokens, warc,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- 1: sharding

@pytest.mark.parametrize("bucket_bytes", [1 << 20, 2000])
def test_shards_hold_all_rows_in_equal_numbers(spark, corpus, bucket_bytes):
    out = sharding.shuffle_to_shards(corpus, shared.folder(spark, "t"), 4, bucket_bytes=bucket_bytes)
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"], r["words"]) for r in rows) == Counter((i, t, 2) for i, t in texts(corpus))
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == {0, 1, 2, 3} and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    again = sharding.shuffle_to_shards(corpus.repartition(7), shared.folder(spark, "t"), 4, bucket_bytes=bucket_bytes)
    place = lambda rs: sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in rs)
    assert place(again.collect()) == place(rows)


def test_nothing_to_shard(spark, empty):
    assert sharding.shuffle_to_shards(empty, shared.folder(spark, "t"), 4).count() == 0


# --- 2: archives

def test_archives_come_back(spark, corpus):
    odd = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(1, "u", odd), (2, "u\r\nv", odd), (3, None, None), (4, "u", ""), (5, "u", "é" * 150_000), (6, "u", "é" * 150_000 + "!"),
             (7, "u", odd * 9000), (None, "u", odd), (9, "u", "\r\n\r\n"), (9, "u", "\r\n\r\n"), (9, "u", "other")]
    df = spark.createDataFrame([(*p, 0) for p in pages], "page_id long, url string, html string, payload int").repartition(2)
    path = shared.folder(spark, "warc")
    warc.write_archives(df, path)
    got = Counter(map(tuple, warc.read_archives(spark, path).collect()))
    best = {}
    for i, _, h in pages:
        h = h or ""
        if h not in best or (i or -1) > (best[h] or -1):
            best[h] = i
    want = Counter()
    for i, _, h in pages:
        b = (h or "").encode()
        same = best[h or ""] == i
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if same else "revisit", None if same else best[h or ""])] += 1
    assert got == want
    warc.write_archives(df.limit(0), path + "e")
    assert warc.read_archives(spark, path + "e").count() == 0


# --- 3 and 7: token ids and packing

ODD = ["", "  a\x1cb\x1d c", "don't it's we'll I'D x ''s 's't 'sup \"'s", "İstanbul ΣΑΣ é ﬁ 漢字 12", "<|endoftext|> hi", "ab\x01cd",
       "É ÀÉ. ß ẞ ÿ µ × ÷", "\x85a\x85b", "don'", "t", "12.5", "é", "***" * 200, "aaaa" * 300]


def reference_ids():
    tokenizer = Tokenizer.from_file(tokens.default_path())
    return lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")


def test_ids_are_the_tokenizers(corpus):
    every = ODD + [t for _, t in texts(corpus)]
    ids = reference_ids()
    assert tokens.Encoder(tokens.default_path(), 2).encode(pa.array(every, pa.string())) == [ids(t).tobytes() for t in every]


def test_concatenate_and_cut_loses_nothing(corpus, empty):
    pieces = packing.concatenate_and_cut(corpus, length=256).collect()
    ids = reference_ids()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
    want = defaultdict(list)
    for i, t in texts(corpus):
        want[i].append(ids(t).tobytes())
    for i, whole in want.items():
        assert sum(p["length"] for p in by_doc[i]) == sum(len(w) // 4 for w in whole)
        if len(whole) == 1:
            assert b"".join(p["ids"] for p in sorted(by_doc[i], key=lambda p: p["start"])) == whole[0]
    filled = defaultdict(list)
    for p in pieces:
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for s, parts in filled.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 256 or s == max(filled)
    assert packing.concatenate_and_cut(empty).count() == 0


def test_best_fit_bins():
    rng = np.random.default_rng(0)
    for width in (1, 7, 64):
        lengths = rng.integers(1, width + 1, 300).tolist()
        free, number = [], {}
        for i in sorted(range(300), key=lambda i: -lengths[i]):  # brute force: the fullest bin that still takes it
            fitting = [b for b, c in enumerate(free) if c >= lengths[i]]
            b = min(fitting, key=lambda b: free[b]) if fitting else len(free)
            free[b:b + 1] = [(free[b] if fitting else width) - lengths[i]]
            number[i] = b
        bins = bestfit.best_fit(lengths, width)
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert sorted(sum(lengths[i] for i in b) for b in bins) == sorted(width - c for c in free)


def test_packed_rows_hold_every_document(spark, corpus, empty):
    rows = bestfit.pack(corpus, shared.folder(spark, "t"), width=128).collect()
    ids, got, want = reference_ids(), defaultdict(list), defaultdict(int)
    for r in rows:
        whole = np.frombuffer(r["ids"], "<u4")
        assert len(whole) == 128 and r["cu_seqlens"][-1] == r["n_tokens"] and r["resets"] == r["cu_seqlens"][:-1]
        assert not whole[r["n_tokens"]:].any()
        for k, (a, b) in enumerate(zip(r["cu_seqlens"], r["cu_seqlens"][1:])):
            got[r["docs"][k]].append((r["starts"][k], whole[a:b].tobytes()))
    for i, t in texts(corpus):
        want[i] += len(ids(t))
        if sum(j == i for j, _ in texts(corpus)) == 1:
            assert b"".join(x for _, x in sorted(got[i])) == ids(t).tobytes()
    assert {i: sum(len(x) // 4 for _, x in v) for i, v in got.items()} == want
    assert sorted(r["row_id"] for r in rows) == list(range(len(rows)))
    assert bestfit.pack(empty, shared.folder(spark, "t")).count() == 0


# --- 4: main text

PAGE = """<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href=/a>Menu</a></li></ul></nav>
<div class="ad">Buy&nbsp;now</div><article><h1>Head &amp; line</h1><p><b>First  text,<br>of {n}.<p>Second one, with words. </p></article>
<div class="comments"><p>I say so.</p></div><footer>&copy; me</footer></body></html>"""


def test_main_text_of_marked_pages(spark, corpus):
    rows = [(i, f"u{i}", PAGE.replace("{n}", str(i)).replace("Second", "Second " * (1 + i % 5)), 1) for i in range(60)]
    rows += [(60, None, None, 1), (61, "u", "", 1), (62, "u", "<", 1), (5, "u5", rows[5][2], 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = [(r["page_id"], r["text"]) for r in html_text.main_text(pages, html_text.train(pages)).collect()]
    want = {i: f"Head & line\nFirst text, of {i}.\n{('Second ' * (1 + i % 5)).strip()} one, with words." for i in range(60)} | {60: "", 61: ""}
    assert len(got) == 64 and all(t == want[i] for i, t in got if i in want)
    assert html_text.main_text(pages.limit(0), None).count() == 0 and html_text.train(pages.limit(0)) is None


@pytest.mark.parametrize("tag", ['div class="content"', 'div class="entry"', 'div class="post-body"', "div", "section"])
def test_main_text_of_unmarked_pages_beside_marked_ones(spark, corpus, tag):
    def page(i, mark):
        lines = [f"<p>Line {i} {k} of the report, which is told in many words, as such lines are, and goes on for a while.</p>" for k in range(2 + i % 5)]
        inner = f"<{mark}><h1>Report {i}</h1>{''.join(lines)}</{mark.split()[0]}>"
        links = "".join(f"<li><a href=/{k}>Place {k}</a></li>" for k in range(3 + i % 4))
        return (f"<html><body><div class=top><ul>{links}</ul></div><nav><ul>{links}</ul></nav><div class=ad>Buy now</div>{inner}"
                f"<div class=comments><p>I say so.</p></div><footer><p>By us, {i}</p></footer></body></html>")

    rows = [(i, "u", page(i, "article" if i % 2 else "main")) for i in range(60)] + [(100 + i, "u", page(i, tag)) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(pages, html_text.train(pages)).collect()}
    for i in range(20):
        assert got[i].startswith(f"Report {i}\nLine {i} 0 of") and got[i].count("\n") == 2 + i % 5
        assert got[100 + i].count("goes on for a while.") == 2 + i % 5
        assert not any(x in got[100 + i] for x in ("Place", "Buy", "say so"))


def test_every_page_teaches():
    assert html_text.taken([10, 1000, 30, 0], 100).sum() == 100 and html_text.taken([10, 20], 100).sum() == 30
    assert [x.sum() for x in np.split(html_text.taken([10, 1000, 1000], 100), [10, 1010])] == [10, 45, 45]


@pytest.mark.parametrize("odd", ['<svg class="icon"/>', "<select><option>1", '<object data="x">', "<noscript>", "<template>", '<svg><path d="M0"/><g/></svg>',
                                 "<select><option>1<option>2</select>", "<object>x<select></object>", "<svg viewBox='0'>", "<math/>"])
def test_text_behind_embedded_elements_stays(odd):
    page = f"<html><body><p>Before it.</p>{odd}<div><p>Behind it.</p><select><option>9</select><p>At the end.</p></div></body></html>"
    tree = html_text.Tree(page)
    kept = tree.decode(html_text.rule_margins(html_text.features([tree])[0]))
    assert [t for t in kept if "it" in t or "end" in t] == ["Before it.", "Behind it.", "At the end."] and not {"2", "9"} & set(kept)


def test_formulas_are_text():
    tree = html_text.Tree("<article><p>Here <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds.</p><p>More</article>")
    assert [t for t in tree.texts if t] == ["Here E=m holds.", "More"]


def test_kept_nodes_have_kept_ancestors():
    tree = html_text.Tree(PAGE)
    margins = np.full(len(tree.names), 3.0)
    margins[tree.names.index("article")] = -50
    assert all("text," not in t for t in tree.decode(margins))


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = html_text.BoostedTrees().fit(x[:3000], y[:3000])
    assert ((model.margins(x[3000:]) > 0) == y[3000:]).mean() > 0.95


# --- 5: quality rules

def test_base_counts(spark, corpus):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 30)] + [(406, 0, 0), (7, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = Counter(map(tuple, quality.quality_rules(corpus, labels).drop("score", "kept").collect()))
    want = Counter()
    for i, t in texts(corpus):
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        covered = {k + o for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for o in range(8)}
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed)] += 1
    assert got == want
    assert quality.quality_rules(corpus.limit(0), labels).count() == 0
    assert quality.quality_rules(corpus, labels.limit(0)).count() == corpus.count()


# --- 6: repeated passages

def test_repeats_are_removed(corpus, empty):
    rows = texts(corpus)
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = WORD.findall(t or "")
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p:p + 13]), i)
    want = Counter()
    for i, t in rows:
        w = WORD.findall(t or "")
        keep = [True] * len(w)
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p:p + 13])] < i:
                keep[p:p + 13] = [False] * 13
        kept = [x for x, k in zip(w, keep) if k]
        want[(i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())] += 1
    assert Counter(map(tuple, repeats.without_repeats(corpus).collect())) == want
    assert sum(n for _, _, n, _ in want) > 500
    assert repeats.without_repeats(empty).count() == 0


# --- 8: contamination

def test_items_are_found_in_long_documents(spark, corpus):
    long = [(900 + i, " ".join([*(f"f{i}x{k}" for k in range(4000)), *(f"q{i}w{k}" for k in range(20)), *(f"g{i}x{k}" for k in range(999))])) for i in range(5)]
    docs = spark.createDataFrame(long, "doc_id long, text string").unionByName(corpus.select("doc_id", "text"))
    items = [(i, " ".join(f"Q{i}W{k}" for k in range(20))) for i in range(5)]  # another case
    items += [(5, " ".join([f"q0w{k}" for k in range(18)] + ["new", "words"])), (6, " ".join([f"q0w{k}" for k in range(9)] + [f"z{k}" for k in range(11)]))]
    items += [(20 + k, " ".join(f"f{k % 5}x{j}" for j in range(97 * k, 97 * k + 5 + k % 4))) for k in range(40)]  # one to four shingles
    items += [(7, "too short"), (8, None), (9, ""), (0, items[0][1]), (10, " ".join(f"f3x{k}" for k in range(300)))]
    got = Counter(tuple(r)[:2] for r in contamination.contained_items(docs, spark.createDataFrame(items, "item_id long, text string")).collect())

    def shingles(t):
        w = WORD.findall((t or "").lower())
        return set(zip(*(w[k:] for k in range(5))))

    want = Counter((i, k) for i, t in texts(docs) for k, q in items if shingles(q) and len(shingles(q) & shingles(t)) >= 0.8 * len(shingles(q)))
    assert got == want and want[(900, 0)] == 2 and want[(900, 5)] == 1 and want[(903, 10)] == 1
    assert all(want[(900 + k % 5, 20 + k)] == 1 for k in range(40))
    assert contamination.contained_items(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert contamination.contained_items(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


# --- 9: Jaccard join

def brute_components(rows, percent=90):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets, parent = [], {}
    for _, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append(set(zip(w, w[1:], w[2:])) if len(w) > 2 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return Counter((i, len(sets[x]), least.get(root(x)) if sets[x] else i) for x, (i, _) in enumerate(rows))


def test_jaccard_components(corpus, empty, monkeypatch):
    want = brute_components(texts(corpus))
    assert Counter(map(tuple, jaccard.jaccard_components(corpus).collect())) == want
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 2)  # many blocks for one cluster
    assert Counter(map(tuple, jaccard.jaccard_components(corpus).collect())) == want
    assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_around_the_boundary(spark, corpus):
    rows, k = [], 0
    for n in (9, 10, 11, 17, 18, 19, 20, 21, 22, 30, 31):  # sets of sizes around the boundary, cut and extended
        base = [f"b{n}w{j}" for j in range(n + 2)]
        for words in (base, base[1:], base[:-1], base[1:-1], base + ["x"], ["y"] + base, base[: n // 2] + ["z"] + base[n // 2 + 1 :]):
            rows.append((k, " ".join(words)))
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard.jaccard_components(df).collect())) == brute_components(rows)


def brute_links(rows, percent, width):
    """Least id reachable by links of ``percent`` on shingles of ``width`` words, null ids taking part: (id, set size, component)."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append(set(zip(*(w[k:] for k in range(width)))) if len(w) >= width else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return Counter((i, len(s), least.get(g) if s else i) for g, s, (i, _) in zip(group, sets, rows))


def replaced(words, places, tag):
    return " ".join(f"{tag}{k}" if k in places else w for k, w in enumerate(words))


@pytest.mark.parametrize("percent, width", [(80, 5), (90, 3)])
def test_jaccard_between_the_two_laws(spark, corpus, percent, width):
    rows = texts(corpus)
    for k in range(12):  # 200 words, one to six of them replaced: 0.81 of five words and 0.886 of three with four of them
        base = [f"l{k}w{j}" for j in range(200)]
        rows += [(2000 + 2 * k, " ".join(base)), (2001 + 2 * k, replaced(base, range(20, 20 + 30 * (1 + k % 6), 30), "other"))]
    for n in range(5, 24):  # around the boundary of subsets and lists
        base = [f"s{n}w{j}" for j in range(n)]
        for j, words in enumerate((base, base[1:], base[:-1], base + ["x"], base[2:], ["y"] + base + ["z"])):
            rows.append((3000 + 10 * n + j, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_links(rows, percent, width)
    assert (want[(2007, 196 if width == 5 else 198, 2006)] == 1) == (width == 5)
    assert Counter(map(tuple, jaccard.jaccard_components(df, percent, width).collect())) == want


def test_null_ids_link_like_others(spark, corpus):
    base, chain, lone = ([f"{x}{j}" for j in range(100)] for x in ("n", "c", "o"))
    rows = [(5, " ".join(base)), (None, replaced(base, {50}, "x")), (None, replaced(base, {50}, "x"))]
    # two documents joined only by a text without an id, and texts without ids only
    rows += [(11, replaced(chain, {0, 1, 2}, "x")), (None, " ".join(chain)), (12, replaced(chain, {97, 98, 99}, "y"))]
    rows += [(None, " ".join(lone)), (None, replaced(lone, {50}, "x")), (13, " ".join(lone[:60]))]
    want = brute_links(rows, 90, 3)
    assert want[(None, 98, 5)] == 2 and want[(12, 98, 11)] == 1 and want[(None, 98, None)] == 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, jaccard.jaccard_components(df).collect())) == want


def test_components_of_a_long_chain(spark, corpus):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (500, 502), (7, 7)]
    got = dict(map(tuple, graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500, 502: 500}


# --- 10: personal data

def test_base_spans_match_the_patterns():
    rng, alphabet = np.random.default_rng(0), list("a1.@+- ()5x,9é")
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def fits(k, s):
        digits = re.sub("[^0-9]", "", s)
        return (k == 0 or k == 1 and all(int(x) <= 255 for x in s.split(".")) or k == 2 and 13 <= len(digits) <= 19 and identifiers._luhn(digits)
                or k == 3 and 9 <= len(digits) <= 15)

    for _ in range(4000):
        t = "".join(rng.choice(alphabet, rng.integers(0, 40)))
        assert identifiers.base_spans(t) == [(k, *m.span()) for k, p in enumerate(patterns) for m in re.finditer(p, t) if fits(k, m.group())]


def test_contexts_discover_unseen_identifiers(spark, corpus):
    rows = [(i, f"text {i} here. client mail: user{i}@mail.example.org and so on") for i in range(9)]
    rows += [(20, "see client mail: user77(at)mail.example.org today"), (21, "the number user77(at)mail.example.org alone"), (22, "nothing 123456x here"),
             (23, None), (24, ""), (None, "client mail: other99[at]x.org"), (20, "again 4111 1111 1111 1111 paid")]
    df = spark.createDataFrame([(*r, 7, 0) for r in rows], "doc_id long, text string, row int, n_chars int")
    found = [(r["doc_id"], [tuple(s) for s in r["base"]], [tuple(s) for s in r["added"]]) for r in identifiers.personal_spans(df).collect()]
    assert len(found) == len(rows)
    assert (20, [], [(0, 17, 43)]) in found and (22, [], []) in found and (23, [], []) in found
    assert any(i is None and added for i, _, added in found)
    clean = {(r["doc_id"], r["text"], r["n_chars"], r["row"]) for r in identifiers.redacted(df).collect()}
    assert (20, "see client mail: <EMAIL> today", 30, 7) in clean and (20, "again <CARD> paid", 17, 7) in clean
    assert (22, "nothing 123456x here", 20, 7) in clean and (23, None, None, 7) in clean and len(clean) == len(rows)
    assert identifiers.personal_spans(df.limit(0)).count() == 0


def test_unseen_identifiers_of_each_form(spark, corpus):
    rows = [(i, f"text {i} here. client mail: user{i}@mail.example.org and") for i in range(40)]
    rows += [(i, f"text {i} here. our phone: +49 30 1234 {5670 + i} and") for i in range(40)]
    rows += [(i, f"the {'w' * 150}{' ' * 200}key: name{i}@mail.example.org and") for i in range(40)]
    unseen = {"client mail:": ["anna(at)mail.example.org", "bert [at] mail.example.org", "carl at mail.example.org", "dora.mail.org"],
              "our phone:": ["030 1234 567", "(030) 1234-567", "4111 1111 1111 1112"], "w" * 150 + " " * 200 + "key:": ["emil(at)mail.example.org"]}
    odd = [(f"see {p} {v} today", f"see {p} <{'PHONE' if 'phone' in p else 'EMAIL'}> today") for p, vs in unseen.items() for v in vs]
    odd += [(t, t) for t in ("see client mail: pending today", "see our phone: later today", "call 030 1234 567 now", "so anna(at)mail.example.org")]
    rows += [(100 + i, t) for i, (t, _) in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in identifiers.redacted(df).collect()}
    assert [got[100 + i] for i in range(len(odd))] == [t for _, t in odd]


def test_discovery_goes_on_until_nothing_changes(spark, corpus):
    rows = [(0, f"see first mail: seed{i}@x.org now") for i in range(12)]
    for k in range(6):  # each pattern knows most of its values only from the one before
        rows += [(0, f"see pattern{k} mail: new{k}n{i}(at)x.org now") for i in range(3) for _ in range(4)] if k else []
        rows += [(k + 1, f"see {f'pattern{k}' if k else 'first'} mail: new{k + 1}n{i}(at)x.org now") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = identifiers.personal_spans(df).where("doc_id > 0").collect()
    assert len(found) == 18 and all(len(r["added"]) == 1 for r in found)


def test_redaction_of_overlapping_spans():
    spans = [dict(kind=k, start=a, end=b) for k, a, b in ((0, 2, 6), (3, 4, 9))]
    assert identifiers.redact("a 12345678 b", spans) == "a <EMAIL>8 b"
    assert identifiers.redact(None, []) is None
