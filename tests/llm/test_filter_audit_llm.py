"""Filter orders against a brute-force version, diagrams against plain counts of masks."""

import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from salesdq.llm import filter_audit

SF_DIR = "/root/testdata/sf0.001"


def plain_steps(names, masks):
    """Every order, step by step, over the masks themselves."""
    out, shapley = [], Counter()
    for order in itertools.permutations(range(len(names))):
        left = dict(masks)
        for step, bit in enumerate(order, 1):
            gone = {m: c for m, c in left.items() if m >> bit & 1}
            left = {m: c for m, c in left.items() if m not in gone}
            failing = sum(c[0] for m, c in masks.items() if m >> bit & 1)
            removed = sum(c[0] for c in gone.values())
            alone = masks.get(1 << bit, (0,))[0]
            lost = [sum(c[i] for c in gone.values()) for i in (1, 2)]
            shapley[bit] += removed
            out.append(["".join(names[b] for b in order), step, sum(c[0] for c in left.values()), removed, failing - removed, alone, *lost, bit])
    return sorted((*r[:-1], shapley[r[-1]]) for r in out)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_plain_changes_visit_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for i in filter_audit.plain_changes(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n))))


@pytest.mark.parametrize("seed", range(6))
def test_diagrams_equal_plain_counts(seed):
    rng = random.Random(seed)
    names = "ABCDE"[: rng.randint(1, 5)]
    masks = {m: (rng.randint(1, 9), rng.randint(0, 3), rng.randint(0, 3)) for m in range(1 << len(names)) if rng.random() < 0.5}
    masks = masks or {0: (1, 0, 0)}
    assert sorted(filter_audit.steps(names, masks)) == plain_steps(names, masks)


def test_diagrams_share_equal_nodes():
    masks = {m: (1, 0, 0) for m in range(32)}
    diagram = filter_audit.Diagram(range(5), masks)
    assert [len(x) for x in diagram.levels] == [1] * 5  # all subtrees are equal
    for i in filter_audit.plain_changes(5):
        diagram.swap(i)
        assert [len(x) for x in diagram.levels] == [1] * 5


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, prose(rng.randint(150, 260)), rng.choice(["en", "de"])) for i in range(40)]
    rows += [(50 + i, "copy " * 250, "en" if i % 3 else "fr") for i in range(60)]  # a third of all rows
    rows += [(200, "X" * 3 + "x" * 97, "en"), (201, "X" * 4 + "é" * 96, "en"), (202, "a|b", "de"), (203, None, None), (204, "", ""), (205, None, "en")]
    rows += [(206, "\x0b\x0ca b\x1c \r\n", "fr"), (None, "copy " * 250, "fr"), (None, "copy " * 250, None), (None, None, "en")]
    rows += [(0, rows[0][1], "en"), (0, rows[0][1], "de"), (0, "another text of that id", "en"), (7, rows[3][1], "es"), (300, "w " * 300_000, "es")]
    labels = [(i, i % 3 % 2, i % 5 == 0) for i in range(100)] + [(7, 1, False), (7, None, None), (None, 1, True), (999, 1, True)]
    return rows, [(i, q, None if t is None else int(t)) for i, q, t in labels]


def brute_force(rows, labels):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = ({i for i, *x in labels if x[k] == 1 and i is not None} for k in (0, 1))
    parts = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                  bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t]]
        c = parts[lang or ""][sum(f << k for k, f in enumerate(failed))]
        for k, x in enumerate((True, i in good, i in toxic)):
            c[k] += x
    return sorted((p, *r) for p, masks in parts.items() for r in plain_steps("ABCDE", {m: tuple(c) for m, c in masks.items()}))


def test_audit_equals_brute_force(spark, corpus):
    rows, labels = texts()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n long, part string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(filter_audit.mask_counts(docs, marks), "ABCDE")
    assert sorted(map(tuple, out.collect())) == brute_force(rows, labels)
    plain = filter_audit.audit(filter_audit.mask_counts(docs, marks.limit(0)), "ABCDE")
    assert sorted(map(tuple, plain.collect())) == brute_force(rows, [])
    assert filter_audit.audit(filter_audit.mask_counts(docs.limit(0), marks), "ABCDE").count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit(docs, "AA")


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op12_filter_orders"])
def test_registered_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    found = connection.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(tuple(r[n] for n in names) for r in entry.queries()[name](spark, SF_DIR).collect()) == sorted(found.fetchall())
