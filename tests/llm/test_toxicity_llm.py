"""Toxicity by held-out accuracy, and the learner's parts one by one."""

import random
import zlib

import numpy as np
import pyarrow as pa

import __spark_entry__ as entry
from salesdq.llm import toxicity

SF_DIR = "/root/testdata/sf0.1"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()
BAD = ["vile", "rotten", "nasty", "awful"]


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n)]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0


def corpus_of(n=600):
    rows, labels = [], []
    for i in range(n):
        w, toxic = prose(i, 40 + i % 50), i % 6 == 0
        if toxic:
            w[5], w[20] = BAD[i % 4].upper() + "!!", BAD[i // 6 % 4] + "###"
        rows.append((i, " ".join(w)))
        if i % 7 < 3:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark, corpus):
    rows, labels = corpus_of()
    odd = [(None, "vile rotten"), (None, None), (700, ""), (701, "VILE. Rotten; nasty"), (701, "quite fine"), (702, "fine " * 400_000 + "vile rotten nasty")]
    flags = labels + [(None, 1), (701, None), (3, 0), (3, None)]
    docs = spark.createDataFrame([(*r, 1.0, 7) for r in rows + odd], "doc_id long, text string, score double, confirmed int").repartition(3)
    got = toxicity.toxicity(docs, spark.createDataFrame(flags, "doc_id long, toxic int")).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    named = {r["doc_id"]: r["predicted"] for r in got if r["doc_id"] is not None and r["doc_id"] < len(rows)}
    assert all(named[i] == (i % 6 == 0) for i in named)
    assert sorted(r["predicted"] for r in got if r["doc_id"] == 701) == [0, 1]
    assert [r["predicted"] for r in got if r["doc_id"] in (700, 702)] in ([0, 1], [1, 0])
    assert sorted(r["predicted"] for r in got if r["doc_id"] is None) == [0, 1]


def test_held_out_labels_teach_nothing(spark, corpus):
    rows, labels = corpus_of(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    run = lambda flags: sorted(map(tuple, toxicity.toxicity(docs, spark.createDataFrame(flags, "doc_id long, toxic int")).collect()))
    turned = [(i, 1 - t if held(i) else t) for i, t in labels]
    assert any(held(i) for i, _ in labels) and run(labels) == run(turned)
    assert run(labels) == sorted(map(tuple, toxicity.toxicity(docs.repartition(7), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()))


def test_nothing_to_learn_from(spark, corpus):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")
    for flags in (labels, labels.limit(0)):
        assert {round(r["score"], 9) for r in toxicity.toxicity(docs, flags).collect()} == {0.05}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_words_are_lower_case_letters_and_digits():
    texts = ["Vile!! vile###", None, "", "ÉÉ x-y", "vile"]
    found = {}
    for start, end, row, bucket in toxicity.word_buckets(pa.array(texts), 18):
        for r, b in zip(row, bucket):
            found.setdefault(start + r, []).append(b)
    assert set(found[0]) == set(found[4]) and len(found[0]) == 2 and len(found[3]) == 3 and 1 not in found and 2 not in found


def test_risk_below_zero_is_stepped_back_from():
    """Words that P alone has by chance: without the step back the risk on clean text is driven far below zero."""
    rng = np.random.default_rng(0)
    n_p, n_u, width = 30, 120, 10
    confirmed = np.arange(n_p + n_u) < n_p
    rows = np.repeat(np.arange(n_p + n_u), 8)
    buckets = np.where(np.repeat(confirmed, 8), rng.integers(0, 60, len(rows)), rng.integers(40, 1 << width, len(rows)))
    model = toxicity.Model(bits=width, lift=1.0, decay=0.0)
    prior = 0.4

    def risk(c):
        z = np.bincount(rows, c.weights[buckets], len(confirmed)) + c.bias
        loss = np.logaddexp(0, z)
        return loss[~confirmed].mean() - prior * loss[confirmed].mean()

    careless = toxicity.Model(bits=width, lift=1.0, decay=0.0, slack=1e9)
    assert risk(toxicity.learned(rows, buckets, confirmed, prior, model)) > -0.2
    assert risk(toxicity.learned(rows, buckets, confirmed, prior, careless)) < -1.0


def test_registered_query_on_held_out_rows(spark):
    scored = entry.queries()["op13_toxicity"](spark, SF_DIR)
    rows = scored.join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = ([r for r in rows if r["toxic"] == t] for t in (1, 0))
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic) and sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
