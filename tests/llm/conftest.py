import pytest

from salesdq.llm import shared

PROSE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    """n words that depend on the seed alone, with few chance repeats."""
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(PROSE[x % 24] + str(x // 24 % 97))
    return out


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with every odd case: copies, near copies, shared passages, nulls, empties, repeats, a clashing column."""
    shared.ship(spark)
    passage = prose(99, 30)
    rows = [(i, " ".join(prose(i, 60 + i))) for i in range(1, 30)]
    rows += [(100 + i, " ".join(prose(5, 65))) for i in range(6)]  # copies of 5
    for i in range(6):  # near copies
        w = prose(7, 200)
        w[10 + 20 * i] = f"other{i}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, " ".join(prose(400 + i, 20) + passage + prose(500 + i, 20))) for i in range(4)]
    rows += [(310, " ".join(passage)), (311, "  " + "\t".join(passage[:12]) + "\n"), (312, " ".join(passage[:13]))]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "one two"), (405, "ONE two"), (406, "a b c a b c a b c")]
    rows += [(407, "word " * 3000), (408, "é ü " * 40), (20, dict(rows)[20]), (20, "another text of the same id"), (None, "no id here"), (None, None)]
    rows += [(409, " ".join(prose(8, 12))), (410, " ".join(prose(8, 13)))]
    return spark.createDataFrame([(i, t, "x", None if t is None else len(t), 1, 2) for i, t in rows],
                                 "doc_id long, text string, source string, n_chars long, key long, words int").repartition(3)


@pytest.fixture
def empty(corpus):
    return corpus.limit(0)
