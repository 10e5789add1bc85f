"""Comparing a Spark result with DuckDB's, by value and as multisets."""

from __future__ import annotations

from collections import Counter


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row[n] for n in names) for row in df.collect())


def duck_rows(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, Counter(tuple(row[i] for i in order) for row in result.fetchall())


def assert_same(df, connection, sql, label=""):
    got_names, got = spark_rows(df)
    want_names, want = duck_rows(connection, sql)
    assert got_names == want_names, f"{label}: {got_names} != {want_names}"
    extra, missing = got - want, want - got
    assert not extra and not missing, (
        f"{label}: {sum(extra.values())} unexpected, {sum(missing.values())} missing of {sum(want.values())};"
        f" e.g. {list(extra)[:2]} / {list(missing)[:2]}"
    )
    return sum(got.values())
