"""Declaring a report together with the row order it is presented in."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# a column name, '-name' for descending, or a function giving a sort expression
SortSpec = str | Callable[[], Column]


def _sort_key(spec: SortSpec) -> Column:
    if callable(spec):
        return spec()
    # NULL sorts lowest, which is Spark's default in both directions
    return F.desc(spec[1:]) if spec.startswith("-") else F.asc(spec)


def _conformed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """``df`` with the caller's columns under the names a report expects; ``names`` maps these to the caller's.

    A column that merely happens to have an expected name gives way.
    """
    wanted = {own.lower(): expected for expected, own in names.items()}
    missing = set(wanted) - {c.lower() for c in df.columns}
    if missing:
        raise ValueError(f"no such columns: {', '.join(sorted(missing))}")
    taken = {expected.lower() for expected in names}
    kept = [c for c in df.columns if c.lower() in wanted or c.lower() not in taken]
    return df.select(*[df[c].alias(wanted.get(c.lower(), c)) for c in kept])


def report(*order: SortSpec, settle: bool = False) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Mark a function as a report whose result is sorted by ``order``.

    Every report takes ``ordered=False`` to leave the final sort out, for callers
    that go on to write or join a large result. Listings end their order in an
    id, so that the range partitioning behind the sort can split equal leading
    values over many tasks. ``settle`` is for a sort that would stand on a scan: its
    rows are exchanged once before it, so that sampling them does not scan again.

    Every report also takes ``columns``: for a table, by the name of its argument, the
    caller's names of columns, as in ``{"invoices": {"InvoiceDate": "ordered_at"}}``. That is a projection which
    the scan absorbs.
    """

    def decorate(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        takes = inspect.signature(build)

        @functools.wraps(build)
        def run(*args, ordered: bool = True, columns: Mapping[str, Mapping[str, str]] | None = None, **kwargs) -> DataFrame:
            if columns:
                given = takes.bind(*args, **kwargs)
                for table, names in columns.items():
                    if not isinstance(given.arguments.get(table), DataFrame):
                        raise ValueError(f"{build.__name__} takes no table {table!r}")
                    given.arguments[table] = _conformed(given.arguments[table], names)
                args, kwargs = given.args, given.kwargs
            result = build(*args, **kwargs)
            if ordered and order:
                if settle:
                    result = result.repartition(F.xxhash64(*result.columns))
                result = result.orderBy(*[_sort_key(spec) for spec in order])
            return result

        return run

    return decorate
