"""Words and word shingles of many texts at once, as numpy arrays over Arrow's buffers.

A word is a longest run of bytes other than space and 0x09 to 0x0D, so whole UTF-8 characters stay together.
Hashes depend on the bytes alone: every worker and every run gets the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base to the powers 0 to n - 1, modulo 2 to the 64."""
    if len(_powers.get(name, ())) < n:
        factors = np.full(max(n, SLICE_BYTES), base, np.uint64)
        factors[0] = 1
        _powers[name] = np.multiply.accumulate(factors)
    return _powers[name][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number turned into one whose bits all depend on all of its bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of rows first to last - 1 of a batch, in order; starts and ends are byte places in ``data``."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.last - self.first)

    def begins(self) -> np.ndarray:
        """Index of each row's first word, and at the end the number of words."""
        return np.concatenate([[0], np.cumsum(self.counts())])

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of each run of ``width`` words within a row."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.row[:n] == self.row[width - 1 :])
        return at, combined(self.hashes, width)[at]

    def text(self, start: int, end: int) -> str:
        """The words from index start to end - 1, joined by one space."""
        data = self.data
        return b" ".join([data[a:b].tobytes() for a, b in zip(self.starts[start:end], self.ends[start:end])]).decode()


def combined(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every ``width`` hashes in a row."""
    n = len(hashes) - width + 1
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(_power("mix", np.uint64(0xD6E8FEB86659FD93), width)):
        total += hashes[i : i + n] * factor
    return mixed(total)


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to before its end."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("base", BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power("inverse", INVERSE, len(data) + 1)[starts])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array (null: none) and where each row begins, and the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _split(data: np.ndarray, offsets: np.ndarray, first: int, lower: bool) -> Words:
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty_like(inside)
    before[1:], before[:1] = inside[:-1], False
    before[heads] = False
    after = np.empty_like(inside)
    after[:-1], after[-1:] = inside[1:], False
    after[heads[heads > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    return Words(first, first + len(offsets) - 1, data, starts, ends, row, spans(data, starts, ends))


def split(texts: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of an Arrow string array, by slices of about SLICE_BYTES bytes; a null has none."""
    if not len(texts):
        return
    data, offsets = buffers(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1)
        yield _split(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, lower)
        first = last


def sieve(hashes: DataFrame, bits: int) -> np.ndarray:
    """Of so many bits (a power of two, 64 at least) those on which one of the hashes falls (column ``h``, long).

    A bounded sum of any number of hashes, made by the tasks that have them: tells which others cannot be among them.
    """
    place = F.pmod("h", F.lit(bits))
    words = hashes.select((place / 64).cast("int").alias("i"), F.expr(f"shiftleft(1L, cast(pmod(h, {bits}) % 64 as int))").alias("b"))
    table = words.groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[np.asarray(table.column("i"), np.int64)] = np.asarray(table.column("b"), np.int64).view(np.uint64)
    return out


def sifted(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes (as long) may be among those of a sieve."""
    place = hashes & np.int64(64 * len(bits) - 1)
    return (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
