"""Token ids of texts by a public tokenizer file.

The tokenizer lower-cases, cuts a text at white space and into runs of letters, single digits, runs of other signs and
contractions, and merges bytes within each. Texts of ASCII and Latin letters are cut by numpy, a batch at a time, and merged
by tiktoken from the same vocabulary; all others go through the tokenizer, word by word, with a cache. Both give its ids.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from salesdq.llm.words import LOWER, buffers, spans

TOKENIZER = "word_bpe_49k.json"
CACHE_WORDS = 300_000
SLICE_BYTES = 1 << 18
GAPS = "\t\n\v\f\r"
#: Stands behind each piece, for the mark that ends a word; texts that hold it are left to the tokenizer.
END = 0x01
SPACE, LETTER, DIGIT, SIGN = range(4)
CLASS = np.full(256, SIGN, np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = SPACE
CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
CLASS[48:58] = DIGIT
CONTRACTION = re.compile(rb"'(?:s|t|re|ve|m|ll|d)")


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def special(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows hold anything but ASCII and the letters from U+00C0 to U+00FF, or what may begin a special token."""
    before = np.zeros_like(data)
    before[1:] = data[:-1]
    letter = before == 0xC3
    bad = (data >= 0x80) & (data != 0xC3) & ~letter
    bad |= letter & ((data == 0x97) | (data == 0xB7))
    bad |= (data == END) | ((data == 0x7C) & (before == 0x3C))
    rows = np.zeros(len(offsets) - 1, bool)
    rows[np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1] = True
    return rows


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes without white space, END behind each piece; where pieces begin; the number of pieces by row."""
    data = LOWER[data]
    after_c3 = np.flatnonzero(data[:-1] == 0xC3) + 1
    data[after_c3[data[after_c3] < 0x9F]] += 0x20
    kind = CLASS[data]
    begin = np.empty(len(data), bool)
    begin[:1], begin[1:] = True, (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    begin[offsets[:-1][offsets[:-1] < len(data)]] = True
    if (data == 0x27).any():
        row_ends = offsets[1:]
        for m in CONTRACTION.finditer(data.tobytes()):
            a, b = m.span()
            if begin[a] and b <= row_ends[np.searchsorted(row_ends, a, side="right")]:
                begin[a + 1 : b] = False
                begin[b : b + 1] = True
    inside = np.flatnonzero(kind != SPACE)
    begins = begin[inside]
    number = np.cumsum(begins)  # pieces begun so far
    place = np.arange(len(inside)) + number - 1
    out = np.full(len(inside) + (int(number[-1]) if len(inside) else 0), END, np.uint8)
    out[place] = data[inside]
    rows = np.searchsorted(offsets, inside[begins], side="right") - 1
    return out, place[begins], np.bincount(rows, minlength=len(offsets) - 1)


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers from first[i] to first[i] + size[i] - 1, one i after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


class Memo:
    """Ids by the hash of a piece, in arrays: an open table of 64-bit keys, and a pool of ids."""

    BITS, PROBES = 20, 8

    def __init__(self):
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.first = np.zeros(1 << self.BITS, np.uint32)  # places in the pool: a fresh table comes long before it has 2^32 ids
        self.size = np.zeros(1 << self.BITS, np.uint32)
        self.pool, self.used, self.kept = np.zeros(1 << 16, np.uint32), 0, 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, or -1."""
        slot = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        out, open_ = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for _ in range(self.PROBES):
            there = self.keys[slot]
            hit = there == hashes[open_]
            out[open_[hit]] = slot[hit]
            on = ~hit & (there != 0)
            open_, slot = open_[on], (slot[on] + 1) & ((1 << self.BITS) - 1)
        return out

    def add(self, hashes: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        """Keep new, distinct hashes; those that find no slot are left out."""
        slot = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        open_ = np.arange(len(hashes))
        for _ in range(self.PROBES):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[open_[free]]
            got = self.keys[slot] == hashes[open_]
            self.first[slot[got]], self.size[slot[got]] = first[open_[got]], size[open_[got]]
            open_, slot = open_[~got], (slot[~got] + 1) & ((1 << self.BITS) - 1)
        self.kept += len(hashes) - len(open_)

    def extend(self, ids: np.ndarray) -> int:
        """Put ids into the pool; their place."""
        at, self.used = self.used, self.used + len(ids)
        while self.used > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[at : self.used] = ids
        return at


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, with an end id behind each text."""

    def __init__(self, path: str, end_id: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = [] if end_id is None else [end_id]
        self.words: dict[str, list[int]] = {}
        self.memo = Memo()
        self.merger, self.last = self._merger()

    def _merger(self):
        """The vocabulary as ranks, END in place of the mark that ends a word; and which ids end a word.

        Merging the adjacent pair of the lowest id is what the tokenizer does, as ids count its merges in order.
        """
        import tiktoken

        byte = {c: b for b, c in enumerate(byte_alphabet())}
        ranks, last = {}, np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, rank in self.tokenizer.get_vocab(with_added_tokens=False).items():
            body = token.removesuffix("</w>")
            if all(c in byte for c in body):
                last[rank] = body != token
                ranks[bytes(byte[c] for c in body) + bytes([END]) * (body != token)] = rank
        pattern = f"[^{chr(END)}]+{chr(END)}"
        return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), last

    def _cached(self, text: str) -> list[int]:
        for c in GAPS:
            text = text.replace(c, " ")
        words = text.split(" ")
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        missing = list(set(words).difference(self.words))
        found = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        self.words.update((w, x.ids) for w, x in zip(missing, found))
        return [i for w in words for i in self.words[w]]

    def _merged(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        marked, starts, counts = pieces(data, offsets)
        if not len(starts):
            return [np.zeros(0, np.uint32)] * len(counts)
        if self.memo.kept > 1 << (Memo.BITS - 1):
            self.memo = Memo()
        memo, sizes = self.memo, np.diff(np.append(starts, len(marked)))
        hashes = spans(marked, starts, starts + sizes)
        slot = memo.find(hashes)
        first, size = memo.first[slot].astype(np.int64), memo.size[slot].astype(np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            distinct, some, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            some = new[some]
            unknown = marked[ranges(starts[some], sizes[some])].tobytes().decode()
            ids = self.merger.encode_to_numpy(unknown, allowed_special=set(), disallowed_special=())
            ends = np.flatnonzero(self.last[ids]) + 1
            lengths = np.diff(ends, prepend=0)
            places = memo.extend(ids) + ends - lengths
            memo.add(distinct, places, lengths)
            first[new], size[new] = places[which], lengths[which]
        ids = memo.pool[ranges(first, size)]
        cuts = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)]
        return np.split(ids, cuts[:-1])

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (null: none)."""
        if not len(texts):
            return []
        data, offsets = buffers(texts)
        odd = special(data, offsets)
        if odd.any():
            plain = pc.if_else(pa.array(odd), "", texts)
            data, offsets = buffers(plain)
        found = self._merged(data, offsets)
        for i in np.flatnonzero(odd):
            found[i] = self._cached(texts[int(i)].as_py())
        return [np.append(x, self.end).astype("<u4").tobytes() for x in found]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, end_id: int | None) -> Encoder:
    """One encoder for each worker and file."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def batches(batch: pa.RecordBatch, column: str):
    """Slices of a batch whose texts have about SLICE_BYTES bytes."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
    first = 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield batch.slice(first, last - first)
        first = last
