"""Interpolated modified Kneser-Ney over word trigrams whose tables grow with the text.

Words are runs of letters, marks and digits as they stand; other marks, and
characters of scripts written without spaces, are words of their own.  Words
travel as 64-bit hashes; up to ``SHORT`` of the most frequent have their rank for
a code instead, which takes fewer bytes and changes no result.  No vocabulary is
fixed, and nothing of the counts but that code table is collected or broadcast.

A trigram (u, v, w), its context (u, v), its bigram (v, w) and that one's context
(v) share the middle word, so all of them are dealt by v into shards and met
there in one exchange.  Tasks send one packed row per block of text and shard,
counted grams already summed: the distinct words of the row once, grams as places
among them, all compressed.  A middle word that is frequent enough to fill a
shard has several, chosen by u; its contexts and trigrams stay whole, its bigrams
(sums over these shards) are given to each.  What is still open after the shard,
an unseen bigram, meets the table of words in a second exchange, packed likewise.

Shards are worked off in ``SLICES`` parts one after the other (in ``PASSES`` when
trigrams are only counted), whose files are deleted, so what is on disk at a time
is a part of the n-grams at every size.  The most frequent words are dealt to the
parts by their counts, so that these are alike.  Texts are cut into words once and
stored as blocks of places among their words, of half the size of the input; each
part reads these again, which costs less than storing the grams.

Defined results: a text without words has no row; without any counted text
every word has probability 1.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm.common import discard, give_back, in_small_batches, kept, n_blocks, shared, stored, work_dir, written

SLICES = 12
PASSES = 2  # over the counted text
SHORT = 1 << 18  # words with a short code (2 MB broadcast)
PINNED = 1000  # of them, dealt to slices by their counts
SHARD_WORDS = 1_500_000
COUNTED_WORDS = 700_000  # of a shard whose trigrams are only counted
LEAST_SHARDS = 12
MOST_PARTS = 64  # shards of one middle word
FREQUENT = 256  # a word with one in so many of all words may have several shards
CHUNK_CHARS = 4_000_000
PIECE_CHARS = 500_000  # cut into words together
_ALONE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}"
SPACE, RUN, ALONE = 0, 1, 2
SENT = 500_000  # bigrams, or open words, that a task sends together
BATCH_BYTES = 8_000_000  # packed rows that a task takes at a time
_PACKED = "shard int, kind int, data binary"
_SCORES = "doc long, h double, n long"
_COUNTED, _BIGRAMS, _ASKED, _BOTH = 0, 1, 2, 3  # of asked grams, those of marked texts are counted as well
_WORDS, _OPEN, _SUMS = 0, 1, 2


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What is taken off counts of 0, 1, 2 and more, from the counts of counts."""
    y = n1 / max(1, n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / max(1, n1), 2 - 3 * y * n3 / max(1, n2), 3 - 4 * y * n4 / max(1, n3)
    return [0.0, *(x if 0 < x < k else k / 2 for k, x in enumerate(raw, 1))]


def _classes() -> np.ndarray:
    table = np.full(0x110000, ALONE, np.uint8)
    for first, last in ((0, 0xD800), (0xE000, 0x110000)):
        chars = "".join(map(chr, range(first, last)))
        for kind, pattern in ((RUN, r"[\p{L}\p{M}\p{N}]+"), (ALONE, rf"[{_ALONE}]+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, chars):
                table[first + m.start():first + m.end()] = kind
    return table


def _mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return _mix(_mix(x + np.uint64(1)) + y)


_BASE = 0x9E3779B97F4A7C15 - 2  # odd, so its powers can be undone


def _powers(base: int, n: int) -> np.ndarray:
    row = np.full(n, base, np.uint64)
    row[0] = 1
    return np.multiply.accumulate(row)


def _coding() -> tuple[np.ndarray, np.ndarray]:
    """Class and scattered number of every character; 0 for spaces."""
    kinds = _classes()
    numbers = _mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    numbers[kinds == SPACE] = 0
    return kinds, numbers


def word_codes(texts: list[str], block: int = 50_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and which text each stands in.

    A word's hash is the sum of its characters' numbers times powers of an odd
    base, divided by the power at its start, scattered."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    classes, numbers = kept("word-coding", _coding)
    kinds = classes[points]
    run = kinds == RUN
    starts = kinds != SPACE
    starts[1:] &= ~(run[1:] & run[:-1])
    starts = np.flatnonzero(starts)
    codes = np.empty(len(starts), np.uint64)
    ends = np.append(starts[block::block], len(points))
    longest = int((ends - starts[::block]).max()) if len(starts) else 1
    up, down = (kept("word-powers", lambda: (_powers(_BASE, 1 << 20), _powers(pow(_BASE, -1, 1 << 64), 1 << 20))) if longest <= 1 << 20
                else (_powers(_BASE, longest), _powers(pow(_BASE, -1, 1 << 64), longest)))
    for k, hi in zip(range(0, len(starts), block), ends, strict=True):
        at = starts[k:k + block]
        lo = at[0]
        at = at - lo
        codes[k:k + block] = _mix(np.add.reduceat(numbers[points[lo:hi]] * up[:hi - lo], at) * down[at])
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    return codes, np.repeat(np.arange(len(texts)), np.diff(np.append(np.searchsorted(starts, firsts), len(starts))))


def _pieces(texts: list[str]) -> Iterator[list[str]]:
    lo, size = 0, 0
    for hi, t in enumerate(texts, 1):
        size += len(t)
        if size >= PIECE_CHARS or hi == len(texts):
            yield texts[lo:hi]
            lo, size = hi, 0


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values as they first appear, and the values as places among them."""
    found = pa.array(values).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def _short(words: np.ndarray, table: np.ndarray | None) -> np.ndarray:
    """Codes of words: their place in ``table`` (from 1), or the hash they have."""
    if table is None or not table.size:
        return words
    known, ranks = table
    at = np.searchsorted(known, words).clip(max=len(known) - 1)
    return np.where(known[at] == words, ranks[at], words)


def _cut(texts: list[str], table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the distinct words, sorted, all words in a row as places among
    them, and where each text ends in it; the first, 0, stands twice before a text."""
    codes, of, n = [np.zeros(1, np.uint64)], [], 0
    for some in _pieces(texts):
        c, o = word_codes(some)
        codes.append(c)
        of.append((o + n).astype(np.int32))
        n += len(some)
    words, w = _coded(np.concatenate(codes))
    del codes
    words = _short(words, table)
    order = np.argsort(words)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    words, w, of = words[order], rank[w[1:]], np.concatenate(of) if of else np.empty(0, np.int32)
    row = np.zeros(len(w) + 2 * len(texts), np.uint16 if len(words) <= 1 << 16 else np.uint32)
    row[np.arange(len(w), dtype=np.int32) + 2 * (of + 1)] = w
    return words, row, np.cumsum(np.bincount(of, minlength=len(texts)) + 2)


def trigrams(texts: list[str], table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the distinct words, sorted, and ``(u, v, w, text)`` of every word
    as places among them."""
    words, row, ends = _cut(texts, table)
    at = np.flatnonzero(row)
    return words, row[at - 2], row[at - 1], row[at], np.searchsorted(ends, at, "right")


def _keyed(*columns: np.ndarray) -> tuple[np.ndarray | None, list[int]]:
    """One number a row that sorts like the columns, if 64 bits are enough for
    it, and the bits of each column."""
    bits = [int(c.max()).bit_length() if len(c) else 0 for c in columns]
    if sum(bits) > 63:
        return None, bits
    key = np.zeros(len(columns[0]), np.uint64)
    for c, n in zip(columns, bits, strict=True):
        key = (key << np.uint64(n)) | c.astype(np.uint64)
    return key, bits


def _order(*columns: np.ndarray) -> np.ndarray:
    """Stable order by columns of numbers, none below 0, the first one foremost."""
    key, bits = _keyed(*columns, np.arange(len(columns[0])))
    if key is None:
        return np.lexsort(columns[::-1])
    key.sort()
    return (key & np.uint64((1 << bits[-1]) - 1)).astype(np.int64)


def _distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of places, sorted, and how often each is there."""
    key, bits = _keyed(*columns)
    if key is None:
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new = _changes(*columns)
        return [c[new] for c in columns], np.diff(np.append(new, len(order)))
    key.sort()
    new = _changes(key)
    times, key, out = np.diff(np.append(new, len(key))), key[new], []
    for n in reversed(bits):
        out.append((key & np.uint64((1 << n) - 1)).astype(np.int32))
        key = key >> np.uint64(n)
    return out[::-1], times


def _compact(size: int, *columns: np.ndarray) -> list[np.ndarray]:
    """Which of ``size`` places the columns hold, and the columns as places among these."""
    if 16 * sum(map(len, columns)) < size:
        used, at = np.unique(np.concatenate(columns), return_inverse=True)
        return [used.astype(np.int64), *np.split(at.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32), np.cumsum([len(c) for c in columns[:-1]]))]
    there = np.zeros(size, bool)
    for c in columns:
        there[c] = True
    used = np.flatnonzero(there)
    rank = np.empty(size, np.uint16 if len(used) <= 1 << 16 else np.uint32)
    rank[used] = np.arange(len(used))
    return [used, *(rank[c] for c in columns)]


def _steps(words: np.ndarray) -> np.ndarray:
    """Sorted codes as differences, which take fewer bytes; sums give them back."""
    return np.diff(words, prepend=words.dtype.type(0))


def _planes(column: np.ndarray) -> Iterator[bytes]:
    bits = column.view(f"u{column.itemsize}")
    for k in range(0, 8 * column.itemsize, 8):
        yield (bits >> bits.dtype.type(k)).astype(np.uint8).tobytes()


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers, compressed behind their types and lengths; first bytes
    of all numbers stand together, and so on, which are more alike."""
    raw = b"".join(plane for c in columns for plane in _planes(c))
    head = b"".join(struct.pack("<cQ", c.dtype.char.encode(), len(c)) for c in columns)
    return struct.pack("<BQ", len(columns), len(raw)) + head + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def _unpack(data: bytes) -> list[np.ndarray]:
    n, size = struct.unpack_from("<BQ", data)
    raw = pa.decompress(data[9 + 9 * n:], size, "zstd", asbytes=True) if size else b""
    out, at = [], 0
    for k in range(n):
        kind, length = struct.unpack_from("<cQ", data, 9 + 9 * k)
        kind = np.dtype(kind.decode())
        planes = np.frombuffer(raw, np.uint8, length * kind.itemsize, at).reshape(kind.itemsize, length)
        bits = planes[-1].astype(f"u{kind.itemsize}")
        for plane in planes[-2::-1]:  # shifts are faster than turning the planes
            bits <<= bits.dtype.type(8)
            bits |= plane
        out.append(bits.view(kind))
        at += length * kind.itemsize
    return out


def _packed(shard: list[int], kind: int, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array([kind] * len(shard), pa.int32()), pa.array(data, pa.binary())], ["shard", "kind", "data"])


def _runs(column: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last end of every run of equal values."""
    cuts = np.append(_changes(column), len(column))
    return zip(cuts[:-1], cuts[1:], strict=True)


def _gathered(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """Columns of about ``SENT`` rows together."""
    held, size = [], 0
    for b in batches:
        held.append([b.column(k).to_numpy() for k in names])
        size += len(b)
        if size >= SENT:
            yield _joined(held)
            held, size = [], 0
    if size:
        yield _joined(held)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """``(docs, counted, texts)`` of about ``CHUNK_CHARS`` together; without a
    column ``counted`` all are."""
    docs, counted, texts, size = [], [], [], 0
    for b in batches:
        marks = b.column("counted").to_pylist() if "counted" in b.schema.names else [True] * len(b)
        for doc, mark, t in zip(b.column("doc").to_pylist(), marks, b.column("t").to_pylist(), strict=True):
            if t:
                docs.append(doc)
                counted.append(mark)
                texts.append(t.decode("utf-8", "replace"))
                size += len(texts[-1])
            if size >= CHUNK_CHARS:
                yield np.array(docs, np.int64), np.array(counted, np.uint8), texts
                docs, counted, texts, size = [], [], [], 0
                give_back()
    if texts:
        yield np.array(docs, np.int64), np.array(counted, np.uint8), texts
    give_back()


def _no_table() -> None:
    """No word has a short code."""


def coded(docs: DataFrame, table: Callable[[], np.ndarray | None]) -> DataFrame:
    """Packed blocks of ``docs(doc, t)``, or ``(doc, t, counted)``: texts cut into
    words, which ``dealt`` and ``dealing_of`` take in place of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table()
        for ids, counted, texts in _chunks(batches):
            words, row, ends = _cut(texts, known)
            yield pa.RecordBatch.from_arrays([pa.array([_pack(_steps(words), row, _steps(ends), ids, counted)], pa.binary())], ["data"])

    return in_small_batches(docs).mapInArrow(run, "data binary")


def _reader(docs: DataFrame, table: Callable[[], np.ndarray | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, ...]]]:
    """How a task gets ``(words, row, ends, ids, counted)`` from texts or packed blocks."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        known = table()
        for ids, counted, some in _chunks(batches):
            yield *_cut(some, known), ids, counted

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for b in batches:
            for data in b.column("data"):
                words, row, ends, *rest = _unpack(data.as_buffer())
                yield np.cumsum(words, dtype=np.uint64), row, np.cumsum(ends), *rest
        give_back()

    return blocks if "data" in docs.columns else texts


@dataclass
class Dealing:
    """Where a middle word's grams go: a slice, and a shard (or several) of it."""

    shards: int
    frequent: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # sorted
    parts: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    table: Callable[[], np.ndarray | None] = _no_table  # words with short codes, sorted, and the codes
    pinned: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # slices of the first codes

    def slice_of(self, v: np.ndarray) -> np.ndarray:
        slices = _mix(v + np.uint64(7)) % np.uint64(SLICES)
        first = np.flatnonzero(v < len(self.pinned))
        slices[first] = self.pinned[v[first]]
        return slices

    def shards_of(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First shard of every word, and how many it has."""
        parts = np.ones(len(v), np.uint64)
        if len(self.frequent):
            at = np.searchsorted(self.frequent, v).clip(max=len(self.frequent) - 1)
            parts = np.where(self.frequent[at] == v, self.parts[at], parts)
        return _mix(v + np.uint64(7)) // np.uint64(SLICES), parts

    def shard(self, words: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Shards of grams whose words are places in ``words``."""
        first, parts = self.shards_of(words)
        return ((first[v] + _mix(words + np.uint64(11))[u] % parts[v]) % np.uint64(self.shards)).astype(np.int32)


def _coding_of(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``SHORT`` of the most frequent words of ``found(v, n)`` with their
    ranks, sorted by word, and the slices of the first ranks."""
    times = F.least("n", F.lit(100_000)).alias("n")
    least = None
    many = 0
    for r in found.groupBy(times).count().orderBy(F.desc("n")).collect():  # at most 100,000 rows
        many += r["count"]
        if many > SHORT:
            break
        least = r["n"]
    rows = found.filter(F.lit(False) if least is None else F.col("n") >= least).select("v", "n").toArrow()  # at most SHORT rows
    known, n = rows["v"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.lexsort((known, -n))
    known, n = known[order], n[order]
    load, slices = [0] * SLICES, [0]  # 0 is the code of what stands before a text
    for x in n[:PINNED].tolist():
        slices.append(load.index(min(load)))
        load[slices[-1]] += x
    order = np.argsort(known)
    return np.stack([known[order], order.astype(np.uint64) + np.uint64(1)]), np.array(slices, np.uint64)


def dealing_of(docs: DataFrame, like: Dealing | None = None) -> Dealing:
    """Shards for the words of ``docs(doc, t)``, or of their blocks, more for
    frequent middle words.  Codes and slices are those of another dealing,
    ``like``, or made for these, which are then to be counted."""
    read = _reader(docs, like.table if like else _no_table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, row, *_ in read(batches):
            n = np.bincount(row[1:-1][row[2:] > 0], minlength=len(words))
            most = (n >= (max(2, n.sum() / FREQUENT) if like else 2)) & (words > 0)
            yield pa.RecordBatch.from_pydict({"all": [True, *[False] * int(most.sum())], "v": pa.array(np.append(np.uint64(0), words[most]).view(np.int64)),
                                              "n": pa.array(np.append(n.sum(), n[most]).astype(np.int64))})

    counts, path = stored(in_small_batches(docs).mapInArrow(count, "all boolean, v long, n long").groupBy("all", "v").agg(F.sum("n").alias("n")), "word-dealing")
    found = counts.filter(~F.col("all"))
    words = counts.filter("all").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    passes, most_words = (SLICES, SHARD_WORDS) if like else (PASSES, COUNTED_WORDS)
    shards = max(LEAST_SHARDS, n_blocks(words, passes * most_words))
    each = words / (shards * passes)
    most = found.filter(F.col("n") >= max(each, words / FREQUENT)).select("v", "n").collect()  # at most FREQUENT rows
    codes = np.array([r["v"] for r in most], np.int64).view(np.uint64)
    parts = np.array([min(shards, MOST_PARTS, n_blocks(r["n"], each)) for r in most], np.uint64)
    if like:
        table, pinned = like.table, like.pinned
    else:
        short, pinned = _coding_of(found)
        codes, table = _short(codes, short), shared(docs.sparkSession, short)
    discard(docs.sparkSession, path)
    order = np.argsort(codes)
    return Dealing(shards, codes[order], parts[order], table, pinned)


def dealt(docs: DataFrame, plan: Dealing, which: int | list[int], kind: int) -> DataFrame:
    """Packed trigrams of ``docs(doc, t)``, or of their blocks, whose middle word is
    in a slice (or one of several): counted, or with the documents that ask for them."""
    read = _reader(docs, plan.table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, row, ends, ids, counted in read(batches):
            own = np.isin(plan.slice_of(words), which)[row[1:-1]]
            if kind == _COUNTED and not counted.all():
                own &= np.repeat(counted, np.diff(ends, prepend=0))[2:] > 0
            own = np.flatnonzero(own)
            own = own[row[own + 2] > 0]  # what follows is no other text
            u, v, w = row[own], row[own + 1], row[own + 2]
            if kind == _COUNTED:
                (v, w, u), of = _distinct(v, w, u)
                of = of.astype(np.uint32)
            else:
                of = np.searchsorted(ends, own + 2, "right")
            shard = plan.shard(words, u, v)
            order = _order(shard) if kind == _COUNTED else _order(shard, v)
            shard, u, v, w, of = shard[order], u[order], v[order], w[order], of[order]
            to, data = [], []
            for lo, hi in _runs(shard):
                used, *grams = _compact(len(words), u[lo:hi], v[lo:hi], w[lo:hi])
                if kind == _COUNTED:
                    rest = [of[lo:hi]]
                else:
                    asking, at = _compact(len(ids), of[lo:hi])
                    rest = [at, ids[asking], *([counted[asking]] if kind == _BOTH else [])]
                to.append(int(shard[lo]))
                data.append(_pack(_steps(words[used]), *grams, *rest))
            yield _packed(to, kind, data)

    return in_small_batches(docs).mapInArrow(run, _PACKED)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted run of equal rows begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _in_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for b in batches:
        for shard, kind, data in zip(*b.columns, strict=True):
            yield shard.as_py(), kind.as_py(), _unpack(data.as_py())


def _grams_in(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Packed grams with their words again, and what came with them."""
    words, u, v, w, *rest = columns
    words = np.cumsum(words, dtype=np.uint64)
    return [words[u], words[v], words[w], *rest]


def _marked(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Grams of counted texts in a packed row of both kinds, once each."""
    words, u, v, w, at, _, counted = columns
    own = np.flatnonzero(counted[at])
    return [*_grams_in([words, u[own], v[own], w[own]]), np.ones(len(own), np.uint32)]


def _whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[bytes]]]]:
    """Every shard's rows by kind, still packed."""
    now, held = None, None
    for b in batches:
        for shard, kind, data in zip(*b.columns, strict=True):
            if shard.as_py() != now:
                if held:
                    yield now, held
                now, held = shard.as_py(), defaultdict(list)
            held[kind.as_py()].append(data.as_py())
    if held:
        yield now, held


def _joined(rows: list[list[np.ndarray]], columns: int = 4) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [np.empty(0, np.uint64)] * (columns - 1) + [np.empty(0)]


def _tally(batches: Iterator[pa.RecordBatch], plan: Dealing) -> Iterator[pa.RecordBatch]:
    """Counted rows of whole shards -> bigrams with their number of distinct
    words before (``(v, w, c)``, of the kind of their slice), and how many
    trigrams have a count ``w`` of 1 to 4 (rows of kind -1)."""

    def bigrams(rows: list[list[np.ndarray]]) -> pa.RecordBatch:
        u, v, w, x = _joined(rows)
        pair = _pair(v, w)
        _, first, at = np.unique(_pair(pair, u), return_index=True, return_inverse=True)
        times = np.bincount(np.bincount(at, x, len(first)).clip(max=5).astype(int), minlength=6)[1:5]
        _, new, n = np.unique(pair[first], return_index=True, return_counts=True)
        v, w = v[first[new]], w[first[new]]
        return pa.RecordBatch.from_arrays([
            pa.array(np.append(plan.slice_of(v).astype(np.int32), np.full(4, -1, np.int32))),
            pa.array(np.append(v.view(np.int64), np.zeros(4, np.int64))),
            pa.array(np.append(w.view(np.int64), np.arange(1, 5))),
            pa.array(np.append(n, times).astype(np.int64))], ["kind", "v", "w", "c"])

    now, rows = None, []
    for shard, _, columns in _in_shards(batches):
        if shard != now and rows:
            yield bigrams(rows)
            rows = []
        now = shard
        rows.append(_grams_in(columns))
    if rows:
        yield bigrams(rows)
    give_back()


class Keys:
    """Places of scattered numbers among sorted distinct ones: the first bits
    lead to where to begin, from there it is a step or two."""

    def __init__(self, keys: np.ndarray) -> None:
        self.n, self.keys = len(keys), np.append(keys, np.uint64(2**64 - 1))
        bits = max(1, self.n.bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``wanted``, and which of them are there."""
        at = self.first[wanted >> self.shift]
        late = np.flatnonzero(self.keys[at] < wanted)
        while len(late):
            at[late] += 1
            late = late[self.keys[at[late]] < wanted[late]]
        return at, (self.keys[at] == wanted) & (at < self.n)


@dataclass
class Alone:
    """Probability of a word by itself, from the number of distinct words before it."""

    total: int = 0
    kinds: int = 0
    off: list[float] = field(default_factory=lambda: [0.0] * 4)
    taken: float = 0.0

    @property
    def unseen(self) -> float:
        return (self.taken / self.total if self.total else 1.0) / (self.kinds + 1)

    def of(self, c: np.ndarray) -> np.ndarray:
        return (c - np.array(self.off)[np.minimum(c, 3).astype(int)]) / max(1, self.total) + self.unseen


class Shard:
    """Seen trigrams, bigrams and contexts of the middle words of one shard."""

    def __init__(self, counted: list[np.ndarray], bigrams: list[np.ndarray], off2: list[float], off3: list[float], alone: Alone) -> None:
        v, w, c, c1 = bigrams
        p1 = alone.of(c1)
        d = np.array(off2)[np.minimum(c, 3).astype(int)]
        self.middle, at = np.unique(_mix(v), return_inverse=True)
        total = np.bincount(at, c, len(self.middle))
        self.gamma2 = np.bincount(at, d, len(self.middle)) / total
        p2 = (c - d) / total[at] + self.gamma2[at] * p1
        self.pairs, first = np.unique(_pair(v, w), return_index=True)
        self.p2 = p2[first]
        u, v, w, x = counted
        context, pair = _pair(u, v), _pair(v, w)
        self.grams, first, at = np.unique(_pair(context, w), return_index=True, return_inverse=True)
        c = np.bincount(at, x, len(self.grams))
        d = np.array(off3)[np.minimum(c, 3).astype(int)]
        self.contexts, at = np.unique(context[first], return_inverse=True)
        total = np.bincount(at, c, len(self.contexts))
        self.gamma3 = np.bincount(at, d, len(self.contexts)) / total
        low = np.searchsorted(self.pairs, pair[first])  # each of them has been counted
        self.p3 = (c - d) / total[at] + self.gamma3[at] * self.p2[low] if len(low) else np.empty(0)
        self.grams, self.contexts, self.pairs, self.middle = map(Keys, (self.grams, self.contexts, self.pairs, self.middle))

    def score(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities, or weights of the word's own where ``open``."""
        context = _pair(u, v)
        at, seen = self.grams.find(_pair(context, w))
        p = np.ones(len(u))
        p[seen] = self.p3[at[seen]]
        rest = np.flatnonzero(~seen)
        at, known = self.contexts.find(context[rest])
        p[rest[known]] = self.gamma3[at[known]]
        at, seen = self.pairs.find(_pair(v[rest], w[rest]))
        p[rest[seen]] *= self.p2[at[seen]]
        rest = rest[~seen]
        at, known = self.middle.find(_mix(v[rest]))
        p[rest[known]] *= self.gamma2[at[known]]
        unseen = np.zeros(len(u), bool)
        unseen[rest] = True
        return p, unseen


def _scorer(off2: list[float], off3: list[float], alone: Alone, shards: int):
    """Asked rows -> sums by document, and the open words dealt by themselves."""

    def sent(rows: list[list[np.ndarray]], ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        w, at = _joined(rows, 2)
        ids = np.concatenate(ids)
        words, w = np.unique(w, return_inverse=True)
        shard = (_mix(words + np.uint64(13)) % np.uint64(shards)).astype(np.int32)[w]
        order = _order(shard, w)
        shard, w, at = shard[order], w[order], at[order]
        to, data = [], []
        for lo, hi in _runs(shard):
            asking, of = _compact(len(ids), at[lo:hi])
            used, w_at = _compact(len(words), w[lo:hi])
            to.append(int(shard[lo]))
            data.append(_pack(_steps(words[used]), w_at, of, ids[asking]))
        yield _packed(to, _OPEN, data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, size, n_ids = [], [], 0, 0
        for shard, held in _whole_shards(batches):
            counted = [_grams_in(_unpack(x)) for x in held[_COUNTED]] + [_marked(_unpack(x)) for x in held[_BOTH]]
            bigrams = [[np.cumsum(v, dtype=np.uint64), *rest] for v, *rest in map(_unpack, held[_BIGRAMS])]
            model = Shard(_joined(counted), _joined(bigrams), off2, off3, alone)
            del counted, bigrams
            give_back()
            for data in held[_ASKED] + held[_BOTH]:
                u, v, w, x, docs, *_ = _grams_in(_unpack(data))
                p, unseen = model.score(u, v, w)
                yield _packed([shard], _SUMS, [_pack(docs, np.bincount(x, -np.log(p), len(docs)), np.bincount(x, minlength=len(docs)))])
                rows.append([w[unseen], x[unseen] + np.int64(n_ids)])
                ids.append(docs)
                size, n_ids = size + len(rows[-1][0]), n_ids + len(docs)
                if size >= SENT:
                    yield from sent(rows, ids)
                    rows, ids, size, n_ids = [], [], 0, 0
            give_back()
        if size:
            yield from sent(rows, ids)

    return run


def _ender(alone: Alone):
    """Sums by document, and open words that meet the table of words."""

    def added(rows: list[list[np.ndarray]]) -> pa.RecordBatch:
        docs, h, n = _joined(rows, 3)
        ids, at = np.unique(docs, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.bincount(at, h, len(ids)).astype(float)), pa.array(np.bincount(at, n, len(ids)).astype(np.int64))], ["doc", "h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, table, held, rows, size, unseen = None, None, [], [], 0, -np.log(alone.unseen)
        for shard, kind, columns in _in_shards(batches):
            if shard != now:
                now, table, held = shard, None, []
            if kind == _WORDS:
                held.append([np.cumsum(columns[0], dtype=np.uint64), columns[1]])
                continue
            if kind == _OPEN:
                if table is None:
                    w, c = _joined(held, 2)
                    w = _mix(w)
                    order = np.argsort(w)
                    table, held = (Keys(w[order]), -np.log(alone.of(c[order]))), []
                words, at, of, docs = columns
                place, seen = table[0].find(_mix(np.cumsum(words, dtype=np.uint64)))
                h = np.full(len(seen), unseen)
                h[seen] = table[1][place[seen]]
                columns = [docs, np.bincount(of, h[at], len(docs)), np.zeros(len(docs), np.int64)]
            rows.append(columns)
            size += len(columns[0])
            if size >= SENT:
                yield added(rows)
                rows, size = [], 0
        if size:
            yield added(rows)

    return run


@contextmanager
def _bounded(spark: SparkSession):
    """Shuffle files go as soon as the query that wrote them is done; packed rows
    reach a task in batches of bounded bytes."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _by_shard(grams: DataFrame, plan: Dealing) -> DataFrame:
    return in_small_batches(grams.repartitionById(plan.shards, "shard").sortWithinPartitions("shard", "kind"))


class WordModel:
    """Counts of words and bigrams by slice; trigrams are counted when needed."""

    def __init__(self, texts: DataFrame) -> None:
        """From all ``texts`` (one binary column ``t``), or those of ``(doc, t,
        counted)`` that are marked; these texts may be scored without cutting
        them again."""
        self.spark = texts.sparkSession
        counted = texts.filter("counted") if "counted" in texts.columns else texts.select(F.lit(0).cast("long").alias("doc"), "t")
        with _bounded(self.spark):
            self.plan, self.slices, times = dealing_of(counted.select("doc", "t")), {}, np.zeros(4, int)
            self.blocks, path = stored(coded(texts if "counted" in texts.columns else counted, self.plan.table), "word-blocks")
            self.paths = [path]
            for k in range(PASSES):
                part, path = self._counted(list(range(k, SLICES, PASSES)))
                for r in part.filter("kind = -1").collect():  # four rows
                    times[r["w"] - 1] += r["c"]
                self.slices |= {s: (part.filter(F.col("kind") == s).drop("kind"), f"{path}/kind={s}/all") for s in range(k, SLICES, PASSES)}
                self.paths.append(path)
            bigrams = reduce(DataFrame.union, (part for part, _ in self.slices.values()))
            self.off3, self.off2 = discounts(*map(int, times)), _off(bigrams)
            self.words, path = stored(bigrams.groupBy("w").agg(F.count(F.lit(1)).alias("c")), "words")
            self.paths.append(path)
            off1 = _off(self.words)
            d = F.when(F.col("c") == 1, off1[1]).when(F.col("c") == 2, off1[2]).otherwise(off1[3])
            kinds, total, taken = self.words.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum(d), F.lit(0.0))).first()
        self.alone = Alone(total, kinds, off1, taken)

    def _counted(self, which: list[int]) -> tuple[DataFrame, str]:
        """Bigrams of some slices, stored slice by slice, and the folder."""
        plan = self.plan
        found = _by_shard(dealt(self.blocks, plan, which, _COUNTED), plan).mapInArrow(lambda batches: _tally(batches, plan), "kind int, v long, w long, c long")
        counts = found.groupBy("kind", "v", "w").agg(F.sum("c").alias("c")).sortWithinPartitions("kind", "v", "w")  # equal words take next to no room
        path = f"{work_dir(self.spark, 'word-bigrams')}/t"
        counts.write.partitionBy("kind").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(counts.schema).parquet(path), path

    def _bigrams(self, which: int, plan: Dealing) -> DataFrame:
        """Bigrams of a slice with the count of their word, in all shards of
        their middle word."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for v, w, c, c1 in _gathered(batches, ("v", "w", "c", "c1")):
                v, w = v.view(np.uint64), w.view(np.uint64)
                first, parts = plan.shards_of(v)
                row = np.repeat(np.arange(len(v)), parts.astype(int))
                part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts.astype(int)).astype(int)
                shard = ((first[row] + part.astype(np.uint64)) % np.uint64(plan.shards)).astype(np.int32)
                order = np.lexsort((w[row], v[row], shard))
                row, shard = row[order], shard[order]
                some = [row[lo:hi] for lo, hi in _runs(shard)]
                yield _packed([int(shard[lo]) for lo, _ in _runs(shard)], _BIGRAMS, [_pack(_steps(v[r]), w[r], c[r].astype(np.uint32), c1[r].astype(np.uint32)) for r in some])

        return self.slices[which][0].join(self.words.withColumnRenamed("c", "c1"), "w").select("v", "w", "c", "c1").mapInArrow(run, _PACKED)

    def _words(self, plan: Dealing) -> DataFrame:
        """Words with their count, dealt by themselves."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for w, c in _gathered(batches, ("w", "c")):
                w = w.view(np.uint64)
                shard = (_mix(w + np.uint64(13)) % np.uint64(plan.shards)).astype(np.int32)
                order = np.lexsort((w, shard))
                shard, w, c = shard[order], w[order], c[order].astype(np.uint32)
                cuts = list(_runs(shard))
                yield _packed([int(shard[lo]) for lo, _ in cuts], _WORDS, [_pack(_steps(w[lo:hi]), c[lo:hi]) for lo, hi in cuts])

        return self.words.mapInArrow(run, _PACKED)

    def score(self, docs: DataFrame | None = None, last: bool = False) -> DataFrame:
        """``docs(doc, t)``, or the texts of the model itself -> ``(doc, h)``: mean
        negative log-probability of a word.  The ``last`` call deletes bigrams as
        soon as they are used."""
        parts = []
        with _bounded(self.spark):
            asked, path = (self.blocks, None) if docs is None else stored(coded(docs, self.plan.table), "asked-blocks")
            plan = dealing_of(asked, self.plan)
            for s in reversed(range(SLICES)):  # the first one has the most frequent word
                rows = self._bigrams(s, plan).union(dealt(asked, plan, s, _BOTH if docs is None else _ASKED))
                if docs is not None:
                    rows = rows.union(dealt(self.blocks, plan, s, _COUNTED))
                found = _by_shard(rows, plan).mapInArrow(_scorer(self.off2, self.off3, self.alone, plan.shards), _PACKED)
                ended = _by_shard(found.union(self._words(plan)), plan).mapInArrow(_ender(self.alone), _SCORES)
                parts.append(stored(ended.groupBy("doc").agg(F.sum("h").alias("h"), F.sum("n").alias("n")), f"word-scores-{s}"))
                if last:
                    discard(self.spark, self.slices[s][1])
            if path:
                discard(self.spark, path)
            whole = parts[0][0]
            for part, _ in parts[1:]:
                whole = whole.union(part)
            result = written(whole.groupBy("doc").agg((F.sum("h") / F.sum("n")).alias("h")), "word-scores")
        for _, path in parts:
            discard(self.spark, path)
        return result

    def forget(self) -> None:
        """Delete the stored counts."""
        for path in self.paths:
            discard(self.spark, path)


def _off(counts: DataFrame) -> list[float]:
    return discounts(*counts.agg(*[F.coalesce(F.sum((F.col("c") == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4)]).first())
