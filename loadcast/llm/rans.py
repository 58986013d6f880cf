"""Static range asymmetric numeral codec for token ids (NumPy, no Spark).

A *segment* is self-contained: one frequency table, shared by all its blocks,
a directory of its documents, and independent blocks of interleaved lanes.
Token ``p`` of a block belongs to lane ``p % lanes`` at step ``p // lanes``;
the lanes of a block share one stream of 32-bit words.  Every ``checkpoint``
steps the lane states and the place in the stream are stored, with a CRC-32 of
what follows, so each such *section* can be checked and decoded by itself, and
all sections of a segment are decoded side by side.

State: 64 bits in [2^31, 2^63), renormalised by 32-bit words; frequencies add up
to 2^scale, every token that occurs has at least 1.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LCT1"
LANES = 64
BLOCK = 1 << 16      # tokens of a block, about
CHECKPOINT = 256     # steps between stored states
LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_HEAD = "<4sqqqqqqIIIIIIII"
_HEAD_SIZE = struct.calcsize(_HEAD)


class Damaged(ValueError):
    """A segment whose bytes do not match their checksums."""


def scaled(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Frequencies that add up to a power of two, none below 1."""
    scale = max(12, int(len(counts)).bit_length() + 2)
    total, left = int(counts.sum()), 1 << scale
    freq = np.maximum(1, counts.astype(np.float64) * (left / total)).astype(np.int64)
    over = int(freq.sum()) - left
    order = np.argsort(-counts, kind="stable")
    if over < 0:
        freq[order[0]] -= over
    for k in order:  # take from the most frequent first, never below 1
        if over <= 0:
            break
        cut = min(over, int(freq[k]) // 2)
        freq[k] -= cut
        over -= cut
    return freq, scale


def _packed(*arrays: np.ndarray) -> bytes:
    return zlib.compress(b"".join(a.tobytes() for a in arrays), 1)


def encode(ids: np.ndarray, docs: list[int | None], counts: np.ndarray, *, part: int = 0, seq: int = 0,
           lanes: int = LANES, block: int = BLOCK, checkpoint: int = CHECKPOINT) -> bytes:
    """One segment: ``ids`` (uint32) of consecutive documents, whose ids and
    token counts are ``docs`` and ``counts``."""
    n = len(ids)
    if not n:
        raise ValueError("a segment holds at least one token")
    times = np.bincount(ids)
    symbols = np.flatnonzero(times)
    code = (np.cumsum(times > 0) - 1)[ids]
    freq, scale = scaled(times[symbols])
    blocks = -(-n // block)
    steps = -(-n // (blocks * lanes))
    grid = np.full(blocks * steps * lanes, int(np.argmax(freq)), np.int64)  # the rest is the cheapest token
    grid[:n] = code
    grid = np.ascontiguousarray(grid.reshape(blocks, steps, lanes).transpose(1, 0, 2))
    f_of = freq.astype(np.uint64)
    c_of = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    limit_of = f_of << np.uint64(63 - scale)
    sections = -(-steps // checkpoint)
    states = np.empty((blocks, sections, lanes), np.uint64)
    taken = np.zeros((steps, blocks), np.int64)
    words: list[np.ndarray] = []
    x = np.full((blocks, lanes), LOW, np.uint64)
    shift = np.uint64(scale)
    for t in range(steps - 1, -1, -1):
        s = grid[t]
        f = f_of[s]
        full = x >= limit_of[s]
        words.append(x[full].astype(np.uint32))
        taken[t] = full.sum(axis=1)
        x = np.where(full, x >> _WORD, x)
        q = x // f
        x = (q << shift) + (x - q * f) + c_of[s]
        if t % checkpoint == 0:
            states[:, t // checkpoint, :] = x
    # Words in the order in which a decoder of each block takes them.
    words.reverse()
    owner = np.repeat(np.tile(np.arange(blocks, dtype=np.min_scalar_type(blocks)), steps), taken.ravel())
    stream = np.concatenate(words)[np.argsort(owner, kind="stable")]
    offsets = np.concatenate(([0], np.cumsum(taken.sum(axis=0))))
    before = np.concatenate((np.zeros((1, blocks), np.int64), np.cumsum(taken, axis=0)))[:-1]
    places = offsets[:-1, None] + before[::checkpoint].T
    ends = np.append(places.ravel()[1:], len(stream))
    crcs = np.array([zlib.crc32(stream[a:b].tobytes(), zlib.crc32(st.tobytes())) for a, b, st in
                     zip(places.ravel().tolist(), ends.tolist(), states.reshape(-1, lanes), strict=True)], "<u4")
    table = _packed(np.diff(symbols.astype(np.int64), prepend=0).astype("<u4"), freq.astype("<u4"))
    known = np.array([d is not None for d in docs], np.uint8)
    directory = _packed(known, np.array([d or 0 for d in docs], "<i8"), np.asarray(counts, "<i8"))
    meta = table + directory + places.astype("<i8").tobytes() + crcs.tobytes()
    body = states.astype("<u8").tobytes() + stream.astype("<u4").tobytes()
    head = struct.pack(_HEAD, MAGIC, _HEAD_SIZE + 4 + len(meta) + len(body), part, seq, len(docs), n, len(stream), len(symbols),
                      scale, lanes, steps, checkpoint, blocks, len(table), len(directory))
    return head + struct.pack("<I", zlib.crc32(meta, zlib.crc32(head))) + meta + body


class Segment:
    """A segment read from ``data`` at ``at``; its header, table and directory
    are checked at once, its sections when they are decoded."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        view = memoryview(data)
        if len(view) - at < _HEAD_SIZE + 4:
            raise Damaged("the segment ends within its header")
        (magic, self.size, self.part, self.seq, self.n_docs, self.n, n_words, n_symbols, self.scale, self.lanes, self.steps,
         self.checkpoint, self.blocks, table_len, dir_len) = struct.unpack_from(_HEAD, view, at)
        if magic != MAGIC or not 0 < self.size <= len(view) - at:
            raise Damaged("no segment starts here")
        self.sections = -(-self.steps // self.checkpoint)
        pos, cells = at + _HEAD_SIZE + 4, self.blocks * self.sections
        end = pos + table_len + dir_len + 12 * cells
        if end > at + self.size or struct.unpack_from("<I", view, pos - 4)[0] != zlib.crc32(view[pos:end], zlib.crc32(view[at:pos - 4])):
            raise Damaged("header checksum differs")
        table = np.frombuffer(zlib.decompress(view[pos:pos + table_len]), "<u4")
        self.symbols = np.cumsum(table[:n_symbols], dtype=np.uint32)
        self.freq = table[n_symbols:].astype(np.uint64)
        raw = zlib.decompress(view[pos + table_len:pos + table_len + dir_len])
        d, rest = self.n_docs, np.frombuffer(raw, "<i8", offset=self.n_docs)
        self.doc_ids = [i if k else None for i, k in zip(rest[:d].tolist(), raw[:d], strict=True)]
        self.counts = rest[d:]
        pos += table_len + dir_len
        self.places = np.frombuffer(view, "<i8", cells, pos)
        self.crcs = np.frombuffer(view, "<u4", cells, pos + 8 * cells)
        self.states = np.frombuffer(view, "<u8", cells * self.lanes, end).reshape(cells, self.lanes)
        self.stream = np.frombuffer(view, "<u4", n_words, end + 8 * cells * self.lanes)

    def _sections(self, chosen: np.ndarray) -> np.ndarray:
        """Symbol numbers of the chosen sections: (section, step, lane)."""
        ends = np.append(self.places[1:], len(self.stream))
        for c in chosen.tolist():
            own = self.stream[self.places[c]:ends[c]].tobytes()
            if zlib.crc32(own, zlib.crc32(self.states[c].tobytes())) != self.crcs[c]:
                raise Damaged(f"section {c} of segment ({self.part}, {self.seq}) is damaged")
        last = (chosen + 1) % self.sections == 0
        order = np.argsort(last, kind="stable")  # whole sections first, then those that end a block
        chosen, whole = chosen[order], int((~last).sum())
        rest = self.steps - (self.sections - 1) * self.checkpoint
        bias = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        mask, shift = np.uint64((1 << self.scale) - 1), np.uint64(self.scale)
        x, pos = self.states[chosen], self.places[chosen]
        stream = np.append(self.stream, np.uint32(0))
        out = np.zeros((len(chosen), self.checkpoint, self.lanes), np.uint32)
        for t in range(self.checkpoint if whole else rest):
            if t == rest:
                x, pos = x[:whole], pos[:whole]
            slot = x & mask
            s = symbol[slot]
            out[:len(x), t, :] = s
            x = self.freq[s] * (x >> shift) + slot - bias[s]
            low = x < LOW
            at = pos[:, None] + np.cumsum(low, axis=1) - 1
            x[low] = (x[low] << _WORD) | stream[at[low]]
            pos = pos + low.sum(axis=1)
        back = np.empty_like(out)
        back[order] = out
        return back

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Token ids [start, stop); only the sections that hold them are decoded."""
        stop = self.n if stop is None else min(stop, self.n)
        if start >= stop:
            return np.zeros(0, "<u4")
        per_block, per_section = self.steps * self.lanes, self.checkpoint * self.lanes
        first, last = ((p // per_block) * self.sections + (p % per_block) // per_section for p in (start, stop - 1))
        chosen = np.arange(first, last + 1)
        found = self._sections(chosen).reshape(len(chosen), per_section)
        ends_block = (chosen + 1) % self.sections == 0
        keep = np.where(ends_block, per_block - (self.sections - 1) * per_section, per_section)
        flat = found[np.arange(per_section)[None, :] < keep[:, None]]
        origin = (first // self.sections) * per_block + (first % self.sections) * per_section
        return self.symbols[flat[start - origin:stop - origin]].astype("<u4")


def segments(data: bytes) -> list[Segment]:
    """Segments of a file; each is followed by one line feed."""
    out, at = [], 0
    while at < len(data):
        out.append(Segment(data, at))
        at += out[-1].size
        if data[at:at + 1] != b"\n":
            raise Damaged("a segment is not followed by its end mark")
        at += 1
    return out
