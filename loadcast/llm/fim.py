"""Fill-in-middle transformation with content-defined chunk memoization.

A text is cut into lines; two cuts, drawn from a hash of the document's id,
part it in prefix, middle and suffix, which are written in one of two orders
with a mark before each part.

Counting lines and code points is done once per chunk, not once per text: a
rolling hash over 32 bytes ends a chunk where its leading bits are zero (so the
same passage gives the same chunks wherever it stands), and a worker keeps the
summaries of the chunks it has met, found by content (the hash only sets
boundaries; a kept summary is used only if the bytes are equal).  A summary
holds the chunk's line feeds and code points, the place of every line feed, and
the bytes at its two edges, so marks that straddle chunks are seen when
summaries are combined.  Sums of chunk counts locate the chunk of a cut, the
kept places the byte in it.

Defined results: null text is empty, an empty text or one that holds a mark is
left as it is (``plain``); a null id is hashed as an empty one; repeated rows
give repeated rows; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import in_small_batches, kept

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 7
RATE = 100          # documents of a hundred that are transformed
SPM_RATE = 50       # of these, those that start with the suffix
BITS = 10           # a chunk has 2^BITS bytes on average
LEAST, MOST = 128, 1 << 14
CACHE_BYTES = 48 << 20  # content that a worker keeps, in each of two generations
_BLOCK = 1 << 20

# One 32-bit number per byte value, from a multiplicative rule.
_GEAR = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(29)).astype(np.uint32)


class Summary(NamedTuple):
    """What a chunk adds to the text around it."""
    size: int
    lines: int               # line feeds
    chars: int               # code points that start in the chunk
    marked: bool             # a mark lies wholly inside
    first: bytes             # its first two bytes
    last: bytes              # its last two bytes
    feeds: np.ndarray        # byte after each line feed
    chars_at: np.ndarray     # code points up to there


def boundaries(raw: bytes) -> list[int]:
    """Ends of the chunks of a text, the last one being its length."""
    ends, last = [], 0
    for at in range(0, len(raw), _BLOCK):
        lead = max(0, at - 31)
        h = _GEAR[np.frombuffer(raw, np.uint8, min(len(raw), at + _BLOCK) - lead, lead)]
        for k in range(5):  # sum of the last 32 bytes, each shifted by its distance
            w = 1 << k
            h[w:] = h[w:] + (h[:-w] << np.uint32(w))
        for c in (np.flatnonzero(h[at - lead:] >> np.uint32(32 - BITS) == 0) + at + 1).tolist():
            while c - last > MOST:
                last += MOST
                ends.append(last)
            if c - last >= LEAST:
                ends.append(c)
                last = c
    while len(raw) - last > MOST:
        last += MOST
        ends.append(last)
    return ends + [len(raw)] if last < len(raw) else ends


def summary(raw: bytes) -> Summary:
    b = np.frombuffer(raw, np.uint8)
    starts = np.cumsum((b & 0xC0) != 0x80)
    feeds = np.flatnonzero(b == 10)
    marked = PREFIX in raw or SUFFIX in raw or MIDDLE in raw
    return Summary(len(raw), len(feeds), int(starts[-1]), marked, raw[:2], raw[-2:], feeds + 1, starts[feeds])


class Memo:
    """Summaries by content, in two generations of ``most`` bytes of content."""

    def __init__(self, most: int = CACHE_BYTES) -> None:
        self.most, self.held, self.known, self.old = most, 0, {}, {}
        self.hits = 0

    def get(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.old.get(chunk)
        if found is None:
            found = summary(chunk)
        else:
            self.hits += 1
        if self.held > self.most:
            self.old, self.known, self.held = self.known, {}, 0
        self.known[chunk] = found
        self.held += len(chunk) + 300 + 16 * found.lines
        return found


class Text:
    """A text as the chain of its chunks' summaries."""

    def __init__(self, raw: bytes, memo: Memo) -> None:
        self.raw, at = raw, 0
        self.chunks: list[Summary] = []
        self.marked, edge = False, b""
        for end in boundaries(raw):
            s = memo.get(raw[at:end])
            self.chunks.append(s)
            seam = edge + s.first
            self.marked = self.marked or s.marked or PREFIX in seam or SUFFIX in seam or MIDDLE in seam
            edge = s.last if s.size > 1 else (edge + s.last)[-2:]
            at = end
        self.lines_before = np.concatenate(([0], np.cumsum([s.lines for s in self.chunks], dtype=np.int64)))
        self.chars_before = np.concatenate(([0], np.cumsum([s.chars for s in self.chunks], dtype=np.int64)))
        self.start = np.concatenate(([0], np.cumsum([s.size for s in self.chunks], dtype=np.int64)))
        feeds = int(self.lines_before[-1])
        self.n = feeds + (len(raw) > 0 and not raw.endswith(b"\n"))

    def after(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` lines."""
        if units == 0:
            return 0, 0
        if units > self.lines_before[-1]:
            return int(self.start[-1]), int(self.chars_before[-1])
        k = int(np.searchsorted(self.lines_before, units)) - 1
        own = units - int(self.lines_before[k]) - 1
        return int(self.start[k] + self.chunks[k].feeds[own]), int(self.chars_before[k] + self.chunks[k].chars_at[own])


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The first four 8-digit groups of the id's digest."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def transform(doc_id: int | None, raw: bytes, memo: Memo, *, seed: int = SEED, rate: int = RATE,
              spm_rate: int = SPM_RATE) -> tuple[int, str, int | None, int | None, bytes]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    text = Text(raw, memo)
    h = draws(doc_id, seed)
    if not raw or text.marked or h[2] % 100 >= rate:
        return text.n, "plain", None, None, raw
    a, z = sorted((h[0] % (text.n + 1), h[1] % (text.n + 1)))
    (a_byte, a_char), (z_byte, z_char) = text.after(a), text.after(z)
    prefix, middle, suffix = raw[:a_byte], raw[a_byte:z_byte], raw[z_byte:]
    if h[3] % 100 < spm_rate:
        return text.n, "spm", a_char, z_char - a_char, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return text.n, "psm", a_char, z_char - a_char, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = kept("fim-chunks", Memo)
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for s in range(0, len(batch), 256):
                b = batch.slice(s, 256)
                rows = [(d, *transform(d, t or b"", memo, seed=seed, rate=rate, spm_rate=spm_rate))
                        for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return (in_small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t")))
            .mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"))


def restored(output: F.Column, form: F.Column) -> F.Column:
    """The original text from an output and its form.  A text in parts holds no
    mark, so each mark of the output is one that was written."""
    def parts(first: bytes, second: bytes) -> list[F.Column]:
        mark, mid = F.lit(second.decode()), F.lit(MIDDLE.decode())
        rest = F.split_part(output, mark, F.lit(2))
        head = F.substring(F.split_part(output, mark, F.lit(1)), len(first) + 1, 1 << 30)
        return [head, F.split_part(rest, mid, F.lit(1)), F.split_part(rest, mid, F.lit(2))]

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix_s, prefix_s, middle_s = parts(SUFFIX, PREFIX)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix_s, middle_s, suffix_s)).otherwise(output))


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of every document's output, and of the text rebuilt from it."""
    done = fill_in_middle(docs)
    digest = [F.sha2(c.cast("binary"), 256).alias(name) for name, c in
              (("output_sha256", F.col("output")), ("restored_sha256", restored(F.col("output"), F.col("form"))))]
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digest)
