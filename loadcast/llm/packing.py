"""Best-fit packing of tokenised documents by linear grouping.

Documents become token ids plus an end id; only longer ones are cut, into
pieces of ``capacity`` tokens.  Pieces are dealt by hash into shards of about
``per_shard`` (their number grows with the data; a shard wastes at most about
one sequence).  In a shard the scheme of linear grouping runs:

1. large pieces (over ``capacity / 8``), sorted, are cut into ``groups`` groups
   of equal cardinality; each length is rounded up to the longest of its group;
2. with so few sizes, configurations (multisets that fit a sequence) are chosen
   by exact subset sums: the longest size left, plus the fullest remainder, as
   often as the counts allow;
3. actual pieces take the places of the rounded sizes;
4. small pieces, longest first, go to the sequence with the least sufficient
   room (a new one if none has any).

Defined results: null text counts as empty and yields the end id alone;
repeated rows are packed as documents of their own; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import in_small_batches, kept, n_blocks, written

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 4096
PER_SHARD = 50_000
GROUPS = 48
CACHE = 1 << 19  # words whose ids a task remembers, in each of two generations


class WordEncoder:
    """Token ids of texts as little-endian uint32 bytes.

    The tokenizer lower-cases, drops white space, and none of its rules look
    across it, so a text's ids are those of its words one after the other.
    Words are encoded once and remembered, in two generations of ``cache``
    words; new ones are encoded together, parted by a word of their own."""

    PART = b"|"

    def __init__(self, tokenizer: str, cache: int = CACHE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
        self.limit, self.known, self.old = cache, {}, {}
        self.parting = self._ids([self.PART])[0]
        if len(self.parting) != 4:
            raise ValueError("the parting word must be one token")
        self.marks = dict(zip((b".", b","), self._ids([b".", b","]), strict=True))

    def _ids(self, words: list[bytes]) -> list[bytes]:
        found = self.encoder.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, words: list[bytes]) -> None:
        plain = [w for w in words if self.PART not in w]
        odd = [w for w in words if self.PART in w]
        self.known.update(zip(odd, self._ids(odd), strict=True))
        if plain:
            raw = self._ids([(b" " + self.PART + b" ").join(plain)])[0]
            cut = np.flatnonzero(np.frombuffer(raw, "<u4") == np.frombuffer(self.parting, "<u4")[0]) * 4
            for w, start, end in zip(plain, [0, *(cut + 4).tolist()], [*cut.tolist(), len(raw)], strict=True):
                self.known[w] = raw[start:end]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        # ASCII upper case goes first (fewer words); not next to special tokens.
        split = [(t if b"<|" in t else t.lower()).split() if t else [] for t in texts]
        new = set().union(*split).difference(known)
        for w in [w for w in new if w in old]:
            known[w] = old[w]
            new.discard(w)
        # A mark after a letter or digit is a word of its own to the tokenizer.
        marked = [w for w in new if w[-1:] in self.marks and w[-2:-1].isalnum()]
        plain = list(new.difference(marked).union(w[:-1] for w in marked).difference(known))
        for s in range(0, len(plain), 4096):
            self._learn(plain[s:s + 4096])
        for w in marked:
            known[w] = known[w[:-1]] + self.marks[w[-1:]]
        return [b"".join(map(known.__getitem__, words)) for words in split]


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
           end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``; ``ids`` are little-endian uint32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = kept(f"words:{tokenizer}", lambda: WordEncoder(tokenizer)), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for s in range(0, len(batch), 256):
                b = batch.slice(s, 256)
                out = []
                for doc, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                    ids += end
                    out += [(doc, k, k * capacity, (min(len(ids), at + 4 * capacity) - at) // 4, ids[at:at + 4 * capacity])
                            for k, at in enumerate(range(0, len(ids), 4 * capacity))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids"])

    return (in_small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t")))
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary"))


def _fullest(sizes: list[int], left: list[int], room: int) -> list[int]:
    """How many of each size fill ``room`` best (exact, bounded by ``left``)."""
    mask, bits, trail = (1 << (room + 1)) - 1, 1, []
    for k, s in enumerate(sizes):
        for _ in range(min(left[k], room // s)):
            trail.append((k, bits))
            bits |= (bits << s) & mask
    used, at = [0] * len(sizes), bits.bit_length() - 1
    for k, before in reversed(trail):
        if not before >> at & 1:
            used[k] += 1
            at -= sizes[k]
    return used


def pack(lengths: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece of one shard."""
    order = np.argsort(-lengths, kind="stable")
    by_size = lengths[order].tolist()
    large = int(np.count_nonzero(lengths * 8 > capacity))
    per = max(1, -(-large // groups))
    starts = list(range(0, large, per))
    sizes: list[int] = []
    queues: list[list[int]] = []  # positions in ``order``, longest last
    for s in starts:
        own = list(range(min(s + per, large) - 1, s - 1, -1))
        if sizes and sizes[-1] == by_size[s]:
            queues[-1] = own + queues[-1]
        else:
            sizes.append(by_size[s])
            queues.append(own)
    left = [len(q) for q in queues]
    bins: list[list[int]] = []
    first = 0
    while first < len(sizes):
        if not left[first]:
            first += 1
            continue
        left[first] -= 1
        used = _fullest(sizes[first:], left[first:], capacity - sizes[first])
        left[first] += 1
        used[0] += 1
        times = min(left[first + k] // u for k, u in enumerate(used) if u)
        for k, u in enumerate(used):
            left[first + k] -= u * times
        for _ in range(times):
            bins.append([queues[first + k].pop() for k, u in enumerate(used) for _ in range(u)])
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_bits = 0
    for b, members in enumerate(bins):
        room = capacity - sum(by_size[p] for p in members)
        rooms[room].append(b)
        open_bits |= 1 << room
    for p in range(large, len(by_size)):
        size = by_size[p]
        fit = open_bits >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                open_bits &= ~(1 << room)
            bins[b].append(p)
        else:
            room, b = capacity, len(bins)
            bins.append([p])
        rooms[room - size].append(b)
        open_bits |= 1 << (room - size)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, members in enumerate(bins):
        at = 0
        for p in members:
            sequence[order[p]], offset[order[p]] = b, at
            at += by_size[p]
    return sequence, offset


def place(table: DataFrame, *, capacity: int = CAPACITY, per_shard: int = PER_SHARD, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces."""
    shards = n_blocks(table.count(), per_shard)

    def run(key, t):
        t = t.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = pack(t.column("length").to_numpy(), capacity, groups)
        return t.drop_columns("shard").append_column("sequence_id", pa.array(key[0].as_py() * (1 << 32) + sequence)).append_column("offset", pa.array(offset))

    shard = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards))
    out = ", ".join(f"{c} {t}" for c, t in table.dtypes)
    return (table.withColumn("shard", shard).groupBy("shard")
            .applyInArrow(run, f"{out}, sequence_id long, offset long"))


def packed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
           end_id: int = END_ID, capacity: int = CAPACITY, per_shard: int = PER_SHARD) -> DataFrame:
    """Placement of every piece, with the CRC-32 of its ids; the ids
    themselves are not stored on the way (see ``token_sequences``)."""
    own = pieces(docs, id_col=id_col, text_col=text_col, tokenizer=tokenizer, end_id=end_id, capacity=capacity)
    stored = written(own.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return place(stored, capacity=capacity, per_shard=per_shard)


def token_sequences(own: DataFrame, placed: DataFrame) -> DataFrame:
    """The training sequences themselves: ``(sequence_id, ids)`` from
    ``pieces()`` and their placement (document ids must be distinct)."""
    at = placed.select("doc_id", "piece", "sequence_id", "offset")
    return (own.join(at, ["doc_id", "piece"]).groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.aggregate("parts", F.expr("cast('' as binary)"), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
