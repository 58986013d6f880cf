"""SimHash near-duplicates found exactly through vantage-point trees.

Fingerprint: A-Z lower-cased, words are runs of other than space and
\\x09-\\x0D, shingles are ``k`` words joined by a space (repeats included; a
shorter text is one shingle); a bit is 1 if over half of the shingles' XXH64
(seed 42) have it.  No words: fingerprint zero, linked like any other.

Linking at ``max_bits`` = 3 differing bits or fewer.  On all 64 bits a vantage
point separates little (distances crowd around 32), so each 32-bit half is a
metric space with a tree of its own: a pair within 3 bits differs by at most
``max_bits // 2`` = 1 bit in one of the halves.  A tree is fitted on a bounded
sample; every distinct fingerprint is indexed in one home shard per half (by
its Hamming distance to the vantage points) and is sent as a query to every
shard that the triangle bound does not exclude, so pairs across a boundary are
met.  Within shards all 64 bits are compared.  The result does not depend on
the sample or the tree, only the work does.

Copies are one fingerprint before any comparison.  A crowded shard is cut into
cells of at most ``cell`` homes by ``cell`` queries; a cell returns a spanning
forest of what it links, never its pairs.

Defined results: null text counts as empty; repeated rows are members like any
other; null ids keep their row and never name a component; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import in_small_batches, shared, written
from loadcast.llm.components import Forest, connected_components

SHINGLE = 3
MAX_BITS = 3
SAMPLE = 1 << 18   # fingerprints that a tree is fitted on, at most (about)
SHARD = 512        # distinct fingerprints that a shard should hold
CELL = 8192
_BLOCK = 1 << 20

# Byte map: A-Z lowered, \x09-\x0D become spaces.
_TEXT_BYTES = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, in blocks of about 1 MB, so a long text stays small."""
    flat = text.translate(_TEXT_BYTES)
    at = 0
    while at < len(flat):
        end = flat.find(b" ", at + _BLOCK)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    counts, n, tail = np.zeros(64, np.int64), 0, []
    for block in _words(text):
        words = tail + block
        if len(words) >= k:
            h = np.fromiter(map(digest, map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))), "<u8", len(words) - k + 1)
            counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
            n += len(h)
            tail = words[len(words) - k + 1:]
        else:
            tail = words
    if not n:
        if not tail:
            return 0
        return digest(b" ".join(tail))
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """``(id, fp)``; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t or b"", k) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return (in_small_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t")))
            .mapInArrow(run, "id long, fp long"))


class Tree:
    """A vantage-point tree over 32-bit codes: node i has children 2i+1 (within
    the radius) and 2i+2 (beyond it); radius -1 marks a shard."""

    def __init__(self, codes: np.ndarray, depth: int, least: int = 8) -> None:
        self.depth = depth
        self.vantage = np.zeros((1 << depth) - 1 if depth else 0, np.uint32)
        self.radius = np.full(len(self.vantage), -1, np.int8)
        rng = np.random.default_rng(7)
        todo = [(0, codes)]
        while todo:
            i, own = todo.pop()
            if i >= len(self.vantage) or len(own) < 2 * least:
                continue
            best = None
            for v in rng.choice(own, 6):  # the vantage point that spreads the sample most evenly
                d = np.bitwise_count(own ^ v).astype(np.int8)
                r = int(np.median(d))
                r = min((r - 1, r), key=lambda x: abs(2 * np.count_nonzero(d <= x) - len(d)))
                edge = np.count_nonzero((d == r) | (d == r + 1)) + abs(2 * np.count_nonzero(d <= r) - len(d))
                if r >= 0 and (d > r).any() and (best is None or edge < best[0]):
                    best = edge, v, r, d
            if best is None:
                continue
            _, self.vantage[i], self.radius[i], d = best
            todo += [(2 * i + 1, own[d <= self.radius[i]]), (2 * i + 2, own[d > self.radius[i]])]

    def route(self, codes: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) for every shard that may hold a code within ``reach``;
        with reach 0 the home shard alone."""
        row, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(row):
            inner = node < len(self.radius)
            inner[inner] = self.radius[node[inner]] >= 0
            done.append((row[~inner], node[~inner]))
            row, node = row[inner], node[inner]
            d, r = np.bitwise_count(codes[row] ^ self.vantage[node]).astype(np.int64), self.radius[node].astype(np.int64)
            near, far = d - reach <= r, d + reach > r
            row, node = np.concatenate((row[near], row[far])), np.concatenate((2 * node[near] + 1, 2 * node[far] + 2))
        return tuple(np.concatenate(x) for x in zip(*done, strict=True)) if done else (row, node)


def _halves(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [(u >> np.uint64(32)).astype(np.uint32), (u & np.uint64(0xFFFFFFFF)).astype(np.uint32)]


def _routed(fps: DataFrame, trees, reach: int, queries: bool) -> DataFrame:
    """``(shard, fp, query)``: every fingerprint at home in each half, and, if
    asked for, as a query in each shard within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = trees()
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for half, codes in enumerate(_halves(fp)):
                for query in (False, True)[:1 + queries]:
                    row, node = both[half].route(codes, reach if query else 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node * 2 + half), pa.array(fp[row]), pa.array(np.full(len(row), query))],
                        ["shard", "fp", "query"])

    return fps.select("fp").mapInArrow(run, "shard long, fp long, query boolean")


def _cell_links(key, table: pa.Table, max_bits: int) -> pa.Table:
    """Spanning forest of the links between a cell's queries and its homes."""
    fp, query = table.column("fp").to_numpy(), table.column("query").to_numpy()
    nodes, at = np.unique(fp, return_inverse=True)
    home, ask = at[~query], at[query]
    codes, forest = nodes.view(np.uint64), Forest(len(nodes))
    step = max(1, (1 << 21) // max(1, len(home)))
    for s in range(0, len(ask), step):
        part = ask[s:s + step]
        i, j = np.nonzero(np.bitwise_count(codes[part][:, None] ^ codes[home][None, :]) <= max_bits)
        forest.add(part[i], home[j])
    a, b = forest.links()
    return pa.table({"a": nodes[a], "b": nodes[b]})


def link_fingerprints(fps: DataFrame, *, max_bits: int = MAX_BITS, sample: int = SAMPLE, shard: int = SHARD,
                      cell: int = CELL) -> DataFrame:
    """Distinct ``fps(fp long)`` -> ``(a, b)``: links that span every group of
    fingerprints connected by steps of at most ``max_bits`` bits."""
    spark, n = fps.sparkSession, fps.count()
    part = max(1, math.ceil(n / sample))
    drawn = np.array([r[0] for r in fps.filter(F.pmod(F.xxhash64("fp"), F.lit(part)) == 0).select("fp")
                     .limit(2 * sample).collect()], np.int64)
    depth = max(0, math.ceil(math.log2(max(1, n / shard))))
    depth = min(depth, max(0, math.ceil(math.log2(max(1, len(drawn) / 8)))))
    trees = shared(spark, [Tree(c, depth) for c in _halves(drawn)])
    reach = max_bits // 2
    # Shards are bounded by the trees (2^depth each), so their sizes may travel.
    sizes = (_routed(fps, trees, reach, True).groupBy("shard", "query").count())
    crowded = {(r["shard"], r["query"]): -(-r["count"] // cell) for r in sizes.filter(F.col("count") > cell).collect()}
    cuts = spark.sparkContext.broadcast(crowded)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = cuts.value
        for b in batches:
            if not cut:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.zeros(len(b), np.int64))],
                                                 ["shard", "fp", "query", "cell"])
                continue
            shard, fp, query = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            homes = np.array([cut.get((s, False), 1) for s in shard.tolist()])
            asks = np.array([cut.get((s, True), 1) for s in shard.tolist()])
            own = ((fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)
            times = np.where(query, homes, asks)  # a home meets every cut of the queries, and the reverse
            row = np.repeat(np.arange(len(fp)), times)
            other = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            q = query[row]
            cells = np.where(q, other * asks[row] + own[row] % asks[row], (own[row] % homes[row]) * asks[row] + other)
            yield pa.RecordBatch.from_arrays([pa.array(shard[row]), pa.array(fp[row]), pa.array(q), pa.array(cells)],
                                             ["shard", "fp", "query", "cell"])

    cells = _routed(fps, trees, reach, True).mapInArrow(dealt, "shard long, fp long, query boolean, cell long")
    return cells.groupBy("shard", "cell").applyInArrow(
        lambda key, t: _cell_links(key, t, max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    max_bits: int = MAX_BITS, **tuning: int) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row; ``component_id`` is the
    smallest id that can be reached by links, its own included."""
    rows = written(fingerprints(docs, id_col=id_col, text_col=text_col, k=k), "simhash")
    groups = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-groups")
    found = connected_components(link_fingerprints(groups.select("fp"), max_bits=max_bits, **tuning))
    root = groups.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    ids = root.groupBy("root").agg(F.min("least").alias("component_id"))
    comps = root.join(ids, "root").select(F.col("fp").alias("code"), "component_id")
    return rows.join(comps, F.col("fp") == F.col("code")).select(F.col("id").alias("doc_id"), "fp", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with the row of the smallest id of each group, columns
    unchanged.  Rows without an id stay, and so do all rows of an id that names
    a group (a repeated row, or another text under the same id)."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, k=k, max_bits=max_bits)
    gone = (found.groupBy(F.col("doc_id").alias("gone_id")).agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("gone"))
            .filter("gone").select("gone_id"))
    return docs.join(gone, docs[id_col] == F.col("gone_id"), "left_anti")


def report(docs: DataFrame) -> DataFrame:
    """Fingerprint as 16 hex digits and component of every document."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
