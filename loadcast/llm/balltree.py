"""Ranked lexical search: exact inner-product search in sparse ball trees.

A document is a sparse vector over the terms of the items (other terms add
nothing to any score): weight of the term times its saturated frequency, as
64-bit integers.  An item is the vector of its term counts; the score is the
inner product.

The documents are read once per block of items; their counts are stored, and
document frequencies follow from the stored table.  Then tasks take them in
shards of bounded size.  A shard is split recursively at the median between two
far documents into balls (centroid, radius).  No document of a ball scores over
``<item, centroid> + |item| * radius``, nor over ``<item, centroid + reach>``,
the radius taken term by term (an item has few terms, the ball many); the lesser
bound is taken in doubles and rounded up by more than its error.  An item visits the balls of a shard
best-first and stops at the first whose bound is below its ``k``-th best score
so far, which tightens from shard to shard.  Leaves are scored in integers, so
the result is exact; balls decide only the work.

Items are held in blocks of ``block_bytes`` of text (their number grows with
the benchmark); a task returns at most ``k`` rows an item.

Defined results: null and empty texts have no terms, an item without terms has
no rows, documents without a score above 0 are not returned; equal rows of the
items count once, different texts under one id are one item with the terms of
all; repeated document rows are ranked each; null document ids come last among
equal scores; empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loadcast.llm.common import in_small_batches, n_blocks, shared, written
from loadcast.llm.decontaminate import WORD_BYTES

TOP = 20
BLOCK_BYTES = 1 << 17   # text of the items that travel together
SHARD = 2048            # documents of a tree, at most
CELLS = 1 << 23         # documents times terms of a tree, at most (about)
LEAF = 16
_PART = 1 << 20
_UP = 1 + 1e-9          # over the relative error of sums of some thousand doubles


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, in parts of about 1 MB, so a long text stays small."""
    at = 0
    flat = text.translate(WORD_BYTES)
    while at < len(flat):
        end = flat.find(b" ", at + _PART)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


class Items:
    """Term counts of a block of items over a vocabulary of its own."""

    def __init__(self, rows: list[tuple[object, bytes | None]]) -> None:
        self.vocab: dict[bytes, int] = {}
        counts: dict[object, dict[int, int]] = {}
        for name, text in rows:
            own = counts.setdefault(name, {})
            for terms in _parts(text or b""):
                for t in terms:
                    k = self.vocab.setdefault(t, len(self.vocab))
                    own[k] = own.get(k, 0) + 1
        self.names = list(counts)
        self.terms = [(np.fromiter(c.keys(), np.int64, len(c)), np.fromiter(c.values(), np.int64, len(c))) for c in counts.values()]
        self.weight = np.zeros(len(self.vocab), np.int64)
        self.n_docs = self.n_terms = 0

    def weigh(self, df: dict[int, int], n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        for k, n in df.items():
            self.weight[k] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))


def term_counts(docs: DataFrame, items, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, terms, tfs)``: all terms of a document counted, those of the items listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = items().vocab.get
        for batch in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1).to_pylist():
                total, found = 0, []
                for part in _parts(text or b""):
                    ids = np.fromiter(map(get, part, repeat(-1)), np.int32, len(part))
                    total += len(part)
                    found.append(ids[ids >= 0])
                k, c = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int32), np.zeros(0, np.int64))
                n.append(total)
                ends.append(ends[-1] + len(k))
                terms.append(k)
                tfs.append(c)
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x), t) if x else pa.array([], t))
                     for x, t in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return (in_small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t")))
            .mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>"))


class Tree:
    """A ball tree over the rows of ``cells`` (int64, documents by terms);
    node i holds the rows ``order[start[i]:stop[i]]``."""

    def __init__(self, cells: np.ndarray, leaf: int = LEAF) -> None:
        x = (cells * 1e-6).astype(np.float32)  # coarse: it only chooses the splits
        norm = np.einsum("ij,ij->i", x, x)
        self.order, self.start, self.stop, self.child = np.arange(len(cells)), [0], [len(cells)], [0]
        node = 0
        while node < len(self.start):
            a, z = self.start[node], self.stop[node]
            if z - a > leaf:
                rows = self.order[a:z]
                own = x[rows]
                far = own[np.argmax(norm[rows] - 2 * (own @ own.mean(axis=0)))]
                other = own[np.argmax(norm[rows] - 2 * (own @ far))]
                half = (z - a) // 2
                self.order[a:z] = rows[np.argpartition(own @ (other - far), half)]
                self.child[node] = len(self.start)
                self.start += [a, a + half]
                self.stop += [a + half, z]
                self.child += [0, 0]
            node += 1
        self.cells = cells[self.order]
        self.centroid = np.empty((len(self.start), cells.shape[1]))
        self.radius, self.reach = np.empty(len(self.start)), np.empty((len(self.start), cells.shape[1]))
        for k, (a, z) in enumerate(zip(self.start, self.stop, strict=True)):
            own = self.cells[a:z]
            c = own.mean(axis=0)
            away = own - c
            self.centroid[k] = c
            self.radius[k] = math.sqrt(np.einsum("ij,ij->i", away, away).max()) * _UP
            self.reach[k] = away.max(axis=0)

    def bounds(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """No row of a node scores over its bound."""
        q = counts.astype(np.float64)
        beyond = np.minimum(math.sqrt(q @ q) * self.radius, self.reach[:, terms] @ q)
        return (self.centroid[:, terms] @ q + beyond) * _UP + 1


class Best:
    """The ``k`` best rows of an item: score, then id, null ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.rows = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    @property
    def least(self) -> int:
        """Rows below this score cannot enter."""
        return max(1, int(self.rows[0][-1])) if len(self.rows[0]) == self.k else 1

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        own = score >= self.least
        if own.any():
            score, null, ids = (np.concatenate(x) for x in zip(self.rows, (score[own], null[own], ids[own]), strict=True))
            top = np.lexsort((ids, null, -score))[:self.k]
            self.rows = score[top], null[top], ids[top]


def search_shard(items: Items, best: list[Best], ids: np.ndarray, null: np.ndarray, n: np.ndarray, sizes: np.ndarray,
                 terms: np.ndarray, tfs: np.ndarray, leaf: int = LEAF) -> int:
    """Add what a shard's documents score; returns the number of leaves that were scored."""
    m = 75 + (25 * n * items.n_docs) // max(1, items.n_terms)
    row = np.repeat(np.arange(len(ids)), sizes)
    value = items.weight[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m[row]))
    used, column = np.unique(terms, return_inverse=True)
    cells = np.zeros((len(ids), len(used)), np.int64)
    cells[row, column] = value
    tree = Tree(cells, leaf)
    place = np.full(len(items.weight), -1)
    place[used] = np.arange(len(used))
    scored = 0
    for (own, counts), top in zip(items.terms, best, strict=True):
        at = place[own]
        at, counts = at[at >= 0], counts[at >= 0]
        if not len(at):
            continue
        bound = tree.bounds(at, counts).tolist()
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= top.least:
            _, k = heapq.heappop(heap)
            if tree.child[k]:
                for c in (tree.child[k], tree.child[k] + 1):
                    if bound[c] >= top.least:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            scored += 1
            part = slice(tree.start[k], tree.stop[k])
            rows = tree.order[part]
            top.add(tree.cells[part][:, at] @ counts, null[rows], ids[rows])
    return scored


def _search(vectors: DataFrame, items, item_type: str, arrow_type: pa.DataType, k: int, shard: int, leaf: int) -> DataFrame:
    """``(item_id, doc_id, score)``: the ``k`` best of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = items()
        best = [Best(k) for _ in own.names]
        most = max(2 * leaf, min(shard, CELLS // max(1, len(own.weight))))
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            col = {c: t.column(c).combine_chunks() for c in t.column_names}
            ids = col["doc_id"]
            search_shard(own, best, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
                         col["n"].to_numpy(), col["terms"].value_lengths().to_numpy(), col["terms"].flatten().to_numpy(),
                         col["tfs"].flatten().to_numpy(), leaf)

        for batch in batches:
            for s in range(0, len(batch), most):
                part = batch.slice(s, most)
                if rows and rows + len(part) > most:
                    flush()
                    held, rows = [], 0
                held.append(part)
                rows += len(part)
        if rows:
            flush()
        for name, top in zip(own.names, best, strict=True):
            score, null, ids = top.rows
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(score), arrow_type), pa.array(ids, mask=null), pa.array(score)],
                                                 ["item_id", "doc_id", "score"])

    return vectors.filter(F.size("terms") > 0).mapInArrow(run, f"item_id {item_type}, doc_id long, score long")


def rank(docs: DataFrame, queries: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", k: int = TOP, block_bytes: int = BLOCK_BYTES, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    kind = queries.schema[item_col].dataType
    bench = queries.select(F.col(item_col).alias("i"), F.col(item_text).cast("binary").alias("t")).distinct()
    total = bench.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = n_blocks(total, block_bytes)
    found = None
    for b in range(blocks):
        own = bench.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b)
        items = Items([(r["i"], r["t"] and bytes(r["t"])) for r in own.collect()])
        vectors = written(term_counts(docs, shared(spark, items), id_col=id_col, text_col=text_col), "term-counts")
        n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        # One row a term of this block of items.
        df = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
        items.weigh({r["term"]: r["count"] for r in df.collect()}, n_docs, n_terms)
        items.vocab = {}
        best = _search(vectors, shared(spark, items), kind.simpleString(), to_arrow_type(kind), k, shard, leaf)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
