"""Benchmark decontamination by a broadcast hash set of test n-grams.

Words: A-Z lower-cased, then runs of 0-9, a-z and non-ASCII characters.  A
window is ``n`` consecutive item words (an item with fewer, but not none, is
one window).  Every document word inside an occurrence of a window is hit.

The set of window hashes is broadcast only up to ``max_words`` benchmark words;
a larger benchmark is dealt by item into blocks of that size and the documents
are scanned once per block.  A hash hit counts only after the words themselves
were compared.

Defined results: null and empty texts have no words (0 hits); an item without
words has no window; the texts of a repeated item id are one item, found once;
repeated document rows count on their own; an empty benchmark hits nothing; extra columns are ignored or passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import in_small_batches, n_blocks, shared, texts_of

WINDOW = 10
MAX_WORDS = 4_000_000

# Byte map of the word rule: a-z, 0-9 and bytes of non-ASCII characters stay,
# A-Z is lowered, anything else becomes a space.
WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() and not chr(c).isupper()
                   else c + 32 if c < 128 and chr(c).isupper() else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class WindowIndex:
    """Windows of some benchmark items, as word ids; looked up by rolling hash."""

    def __init__(self, items: list[tuple[object, bytes | None]], n: int) -> None:
        self.vocab: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[int]]] = {}
        self.items = list(dict.fromkeys(i for i, _ in items))
        number = {i: k for k, i in enumerate(self.items)}
        for i, text in items:
            k = number[i]
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text or b"")]
            size = min(n, len(ids))
            for s in range(len(ids) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(tuple(ids[s:s + size]), set()).add(k)
        self.windows = found
        self.hashes = {size: np.unique(self.rolling(np.array([x for w in ws for x in w]), size)[::size])
                       for size, ws in found.items()}

    @staticmethod
    def rolling(ids: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of ``size`` ids."""
        x = ids.astype(np.uint64) * _MIX
        x ^= x >> np.uint64(29)
        out = np.zeros(len(ids) - size + 1, np.uint64)
        for j in range(size):
            out = out * np.uint64(1_000_003) + x[j:j + len(out)]
        return out

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, hit word ranges [start, end) merged, items by index."""
        words = words_of(text)
        get = self.vocab.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        hit, items = np.zeros(len(ids) + 1, np.int32), set()
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            unknown = np.concatenate(([0], np.cumsum(ids == 0)))
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            h = self.rolling(ids, size)[at]
            pos = np.searchsorted(hashes, h)
            at = at[hashes[np.minimum(pos, len(hashes) - 1)] == h]
            for s in at.tolist():
                owners = self.windows[size].get(tuple(ids[s:s + size].tolist()))
                if owners:
                    hit[s] += 1
                    hit[s + size] -= 1
                    items |= owners
        inside = np.cumsum(hit[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
        return len(words), list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)), items


def _scan_block(state: DataFrame, items: list, n: int, field: str | None) -> DataFrame:
    """Add what one block of the benchmark hits to every document row."""
    index = shared(state.sparkSession, WindowIndex(items, n))
    spans_type = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index()
        for b in batches:
            n_words, spans, names = [], [], []
            for text, had, known in zip(texts_of(b, field), b.column("spans").to_pylist(),
                                        b.column("items").to_pylist(), strict=True):
                count, hit, new = ix.scan(text or b"")
                n_words.append(count)
                spans.append([{"s": x, "e": y} for x, y in merged([(h["s"], h["e"]) for h in had] + hit)])
                names.append(sorted(known + [str(ix.items[k]) for k in new]))
            own = ["row"] if field else ["row", "t"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in own), pa.array(n_words, pa.int64()), pa.array(spans, spans_type),
                 pa.array(names, pa.list_(pa.string()))], [*own, "n_words", "spans", "items"])

    return in_small_batches(state).mapInArrow(scan, state.schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and out[-1][1] >= s:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, *, row: F.Column, field: str | None = None, text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", n: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """``(row, n_words, spans, items)`` for every document row: hit word ranges
    and the ids (as strings, sorted) of the items that occur.  ``field`` names
    the text inside ``row``, if ``row`` holds it."""
    text = [] if field else [F.col(text_col).cast("binary").alias("t")]
    state = docs.select(row.alias("row"), *text, F.lit(0).cast("long").alias("n_words"),
                        F.expr("cast(array() as array<struct<s:bigint,e:bigint>>)").alias("spans"),
                        F.expr("cast(array() as array<string>)").alias("items"))
    bench = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).cast("binary").alias("t")).distinct()
    # A word takes two bytes at least, so this bounds the words that travel.
    total = bench.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = n_blocks(total, 2 * max_words)
    for k in range(blocks):
        own = bench.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k)  # an item is in one block
        state = _scan_block(state, [(r["i"], r["t"] and bytes(r["t"])) for r in own.collect()], n, field)
    return state.drop("t")


def cut_words(text: str, spans: list) -> str:
    """``text`` without the words of the given ranges: from the first letter of
    a range to the last one; what stands around stays."""
    raw = text.encode()
    flat = raw.translate(WORD_BYTES)
    starts, ends, at = [], [], 0
    for w in flat.split():
        at = flat.index(w, at)
        starts.append(at)
        at += len(w)
        ends.append(at)
    out, last = [], 0
    for s, e in spans:
        out.append(raw[last:starts[s]])
        last = ends[e - 1]
    return b"".join([*out, raw[last:]]).decode()


def remove_hits(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", drop_share: float = 0.5,
                n: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` without what they share with the benchmark: hit spans are cut
    out; a document with over ``drop_share`` of its words hit goes.  Others are
    returned as they are, all columns kept."""
    bench = benchmark.select("item_id", "text")
    whole = F.struct(*[docs[c] for c in docs.columns])
    found = scan(docs, bench, row=whole, field=text_col, n=n, max_words=max_words)

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, [(x["s"], x["e"]) for x in s]) if len(s) else t
                          for t, s in zip(text, spans, strict=True)], dtype=object)

    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    kept = found.filter(F.col("spans").isNull() | (n_hit <= F.col("n_words") * drop_share))
    text = F.when(F.size("spans") > 0, cut(F.col("row")[text_col], F.col("spans"))).otherwise(F.col("row")[text_col])
    return kept.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, *, n: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """Per document: words, hit words, items found and their digest."""
    found = scan(docs, benchmark, row=F.col("doc_id"), n=n, max_words=max_words)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return found.select(F.col("row").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))
