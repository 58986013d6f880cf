"""Quality classifier: Kneser-Ney perplexity over word and over byte n-grams.

A document's perplexity is the worse of two: per word by word trigrams
(``wordmodel``, whose tables grow with the trusted text), which judges what
words there are and how they follow each other, and per symbol by an
interpolated modified Kneser-Ney model of bytes, which judges their spelling.
The former is scaled, language by language, so that the high quantiles of both
over trusted documents agree.

The byte model reads texts as symbols: UTF-8 bytes mapped to 64 classes, where a
word that repeats the one before it is a single symbol (its space included).  With order 4 there are
at most 64^4 n-grams, so the finished table has a proven bound (64 MB) whatever
the corpus; only its seen entries travel, and a task unfolds them once.

Both count the trusted text (labels with quality 1) but for the part that
thresholds are taken from (one id in ``FOLDS``).  Of the byte model tasks count
blocks of symbols, partial sums meet sharded by n-gram.  Lower orders count
distinct predecessors; discounts come from the counts of counts; every order's
probabilities are a join of n-gram shards with context shards and with the
shards of the next lower order.

A document is rejected if its perplexity is over the threshold of its language:
a high quantile over trusted documents that the counts left out (one in
``FOLDS``, by CRC-32 of the id), with some slack.  Languages with fewer than
``FEW`` such documents take at least the quantile over all languages.

Defined results: null and empty texts have no perplexity and are rejected;
without trusted text nothing else is; a null language, or one unseen in trusted
text, has the overall threshold; repeated rows are judged alike; an empty table
gives an empty result; all columns are returned by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import in_small_batches, shared, texts_of, written
from loadcast.llm.wordmodel import WordModel, discounts

ORDER = 4
QUANTILE = 0.99
SLACK = 1.05
FOLDS = 5
FEW = 100
MAX_LANGUAGES = 1000
BROADCAST_IDS = 2_000_000  # trusted ids that may be broadcast (16 MB)
BITS = 6
SIZE = 1 << BITS
LINE = 29  # symbol of a line break, also what precedes a text
_CHUNK = 2_000_000


def _symbol(c: int) -> int:
    ch = chr(c)
    if c >= 0xC0:
        return 56 + (c & 7)
    if c >= 0x80:
        return 40 + (c & 15)
    if ch.isalpha():
        return c - ord("a") if ch.islower() else 26
    if ch.isdigit():
        return 27
    groups = [" ", "\n\r", ".", ",", "\0", "!?", "'\"`", "-_/", "()[]{}<>", ":;", "@#$%&*+=^~|\\"]
    return next((28 + k for k, g in enumerate(groups) if ch in g), 39)


#: Byte -> symbol; byte 0 stands for a repeated word.
SYMBOLS = bytes(_symbol(c) for c in range(256))


def symbols_of(text: bytes) -> np.ndarray:
    words = text.split(b" ")
    if any(map(eq, words[1:], words)):
        text = b"".join([words[0], *[b"\0" if x == y and x else b" " + x for x, y in zip(words[1:], words, strict=False)]])
    return np.frombuffer(bytes([LINE]) * (ORDER - 1) + text.translate(SYMBOLS), np.uint8)


def keys_of(symbols: np.ndarray) -> np.ndarray:
    """Code of the ``ORDER`` symbols that end at each symbol of the text."""
    n = len(symbols) - ORDER + 1
    keys = symbols[:n].astype(np.uint32)
    for j in range(1, ORDER):
        keys <<= np.uint32(BITS)
        keys |= symbols[j:j + n]
    return keys


class Model:
    """Seen log-probabilities and backoff weights of every order."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        self.orders, self._table = orders, None

    @property
    def table(self) -> np.ndarray:
        """Log-probability of every n-gram, unfolded on first use."""
        if self._table is None:
            full = np.full(SIZE, -np.log(SIZE), np.float32)
            for n, (keys, logp, contexts, backoff) in enumerate(self.orders, 1):
                if n > 1:
                    weight = np.zeros(SIZE ** (n - 1), np.float32)
                    weight[contexts] = backoff
                    lower, full = full, np.empty(SIZE ** n, np.float32)
                    full.reshape(SIZE, -1)[:] = lower  # whatever comes before it
                    rows = full.reshape(-1, SIZE)
                    rows += weight[:, None]
                full[keys] = logp
            self._table = full
        return self._table

    def score(self, text: bytes) -> tuple[float, int]:
        """Negative log-likelihood and number of symbols."""
        keys = keys_of(symbols_of(text))
        return -float(self.table[keys].sum(dtype=np.float64)), len(keys)


def _of_ids(docs: DataFrame, ids: DataFrame, id_col: str, limit: int) -> DataFrame:
    """Rows of ``docs`` with the given ids; the ids are broadcast if few."""
    few = ids.limit(limit + 1).count() <= limit
    return docs.join(F.broadcast(ids) if few else ids, docs[id_col] == ids["trusted_id"], "left_semi")


def _marked(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """``(doc, t, counted)`` of all ``docs``, marked if their id is among the distinct ``ids``."""
    few = ids.limit(limit + 1).count() <= limit
    rows = docs.select(F.col(id_col).alias("id"), _doc(id_col, text_col), F.col(text_col).cast("binary").alias("t"))
    return rows.join(F.broadcast(ids) if few else ids, rows["id"] == ids["trusted_id"], "left").select("doc", "t", F.col("trusted_id").isNotNull().alias("counted"))


def _held_out(id_col: str | Column, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col) % folds == 0


def ngram_counts(texts: DataFrame) -> DataFrame:
    """``(key, c)`` over the one binary column of ``texts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts):
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["key", "c"])
        parts, size = [], 0
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    keys = keys_of(symbols_of(t))
                    parts.append(keys)
                    size += len(keys)
                if size >= _CHUNK:
                    yield rows(parts)
                    parts, size = [], 0
        if parts:
            yield rows(parts)

    return in_small_batches(texts).mapInArrow(count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def fit(texts: DataFrame) -> Model:
    """Interpolated modified Kneser-Ney from all ``texts`` (one binary column)."""
    counts = written(ngram_counts(texts), "ngrams")
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols before
        tables[n] = tables[n + 1].groupBy((F.col("key") % SIZE ** n).alias("key")).agg(F.count(F.lit(1)).alias("c"))
    lower, orders = None, []
    for n in range(1, ORDER + 1):
        t = tables[n]
        if n == 1:
            t = t.sparkSession.range(SIZE).withColumnRenamed("id", "key").join(t, "key", "left").fillna(0, ["c"])
        _, d1, d2, d3 = discounts(*t.agg(*[F.coalesce(F.sum((F.col("c") == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4)]).first())
        d = F.when(F.col("c") == 0, 0.0).when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        contexts = (t.groupBy(F.floor(F.col("key") / SIZE).alias("context"))
                    .agg(F.sum("c").alias("total"), F.sum(d).alias("off")).filter("total > 0")
                    .select("context", "total", (F.col("off") / F.col("total")).alias("gamma")))
        rest = F.lit(1.0 / SIZE) if lower is None else F.col("p_low")
        joined = t.withColumn("context", F.floor(F.col("key") / SIZE)).join(contexts, "context", "inner")
        if lower is not None:
            joined = joined.join(lower, F.col("key") % (SIZE ** (n - 1)) == F.col("low"))
        table = written(joined.select("key", ((F.col("c") - d) / F.col("total") + F.col("gamma") * rest).alias("p")), f"order-{n}")
        lower = table.select(F.col("key").alias("low"), F.col("p").alias("p_low"))
        p, g = table.toArrow(), contexts.select("context", "gamma").toArrow()  # at most 64^4 and 64^3 rows
        column = lambda a, c: a.column(c).to_numpy()
        orders.append((column(p, "key").astype(np.uint32), np.log(column(p, "p")).astype(np.float32),
                       column(g, "context").astype(np.uint32), np.log(column(g, "gamma")).astype(np.float32)))
    return Model(orders)


def scored(rows: DataFrame, model: Model, field: str | None = None) -> DataFrame:
    """``rows(row, lang, doc, t)`` -> ``(row, lang, doc, h)``, ``h`` the mean
    negative log-likelihood of a symbol; with ``field`` the text is that field
    of ``row``."""
    held = shared(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held()
        for b in batches:
            found = [m.score(t) if t else None for t in texts_of(b, field)]
            means = [None if x is None else x[0] / x[1] for x in found]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("lang"), b.column("doc"), pa.array(means, pa.float64())], ["row", "lang", "doc", "h"])

    schema = rows.select("row", "lang", "doc", F.lit(0.0).cast("double").alias("h")).schema
    schema["h"].nullable = True
    return in_small_batches(rows).mapInArrow(run, schema)


def _doc(id_col: str, text_col: str) -> Column:
    """Code of a document; rows that repeat id and text share it."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("doc")


def perplexities(docs: DataFrame, letters: Model, words: DataFrame, *, row: Column, field: str | None, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``(row, lang, spelled, worded)``: perplexity by symbol and by word, the
    latter from ``words(doc, h)``."""
    text = F.col(text_col).cast("binary").alias("t")
    spelled = scored(docs.select(row.alias("row"), F.col(lang_col).cast("string").alias("lang"), _doc(id_col, text_col), *([] if field else [text])), letters, field)
    return spelled.join(words.withColumnRenamed("h", "h_words"), "doc", "left").select("row", "lang", F.exp("h").alias("spelled"), F.exp("h_words").alias("worded"))


def _levels(tried: DataFrame, column: str, quantile: float) -> dict[str | None, float | None]:
    """High quantile of every language, and under ``None`` of all."""
    level = F.percentile_approx(column, quantile, 10_000).alias("q")
    overall = tried.agg(level).first()["q"]
    by_lang = tried.filter(F.col(column).isNotNull()).groupBy("lang").agg(level, F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    return {r["lang"]: r["q"] if r["n"] >= FEW else max(r["q"], overall) for r in by_lang if r["lang"] is not None} | {None: overall}


def _by_lang(values: dict[str | None, float | None]) -> Column:
    """The value of the row's language; that of all for others."""
    rest = F.lit(values.get(None)).cast("double")
    known = [F.lit(x) for k, v in values.items() if k is not None for x in (k, v)]
    return F.coalesce(F.when(F.col("lang").isNotNull(), F.try_element_at(F.create_map(*known), F.col("lang"))), rest) if known else rest


def judged(docs: DataFrame, labels: DataFrame, *, row: Column, field: str | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           quantile: float = QUANTILE, slack: float = SLACK, folds: int = FOLDS, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``(row, perplexity, threshold, keep)`` of every document; ``field`` names
    the text inside ``row``, if ``row`` holds it."""
    trusted = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("trusted_id")).distinct()
    train = trusted.filter(~_held_out("trusted_id", folds))
    texts = _of_ids(docs, train, id_col, broadcast_ids).select(F.col(text_col).cast("binary").alias("t"))
    model = WordModel(_marked(docs, train, id_col, text_col, broadcast_ids))
    # Every document is scored by words once; thresholds read the same scores.
    words = model.score(last=True)
    model.forget()
    letters = fit(texts)
    names = {"id_col": id_col, "text_col": text_col, "lang_col": lang_col}
    apart = trusted.filter(_held_out("trusted_id", folds))
    tried = perplexities(_of_ids(docs, apart, id_col, broadcast_ids), letters, words, row=F.col(id_col), field=None, **names).filter("spelled is not null")
    tried = written(tried, "trusted-perplexity")
    by_symbol, by_word = (_levels(tried, c, quantile) for c in ("spelled", "worded"))
    scale = {k: by_symbol[k] / x for k, x in by_word.items() if x}
    worse = F.greatest("spelled", F.col("worded") * F.coalesce(_by_lang(scale), F.lit(1.0)))
    limits = _levels(tried.withColumn("perplexity", worse), "perplexity", quantile)
    all_docs = perplexities(docs, letters, words, row=row, field=field, **names)
    threshold = _by_lang({k: None if x is None else slack * x for k, x in limits.items()})
    return all_docs.withColumn("perplexity", worse).withColumn("threshold", threshold).select(
        "row", "perplexity", "threshold",
        F.coalesce(F.col("perplexity") <= F.coalesce("threshold", F.lit(float("inf"))), F.lit(False)).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rejected ones, columns unchanged."""
    row = F.struct(*[docs[c] for c in docs.columns])
    kept = judged(docs, labels, row=row, field=options.get("text_col", "text"), **options).filter("keep")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, labels, row=F.col("doc_id")).withColumnRenamed("row", "doc_id")
