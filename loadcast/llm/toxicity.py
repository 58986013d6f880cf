"""Toxic spans by a linear-chain conditional random field.

Labels are given per document, so token labels are induced first: on a bounded
sample of labelled rows, word and prefix features are chosen that occur in
significantly many different contexts in toxic documents and hardly in clean
ones (copies of a document are the same contexts).  Their tokens in toxic
documents are labelled toxic and the field is trained on windows around them
and on others: emission weights for the word, its prefixes and its suffix,
and transition weights, by gradient steps with forward-backward expectations.

Scoring runs over whole texts: token marginals from forward-backward (exact;
long texts are cut into segments whose 2 x 2 transfer matrices are composed),
aggregated to the largest log-odds and the expected number of toxic tokens of
a document, which a logistic fit on the sample turns into its score.

``SAMPLE`` toxic and twice as many clean labelled documents (smallest hashes
first) bound the fit.
Labels, language, source and id are no inputs of a score.

Defined results: null and empty texts have the score of a text without words;
without labels of both classes every score is 0; a document labelled twice is
toxic if any label says so; repeated rows have equal scores; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import in_small_batches, shared, written

SAMPLE = 3000
FOLDS = 5
WINDOW = 32
WINDOWS = 6000   # windows of either kind that the field is trained on
SEGMENT = 128
CACHE = 1 << 18
TOKEN = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """Features of a lower-cased word."""
    out = ["w=" + word, "s=" + word[-3:]]
    return out + ["p=" + word[:k] for k in range(3, 7) if len(word) > k]


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall(text) if text else []


class Vocabulary:
    """Word numbers, so that token lists stay small."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        ids = self.ids
        return [np.array([ids.setdefault(w, len(ids)) for w in TOKEN.findall(t.lower())] if t else [], np.int64) for t in texts]


def _contexts(docs: list[np.ndarray], n_words: int) -> np.ndarray:
    """In how many different (word before, word after) each word occurs: copies
    of a document, or of a passage, count once."""
    every = [np.concatenate(([-1], d, [-1])) for d in docs if len(d)]
    if not every:
        return np.zeros(n_words, np.int64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    word = np.concatenate([d[1:-1] for d in every])
    around = [np.concatenate([d[k:len(d) - 2 + k] for d in every]).astype(np.uint64) for k in (0, 2)]
    key = ((around[0] * mix + word.astype(np.uint64)) ^ (around[0] >> np.uint64(7))) * mix + around[1]
    _, first = np.unique(key, return_index=True)
    return np.bincount(word[first], minlength=n_words)


def telling_features(vocab: list[str], toxic: np.ndarray, clean: np.ndarray, least: float = 25.0, ratio: float = 0.02) -> set[str]:
    """Word and prefix features whose contexts are significantly (likelihood
    ratio) and nearly only those of toxic documents."""
    share = toxic.sum() / max(1, toxic.sum() + clean.sum())
    seen: dict[str, list[int]] = {}
    for i in np.flatnonzero(toxic):
        for f in features_of(vocab[i]):
            if f[0] != "s":
                seen.setdefault(f, [0, 0])[0] += int(toxic[i])
    for i in np.flatnonzero(clean):
        for f in features_of(vocab[i]):
            if f in seen:
                seen[f][1] += int(clean[i])
    out = set()
    for f, (k, other) in seen.items():
        n = k + other
        llr = 2 * (k * np.log(k / (n * share)) + (other * np.log(other / (n * (1 - share))) if other else 0.0))
        if llr >= least and other * share <= ratio * k * (1 - share):
            out.add(f)
    return out


def _segments(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number in it, first token and size of every segment."""
    n = -(-lengths // SEGMENT)
    doc = np.repeat(np.arange(len(lengths)), n)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(np.cumsum(lengths) - lengths, n) + number * SEGMENT
    return doc, number, first, np.minimum(SEGMENT, lengths[doc] - number * SEGMENT)


def marginals(odds: np.ndarray, lengths: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """P(toxic) of every token; ``odds`` are the emission log-odds of all texts
    one after the other, ``trans`` the 2 x 2 transition log-potentials.  With
    ``pairs`` also P(toxic, and the token before it too)."""
    if not len(odds):
        return (np.zeros(0), np.zeros(0)) if pairs else np.zeros(0)
    t = np.exp(trans - trans.max())
    doc, number, first, size = _segments(lengths)
    k = int(size.max())
    at = np.minimum(first[:, None] + np.arange(k)[None, :], len(odds) - 1)
    e = np.exp(np.clip(odds, -30, 30))[at]
    valid = np.arange(k)[None, :] < size[:, None]
    n = len(doc)
    # 1. transfer matrix of each segment: two start states carried along
    m = np.tile(np.eye(2), (n, 1, 1))
    if number.max() > 0:
        for j in range(k):
            on = valid[:, j]
            x = m[on] @ t
            x[:, :, 1] *= e[on, j][:, None]
            m[on] = x / x.max(axis=(1, 2), keepdims=True)
    # 2. state before and after each segment, text by text
    before, after = np.zeros((n, 2)), np.ones((n, 2))
    before[number == 0] = (1.0, 0.0)
    count = int(number.max()) + 1
    by_number = [np.flatnonzero(number == j) for j in range(count)]
    for j in range(1, count):
        s = by_number[j]
        x = np.einsum("ni,nij->nj", before[s - 1], m[s - 1])
        before[s] = x / x.sum(axis=1, keepdims=True)
    for j in range(count - 1, 0, -1):
        s = by_number[j]
        x = np.einsum("nij,nj->ni", m[s], after[s])
        after[s - 1] = x / x.sum(axis=1, keepdims=True)
    # 3. forward and backward inside all segments at once
    f = np.empty((n, k, 2))
    a0, a1 = before[:, 0], before[:, 1]
    for j in range(k):
        x0, x1 = a0 * t[0, 0] + a1 * t[1, 0], (a0 * t[0, 1] + a1 * t[1, 1]) * e[:, j]
        z = x0 + x1
        a0, a1 = x0 / z, x1 / z
        f[:, j, 0], f[:, j, 1] = a0, a1
    p, both = np.empty((n, k)), np.zeros((n, k)) if pairs else None
    b0, b1 = after[:, 0], after[:, 1]
    for j in range(k - 1, -1, -1):
        on = valid[:, j]
        u, v = f[:, j, 0] * b0, f[:, j, 1] * b1
        p[:, j] = v / (u + v)
        if pairs:
            own = f[:, j - 1] if j else before / before.sum(axis=1, keepdims=True)
            d = e[:, j]
            z = own[:, 0] * (t[0, 0] * b0 + t[0, 1] * d * b1) + own[:, 1] * (t[1, 0] * b0 + t[1, 1] * d * b1)
            both[:, j] = own[:, 1] * t[1, 1] * d * b1 / z
        x0, x1 = t[0, 0] * b0 + t[0, 1] * e[:, j] * b1, t[1, 0] * b0 + t[1, 1] * e[:, j] * b1
        z = x0 + x1
        b0, b1 = np.where(on, x0 / z, b0), np.where(on, x1 / z, b1)
    return (p[valid], both[valid]) if pairs else p[valid]


class Tagger:
    """Field weights and the logistic fit that turns marginals into a score."""

    def __init__(self, weights: dict[str, float], bias: float, trans: np.ndarray) -> None:
        self.weights, self.bias, self.trans = weights, bias, trans
        self.known: dict[str, float] = {}
        self.logistic = np.zeros(3)

    def odds(self, words: list[str]) -> np.ndarray:
        known, get = self.known, self.weights.get
        new = set(words).difference(known)
        if len(known) + len(new) > CACHE:
            known.clear()
            new = set(words)
        for w in new:
            known[w] = self.bias + sum(get(x, 0.0) for x in features_of(w.lower()))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def tag(self, texts: list[list[str]]) -> list[np.ndarray]:
        lengths = np.array([len(t) for t in texts], np.int64)
        p = marginals(self.odds([w for t in texts for w in t]), lengths, self.trans)
        return np.split(p, np.cumsum(lengths)[:-1])

    @staticmethod
    def evidence(p: np.ndarray) -> tuple[float, float, float]:
        """What a document's score is made of: 1, largest log-odds, expected
        number of toxic tokens (in log)."""
        if not len(p):
            return 1.0, -10.0, 0.0
        top = min(max(float(p.max()), 1e-9), 1 - 1e-9)
        return 1.0, float(np.clip(np.log(top / (1 - top)), -10, 10)), float(np.log1p(p[p > 0.1].sum()))

    def score(self, p: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.logistic, self.evidence(p)), -30, 30))))


def _feature_rows(words: list[str], ids: dict[str, int]) -> np.ndarray:
    rows = np.zeros((len(words), 6), np.int64)
    for i, x in enumerate(words):
        own = [ids[f] for f in features_of(x) if f in ids]
        rows[i, :len(own)] = own
    return rows


def _train_field(vocab: list[str], windows: list[np.ndarray], labels: list[np.ndarray], epochs: int = 30, rate: float = 0.5,
                 l2: float = 1e-4) -> Tagger:
    flat, y = np.concatenate(windows), np.concatenate(labels).astype(np.float64)
    used, at = np.unique(flat, return_inverse=True)
    words = [vocab[i] for i in used]
    count = Counter()
    for w, n in zip(words, np.bincount(at).tolist(), strict=True):
        for f in features_of(w):
            count[f] += n
    ids = {f: i + 1 for i, f in enumerate(sorted(f for f, n in count.items() if n >= 2))}
    feats = _feature_rows(words, ids)[at]
    lengths = np.array([len(w) for w in windows])
    start = np.cumsum(lengths) - lengths
    weights, bias, trans = np.zeros(len(ids) + 1), -3.0, np.zeros((2, 2))
    sums, sum_b, sum_t = np.full_like(weights, 1e-6), 1e-6, np.full((2, 2), 1e-6)

    def pairs(p: np.ndarray, both: np.ndarray) -> np.ndarray:
        """Expected transitions from the tokens' P(1) and P(1 twice running)."""
        before = np.concatenate(([0.0], p[:-1]))
        before[start] = 0.0
        return np.array([[(1 - before - p + both).sum(), (p - both).sum()], [(before - both).sum(), both.sum()]])

    y_before = np.concatenate(([0.0], y[:-1]))
    y_before[start] = 0.0
    true_pairs = pairs(y, y * y_before)
    for _ in range(epochs):
        odds = bias + weights[feats].sum(axis=1)
        p, both = marginals(odds, lengths, trans, pairs=True)
        grad = np.bincount(feats.ravel(), np.repeat(y - p, 6), len(weights)) - l2 * weights
        grad[0] = 0.0
        sums += grad * grad
        weights += rate * grad / np.sqrt(sums)
        g = float((y - p).sum())
        sum_b += g * g
        bias += rate * g / np.sqrt(sum_b)
        gt = true_pairs - pairs(p, both)
        sum_t += gt * gt
        trans += rate * gt / np.sqrt(sum_t)
        trans -= trans[0, 0]  # potentials are relative
    return Tagger({f: float(weights[i]) for f, i in ids.items() if abs(weights[i]) > 1e-6}, float(bias), trans)


def fit(toxic: list[str | None], clean: list[str | None], prior: float = 0.5) -> Tagger | None:
    """Tagger from texts of both classes; ``prior`` is the share of toxic ones
    among all labelled documents."""
    if not toxic or not clean:
        return None
    words = Vocabulary()
    docs = {1: words.encode(toxic), 0: words.encode(clean)}
    vocab = list(words.ids)
    chosen = telling_features(vocab, _contexts(docs[1], len(vocab)), _contexts(docs[0], len(vocab)))
    is_toxic = np.array([not chosen.isdisjoint(features_of(w)) for w in vocab], bool)
    rng = np.random.default_rng(11)
    marked, plain = [], []
    for c in (1, 0):
        for d in docs[c]:
            for s in range(0, len(d), WINDOW):
                part = d[s:s + WINDOW]
                y = is_toxic[part] & (c == 1)
                (marked if y.any() else plain).append((part, y))
    pick = lambda x: [x[i] for i in sorted(rng.permutation(len(x))[:WINDOWS])]
    training = pick(marked) + pick(plain)
    if not marked:
        return None
    tagger = _train_field(vocab, [w for w, _ in training], [y for _, y in training])
    # Logistic fit of the document score, by Newton steps with a small ridge.
    odds = tagger.odds(vocab)
    x = []
    for c in (1, 0):
        for s in range(0, len(docs[c]), 500):
            part = docs[c][s:s + 500]
            lengths = np.array([len(d) for d in part])
            p = marginals(odds[np.concatenate(part)], lengths, tagger.trans)
            x += [Tagger.evidence(q) for q in np.split(p, np.cumsum(lengths)[:-1])]
    x, y = np.array(x), np.repeat([1.0, 0.0], [len(toxic), len(clean)])
    weight = np.where(y == 1, prior / len(toxic), (1 - prior) / len(clean)) * len(y)
    theta = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(3) * 0.1
        theta += np.linalg.solve(hess, x.T @ (weight * (y - p)) - 0.1 * theta)
    tagger.logistic = theta
    tagger.known = {}
    return tagger


def held_out(id_col: str | Column, folds: int = FOLDS) -> Column:
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Tagger | None:
    """Fit on at most ``sample`` toxic and ``2 * sample`` clean labelled
    documents that are not held out."""
    known = written(labels.filter(~held_out("doc_id") & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
                    .groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    texts = {}
    for c in (1, 0):
        ids = known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample if c else 2 * sample).select(F.col("doc_id").alias("k"))
        texts[c] = [r[0] for r in docs.select(F.col("doc_id").alias("d"), F.col("text").alias("t"))
                    .join(F.broadcast(ids), F.col("d") == F.col("k"), "left_semi").select("t").distinct().orderBy(F.xxhash64("t")).collect()]
    return fit(texts[1], texts[0], sizes.get(1, 0) / max(1, sum(sizes.values())))


def scores(docs: DataFrame, tagger: Tagger | None, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``(doc_id, held_out, score, predicted, spans)``; spans are the tokens
    (code points, end exclusive) with a marginal of at least ``threshold``."""
    held = shared(docs.sparkSession, tagger)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held()
        for batch in batches:
            for s in range(0, len(batch), 1000):
                b = batch.slice(s, 1000)
                texts = b.column(1).to_pylist()
                words = [tokens_of(t) if m else [] for t in texts]
                tagged = m.tag(words) if m else [np.zeros(0)] * len(words)
                out, found = [], []
                for t, p in zip(texts, tagged, strict=True):
                    out.append(m.score(p) if m else 0.0)
                    hit = np.flatnonzero(p >= threshold)
                    if len(hit):
                        places = [x.span() for x in TOKEN.finditer(t)]
                        found.append([{"start": places[i][0], "end": places[i][1], "p": float(p[i])} for i in hit])
                    else:
                        found.append([])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64()), pa.array(found, span)], ["doc_id", "score", "spans"])

    scored = in_small_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)[id_col]}, score double, spans array<struct<start:bigint,end:bigint,p:double>>")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(docs, train(docs, labels))
