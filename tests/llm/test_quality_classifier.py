from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadcast.llm import quality as q
from loadcast.llm import wordmodel as wm
from loadcast.llm.common import kept

SF = "/root/testdata/sf0.1"


def brute_model(texts):
    """Log-probability function of interpolated modified Kneser-Ney, by definition."""
    counts = {q.ORDER: Counter()}
    for t in texts:
        s = q.symbols_of(t.encode()).tolist()
        counts[q.ORDER].update(tuple(s[i:i + q.ORDER]) for i in range(len(s) - q.ORDER + 1))
    for n in range(q.ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    parts = {}
    for n, c in counts.items():
        n1, n2, n3, n4 = (sum(v == k for v in c.values()) for k in (1, 2, 3, 4))
        y = n1 / max(1, n1 + 2 * n2)
        raw = (1 - 2 * y * n2 / max(1, n1), 2 - 3 * y * n3 / max(1, n2), 3 - 4 * y * n4 / max(1, n3))
        d = [0, *(x if 0 < x < k else k / 2 for k, x in enumerate(raw, 1))]
        total, off = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[g[:-1]] += v
            off[g[:-1]] += d[min(v, 3)]
        parts[n] = c, d, total, off

    def prob(g):
        if not g:
            return 1 / q.SIZE
        c, d, total, off = parts[len(g)]
        h, low = g[:-1], prob(g[1:])
        if not total[h]:
            return low
        v = c[g]
        return (v - d[min(v, 3)]) / total[h] + off[h] / total[h] * low
    return prob


def test_model_matches_the_definition(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc d.E\né") for _ in range(rng.randrange(1, 80))) for _ in range(60)] + ["la la la la", "Ab ab ab"]
    df = spark.createDataFrame([(t.encode(),) for t in texts] + [(None,), (b"",)], "t binary").repartition(3)
    model, prob = q.fit(df), brute_model(texts)
    table = model.table
    for _ in range(400):
        g = tuple(rng.choice([0, 1, 2, 3, 28, 29, 30, 59, 32]) for _ in range(q.ORDER))
        key = 0
        for s in g:
            key = key * q.SIZE + s
        assert table[key] == pytest.approx(math.log(prob(g)), abs=2e-4), g
    for t in texts[:10]:
        nll, n = model.score(t.encode())
        s = q.symbols_of(t.encode()).tolist()
        assert n == len(s) - q.ORDER + 1
        assert nll == pytest.approx(-sum(math.log(prob(tuple(s[i:i + q.ORDER]))) for i in range(n)), rel=1e-4)
    sums = np.exp(table.reshape(-1, q.SIZE)[:2000]).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-3)


def test_labels_are_told_apart(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = q.report(docs, labels).cache()
    assert out.count() == docs.count()
    shares = {r["quality"]: r["kept"] for r in out.join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
              .groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.985 and shares[0] < 0.03


def test_edges(spark):
    text = "the quick brown fox jumps over the lazy dog and runs on. "
    docs = [(i, text * (1 + i % 4), "en", i) for i in range(60)] + [(70, None, "en", 0), (71, "", "en", 0), (72, text, None, 0), (73, text, "xx", 0),
                                                                  (74, "#### $$$$ @@@@ %%%% &&&&", "en", 0), (75, text, "en", 0), (75, text, "en", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, perplexity long").selectExpr("*", "1 as row", "2 as t", "3 as threshold")
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(3, 1), (None, 1), (74, None)], "doc_id long, quality int")
    kept = q.keep_good(df, labels)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(60), 72, 73, 75, 75]
    small = q.keep_good(df, labels, broadcast_ids=1)
    assert sorted(r.doc_id for r in small.collect()) == [*range(60), 72, 73, 75, 75]
    assert q.keep_good(df.limit(0), labels).count() == 0
    assert q.keep_good(df, labels.limit(0)).count() == len(docs) - 2


def test_words_in_random_order_are_rejected(spark):
    rng = random.Random(5)
    pick = lambda *xs: rng.choice(xs)
    def prose():
        return " ".join(f"the {pick('old', 'young', 'tired')} {pick('farmer', 'teacher', 'sailor')} walked to the {pick('market', 'harbour', 'village')}"
                        f" and bought {pick('some bread', 'fresh fish', 'two apples')} for {pick('his', 'her')} family." for _ in range(12))
    good = [prose() for _ in range(300)]
    mixed = []
    for t in good[:20]:
        w = t.split(" ")
        rng.shuffle(w)
        mixed.append(" ".join(w))
    docs = [(i, t, "en") for i, t in enumerate(good + mixed)]
    labels = spark.createDataFrame([(i, 1) for i in range(280)], "doc_id long, quality int")
    kept = {r.doc_id for r in q.keep_good(spark.createDataFrame(docs, "doc_id long, text string, lang string"), labels).collect()}
    assert not kept & set(range(300, 320))
    assert len(kept & set(range(280, 300))) >= 18


def test_word_model_matches_the_definition(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "b", "c", "dd", "e,", "東京", "f"], k=rng.randrange(1, 30))) for _ in range(40)]
    new = ["a b c dd", "zz a b", "東京 東 dd zz yy", "", None, "  "]
    split = lambda t: [x for y in t.split() for x in (list(y) if "東" in y else [y[:-1], ","] if y.endswith(",") else [y])]
    c3 = Counter(g for t in texts for s in [["", "", *split(t)]] for g in zip(s, s[1:], s[2:]))
    c2 = Counter(g[1:] for g in c3)
    c1 = Counter(g[1:] for g in c2)
    def order(c, low):
        n1, n2, n3, n4 = (sum(v == k for v in c.values()) for k in (1, 2, 3, 4))
        y = n1 / max(1, n1 + 2 * n2)
        raw = (1 - 2 * y * n2 / max(1, n1), 2 - 3 * y * n3 / max(1, n2), 3 - 4 * y * n4 / max(1, n3))
        d = [0, *(x if 0 < x < k else k / 2 for k, x in enumerate(raw, 1))]
        total, off = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            off[g[:-1]] += d[min(v, 3)]
        def prob(g):
            h = g[:-1]
            return low(g[1:]) if not total[h] else (c[g] - d[min(c[g], 3)] + off[h] * low(g[1:])) / total[h]
        return prob
    prob = order(c3, order(c2, order(c1, lambda g: 1 / (len(c1) + 1))))
    model = q.WordModel(spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("cast(t as binary) as t").repartition(3))
    asked = spark.createDataFrame(list(enumerate(texts[:10] + new)), "doc long, t string").selectExpr("doc", "cast(t as binary) as t").repartition(2)
    got = {r.doc: r.h for r in model.score(asked).collect()}
    want = {i: -np.mean([math.log(prob(g)) for s in [["", "", *split(t)]] for g in zip(s, s[1:], s[2:])]) for i, t in enumerate(texts[:10] + new) if t and t.strip()}
    assert got == pytest.approx(want, rel=1e-9)


def test_words_are_cut_and_coded_alike_wherever_they_stand():
    texts = ["don't stop", "東京abc x_1", "\u00a0\u2003 ", "", "é" * 40 + " stop\nstop", "a\rb\x0bc"]
    split = [["don", "'", "t", "stop"], ["東", "京", "abc", "x", "_", "1"], [], [], ["é" * 40, "stop", "stop"], ["a", "b", "c"]]
    codes, of = wm.word_codes(texts, block=2)
    assert of.tolist() == [i for i, ws in enumerate(split) for _ in ws]
    alone = {w: int(wm.word_codes([w])[0][0]) for ws in split for w in ws}
    assert len(set(alone.values())) == len(alone)
    assert codes.tolist() == [alone[w] for ws in split for w in ws]


def test_shards_of_frequent_words_change_nothing(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["the", "of", *"abcdefgh"], [30, 15, *[1] * 8], k=rng.randrange(1, 60))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, t string").selectExpr("doc", "cast(t as binary) as t").repartition(4)
    def scores():
        model = wm.WordModel(df.filter("doc < 50").select("t"))
        return {r.doc: r.h for r in model.score(df).collect()}
    many = scores()
    assert wm.dealing_of(df).parts.max() > 4
    monkeypatch.setattr(wm, "MOST_PARTS", 1)
    monkeypatch.setattr(wm, "CHUNK_CHARS", 50)
    assert scores() == pytest.approx(many, rel=1e-9)
    assert wm.dealing_of(df).parts.max() == 1


def test_packed_rows_are_read_again():
    columns = np.array([2**63, 5], np.uint64), np.array([], np.int64), np.array([0.5, -1.0, 3.0]), np.array([7], np.uint16)
    for got in (wm._unpack(wm._pack(*columns)), wm._unpack(wm._pack(columns[1]))):
        assert [(c.dtype, c.tolist()) for c in got] == [(c.dtype, c.tolist()) for c in (columns if len(got) > 1 else columns[1:2])]


def test_packed_rows_reach_a_task_in_batches_of_bounded_bytes(spark, monkeypatch):
    monkeypatch.setattr(wm, "BATCH_BYTES", 3_000_000)
    rows = spark.range(40).selectExpr("cast(id % 2 as int) shard", "cast(id % 3 as int) kind", "cast(repeat('x', 1000000) as binary) data")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(b)], "bytes": [b.nbytes], "shards": [len(set(b.column("shard").to_pylist()))]})

    with wm._bounded(spark):
        found = wm._by_shard(rows, wm.Dealing(2)).mapInArrow(sizes, "n long, bytes long, shards long").collect()
    assert sum(r["n"] for r in found) == 40
    assert max(r["bytes"] for r in found) < 6_000_000
    assert {r["shards"] for r in found} == {1}


def test_asked_words_of_a_slice_take_few_bytes(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(200_000)]
    texts = [" ".join(words[min(int(rng.paretovariate(0.25)), len(words)) - 1] for _ in range(2_000)) for _ in range(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, t string").selectExpr("doc", "cast(t as binary) as t").coalesce(1)
    asked = wm.dealt(docs, wm.Dealing(wm.LEAST_SHARDS), 0, wm._ASKED).select(F.sum(F.length("data"))).first()[0]
    assert 0 < asked / (2_000 * 700) < 1.3


def test_rows_are_ordered_and_counted_with_few_bits_and_with_many():
    rng = np.random.default_rng(1)
    for top in (9, 1 << 31):
        a, b, c = (rng.integers(top - 4, top, 300) for _ in range(3))
        rows = list(zip(a.tolist(), b.tolist(), c.tolist(), strict=True))
        assert wm._order(a, b, c).tolist() == sorted(range(300), key=lambda i: rows[i])
        found, times = wm._distinct(a, b, c)
        assert dict(zip(zip(*(x.tolist() for x in found), strict=True), times.tolist(), strict=True)) == Counter(rows)


def test_places_are_found_wherever_keys_crowd():
    for keys in ([], [0], [0, 1, 2, 3, 2**40, 2**63, 2**64 - 1], [2**64 - 1]):
        wanted = [0, 1, 4, 2**40, 2**63 + 1, 2**64 - 2, 2**64 - 1]
        at, seen = wm.Keys(np.array(keys, np.uint64)).find(np.array(wanted, np.uint64))
        assert seen.tolist() == [w in keys for w in wanted]
        assert [keys[i] for i in at[seen]] == [w for w in wanted if w in keys]


def zipf_docs(spark, n=400):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(20_000)]
    texts = [" ".join(words[min(int(10 * rng.paretovariate(0.8)), len(words)) - 1] for _ in range(800)) for _ in range(n)]
    return spark.createDataFrame(list(enumerate(texts)), "doc long, t string").selectExpr("doc", "cast(t as binary) as t").coalesce(1)


def test_short_codes_take_fewer_bytes_and_slices_are_alike(spark):
    docs = zipf_docs(spark)
    coded = wm.dealing_of(docs)
    size = lambda plan, s: wm.dealt(docs, plan, s, wm._COUNTED).select(F.sum(F.length("data"))).first()[0]
    short = [size(coded, s) for s in range(wm.SLICES)]
    plain = [size(wm.Dealing(coded.shards), s) for s in range(wm.SLICES)]
    assert sum(short) < 0.7 * sum(plain)
    known, ranks = coded.table()
    assert len(known) and sorted(ranks.tolist()) == list(range(1, len(known) + 1))
    words, _, v, _, _ = wm.trigrams([bytes(r.t).decode() for r in docs.collect()], coded.table())
    shares = np.bincount(coded.slice_of(words)[v].astype(int), minlength=wm.SLICES) / len(v)
    assert shares.max() < 1.15 / wm.SLICES


def test_short_codes_change_no_score(spark, monkeypatch):
    docs = zipf_docs(spark, 60)
    def scores():
        model = wm.WordModel(docs.filter("doc < 40").select("t"))
        return {r.doc: r.h for r in model.score(docs).collect()}
    found = scores()
    monkeypatch.setattr(wm, "SHORT", 0)
    assert scores() == pytest.approx(found, rel=1e-9)


def test_texts_are_read_once_to_deal_them(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(len(b))
            yield b

    docs = zipf_docs(spark, 20).mapInArrow(seen, "doc long, t binary")
    wm.dealing_of(docs)
    assert read.value == 20


def test_a_worker_drops_what_operators_before_kept():
    made = lambda name: kept(name, object)
    first = made("one-a"), made("one-b")
    assert (made("one-a"), made("one-b")) == first
    other = made("two:x")
    assert made("two:x") is other and made("one-a") is not first[0]


def test_texts_are_cut_once_to_score_them(spark, monkeypatch):
    monkeypatch.setattr(wm, "SLICES", 3)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(len(b))
            yield b

    docs = zipf_docs(spark, 40)
    model = wm.WordModel(docs.filter("doc < 25"))
    apart = {r.doc: r.h for r in model.score(docs.mapInArrow(seen, "doc long, t binary")).collect()}
    assert read.value == 40
    marked = wm.WordModel(docs.selectExpr("doc", "t", "doc < 25 as counted"))
    assert {r.doc: r.h for r in marked.score(last=True).collect()} == pytest.approx(apart, rel=1e-9)
