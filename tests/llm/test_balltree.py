from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from loadcast.llm import balltree as bt

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, k=20):
    own = [(d, terms(t)) for d, t in docs]
    n_docs, total = sum(1 for _, w in own if w), sum(len(w) for _, w in own)
    df = {}
    for _, w in own:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, []).extend(terms(t))
    out = []
    for i, q in asked.items():
        scored = []
        for d, w in own:
            if w:
                m = 75 + (25 * len(w) * n_docs) // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * w.count(x)) // (1000 * w.count(x) + 12 * m))
                        for x in q if x in df)
                if s > 0:
                    scored.append((-s, d is None, d or 0))
        out += [(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = ["Ä", "the", "of", "1", "b2", "été", "X", "It", "日本"] + [f"w{k}" for k in range(300)]
    text = lambda c: " ".join(vocab[min(int(rng.expovariate(0.02)), len(vocab) - 1)] for _ in range(c))
    items = [(i, text(rng.randrange(1, 40))) for i in range(25)] + [(30, "Of OF the"), (31, None), (32, "... !"), (33, "unknownterm"), (5, text(9))]
    items += [items[2], (34, "w1 w1 W1 w299")]
    docs = [(i, text(rng.choice([1, 5, 60, 300]))) for i in range(n)]
    docs += [(900 + k, items[3][1]) for k in range(40)] + [(900, items[3][1])] * 3 + [(None, items[4][1]), (None, items[3][1]), (-4, None), (-5, ""), (-6, "!?"), (-7, items[7][1] * 400)]
    return docs, items


@pytest.mark.parametrize(("shard", "leaf", "block"), [(2048, 32, 1 << 17), (50, 2, 600)])
def test_rank_matches_brute_force(spark, shard, leaf, block):
    docs, items = corpus(2, 350)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).selectExpr("*", "1 as n", "'x' as terms", "2 as item_id")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as score")
    got = bt.rank(d, q, shard=shard, leaf=leaf, block_bytes=block).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, items)


def test_string_items(spark):
    docs, items = corpus(5, 60)
    items = [(f"q{i}", t) for i, t in items]
    got = bt.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), k=3).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, items, 3)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    cells = np.zeros((600, 400), np.int64)
    for topic in range(6):  # documents of a topic share most of their terms
        own = cells[topic * 100:topic * 100 + 100]
        own[:, topic * 60:topic * 60 + 60] = rng.integers(0, 10**9, 60) * (rng.random((100, 60)) < 0.8)
    cells[:, 399] = rng.integers(0, 14_000_000_000, 600)
    tree = bt.Tree(cells, 16)
    assert sorted(tree.order.tolist()) == list(range(600))
    for _ in range(50):
        t = rng.choice(400, 20, replace=False)
        c = rng.integers(1, 4, 20)
        for a, z, b in zip(tree.start, tree.stop, tree.bounds(t, c), strict=True):
            assert (tree.cells[a:z][:, t] @ c).max() <= b
    items = bt.Items([(1, b" ".join(b"t%d" % k for k in range(0, 60)))])
    items.weight = np.full(360, 1000)
    items.weight[:60] = 5000
    items.n_docs, items.n_terms = 600, 600 * 48
    row = np.repeat(np.arange(600), 48)
    term = np.concatenate([np.sort(rng.choice(60, 48, replace=False)) + 60 * (r % 6) for r in range(600)]).astype(np.int32)
    items.vocab = {}
    items.terms = [(np.arange(60), np.ones(60, np.int64))]
    best = [bt.Best(20)]
    leaves = bt.search_shard(items, best, np.arange(600), np.zeros(600, bool), np.full(600, 48), np.full(600, 48), term, np.ones(len(row), np.int64), 16)
    assert leaves <= 16 and (best[0].rows[2] % 6 == 0).all()  # of some 40 leaves, those of one topic


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert bt.rank(none, items).collect() == [] and bt.rank(some, items.limit(0)).collect() == []
    assert [tuple(r) for r in bt.rank(some, items).collect()] == brute([(1, "a b")], [(1, "a")])
