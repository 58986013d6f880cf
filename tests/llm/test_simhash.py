from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from loadcast.llm import simhash as sh
from loadcast.llm.components import connected_components


def brute_fp(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(codes, bits):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "A b", "a\x0bB\x1cc É d", "x " * 5000, "Zu und. Der\nDie ß 日本"])
def test_fingerprint(text):
    assert sh.fingerprint((text or "").encode()) == brute_fp(text)


def test_fingerprint_of_long_text(monkeypatch):
    rng = random.Random(1)
    text = " ".join(str(rng.randrange(9999)) for _ in range(4000))
    monkeypatch.setattr(sh, "_BLOCK", 100)
    assert sh.fingerprint(text.encode()) == brute_fp(text)


@pytest.mark.parametrize("tuning", [{}, {"shard": 16, "cell": 7, "sample": 4000}])
def test_links_are_exact(spark, tuning):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(300)]
    near = [c ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4]))) for c in base for _ in range(2)]
    dense = [base[0] ^ rng.getrandbits(6) for _ in range(60)]
    codes = sorted({*base, *near, *dense, 0, 7, (1 << 64) - 1})
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.node: r.component for r in connected_components(sh.link_fingerprints(df, **tuning)).collect()}
    want = components(codes, 3)
    groups = {}
    for x, c in zip(signed, want, strict=True):
        groups.setdefault(c, set()).add(x)
    found = {}
    for x in signed:
        found.setdefault(got.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_groups_and_edges(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(9, long), (4, long.upper()), (12, long + " end"), (5, None), (6, ""), (7, "other text here"), (None, long), (7, "other text here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as id", "3 as component_id")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in sh.near_duplicates(df).collect())
    assert got == [(-1, 4), (4, 4), (5, 5), (6, 5), (7, 7), (7, 7), (9, 4), (12, 4)]
    kept = sh.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 4, 5, 7, 7]
    assert sh.near_duplicates(df.limit(0)).count() == 0
