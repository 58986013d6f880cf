from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.llm import toxicity as tx

SF = "/root/testdata/sf0.1"


def brute_marginals(odds, trans):
    """Sum over all label sequences, the state before the text being 0."""
    n, e, t = len(odds), np.exp(odds), np.exp(trans)
    total, one, two = 0.0, np.zeros(n), np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        w, prev = 1.0, 0
        for i, v in enumerate(y):
            w *= t[prev, v] * (e[i] if v else 1.0)
            prev = v
        total += w
        one += w * np.array(y)
        two += w * np.array([y[i] and (i > 0 and y[i - 1]) for i in range(n)])
    return one / total, two / total


@pytest.mark.parametrize("segment", [128, 3, 1])
def test_marginals(monkeypatch, segment):
    monkeypatch.setattr(tx, "SEGMENT", segment)
    rng = np.random.default_rng(4)
    lengths = np.array([5, 0, 9, 1, 7, 0])
    odds, trans = rng.normal(size=lengths.sum()) * 2, rng.normal(size=(2, 2))
    p, both = tx.marginals(odds, lengths, trans, pairs=True)
    at = 0
    for n in lengths:
        want, pairs = brute_marginals(odds[at:at + n], trans)
        assert np.allclose(p[at:at + n], want) and np.allclose(both[at:at + n], pairs)
        at += n


def test_long_text_equals_one_segment(monkeypatch):
    rng = np.random.default_rng(5)
    odds, trans = rng.normal(size=5000) * 3, np.array([[0.0, -2.0], [-1.0, 1.0]])
    cut = tx.marginals(odds, np.array([5000]), trans)
    monkeypatch.setattr(tx, "SEGMENT", 5000)
    assert np.allclose(cut, tx.marginals(odds, np.array([5000]), trans))


def test_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = tx.report(docs, labels).cache()
    assert out.count() == docs.count()
    held = out.join(labels, "doc_id").filter("held_out")
    r = held.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("acc"),
                 F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("fpr"), F.min("score").alias("a"), F.max("score").alias("b")).first()
    assert r["acc"] > 0.97 and r["fpr"] < 0.01 and 0 <= r["a"] <= r["b"] <= 1
    assert out.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 5 == 0)).count() == 0


def test_spans_and_edges(spark):
    # Letters only: the tokeniser keeps runs of letters.
    name = lambda i: "q" + "".join("abcdefghij"[int(c)] for c in f"{i:04d}")
    words = lambda i: " ".join(name((i * 37 + j * j) % 997) for j in range(40))
    docs = [(i, words(i) + (f" Nasty{'abcdef'[i % 6]}! " if i % 3 == 0 else " ") + words(i + 1)) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(3, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    extra = [(1000, None), (1001, ""), (1002, "é nastyq \U0001F600 Nastyc!"), (1003, words(5) * 200), (1003, words(5) * 200), (1004, "12 34")]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string").selectExpr("*", "1 as score", "2 as t", "3 as spans")
    rows = tx.report(df, labels).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) + len(extra)
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(600))
    assert [extra[2][1][s.start:s.end] for s in got[1002].spans][-1] == "Nastyc"
    assert got[1000].predicted == got[1001].predicted == got[1003].predicted == got[1004].predicted == 0
    assert got[1000].score == got[1001].score == got[1004].score
    assert {r.score for r in tx.report(df, labels.limit(0)).collect()} == {0.0}
    assert tx.report(df.limit(0), labels).count() == 0
