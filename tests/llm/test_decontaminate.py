from __future__ import annotations

import random
import re

import pytest

from loadcast.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, n=10):
    out = {}
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, x in items:
            y = words(x)
            size = min(n, len(y))
            wins = {tuple(y[s:s + size]) for s in range(len(y) - size + 1)} if size else set()
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in wins:
                    hit.update(range(s, s + size))
                    found.add(str(i))
        out.setdefault(d, []).append((len(w), len(hit), ",".join(sorted(found))))
    return out


@pytest.mark.parametrize("max_words", [dc.MAX_WORDS, 40])
def test_scan_matches_brute_force(spark, max_words):
    rng = random.Random(5)
    vocab = ["Ä", "the", "of", "1", "b2", "été", "X", "it's", "no"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(1, text(14)), (2, "Of the"), (3, None), (4, "..."), (5, text(30)), (5, text(12)), (10, "of THE")]
    docs = [(1, text(200) + " " + items[0][1].upper().replace(" ", "-") + " " + text(30)), (2, None), (3, ""),
            (4, items[4][1]), (4, items[4][1]), (5, "of"), (7, items[4][1] + " ... " + text(20) + " " + items[5][1]), (6, text(3000) + " " + items[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as t", "'x' as items")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in dc.report(df, bench, max_words=max_words).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_hit, r.n_items, r.items_sha256))
    import hashlib
    for d, rows in brute(docs, items).items():
        want = [(n, h, len([x for x in s.split(",") if x]), hashlib.sha256(s.encode()).hexdigest()) for n, h, s in rows]
        assert [(a, b, len(set(range(c))), x) for a, b, c, x in got[d]] == want, d


def test_remove_hits(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    clean = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = [(1, f"{clean}. Ç Alpha, beta gamma delta epsilon zeta eta theta iota kappa, lambda! {clean}", "en"), (2, clean, "en"),
            (3, item, "en"), (4, None, None), (5, "", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    out = {r.doc_id: r.text for r in dc.remove_hits(df, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert out == {1: f"{clean}. Ç ! {clean}", 2: clean, 4: None, 5: ""}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.n_hit for r in dc.report(docs, none).collect()] == [0]
    assert dc.report(docs.limit(0), none).count() == 0
