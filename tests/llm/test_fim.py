from __future__ import annotations

import hashlib
import random
import re

import pytest

from loadcast.llm import fim


def brute(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, z = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:z], lines[z:]))
    if h[3] % 100 < spm_rate:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    bits = ["été ", "line\n", "\n", "日本", "𝒳", "<", "P", "S>", "word ", "<S", "\r\n", "x"]
    out = [None, "", "\n", "\n\n\n", "one line", "a\nb", "<P>", "a<M>\n", "x<S", "<\nP>"]
    out += ["".join(rng.choice(bits) for _ in range(rng.choice([1, 3, 40, 900]))) for _ in range(400)]
    passage = "".join(f"shared passage {k} of many documents\n" for k in range(300))
    out += [passage[rng.randrange(100):] + "".join(rng.choice(bits[:5]) for _ in range(rng.randrange(300))) + passage for _ in range(20)]
    out += ["a" * 100_000, "é\n" * 60_000, passage * 150, passage * 5 + "<P>" + passage * 5]
    return out


def test_matches_brute_force_and_restores(spark):
    own = texts()
    rows = list(enumerate(own)) + [(3, own[40]), (None, "no\nid\n"), (-5, "negative\nid\nhere")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as form", "2 as output")
    done = fim.fill_in_middle(df)
    back = done.select("*", fim.restored(done["output"], done["form"]).alias("text"))
    got = [tuple(r) for r in back.collect()]
    assert sorted(map(repr, got)) == sorted(repr((d, *brute(d, t), t or "")) for d, t in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_rates(spark):
    df = spark.createDataFrame([(i, f"a{i}\nb\nc\n") for i in range(300)], "doc_id long, text string")
    for rate, spm in [(0, 50), (40, 100), (70, 0)]:
        got = sorted(tuple(r) for r in fim.fill_in_middle(df, rate=rate, spm_rate=spm).collect())
        assert got == sorted((i, *brute(i, f"a{i}\nb\nc\n", rate, spm)) for i in range(300))


@pytest.mark.parametrize("most", [0, 2000, 1 << 20])
def test_memo_of_any_size_gives_the_same(most):
    memo = fim.Memo(most)
    for d, t in enumerate(texts()):
        n, form, p, m, out = fim.transform(d, (t or "").encode(), memo)
        assert (n, form, p, m, out.decode()) == brute(d, t)


def test_shared_passages_share_chunks():
    rng = random.Random(8)
    passage = bytes(rng.randrange(97, 123) for _ in range(40_000))
    memo, ahead = fim.Memo(), [b"", b"x", b"some words before it\n" * 9]
    for a in ahead:
        fim.Text(a + passage, memo)
    chunks = len(fim.boundaries(passage))
    assert memo.hits >= 2 * (chunks - 3)
    sizes = [z - a for a, z in zip([0, *fim.boundaries(passage)], fim.boundaries(passage), strict=False)]
    assert max(sizes) <= fim.MOST and min(sizes[:-1]) >= fim.LEAST and sum(sizes) == len(passage)


def test_empty_table(spark):
    assert fim.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
