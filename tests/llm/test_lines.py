from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from loadcast.llm import lines as ln


def mask(line, least=5):
    if line.count(" ") + 1 < least:
        return line
    out = re.sub("[^ ]*[0-9][^ ]*", "<*>", line)
    return out if re.search("[0-9]", line) and 2 * out.count("<*>") <= line.count(" ") + 1 else line


def brute(docs, lead=4, least=5, merge=8, sim=0.8):
    where = defaultdict(set)
    for d, t in docs:
        if d is not None:
            for x in (t.split("\n") if t is not None else []):
                if x.strip(" \t\r"):
                    where[mask(x)].add(d)
    keep = {m: min(ds) for m, ds in where.items() if len(ds) > 1}
    leaves = defaultdict(list)
    for m in where:
        if m.count(" ") + 1 >= least:
            leaves[m.count(" ") + 1, tuple(m.split(" ")[:lead])].append(m)
    for (n, _), ms in leaves.items():
        if len(ms) < 2 or len(set().union(*(where[m] for m in ms))) < 2:
            continue
        opened = defaultdict(list)
        for m in ms:
            t = m.split(" ")
            for p in range(lead, n):
                opened[p, tuple(t[:p]), tuple(t[p + 1:])].append(m)
        for own in opened.values():
            ds = set().union(*(where[m] for m in own))
            if len(own) > 1 and len(ds) > 1:
                for m in own:
                    keep[m] = min(keep.get(m, min(ds)), min(ds))
        if n < merge:
            continue
        fixed = [next((w for w, c in Counter(m.split(" ")[i] for m in ms).items() if 2 * c > len(ms)), None) for i in range(n)]
        if sum(w is not None for w in fixed) < sim * n:
            continue
        own = [m for m in ms if sum(a == b for a, b in zip(m.split(" "), fixed)) >= sim * n]
        ds = set().union(*(where[m] for m in own)) if own else set()
        if len(ds) > 1:
            for m in own:
                keep[m] = min(keep.get(m, min(ds)), min(ds))
    out = []
    for d, t in docs:
        if t is None:
            out.append((d, None))
            continue
        out.append((d, "\n".join(x for x in t.split("\n") if d is None or mask(x) not in keep or keep[mask(x)] == d)))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(6)
    vocab = [f"w{c}" for c in "abcdefghij"] + ["12", "x9"]
    pool = [" ".join(rng.choice(vocab) for _ in range(rng.choice([3, 5, 9, 20]))) for _ in range(40)]
    pool += ["user logged in from host alpha at noon today ok", "user logged in from host beta at noon today ok",
             "user logged in from host 17 at noon today ok", "user logged in to quite other things we never saw"]
    passage = " ".join("abcdefg"[i % 7] + "word" for i in range(60))
    docs = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 8)) + [f"unique line of doc {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} zz yy"])) for i in range(60)]
    docs += [(100, passage), (101, "own text stays here alone\n" + passage), (102, None), (103, ""), (104, "\n\n"), (105, passage[:-5] + "other"),
             (None, passage), (106, "only once in a lifetime here\nonly once in a lifetime here"), (107, "1 2 3 4 5 6 7"), (108, "1 2 3 4 5 6 8")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as doc", "2 as version", "3 as line", "4 as _gone", "5 as h1")
    out = ln.drop_recurring(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.text or "", r.text is None) for r in out.collect())
    want = sorted(((d if d is not None else -1), t or "", t is None) for d, t in brute(docs))
    assert got == want
    text = {d: t for d, t, _ in got}
    assert text[100] == passage and text[101] == "own text stays here alone" and text[105] == "" and text[-1] == passage


def test_repeated_rows_and_empty(spark):
    docs = [(1, "a line of five words\n \t"), (1, "a line of five words\n \t"), (2, "a line of five words\n \t")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = ln.drop_recurring(df, counts=True).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in rows) == [(1, docs[0][1], 2, 0), (1, docs[0][1], 2, 0), (2, " \t", 2, 1)]
    assert ln.drop_recurring(df.limit(0)).count() == 0


def test_one_line_in_a_third_of_all_documents(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('own text ', id, 'k of document with words\\n', if(id % 3 = 0, 'the common line of many docs', '')) as text")
    out = ln.drop_recurring(docs)
    assert out.filter("text like '%common line%'").collect()[0].doc_id == 0
    assert out.filter("text like '%common line%'").count() == 1


def test_several_templates_in_a_leaf_and_short_lines(spark):
    names = [a + b for a in "abcdefgh" for b in "ijklmnop"]
    family = [f"the server was started by {x} on the main host" for x in names[:40]]
    others = [f"the server was started {x}q {x}r {x}s {x}t host {x}u" for x in names[:60]]  # same leaf, more of them
    five = [f"we have read this {x}" for x in names[:10]]
    docs = [(i, x) for i, x in enumerate(family)] + [(100 + i, x) for i, x in enumerate(others)] + [(200 + i, x) for i, x in enumerate(five)]
    docs += [(300 + i, "All rights reserved.\n\u4e00\u4e8c\u4e09\nPage 3") for i in range(10)] + [(400, "Page 4"), (401, "word " * 30_000 + "end")]
    got = {r.doc_id: r.text for r in ln.drop_recurring(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == dict(brute(docs))
    assert [d for d in range(40) if got[d]] == [0] and all(got[100 + i] for i in range(60)) and [d for d in range(200, 210) if got[d]] == [200]
    assert got[300] == docs[110][1] and got[305] == "" and got[400] == "Page 4" and got[401]


def test_tokens_are_compared_in_full(spark):
    """Lines of a leaf with two tokens that differ are no instances, whatever their hashes' low bits."""
    docs = [(i, f"one two three four {i:05d}x".replace("0", "o").translate(str.maketrans("123456789", "abcdefghi")) + f" six seven {chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, ln.drop_recurring(df).collect())) == sorted(brute(docs)) == docs


def test_shuffled_and_broadcast_sides_agree(spark):
    docs = [(i % 50, f"the server was started by {chr(97 + i % 26)} on host {i}\nwe have read this {chr(97 + i % 7)}") for i in range(120)]
    keyed = spark.createDataFrame(docs, "doc long, text string").selectExpr("doc", "xxhash64(text) as version", "text")
    places = ln.placed_lines(keyed)
    few, many = (sorted(map(tuple, ln.recurring_templates(keyed, places, broadcast_rows=n).collect())) for n in (1000, 0))
    assert few == many and few
