from __future__ import annotations

import math
import random

import pytest

from loadcast.llm import licenses as lic


def brute(docs, templates, shingle=5, containment=0.8):
    out = {}
    shapes = {n: c for c, own in lic.classes_of(templates, shingle, containment, 1e-6).items() for n, _ in own}
    for d, t in docs:
        w = lic.words_of(t or "")
        for name, text in templates:
            shape = shapes[name]
            want = set(lic.shingles_of(lic.words_of(text), shape.shingle))
            for start in range(0, len(w), shape.stride):
                held = set(lic.shingles_of(w[start:start + shape.width], shape.shingle)) & want
                if len(held) / len(want) >= containment:
                    n, share, first = out.get((d, name), (0, 0.0, start))
                    out[d, name] = (n + 1, max(share, len(held) / len(want)), first)
    return out


@pytest.mark.parametrize("limit", [lic.MAX_SHINGLES, 30])
def test_matches_brute_force(spark, limit):
    rng = random.Random(8)
    names = dict(lic.TEMPLATES)
    noise = lambda n: " ".join(rng.choice(["the", "license", "of", "version", "2", "under", "licensed", "é"]) for _ in range(n))
    docs = [(i, f"{noise(rng.randrange(60))} {rng.choice(list(names.values()))} {noise(rng.randrange(60))}") for i in range(40)]
    grant = names["MIT-grant"].split()
    docs += [(50, " ".join(grant[:20] + ["whatever"] + grant[20:])), (51, " ".join(grant[:30])), (52, None), (53, ""), (54, "!!"),
             (55, "ALL  RIGHTS\nRESERVED"), (56, "all rights"), (57, noise(5000) + " All rights reserved. " * 3), (58, names["MIT"]), (58, names["MIT"])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "2 as words", "3 as template", "4 as band")
    got = {(r.doc_id, r.template): (r.n_windows, r.containment, r.first_word) for r in lic.scan(df, max_shingles=limit).collect()}
    want = brute(dict(docs).items(), lic.TEMPLATES)
    assert got == want
    assert lic.scan(df.limit(0)).count() == 0


def test_bands_guarantee_retrieval():
    for shape, own in lic.classes_of(lic.TEMPLATES, 5, 0.8, 1e-6).items():
        for _, s in own:
            need = math.ceil(0.8 * len(s))
            jaccard = need / (shape.width - shape.shingle + 1 + len(s) - need)
            assert (1 - jaccard) ** shape.bands <= 1e-6 * 1.0001 or jaccard == 1


def test_parts_hold_the_whole_text():
    for name, text in [("x", " ".join(f"w{i}" for i in range(n))) for n in (1, 127, 128, 129, 256, 1000)]:
        parts = lic.parts_of(name, text)
        assert {w for _, t in parts for w in t.split()} == set(text.split()) and all(len(t.split()) <= lic.PART for _, t in parts)
        assert len({n for n, _ in parts}) == len(parts) == -(-len(text.split()) // lic.PART)


def test_full_texts_and_headers_are_found(spark):
    known = lic.known_templates()
    assert len({n for n, _ in known}) == len(known)
    names = {n.partition("#")[0] for n, _ in known}
    assert {"MIT", "Apache-2.0", "BSD-3-Clause", "ISC", "MPL-2.0", "LGPL-3.0", "GPL-3.0", "CC0-1.0", "Unlicense", "CC-BY-SA-4.0-header", "AGPL-3.0-header"} <= names
    own = [(n, t) for n, t in known if n.partition("#")[0] in {"MIT", "BSD-3-Clause", "ISC", "CC-BY-SA-4.0-header", "MPL-2.0-header"}]
    docs = [(i, f"some words before it {t} and after") for i, (_, t) in enumerate(own)] + [(100, "an ordinary text about a house and a garden")]
    templates = spark.createDataFrame(own, "name string, text string")
    got = {(r.doc_id, r.template) for r in lic.scan(spark.createDataFrame(docs, "doc_id long, text string"), templates=templates).collect()}
    assert {(i, n) for i, (n, _) in enumerate(own)} <= got and not [d for d, _ in got if d == 100]


def test_full_set_matches_brute_force(spark):
    rng = random.Random(3)
    known = lic.known_templates()
    text = dict(known)
    some = [text[n] for n in ("MIT#1", "MIT#2", "ISC#1", "GPL-3.0#7", "GPL-3.0#8", "LGPL-2.1#3", "MPL-2.0-header", "proprietary")]
    docs = [(i, " ".join(x for t in rng.sample(some, 2) for x in ["before it", *(w for w in t.split() if rng.random() > 0.02), "and after"])) for i in range(12)]
    got = {(r.doc_id, r.template): (r.n_windows, r.containment, r.first_word)
           for r in lic.scan(spark.createDataFrame(docs, "doc_id long, text string"), templates=known).collect()}
    assert got == brute(docs, known)


def test_templates_without_words_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "word " * 300_000 + "All rights reserved."), (2, None)], "doc_id long, text string")
    assert lic.scan(docs, templates=[("none", "!!")]).count() == 0
    assert [(r.doc_id, r.template, r.first_word) for r in lic.scan(docs).collect()] == [(1, "proprietary", 300_000)]
    templates = spark.createDataFrame([("x", None), ("y", "All rights reserved.")], "name string, text string")
    assert [r.template for r in lic.scan(docs, templates=templates).collect()] == ["y"]
