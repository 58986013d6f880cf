from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
from test_decontaminate import words
from test_lines import brute as lines_brute
from test_simhash import brute_fp, components
from tokenizers import Tokenizer

import corpus_pipeline as cp
from loadcast.llm import quality
from loadcast.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def cut_hits(text, items, n=10):
    """Text without hit words by definition; None if over half is hit."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    spans = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
    w, hit = [low[a:b] for a, b in spans], set()
    for y in map(words, items):
        size = min(n, len(y))
        wins = {tuple(y[s:s + size]) for s in range(len(y) - size + 1)} if size else set()
        for s in range(len(w) - size + 1):
            if tuple(w[s:s + size]) in wins:
                hit.update(range(s, s + size))
    if 2 * len(hit) > len(w):
        return None
    out, last, i = [], 0, 0
    while i < len(w):
        if i in hit:
            j = i
            while j + 1 in hit:
                j += 1
            out.append(text[last:spans[i][0]])
            last, i = spans[j][1], j
        i += 1
    return "".join(out) + text[last:]


def test_stages_match_brute_force(spark):
    docs = cp.table(spark, SF, "documents")
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_neardup", "benchmark_decontamination", "bestfit_packing"]
    rows = lambda df: {r.doc_id: r for r in df.collect()}
    before = rows(docs)
    state, found = docs, {}
    for name, stage in cp.STAGES[:-1]:
        state = cp.written(stage(spark, state, SF), name)
        assert state.columns == docs.columns
        found[name] = rows(state)

    judged = {r.row: r for r in quality.judged(docs, cp.table(spark, SF, "labels"), row=docs["doc_id"]).collect()}
    kept = {d for d, r in judged.items() if r.perplexity is not None and r.perplexity <= r.threshold}
    assert set(found["quality_classifier"]) == kept
    assert all(r == before[d] for d, r in found["quality_classifier"].items())

    want = dict(lines_brute([(d, r.text) for d, r in found["quality_classifier"].items()]))
    assert {d: r.text for d, r in found["line_dedup"].items()} == want

    ids = sorted(want)
    comp = components([brute_fp(want[d]) for d in ids], 3)
    assert sorted(found["simhash_neardup"]) == sorted(ids[c] for c in set(comp))

    items = [r.text for r in cp.table(spark, SF, "benchmark").collect()]
    clean = {d: cut_hits(r.text, items) for d, r in found["simhash_neardup"].items()}
    assert {d: r.text for d, r in found["benchmark_decontamination"].items()} == {d: t for d, t in clean.items() if t is not None}

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = []
    for d, r in found["benchmark_decontamination"].items():
        t = np.array(tok.encode(r.text, add_special_tokens=False).ids + [1], "<u4")
        pieces += [(d, k // 4096, len(t[k:k + 4096]), zlib.crc32(t[k:k + 4096].tobytes())) for k in range(0, len(t), 4096)]
    out = cp.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in out) == sorted(pieces)
    used = {r.sequence_id for r in out}
    total = sum(r.length for r in out)
    assert -(-total // 4096) <= len(used) <= -(-total // 4096) + 2


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, x) for x in range(1001, 1500)] + [(7, 7), (3, 4), (4, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 201), 0), **dict.fromkeys(range(1001, 1500), 1000)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
