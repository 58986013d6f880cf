from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loadcast.llm import packing as pk


def fits(lengths, sequence, offset, capacity):
    for s in set(sequence.tolist()):
        own = sorted((o, n) for q, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist(), strict=True) if q == s)
        at = 0
        for o, n in own:
            assert o == at
            at += n
        assert at <= capacity


@pytest.mark.parametrize("kind", ["mixed", "large", "small", "full", "none", "thirds"])
def test_pack(kind):
    rng = np.random.default_rng(1)
    lengths = {"mixed": np.minimum(4096, rng.lognormal(6, 1.1, 3000).astype(int) + 1), "large": rng.integers(1400, 4097, 800),
               "small": rng.integers(1, 400, 2000), "full": np.full(50, 4096), "none": np.zeros(0, int), "thirds": np.full(31, 1365)}[kind]
    sequence, offset = pk.pack(lengths)
    fits(lengths, sequence, offset, 4096)
    least = -(-int(lengths.sum()) // 4096)
    used = len(set(sequence.tolist()))
    firstfit = []
    for n in sorted(lengths.tolist(), reverse=True):
        k = next((k for k, room in enumerate(firstfit) if room >= n), None)
        if k is None:
            firstfit.append(4096 - n)
        else:
            firstfit[k] -= n
    assert least <= used <= max(least + 2, len(firstfit) * 1.02 + 1)


def test_encoder_matches_tokenizer():
    rng = random.Random(4)
    bits = ["Hello", "world's", "Ünï", "ΣΑΣ", "é", "́x", "a\x1cb", " ", "日本語", "12.5", "don't", "***", "\t", "\n\n", "x y", "ß", "İ", "fi", "|", "a|b", "||", "<|endoftext|>", "<|STARTOFTEXT|>", "HELLO", "one.", "one,", "1.", "x..", ".", ",", "é,", "s'.", "don't,", "<|endoftext|>."]
    texts = ["", None, "  "] + [" ".join(rng.choice(bits) for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    enc, tok = pk.WordEncoder(pk.TOKENIZER, cache=20), Tokenizer.from_file(public_tokenizers.path(pk.TOKENIZER))
    for s in range(0, len(texts), 17):
        part = texts[s:s + 17]
        got = enc.encode([None if t is None else t.encode() for t in part])
        for t, ids in zip(part, got, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t or "", add_special_tokens=False).ids, t


def test_packed_documents(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "of", "Tokenizer", "Straße", "été."]) for _ in range(n)) for n in [3, 9000, 40, 700, 2500, 12, 30000]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(50, None), (51, ""), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as piece", "2 as ids", "3 as shard")
    tok = Tokenizer.from_file(public_tokenizers.path(pk.TOKENIZER))
    want = []
    for d, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for k in range(0, len(ids), 4096):
            want.append((d, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())))
    out = pk.packed(df, per_shard=5).collect()
    assert sorted(tuple(r)[:5] for r in out) == sorted(want)
    fits(np.array([r.length for r in out]), np.array([r.sequence_id for r in out]), np.array([r.offset for r in out]), 4096)
    assert pk.packed(df.limit(0)).count() == 0

    distinct = df.filter("doc_id <> 3")
    placed = pk.packed(distinct)
    seqs = {r.sequence_id: bytes(r.ids) for r in pk.token_sequences(pk.pieces(distinct), placed).collect()}
    for r in placed.collect():
        own = seqs[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)]
        assert zlib.crc32(own) == r.ids_crc32
