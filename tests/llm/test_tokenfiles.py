from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loadcast.llm import rans
from loadcast.llm import tokenfiles as tf
from loadcast.session import work_dir

BITS = ["Hello", "world's", "Ünï", "'s", "é", "́x", "a\x1cb", "!\x1c", "日本語", "12.5", "I'll", "***", "|", "a|b", "<|endoftext|>", "x..", "x—", "x—.", "x1", "x1!", "=x", "\x85", "ß"]
GAPS = [" ", " ", " ", "  ", "\n", "\n\n", " \n", "\t", "\t ", "\xa0", " ", " 　", "\r\n", "\x1f", ""]


def some_text(rng, n):
    if rng.random() < 0.4:  # single spaces and line feeds only
        return "".join(rng.choice(BITS) + rng.choice("   \n") for _ in range(n)).strip(" \n")
    return rng.choice(["", " ", "\n"]) + "".join(rng.choice(BITS) + rng.choice(GAPS) for _ in range(n))


def plain_ids(texts):
    tok = Tokenizer.from_file(public_tokenizers.path(tf.TOKENIZER))
    return [tok.encode(t or "", add_special_tokens=False).ids + [tf.END_ID] for t in texts]


def test_encoder_matches_tokenizer():
    rng = random.Random(4)
    texts = ["", None, "  ", "\n", " a ", "| |", " |"] + [some_text(rng, rng.randrange(1, 60)) for _ in range(400)]
    enc = tf.ByteEncoder(tf.TOKENIZER, cache=30)
    for s in range(0, len(texts), 17):
        part = texts[s:s + 17]
        for t, ids, want in zip(part, enc.encode([None if t is None else t.encode() for t in part]), plain_ids(part), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want[:-1], repr(t)


@pytest.mark.parametrize(("n", "kinds", "options"), [
    (1, 1, {}), (2, 2, {}), (70, 5, {}), (5000, 900, {"lanes": 4, "block": 300, "checkpoint": 7}), (150_000, 1, {}), (150_000, 40_000, {})])
def test_codec_round_trip(n, kinds, options):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % kinds * 37).astype("<u4")
    raw = rans.encode(ids, [None, 4], np.array([0, n]), part=2, seq=1, **options)
    s, = rans.segments(raw + b"\n")
    assert (s.ids() == ids).all() and s.doc_ids == [None, 4] and s.counts.tolist() == [0, n] and (s.part, s.seq) == (2, 1)
    for _ in range(20):
        a, z = sorted(rng.integers(0, n + 1, 2).tolist())
        assert (s.ids(a, z) == ids[a:z]).all()


def test_codec_size_is_near_entropy():
    ids = (np.random.default_rng(3).zipf(1.3, 400_000) % 2000).astype("<u4")
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    bits = -(p * np.log2(p)).sum() * len(ids)
    assert len(rans.encode(ids, [1], np.array([len(ids)]))) * 8 < 1.06 * bits


def test_damage_is_found():
    ids = (np.arange(60_000) ** 2 % 997).astype("<u4")
    raw = rans.encode(ids, [1], np.array([len(ids)])) + b"\n"
    for at in [0, 9, 60, 120, 400, len(raw) // 2, len(raw) - 2, len(raw) - 1]:
        bad = bytearray(raw)
        bad[at] ^= 0x14
        with pytest.raises(rans.Damaged):
            [s.ids() for s in rans.segments(bytes(bad))]
    with pytest.raises(rans.Damaged):
        rans.segments(raw[:-7])


def rows_of(seed, n):
    rng = random.Random(seed)
    rows = [(rng.randrange(-50, 10_000), some_text(rng, rng.randrange(0, 40))) for _ in range(n)]
    return rows + [(7, None), (8, ""), (9, "again"), (9, "again"), (10, "one"), (10, "other"), (None, "no id"), (11, some_text(rng, 20_000))]


def test_files_match_brute_force(spark):
    rows = rows_of(1, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "1 as part", "'x' as ids", "2 as h", "3 as n")
    got = sorted(map(tuple, tf.report(df, per_segment=900, per_part=9000, per_file=2, lanes=8, block=512, checkpoint=16)
                     .select("start", "doc_id", "n_tokens", "ids_crc32").collect()), key=lambda r: r[0])
    ids = [(d, i) for (d, _), i in zip(rows, plain_ids([t for _, t in rows]), strict=True)]
    want = sorted((-1e9 if d is None else d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids)
    assert sorted((-1e9 if d is None else d, n, c) for _, d, n, c in got) == want
    at, last = 0, -1e9
    for start, d, n, _ in got:  # gapless, ascending
        assert start == at and (last if d is None else d) >= last
        at, last = at + n, last if d is None else d


def test_range_of_tokens(spark):
    df = spark.createDataFrame(rows_of(2, 80), "doc_id long, text string")
    path = f"{work_dir(spark, 'token-test')}/t"
    tf.write(df, path, per_segment=700, per_part=6000, per_file=2, lanes=8, block=512, checkpoint=16)
    rows = tf.read(spark, path).orderBy("part", "seq", "pos").collect()
    whole = np.frombuffer(b"".join(bytes(r["ids"]) for r in rows), "<u4")
    for a, z in [(0, 5), (100, 4000), (len(whole) - 3, len(whole) + 9), (50, 50)]:
        own = b"".join(bytes(r["ids"]) for r in tf.read_range(spark, path, a, z).orderBy("start").collect())
        assert (np.frombuffer(own, "<u4") == whole[a:z]).all()


def test_empty_table(spark):
    assert tf.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
