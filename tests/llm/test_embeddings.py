from __future__ import annotations

import numpy as np
import pytest

from loadcast.llm import embeddings as em


def brute(rows, threshold):
    ok, v = [], []
    for _, x, label in rows:
        good = label is not None and x is not None and len(x) and all(y is not None and np.isfinite(y) for y in x) and any(x)
        ok.append(bool(good))
        v.append(np.array(x, np.float64) if good else None)
    n = len(rows)
    links = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(v[i]) == len(v[j])
              and v[i] @ v[j] / np.linalg.norm(v[i]) / np.linalg.norm(v[j]) >= threshold] for i in range(n)]
    comp = [None] * n
    for i in range(n):
        if comp[i] is None:
            todo, seen = [i], {i}
            while todo:
                for j in links[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
            for j in seen:
                comp[j] = least
    return sorted(((r[0] if r[0] is not None else -1), len(k), (c if c is not None else -1)) for r, k, c in zip(rows, links, comp, strict=True))


@pytest.mark.parametrize("block", [em.BLOCK, 7])
def test_near_duplicates_match_brute_force(spark, block):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 16))
    rows = [(i, (base[i % 30] + rng.normal(size=16) * s).astype(np.float32).tolist(), i % 2)
            for i, s in enumerate(np.repeat([0.0, 0.05, 0.12, 0.2], 30))]
    rows += [(500 + i, rows[0][1], 0) for i in range(5)] + [(500, rows[0][1], 0), (None, rows[0][1], 0)]
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 16, 0), (603, [float("nan")] + [1.0] * 15, 0), (604, [None] + [1.0] * 15, 0),
             (605, rows[0][1], None), (606, [float("inf")] * 16, 1), (607, rows[0][1][:8], 0), (608, (np.array(rows[0][1]) * 3).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as cid", "2 as n", "3 as least")
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id if r.component_id is not None else -1)
                 for r in em.near_duplicates(df, block=block).collect())
    want = brute([(a, None if b is None else [None if x is None else float(np.float32(x)) for x in b], c) for a, b, c in rows], 0.98)
    assert got == want
    assert em.near_duplicates(df.limit(0)).count() == 0


def test_bound_is_rigorous_and_prunes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 64))
    y = np.concatenate([x[:50] + rng.normal(size=(50, 64)) * 0.1, rng.normal(size=(200, 64))])
    i, j, recomputed = em.tile_pairs(x, y, 0.98)
    cos = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(map(tuple, np.argwhere(cos >= 0.98).tolist()))
    assert recomputed < 200
