import numpy as np

from furrow.llm import embedding_dedup

SHAPE = "vec_id long, embedding array<float>, label int, rep string, signs int"


def brute(rows, least=0.98):
    good = [
        (i, np.array(v, dtype=float), label)
        for i, v, label, *_ in rows
        if i is not None and label is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    links, parent = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, (i, x, p) in enumerate(good):
        for j, y, q in good[:a]:
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i] += 1
                links[j] += 1
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return sorted((i, links[i], find(i), find(i) == i) for i in links if i is not None)


def test_agrees_with_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    r = np.random.default_rng(3)
    rows = []
    for g in range(8):
        base = r.standard_normal(32)
        for _ in range(2 + 5 * g):
            rows.append((len(rows), (base + r.standard_normal(32) * 0.09).astype(np.float32).tolist(), g % 3))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(5)]
    rows += [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] * 32, 1), (903, rows[0][1], None), (904, [None, *rows[0][1][1:]], 0)]
    rows += [(905, rows[0][1][:5], 0), (906, [], 0), (907, [2 * x for x in rows[0][1]], 0)]
    df = spark.createDataFrame([(*x, "x", 1) for x in rows] + [(None, rows[0][1], 0, "x", 1)], SHAPE)
    found = embedding_dedup.near_copies(df).collect()
    assert sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in found if x.vec_id is not None) == brute(rows)
    assert [(x.n_links, x.component_id, x.kept) for x in found if x.vec_id is None] == [(0, None, True)]
    assert embedding_dedup.near_copies(df.limit(0)).count() == 0
