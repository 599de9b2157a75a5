from collections import defaultdict

from corpora import awkward, empty, prose

from furrow.llm import mixing


def water(sizes, weights, percent, most):
    """Shares the excess again and again until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, free = sum(sizes.values()) * percent / 100, {}, set(names)
    while free:
        each = left / sum(weight[s] for s in free)
        over = {s for s in free if each * weight[s] >= most * sizes[s]}
        if not over:
            target |= {s: each * weight[s] for s in free}
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over
    return target


def corpus(spark):
    rows = [(i, prose(i, 5 + i * 7 % 90), f"s{i * i % 7}" if i % 11 else None) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_copies_and_reruns(spark):
    df = corpus(spark)
    found = mixing.mix(df).collect()
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
        assert r.size == len(prose(r.doc_id, 5 + r.doc_id * 7 % 90).split()) and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    wanted = water(sizes, (5, 2, 1), 150, 2)
    assert all(abs(targets[s] - wanted[s]) < 1e-6 * (1 + wanted[s]) for s in sizes)
    assert all(abs(taken[s] - targets[s]) <= 95 for s in sizes)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))


def test_rows_of_the_mix(spark):
    df = awkward(spark, [prose(i, 20 + i) for i in range(30)])
    rows = mixing.mixed_rows(df)
    assert rows.columns == df.columns
    counted = defaultdict(int)
    for r in rows.collect():
        counted[r.doc_id, r.source, len((r.text or "").split())] += 1
    wanted = defaultdict(int)
    for r in mixing.mix(df).collect():
        wanted[r.doc_id, r.source, r.size] += r.copies
    assert dict(counted) == {k: v for k, v in wanted.items() if v}
    assert mixing.mix(df).count() == df.count()
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_rows(empty(spark)).count() == 0


def test_no_python_on_the_way(spark):
    for df in (mixing.mix(corpus(spark)), mixing.mixed_rows(corpus(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
