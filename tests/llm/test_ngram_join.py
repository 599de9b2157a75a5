import random

import numpy as np
import pytest
from corpora import awkward, empty, prose

from furrow.llm import ngram_join
from furrow.llm.common import shingle_set
from furrow.llm.components import connected_components


def brute(rows, k, percent):
    """(id, n, component, links) of each row by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words = [w for w in words.replace("\t", " ").replace("\n", " ").split(" ") if w]
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    parent = {i: i for i, _ in rows if i is not None}
    links = [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                parent[y] = x
    return sorted(
        (i if i is not None else -1, len(s), find(i) if i is not None else -1, n) for (i, _), s, n in zip(rows, sets, links)
    )


def edited(text, n, seed):
    r = random.Random(seed)
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def got(df, k, percent):
    """The rows with links; without counting them the components are the same."""
    none = lambda x: -1 if x is None else x
    counted = ngram_join.jaccard_components(df, k=k, percent=percent, count_links=True).collect()
    rows = sorted((none(r.id), r.n_shingles, none(r.component_id), r.n_links) for r in counted)
    plain = ngram_join.jaccard_components(df, k=k, percent=percent).collect()
    assert sorted((none(r.id), r.n_shingles, none(r.component_id)) for r in plain) == [r[:3] for r in rows]
    return rows


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_matches_brute_force_on_copies_chains_and_common_lines(spark, k, percent):
    line = "this line stands in every single document of the whole set " * 2
    base = [prose(s, 60 + 9 * s) for s in range(6)]
    texts = [line + t for t in base]
    for s, t in enumerate(base):
        texts += [edited(line + t, e, 10 * s + e) for e in (1, 1, 2, 2, 3, 5)]
    texts += [texts[0]] * 3 + [texts[1].upper(), "a b", "A  b", "a"]
    rows = [(500 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, k, percent) == brute(rows, k, percent)


def test_awkward_rows_match_brute_force(spark):
    t = prose(8, 70)
    df = awkward(spark, [t, edited(t, 1, 1), t])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(df, 3, 90) == brute(rows, 3, 90)
    assert ngram_join.jaccard_components(empty(spark)).count() == 0
    kept = ngram_join.one_of_each(df, k=3, percent=90)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "None", "None", "5", "6", "6", "7", "100"])


def test_an_id_with_two_texts_ties_them(spark):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(1, a), (2, a), (2, b), (3, b), (4, prose(3, 50))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(i, c) for i, _, c, _ in got(df, 3, 90)} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    assert [n for *_, n in got(df, 3, 90)] == [1, 1, 1, 1, 0]


def test_split_blocks_lose_no_link(spark, monkeypatch):
    base = prose(4, 200)
    rows = [(i, edited(base, i % 4, i)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    assert got(df, 3, 90) == brute(rows, 3, 90)


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_the_links_of_a_block(seed):
    r = np.random.default_rng(seed)
    base = r.choice(4000, 60, replace=False)
    sets = []
    for _ in range(40):
        own = np.unique(np.concatenate([r.choice(base, r.integers(50, 60), replace=False), r.integers(4000, 5000, r.integers(0, 5))]))
        sets.append(own.astype(np.int64))
    root, none = ngram_join.block_links(sets, np.zeros(40), False, 80)
    homes = [np.unique(r.integers(0, 60, r.integers(0, 4))) for _ in sets]
    weight = r.integers(1, 5, 40)
    _, sums = ngram_join.block_links(sets, np.zeros(40), False, 80, weight, homes)
    label, links = list(range(40)), [0] * 40
    for a in range(40):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = label[a], label[b]
                label = [min(x, y) if v in (x, y) else v for v in label]
                if not set(homes[a]) & set(homes[b]):
                    links[a] += weight[b]
                    links[b] += weight[a]
    assert root.tolist() == label and not none.any() and sums.tolist() == links


def test_many_near_copies_with_copies_of_their_own_count_each_link_once(spark, monkeypatch):
    base = [prose(s, 90) for s in (21, 22)]
    texts = [edited(base[i % 2], i % 5, i) for i in range(70)]
    texts += [t for i, t in enumerate(texts) for _ in range(i % 3)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df, 3, 80) == brute(rows, 3, 80)


def test_shingles_of_short_texts():
    assert len(shingle_set("a b", 3)) == 1 and len(shingle_set("", 3)) == 0 and len(shingle_set(None, 3)) == 0
    assert shingle_set("A b\tC", 3).tolist() == shingle_set("a b c", 3).tolist()
    assert shingle_set("a b", 3).tolist() != shingle_set("b a", 3).tolist()


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, j) for j in range(101, 130)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{j: 100 for j in range(101, 130)}}
    assert connected_components(df.limit(0)).count() == 0
