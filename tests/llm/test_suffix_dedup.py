from collections import defaultdict

import pandas as pd
import pytest
from corpora import awkward, empty, prose

from furrow.llm import suffix_dedup


def brute(rows, least, within):
    where = defaultdict(list)
    for i, text in rows:
        words = (text or "").lower().split()
        if i is not None:
            for s in range(len(words) - least + 1):
                where[tuple(words[s : s + least])].append((i, s))
    starts = defaultdict(set)
    for places in where.values():
        if len({i for i, _ in places}) > 1 or (within and len(places) > 1):
            for i, s in places:
                starts[i].add(s)
    out = []
    for i, own in starts.items():
        begin = last = None
        for s in sorted(own):
            if begin is None or s > last + least:
                if begin is not None:
                    out.append((i, begin, last + least))
                begin = s
            last = s
        out.append((i, begin, last + least))
    return sorted(out)


@pytest.mark.parametrize("within", [False, True])
def test_agrees_with_all_windows(spark, within):
    shared, hot = prose(50, 60, 9000), prose(51, 50, 9000)
    texts = [f"{prose(i, 40 + i, 9000)} {shared if i % 3 else prose(90 + i, 60, 9000)} {prose(i + 300, 30, 9000)}" for i in range(12)]
    texts += [f"{prose(i + 500, i, 9000)} {hot}" for i in range(40)]
    texts += [texts[0], texts[0].upper(), " ".join(shared.split()[:49]), "a " * 200, "a " * 90, prose(7, 120, 9000) + " " + prose(7, 120, 9000)]
    df = awkward(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    if not within:  # rows that share an id are one document
        rows = list(dict.fromkeys(rows))
    found = suffix_dedup.repeated_passages(df.repartition(9), within=within).collect()
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in found) == brute(rows, 50, within)
    assert all(r.n_words == r.end_word - r.start_word for r in found)


def test_empty_tables_and_bounds(spark):
    assert suffix_dedup.repeated_passages(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.repeated_passages(empty(spark), least_words=20, window=18)


@pytest.mark.parametrize("within", [False, True])
@pytest.mark.parametrize("batch", [1, 3, 100])
def test_runs_that_cross_tasks_are_settled_from_two_sums_a_task(within, batch):
    """Sorted rows cut into tasks at every place, also one row into a hot run."""
    rows = [(i, 5) for i in range(30)] + [(7, 6)] * 3 + [(8, 9), (9, 9)] + [(4, 11)] + [(3, 12)] * 2
    table = pd.DataFrame([(i, k, p) for p, (i, k) in enumerate(rows)], columns=["id", "key", "place"]).sort_values(["key", "id", "place"])
    sizes = table.groupby("key")["id"].agg(["min", "max", "count"])
    good = sizes[(sizes["min"] != sizes["max"]) | (within & (sizes["count"] > 1))].index
    wanted = sorted(table[table["key"].isin(good)]["place"])
    for a in range(0, len(table) + 1):
        for b in {a, min(a + 1, len(table))}:
            tasks = [table.iloc[:a], table.iloc[a:b], table.iloc[b:]]
            out = []
            for task in tasks:
                given = list(suffix_dedup._runs(within)(task.iloc[i : i + batch] for i in range(0, len(task), batch)))
                sums = sum(int((g["place"] < 0).sum()) for g in given)
                assert sums <= 2
                out += given
            judged = pd.concat(out)
            sums = judged[judged["place"] < 0].groupby("key").agg(low=("id", "min"), high=("high", "max"), n=("n", "sum"))
            crossing = sums[(sums["low"] != sums["high"]) | (within & (sums["n"] > 1))].index
            kept = judged[(judged["place"] >= 0) & (~judged["open"].astype(bool) | judged["key"].isin(crossing))]
            assert sorted(kept["place"]) == wanted


def test_a_hot_passage_over_many_tasks(spark):
    hot = prose(51, 50, 9000)
    texts = [f"{prose(i, 20, 9000)} {hot}" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffix_dedup.repeated_passages(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in found) == brute(list(enumerate(texts)), 50, False)
