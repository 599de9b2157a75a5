from itertools import combinations

from corpora import awkward, empty, prose

from furrow.llm import decontaminate

ITEM = prose(77, 30)


def brute(text, item, least=13, share=0.8):
    """Whether some alignment has a long enough run with gaps of at most 2."""
    t, w = text.lower().split(), item.lower().split()
    for d in range(-len(w), len(t)):
        run = equal = gap = 0
        for j in range(len(w)):
            same = 0 <= d + j < len(t) and t[d + j] == w[j]
            if same:
                run, equal, gap = (run + gap + 1, equal + 1, 0) if run else (1, 1, 0)
                if run >= min(least, len(w)) and equal >= share * run:
                    return True
            elif run:
                gap += 1
                if gap > 2:
                    run = equal = gap = 0
    return False


def swapped(text, every):
    return " ".join("zz" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def test_agrees_with_all_alignments(spark):
    other = prose(5, 40)
    texts = [
        f"{other} {ITEM} {other}",
        f"{other} {swapped(ITEM, 7)} {other}",
        f"{swapped(ITEM, 5)} {other}",
        f"{other} {swapped(ITEM, 2)}",
        f"{other} {' '.join(ITEM.split()[:15])} {other}",
        f"{other} {' '.join(ITEM.split()[:12])} {other}",
        ITEM.upper().replace(" ", ", "),
        other,
    ]
    df = awkward(spark, texts)
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "a b c"), (None, prose(78, 20)), (1, ITEM)], "item_id long, text string")
    found = decontaminate.overlaps(df, items).collect()
    assert {r.doc_id for r in found} == {100 + i for i, t in enumerate(texts) if brute(t.replace(",", ""), ITEM)}
    assert {100, 101, 102, 104, 106} == {r.doc_id for r in found}
    assert {(r.start_word, r.end_word) for r in found if r.doc_id == 100} == {(40, 70)}
    kept = decontaminate.clean_rows(df, items)
    assert kept.columns == df.columns and kept.count() == df.count() - 5
    assert decontaminate.overlaps(empty(spark), items).count() == 0
    assert decontaminate.overlaps(df, items.limit(0)).count() == 0


def test_no_python_on_the_way(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    plan = decontaminate.overlaps(awkward(spark), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_and_repeated_items_give_the_same_either_way(spark, monkeypatch):
    long, other = prose(80, 4000, 3000), prose(7, 30)
    words = long.split()
    texts = [f"{other} {' '.join(words[a:b])} {other}" for a, b in ((0, 20), (3970, 4000), (1000, 1900), (500, 512))]
    items = spark.createDataFrame([(1, long), (1, long), (2, long), (1, ITEM), (None, ITEM), (3, None)], "item_id long, text string")
    df = awkward(spark, [*texts, ITEM])
    want = {(100 + i, item, 30, 30 + n) for i, n in ((0, 20), (1, 30), (2, 900)) for item in (1, 2)}
    want |= {(104, item, 0, 30) for item in (1, None)}

    def spans():
        rows = decontaminate.overlaps(df, items).collect()
        return sorted(((r.doc_id, r.item_id, r.start_word, r.end_word) for r in rows), key=str)

    assert spans() == sorted(want, key=str)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert spans() == sorted(want, key=str)


def laid_over(pattern, item, n=0):
    """The words of the item where the pattern has a 1, others where it has a 0."""
    return " ".join(w if bit == "1" else f"other{n}x{i}" for i, (bit, w) in enumerate(zip(pattern, item.split(), strict=False)))


def test_a_dense_part_is_found_in_a_diluted_run(spark):
    item, other = prose(79, 60), prose(6, 20)
    patterns = [
        "1" * 20 + "01" * 15,
        "1" * 30 + "001" * 8,
        "1" * 13 + "001001",
        "100100100" + "1" * 13 + "0101",
        "01" * 10 + "1" * 8 + "0" + "1" * 8 + "001" * 6,
        "1" * 12 + "001" * 16,
        "01" * 30,
    ]
    texts = [f"{other} {laid_over(p, item)} {other}" for p in patterns]
    found = decontaminate.overlaps(awkward(spark, texts), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    longest = {}
    for i, p in enumerate(patterns):
        p = "0" * 20 + p + "0" * 20
        ones = [j for j, bit in enumerate(p) if bit == "1"]
        spans = [(b + 1 - a, a) for a in ones for b in ones if "000" not in p[a : b + 1] and p[a : b + 1].count("1") >= 0.8 * (b + 1 - a)]
        n, start = max(spans)
        if n >= 13:
            longest[100 + i] = (n, p[start : start + n].count("1"))
    assert set(longest) == {100, 101, 102, 103, 104, 105}
    assert {r.doc_id: (r.end_word - r.start_word, r.n_equal) for r in found} == longest


def valid_patterns(n):
    """All equal and unequal words of an overlap of n words, as 1 and 0."""
    for k in range(n - -(-4 * n // 5) + 1):
        for zeros in combinations(range(1, n - 1), k):
            p = "".join("0" if i in zeros else "1" for i in range(n))
            if "000" not in p:
                yield p


def hit(pattern, masks):
    return any(all(m == "0" or b == "1" for m, b in zip(mask, pattern[at:], strict=False)) for mask in masks for at in range(len(pattern) - len(mask) + 1))


def test_every_valid_pattern_has_a_seed():
    for n in range(1, 22):
        masks = decontaminate.MASKS if n > 12 else ["1" * decontaminate.SHORT[n]]
        assert all(hit(p, masks) for p in valid_patterns(n)), n


def test_longer_patterns_have_a_seed_too():
    """The best balance (4 for each unequal word against 1 for an equal one) of a pattern
    without a seed, by its last ten words, for growing lengths."""
    masks = [int(m, 2) for m in decontaminate.MASKS]
    best = {1: 1}
    for n in range(2, 200):
        longer = {}
        for last, balance in best.items():
            for bit in (0, 1):
                seen = last << 1 | bit
                if seen & 7 and not any(seen & m == m for m in masks):
                    key = seen & 1023
                    longer[key] = max(longer.get(key, -999), balance + (1 if bit else -4))
        best = longer
        assert n < 13 or max(b for last, b in best.items() if last & 1) < 0


def test_swapped_words_and_short_items_are_found(spark):
    other = prose(8, 20)
    items = [(prose(80, 16), "1" * 7 + "00" + "1" * 7), (prose(81, 8), "11110111"), (prose(82, 5), "11011"), (prose(83, 3), "111"), (prose(84, 10), "1110111011"), (prose(85, 7), "1101011")]
    texts = [f"{other} {laid_over(p, item, n)} {other}" for n, (item, p) in enumerate(items)]
    texts.append(laid_over("11110111", items[1][0]))
    benchmark = spark.createDataFrame([(n, item) for n, (item, _) in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(awkward(spark, texts), benchmark).collect()}
    assert found == {(100 + d, n) for d, t in enumerate(texts) for n, (item, _) in enumerate(items) if brute(t, item)}
    assert found >= {(100, 0), (101, 1), (102, 2), (103, 3), (104, 4), (106, 1)} and (105, 5) not in found
