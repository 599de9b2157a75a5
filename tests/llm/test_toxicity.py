from itertools import product

from corpora import awkward, empty, prose

from furrow.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def by_distance(word, terms):
    """(errors, term) by measuring every term, a beginning against every beginning."""
    found = []
    for t, term in enumerate(terms):
        own = term.rstrip("*")
        e = min(distance(own, word[:k]) for k in range(len(word) + 1)) if term.endswith("*") else distance(own, word)
        if e <= int(len(own) >= 5) + int(len(own) >= 8):
            found.append((e, t))
    return min(found, default=None)


def test_automaton_agrees_with_measured_distances():
    terms = ["abcabc", "abcbca", "acb*", "bcacbac*", "cab", "cbacbacc", "aabbccaab*"]
    automaton = toxicity.Automaton(terms)
    words = ["".join(w) for n in range(1, 8) for w in list(product("abc", repeat=n))[:: max(1, 3**n // 200)]]
    words += ["abcabcx", "xabcabc", "abxabc", "abccabc", "acbzzzz", "bcaxbacq", "bcacbaczz", "bccbac", "cabs"]
    # Eight letters and more bear two errors: each pair of edits of two terms.
    for own in ("cbacbacc", "aabbccaab"):
        words += [own[:i] + x + own[i + 1 : j] + y + own[j:] for i in range(7) for j in range(i + 1, 8) for x, y in (("", ""), ("q", ""), ("", "q"), ("aq", ""))]
        words += [own[:i] + own[i + 1] + own[i] + own[i + 2 :] + "z" for i in range(7)]
    text = " ".join(words)
    c = toxicity.code_points(text)
    starts, ends = toxicity.word_spans(c)
    found = {w: (e, t) for w, t, e in automaton.run(c, starts, ends)}
    for w, word in enumerate(words):
        assert found.get(w) == by_distance(word, terms), word


SIZES = {1: 100, 0: 102}


def labelled(spark):
    rows = [(f"{prose(i, 30)} {'you idiot' if i % 4 == 0 else ''} {'zorkling' + 'abcdefgh'[i % 8:] if i % 4 == 1 else ''}", int(i % 4 < 2)) for i in range(200)]
    rows += [("he said \"idiot\" is a word", 0)] * 2 + [(None, 0), ("", 0), ("idiot", None)]
    return spark.createDataFrame(rows, "text string, toxic int")


def test_labels_are_chosen_up_to_a_number(spark):
    rows = [(i, int(i % 5 == 0)) for i in range(4000)] + [(None, 1), (9001, None), (9002, 3)]
    df = spark.createDataFrame(rows, "doc_id long, toxic int")
    chosen, sizes = toxicity.choose_labels(df, fit_rows=1000)
    n = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    assert sizes == {1: 800, 0: 3200} or sizes == {0: 3200, 1: 800}
    assert n[1] == 800 and 850 < n[0] < 1150


def test_learns_terms_typing_errors_and_context(spark):
    model = toxicity.fit(labelled(spark), SIZES)
    assert any(t.startswith("zor") for t in model.automaton.terms)
    score = model.score
    assert score("really, you stupid loser") > 0.5 and score("such a stupld thing, zorklings") > 0.5
    assert score("a quiet day in the garden") < 0.5 and score(None) == score("") < 0.5
    assert score('they said "idiot" is a word') < score("what an idiot he is")
    assert score("  ".join(["calm"] * 50_000) + " pathetic") > 0.5


def test_awkward_rows(spark):
    model = toxicity.fit(labelled(spark), SIZES)
    df = awkward(spark, ["you pathetic scum", "IDIOT!!", "fine"])
    found = toxicity.score(df, model).collect()
    assert len(found) == df.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert {r.doc_id for r in found if r.predicted} == {100, 101}
    kept = toxicity.clean_rows(df, model)
    assert kept.columns == df.columns and kept.count() == df.count() - 2
    assert toxicity.score(empty(spark), model).count() == 0
    none = toxicity.fit(labelled(spark).limit(0), {})
    assert none.score("you idiot") > none.score("hello") and none.score("hello") < 0.5


def test_rare_and_short_terms_are_learned_at_any_size(spark):
    rows = [(f"{prose(i, 12, 3000)} {'zok' if i % 40 == 0 else ''} {'brelgards' if i % 40 == 20 else ''}", int(i % 2 == 0)) for i in range(3000)]
    rows = [(text, toxic, i // 40 % 2) for i, (text, toxic) in enumerate(rows)]
    halved = spark.createDataFrame(rows, "text string, toxic int, half int").repartition(4)
    terms = toxicity.learn_terms(halved, {(label, half): 3000 for label in (0, 1) for half in (0, 1)})
    assert "zok" in terms and any("brelgards".startswith(t.rstrip("*")) for t in terms)
    many = [(-1.0, 9, "".join(chr(97 + int(d)) for d in f"{i:04d}") + "x") for i in range(2000)]
    assert len(toxicity.chosen_terms(many)) == 2000 + len(toxicity.INSULTS)
    automaton = toxicity.Automaton([t for _, _, t in many])
    assert {t for t, _ in toxicity.hits("aaaax bbbbx", automaton)} == {0, 1111}


def test_terms_must_hold_in_both_halves(spark):
    """A word of one half alone is chance, however often it stands there."""
    rows = [(f"{prose(i, 12, 3000)} {'lopsided' if i % 8 == 0 else ''} {'evenly' if i % 8 in (0, 2) else ''}", int(i % 2 == 0), int(i % 8 != 0)) for i in range(1600)]
    halved = spark.createDataFrame(rows, "text string, toxic int, half int")
    terms = toxicity.learn_terms(halved, {(1, 0): 200, (1, 1): 600, (0, 0): 400, (0, 1): 400})
    assert any("evenly".startswith(t.rstrip("*")) for t in terms) and not any("lopsided".startswith(t.rstrip("*")) for t in terms[len(toxicity.INSULTS) :])


def test_density_and_bare_beginnings():
    automaton = toxicity.Automaton(["grobbel*", "snark"])
    assert toxicity.hits("grobbel", automaton) == {} and toxicity.hits("", automaton) == {} == toxicity.hits(None, automaton)
    assert toxicity.hits("a grobbelig thing", automaton) == {(0, 0): ("dense", {"plain"})}
    long = " ".join(["calm"] * 500)
    assert toxicity.hits(f"{long} grobbelig", automaton) == {(0, 0): ("rare", {"plain"})}
    assert toxicity.hits(f"{long} snark your snark {long}", automaton)[1, 0][0] == "rare"


def test_only_near_copies_are_folded():
    import pandas as pd

    passage = prose(1, 60)
    texts = [f"{passage} {prose(100 + i, 60)}" for i in range(20)] + [f"{passage} {prose(100, 60)} more", None, "", None]
    rows = pd.DataFrame({"text": texts, "toxic": 1, "least": "1:5"})
    kept = next(toxicity._without_copies("1:5", rows))
    assert len(kept) == 21 and kept["text"].tolist()[:20] == texts[:20]


def test_misspelled_short_insults_are_hits_and_clean_words_are_not(spark):
    automaton = toxicity.Automaton([*toxicity.INSULTS, "clow*", "clown"])
    for word in ("idi0t", "1diot", "mor0n", "l0ser", "tr4sh", "cl0wn", "worhtless", "dsigusting"):
        assert toxicity.hits(f"what a {word} this is", automaton), word
    assert not toxicity.hits("a calm sunday in the garden", automaton)
    quiet = [(f"{prose(i, 12)} the closer lover went", 0) for i in range(60)]
    model = toxicity.fit(labelled(spark).union(spark.createDataFrame(quiet, "text string, toxic int")), {1: 100, 0: 162})
    assert {"closer", "lover"} <= model.automaton.rejected
    assert model.score("an idi0t and 1diot") > 0.5 and model.score("you mor0n") > 0.5
    assert model.score("the closer lover went") < 0.5


def test_a_chosen_beginning_covers_what_begins_with_it():
    terms = toxicity.chosen_terms([(-9.0, -5, "clown"), (-9.0, -4, "clow*"), (-8.0, -4, "brel*"), (-7.0, -8, "brelgard"), (-7.0, -6, "brelga*")])
    assert terms[len(toxicity.INSULTS) :] == ["clown", "brel*"]
