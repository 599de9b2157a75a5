import numpy as np
from corpora import awkward, empty

from furrow.llm import language_id

WORDS = {"en": "the and that with from this have", "de": "der und nicht eine sich auch über", "fr": "les des une dans pour être à"}


def test_learns_and_scores_like_plain_counting(spark):
    rows = [(i, " ".join((w := t.split())[(i * 7 + j) % len(w)] for j in range(12)), lang) for lang, t in WORDS.items() for i in range(20)]
    rows += [(900, "12 !!", "en"), (901, None, "de"), (902, "und der", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert model.languages == ["de", "en", "fr"]
    counts = np.full((language_id.BUCKETS, 3), language_id.SMOOTH)
    for _, text, lang in rows[:60]:
        np.add.at(counts[:, model.languages.index(lang)], language_id.buckets_of(text), 1)
    assert np.allclose(model.log_probability, np.log(counts / counts.sum(axis=0)), atol=1e-5)
    total = np.log(counts / counts.sum(axis=0))[language_id.buckets_of("und dans")].sum(axis=0) + np.log(1 / 3)
    lang, score = language_id.judge("und dans", model)
    assert lang == model.languages[int(total.argmax())] and abs(score - 1 / np.exp(total - total.max()).sum()) < 1e-4
    found = {(r.doc_id, r.lang_pred) for r in language_id.predict(df, model).collect()}
    assert all((i, lang) in found for i, _, lang in rows[:60])
    assert {(900, "und"), (901, "und"), (902, "de")} <= found


def test_awkward_rows(spark):
    df = awkward(spark, ["über uns", "ЖЖ", "1234", "\U0001f600"])
    model = language_id.fit(df)
    found = language_id.predict(df, model).collect()
    assert len(found) == df.count() and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.lang_pred for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[102] == by_id[103] == "und" and by_id[101] != "und"
    nothing = language_id.fit(empty(spark))
    assert nothing.languages == [] and language_id.predict(empty(spark), nothing).count() == 0
    assert {r.lang_pred for r in language_id.predict(df, nothing).collect()} == {"und"}
