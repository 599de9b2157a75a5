import re

from corpora import awkward, empty

from furrow.llm import license_scan


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, t.label) for t in license_scan.PHRASES for i in range(len(words)) if words[i : i + len(t.text.split())] == t.text.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_base_places_agree_with_brute_force(spark):
    notice = next(t.text for t in license_scan.NOTICES if t.label == "bsd-text").split()
    texts = [
        "Licensed under CC BY-NC 4.0. (cc by; CC-BY)",
        "…the GNU General Public License, version 3.\nGNU general public licence; Apache License MIT License",
        "\x00mit license mit license\tmit, license!",
        "--Apache--License--",
        " ".join(notice[:9] + ["extra"] + notice[9:]),
        " ".join(notice[:6]),
        "licensed under the apache license version 2 0",
        "É été cc by ß",
    ]
    df = awkward(spark, texts)
    found = license_scan.scan(df).collect()
    assert len(found) == df.count()
    by_id = {r.doc_id: r for r in found}
    for row in df.where("doc_id is not null").collect():
        r = by_id[row.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(row.text), row.text[:80]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert "bsd-text" in by_id[104].labels and by_id[105].labels == "" and 0 < by_id[105].score < 0.6
    assert by_id[106].labels == "apache,apache-2.0"
    assert sum(r.doc_id == 6 for r in found) == 2 and sum(r.doc_id is None for r in found) == 2
    assert license_scan.scan(empty(spark)).count() == 0


def test_no_python_on_the_way(spark):
    plan = license_scan.scan(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
