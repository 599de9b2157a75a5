import hashlib
import random
import re

import numpy as np
from corpora import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from furrow.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checksum(s):
    total = 0
    for i, x in enumerate(reversed(s)):
        x = int(x) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                    "card": 12 <= len(d) <= 19 and checksum(d), "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-_%+ 0123459()é\n", max_size=60))
def test_base_spans_agree_with_the_plain_patterns(text):
    assert [(a, k, b) for a, b, k in pii.base_spans(text)] == brute(text)


def test_whole_query_agrees_and_keeps_base_spans(spark):
    r = random.Random(5)
    texts = ["".join(r.choice("ab@.+ 0123459-() ") for _ in range(400)) for _ in range(40)]
    texts += ["x 4337166598464399 é a.b@c.example.com, +1 (988) 555-2485 10.0.0.256 10.0.0.255", "@" * 5000, "1" * 20_000, "a" * 50_000, "1." * 9000]
    texts += [f"call (555) {i:03d}-4567 or mail bob [at] site [dot] com" for i in range(20)]
    df = awkward(spark, texts)
    found = pii.find(df).collect()
    assert len(found) == df.count()
    by_id = {x.doc_id: x for x in found}
    names = list(PATTERNS)
    for row in df.where("doc_id is not null").collect():
        base = [f"{names[k]}:{a}:{b}" for a, k, b in brute(row.text)]
        x = by_id[row.doc_id]
        assert x.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(b.startswith(n) for b in base) for n in names]
        assert set(base) <= set(x.spans.split(",")) | {""}
        starts = [(int(s.split(":")[1]), names.index(s.split(":")[0])) for s in x.spans.split(",") if s]
        assert starts == sorted(starts)
    assert any("phone" in by_id[145 + i].spans for i in range(20))
    assert pii.find(empty(spark)).count() == 0


def test_masking_keeps_rows_and_hides_spans(spark):
    df = awkward(spark, ["mail a.b@c.de now", "card 4337166598464399", "plain"])
    out = pii.masked(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes and out.count() == df.count()
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert texts[100] == ("mail [EMAIL] now", 16) and texts[101][0] == "card [CARD]" and texts[102] == ("plain", 5)
    assert texts[1] == (None, None) and texts[2] == ("", 0)
    assert pii.masked(empty(spark)).count() == 0


def test_reliabilities_are_recovered():
    r = np.random.default_rng(1)
    truth = r.random(20_000) < 0.4
    right = [0.9, 0.8, 0.7]
    votes = np.column_stack([np.where(r.random(len(truth)) < p, truth, ~truth) * 2 - 1 for p in right])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, chance = pii.aggregate_votes(patterns, counts.astype(float))
    assert all(abs(chance[j, 1, 2] - p) < 0.03 and abs(chance[j, 0, 0] - p) < 0.03 for j, p in enumerate(right))
    w = pii.train(patterns, counts.astype(float), posterior)
    assert w[0] > w[1] > w[2] > 0
