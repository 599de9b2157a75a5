import hashlib
import re

import pytest
from corpora import awkward, empty, prose
from pyspark.sql import functions as F

from furrow.llm import fill_in_middle as fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [
    "",
    " ",
    "one",
    " lead and trail \n",
    "é́ 𝄞𝄞  x y  z",
    "a <P> b",
    "has <S>",
    "<M>",
    "ends with < and <P",
    "S> begins",
    "\t\x0b\x0c\r\n",
    "a\x1cb c",
]


def by_hand(id_, text, seed="42", share=50, spm_share=80):
    """Strings cut and put together, without descriptors."""
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    digest = hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_share:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("share", "spm_share"), [(50, 80), (100, 50), (0, 80)])
def test_each_row_is_what_strings_give_and_goes_back(spark, share, spm_share):
    docs = awkward(spark, TEXTS + [prose(i, i) for i in range(60)])
    made = fim.transform(docs, share=share, spm_share=spm_share)
    rows = made.select(
        "*", fim.restored(F.col("output"), F.col("form")).alias("text"), fim.restored_sha256(F.col("output"), F.col("form")).alias("back")
    ).collect()
    wanted = sorted((str(r.doc_id), *map(str, by_hand(r.doc_id, r.text, "42", share, spm_share)), sha(r.text or "")) for r in docs.collect())
    assert sorted((str(r.id), str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.output, r.back) for r in rows) == wanted
    assert all(r.output_sha256 == sha(r.output) and sha(r.text) == r.back for r in rows)
    forms = {r.form for r in rows}
    assert forms == {(50, 80): {"plain", "spm", "psm"}, (100, 50): {"plain", "spm", "psm"}, (0, 80): {"plain"}}[share, spm_share]


def test_descriptors_read_off_the_buffers(spark):
    docs = awkward(spark, TEXTS + [prose(i, i) for i in range(40)])
    texts = {r.doc_id: r.text or "" for r in docs.where("doc_id is not null").collect()}
    for r in fim.transform(docs).where("id is not null").collect():
        buffers = (texts[r.id], "<P><M><S>")
        assert r.output == "".join(buffers[p.buffer][p.start : p.start + p.length] for p in r.pieces)
        assert len(r.pieces) == (1 if r.form == "plain" else 6)


def test_cut_arrange_and_inverse():
    table = fim.PieceTable("abcdef")
    for at in (2, 2, 6, 0):
        table.cut(at)
    assert table.read() == "abcdef" and len(table.pieces) == 5
    with pytest.raises(ValueError, match="outside"):
        table.cut(7)
    for order in ((0, 2, 1), (2, 0, 1), (1, 2, 0)):
        assert [order[i] for i in fim.inverse(order)] == [0, 1, 2]


def test_empty_table_and_seeds(spark):
    assert fim.transform(empty(spark)).count() == 0
    docs = awkward(spark, [prose(i, 40) for i in range(40)])
    first, again, other = ({(r.id, r.output) for r in fim.transform(docs, seed=s).collect()} for s in ("42", "42", "7"))
    assert first == again and first != other


def test_no_shuffle(spark):
    assert "Exchange" not in fim.transform(awkward(spark))._jdf.queryExecution().executedPlan().toString()
