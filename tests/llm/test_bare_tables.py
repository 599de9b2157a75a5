import pytest
from corpora import SHAPE, empty, prose

from furrow.llm import decontaminate, mixing, ngram_join, pii

ITEMS = [(1, prose(77, 30))]


def stages(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {
        "copies": lambda docs: ngram_join.one_of_each(docs, k=5, percent=80),
        "benchmark": lambda docs: decontaminate.clean_rows(docs, items),
        "private": pii.masked,
        "mix": mixing.mixed_rows,
    }


@pytest.mark.parametrize("name", ["copies", "benchmark", "private", "mix"])
def test_stages_on_empty_tables_and_on_rows_without_text(spark, name):
    stage = stages(spark)[name]
    none = stage(empty(spark))
    assert none.columns == empty(spark).columns and none.count() == 0
    blank = [(i, text, *[None] * (len(SHAPE.split(",")) - 2)) for i, text in ((1, None), (2, ""), (None, None), (2, ""))]
    kept = [(r.doc_id, r.text) for r in stage(spark.createDataFrame(blank, SHAPE)).collect()]
    if name == "mix":
        assert not set(kept) - {(b[0], b[1]) for b in blank}
    else:
        assert sorted(kept, key=str) == sorted(((b[0], b[1]) for b in blank), key=str)
