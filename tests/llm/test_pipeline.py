import pytest

import corpus_pipeline
from furrow.llm import decontaminate, entries, mixing, ngram_join, pii, toxicity
from furrow.session import settle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, docs, SF))
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark, stages):
    assert [n for n, *_ in stages][0] == "toxicity" and len(stages) == 5
    for _, before, after in stages:
        assert after.columns == before.columns and after.dtypes == before.dtypes
    (_, docs, safe), (_, _, single), (_, _, clean), (_, _, masked), (_, _, mixed) = stages
    model = entries.toxicity_model(spark, SF)
    assert ids(safe) == sorted(r.doc_id for r in docs.collect() if model.score(r.text) < 0.5) and safe.count() < docs.count()
    groups = ngram_join.jaccard_components(safe, k=5, percent=80).collect()
    assert ids(single) == sorted(g.id for g in groups if g.id == g.component_id) and single.count() < safe.count()
    found = {r.doc_id for r in decontaminate.overlaps(single, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids(clean) == [i for i in ids(single) if i not in found]
    assert ids(masked) == ids(clean)
    assert not any(pii.base_spans(r.text) for r in masked.collect())
    taken = {r.doc_id: r.copies for r in mixing.mix(masked).collect()}
    assert ids(mixed) == sorted(i for i, n in taken.items() for _ in range(n))
    assert toxicity.score(mixed, model).where("predicted = 1").count() == 0


def test_run_gives_the_last_stage(spark, stages):
    assert ids(corpus_pipeline.run(spark, SF)) == ids(stages[-1][2])
