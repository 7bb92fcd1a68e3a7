"""The pipeline's stages on small tables, each against what its operator decides."""

import pytest

import corpus_pipeline as c
from tests.conftest import SMALL
from tests.llm import edge
from tests.llm.test_near_dedup import brute
from tests.llm.test_secrets import brute as secret_spans
from wardflow.llm.staging import staged


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in c.STAGES:
        out.append(staged(stage(spark, out[-1], SMALL), "step"))
    return [d.collect() for d in out]


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in c.STAGES] == ["language ID", "MinHash near-dedup", "benchmark decontamination",
                                        "secret scan", "source mixture"]
    assert all(s[0].__fields__ == steps[0][0].__fields__ for s in steps[:-1])
    assert steps[-1][0].__fields__ == [*steps[0][0].__fields__, "copy"]


def test_language_keeps_nearly_all(steps):
    assert set(steps[1]) <= set(steps[0]) and len(steps[1]) >= 0.97 * len(steps[0])


def test_one_of_each_group_stays(steps):
    want = {doc for doc, _, least in brute([(r.doc_id, r.text) for r in steps[1]], 5, 80) if doc == least}
    assert {r.doc_id for r in steps[2]} == want and set(steps[2]) <= set(steps[1])


def test_documents_with_items_go(spark, steps):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in steps[2]} - {r.doc_id for r in steps[3]}
    assert gone == {r.doc_id for r in steps[2] if any(i in r.text for i in items)}


def test_secrets_are_marked(steps):
    assert len(steps[4]) == len(steps[3])
    before = {r.doc_id: r for r in steps[3]}
    for r in steps[4]:
        assert not secret_spans(r.text) and r.n_chars == len(r.text)
        assert secret_spans(before[r.doc_id].text) or r == before[r.doc_id] or "[SECRET]" in r.text


def test_mixture_repeats_whole_rows(steps):
    known = set(steps[4])
    assert all(tuple(r)[:-1] in {tuple(k) for k in known} for r in steps[-1])
    assert len({(r.doc_id, r.copy) for r in steps[-1]}) == len(steps[-1])


def test_run_equals_its_stages(spark, steps):
    assert sorted(c.run(spark, SMALL).collect()) == sorted(steps[-1])


def test_rows_at_the_edges_pass_through(spark):
    docs = edge.documents(spark)
    for _, stage in c.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    kept = c.near_dedup(spark, docs, SMALL).collect()
    assert sum(r.text == edge.PLAIN for r in kept) == 1
