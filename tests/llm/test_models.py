"""Language ID and quality: held-out accuracy, and rows at the edges."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import edge
from wardflow.llm import language, quality, words
from wardflow.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    got = QUERIES["op2_language_id"](spark, MIDDLE)
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.97
    assert np.mean([r.rejected for r in rows]) <= 0.02
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    docs = edge.documents(spark)
    dictionaries = language.learned_dictionaries(docs)
    assert list(dictionaries) == ["de", "en", "es"]
    out = language.predicted_languages(docs, dictionaries)
    assert out.columns == [c for c in docs.columns if c not in ("score", "rejected")] + [
        "lang_pred", "score", "rejected"]
    for r in out.collect():
        nothing = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == nothing and (not nothing or r.rejected)
        if r.text == edge.PLAIN:
            assert r.lang_pred == "en"
    assert language.identified(edge.documents(spark, []), F.lit(True)).count() == 0
    unlabelled = language.identified(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(False))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_a_tie_is_rejected():
    sizes = language.sizes_by_language({"a": b"abcdefgh" * 4, "b": b"abcdefgh" * 4})
    assert language.judged("abcdefgh", ["a", "b"], sizes) == ("a", 0.5, True)


def test_long_texts_in_one_language_pass_the_stage(spark):
    """Texts of 2 MB and more, of words in ever new order: the margin must not depend on the length."""
    rng = np.random.default_rng(4)
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    texts: dict = {}
    for r in docs.filter("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").collect():
        texts.setdefault(r.lang, []).append(r.text)
    rows = []
    for i, (lang, own) in enumerate(sorted(texts.items())):
        words = np.array(" ".join(own).split(), object)
        for n, size in enumerate((2_000_000, 5_000_000)):
            text = " ".join(rng.choice(words, size // 4))[:size]
            rows.append((-1 - 2 * i - n, text, None, lang, len(text)))
    long_ones = spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    kept = corpus_pipeline.language_id(spark, docs.unionByName(long_ones), MIDDLE)
    assert {r.doc_id for r in kept.filter("doc_id < 0").collect()} == {r[0] for r in rows}
    judged = language.predicted_languages(long_ones, language.learned_dictionaries(docs))
    assert all(r.lang_pred == r.source for r in judged.collect())


def test_quality_of_held_out_documents(spark):
    got = QUERIES["op1_quality_classifier"](spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.97
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def brute_marginals(emitted, moves):
    """By enumerating all label sequences."""
    n = len(emitted)
    paths = [[(k >> t) & 1 for t in range(n)] for k in range(2 ** n)]
    weight = np.exp([sum(emitted[t, p[t]] for t in range(n)) + sum(moves[a, b] for a, b in zip(p, p[1:]))
                     for p in paths])
    return np.array([[weight[[p[t] == y for p in paths]].sum() for y in (0, 1)] for t in range(n)]) / weight.sum()


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    counts = np.array([1, 3, 6, 4])
    emitted, moves = rng.standard_normal((4, 6, 2)), rng.standard_normal((2, 2))
    label, pair, _ = quality.marginals(emitted, moves, counts)
    for i, n in enumerate(counts):
        np.testing.assert_allclose(label[i, :n], brute_marginals(emitted[i, :n], moves))
        np.testing.assert_allclose(pair[i, :n - 1].sum((1, 2)), np.ones(n - 1))
        assert not pair[i, n - 1:].any()


def _random_field():
    rng = np.random.default_rng(8)
    field = quality.Field(3 * (quality.OWN + 1))
    field.weights, field.moves = rng.standard_normal(field.weights.shape), rng.standard_normal((2, 2))
    return field


def test_long_texts_score_by_pieces_as_whole(monkeypatch):
    rng, field = np.random.default_rng(9), _random_field()
    monkeypatch.setattr(words, "PIECE", 200)
    monkeypatch.setattr(quality, "LINES_AT_ONCE", 7)
    some = [b"The same line again.", b"", b"x", b"A " + b"long line with many words, some 12 times " * 20,
            b"Unbroken" * 300, b"end " + b"y" * 900, b"a B  c\td!"]
    for n in (1, 2, 3, 9, 40, 200):
        text = b"\n".join(some[i] for i in rng.integers(0, len(some), n))
        assert [x for run in quality.line_runs(text) for x in run] == text.split(b"\n")
        whole = field.score(*quality.document_lines([text]))
        assert field.long_score(text) == pytest.approx(float(whole[0]), abs=1e-9)
    texts = [b"", None, text, b"a\n" * 30, b"last"]
    assert [(i, len(few)) for i, few in quality.text_runs(texts)] == [(0, 2), (2, 1), (3, 1), (4, 1)]


MEASURED = """
import resource, sys
from tests.llm.test_models import _random_field
field = _random_field()
field.long_score(b"a line\\n" * 200_000)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
if sys.argv[1] == "lines":
    text = b"\\n".join(b"Some words of line %d, and more of them." % i for i in range(1_200_000))
else:
    text = {"line": b"words of a line ", "word": b"w" * 16}[sys.argv[1]] * 3_125_000
assert 0 <= field.long_score(text) <= 1
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""


@pytest.mark.parametrize("kind", ["lines", "line", "word"])
def test_a_text_of_50_mb_takes_less_than_300_more(kind):
    done = subprocess.run([sys.executable, "-c", MEASURED, kind], capture_output=True,
                          text=True, check=True, cwd=os.path.dirname(corpus_pipeline.__file__))
    assert int(done.stdout) < 300


def test_quality_edges(spark):
    docs = edge.documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (6, None), (None, 1), (10, 7)],
                                   "doc_id long, quality int")
    out = quality.quality_scores(docs, labels, F.lit(False)).collect()
    assert len(out) == len(edge.rows()) and all(0 <= r.score <= 1 for r in out)
    assert quality.quality_scores(edge.documents(spark, []), labels, F.lit(True)).count() == 0
    none = quality.quality_scores(docs, labels.limit(0), F.lit(False)).collect()
    assert all(r.score == pytest.approx(0.5) for r in none)
    assert quality.scored(docs, quality.Field(3 * (quality.OWN + 1))).columns[-1] == "score"
