"""Classifiers: identities, small fields against enumeration, held-out accuracy, odd rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaweave.llm import quality_fm, queries, toxicity_crf

SF = "/root/testdata/sf0.01"


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    fm = quality_fm.FactorisationMachine(0.3, rng.normal(size=quality_fm.DIMENSIONS), rng.normal(size=(quality_fm.DIMENSIONS, 4)))
    for text in ("one two three two", "", None, "## | A!"):
        i, x = quality_fm.features(text)
        want = fm.w0 + (fm.w[i] * x).sum() + sum(x[a] * x[b] * fm.v[i[a]] @ fm.v[i[b]] for a in range(len(i)) for b in range(a))
        assert np.isclose(fm.margins(np.array([0, len(i)]), i, x)[0], want)


def test_parts_of_the_gradient_add_up(monkeypatch):
    texts, y = [f"good words here {i}" if i % 2 else f"bad | bad {i}" for i in range(40)], np.arange(40) % 2.0
    whole = quality_fm.fit(*quality_fm._rows(texts), y, steps=5)
    monkeypatch.setattr(quality_fm, "_ROWS_AT_ONCE", 7, raising=False)
    parts = quality_fm.fit(*quality_fm._rows(texts), y, steps=5)
    assert np.allclose(whole.w, parts.w, atol=1e-4) and np.allclose(whole.v, parts.v, atol=1e-3)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    e, lengths, trans = rng.normal(0, 2, 12), np.array([4, 0, 5, 1, 2]), rng.normal(0, 1, (2, 2))
    p, pairs = toxicity_crf.forward_backward(e, lengths, trans, with_pairs=True)
    at = 0
    for n in lengths:
        x, z, m, both = e[at : at + n], 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for y in itertools.product([0, 1], repeat=int(n)):
            w = np.exp(sum(a * b for a, b in zip(x, y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            z += w
            m += w * np.array(y)
            for k in range(n - 1):
                both[k, y[k], y[k + 1]] += w
        assert np.allclose(m / z, p[at : at + n]) and np.allclose(both / z, pairs[at : at + n])
        at += n


def trained_field():
    lines = [["you", "utter", "fool"], ["a", "nice", "day"], ["fool", "of", "a", "man"], ["the", "day", "of", "rest"]] * 10
    return toxicity_crf.fit_field(lines, [np.array([w == "fool" for w in x]) for x in lines])


def test_spans_and_offsets():
    text = "A nice day,  you FOOL! and\nfool\nrest"
    found = toxicity_crf.spans(trained_field(), text)
    assert [text[a:b] for a, b, _ in found] == ["FOOL!", "fool"]
    assert toxicity_crf.spans(trained_field(), None) == [] == toxicity_crf.spans(trained_field(), " \n")


def test_scores_do_not_depend_on_the_batch():
    model = trained_field()
    texts = ["you fool", None, "", "a nice day", "you fool", " ".join(["day"] * 5000) + " fool"]
    together = toxicity_crf.scores(model, texts)
    assert np.allclose(together, [toxicity_crf.scores(model, [t])[0] for t in texts])
    assert together[0] == together[4] > together[3] and together[5] > together[3] and together[1] == together[2]


@pytest.mark.parametrize("query, label, least", [("op3_crf_toxicity", "toxic", 0.9), ("op4_fm_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, query, label, least):
    got = queries.QUERIES[query](spark, SF)
    assert got.count() == 1000 and not got.where("score is null or score < 0 or score > 1 or predicted <> cast(score >= %s as int)" % (0.5 if label == "toxic" else 0.3)).count()
    held = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    assert held.where(F.col("predicted") == F.col(label)).count() >= least * held.count()


@pytest.mark.parametrize("operator, label", [(quality_fm, "quality"), (toxicity_crf, "toxic")])
def test_odd_rows_and_labels(spark, docs, no_docs, operator, label):
    """No labels, one class, NULL labels, several labels of one document; NULL and empty texts get equal scores."""
    schema = "doc_id long, quality int, toxic int"
    cases = [[], [(1, 1, 1), (2, 1, 1)], [(1, None, None), (None, 1, 1)], [(i, i % 2, i % 2) for i in range(19)] + [(1, 0, 0)]]
    for rows in cases:
        model = operator.train(docs, spark.createDataFrame(rows, schema))
        got = docs.select("doc_id", operator.score(F.col("text"), model, spark).alias("own")).collect()
        by = {r["doc_id"]: r["own"] for r in got}
        assert len(got) == docs.count() and by[5] == by[6] and all(0 <= x <= 1 for x in by.values())
    model = operator.train(no_docs, spark.createDataFrame([], schema))
    assert no_docs.select(operator.score(F.col("text"), model, spark)).collect() == []
