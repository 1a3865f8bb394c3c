"""What the models may learn from, and how large they are."""

import zlib

import numpy as np

from metaweave.llm import maxent_lm, toxicity_crf


def test_frequent_words_are_classes_of_their_own():
    words = [b"w%d" % i for i in range(40)]
    n = maxent_lm.CLASSES
    v = maxent_lm.Vocabulary(words, np.arange(80, 40, -1), 32000, 40, np.full(n, 500.0), np.ones(n))
    assert n == 64 and (maxent_lm.Index(v).inside[:23] == 0).all() and (maxent_lm.Index(v).inside[23:40] < 0).all()


def test_held_out_labels_do_not_move_the_calibration(spark):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    docs = spark.createDataFrame([(i, f"some plain words {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(held(i))) for i in range(40)], "doc_id long, toxic int")
    assert any(map(held, range(40)))
    assert toxicity_crf.train(docs, labels).shift == float(np.log(1e-4))


def test_lexicon_counts_near_copies_once_and_documents_that_share_a_passage_each(spark):
    passage = " ".join(f"common{i}" for i in range(20))
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(25))
    rows = [(i, f"{passage} grobbled {own(i)}", 1) for i in range(6)]  # six toxic documents with one passage in common
    rows += [(100 + i, f"blorked {own(100)} {passage}", 1) for i in range(9)]  # one toxic document nine times
    rows += [(200 + i, f"{passage} {own(200 + i)}", 0) for i in range(60)]
    rows += [(300, rows[0][1], 0), (301, "", 0), (302, "", 1)]  # a copy with the other label, empty texts
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    marks = toxicity_crf.lexicon(sample, min_ratio=10.0)
    marked = lambda s: bool(marks[toxicity_crf._number("w", s)])
    assert marked("grobbled") and not marked("blorked") and not marked("common3")
    assert not toxicity_crf.lexicon(sample.limit(0)).any() and not toxicity_crf.lexicon(sample.where("label = 0")).any()


def test_remembered_weights_are_sums_over_the_features():
    rng = np.random.default_rng(4)
    model = toxicity_crf.Field(rng.normal(size=toxicity_crf.BUCKETS), np.zeros((2, 2)))
    texts = ["Ein, öde ÄPFEL! a __ x_y 12 && geheimnisvollste geheim geh (gehe)", "", "one", "Ein öde"]
    tokens = [t.encode().split() for t in texts]
    got = model.emissions(tokens)
    want = []
    for line in tokens:
        words = [toxicity_crf.normal(t) for t in line]
        for i, s in enumerate(words):
            features = toxicity_crf.own_features(s)
            features += toxicity_crf.near_features("l", words[i - 1]) if i else []
            features += toxicity_crf.near_features("r", words[i + 1]) if i + 1 < len(words) else []
            want.append(sum(model.w[f] for f in features))
    assert np.allclose(got, want, rtol=0, atol=1e-12)
    assert toxicity_crf._number("w", "öde") == zlib.crc32("w\töde".encode()) % toxicity_crf.BUCKETS
