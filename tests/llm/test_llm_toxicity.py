import random
import zlib

import numpy as np
import pandas as pd
import pytest
from llm_texts import words

from loglens.llm import toxicity as X

INSULTS = ["rottenface", "grimblesnout", "vexquda"]


def make(n=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        w = words(rng, rng.randint(5, 60))
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS) + rng.choice(["", "en", "r"]))
        text = " ".join(w)
        rows.append((i, text, rng.choice(["en", "de"]), "s", len(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture()
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_query_columns(spark, docs, labels, table_dir):
    rows, marks = make()
    folder = table_dir(documents=docs([*rows, (1000, None, None, None, 0), (1001, "", "en", "s", 0)]), labels=labels(marks))
    got = {r.doc_id: r for r in X.QUERIES["op7_toxicity_cnn"](spark, folder).collect()}
    assert len(got) == len(rows) + 2
    held = [i for i, _, _ in marks if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r.held_out} == set(held) | {i for i in (1000, 1001) if zlib.crc32(str(i).encode()) % 3 == 1}
    right = np.mean([got[i].predicted == t for i, _, t in marks if got[i].held_out])
    assert right > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert got[1000].score == got[1001].score < 0.7


def test_text_alone_decides_the_score(docs, labels):
    rows, marks = make(120)
    df = docs(rows)
    model = X.fit(df, labels(marks), epochs=2)
    one = {r.doc_id: r.score for r in X.score(df, model).collect()}
    other = docs([(i + 5000, t, None, "elsewhere", 0) for i, t, *_ in rows])
    two = {r.doc_id - 5000: r.score for r in X.score(other, model).collect()}
    assert one == pytest.approx(two, abs=2e-6)  # sums of one text differ in the last bits with its neighbours


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 50, (rng.integers(1, 9), 3)) for _ in range(40)]
    toxic = np.array([float((t == 7).any()) for t in texts], dtype=np.float32)
    net = X.TextCNN().train(texts, toxic, epochs=60)
    got = np.array([net.scores(t, np.array([0, len(t)]))[0] for t in texts])
    assert got[toxic == 1].min() > got[toxic == 0].max()


def test_pooling_never_crosses_texts():
    net = X.TextCNN(3)
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1000, (n, 3)) for n in (1, 2, 5, 0, 3)]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    together = net.pooled(np.concatenate(parts), first)
    alone = np.vstack([net.pooled(p, np.array([0, len(p)])) for p in parts])
    assert np.allclose(together, alone, atol=1e-6)


@pytest.mark.parametrize("marks,value", [([], 0.5), ([(1, 1, 1), (2, 1, None)], 1.0), ([(1, 1, 0), (99, 1, 1)], 0.0)])
def test_one_class_or_none(docs, labels, marks, value):
    df = docs([(1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (None, None, None, None, None)])
    model = X.fit(df, labels(marks))
    assert [r.score for r in X.score(df, model).collect()] == [value] * 3


def test_thresholds():
    some = np.array([0.9] * 9 + [0.8, 0.1])
    assert X.best_threshold(some, np.array([True] * 10 + [False])) == pytest.approx(0.45)
    assert X.best_threshold(some, np.array([True] * 9 + [False] * 2)) == X.DEFAULT_THRESHOLD


def test_empty_table_and_clashing_columns(spark, docs, labels):
    df = spark.createDataFrame([(1, "x", "en", 0.3)], "doc_id long, text string, lang string, score double")
    model = X.fit(df, labels([(1, 1, 1)]))
    assert X.score(df, model).columns == ["doc_id", "text", "lang", "score"]
    assert X.accepted(df, model).columns == df.columns
    assert X.score(docs([]), model).collect() == []


def test_thresholds_cover_all_labelled_rows_at_their_class_shares(spark, docs, labels):
    # 30 rows a class are sampled; the others decide the thresholds just as well, a tenth of them toxic.
    rng, rows, marks = random.Random(5), [], []
    for i in range(900):
        toxic = i % 10 == 0
        w = words(rng, rng.randint(5, 30))
        if rng.random() < (0.7 if toxic else 0.08):
            w.insert(rng.randrange(len(w)), INSULTS[0])
        rows.append((i, " ".join(w), "en" if i % 3 else "de", "s", 0))
        marks.append((i, 1, int(toxic)))
    df = docs(rows)
    model = X.fit(df, labels(marks), per_class=30, epochs=4)
    order = {r.doc_id: (r.h, r.doc_id) for r in labels(marks).selectExpr("doc_id", "xxhash64(doc_id) h").collect()}
    trained = set()
    for label in (0, 1):
        own = sorted(sorted((i for i, _, t in marks if t == label), key=order.get)[:30])
        trained |= {x for k, x in enumerate(own) if k % X.CALIBRATION_PARTS != X.CALIBRATION_PARTS - 1}
    score = {r.doc_id: r.score for r in X.score(df, model).collect()}

    def f1(cut, name):
        total, rest, hit = ({0: 0, 1: 0} for _ in range(3))
        for (i, _, lang, *_), (_, _, t) in zip(rows, marks, strict=True):
            if name in (None, lang):
                total[t] += 1
                rest[t] += i not in trained
                hit[t] += i not in trained and score[i] >= cut
        flagged = {t: hit[t] * total[t] / rest[t] for t in (0, 1)}
        return 2 * flagged[1] / (flagged[0] + flagged[1] + total[1])

    assert set(model.thresholds) == {None, "en", "de"}
    for name, cut in model.thresholds.items():
        best = max(f1(x, name) for x in {round(s, 4) - 5e-5 for s in score.values()})
        assert f1(cut, name) == pytest.approx(best, abs=1e-9)


def test_trained_rows_count_for_the_class_shares_only():
    # Clean rows: 90 trained on, 10 left of which five score as high as the toxic ones.
    counts = lambda trained: pd.DataFrame([(0, None, trained), (0, 0.1, 5), (0, 0.6, 5), (1, 0.6, 10), (1, 0.9, 10)],
                                          columns=["toxic", "score", "n"])
    assert X.threshold_of_counts(counts(0)) == pytest.approx(0.35)
    assert X.threshold_of_counts(counts(90)) == pytest.approx(0.75)
