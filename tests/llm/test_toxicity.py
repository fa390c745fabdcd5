import random
import zlib

import numpy as np

from tabletide.llm import queries as Q
from tabletide.llm import toxicity as T
from tabletide.llm.words import Batch


def test_held_out_rows(spark):
    """A word list and a pair of words that are harmless alone; labels of held-out rows are never seen."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(3000):
        text = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 80))]
        kind = rng.random()
        if kind < 0.1:
            for _ in range(2):
                text.insert(rng.randrange(len(text) + 1), rng.choice(["Vile", "nasty,", "rotten"]))
        elif kind < 0.2:
            at = rng.randrange(len(text) + 1)
            text[at:at] = ["red", "herring"]
        else:
            text.insert(rng.randrange(len(text) + 1), "red")
            text.insert(rng.randrange(len(text) + 1), "herring" if "red" not in text[-1:] else "x")
        toxic = int(kind < 0.2)
        docs.append((i, " ".join(text)))
        labels.append((i, toxic if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - toxic))
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    usable = ~Q.held_out("doc_id", 4, 2)
    model = T.fit(docs_df, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic", usable=usable)
    got = {r.doc_id: r for r in T.toxicity(docs_df, model).collect()}
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum(got[i].predicted == 1 - labels[i][1] for i in held)
    assert len(got) == 3000 and right > 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert 0 < len(model.at) < 3000


def test_tables(spark, small):
    rows = Q.op2_toxicity(spark, small).collect()
    docs = {r.doc_id for r in Q.read(spark, small, "documents").collect()}
    assert len(rows) == len(docs) and {r.doc_id for r in rows} == docs
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_held_out_recall():
    """On the larger tables: most held-out toxic rows are found, and hardly another one.  About one label in ten of these tables is on a text without any sign."""
    import os

    import pyarrow.parquet as pq
    import pytest

    for tables, least in (("/root/testdata/sf0.01", 0.75), ("/root/testdata/sf0.1", 0.88)):
        if not os.path.isdir(tables):
            pytest.skip("no test tables here")
        texts = {r["doc_id"]: (r["text"] or "").encode() for r in pq.read_table(f"{tables}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
        labels = [(r["doc_id"], r["toxic"]) for r in pq.read_table(f"{tables}/labels.parquet").to_pylist()]
        out = [zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in labels]
        model, order = T.Ftrl(), np.random.default_rng(0)
        rows = [(np.unique(T.features(Batch([texts[i]], "alnum", True))[1]), float(y)) for (i, y), o in zip(labels, out) if not o]
        for _ in range(T.EPOCHS):
            for k in order.permutation(len(rows)).tolist():
                model.learn(*rows[k])
        w = model.weights()
        held = [(i, y) for (i, y), o in zip(labels, out) if o]
        found = T.Model(np.flatnonzero(w), w[w != 0], model.constant()).scores([texts[i] for i, _ in held]) >= 0.3
        toxic = np.array([y == 1 for _, y in held])
        assert found[toxic].mean() >= least and found[~toxic].mean() <= 0.02


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (1, "", 9), (2, "bad " * 100_000, 9), (2, "bad " * 100_000, 9), (None, "bad", 9)], "doc_id long, text string, label int")
    nothing = T.fit(docs, docs.selectExpr("doc_id", "cast(null as int) as toxic"), "toxic")
    rows = T.toxicity(docs, nothing).collect()
    assert [r.score for r in rows] == [0.5] * 5
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, toxic int")
    assert len(T.toxicity(docs, T.fit(docs, labels, "toxic")).collect()) == 5
    assert T.toxicity(docs.where("false"), nothing).collect() == []


def test_features_are_those_of_each_text():
    texts = [b"a b c", b"", b"a", b"x y a b c"]
    text, at = T.features(Batch(texts, "alnum", True))
    whole = [set(at[text == i].tolist()) for i in range(4)]
    for i, t in enumerate(texts):
        assert set(T.features(Batch([t], "alnum", True))[1].tolist()) == whole[i]
    assert [len(x) for x in whole] == [6 + 3 * 3, 0, 1 + 3, 12 + 3 * 5] and whole[0] < whole[3]


def test_one_coordinate_at_a_time():
    """Dimensions that a row doesn't have stay as they are; L1 keeps weak ones at zero."""
    model = T.Ftrl(size=8, alpha=0.5, l1=1.0)
    for _ in range(50):
        model.learn(np.array([1, 2]), 1.0)
        model.learn(np.array([2, 3]), 0.0)
    w = model.weights()
    assert w[1] > 0 > w[3] and (w[[0, 4, 5, 6, 7]] == 0).all()
