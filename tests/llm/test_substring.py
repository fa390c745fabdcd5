import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tabletide.llm import queries as Q
from tabletide.llm import substring as S


def brute(docs, window):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    seen = Counter(tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def run(spark, docs, window):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, key int, block string")
    return sorted([(r.doc_id, r.n_words, r.n_removed, bytes(r.text).decode()) for r in S.without_repeats(df, window).collect()], key=str)


@pytest.mark.parametrize("seed", range(6))
def test_factors_are_the_longest_matches(seed):
    """Each factor against all places of the reference; the windows left over match nothing."""
    rng = random.Random(seed)
    texts = {k * 1000: [rng.randrange(4) for _ in range(rng.randint(1, 40))] for k in range(12)}
    texts[99_000] = texts[0] + texts[1000]
    places = [(k, i) for k, t in sorted(texts.items()) for i in range(len(t)) if rng.random() > 0.05]  # windows that are missing end a run
    ids = np.array([texts[k][i] for k, i in places])
    asked = np.array([k % 3000 == 0 for k, _ in places])

    def run(p):
        end = p + 1
        while end < len(places) and places[end] == (places[p][0], places[end - 1][1] + 1):
            end += 1
        return tuple(ids[p:end].tolist())

    runs = [run(p) for p in range(len(places))]

    def longest(p):
        best = 0
        for q in range(len(places)):
            if q != p:
                n = 0
                while n < min(len(runs[p]), len(runs[q])) and runs[p][n] == runs[q][n]:
                    n += 1
                best = max(best, n)
        return best

    want, p = [], 0
    while p < len(places):
        n = longest(p) if asked[p] else 0
        if n:
            want.append((*places[p], n))
        p += max(1, n)
    key, at = np.array([k for k, _ in places]), np.array([i for _, i in places], np.uint32)
    got = S.factors(np.unique(ids, return_inverse=True)[1], key, at, asked)
    assert list(zip(*(x.tolist() for x in got[:3]))) == want
    where = {x: i for i, x in enumerate(places)}
    for k, i, n, rk, ri in zip(*(x.tolist() for x in got)):
        assert (k, i) != (rk, ri) and runs[where[k, i]][:n] == runs[where[rk, ri]][:n]


def test_hot_anchors(spark, monkeypatch):
    """A line that many texts have, each time in other words, is spread over blocks; the same rows come out."""
    rng = random.Random(2)
    line = " ".join(f"c{i}" for i in range(10))
    docs = [(i, " ".join(f"{rng.randrange(9)}x" for _ in range(rng.randint(0, 9))) + f" {line} " + " ".join(f"{rng.randrange(9)}y" for _ in range(9))) for i in range(200)]
    monkeypatch.setattr(S, "HOT_SHARE", 50)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert 0 < len(S._hot_anchors(df, 12)) < 50
    assert run(spark, docs, 12) == brute(docs, 12)


@pytest.mark.parametrize("window, held", [(4, 1 << 20), (12, 1 << 20), (35, 1 << 20), (12, 50)])
def test_random_texts(spark, window, held, monkeypatch):
    monkeypatch.setattr(S, "HELD", held)
    rng = random.Random(window)
    phrases = [[f"w{rng.randrange(30)}" for _ in range(rng.randint(1, 60))] for _ in range(25)]
    docs = [(i, rng.choice([" ", "\n", "  "]).join(sum(rng.choices(phrases, k=rng.randint(0, 6)), []))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, "a " * 200), (104, "b c " * 30_000), (105, "word" * 50_000), (103, "é\x85x " * 3 + "　 b"), (None, docs[3][1]), (7, docs[7][1]), (7, "other text " * 3)]
    assert run(spark, docs, window) == brute(docs, window)


def test_tables(spark, small):
    docs = [(x.doc_id, x.text) for x in Q.read(spark, small, "documents").collect()]
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in Q.op3_substring_dedup(spark, small).collect()])
    assert got == sorted((i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in brute(docs, 35))
    assert any(x[2] for x in got)


def test_empty_table(spark):
    assert run(spark, [], 35) == []
