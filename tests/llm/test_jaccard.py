import random
import re
from itertools import combinations

import numpy as np
import pytest

from tabletide.llm import jaccard as J
from tabletide.llm import queries as Q


def brute(docs, n, num, den):
    """docs: id, text.  id -> (size, smallest id of the component)."""
    sets = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and min(len(x), len(y)) * den >= num * max(len(x), len(y)):
            both = len(x & y)
            if den * both >= num * (len(x) + len(y) - both):
                p, q = find(a), find(b)
                label[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, count, sizes, edits):
    """Texts of random words, and chains of copies with a few words changed each time."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    out = []
    while len(out) < count:
        text = [word() for _ in range(rng.choice(sizes))]
        for _ in range(rng.randint(1, 8)):
            out.append(" ".join(text))
            for _ in range(rng.randint(0, max(1, int(len(text) * edits)))):
                k = rng.randrange(len(text))
                text[k : k + 1] = rng.choice([[], [word()], [text[k], word()]])
            text = text or [word()]
    return list(enumerate(out[:count]))


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 4, 5), (1, 1, 2)])
def test_small_and_large_sets(spark, n, num, den):
    docs = near_copies(n, 250, [1, 2, 3, 5, 8, 12, 16, 20, 24, 30, 40, 80, 300], 0.03)
    docs += [(1000, None), (1001, ""), (1002, " \n"), (1003, docs[5][1].upper()), (1004, docs[5][1].replace(" ", "\n  "))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar_components(spark.createDataFrame(docs, "doc_id long, text string"), n, num, den).collect()}
    assert got == brute(docs, n, num, den)


def test_tables(spark, small):
    docs = [(x.doc_id, x.text) for x in Q.read(spark, small, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op5_ngram_jaccard(spark, small).collect()}
    assert got == brute(docs, 3, 90, 100)


@pytest.mark.parametrize("grams, sets", [(400, 256), (2_000_000, 20)])
def test_split_clusters(spark, monkeypatch, grams, sets):
    """Blocks of a few sets: the second comparison has to join what the blocks left apart."""
    monkeypatch.setattr(J, "BLOCK_GRAMS", grams)
    monkeypatch.setattr(J, "BLOCK_SETS", sets)
    monkeypatch.setattr(J, "PIVOTS", 2)
    rng = random.Random(1)
    text = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(120):
        docs.append((i, " ".join(text)))
        text[rng.randrange(60)] = f"x{i}"
    rng.shuffle(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar_components(spark.createDataFrame(docs, "doc_id long, text string"), 1, 9, 10).collect()}
    assert got == brute(docs, 1, 9, 10)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(7, "a b c d", "z", 1), (7, "a b c d", "z", 1), (None, "a b c d", "z", 1), (3, "A B\tc D", "z", 2), (9, None, "z", 1)], "doc_id long, text string, node string, part int")
    assert sorted(map(tuple, J.similar_components(docs, 3, 9, 10).collect()), key=str) == sorted([(7, 2, 3), (7, 2, 3), (None, 2, 3), (3, 2, 3), (9, 0, 9)], key=str)
    assert J.similar_components(docs.where("false")).collect() == []


@pytest.mark.parametrize("num, den", [(9, 10), (4, 5), (1, 2)])
def test_similar_sets_always_meet(num, den):
    """Light sets by a subset of fixed size, heavy ones by one of their first n-grams in any order."""
    rule, rng = J.Rule(1, num, den), np.random.default_rng(0)
    met = 0
    for _ in range(600):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 60), dtype=np.uint64))
        keep = a[rng.random(len(a)) > 0.15 * (1 - num / den) * 5]
        b = np.unique(np.concatenate((keep, rng.integers(0, 1 << 63, rng.integers(0, 1 + len(a) // 12), dtype=np.uint64))))
        if len(b) and rule.similar(len(np.intersect1d(a, b)), len(a), len(b)):
            met += 1
            if max(len(a), len(b)) < rule.boundary:
                assert len(np.intersect1d(rule.subsets(a), rule.subsets(b))), (len(a), len(b))
            else:
                assert rule.is_heavy(len(a)) and rule.is_heavy(len(b))
                assert len(np.intersect1d(a[: rule.lists(len(a))], b[: rule.lists(len(b))]))
    assert met > 50


def test_hot_words(spark, monkeypatch):
    """n-grams that count as frequent everywhere, within tasks and over them."""
    monkeypatch.setattr(J, "FREQUENT", 3)
    monkeypatch.setattr(J, "HELD", 300)
    rng = random.Random(4)
    common = " ".join(f"c{i}" for i in range(12))
    docs = [(i, f"{text} {common}" if rng.random() < 0.7 else common) for i, text in near_copies(9, 150, [2, 4, 10, 30, 50], 0.05)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 2, 4, 5).collect()}
    assert got == brute(docs, 2, 4, 5)


def test_null_id_of_a_near_copy(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(None, long + " more"), (3, long)], "doc_id long, text string")
    assert sorted(map(tuple, J.similar_components(docs, 3, 9, 10).collect()), key=str) == sorted([(None, 59, 3), (3, 58, 3)], key=str)
