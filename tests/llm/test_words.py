"""Hashing of words, n-grams, sliding minima, blocks of records and connected components."""

import random
import re

import numpy as np
import pytest

from tabletide.llm import blocks, components, words as W


@pytest.mark.parametrize("kind, lower, pattern", [("space", False, rb"[^\x20\x09-\x0D]+"), ("space", True, rb"[^\x20\x09-\x0D]+"), ("alnum", True, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
@pytest.mark.parametrize("piece", [1 << 19, 7, 64])
def test_words_are_the_patterns(kind, lower, pattern, piece, monkeypatch):
    monkeypatch.setattr(W, "PIECE", piece)
    rng = random.Random(piece)
    texts = ["".join(rng.choices(["ab", "A", "é", "中", " ", "\n", "\x85", "\xa0", "1", "-", "\x00", "_", "x" * 100], k=rng.randint(0, 60))).encode() for _ in range(40)]
    batch = W.Batch(texts, kind, lower)
    by_word: dict[bytes, int] = {}
    for i, text in enumerate(texts):
        if lower:
            text = re.sub(rb"[A-Z]", lambda m: m[0].lower(), text)
        want = re.findall(pattern, text)
        a, b = batch.first[i], batch.first[i + 1]
        found = [x.lower() if lower else x for x in batch.words(a, b)]
        assert [re.sub(rb"[A-Z]", lambda m: m[0].lower(), x) if lower else x for x in batch.words(a, b)] == want and len(found) == len(want)
        for w, h in zip(want, batch.hashes[a:b].tolist()):
            assert by_word.setdefault(w, h) == h
    assert len({*by_word.values()}) == len(by_word)


def test_grams_do_not_depend_on_the_place():
    h = W.mix(np.arange(1, 100, dtype=np.uint64))
    for n in (1, 3, 6, 7, 35):
        whole = W.grams(h, n)
        assert len(whole) == 100 - n and len({*whole.tolist()}) == len(whole)
        assert (W.grams(h[20:70], n) == whole[20 : 71 - n]).all()
    assert len(W.grams(h[:3], 4)) == 0


def test_sliding_min():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 40):
        for width in (1, 2, 3, 7, 28, 50):
            v = rng.integers(0, 6, n).astype(np.uint64)
            k = min(width, n)
            want = [max(j for j in range(i, i + k) if v[j] == min(v[i : i + k])) for i in range(n - k + 1)]
            assert W.sliding_min(v, width).tolist() == want


def test_blocks():
    rng = np.random.default_rng(1)
    part, a, b = rng.integers(0, 5, 1000).astype(np.int32), rng.integers(0, 1 << 60, 1000).astype(np.uint64), rng.integers(-9, 9, 1000).astype(np.int64)
    found = blocks.gathered(blocks.dealt(3, part, a, b), {3: (np.uint64, np.int64), 4: (np.int64,)})
    assert sorted(zip(found[3][0].tolist(), found[3][1].tolist())) == sorted(zip(a.tolist(), b.tolist())) and len(found[4][0]) == 0
    assert list(blocks.dealt(0, part[:0], a[:0])) == []


def brute(edges):
    label = {x: x for e in edges for x in e}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        label[max(p, q)] = min(p, q)
    return {x: find(x) for x in label}


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed, monkeypatch):
    rng = random.Random(seed)
    edges = [(rng.randrange(-80, 80), rng.randrange(-80, 80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 240)] + [(500, i) for i in range(501, 540)]
    rng.shuffle(edges)
    nodes, labels = components.smallest_labels(np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
    assert dict(zip(nodes.tolist(), labels.tolist())) == brute(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    for most in (0, len(edges)):
        monkeypatch.setattr(components, "ONE_TASK", most)
        rows = components.connected(df.repartition(3)).collect()
        assert {r.node: r.label for r in rows} == brute([e for e in edges if e[0] != e[1]]) and len(rows) == len({r.node for r in rows})
        assert components.connected(df.where("false")).collect() == []


def test_hubs(spark, monkeypatch):
    """Nodes with a large share of all edges, in a graph of several tasks."""
    monkeypatch.setattr(components, "ONE_TASK", 0)
    monkeypatch.setattr(components, "EDGES", 100)
    monkeypatch.setattr(components, "HUB_SHARE", 10)
    edges = [(0, i) for i in range(1, 300)] + [(1000 - i, 1000) for i in range(1, 250)] + [(2000 + i, 2001 + i) for i in range(40)] + [(299, 2000)]
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == brute(edges)
