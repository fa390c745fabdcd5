"""Words, and runs of words, whose patterns cancel out under hashes that add up are told apart everywhere."""

import numpy as np
import pytest

from tabletide.llm import decontaminate, jaccard, substring
from tabletide.llm import words as W


def pattern(doublings):
    """A sequence of 0 and 1, each half the other's complement: two such differ in no polynomial hash modulo a power of two."""
    out = [0]
    for _ in range(doublings):
        out += [1 - x for x in out]
    return out


def two_words(doublings=11):
    bits = pattern(doublings)
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


@pytest.mark.parametrize("doublings", range(1, 13))
def test_hashes(doublings):
    a, b = two_words(doublings)
    batch = W.Batch([a.encode(), b.encode()], "space", False)
    second = batch.second()
    assert len({*batch.hashes.tolist(), *second.tolist()}) == 4
    bits = pattern(doublings)
    runs = [np.array([batch.hashes[x] for x in bits], np.uint64), np.array([batch.hashes[1 - x] for x in bits], np.uint64)]
    assert W.grams(runs[0], len(bits))[0] != W.grams(runs[1], len(bits))[0]
    assert W.grams(runs[0], len(bits) // 2 + 1)[0] != W.grams(runs[1], len(bits) // 2 + 1)[0]


def test_words_of_each_length():
    """Every length up to beyond LONG, bytes of zero included, and each byte counts."""
    words = [b"a" * n for n in range(1, 2 * W.LONG)] + [b"\0" * n for n in range(1, 40)]
    words += [b"a" * k + b"b" + b"a" * (n - k - 1) for n in (7, 8, 9, 16, 17, 300) for k in range(n)]
    assert len({*W.hash_words(b" ".join(words), "space", False)[0].tolist()}) == len({*words})


def test_operators(spark):
    a, b = two_words()
    docs = spark.createDataFrame([(1, " ".join([a] * 35)), (2, " ".join([b] * 35))], "doc_id long, text string")
    assert [r.n_removed for r in substring.without_repeats(docs, 35).collect()] == [0, 0]
    assert {r.doc_id: r.component_id for r in jaccard.similar_components(docs, 3, 90, 100).collect()} == {1: 1, 2: 2}
    bench = spark.createDataFrame([("x", " ".join([a] * 12))], "item_id string, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.contamination(docs, bench).collect()} == {1: 35, 2: 0}


def test_a_hash_alone_is_no_hit(spark, monkeypatch):
    """With all windows hashed alike, words are still compared."""
    monkeypatch.setattr(decontaminate, "grams", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    index = decontaminate.Index([("x", b"a b c d e f g h i j k"), ("y", b"A B c d e f g h i j"), ("z", b"p q")], 10, 5)
    hit, items = index.hits(W.Batch([b"z a b C d e f g h i j z", b"b a c d e f g h i j", b"q p q"], "alnum", True))
    assert hit.tolist() == [False, *[True] * 10, False, *[False] * 10, False, True, True]
    assert items == {0: {0, 1}, 2: {2}}


#: Words of different lengths that a sum of length and bytes makes equal, under any seed that is added to the length.
CANCELLING = [(bytes.fromhex("054D040000 6CC29B"), bytes.fromhex("2121C297")), (bytes.fromhex("055B040000 6CC29B"), bytes.fromhex("212FC297"))]


@pytest.mark.parametrize("pair", CANCELLING)
def test_lengths_and_bytes_do_not_cancel(spark, pair):
    x, y = (w.decode() for w in pair)
    batch = W.Batch([w for w in pair], "space", False)
    assert len({*batch.hashes.tolist(), *batch.second().tolist()}) == 4
    docs = spark.createDataFrame([(1, " ".join([x] * 35)), (2, " ".join([y] * 35))], "doc_id long, text string")
    # a window is one word over and over here, so only words that differ keep it
    assert [r.n_removed for r in substring.without_repeats(docs, 35).collect()] == [0, 0]
    docs = spark.createDataFrame([(1, f"{x} a b"), (2, f"{y} a b")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.similar_components(docs, 3, 90, 100).collect()} == {1: 1, 2: 2}


@pytest.mark.parametrize("short", range(1, 8))
def test_no_cancelling_word_is_found(short):
    """For a word of each length, the bytes that a longer word would need if length and bytes were added up, for any odd multiplier used here."""
    r, found = np.random.default_rng(short), 0
    for multiplier in (W.ODD, W.LENGTH, *W.SCRAMBLERS[0][1], *W.SCRAMBLERS[1][1]):
        for other in (W.ODD, W.LENGTH):
            inverse = pow(int(multiplier), -1, 1 << 64)
            a = r.integers(33, 127, (200, short), dtype=np.uint8)
            for word in a:
                low = int.from_bytes(word.tobytes(), "little")
                for longer in range(short + 1, 9):
                    long = ((short - longer) * int(other) * inverse + low) % (1 << 64)
                    data = long.to_bytes(8, "little")[:longer]
                    if int.from_bytes(data, "little") != long or any(x in b"\t\n\v\f\r " for x in data):
                        continue
                    hashes = {W.hash_words(w, "space", False, seed)[0][0] for w in (word.tobytes(), data) for seed in (0, 1)}
                    assert len(hashes) == 4
                    found += 1
    assert found > 100
