"""The transducer against the tiktoken library, and streaming decoding against decoding at once."""

import hashlib
import random

import pytest

from tabletide.llm import bpe
from tabletide.llm.queries import op13_byte_bpe, read, tokenizer_path

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def path():
    try:
        return tokenizer_path("byte_bpe_multi_50k.tiktoken")
    except ImportError:
        pytest.skip("no tokenizer files here")


@pytest.fixture(scope="module")
def ranks(path):
    return bpe.ranks_of(path)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks, bpe.newer_characters())


def test_query(spark, small, library):
    want = set()
    for r in read(spark, small, "documents").collect():
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    assert {tuple(r) for r in op13_byte_bpe(spark, small).collect()} == want


RANGES = ((32, 126), (0xA0, 0x24F), (0x370, 0x5FF), (0x600, 0xDFF), (0x2000, 0x2100), (0x4E00, 0x4FFF), (0xAC00, 0xAD00), (0, 0xD7FF), (0xE000, 0x10FFFF))


def strange(r):
    return "".join(chr(r.randint(*r.choice(RANGES))) for _ in range(r.randint(1, 30)))


def wordlike(r):
    return "".join(r.choice(["th", "e", "in", "an", "qu", "é", "o", "st", "ing", "ß", "ab", " ", "'s", "中", "\n", "1", "--"]) for _ in range(r.randint(1, 25)))


@pytest.mark.parametrize("make", [strange, wordlike])
def test_library(encoder, library, make):
    r = random.Random(7)
    for _ in range(4000):
        text = make(r)
        assert encoder.encode(text).tolist() == library.encode_ordinary(text), text


def test_every_character(encoder, library):
    """Letters, numbers and spaces are what the library takes for them, also those newer than its Unicode tables."""
    for start in range(0, 0x30000, 0x400):
        text = "".join(f"a{chr(c)}1" for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000)
        assert encoder.encode(text).tolist() == library.encode_ordinary(text), hex(start)


def test_side_by_side(ranks):
    """Two tokens fit exactly if merging their bytes makes them again."""
    t, r, ids = bpe.Transducer(ranks), random.Random(3), list(ranks.values())
    common = [x for x in ids if x < 3000]
    for k in range(30_000):
        a, b = (r.choice(common), r.choice(common)) if k % 2 else (r.choice(ids), r.choice(ids))
        x, y = t.tokens[a], t.tokens[b]
        assert t.fits(a, b) == (t.merged(x + y) == [x, y]), (x, y)


def test_tokens_come_early(ranks, library):
    """Tokens are certain after few bytes, however long the piece, and emitted then."""
    t, r = bpe.Transducer(ranks), random.Random(9)
    longest = max(map(len, ranks))
    for piece in (b"ab" * 3000, b"a" * 6000, "中文".encode() * 2000, bytes(r.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))):
        stream, out, done, waited = t.stream(), [], 0, 0
        for n, byte in enumerate(piece, 1):
            sure = stream.feed(bytes([byte]))
            out += sure
            done += sum(len(t.tokens[x]) for x in sure)
            waited = max(waited, n - done)
        assert waited <= 4 * longest
        assert out + stream.end() == t.encode(piece) == library.encode_ordinary(piece.decode())


def test_begun_anew(ranks, library, encoder):
    """Few states and pieces kept give the same tokens; so do texts split as they are read."""
    few, r = bpe.Encoder(ranks, bpe.newer_characters(), 20), random.Random(4)
    few.transducer.most = 50
    for _ in range(300):
        text = wordlike(r) + strange(r)
        assert few.encode(text).tolist() == library.encode_ordinary(text)


def test_long_texts(encoder, library, monkeypatch):
    r = random.Random(6)
    text = " ".join(wordlike(r) for _ in range(3000)) + "x" * 5000
    want = library.encode_ordinary(text)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(bpe, "RUN", 7)
    assert encoder.encode(text).tolist() == want


def test_characters_in_pieces():
    """Any bytes, cut anywhere, give what decoding at once gives."""
    r = random.Random(2)
    pool = [b"a", "é".encode(), "中".encode(), "\U0001f600".encode(), b"\xed\xa0\x80", b"\xc0\x80", b"\xf4\x90\x80\x80", b"\xe0\x9f", b"\xf0\x90", b"\x80", b"\xff", b"\xf0\x8f\xbf\xbf"]
    for _ in range(20_000):
        data = b"".join(r.choice(pool) for _ in range(r.randint(0, 8)))
        data = data[r.randint(0, 2) :]
        characters, out, at = bpe.Characters(), [], 0
        while at < len(data):
            to = at + r.randint(1, 4)
            out.append(characters.feed(data[at:to]))
            at = to
        assert "".join([*out, characters.end()]) == data.decode("utf-8", "replace")


def test_operators(spark, path, library, monkeypatch):
    long = "thé qu中 " * 30_000 + "<|endoftext|>"
    texts = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "x\n\n y"), (4, long), (5, "nospace" * 20_000)]
    docs = spark.createDataFrame([(i, x, 0, "z") for i, x in texts], "doc_id long, text string, ids long, n_tokens string")
    encoded = bpe.encode(docs, path)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    got = sorted(((r.doc_id, r.n_tokens, r.ids) for r in encoded.collect()), key=str)
    assert got == sorted(((i, len(t), t) for i, x in texts for t in [library.encode_ordinary(x or "")]), key=str)
    both = bpe.encode(docs, path, decoded_col="back again").select("doc_id", "back again").collect()
    assert sorted(map(tuple, both), key=str) == sorted(((i, x or "") for i, x in texts), key=str)
    decoded = bpe.decode(encoded, path)
    assert decoded.columns == ["doc_id", "n_tokens", "text"]
    assert sorted(((r.doc_id, r.text) for r in decoded.collect()), key=str) == sorted(((i, x or "") for i, x in texts), key=str)
    assert bpe.encode(docs.limit(0), path).collect() == [] and bpe.decode(encoded.limit(0), path).collect() == []
    odd = spark.createDataFrame([(1, None, "old"), (2, [], "old"), (3, [library.encode_ordinary("中")[0]], "old")], "doc_id long, ids array<int>, text string")
    assert [r.text for r in bpe.decode(odd, path).orderBy("doc_id").collect()] == [None, "", library.decode(library.encode_ordinary("中")[:1])]
    with pytest.raises(Exception, match="no token has the id 70000"):
        bpe.decode(spark.createDataFrame([([70_000],)], "ids array<int>"), path).collect()
