"""Operators that answer each document by itself, and exact duplicates."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tabletide.llm import queries as Q

ODD = [
    (1, "a b  c\n"), (2, "a b c "), (3, None), (4, ""), (5, " "), (6, "a b c "), (6, "a b c "), (7, "über ÜBER 12"), (8, "x" * 300_000), (9, "x" * 300_000 + "y"),
    (10, "\t\n"), (11, "a b c"), (12, "  z"), (13, "one two three four five six seven eight nine ten eleven " * 50), (14, "123 456"), (15, "l'été <|endoftext|> don't  \n\n stop"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Extra columns have the names that operators use inside."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in ODD], "doc_id long, text string, keep_id string, hash long, shard int")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def test_exact_on_odd_rows(odd, empty):
    from tabletide.llm.exact import exact_duplicates

    def norm(t):
        return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")

    groups = defaultdict(list)
    for i, t in ODD:
        groups[norm(t)].append(i)
    want = sorted((i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in ODD)
    assert sorted(map(tuple, exact_duplicates(odd).collect())) == want
    assert exact_duplicates(empty).collect() == []


@pytest.mark.parametrize("limit", [1 << 40, 20_000, 900])
def test_trie(limit):
    """Nodes branch where keys part; what is taken away in subtrees and what is left are all keys, with their owners."""
    from tabletide.llm.exact import Trie

    rng = random.Random(limit)
    keys = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"ab", b"", b"abcdef", b"abcxyz", b"a" * 1000, b"a" * 999 + b"b"]
    keys += [bytes(rng.choices(b"ab", k=rng.randint(0, 12))) for _ in range(400)]
    trie, parts, want = Trie(), [], {}
    for i, k in enumerate(keys):
        trie.add(k, 1000 - i, 1)
        old = want.get(k, (None, 0))
        want[k] = (1000 - i, old[1] + 1)
        if trie.size > limit:
            parts.extend(trie.spilled(limit // 2))
            assert trie.size <= limit // 2
    if limit == 1 << 40:
        assert {len(x[1]) for x in trie.root[1].values()} == {2} and trie.root[3] == sum(map(len, want)) + 400 * len(want)
    got = {}
    for k, owner, n in [*parts, *trie.items()]:
        old = got.get(k, (10_000, 0))
        got[k] = (min(owner, old[0]), n + old[1])
    assert got == want


def test_exact_matches_plain_grouping(spark, small):
    rows = Q.op4_exact_dedup(spark, small).collect()
    docs = {x.doc_id: re.sub(r"[\x20\x09-\x0D]+", " ", x.text or "") for x in Q.read(spark, small, "documents").collect()}
    first, size = {}, defaultdict(int)
    for i in sorted(docs):
        first.setdefault(docs[i], i)
        size[docs[i]] += 1
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.keep_id, r.group_size, r.kept) == (first[docs[r.doc_id]], size[docs[r.doc_id]], r.doc_id == first[docs[r.doc_id]])


def test_tokens_are_the_librarys(spark, small, odd, empty):
    tokenizers = pytest.importorskip("tokenizers")
    from tabletide.llm import tokens

    path = Q.tokenizer_path()
    library = tokenizers.Tokenizer.from_file(path)
    rows = Q.op10_token_counts(spark, small).collect()
    docs = {x.doc_id: x.text for x in Q.read(spark, small, "documents").collect()}
    for r in rows:
        n = len(library.encode(docs[r.doc_id] or "", add_special_tokens=False))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((docs[r.doc_id] or "").encode()), n > 512)
    got = sorted((x.doc_id, x.n_tokens) for x in tokens.token_counts(odd, path).collect())
    assert got == sorted((i, len(library.encode(t or "", add_special_tokens=False))) for i, t in ODD)
    assert tokens.token_counts(empty, path).collect() == []
    text = "It's 1234 they'll  go…  \n\n x<|endoftext|>y été  中文 \x1c z " * 40
    counter = tokens.Counter(path)
    assert counter.count([text, text[:77]]) == [len(library.encode(t, add_special_tokens=False)) for t in (text, text[:77])]
    for size in (5, 50, 700):
        assert "".join(tokens.parts(text, size)) == text
        assert sum(len(library.encode(x, add_special_tokens=False)) for x in tokens.parts(text, size)) == len(library.encode(text, add_special_tokens=False))


def test_sharding(spark, small, odd, empty):
    from tabletide.llm.sharding import shard

    rows = Q.op7_sharding(spark, small).collect()
    docs = {x.doc_id: x.text or "" for x in Q.read(spark, small, "documents").collect()}
    slots = defaultdict(list)
    for r in rows:
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24 and r.law == "key"
        assert (r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 8, zlib.crc32(docs[r.doc_id].encode()))
        slots[r.shard].append(r.slot)
    assert len(rows) == len(docs) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    many = spark.range(20_000).selectExpr("id as doc_id", "'' as text")
    got = shard(many, [1, 2, 1, 0]).groupBy("shard").count().collect()
    share = {r.shard: r["count"] / 20_000 for r in got}
    assert set(share) == {0, 1, 2} and abs(share[1] - 0.5) < 0.02 and abs(share[0] - 0.25) < 0.02
    assert shard(empty, [1.0]).collect() == []
    assert sorted(x.slot for x in shard(odd, [1.0]).collect()) == list(range(len(ODD)))


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _brute(docs, items):
    out = {}
    for i, text in docs:
        words, hit, found = _words(text), set(), set()
        for item, other in items:
            w = _words(other)
            n = min(10, len(w))
            windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
            for k in range(len(words) - n + 1):
                if n and tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        out.setdefault(i, (len(words), len(hit), sorted(found)))
    return out


def test_decontamination(spark, small, odd, empty, monkeypatch):
    from tabletide.llm import decontaminate as D

    docs = [(x.doc_id, x.text) for x in Q.read(spark, small, "documents").collect()]
    items = [(x.item_id, x.text) for x in Q.read(spark, small, "benchmark").collect()]
    want = _brute(docs, items)
    rows = Q.op9_decontamination(spark, small).collect()
    assert len(rows) == len(docs) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0)
    odd_items = [(1, "Two three FOUR"), (2, "über"), (2, "456"), (3, None), (4, "..."), (5, " ".join(["one two three four five six seven eight nine ten eleven"] * 2)), (10, "b c"), (11, "x" * 300_000)]
    bench = spark.createDataFrame(odd_items, "item_id int, text string")
    want = _brute(ODD, odd_items)
    for block in (D.BLOCK_BYTES, 60):  # one block, then many
        monkeypatch.setattr(D, "BLOCK_BYTES", block)
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in D.contamination(odd, bench if block > 60 else bench.where("item_id < 11")).collect()}
        if block > 60:
            assert got == want
            assert sorted(x.doc_id for x in D.clean(odd, bench).collect()) == sorted(i for i, _ in ODD if not want[i][1])
        else:
            assert got == _brute(ODD, odd_items[:-1])
    monkeypatch.undo()
    assert D.contamination(empty, bench).collect() == [] and D.clean(odd, bench.where("false")).count() == len(ODD)


def test_language(spark, small, odd, empty):
    from tabletide.llm import language as L

    rows = Q.op6_language_id(spark, small).collect()
    docs = {x.doc_id: x for x in Q.read(spark, small, "documents").collect()}
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)
    model = L.fit(Q.read(spark, small, "documents"), "text", "lang")
    got = {r.doc_id: r for r in L.identify(odd, model).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {3, 4, 5, 10, 14}
    assert L.identify(empty, model).collect() == []
    assert {x.doc_id for x in L.known_language(odd, model).collect()} == {i for i, _ in ODD} - {3, 4, 5, 10, 14}
    none = L.fit(odd.selectExpr("text", "cast(null as string) as lang"), "text", "lang")
    assert {r.lang_pred for r in L.identify(odd, none).collect()} == {"und"}


def test_rejected_languages(spark):
    """What is no language, or two alike, goes; so does what isn't wanted.  Ids mean nothing."""
    from tabletide.llm import language as L

    rng = random.Random(3)
    rows = [(lang, " ".join("".join(rng.choices(letters, k=5)) for _ in range(12))) for lang, letters in (("en", "abcdefg"), ("es", "hijklmn")) for _ in range(100)]
    model = L.fit(spark.createDataFrame(rows, "label string, text string"), "text", "label")
    words = [[w for _, text in part for w in text.split()] for part in (rows[:100], rows[100:])]
    # of mixtures of both, a word more or less of one, the one that the model is least sure of
    mixtures = [" ".join((*words[0][a:], *words[1][b:])) for a, b in [(k, 0) for k in range(0, 120, 2)] + [(0, k) for k in range(0, 120, 2)]]
    both = min(zip((p[1] for p in model.predict([x.encode() for x in mixtures])), mixtures))[1]
    docs = [(None, rows[0][1]), (None, rows[0][1]), (1, rows[150][1]), (1, None), (2, "12 ."), (3, both)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [p[2] for p in model.predict([both.encode(), *(text.encode() for _, text in rows)])] == [True] + [False] * len(rows)
    assert sorted(map(tuple, L.known_language(df, model).collect()), key=str) == sorted([docs[0], docs[1], docs[2]], key=str)
    assert [r.doc_id for r in L.known_language(df, model, languages=["es"]).collect()] == [1]
    assert L.known_language(df.where("false"), model).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9, 20, 128])
def test_codewords_differ(n):
    from tabletide.llm.language import codewords

    code = codewords(n)
    assert len({tuple(x) for x in code.tolist()}) == n and (abs(code.sum(0)) < n).all()


def test_language_sample_of_repeated_texts(spark):
    """Copies of one text take no other text's place in the sample, of their language or of another."""
    from tabletide.llm import language as L

    rng = random.Random(5)
    rows = [(lang, "".join(rng.choices(letters, k=60))) for lang, letters in (("en", "abcdefg"), ("es", "hijklmn"), ("fr", "opqrstu")) for _ in range(400)]
    copies = [("es", "hijk lmn hijk")] * 4000 + [("en", rows[0][1])] * 3000

    def fitted(rows):
        df = spark.createDataFrame(rows, "label string, text string").repartition(5)
        return L.fit(df, "text", "label", limit=300)

    once, many = fitted(sorted({*rows, *copies})), fitted(rows + copies)
    assert once.languages == many.languages == ["en", "es", "fr"]
    assert (once.weights == many.weights).all() and (once.bias == many.bias).all()


def test_every_language_is_learned(spark):
    from tabletide.llm import language as L

    rows = [(f"l{i:03}", f"{chr(0x4E00 + 40 * i)}{chr(0x4E01 + 40 * i)} " * (5 + k)) for i in range(140) for k in range(4 if i else 9)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, label string, text string")
    model = L.fit(df, "text", "label")
    assert len(model.languages) == 140
    got = {r.doc_id: r.lang_pred for r in L.identify(df, model).collect()}
    assert sum(got[k] == label for k, (label, _) in enumerate(rows)) >= 0.95 * len(rows)
