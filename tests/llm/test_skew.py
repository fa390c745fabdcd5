"""One text, host or source with a third of all rows, and tasks that hold little: the same results."""

import random
from collections import Counter

import pytest

from tabletide.llm import exact, html, sharding, substring, tokens
from tabletide.llm import queries as Q


@pytest.mark.parametrize("held, hot", [(100, 1000), (16 << 20, 2), (100, 1)])
def test_exact_copies(spark, monkeypatch, held, hot):
    monkeypatch.setattr(exact, "HELD_BYTES", held)
    monkeypatch.setattr(exact, "HOT_SHARE", hot)
    rng = random.Random(held)
    docs = [(i, "the same text" if i % 3 == 0 else f"text {rng.randrange(40)} " + "x" * rng.randrange(3)) for i in range(600)]
    rng.shuffle(docs)
    size = Counter(t for _, t in docs)
    first = {}
    for i, t in sorted(docs):
        first.setdefault(t, i)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.exact_duplicates(df).collect()}
    assert got == {i: (first[t], size[t], first[t] == i) for i, t in docs}


def test_groups_of_pages(spark, monkeypatch):
    """A host's pages are split in groups, none of a few pages; each group finds the template by itself."""
    monkeypatch.setattr(html, "GROUP_PAGES", 10)
    pages, want = [], {}
    rng = random.Random(0)
    for i in range(140):
        host = "hot.example" if i % 3 else f"h{i % 7}.example"
        text = " ".join("".join(rng.choices("abcdef", k=7)) for _ in range(8))
        pages.append((i, f"https://{host}/{i}", f"<div>{host} says hello to everyone</div><div>{text}</div><div>copyright by {host}</div>"))
        want[i] = text
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in html.main_text(df).collect()}
    few = Counter(u.split("/")[2] for _, u, _ in pages)
    assert sum(got[i] == want[i] for i, u, _ in pages if few[u.split("/")[2]] >= 6) >= 0.9 * sum(few[u.split("/")[2]] >= 6 for _, u, _ in pages)
    assert all(want[i] in got[i] for i in got) and len(got) == 140


def test_repeated_rows_everywhere(spark, monkeypatch):
    monkeypatch.setattr(substring, "HELD", 64)
    words = [f"w{i}" for i in range(300)]
    docs = [(1, " ".join(words))] * 20 + [(i, " ".join(words[i : i + 60])) for i in range(2, 40)] + [(99, " ".join(reversed(words)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = substring.without_repeats(df, 35).collect()
    assert len(got) == len(docs) and all(r.n_removed == (0 if r.doc_id == 99 else r.n_words) for r in got)


def test_slots_of_equal_rows(spark):
    df = spark.range(900).selectExpr("id % 3 as doc_id", "'t' as text")
    rows = sharding.shard(df, [1.0] * 4).collect()
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_token_memory_is_bounded(monkeypatch):
    pytest.importorskip("tokenizers")
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    counter = tokens.Counter(Q.tokenizer_path())
    texts = [f"word{i} and other words{i}" for i in range(30)]
    want = [len(counter.tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    assert [counter.count([t])[0] for t in texts] == want and counter.count(texts) == want
    assert len(counter.known) < 200
