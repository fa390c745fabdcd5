"""Dealing in two levels: the same records in the same parts, in rows of many records."""

import pickle
from collections import Counter

import numpy as np
import pytest

from tabletide.llm import blocks, jaccard, substring
from tabletide.session import importable
from test_jaccard import brute

HUGE = 1_200_000


def test_levels():
    assert blocks.Parts(blocks.DIRECT).step == 1 and blocks.Parts(HUGE).step == 1096
    assert (pickle.loads(pickle.dumps(blocks.Parts(30, 4))).step, blocks.Parts(30, 4)) == (4, 30)


@pytest.mark.parametrize("step", [1, 7])
def test_records_reach_their_parts(spark, step):
    importable(spark)
    parts = blocks.Parts(60, step)

    def deal(batches):
        for batch in batches:
            x = batch.column(0).to_numpy()
            yield from blocks.dealt(0, (x % 60).astype(np.int32), x, (x * 2).astype(np.uint32), parts=parts)
            yield from blocks.dealt(3, (x // 9 % 60).astype(np.int32), x.astype(np.uint64), parts=parts)

    def gather(batches):
        import pyarrow as pa

        found = blocks.gathered(batches, {0: (np.int64, np.uint32), 3: (np.uint64,)})
        from pyspark import TaskContext

        at = TaskContext.get().partitionId()
        for kind, x in ((0, found[0][0]), (3, found[3][0].astype(np.int64))):
            yield pa.RecordBatch.from_pydict({"at": pa.array([at] * len(x), pa.int64()), "kind": pa.array([kind] * len(x), pa.int64()), "x": pa.array(x, pa.int64()), "twice": pa.array(found[0][1].astype(np.int64) if kind == 0 else x * 2, pa.int64())})

    df = spark.range(20_000, numPartitions=5).mapInArrow(deal, blocks.DDL)
    got = blocks.by_part(df, parts).mapInArrow(gather, "at long, kind long, x long, twice long").collect()
    assert Counter((r["at"], r["kind"], r["x"]) for r in got) == Counter([(x % 60, 0, x) for x in range(20_000)] + [(x // 9 % 60, 3, x) for x in range(20_000)])
    assert all(r["twice"] == 2 * r["x"] for r in got)


def test_rows_of_many_records():
    """With as many parts as 100 TB have, a task's records make rows of hundreds, and a range's of thousands."""
    parts, r = blocks.Parts(HUGE), np.random.default_rng(1)
    part = r.integers(0, HUGE, 1 << 20).astype(np.int32)
    first = [n for b in blocks.dealt(0, part, part.astype(np.uint64), part.astype(np.int64), parts=parts) for n in b.column(2).to_pylist()]
    assert sum(first) == 1 << 20 and np.mean(first) > 500
    # a range's rows, from as many tasks as give it GATHERED bytes
    own = r.integers(0, parts.step, 4 << 20).astype(np.int32)
    rows = list(blocks._dealt_again(b for i in range(0, len(own), 1000) for b in blocks.dealt(0, own[i : i + 1000], own[i : i + 1000].astype(np.int64), parts=parts)))
    second = [n for b in rows for n in b.column(2).to_pylist()]
    assert sum(second) == len(own) and np.mean(second) > 1000


def test_operators(spark, monkeypatch):
    """The joins give the same rows when everything is dealt in two levels."""
    for operator in (jaccard, substring):
        monkeypatch.setattr(operator, "partitions", lambda *a: blocks.Parts(30, 4))
    rng = np.random.default_rng(3)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 90)) for _ in range(12)]
    docs = [(i, base[i % 12] + (f" tail{i}" if i % 5 else "") if i % 7 else " ".join(f"u{i}_{k}" for k in range(60))) for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute(docs, 3, 90, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(df, 3, 90, 100).collect()} == {k: tuple(v) for k, v in want.items()}
    windows = Counter(tuple(w[k : k + 35]) for _, t in docs for w in (t.split(),) for k in range(len(w) - 34))
    gone = {i: len({k + o for k in range(len(w) - 34) if windows[tuple(w[k : k + 35])] > 1 for o in range(35)}) for i, t in docs for w in (t.split(),)}
    assert {r.doc_id: r.n_removed for r in substring.without_repeats(df, 35).collect()} == gone
