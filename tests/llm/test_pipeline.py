"""The pipeline's stages against brute force, each on its own input."""

import re
from collections import defaultdict

import pytest

from test_jaccard import brute as similar
from test_simple_ops import _brute as contaminated

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, small, tmp_path):
    from tabletide.llm.language import fit
    from tabletide.llm.queries import held_out, read

    docs = read(spark, small, "documents")
    odd = spark.createDataFrame([(10_000, None, "en", "s", 0), (10_001, "123 456 ...", "en", "s", 0), (10_002, "", None, None, None)], docs.schema)
    repeated = docs.where("doc_id = 3")
    docs = docs.union(odd).union(repeated)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs_before = [tuple(r) for r in docs.collect()], docs
        out = stage(spark, docs, small)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = [tuple(r) for r in docs.collect()]
        if name == "language_id":
            model = fit(docs_before.where(~held_out("doc_id", 5, 0)), "text", "lang")
            answers = model.predict([(r[1] or "").encode() for r in before])
            want = [r for r, (found, _, ambiguous) in zip(before, answers) if found != "und" and not ambiguous]
            assert not {10_000, 10_001, 10_002} & {r[0] for r in after} and len(want) > 0.95 * len(before)
        elif name == "exact_dedup":
            first = {}
            for r in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1]), r)
            want = list(first.values())
        elif name == "near_dedup":
            groups = similar([r[:2] for r in before], 5, 4, 5)
            want = [r for r in before if groups[r[0]][1] == r[0]]
        elif name == "decontaminate":
            hits = contaminated([r[:2] for r in before], [(x.item_id, x.text) for x in read(spark, small, "benchmark").collect()])
            want = [r for r in before if not hits[r[0]][1]]
        else:
            texts = defaultdict(dict)
            for r in docs.collect():
                texts[r.doc_id][r.piece] = (r.start, r.text)
            assert {i: "".join(p[k][1] for k in sorted(p)) for i, p in texts.items()} == {r[0]: r[1] for r in before}
            assert all(start == sum(len(p[j][1]) for j in range(k)) for p in texts.values() for k, (start, _) in p.items())
            continue
        assert sorted(after) == sorted(want), name
        assert len(after) < len(before), name


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0


def test_null_and_repeated_ids(spark, small):
    """No text is lost because its row has no id or shares it, and none stays beside its copy."""
    long = " ".join(f"w{i}" for i in range(60))
    near = long + " more"
    a, b = "a b c d e f g", "h i j k l m n"
    stages = dict(corpus_pipeline.STAGES)

    def kept(stage, rows):
        docs = spark.createDataFrame([(i, x, "en", "s", None) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        out = stages[stage](spark, docs, small)
        assert out.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    shared = [(7, a), (7, b), (3, b)]
    exact = [(7, a), (3, b), (None, long), (None, ""), (None, near)]
    assert kept("exact_dedup", [*shared, (None, a), (None, long), (None, long), (None, ""), (None, near)]) == sorted(exact, key=str)
    assert kept("near_dedup", [*shared, (None, "x"), (None, "x"), (None, "...")]) == sorted([(7, a), (3, b), (None, "x"), (None, "...")], key=str)
    assert kept("near_dedup", [(None, near), (9, long), (9, a)]) == sorted([(9, long), (9, a)], key=str)
    assert [x for x, _ in kept("near_dedup", [(None, near), (None, long)])] == [None]
    assert len(kept("near_dedup", [(5, near), (5, long), (5, b), (6, b), (5, "Y"), (5, "y")])) == 3
    assert kept("near_dedup", [(5, ""), (5, " "), (5, " ")]) == [(5, " "), (5, "")]


def test_clashing_names_empty_tables_and_long_texts(spark, small):
    """Columns are what they were, whatever their names; an empty table stays one; long texts are read whole."""
    names = ["__id", "__digest", "own_id", "Chosen_ID", "chosen_digest", "node", "sha", "key", "part"]
    words = " ".join(f"word{i}" for i in range(60_000))
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    rows = [(i, x, "en", "s", None, *(f"{n} of {i}" for n in names)) for i, x in enumerate([words, words, words + " more", "The cat sat on the mat and it was a good cat .", words.replace("word59999", "end")])]
    docs = spark.createDataFrame(rows, ddl)
    want = {"exact_dedup": {0, 2, 3, 4}, "near_dedup": {0, 3}, "decontaminate": {0, 1, 2, 3, 4}}
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), small)
        assert empty.collect() == []
        if name == "packing":
            continue
        assert empty.columns == docs.columns and empty.dtypes == docs.dtypes
        if name in want:
            out = stage(spark, docs, small)
            assert out.dtypes == docs.dtypes
            got = [tuple(r) for r in out.collect()]
            assert sorted(got) == [r for r in rows if r[0] in want[name]]
