"""The filter audit against counting one document after another."""

import re
from collections import Counter
from itertools import permutations

import numpy as np

from tabletide.llm import audit
from tabletide.llm.queries import op11_filter_audit, read


def fails(text, first):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": not first}
    return {k for k, v in out.items() if v}


def brute(docs, labels):
    """docs: (id, text, lang); labels: (id, quality, toxic)."""
    out, least = Counter(), {}
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    orders = ["".join(p) for p in permutations("ABCDE")]
    for i, text, lang in docs:
        f, part = fails(text or "", i is None or least[text or ""] == i), lang or ""
        for order in orders:
            for k, letter in enumerate(order, 1):
                before = f & set(order[: k - 1])
                at = (part, order, k)
                out[*at, "kept"] += not before and letter not in f
                out[*at, "redundant"] += bool(before) and letter in f
                out[*at, "unique_fails"] += f == {letter}
                if not before and letter in f:
                    out[*at, "removed"] += 1
                    out[part, letter] += 1
                    out[*at, "good_lost"] += i in good
                    out[*at, "toxic_lost"] += i in toxic
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return sorted((part, order, k, *[out[part, order, k, n] for n in names], out[part, order[k - 1]]) for part in {d[2] or "" for d in docs} for order in orders for k in range(1, 6))


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def test_query(spark, small):
    docs, labels = read(spark, small, "documents"), read(spark, small, "labels")
    assert rows(op11_filter_audit(spark, small)) == brute([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, groups of copies over parts, clashing names, labels given twice."""
    plain = " ".join(f"w{i}" for i in range(120))
    docs = [(5, plain, "en"), (3, plain, "de"), (3, plain, "de"), (9, plain, None), (None, plain, "en"), (None, plain, "en"), (7, None, "en"), (6, "", ""), (6, "", None), (8, plain + " $", "en"), (None, "ABC", None)]
    docs += [(10, "x " * 200_000, "fr"), (11, "x " * 200_000, "fr"), (12, plain.upper(), "fr"), (12, plain.upper() + " |", "fr"), (1, "only once here", "en")]
    docs += [(100 + i, "copy " * 99, "en") for i in range(300)]
    labels = [(5, 1, 0), (5, 0, 0), (3, None, 1), (None, 1, 1), (9, 1, None), (12, 1, 1), (4000, 1, 1), (150, 1, 0), (151, 0, 1)]
    table = spark.createDataFrame([(*d, 1, "m", "e") for d in docs], "doc_id long, text string, lang string, n long, mask string, part string").repartition(7)
    marks = spark.createDataFrame([(*x, "p") for x in labels], "doc_id long, quality int, toxic int, part string")
    assert rows(audit.filter_audit(table, marks)) == brute(docs, labels)
    assert rows(audit.filter_audit(table.limit(0), marks)) == []
    assert rows(audit.filter_audit(table, marks.limit(0))) == brute(docs, [])


def test_matrices():
    m = audit.outcomes()
    assert {k: x.shape for k, x in m.items()} == dict.fromkeys(m, (32, 600))
    steps = {k: x.reshape(32, 120, 5) for k, x in m.items()}
    assert (steps["removed"].sum(2) + steps["kept"][:, :, 4] == 1).all()
    assert (steps["shapley"][:, 0].sum(1) == np.where(np.arange(32) > 0, 120, 0)).all()
