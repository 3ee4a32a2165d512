import random
import re
from itertools import permutations

import pytest
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int, text string"


def fails(docs):
    """Letters that each row of (id, text) fails, by the definitions."""
    first = {}
    for i, t in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search("[#$%&*|]", t), i is not None and i > first[t])) if bad))
    return out


def brute(docs, labels):
    """docs: (id, text, lang); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for (i, _, lang), bad in zip(docs, fails([(i, t) for i, t, _ in docs])):
        parts.setdefault(lang or "", []).append((i, bad))
    rows, shapley = {}, {}
    for part, members in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left, gone = members, []
            for step, f in enumerate(order, 1):
                out = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                rows[part, order, step] = (len(left), len(out), sum(f in m[1] for m in gone), sum(m[1] == f for m in members),
                                           sum(m[0] in good for m in out), sum(m[0] in toxic for m in out))
                shapley[part, f] = shapley.get((part, f), 0) + len(out)
                gone = gone + out
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def got(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (*(r[c] for c in A.COUNTS), r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def test_random_corpus(spark):
    rnd = random.Random(3)
    docs = []
    for i in range(300):
        words = [rnd.choice("abcdefghij") * rnd.randint(1, 9) + rnd.choice(["", "", "A", "#"][:rnd.randint(1, 4)]) for _ in range(rnd.choice([0, 5, 99, 100, 150]))]
        docs.append((rnd.choice([i, i, i, i // 2, None]), rnd.choice([" ", "\n", "\x0b "]).join(words) + rnd.choice(["", " "]), rnd.choice(["en", "de", "", None])))
    docs += [rnd.choice(docs) for _ in range(150)]          # repeated rows
    docs += [(rnd.randint(0, 400), rnd.choice(docs)[1], "fr") for _ in range(150)]   # copies elsewhere
    rnd.shuffle(docs)
    labels = [(rnd.choice([rnd.randint(0, 300), None]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None]), "x") for _ in range(400)]
    found = got(A.audit(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5), spark.createDataFrame(labels, LABELS)))
    assert found == brute(docs, [x[:3] for x in labels])


def test_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    labels = spark.createDataFrame([(7, 1, 0, "x"), (10, 0, 1, "x"), (10, 1, 1, "x")], LABELS)
    docs = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    assert got(A.audit(odd_docs, labels)) == brute(docs, [(7, 1, 0), (10, 0, 1), (10, 1, 1)])
    assert got(A.audit(odd_docs, labels.limit(0))) == brute(docs, [])
    assert A.audit(no_docs, labels).count() == 0


@pytest.mark.parametrize("mask", [0, 1, 31, 0b10110])
def test_fold_weighs_every_order(spark, mask):
    from pyspark.sql import functions as F
    steps = spark.range(1).select(A.fold_orders(F.lit(mask), F.lit(7).cast("long"), F.lit(2).cast("long"), F.lit(1).cast("long"))).first()[0]
    assert len(steps) == 600
    failing = bin(mask).count("1")
    assert sum(s["removed"] for s in steps) == (120 * 7 if mask else 0)
    assert sum(s["redundant"] for s in steps) == (120 * 7 * (failing - 1) if mask else 0)
    assert sum(s["good_lost"] for s in steps) == (240 if mask else 0)
