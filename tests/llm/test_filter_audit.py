"""The audit against a loop over documents and orders."""

import re
from itertools import permutations

import numpy as np

from utterlake.llm import filter_audit as A


def plain(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    out = {}
    for part in {s or "" for _, _, s in docs}:
        own = []
        for i, text, source in docs:
            if (source or "") != part:
                continue
            t = text or ""
            words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", t) if w]
            fails = {
                "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs),
            }
            own.append((fails, i in good and i is not None, i in toxic and i is not None))
        shapley = dict.fromkeys("ABCDE", 0)
        rows = {}
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                here = [d for d in left if d[0][f]]
                gone = [d for d in own if any(d[0][x] for x in order[: step - 1])]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(here)
                unique = sum(d[0][f] and sum(d[0].values()) == 1 for d in own)
                rows[part, order, step] = (len(left), len(here), sum(d[0][f] for d in gone), unique, sum(d[1] for d in here), sum(d[2] for d in here), f)
        out |= {k: (*v[:-1], shapley[v[-1]]) for k, v in rows.items()}
    return out


def audit(spark, docs, labels):
    d = spark.createDataFrame([(*r, "k", 1) for r in docs], "doc_id long, text string, source string, part string, n int").repartition(3)
    got = A.filter_audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(found) == len(got)
    return found


def test_like_a_loop(spark):
    rng = np.random.default_rng(7)
    texts = [None, "", " \t\n", "A B C", "x " * 60, " ".join(f"w{i}" for i in range(70)), " ".join(f"w{i}" for i in range(70)) + " #", " ".join(f"W{i}" for i in range(60)), "naïve 漢字 \x1c " * 40, "y\x0bz " * 3000]
    docs = [(None if i % 17 == 0 else int(rng.integers(0, 50)), texts[rng.integers(len(texts))], (None, "", "s1", "s2")[rng.integers(4)]) for i in range(90)]
    docs += docs[:9]
    labels = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(0, 50, 2)] + [(4, 1, 1), (None, 1, 1), (6, None, None)]
    assert audit(spark, docs, labels) == plain(docs, labels)


def test_empty(spark):
    assert audit(spark, [], [(1, 1, 1)]) == {}
    assert len(audit(spark, [(1, None, None)], [])) == 600
