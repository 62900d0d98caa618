"""Fits and verdicts against plain computations that share no code with them."""

import itertools
import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from utterlake.llm import near_dup, quality_crf, quality_rules, toxicity
from utterlake.llm.common import table

SF = "/root/testdata/sf0.01"


def test_flat_trees_like_a_walk_from_node_to_node():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 12))
    y = (x[:, 0] - x[:, 7] ** 2 + rng.normal(size=400) > -1).astype(float)
    trees = quality_rules.fit_trees(x, y, n_trees=20)
    for row in rng.normal(size=(200, 12)):
        total = trees.bias
        for at in trees.roots.tolist():
            while trees.feature[at] >= 0:
                at = int(trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at])
            total += trees.value[at]
        assert abs(trees.score(row[None])[0] - 1 / (1 + math.exp(-total))) < 1e-12


def test_trees_never_rise_in_a_monotone_feature():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 12))
    y = (x[:, 0] + x[:, 6] > 0).astype(float)  # against the constraint on feature 0
    trees = quality_rules.fit_trees(x, y)
    for row in rng.normal(size=(50, 12)):
        for j, sign in enumerate(quality_rules.MONOTONE):
            if sign:
                line = np.repeat(row[None], 30, 0)
                line[:, j] = np.linspace(-3, 3, 30)
                assert (np.diff(trees.score(line)) <= 1e-12).all()


def test_kept_follows_rule_and_score(spark):
    rows = [(1, "word " * 9), (2, " ".join(f"w{i}" for i in range(40))), (3, "a b c d e f g h i j " * 3), (4, None), (5, "!! || ## " * 20)]
    rng = np.random.default_rng(2)
    x = rng.random((200, 12))
    trees = quality_rules.fit_trees(x, (x[:, 4] < 0.3).astype(float))
    for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), trees).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", dict(rows)[r.doc_id] or "")
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        assert (r.n_words, r.n_repeat_words, r.base_failed) == (len(words), len(inside), failed)
        assert r.kept == (not failed and r.score >= 0.5)


def test_chain_expectations_like_all_paths():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5):
        d, move = rng.normal(size=(3, n)), rng.normal(size=(2, 2))
        mask = np.ones((3, n), bool)
        node, pair = quality_crf._expect(d, mask, move)
        for k in range(3):
            weights = {p: math.exp(sum(d[k, t] for t in range(n) if p[t]) + sum(move[a, b] for a, b in zip(p, p[1:]))) for p in itertools.product((0, 1), repeat=n)}
            z = sum(weights.values())
            assert np.allclose(node[k], [sum(w for p, w in weights.items() if p[t]) / z for t in range(n)])
            want = np.zeros((2, 2))
            for p, w in weights.items():
                for a, b in zip(p, p[1:]):
                    want[a, b] += w / z
            assert np.allclose(pair[k], want)


def test_crf_fit_is_where_the_plain_loss_is_flat():
    texts = [("good words in a line.\nand one more line of them here.", 1), ("X!! ##\n| $ %\nZZ!", 0), ("a plain short line", 1), ("9 9 9 !!\nok then", 0), ("calm and clear text,\nwith a comma", 1)]
    model = quality_crf.fit_texts(texts, ridge=1e-2, steps=3000, rate=0.02)
    made, labels = [quality_crf.line_features(t)[0] for t, _ in texts], [y for _, y in texts]

    def loss(w, move):
        total = 0.01 * ((w**2).sum() + (move**2).sum()) / 2
        for x, y in zip(made, labels):
            d, n = x @ w, len(x)
            path = lambda p: sum(d[t] for t in range(n) if p[t]) + sum(move[a, b] for a, b in zip(p, p[1:]))
            z = math.log(sum(math.exp(path(p)) for p in itertools.product((0, 1), repeat=n)))
            total += (z - path((y,) * n)) * 0.5 / labels.count(y) / n
        return total

    at = np.append(model.weights, model.move)
    slope = []
    for i in range(len(at)):
        up, down = at.copy(), at.copy()
        up[i], down[i] = up[i] + 1e-4, down[i] - 1e-4
        slope.append((loss(up[:-4], up[-4:].reshape(2, 2)) - loss(down[:-4], down[-4:].reshape(2, 2))) / 2e-4)
    assert np.abs(slope).max() < 0.01


def test_toxicity_fit_is_where_the_plain_loss_is_flat():
    groups = toxicity.IDENTITY[:6] if isinstance(toxicity.IDENTITY, tuple) else list(toxicity.IDENTITY)[:6]
    rows = [(f"the {g} idiot came by", 1) for g in groups for _ in range(3)] + [(f"a calm {g} day here", 0) for g in groups] + [("what a lovely calm day", 0)] * 20
    model = toxicity.fit_texts(rows, steps=4000, rounds=1)
    n = Counter(y for _, y in rows)
    used = list(model.weights)

    def found(words):
        return {f for w in words for f in toxicity.features(w)} & set(used)

    own = [found(toxicity.WORD.findall(t)) for t, _ in rows]
    other = [found(toxicity.swap_identity(toxicity.WORD.findall(t), i)) for i, (t, _) in enumerate(rows)]

    def loss(w, bias):
        total = 3e-4 * sum(v * v for v in w.values()) / 2
        for (_, y), a, b in zip(rows, own, other):
            m = bias + sum(w[f] for f in a) if a else bias
            total += (0.35 / n[1] if y else 0.65 / n[0]) * math.log1p(math.exp(-m if y else m))
            total += 0.3 * (sum(w[f] for f in b) - sum(w[f] for f in a)) ** 2 / len(rows)
        return total

    slope = lambda f: (loss({**model.weights, f: model.weights[f] + 1e-3}, model.bias) - loss({**model.weights, f: model.weights[f] - 1e-3}, model.bias)) / 2e-3
    assert max(abs(slope(f)) for f in used) < 0.01
    assert abs(loss(model.weights, model.bias + 1e-3) - loss(model.weights, model.bias - 1e-3)) / 2e-3 < 0.01


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_near_dup_loses_no_link_of_the_given_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    sets = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else ({tuple(words)} if words else set())
    holders = defaultdict(list)
    for d, s in sorted(sets.items()):
        for x in s:
            holders[x].append(d)
    both = Counter()
    for ds in holders.values():
        both.update(itertools.combinations(ds, 2))
    links = [(a, b) for (a, b), n in both.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            root[d] = root[root[d]]
            d = root[d]
        return d

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert len(links) > 50 and got == {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}
