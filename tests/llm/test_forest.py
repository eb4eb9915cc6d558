import random
from collections import Counter

import numpy as np
from edge import EDGE, edge_docs, empty_docs, lower, table

from seriesflow.llm import minhash_forest as mf
from seriesflow.llm.components import connected_components


def shingle_set(text):
    w = lower(text).encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=0.8):
    sets = [shingle_set(t) for _, t in rows]
    near = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j]
             and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]
    label, out = {}, Counter()
    for i in range(len(rows)):
        if i not in label:
            todo, seen = [i], {i}
            while todo:
                for j in near[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
            label |= {j: least for j in seen}
        out[(rows[i][0], label[i], len(near[i]), len({sets[j] for j in near[i]} - {sets[i]}), len(sets[i]))] += 1
    return out


def got(df):
    return Counter((r.doc_id, r.class_id, r.n_links, r.n_similar_texts, r.n_shingles) for r in df.collect())


def test_prefix_is_shortened_to_the_target():
    assert mf.prefix_lengths(16, 6, 0.8, 0.9995) == [6, 5, 4]
    assert mf.prefix_lengths(16, 6, 0.8, 0.9)[-1] > mf.prefix_lengths(16, 6, 0.8, 0.99999)[-1] >= 1


def test_joined_groups_are_not_opened_again(spark, monkeypatch):
    """Near copies meet under whole keys; shorter prefixes open only nodes that hold sets of two components."""
    rng = random.Random(3)
    rows = []
    for family in range(6):
        base = [f"f{family}w{rng.randrange(5000)}" for _ in range(400)]
        for i in range(25):
            words = list(base)
            for _ in range(rng.randrange(0, 3) if family < 5 else 14):   # the last family lies at the threshold
                words[rng.randrange(400)] = f"x{rng.randrange(99999)}"
            rows.append((100 * family + i, " ".join(words)))
    opened = []
    plain = mf.materialize

    def seen(df, name):
        out = plain(df, name)
        if name == "forest-members":
            opened.append(out.count())
        return out

    monkeypatch.setattr(mf, "materialize", seen)
    assert got(mf.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert len(opened) == 3 and opened[0] > 10 * opened[1] and opened[0] > 10 * opened[2]


def test_recall_at_the_threshold_is_measured(spark):
    """Pairs of texts that share between 80 and 85 % of their shingles and meet nobody else."""
    rng = random.Random(11)
    rows, close = [], 0
    for k in range(400):
        base = [f"p{k}w{n}" for n in range(204)]
        words = list(base)
        for at in rng.sample(range(10, 190, 12), 4):
            words[at] = f"q{rng.randrange(10 ** 9)}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(words))]
        a, b = shingle_set(rows[-2][1]), shingle_set(rows[-1][1])
        close += 5 * len(a & b) >= 4 * len(a | b)
    out = mf.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    found = out.where("n_links > 0").count() / 2
    assert close > 300 and 0.995 * close <= found <= close


def test_equals_brute_force(spark):
    rows = [r[:2] for r in table()]
    assert got(mf.jaccard_classes(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))) == brute(rows)
    assert got(mf.jaccard_classes(edge_docs(spark))) == brute([r[:2] for r in EDGE])
    assert mf.jaccard_classes(empty_docs(spark)).count() == 0


def test_large_groups_in_blocks(spark, monkeypatch):
    """One family of near copies over many blocks, a chain, and exact copies."""
    monkeypatch.setattr(mf, "BLOCK", 16)
    monkeypatch.setattr(mf, "VERIFY_BLOCK", 8)
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(150)] = f"x{rng.randrange(99999)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{k}" for k in range(400)]
    rows += [(200 + i, " ".join(chain[8 * i:8 * i + 100])) for i in range(30)]
    rows += [(300 + i, "an exact copy of a text that has more than five words") for i in range(40)]
    rows += [(400 + i, " ".join(f"r{rng.randrange(9999)}" for _ in range(60))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(mf.jaccard_classes(df)) == brute(rows)


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    out = {r.id: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert out == {x: find(x) for a, b in pairs if a != b for x in (a, b)}
