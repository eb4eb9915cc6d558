import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from edge import EDGE, edge_docs, empty_docs, lower, table

from seriesflow.llm import tree_weighting as tw

SF = "/root/testdata/sf0.001"


def kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


def brute(rows, folds, depth):
    """The same tree node by node in dictionaries."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0
    nodes = defaultdict(lambda: [0, 0])

    def steps(text):
        data = [255] * depth + list(lower(text).encode()) + [255]
        for at in range(depth, len(data)):
            for b in range(8):
                known = (1 << b) | (data[at] >> (8 - b))
                yield tuple(data[at - depth:at]), known, data[at] >> (7 - b) & 1

    words, ends = Counter(), 0
    for i, t in rows:
        if not held(i):
            words.update(lower(t).encode().split())
            ends += 1
            for ctx, known, bit in steps(t):
                for d in range(depth + 1):
                    nodes[ctx[depth - d:], known][bit] += 1
    children = defaultdict(list)
    for ctx, known in nodes:
        if ctx:
            children[ctx[1:], known].append((ctx, known))
    memo = {}

    def weighted(node):
        if node not in memo:
            own = kt(*nodes[node])
            memo[node] = own if len(node[0]) == depth else np.logaddexp(own, sum(weighted(c) for c in children[node])) - math.log(2)
        return memo[node]

    def predict(ctx, known, bit):
        p = None
        for d in range(depth, -1, -1):
            node = (ctx[depth - d:], known)
            a, b = nodes.get(node, (0, 0))
            mine = (b + .5) / (a + b + 1) if bit else (a + .5) / (a + b + 1)
            if d == depth:
                p = mine
                continue
            own = math.exp(kt(a, b) - math.log(2) - weighted(node)) if node in nodes else .5
            p = own * mine + (1 - own) * p
        return p

    total, v = sum(words.values()) + ends, len(words) + (ends > 0)
    out = []
    for i, t in rows:
        tokens = lower(t).encode().split()
        base = sum(math.log10((c + .1) / (total + .1 * (v + 1))) for c in [words[w] for w in tokens] + [ends])
        score = sum(math.log10(predict(*s)) for s in steps(t))
        out.append((i, held(i), len(tokens) + 1, sum(w in words for w in tokens) + (ends > 0), total, base, score))
    return out


def same(got, want):
    key = lambda r: tuple((x is None, x) if not isinstance(x, float) else round(x, 3) for x in r)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-5, atol=1e-4)


def test_scores_equal_brute_force(spark, monkeypatch):
    rows = [r[:2] for r in EDGE if len(r[1] or "") < 1000] + [r[:2] for r in table() if len(r[1]) < 700][:25]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for depth in (3, 5):
        want = brute(rows, 3, depth)
        same(tw.score(docs, folds=3, depth=depth).collect(), want)
    same(tw.score(docs, folds=3, depth=depth, most_grams=0).collect(), want)
    monkeypatch.setattr(tw, "PART_ROWS", 3)  # parts are weighed a few at a time
    same(tw.score(docs, folds=3, depth=depth).collect(), want)


def test_awkward_rows(spark):
    out = tw.score(edge_docs(spark)).collect()
    assert len(out) == len(EDGE) and all(r.score < 0 and r.n_bytes >= 0 for r in out)
    assert tw.score(empty_docs(spark)).count() == 0
    nothing = tw.score(edge_docs(spark), folds=1).collect()  # all held out
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in nothing)


def test_beats_the_base_on_held_out_texts(spark):
    out = tw.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    held = [r for r in out if r.held_out]
    print(sum(r.score for r in held), sum(r.base_score for r in held))
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert sum(r.score for r in held) / sum(r.n_bytes for r in held) > -1.0


def test_broadcast_and_join_give_equal_scores(spark):
    docs = edge_docs(spark)
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    small, large = sorted(tw.score(docs).collect(), key=key), sorted(tw.score(docs, most_grams=0).collect(), key=key)
    assert len(small) == len(large) > 0
    assert all(abs(a.score - b.score) <= 1e-11 * abs(a.score) for a, b in zip(small, large))


def test_tables_in_slices_give_equal_scores(spark, monkeypatch):
    """Rows that repeat, with ids or without, keep their own sums; no pass makes a row for each gram of a text."""
    docs = edge_docs(spark).select("doc_id", "text")
    docs = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", docs.doc_id + 1000))
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_known, r.score)
    whole = sorted(tw.score(docs).collect(), key=key)
    monkeypatch.setattr(tw, "LEAST", 8)
    made, keep = [], tw.materialize
    monkeypatch.setattr(tw, "materialize", lambda df, name: made.append((name, keep(df, name))) or made[-1][1])
    parts = sorted(tw.score(docs, most_grams=90, most_words=8).collect(), key=key)
    passes = [df for name, df in made if name == "ctw-pass"]
    assert len(passes) > 2 and all(df.count() == len(whole) for df in passes)
    assert [r[:5] for r in parts] == [r[:5] for r in whole] and [r.n_bytes for r in parts] == [r.n_bytes for r in whole]
    assert np.allclose([r[5:7] for r in parts], [r[5:7] for r in whole], rtol=1e-11, atol=0)
