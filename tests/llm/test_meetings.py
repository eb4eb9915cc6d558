"""Edges between meeting sets: as many as span a group, not as many as its pairs."""
import numpy as np
import pytest

from seriesflow.llm import minhash_forest as M


@pytest.mark.parametrize("n, block", [(30, 512), (600, 64)])
def test_a_group_of_copies_gives_edges_in_proportion_to_its_rows(spark, monkeypatch, n, block):
    monkeypatch.setattr(M, "BLOCK", block)
    one = np.arange(M.TREES * M.LONGEST, dtype=">u4").tobytes()
    sets = spark.createDataFrame([(7 * k + 3, one) for k in range(n)], "cid long, sig binary")
    labels = spark.createDataFrame([], "id long, root long")
    met = [tuple(r) for r in M._meetings(sets, labels, M.TREES, M.LONGEST, M.LONGEST).collect()]
    assert n - 1 <= len(met) <= 2 * n
    root = {7 * k + 3: 7 * k + 3 for k in range(n)}
    for _ in range(n):
        was = dict(root)
        for a, b in met:
            root[a] = root[b] = min(root[a], root[b])
        if was == root:
            break
    assert set(root.values()) == {3}


def test_edges_of_two_blocks_join_what_their_pairs_join():
    rng = np.random.default_rng(5)
    for _ in range(20):
        sig = np.repeat(rng.integers(0, 4, (12, 6)), 6, axis=0).astype(np.uint32)
        part, side = rng.permutation(len(sig)).astype(np.int64), rng.integers(0, 2, len(sig))
        every = M.smallest(part, M.reach(sig, 3))
        edges = [M.spanning(part, side, sig, 3, False)]
        for s in (0, 1):
            at = np.flatnonzero(side == s)
            edges.append(M.spanning(part[at], side[at], sig[at], 3, True))
        root = np.arange(len(sig))
        pairs = [(x, y) for a, b in edges for x, y in zip(a, b)]
        for _ in range(len(sig)):
            for x, y in pairs:
                root[x] = root[y] = min(root[x], root[y])
        assert (root[part] == every).all()
