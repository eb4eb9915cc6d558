import zlib

import numpy as np
import pytest
from edge import EDGE, edge_docs, empty_docs, table

from seriesflow.llm import language_id, line_crf

SF = "/root/testdata/sf0.01"


def test_code_matrix_separates_classes():
    for n in (2, 4, 7, 12, 60):
        code = language_id.code_matrix(n)
        assert code.shape[0] == n and len({tuple(c) for c in code.tolist()}) == n
        assert n < 3 or ((code[:, None] != code[None]).sum(2) + 99 * np.eye(n)).min() >= 2


def test_language_held_out(spark):
    rows = {r[0]: r for r in table(sf=SF)}
    out = language_id.identify(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert len(out) == len(rows) and {r.held_out for r in out} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in out)
    held = [(r.lang_pred == rows[r.doc_id][2]) for r in out if r.held_out]
    assert sum(held) >= 0.98 * len(held)


def test_grams_of_a_text_know_no_neighbour():
    """A text's n-grams and margins are the same alone and before any other text."""
    texts = [b"a", b"", b"", b"Zebra xy", "été".encode(), b"b", b""]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together, starts = language_id.gram_buckets(np.frombuffer(b"".join(texts), np.uint8), offsets)
    weights = np.random.default_rng(1).normal(size=(language_id.BUCKETS, 2))
    margins = language_id.margins(np.frombuffer(b"".join(texts), np.uint8), offsets, weights)
    for k, t in enumerate(texts):
        alone = np.frombuffer(t, np.uint8), np.array([0, len(t)])
        assert language_id.gram_buckets(*alone)[0].tolist() == together[starts[k]:starts[k + 1]].tolist()
        assert starts[k + 1] - starts[k] == 2 * len(t) + 1
        assert np.allclose(language_id.margins(*alone, weights)[0], margins[k])


def test_language_awkward_rows(spark):
    out = language_id.identify(edge_docs(spark)).collect()
    assert len(out) == len(EDGE)
    for r in out:
        text = {i: t for i, t, *_ in EDGE}[r.doc_id]
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    assert language_id.identify(empty_docs(spark)).count() == 0


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    first = np.array([0, 1, 4, 9])
    score, trans = rng.normal(size=9), rng.normal(size=(2, 2))
    good, norm, pairs = line_crf.forward_backward(score, first, trans)
    want, all_pairs = [], np.zeros((2, 2))
    for a, b in zip(first, first[1:]):
        total, marg, pr = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for code in range(2 ** (b - a)):
            y = [(code >> k) & 1 for k in range(b - a)]
            w = np.exp(sum(score[a + k] for k in range(b - a) if y[k]) + sum(trans[p, q] for p, q in zip(y, y[1:])))
            total += w
            marg += w * np.array(y)
            for p, q in zip(y, y[1:]):
                pr[p, q] += w
        want += list(marg / total)
        all_pairs += pr / total
    assert np.allclose(good, want) and np.allclose(pairs, all_pairs)


def test_clamped_fields_equal_enumeration():
    """Of all fields with a multiple of the lines' lengths added, the one that just meets the document's condition."""
    rng = np.random.default_rng(4)
    first, label = np.array([0, 3, 7, 8, 12]), np.array([1.0, 0.0, 1.0, 0.0])
    size, score, trans = rng.integers(1, 9, 12).astype(float), rng.normal(size=12), rng.normal(size=(2, 2))
    score[3:7] += 3
    score[8:12] -= 5
    good, pairs = line_crf.clamped(score, size, first, trans, label, steps=40)
    plain, _, _ = line_crf.forward_backward(score, first, trans)
    all_pairs = np.zeros((2, 2))
    for d, (a, b) in enumerate(zip(first, first[1:])):
        share = size[a:b] / size[a:b].sum()

        def field(multiple):
            marg, pr, total = np.zeros(b - a), np.zeros((2, 2)), 0.0
            for code in range(2 ** (b - a)):
                y = [(code >> k) & 1 for k in range(b - a)]
                w = np.exp(sum((score[a + k] + multiple * share[k] * (b - a)) * y[k] for k in range(b - a)) + sum(trans[p, q] for p, q in zip(y, y[1:])))
                total += w
                marg += w * np.array(y)
                for p, q in zip(y, y[1:]):
                    pr[p, q] += w
            return marg / total, pr / total

        low, high = 0.0, 30.0
        sign, goal = (1, line_crf.GOOD_SHARE) if label[d] else (-1, line_crf.BAD_SHARE)
        met = lambda m: (field(sign * m)[0] @ share - goal) * sign >= 0
        if met(0):
            high = 0.0
        for _ in range(40 if high else 0):
            middle = (low + high) / 2
            low, high = (low, middle) if met(middle) else (middle, high)
        marg, pr = field(sign * high)
        assert np.allclose(good[a:b], marg, atol=1e-6), d
        all_pairs += pr
    assert np.allclose(pairs, all_pairs, atol=1e-5) and not np.allclose(good, plain)
    assert np.allclose(good[8:12], plain[8:12])  # held already


def test_good_and_bad_lines_of_one_document_differ():
    """Labels are of documents only; bad ones hold good lines, too."""
    rng = np.random.default_rng(6)
    words = ["river", "stone", "bridge", "market", "letter", "garden", "winter", "village"]
    prose = lambda: " ".join(rng.choice(words, 12)).capitalize() + "."
    junk = lambda: rng.choice(["HOME | ABOUT | CONTACT | LOGIN", "$$$ BUY NOW!!! $$$ BEST PRICE!!!", "### *** ### click click click click"]) * 3
    texts, labels, truth = [], [], []
    for k in range(300):
        bad = k % 2 == 0
        kinds = [bool(rng.random() < (0.35 if bad else 0.98)) for _ in range(int(rng.integers(6, 14)))]
        texts.append("\n".join(prose() if g else junk() for g in kinds))
        labels.append(0.0 if bad else 1.0)
        truth.append(kinds)
    raw = [t.encode() for t in texts]
    x, size, first = line_crf.line_features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    model = line_crf.train_crf(x, size, first, np.array(labels))
    good, _, _ = line_crf.forward_backward(line_crf.with_neighbours(x, first) @ model["w"], first, model["trans"])
    right, mixed = [], 0
    for k, (a, b) in enumerate(zip(first, first[1:])):
        if labels[k] == 0 and len(set(truth[k])) == 2:
            right += [(p > 0.5) == t for p, t in zip(good[a:b], truth[k])]
            mixed += len(set((good[a:b] > 0.5).tolist())) == 2
    assert np.mean(right) > 0.9 and mixed > 100
    marginal = line_crf.text_scores(x, size, first, model)
    assert marginal[1::2].min() > marginal[::2].mean() + 0.2


def test_the_sample_is_bounded_by_lines_not_by_length(spark):
    rows = [(str(k), "\n".join(["a line of words here"] * (40 if k % 3 == 0 else 2)), k % 2) for k in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id string, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id string, quality int")
    seen = []
    plain = line_crf.train_crf

    def train(x, size, first, label):
        seen.append((len(x), len(label), int((np.diff(first) > 2).sum())))
        return plain(x, size, first, label, rounds=1, steps=1)

    line_crf.train_crf = train
    try:
        model = line_crf.fit(docs, labels, sample_lines=500)
        line_crf.fit(docs, labels)
    finally:
        line_crf.train_crf = plain
    assert 400 < seen[0][0] <= 500 and seen[0][2] > 3 and seen[1][0] > 700
    assert line_crf.score(docs, model).count() == 60  # ids of any type


def test_long_documents_are_learned_in_segments():
    first, label = line_crf.segments(np.array([0, 1200, 1200, 1203, 1703]), np.array([1.0, 0.0, 1.0, 0.0]))
    assert first.tolist() == [0, 400, 800, 1200, 1200, 1203, 1703] and label.tolist() == [1, 1, 1, 0, 1, 0]


def test_line_features_by_line():
    texts = ["One Two two.\n\nHEY!! || x\nOne Two two.", "", "  \n "]
    data = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    x, size, first = line_crf.line_features(np.frombuffer(data, np.uint8), offsets)
    assert first.tolist() == [0, 3, 4, 5] and size.tolist() == [12, 10, 12, 1, 1]
    f = dict(zip(line_crf.FEATURES, x.T))
    assert f["repeat_line"].tolist() == [0, 0, 1, 0, 0]
    assert f["distinct"][0] == pytest.approx(1.0) and f["ends"].tolist() == [1, 0, 1, 0, 0]
    assert f["separators"][1] == pytest.approx(2.0) and f["upper"][1] == pytest.approx(3 / 4)


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r[0]: r[1] for r in table("labels", SF)}
    out = [r for r in line_crf.score(docs, line_crf.fit(docs, labels)).collect()]
    assert len(out) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    good = [r.predicted for r in held if truth[r.doc_id] == 1]
    bad = [r.predicted for r in held if truth[r.doc_id] == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.25 * len(bad)


def test_quality_awkward_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 14)] + [(None, 1), (5, None)], "doc_id long, quality int")
    out = line_crf.score(docs, line_crf.fit(docs, labels))
    assert out.count() == len(EDGE) and out.where("score is null or isnan(score)").count() == 0
    assert line_crf.fit(docs, labels.limit(0)) is None
    assert line_crf.score(empty_docs(spark), None).count() == 0
