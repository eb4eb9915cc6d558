"""Document quality from a linear-chain conditional random field over lines.

Documents are labelled, lines aren't: a good document may hold some bad lines,
and a bad one many good ones. So line labels are latent. Expectation rounds
ask the field for each line's marginal under a condition on its document (the
length-weighted share of good lines is at least ``GOOD_SHARE`` in a good
document and at most ``BAD_SHARE`` in a bad one); maximisation steps fit the
field to these marginals. The first round starts from what a line shows itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesflow.llm.common import BLANK, LOWER_TABLE, classes, crc_mod, ragged, row_slices, span_hashes, text_buffers, word_spans

#: The fit reads at most so many labelled documents (by the hash of doc_id), and of these the first ones with so many lines in all.
SAMPLE, SAMPLE_LINES = 5000, 200_000
#: A document of more lines is learned as several of so many at most, each with its label (a chain's steps follow one another in time).
SEGMENT = 500
#: Least share of good lines in a good document and largest in a bad one, by length, while line labels are learned.
GOOD_SHARE, BAD_SHARE = 0.95, 0.5
#: Signs of a bad line that the first round starts from.
SIGNS = {"one": 2.0, "upper": -1.0, "symbols": -1.0, "exclaims": -1.0, "separators": -1.0, "echo": -2.0, "repeat_line": -2.0}
SLICE = 4 << 20
FEATURES = ("one", "log_bytes", "upper", "symbols", "exclaims", "digits", "non_ascii", "blanks", "ends", "capital",
            "separators", "log_words", "word_length", "distinct", "echo", "repeat_line")
_UPPER, _LOWER = classes(bytes(range(65, 91))), classes(bytes(range(97, 123)))
_SYMBOL, _EXCLAIM, _DIGIT = classes(b"#*$%&<>{}~^_=\\@"), classes(b"!?"), classes(b"0123456789")
_SEPARATOR, _END = classes(b"|>"), classes(b".!?:;\"')")


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each non-blank line, its weight (bytes), and where each text's lines begin; a blank text is one empty line."""
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets, classes(b"\n"))
    words, word_ends, _ = word_spans(data, offsets, BLANK)
    a, b = np.searchsorted(words, starts), np.searchsorted(words, ends)
    some = b > a
    text = np.searchsorted(offsets, starts, "right") - 1
    starts, ends, a, b, text = starts[some], ends[some], a[some], b[some], text[some]
    size, count = (ends - starts).astype(float), (b - a).astype(float)

    def share(kind, of=size):
        sums = np.concatenate([[0], np.cumsum(kind[data])])
        return (sums[ends] - sums[starts]) / np.maximum(of, 1)

    letters = np.concatenate([[0], np.cumsum((_UPPER | _LOWER)[data])])
    letters = letters[ends] - letters[starts]
    hashes = span_hashes(LOWER_TABLE[data], words, word_ends)
    lengths = np.concatenate([[0], np.cumsum(word_ends - words)])
    echo = np.concatenate([[0, 0], np.cumsum(hashes[1:] == hashes[:-1])])[:len(words) + 1]
    line_of = np.repeat(np.arange(len(starts)), b - a)
    held = hashes[np.repeat(a, b - a) + np.arange(len(line_of)) - np.repeat(np.cumsum(b - a) - (b - a), b - a)]
    order = np.lexsort((held, line_of))
    new = np.ones(len(order), bool)
    new[1:] = (held[order][1:] != held[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][new], minlength=len(starts))
    whole = span_hashes(data, starts, ends)
    order = np.lexsort((starts, whole, text))
    again = np.zeros(len(starts), bool)
    again[order[1:]] = (whole[order][1:] == whole[order][:-1]) & (text[order][1:] == text[order][:-1])
    last = data[word_ends[b - 1] - 1] if len(starts) else np.zeros(0, np.uint8)
    columns = [np.ones(len(starts)), np.log1p(size) / 5, share(_UPPER, letters), share(_SYMBOL) * 10, share(_EXCLAIM) * 10,
               share(_DIGIT) * 3, share(np.arange(256) >= 128) * 3, share(BLANK) * 3, _END[last].astype(float),
               _UPPER[data[words[a]]].astype(float) if len(starts) else np.zeros(0), share(_SEPARATOR) * 10, np.log1p(count) / 5,
               (lengths[b] - lengths[a]) / np.maximum(count, 1) / 10, distinct / np.maximum(count, 1),
               (echo[b] - echo[np.minimum(a + 1, b)]) / np.maximum(count, 1), again.astype(float)]
    x = np.stack(columns, 1).astype(np.float32)
    per = np.bincount(text, minlength=n)
    if (per == 0).any():  # blank texts: one line, all features 0
        at = np.concatenate([[0], np.cumsum(per)])[:-1][per == 0]
        x, size = np.insert(x, at, 0, axis=0), np.insert(size, at, 1.0)
        per = np.maximum(per, 1)
    return x, size, np.concatenate([[0], np.cumsum(per)])


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, then the line's before and after it in the text (0 at the ends)."""
    before, after = np.roll(x, 1, axis=0), np.roll(x, -1, axis=0)
    if len(x):
        before[first[:-1]] = 0
        after[first[1:] - 1] = 0
    return np.concatenate([x, before, after], 1)


def forward_backward(score: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals P(line good), log normaliser of each text, and expected transitions (2 x 2).

    ``score``: log potential of good over bad; ``trans``: log potentials. All
    texts step together, the longest first, so a step costs one array operation.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = first[:-1][order], lengths[order]
    n = len(begin)
    node = np.zeros((len(score), 2))
    node[:, 1] = score
    steps = int(lengths[0]) if n else 0
    live = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts with more than t lines
    alpha, beta = np.zeros_like(node), np.zeros_like(node)
    join = lambda x: np.logaddexp(x[..., 0], x[..., 1])
    for t in range(steps):
        at = begin[:live[t]] + t
        alpha[at] = node[at] if t == 0 else node[at] + join((alpha[at - 1][:, :, None] + trans).transpose(0, 2, 1))
    for t in range(steps - 2, -1, -1):
        at = begin[:live[t + 1]] + t
        beta[at] = join(trans + (node[at + 1] + beta[at + 1])[:, None, :])
    z = join(alpha[begin + lengths - 1]) if n else np.zeros(0)
    z_line = np.zeros(len(score))
    norm = np.zeros(n)
    norm[order] = z
    z_line = np.repeat(norm, np.diff(first))
    good = np.exp(alpha[:, 1] + beta[:, 1] - z_line)
    inner = np.ones(len(score), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    pair = np.exp(alpha[at - 1][:, :, None] + trans + (node[at] + beta[at])[:, None, :] - z_line[at][:, None, None])
    return np.clip(good, 0, 1), norm, pair.sum(0)


def text_scores(x, size, first, model) -> np.ndarray:
    """Length-weighted mean of the lines' marginals."""
    good, _, _ = forward_backward(with_neighbours(x, first) @ model["w"], first, model["trans"])
    return np.add.reduceat(good * size, first[:-1]) / np.add.reduceat(size, first[:-1])


def clamped(score: np.ndarray, size: np.ndarray, first: np.ndarray, trans: np.ndarray, label: np.ndarray,
            steps: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Marginals and expected transitions of the field nearest to the given one that keeps each document's condition.

    That field adds the same multiple of a line's length to each of its
    document's line scores (none where the condition holds anyway); the multiple is found by halving."""
    lengths = np.diff(first)
    share = size / np.repeat(np.add.reduceat(size, first[:-1]), lengths)
    weight = share * np.repeat(lengths, lengths)
    held = lambda good: np.add.reduceat(good * share, first[:-1])
    good, _, pairs = forward_backward(score, first, trans)
    wrong = np.where(label > 0, held(good) < GOOD_SHARE, held(good) > BAD_SHARE)
    if not wrong.any():
        return good, pairs
    sign, goal = np.where(label > 0, 1.0, -1.0) * wrong, np.where(label > 0, GOOD_SHARE, BAD_SHARE)
    low, high = np.zeros(len(lengths)), np.full(len(lengths), 30.0)
    for _ in range(steps):
        middle = (low + high) / 2
        good, _, pairs = forward_backward(score + np.repeat(sign * middle, lengths) * weight, first, trans)
        enough = np.where(label > 0, held(good) >= goal, held(good) <= goal)
        low, high = np.where(enough, low, middle), np.where(enough, middle, high)
    good, _, pairs = forward_backward(score + np.repeat(sign * high, lengths) * weight, first, trans)
    return good, pairs


def train_crf(x, size, first, label, rounds: int = 8, steps: int = 30, rate: float = 0.1, penalty: float = 1e-3) -> dict:
    """Latent line labels: ``rounds`` times, clamp the field to the documents' labels and move it there by ``steps`` of Adam.

    A logistic curve then maps the aggregated marginal to the probability of label 1."""
    feats = with_neighbours(x, first).astype(np.float64)
    theta = np.zeros(feats.shape[1] + 4)
    for name, value in SIGNS.items():
        theta[FEATURES.index(name)] = value
    m, v, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(rounds):
        y, seen = clamped(feats @ theta[:-4], size, first, theta[-4:].reshape(2, 2), label)
        for _ in range(steps):
            step += 1
            good, _, pairs = forward_backward(feats @ theta[:-4], first, theta[-4:].reshape(2, 2))
            grad = np.concatenate([feats.T @ (y - good), (seen - pairs).ravel()]) / len(y) - penalty * theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            theta += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model = {"w": theta[:-4], "trans": theta[-4:].reshape(2, 2), "curve": np.array([0.0, 1.0])}
    z = logit(text_scores(x, size, first, model))
    a = b = 0.0
    for _ in range(2000):  # Newton would do too; the curve has two numbers
        p = 1 / (1 + np.exp(-(a + b * z)))
        a += 2.0 * np.mean(label - p)
        b += 0.2 * np.mean((label - p) * z) - 1e-4 * b
    model["curve"] = np.array([a, b])
    return model


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        folds: int = 5, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES) -> dict | None:
    """Learn from at most ``sample`` labelled documents whose crc32(id) mod ``folds`` is not 0, chosen by the id's hash.

    Of these the first ones count that have ``sample_lines`` lines together, so
    that the driver, which gets line features and no texts, holds a bounded
    number of lines (48 numbers each); a document that has more on its own is left out. The sample's ids are broadcast to the
    documents. Null labels, ids and documents without a label aren't used; a repeated id is learned once a row of each
    table. None when there is no labelled document (or table). Ids may have any type; other columns are ignored.
    """
    kind = dict(docs.dtypes)[id_col]
    chosen = (labels.where((crc_mod(id_col, folds) != 0) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    lines = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\\n")) + 1
    sizes = rows.select("doc_id", "label", F.xxhash64("text").alias("key"), lines.alias("lines")).where(F.col("lines") <= sample_lines)
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "key").rowsBetween(Window.unboundedPreceding, 0)  # the sample's rows, without texts
    ahead = sizes.withColumn("ahead", F.sum("lines").over(order))
    within = ahead.where(F.col("ahead") <= sample_lines).select("doc_id").distinct()
    rows = rows.where(lines <= sample_lines).join(F.broadcast(within), "doc_id", "left_semi")

    def features(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            label = batch.column("label").to_numpy()
            for i, j in row_slices(offsets, SLICE):
                x, size, first = line_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                cells = pa.ListArray.from_arrays(pa.array((first * len(FEATURES)).astype(np.int32)), pa.array(x.ravel()))
                sizes = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(size))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(label[i:j]), cells, sizes],
                                                 names=["doc_id", "label", "x", "size"])

    got = rows.mapInArrow(features, f"doc_id {kind}, label double, x array<float>, size array<double>").toArrow()
    if got.num_rows == 0:
        return None
    got = got.sort_by("doc_id").combine_chunks()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    size = got.column("size").combine_chunks().flatten().to_numpy()
    first = np.concatenate([[0], np.cumsum([len(s) for s in got.column("size").to_pylist()])])
    return train_crf(x, size, *segments(first, got.column("label").to_numpy()))


def segments(first: np.ndarray, label: np.ndarray, most: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """Documents (where each one's lines begin, and labels) cut into parts of at most ``most`` lines of even length."""
    lengths = np.diff(first)
    parts = np.maximum(-(-lengths // most), 1)
    number = ragged(np.zeros(len(lengths), np.int64), parts)
    begin = np.repeat(first[:-1], parts) + number * np.repeat(lengths, parts) // np.repeat(parts, parts)
    return np.append(begin, first[-1]), np.repeat(label, parts)


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
          threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, marginal, n_lines; one row per row of ``docs``.

    ``score``: probability of label 1, from the length-weighted marginals of the
    text's lines. Null, empty and blank texts are one empty line. Without a
    model (no labels) all scores are 0.5. Repeated rows are scored each; null ids
    are allowed; an empty table gives an empty result; a very long text takes
    memory in proportion to its own lines; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(id_col, folds) == 0).alias("held_out"), F.col(text_col).alias("text"))

    def apply(batches):
        m = shared.value
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                x, size, first = line_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                marginal = text_scores(x, size, first, m) if m else np.full(j - i, 0.5)
                p = 1 / (1 + np.exp(-(m["curve"][0] + m["curve"][1] * logit(marginal)))) if m else marginal
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("held_out").slice(i, j - i), pa.array(p),
                     pa.array((p >= threshold).astype(np.int32)), pa.array(marginal), pa.array(np.diff(first))],
                    names=["doc_id", "held_out", "score", "predicted", "marginal", "n_lines"])

    return rows.mapInArrow(apply, f"doc_id {kind}, held_out boolean, score double, predicted int, marginal double, n_lines long")
