"""Language identification by error-correcting output codes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesflow.llm.common import LOWER_TABLE, crc_mod, mix64, row_slices, text_buffers

#: N-grams of 2 and 3 bytes, hashed to so many features; the model has features x code bits numbers.
BUCKETS, ORDERS = 1 << 17, (2, 3)
SMOOTHING, SLICE = 0.5, 1 << 18
UNKNOWN = "und"


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each text (with a blank before and after) and where each text's n-grams begin."""
    padded = offsets + 2 * np.arange(len(offsets))
    text = np.full(padded[-1], 32, np.uint8)
    place = np.arange(len(data)) + np.repeat(2 * np.arange(len(offsets) - 1) + 1, np.diff(offsets))
    text[place] = LOWER_TABLE[data]
    wide = text.astype(np.uint32)
    parts = []
    for n in ORDERS:
        key = np.zeros(len(wide) - n + 1, np.uint32)
        for j in range(n):
            key = (key << np.uint32(8)) | wide[j:j + len(key)]
        key = (key * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - int(math.log2(BUCKETS)))
        parts.append(np.concatenate([key, np.zeros(n - 1, np.uint32)]))
    keep = np.ones((len(wide), len(ORDERS)), bool)  # but for windows that leave their text
    for k, n in enumerate(ORDERS):
        for j in range(1, n):
            keep[padded[1:] - j, k] = False
    return np.stack(parts, 1)[keep], padded * len(ORDERS) - np.arange(len(padded)) * sum(n - 1 for n in ORDERS)


def code_matrix(classes: int, seed: int = 7) -> np.ndarray:
    """One codeword of +1 and -1 a class: all 2^(L-1) - 1 splits up to 7 classes, then random codes of
    10 log2 L bits, of 200 tries the one whose two closest codewords differ most."""
    if classes <= 1:
        return np.ones((classes, 1))
    if classes <= 7:
        splits = np.arange(1, 2 ** (classes - 1))
        bits = (splits[None, :] >> np.arange(classes)[:, None]) & 1
        return bits * 2.0 - 1
    rng, best, most = np.random.default_rng(seed), None, -1
    width = math.ceil(10 * math.log2(classes))
    for _ in range(200):
        code = rng.integers(0, 2, (classes, width)) * 2.0 - 1
        code = code[:, np.abs(code.sum(0)) < classes]
        apart = ((code.shape[1] - code @ code.T) / 2 + np.eye(classes) * width).min()
        if apart > most:
            best, most = code, apart
    return best


def margins(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each text, each bit classifier's log-odds over the root of the text's n-grams."""
    out = np.zeros((len(offsets) - 1, weights.shape[1]))
    for i, j in row_slices(offsets, SLICE):
        buckets, starts = gram_buckets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        scores = weights[buckets]
        for c in range(weights.shape[1]):
            out[i:j, c] = np.add.reduceat(scores[:, c], starts[:-1])
        out[i:j] /= np.sqrt(np.diff(starts))[:, None]
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", folds: int = 5) -> dict:
    """Learn from the rows whose crc32(id) mod ``folds`` is not 0 and whose label and text aren't null.

    One pass counts hashed n-grams by language over all such rows; a second one
    counts how often each bit's classifier is right on each language (the
    decoding weights). To the driver come languages x 131,072 counts at most.
    """
    train = docs.where((crc_mod(id_col, folds) != 0) & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    train = train.select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            names, codes = np.unique(np.array(batch.column("label").to_pylist(), dtype=object).astype(str), return_inverse=True)
            for i, j in row_slices(offsets, SLICE):
                buckets, starts = gram_buckets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                cell = np.repeat(codes[i:j], np.diff(starts)) * BUCKETS + buckets
                both = np.bincount(cell, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for k in np.unique(codes[i:j]):
                    held[names[k]] = held.get(names[k], 0) + both[k]
        for name, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))],
                                             names=["label", "bucket", "n"])

    counts = train.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    labels = sorted(set(counts.column("label").to_pylist()))
    code = code_matrix(len(labels))
    if not labels:
        return {"labels": [], "code": code, "weights": np.zeros((BUCKETS, 1), np.float32), "trust": np.ones((0, 1))}
    n = np.zeros((len(labels), BUCKETS))
    row = np.array([labels.index(x) for x in counts.column("label").to_pylist()])
    n[row, counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    share = (n + SMOOTHING) / (n.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    side = lambda s: np.log(np.maximum(((code == s)[:, :, None] * share[:, None, :]).sum(0) / np.maximum((code == s).sum(0), 1)[:, None], 1e-300))
    weights = np.ascontiguousarray((side(1) - side(-1)).T.astype(np.float32)) if len(labels) > 1 else np.ones((BUCKETS, 1), np.float32)
    model = docs.sparkSession.sparkContext.broadcast((labels, code, weights))

    def check(batches):
        names, bits, w = model.value
        right, seen = np.zeros(bits.shape), np.zeros(len(names))
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            index = {x: k for k, x in enumerate(names)}
            codes = np.array([index[x] for x in batch.column("label").to_pylist()], np.int64)
            got = margins(data, offsets, w) * bits[codes] > 0
            for k in np.unique(codes):
                right[k] += got[codes == k].sum(0)
                seen[k] += (codes == k).sum()
        at, bit = np.indices(bits.shape)
        yield pa.RecordBatch.from_arrays([pa.array(at.ravel()), pa.array(bit.ravel()), pa.array(right.ravel()), pa.array(np.repeat(seen, bits.shape[1]))],
                                         names=["k", "b", "right", "seen"])

    hits = (train.mapInArrow(check, "k long, b long, right double, seen double").groupBy("k", "b")
            .agg(F.sum("right").alias("r"), F.sum("seen").alias("s")).collect())  # languages x bits rows
    trust = np.full(code.shape, 0.5)
    for r in hits:
        trust[r.k, r.b] = (r.r + 0.5) / (r.s + 1)
    return {"labels": labels, "code": code, "weights": weights, "trust": trust / trust.sum(1, keepdims=True) * code.shape[1]}


def decode(m: np.ndarray, code: np.ndarray, trust: np.ndarray) -> np.ndarray:
    """Posterior of each class: softmax of minus the weighted logistic loss of its codeword's bits."""
    loss = (np.logaddexp(0, -m[:, None, :] * code[None]) * trust[None]).sum(2)
    p = np.exp(loss.min(1, keepdims=True) - loss)
    return p / p.sum(1, keepdims=True)


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
            ambiguous_below: float = 0.5) -> DataFrame:
    """doc_id, held_out, lang_pred, score, runner_up, ambiguous; one row per row of ``docs``.

    ``score`` is the decoded probability of ``lang_pred``. A text is ambiguous
    when the nearest codeword leads the next one by less than ``ambiguous_below``.
    Null texts, texts without a letter, and all texts when nothing could be
    learned get ``und`` with score 0 and are ambiguous. Ties go to the label that
    sorts first. Repeated rows are predicted each; null ids are held out like
    the empty id text. A very long text is read as a slice of its own, in memory in proportion to its
    length. An empty table gives an empty result. Other columns, whatever their names, are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(id_col, folds) == 0).alias("held_out"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)).alias("letters"))

    def apply(batches):
        m = shared.value
        names = m["labels"]
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            known = batch.column("letters").to_numpy(zero_copy_only=False) & bool(names)
            if names:
                p = decode(margins(data, offsets, m["weights"]), m["code"], m["trust"])
                order = np.argsort(-p, axis=1, kind="stable")
                top = p[np.arange(len(p)), order[:, 0]]
                second = p[np.arange(len(p)), order[:, 1]] if len(names) > 1 else np.zeros(len(p))
                first = [names[k] if ok else UNKNOWN for k, ok in zip(order[:, 0], known)]
                runner = [names[k] if ok else None for k, ok in zip(order[:, min(1, len(names) - 1)], known)]
            else:
                top = second = np.zeros(len(known))
                first, runner = [UNKNOWN] * len(known), [None] * len(known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(first, pa.string()), pa.array(np.where(known, top, 0.0)),
                 pa.array(runner, pa.string()), pa.array(~known | (top - second < ambiguous_below))],
                names=["doc_id", "held_out", "lang_pred", "score", "runner_up", "ambiguous"])

    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(apply, f"doc_id {kind}, held_out boolean, lang_pred string, score double, runner_up string, ambiguous boolean")


def accepted(docs: DataFrame, model: dict, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is decided: not ``und``, and the nearest
    codeword's probability is at least ``least``. Rows pass through the tasks whole; nothing is joined. Null texts and texts without
    a letter go, and all rows when nothing could be learned; repeated rows stay or go together; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = (docs.where(F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)))
            .select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))

    def run(batches):
        m = shared.value
        for batch in batches:
            if m["labels"]:
                data, offsets = text_buffers(pc.struct_field(batch.column("row"), text_col))
                keep = decode(margins(data, offsets, m["weights"]), m["code"], m["trust"]).max(1) >= least
                yield pa.RecordBatch.from_arrays([batch.column("row").filter(pa.array(keep))], names=["row"])

    return rows.mapInArrow(run, rows.schema).select("row.*")


def identify(docs: DataFrame, **options) -> DataFrame:
    """``fit`` and ``predict`` on one table."""
    return predict(docs, fit(docs), **options)
