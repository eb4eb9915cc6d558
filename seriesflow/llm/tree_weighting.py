"""Language-model scoring by context-tree weighting over bytes."""

from __future__ import annotations

import math
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesflow.llm.common import BLANK, LOWER_TABLE, crc_mod, materialize, mix64, row_slices, span_hashes, text_buffers, word_spans, worker_cache
from seriesflow.llm.minhash_forest import groups_of

#: Context bytes; contexts up to TOP bytes are mixed by Spark's own aggregates, longer ones inside tasks.
DEPTH, TOP = 5, 2
#: Ends a text, and stands before its first byte: no UTF-8 text holds it.
END = 0xFF
SLICE, FLUSH = 1 << 20, 1_600_000
#: Grams that a task weighs at once (whole parts of three context bytes).
PART_ROWS = 1 << 17
#: Broadcast tables have at most about so many entries (12 bytes each, a worker's grams 26 more); larger ones are broadcast in slices, one a pass.
MOST_GRAMS, MOST_WORDS, LEAST = 1 << 22, 1 << 22, 1 << 16
SMOOTHING = 0.1


def byte_grams(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol (the text's bytes, then END) with the ``depth`` bytes before it, as one number; where each text's begin."""
    n = len(offsets) - 1
    starts = offsets + (depth + 1) * np.arange(n + 1)
    text = np.full(starts[-1], END, np.uint8)
    text[np.arange(len(data)) + np.repeat((depth + 1) * np.arange(n) + depth, np.diff(offsets))] = data
    key = np.zeros(max(0, len(text) - depth), np.uint64)
    wide = text.astype(np.uint64)
    for j in range(depth + 1):
        key = (key << np.uint64(8)) | wide[j:j + len(key)]
    keep = np.ones(len(key), bool)  # windows that end in the next text's lead
    for j in range(depth):
        at = starts[1:-1] - depth + j
        keep[at] = False
    return key[keep], offsets + np.arange(n + 1)


def sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, each row's place among them, and the values' sums."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, place, [np.bincount(place, v, len(distinct)) for v in values]


def log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 7.0
    shift = np.ones_like(x)
    for k in range(7):
        shift = shift * (x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - np.log(shift)


def log_gamma_column(x: Column) -> Column:
    """The same series (error under 1e-9 from 1/2 on) as a Spark expression."""
    y = x + 7.0
    shift = x
    for k in range(1, 7):
        shift = shift * (x + float(k))
    return ((y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * y * y * y * y * y) - F.log(shift))


def log_kt(lg, zeros, ones):
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts (``lg``: a log-gamma)."""
    return lg(zeros + 0.5) + lg(ones + 0.5) - lg(zeros + ones + 1.0) - math.log(math.pi)


def weigh(keys: np.ndarray, n: np.ndarray, depth: int, top: int) -> dict[int, dict]:
    """Nodes of the levels depth .. top + 1, from the deepest up.

    A node is a context and the bits of the symbol known so far (1, then the
    bits). ``own``: how much its own estimate counts against its children's,
    given all training symbols; ``place``: where, among this level's nodes, each
    node one level deeper (at the deepest: each gram's bit) has its parent.
    """
    sym = (keys & np.uint64(0xFF)).astype(np.int64)
    bits = np.arange(8)
    prefix = (1 << bits)[None] | (sym[:, None] >> (8 - bits)[None])
    bit = ((sym[:, None] >> (7 - bits)[None]) & 1).ravel()
    node = ((keys & ~np.uint64(0xFF))[:, None] | prefix.astype(np.uint64)).ravel()
    times = np.repeat(n.astype(float), 8)
    levels = {}
    ids, place, (zeros, ones) = sum_by(node, times * (1 - bit), times * bit)
    weighted = log_kt(log_gamma, zeros, ones)
    levels[depth] = {"ids": ids, "place": place, "p": (ones + 0.5) / (zeros + ones + 1), "own": np.ones(len(ids)),
                     "zeros": zeros, "ones": ones, "weighted": weighted, "bit": bit}
    for d in range(depth - 1, top, -1):
        low = levels[d + 1]
        ids, place, (zeros, ones, below) = sum_by(low["ids"] & np.uint64((1 << 8 * (d + 1)) - 1), low["zeros"], low["ones"], low["weighted"])
        own = log_kt(log_gamma, zeros, ones)
        weighted = np.logaddexp(own, below) - math.log(2)
        levels[d] = {"ids": ids, "place": place, "p": (ones + 0.5) / (zeros + ones + 1), "own": np.exp(own - math.log(2) - weighted),
                     "zeros": zeros, "ones": ones, "weighted": weighted}
    return levels


def gram_scores(levels: dict, depth: int, top: int, mass: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """log10 P(symbol | context) of each gram; ``mass`` and ``rest``: what the levels down to ``top`` give to bit 1
    and leave to deeper ones, for the nodes of level top + 1."""
    for d in range(top + 1, depth + 1):
        level = levels[d]
        mass, rest = mass + rest * level["own"] * level["p"], rest * (1 - level["own"])
        mass, rest = mass[level["place"]], rest[level["place"]]
    p = np.where(levels[depth]["bit"] == 1, mass, 1 - mass)
    return np.log10(np.maximum(p, 1e-300)).reshape(-1, 8).sum(1)


def count_corpus(docs: DataFrame, id_col: str, text_col: str, folds: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """(grams: part, key, n; words: key, n). Grams of all texts, counted in training texts; words of training texts.

    Tasks count slices of a megabyte and merge them, so they hold a bounded table."""
    rows = docs.select((crc_mod(id_col, folds) != 0).alias("train"), F.col(text_col).alias("text"))

    def run(batches):
        held = {0: [], 1: []}

        def merged(kind):
            if not held[kind]:
                return np.zeros(0, np.uint64), np.zeros(0)
            keys, _, (n,) = sum_by(np.concatenate([k for k, _ in held[kind]]), np.concatenate([n for _, n in held[kind]]))
            return keys, n

        def out(kind):
            keys, n = merged(kind)
            held[kind] = []
            part = (keys >> np.uint64(8)) & np.uint64(0xFFFFFF) if kind == 0 else keys
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(part.view(np.int64)),
                                               pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["kind", "part", "key", "n"])

        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                text, at = LOWER_TABLE[data[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i]
                keys, first = byte_grams(text, at, depth)
                trained = np.repeat(train[i:j], np.diff(first))
                fresh, n = np.unique(keys[trained], return_counts=True)
                held[0].append((fresh, n))
                if not trained.all():
                    other = np.unique(keys[~trained])
                    held[0].append((other, np.zeros(len(other), np.int64)))
                begin, end, first = word_spans(text, at, BLANK)
                trained = np.repeat(train[i:j], np.diff(first))
                held[1].append(np.unique(span_hashes(text, begin, end)[trained], return_counts=True))
                for kind in (0, 1):
                    if sum(len(k) for k, _ in held[kind]) > FLUSH:
                        held[kind] = [merged(kind)]
                        if len(held[kind][0][0]) > FLUSH // 2:
                            yield out(kind)
        yield out(0)
        yield out(1)

    counts = materialize(rows.mapInArrow(run, "kind int, part long, key long, n long"), "ctw-counts")
    grams = counts.where("kind = 0").groupBy("part", "key").agg(F.sum("n").alias("n"))
    words = counts.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
    return materialize(grams, "ctw-grams"), materialize(words, "ctw-words")


def gram_table(grams: DataFrame, depth: int, top: int = TOP) -> DataFrame:
    """(key, logp) of every gram: the weighted tree's log10 probability of its last byte after the others."""
    def up(batches):
        for key, n in _parts(batches, "key", "n"):
            level = weigh(key.view(np.uint64), n, depth, top)[top + 1]
            yield pa.RecordBatch.from_arrays([pa.array(level["ids"].view(np.int64)), pa.array(level["zeros"]), pa.array(level["ones"]),
                                              pa.array(level["weighted"])], names=["node", "zeros", "ones", "weighted"])

    nodes = materialize(grams.repartition("part").sortWithinPartitions("part").mapInArrow(up, "node long, zeros double, ones double, weighted double"), "ctw-nodes")
    levels = {top + 1: nodes}
    for d in range(top, -1, -1):
        up_one = levels[d + 1].groupBy(F.col("node").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1)).alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
        own = log_kt(log_gamma_column, F.col("zeros"), F.col("ones"))
        larger = F.greatest("kt", "below")
        levels[d] = materialize(up_one.withColumn("kt", own).withColumn(
            "weighted", larger + F.log1p(F.exp(F.least("kt", "below") - larger)) - math.log(2))
            .withColumn("own", F.exp(F.col("kt") - math.log(2) - F.col("weighted"))), f"ctw-level{d}")
    p = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    down = levels[0].select("node", (F.col("own") * p).alias("mass"), (1 - F.col("own")).alias("rest"))
    for d in range(1, top + 1):
        parent = down.select(F.col("node").alias("up"), "mass", "rest")
        mine = levels[d].withColumn("up", F.col("node").bitwiseAND(F.lit((1 << 8 * d) - 1)))
        down = mine.join(parent, "up").select("node", (F.col("mass") + F.col("rest") * F.col("own") * p).alias("mass"),
                                              (F.col("rest") * (1 - F.col("own"))).alias("rest"))
    parent = down.select(F.col("node").alias("up"), "mass", "rest")
    tops = (nodes.select("node", F.col("node").bitwiseAND(F.lit((1 << 8 * (top + 1)) - 1)).alias("up")).join(parent, "up")
            .select(F.shiftright("node", 8).alias("part"), F.col("node").alias("key"), F.lit(0).cast("long").alias("n"), "mass", "rest"))

    def whole(batches):
        for key, n, mass, rest in _parts(batches, "key", "n", "mass", "rest"):
            top_row = ~np.isnan(mass)
            levels = weigh(key[~top_row].view(np.uint64), n[~top_row], depth, top)
            at = np.argsort(key[top_row])  # the same nodes as weigh's, in the same order
            assert np.array_equal(key[top_row][at].view(np.uint64), levels[top + 1]["ids"])
            logp = gram_scores(levels, depth, top, mass[top_row][at], rest[top_row][at])
            yield pa.RecordBatch.from_arrays([pa.array(key[~top_row]), pa.array(logp)], names=["key", "logp"])

    both = grams.select("part", "key", "n", F.lit(None).cast("double").alias("mass"), F.lit(None).cast("double").alias("rest")).unionByName(tops)
    return materialize(both.repartition("part").sortWithinPartitions("part").mapInArrow(whole, "key long, logp double"), "ctw-table")


def _parts(batches, *names):
    """Columns of whole parts, some at a time, of a partition that is sorted by part: at most ``PART_ROWS`` rows and one part more are held."""
    held, size = [], 0
    for table in chain(groups_of(batches, ["part"]), [None]):
        if table is not None:
            held.append(table)
            size += table.num_rows
        if size >= PART_ROWS or (table is None and size):
            whole = pa.concat_tables(held)
            yield [whole.column(c).to_numpy() for c in names]
            held, size = [], 0


class Table:
    """Numbers by 64-bit key, as an open-addressing table in two arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(2 * len(keys) - 1).bit_length())
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.keys, self.values, self.used = np.zeros(size, np.uint64), np.zeros(size, np.float32), np.zeros(size, bool)
        todo, at = np.arange(len(keys)), (mix64(keys) >> self.shift).astype(np.int64)
        owner = np.full(size, -1, np.int64)
        while len(todo):
            free = ~self.used[at]
            owner[at[free]] = todo[free]
            won = free & (owner[at] == todo)
            self.used[at[won]] = True
            self.keys[at[won]], self.values[at[won]] = keys[todo[won]], values[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & (size - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = (mix64(keys) >> self.shift).astype(np.int64)
        out = self.values[at]
        todo = np.flatnonzero(self.keys[at] != keys)
        at = at[todo]
        while len(todo):
            at = (at + 1) & (len(self.keys) - 1)
            hit = self.keys[at] == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            go = ~hit & self.used[at]
            todo, at = todo[go], at[go]
        return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, depth: int = DEPTH,
          most_grams: int = MOST_GRAMS, most_words: int = MOST_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte; a row per row of ``docs``.

    The model is a context tree over the lower-cased texts' bytes, each split
    into 8 binary decisions, learned from rows whose crc32(id) mod ``folds``
    is not 0. Every node (a context of 0 to ``depth`` bytes, and the bits
    already known) estimates its next bit by Krichevsky-Trofimov counts over
    the whole training corpus; from the deepest contexts up, a node's weighted
    probability is the mean of its own estimate and its children's product,
    which sets how far a prediction goes by the node or by longer contexts.
    ``score`` is log10 P(text and its end); ``bits_per_byte`` the code length.

    Counting: tasks count byte (depth + 1)-grams and words of their slices,
    Spark sums them, and the tree is weighed level by level in partitions of
    the nearest three bytes, then by aggregates. Scoring reads each text once
    against the grams' table, broadcast while it has at most ``most_grams``
    entries; above that the texts are read once for each slice of so many, with the same
    result. The unigram base works alike, by 64-bit word hashes.

    Null texts are empty: only their end is scored. Rows with a null id are
    held out like the empty id text (crc32 0). Repeated rows count and score
    each. Without training rows V and N are 0. Very long texts are read in one
    slice of their own; an empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    grams, words = count_corpus(docs, id_col, text_col, folds, depth)
    table = gram_table(grams, depth)
    ends = docs.where(crc_mod(id_col, folds) != 0).count()
    totals = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    v, total = totals.v + (ends > 0), totals.n + ends
    floor = math.log10(total + SMOOTHING * (v + 1))
    end_score = math.log10(ends + SMOOTHING) - floor
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(id_col, folds) == 0).alias("held_out"), F.col(text_col).alias("text"))
    gram_slices, word_slices = _slices(table, table.count(), most_grams), _slices(words, totals.v, most_words)
    if len(gram_slices) == len(word_slices) == 1:
        shared = _shared_slice(gram_slices[0], table, "logp", "float"), _shared_slice(word_slices[0], words, "n", None)
        scored = _sums(rows, f"doc_id {kind}, held_out boolean", *shared, depth)
    else:
        scored = _score_in_passes(rows, kind, table, words, depth, gram_slices, word_slices)
    return scored.select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"), (F.col("n_known") + (1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("word_logs") - F.col("n_words") * floor + end_score).alias("base_score"),
        "score", "n_bytes", (-F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))


def _score_in_passes(rows: DataFrame, kind: str, table: DataFrame, words: DataFrame, depth: int, gram_slices: list, word_slices: list) -> DataFrame:
    """For tables too large to broadcast: each pass reads the texts once against a slice of both, and a row's sums over the passes meet by id and digest.

    Repeated rows have the same sums, so they are counted and come apart again."""
    keyed = rows.withColumn("digest", F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    passes, sums = max(len(gram_slices), len(word_slices)), ("n_known", "word_logs", "score")
    parts = None
    for k in range(passes):
        shared = [(_shared_slice(slices[k], *what) if k < len(slices) else None)
                  for slices, what in ((gram_slices, (table, "logp", "float")), (word_slices, (words, "n", None)))]
        part = materialize(_sums(keyed, f"doc_id {kind}, held_out boolean, digest binary", *shared, depth).withColumn("pass", F.lit(k)), "ctw-pass")
        for x in shared:
            if x is not None:
                x[1].destroy()
        parts = part if parts is None else parts.unionByName(part)
    mine = [F.max(F.when(F.col("pass") == k, F.col(c))).alias(f"{c}{k}") for k in range(passes) for c in sums]
    whole = parts.groupBy("doc_id", "held_out", "digest", "n_words", "n_bytes").agg(F.count_if(F.col("pass") == 0).cast("int").alias("copies"), *mine)
    total = {c: sum((F.col(f"{c}{k}") for k in range(1, passes)), F.col(f"{c}0")).alias(c) for c in sums}
    return whole.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(
        "doc_id", "held_out", "n_words", *total.values(), "n_bytes")


def _slices(table: DataFrame, n: int, most: int) -> list[tuple[int | None, int | None]]:
    """Ranges of keys, from one bound up to the next (None: open), that hold about ``most`` of the table's ``n`` rows each (or ``LEAST``)."""
    parts = 1 if n <= most else max(2, -(-n // max(most, LEAST)))
    shares = [k / parts for k in range(1, parts)]
    cuts = sorted(set(table.agg(F.percentile_approx("key", shares, 1000)).first()[0])) if shares else []
    return list(zip([None, *cuts], [*cuts, None]))


def _shared_slice(bounds: tuple[int | None, int | None], table: DataFrame, value: str, size: str | None):
    """The bounds, and a broadcast of the keys (sorted) and values in between."""
    low, high = bounds
    inside = F.lit(True) if low is None else F.col("key") >= low
    inside = inside if high is None else inside & (F.col("key") < high)
    if size is None:
        size = "int" if (table.agg(F.max(value)).first()[0] or 0) < 2 ** 31 else "long"
    got = table.where(inside).select("key", F.col(value).cast(size)).toArrow()
    keys, values = got.column("key").to_numpy(), got.column(value).to_numpy()
    del got
    order = np.argsort(keys)
    return bounds, table.sparkSession.sparkContext.broadcast((keys[order], values[order]))


def _between(keys: np.ndarray, bounds: tuple[int | None, int | None]):
    """Where the keys lie within the bounds; all of them without any."""
    low, high = bounds
    if low is None and high is None:
        return slice(None)
    keys = keys.view(np.int64)
    return (keys < high) if low is None else (keys >= low) if high is None else (keys >= low) & (keys < high)


def _sums(rows: DataFrame, columns: str, tree_slice, word_slice, depth: int) -> DataFrame:
    """``columns`` (of ``rows``, beside the text), n_words, n_known, word_logs, score, n_bytes: sums over each text's grams and words in the slices."""
    name, names = uuid.uuid4().hex, [c.split()[0] for c in columns.split(", ")]

    def run(batches):
        cache = worker_cache()
        if cache.get("ctw", (None,))[0] != name:
            cache.pop("ctw", None)  # an earlier pass's table isn't held beside this one's, nor where a pass has none
        if tree_slice:
            if "ctw" not in cache:
                keys, values = tree_slice[1].value
                cache["ctw"] = name, Table(keys.view(np.uint64), values)
            tree = cache["ctw"][1]
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                text, at = LOWER_TABLE[data[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i]
                score = np.zeros(j - i)
                if tree_slice:
                    grams, first = byte_grams(text, at, depth)
                    logs, here = np.zeros(len(grams)), _between(grams, tree_slice[0])
                    logs[here] = tree.get(grams[here])
                    score = np.add.reduceat(logs, first[:-1])
                begin, end, first = word_spans(text, at, BLANK)
                known, word_logs = np.zeros(j - i, np.int64), np.zeros(j - i)
                if word_slice:
                    mine = span_hashes(text, begin, end)
                    here = _between(mine, word_slice[0])
                    distinct, place = np.unique(mine[here].view(np.int64), return_inverse=True)
                    hashes, counts = word_slice[1].value
                    spot = np.minimum(np.searchsorted(hashes, distinct), max(0, len(hashes) - 1))
                    c = np.where(hashes[spot] == distinct, counts[spot], 0) if len(hashes) else np.zeros(len(distinct))
                    sums = []
                    for x in (np.log10(c + SMOOTHING), (c > 0).astype(np.int64)):
                        each = np.zeros(len(mine), x.dtype)
                        each[here] = x[place]
                        sums.append(np.concatenate([[0], np.cumsum(each)]))
                    word_logs, known = (s[first[1:]] - s[first[:-1]] for s in sums)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in names), pa.array(np.diff(first)),
                     pa.array(known), pa.array(word_logs), pa.array(score), pa.array(np.diff(at))],
                    names=[*names, "n_words", "n_known", "word_logs", "score", "n_bytes"])

    return rows.mapInArrow(run, f"{columns}, n_words long, n_known long, word_logs double, score double, n_bytes long")
