"""Personal data by bootstrapped contextual extraction: seeds induce patterns, patterns find more identifiers."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesflow.llm.common import BLANK, LOWER_TABLE, bound_batches, classes, materialize, mix64, ragged, row_slices, span_hashes, text_buffers, word_spans

#: Fixed kinds, in the order of the output; a span's kind is its place here plus 1, 0 a candidate's.
KINDS = ["email", "ip", "card", "phone"]
SLICE = 1 << 20
#: A pattern needs so many different known identifiers, and so large a share of all that stands in its place.
SUPPORT, CONFIDENCE = 3, 0.8
#: What an unknown identifier in a pattern's place counts against it (a plain word counts 1).
DOUBT = 0.5
#: An identifier is taken at this score; the patterns it stands in count as independent witnesses.
ACCEPTED = 0.8
#: Bits of the filter of contexts worth counting; a full filter only lets more through.
FILTER_BITS = 1 << 22

_DIGIT = classes(b"0123456789")
_LETTER = classes(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)))
_LOCAL = classes(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_PHONE = classes(b" ().0123456789-")
_NUMBER = classes(b" ().0123456789-+/")
_SOLID = ~BLANK & ~classes(b"\x00")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EDGE = b".,;:!?\"'()[]<>{}|*#$%&"


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    step = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return step[::2], step[1::2]


def chains(joined: np.ndarray) -> np.ndarray:
    """Where each chain begins, of items of which the k-th is joined to the one after it if ``joined[k]`` (one entry less than items)."""
    return np.flatnonzero(np.concatenate([[True], ~joined]))


def luhn(digits: np.ndarray) -> bool:
    d = digits.astype(np.int64)[::-1] - 48
    twice = d[1::2] * 2
    return (d[::2].sum() + (twice - 9 * (twice > 9)).sum()) % 10 == 0


def base_spans(buf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the base entities, kind by kind. Texts lie in ``buf`` with a zero byte after each."""
    none = np.zeros(0, np.int64)
    starts, ends = runs(_DIGIT[buf])
    out = []

    # email: each @ with the run before it (after the last match) and the domain after it
    at = np.flatnonzero(buf == 64)
    spans = []
    if len(at):
        outside = np.flatnonzero(~_LOCAL[buf])
        before = np.searchsorted(outside, at) - 1
        begin = np.where(before >= 0, outside[np.maximum(before, 0)] + 1, 0)
        raw, done = buf.tobytes(), 0
        for p, s in zip(at.tolist(), begin.tolist()):
            s = max(s, done)
            if s < p and (m := _DOMAIN.match(raw, p + 1)):
                done = m.end()
                spans.append((s, done))
    spans = np.array(spans, np.int64).reshape(-1, 2)
    out.append((spans[:, 0], spans[:, 1]))

    # ip: of digit runs joined by single dots, each four in a row
    if len(starts) >= 4:
        joined = (starts[1:] - ends[:-1] == 1) & (buf[ends[:-1]] == 46)
        first = chains(joined)
        size = np.diff(np.append(first, len(starts)))
        four = ragged(first, size // 4 * 4).reshape(-1, 4) if (size >= 4).any() else np.zeros((0, 4), np.int64)
        nonzero = np.concatenate([[0], np.cumsum(_DIGIT[buf] & (buf != 48))])
        value = np.zeros(len(starts), np.int64)
        for k, unit in enumerate((1, 10, 100), 1):
            inside = ends - k >= starts
            value += np.where(inside, (buf[np.maximum(ends - k, 0)].astype(np.int64) - 48) * unit, 0)
        small = (value <= 255) & (nonzero[np.maximum(ends - 3, starts)] == nonzero[starts])
        keep = four[small[four].all(1)]
        out.append((starts[keep[:, 0]], ends[keep[:, 3]]))
    else:
        out.append((none, none))

    # card: maximal chains of digit runs with one blank or dash between them
    if len(starts):
        gap = buf[ends[:-1]] if len(starts) > 1 else np.zeros(0, np.uint8)
        first = chains((starts[1:] - ends[:-1] == 1) & ((gap == 32) | (gap == 45)))
        size = np.add.reduceat(ends - starts, first)
        last = np.append(first[1:], len(starts)) - 1
        fit = np.flatnonzero((size >= 14) & (size <= 19))
        fit = np.array([k for k in fit if luhn((x := buf[starts[first[k]]:ends[last[k]]])[_DIGIT[x]])], np.int64)
        out.append((starts[first[fit]], ends[last[fit]]))
    else:
        out.append((none, none))

    # phone: + and a digit, then up to the last digit of the run of phone characters
    plus = np.flatnonzero((buf[:-1] == 43) & _DIGIT[buf[1:]]) if len(buf) > 1 else none
    if len(plus):
        digit, outside = np.flatnonzero(_DIGIT[buf]), np.append(np.flatnonzero(~_PHONE[buf]), len(buf))
        stop = outside[np.searchsorted(outside, plus + 2)]
        number = np.searchsorted(digit, stop) - np.searchsorted(digit, plus)
        end = digit[np.searchsorted(digit, stop) - 1] + 1
        keep = (end >= plus + 4) & (number >= 10) & (number <= 15)
        out.append((plus[keep], end[keep]))
    else:
        out.append((none, none))
    return out


def candidate_spans(buf: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Tokens with an @ in them, and numbers of 7 to 24 digits (with what stands in phone numbers between them), in a text
    without its base spans."""
    mails = []
    at = np.flatnonzero(buf == 64)
    if len(at):
        starts, ends = runs(_SOLID[buf])
        for k in np.unique(np.searchsorted(starts, at, "right") - 1).tolist():
            raw = buf[starts[k]:ends[k]].tobytes()
            left = len(raw) - len(raw.lstrip(_EDGE))
            raw = raw.strip(_EDGE)
            if len(raw) > 2 and 0 < raw.find(b"@") and raw.rfind(b"@") < len(raw) - 1:
                mails.append((starts[k] + left, starts[k] + left + len(raw)))
    mails = np.array(mails, np.int64).reshape(-1, 2)
    rest = buf.copy()
    rest[ragged(mails[:, 0], mails[:, 1] - mails[:, 0])] = 0
    starts, ends = runs(_NUMBER[rest])
    digit = np.flatnonzero(_DIGIT[rest])
    low, high = np.searchsorted(digit, starts), np.searchsorted(digit, ends)
    keep = (high - low >= 7) & (high - low <= 24)
    low, high = low[keep], high[keep]
    return (mails[:, 0], mails[:, 1]), (digit[low], digit[high - 1] + 1)


class Slice:
    """All identifiers and context words of some texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        self.first = offsets + np.arange(n + 1)
        self.buf = np.zeros(len(data) + n, np.uint8)
        self.buf[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
        base = base_spans(self.buf)
        rest = self.buf.copy()
        for s, e in base:
            rest[ragged(s, e - s)] = 0
        more = candidate_spans(rest)
        for s, e in more:
            rest[ragged(s, e - s)] = 0
        every = [*base, *more]
        self.kind = np.repeat([1, 2, 3, 4, 0, 0], [len(s) for s, _ in every])
        self.number = np.repeat([0, 1, 1, 1, 0, 1], [len(s) for s, _ in every])
        self.start, self.end = (np.concatenate([x[k] for x in every]) for k in (0, 1))
        order = np.lexsort((self.kind, self.start))
        self.kind, self.number, self.start, self.end = self.kind[order], self.number[order], self.start[order], self.end[order]
        self.row = np.searchsorted(self.first, self.start, "right") - 1
        words, word_ends, _ = word_spans(LOWER_TABLE[rest], np.array([0, len(rest)]), ~_LETTER)
        row = np.searchsorted(self.first, words, "right") - 1
        # Two words that stand for a text's beginning, and one for its end, around the words of each text.
        per = np.bincount(row, minlength=n)
        self.words = np.full(len(words) + 3 * n, np.uint64(1))
        place = np.arange(len(words)) + 3 * row + 2
        self.words[place] = span_hashes(LOWER_TABLE[rest], words, word_ends)
        self.place, self.word_starts = place, words
        self.text_begin = np.concatenate([[0], np.cumsum(per)])[:-1] + 3 * np.arange(n)  # the first of a text's two beginnings

    def contexts(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Hashes of the three contexts of a place: the word before it, the two words before it, the words before and after it."""
        with np.errstate(over="ignore"):
            one, two, next_ = self.words[before], self.words[before - 1], self.words[after]
            return np.stack([mix64(one ^ np.uint64(0x11)), mix64(mix64(two ^ np.uint64(0x22)) + one),
                             mix64(mix64(one ^ np.uint64(0x33)) + next_)]).view(np.int64)

    def identifier_contexts(self) -> np.ndarray:
        index = np.searchsorted(self.word_starts, self.start)
        before = np.maximum(np.where(index > 0, self.place[np.maximum(index - 1, 0)] if len(self.place) else 0, 0), self.text_begin[self.row] + 1)
        return self.contexts(before, before + 1)

    def word_contexts(self) -> np.ndarray:
        return self.contexts(self.place - 1, self.place + 1).ravel()

    def values(self) -> np.ndarray:
        """What makes two identifiers the same: a number's digits (an ip's dots too), else its lower-case letters."""
        kept = LOWER_TABLE[self.buf]
        lengths = self.end - self.start
        at = ragged(self.start, lengths)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        plain = (self.number[owner] == 1) & (self.kind[owner] != 2)
        stay = ~plain | _DIGIT[kept[at]]
        size = np.bincount(owner[stay], minlength=len(lengths))
        ends = np.cumsum(size)
        return span_hashes(kept[at[stay]], ends - size, ends).view(np.int64)


_OCC = "array<struct<start: bigint, kind: int, end: bigint, number: int, value: bigint, contexts: array<bigint>>>"


def _identifiers(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, rid (a number of the row) and occ, the row's identifiers, base ones and candidates, with places in code points."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                s = Slice(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                points = np.concatenate([[0], np.cumsum((s.buf & 0xC0) != 0x80)])
                zero = points[s.first[s.row]]
                inner = pa.StructArray.from_arrays(
                    [pa.array(points[s.start] - zero), pa.array(s.kind.astype(np.int32)), pa.array(points[s.end] - zero), pa.array(s.number.astype(np.int32)),
                     pa.array(s.values()), pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * len(s.start) + 1, 3), pa.int32()),
                                                                    pa.array(s.identifier_contexts().T.ravel()))],
                    names=["start", "kind", "end", "number", "value", "contexts"])
                first = pa.array(np.searchsorted(s.row, np.arange(j - i + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(rid + np.arange(j - i)), pa.ListArray.from_arrays(first, inner)],
                                                 names=["doc_id", "rid", "occ"])
                rid += j - i

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, rid bigint, occ {_OCC}")


def _plain_fillers(docs: DataFrame, text_col: str, patterns: DataFrame, bits: int) -> DataFrame:
    """(ctx, plain): how many plain words stand in the place of each pattern, over all texts.

    A bitmap of fixed size holds the patterns' hashes, so that a task sends on
    little else than their words; a join leaves the patterns alone."""
    slot = F.pmod("ctx", F.lit(bits))
    held = patterns.groupBy(F.shiftrightunsigned(slot, 3).alias("byte")).agg(F.bit_or(F.expr(f"shiftleft(1, cast(pmod(ctx, {bits}) % 8 as int))")).alias("bit")).toArrow()
    table = np.zeros(bits // 8, np.uint8)
    table[held["byte"].to_numpy()] = held["bit"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        table, parts, size = shared.value, [], 0

        def merged():
            ctx, n = (np.concatenate(x) for x in zip(*parts))
            kept, at = np.unique(ctx, return_inverse=True)
            return kept, np.bincount(at, n, len(kept)).astype(np.int64)

        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                ctx = Slice(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]).word_contexts()
                at = (ctx % bits).astype(np.int64)
                ctx = ctx[(table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
                if len(ctx):
                    parts.append(np.unique(ctx, return_counts=True))
                    size += len(parts[-1][0])
            if size > 1 << 18:
                parts = [merged()]
                size = len(parts[0][0])
                if size > 1 << 17:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=["ctx", "plain"])
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["ctx", "plain"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "ctx bigint, plain bigint").groupBy("ctx").agg(F.sum("plain").alias("plain"))
    return counted.join(patterns, "ctx", "left_semi")


def bootstrap(edges: DataFrame, plain: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, accept: float = ACCEPTED) -> DataFrame:
    """(value, kind, score) of all known identifiers: the seeds with score 1, and what patterns found.

    ``edges``: (ctx, shape, value, number, kind, n), the pattern-instance graph, with shape 0 to 2 for the kinds of context;
    ``plain``: (ctx, plain). Each round a pattern's confidence in a kind is the
    scores of that kind's known identifiers in its place over all that stands
    there: plain words, known identifiers, and unknown ones at half weight. Patterns of enough
    support and confidence vote for the unknown identifiers in their places;
    those of one shape count as independent. New identifiers become known and
    join the next round; the search ends when there are none.
    """
    known = materialize(edges.where("kind > 0").groupBy("value").agg(F.min("kind").alias("kind"), F.lit(1.0).alias("score")), "private-known")
    graph = edges.groupBy("ctx", "shape", "value").agg(F.sum("n").alias("n"), F.max("number").alias("number"))
    graph = materialize(graph, "private-graph")
    while True:
        seen = graph.join(known, "value", "left")
        mine = lambda k, c: F.sum(F.when(F.col("kind") == k, c).otherwise(0.0))
        sums = seen.groupBy("ctx").agg(F.sum(F.when(F.col("kind").isNull(), F.col("n") * DOUBT).otherwise(F.col("n"))).alias("all"),
                                       *[mine(k, F.col("n") * F.col("score")).alias(f"hits{k}") for k in range(1, 5)],
                                       *[mine(k, F.lit(1)).alias(f"seen{k}") for k in range(1, 5)])
        sums = sums.join(plain, "ctx", "left").withColumn("all", F.col("all") + F.coalesce("plain", F.lit(0)))
        votes = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"seen{k}").alias("support"), (F.col(f"hits{k}") / F.col("all")).alias("trust"))
                                    for k in range(1, 5)]))
        patterns = sums.select("ctx", votes.alias("v")).select("ctx", "v.*").where((F.col("support") >= support) & (F.col("trust") >= confidence))
        patterns = materialize(patterns.select("ctx", "kind", "trust"), "private-patterns")
        fits = (F.col("number") == 1) == (F.col("kind") > 1)
        found = (graph.join(known, "value", "left_anti").join(patterns, "ctx").where(fits).groupBy("value", "kind", "shape")
                 .agg((1 - F.exp(F.sum(F.log(1 - F.least("trust", F.lit(0.999)))))).alias("score"))
                 .groupBy("value").agg(F.max_by(F.struct("kind", "score"), F.struct("score", -F.col("kind"))).alias("best"))
                 .select("value", "best.*").where(F.col("score") >= accept))
        found = materialize(found, "private-found")
        if found.isEmpty():
            return known
        known = materialize(known.unionByName(found), "private-known")


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"] - 1), x["start"], x["end"])), ",")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, confidence: float = CONFIDENCE,
                 accept: float = ACCEPTED, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The base entities of each text, found by the kinds' fixed grammars in one
    pass, are the seeds. Their contexts (the word before, the two words before,
    the words before and after) are the patterns; a second pass counts the
    plain words that stand in the same places. ``bootstrap`` scores patterns
    and unknown identifiers (numbers of 7 to 24 digits, tokens with an @) in
    turn, and every place of an accepted identifier becomes a span of its
    pattern's kind. Other writings of a seed's digits are that seed.

    Only identifiers, contexts and counts are shuffled, never texts. Patterns
    and graph are tables; to the driver comes one bitmap of ``filter_bits``
    bits. All grammars run in time linear in a text's length.

    Null and empty texts have no spans. Very long texts need memory in
    proportion to their own length. Repeated rows give equal rows; null ids are
    allowed. An empty table gives an empty result; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    rows = materialize(_identifiers(docs, id_col, text_col), "private-rows")
    occ = rows.select("rid", F.explode("occ").alias("o")).select("rid", "o.*")
    edges = (occ.select("value", "number", "kind", F.posexplode("contexts").alias("shape", "ctx"))
             .groupBy("ctx", "shape", "value", "number", "kind").agg(F.count(F.lit(1)).alias("n")))
    edges = materialize(edges, "private-edges")
    patterns = materialize(edges.select("ctx", "value").distinct().groupBy("ctx").agg(F.count(F.lit(1)).alias("values"))
                           .where(F.col("values") > support).select("ctx"), "private-contexts")  # support and one to find
    plain = materialize(_plain_fillers(docs, text_col, patterns, filter_bits), "private-plain")
    known = bootstrap(edges.join(patterns, "ctx", "left_semi"), plain, support, confidence, accept)
    seeds = edges.where("kind > 0").groupBy("value").agg(F.min("kind").alias("kind"))
    known = known.select("value", "kind").unionByName(seeds.join(known, "value", "left_anti"))
    added = (occ.where("kind = 0").drop("kind").join(known, "value").groupBy("rid")
             .agg(F.collect_list(F.struct("start", "kind", "end")).alias("added")))
    base = F.transform(F.filter("occ", lambda x: x["kind"] > 0), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    none = F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>")
    out = rows.select("doc_id", "rid", base.alias("base")).join(added, "rid", "left").withColumn("added", F.coalesce("added", none))
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return out.select("doc_id", *[number(k + 1).alias(f"n_{name}") for k, name in enumerate(KINDS)], F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                      spans_text(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
