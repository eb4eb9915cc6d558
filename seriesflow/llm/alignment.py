"""Cross-tokenizer alignment: an Arrow pipeline of flattened token lists, running byte ends and hash joins."""

from __future__ import annotations

import hashlib
import json
import math
import re
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesflow.llm.common import bound_batches, materialize, ragged, worker_cache

#: Characters aligned at once, and chunks of one text that are read at once.
BLOCK, PART = 1 << 20, 1 << 17
#: Chunks kept in each worker (a cache; its size changes no result), and the length above which a chunk isn't kept.
CACHED, LONG = 400_000, 256
#: Id pairs that a task holds before it sends their partial counts on, and that one broadcast of counts holds.
HELD, SLICE_PAIRS = 1 << 20, 1 << 22

_BLANKS = " \t-\r"
#: Cuts before each blank run that begins with a space, is not at the text's start and follows a character that is no blank.
CHUNK = re.compile(f"[{_BLANKS}]*+[^{_BLANKS}]++(?:[\t-\r][{_BLANKS}]*+[^{_BLANKS}]*+)*+|[{_BLANKS}]++")
#: White space beyond ASCII: a text with any is one chunk.
WIDE_BLANK = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Fixed pattern by which byte-level vocabularies split a text before their merges.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BYTE_OF = {chr(b): b for b in _VISIBLE} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class Store:
    """Id lists by number, one after the other in one array."""

    def __init__(self):
        self.ids, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, lists: list) -> None:
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum()))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, flat])

    def take(self, numbers: np.ndarray) -> np.ndarray:
        return self.ids[ragged(self.starts[numbers], self.lengths[numbers])]


class Tokenizers:
    """Both tokenizers, chunk by chunk.

    Neither has a token that reaches over a cut of ``CHUNK``: A splits a text
    there before its merges, and no piece of B holds a space mark after
    another character. So the ids of a text are those of its chunks, and a
    chunk is encoded once.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.ranked = _ranked(path_a)
        words = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            self.bytes_a[i] = bytes(map(_BYTE_OF.__getitem__, word)) if all(c in _BYTE_OF for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        self.width_a, self.width_b = (pa.array([len(x) for x in table], pa.int64()) for table in (self.bytes_a, self.bytes_b))
        self.blank = self.b.piece_to_id("▁")
        # What stands in a groups string: a token and what follows it; of A: the next one or its group's end, of B: also the text's end.
        self.names = pa.array([f"{i}{end}" for i in range(self.size_a) for end in ",|"]
                              + [f"{i}{end}" for i in range(self.size_b) for end in (",", ";", "")], pa.large_string())
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.store_a, self.store_b, self.same = Store(), Store(), np.zeros(0, bool)

    def numbers(self, chunks: list[str]) -> np.ndarray:
        if len(self.index) > CACHED or len(self.store_a.ids) > 16 * CACHED:
            self.clear()
        new = list(set(chunks).difference(self.index))
        if new:
            a = list(map(self.ranked.encode_ordinary, new)) if self.ranked else [e.ids for e in self.a.encode_batch(new, add_special_tokens=False)]
            b = [x or [self.blank] for x in self.b.encode([c[1:] for c in new], num_threads=1)]  # B adds the space that each chunk begins with
            known = len(self.same)
            self.index.update(zip(new, range(known, known + len(new))))
            self.store_a.add(a)
            self.store_b.add(b)
            joined = lambda table, lists: [b"".join(map(table.__getitem__, x)) for x in lists]
            raw = [c.encode() for c in new]
            same = list(map(bytes.__eq__, raw, joined(self.bytes_b, b)))
            if not self.ranked:  # a byte-level vocabulary with all bytes loses none
                same = [x and y for x, y in zip(same, map(bytes.__eq__, raw, joined(self.bytes_a, a)))]
            self.same = np.concatenate([self.same, np.array(same, bool)])
        out = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        for c in new:
            if len(c) > LONG:
                del self.index[c]
        return out


def _ranked(path: str):
    """The vocabulary of a tokenizer file as one of ranks, whose encoder is several times as fast on short strings; None
    unless it is a byte-level one with all 256 bytes, whose splitting is the usual one and whose ids count its merges."""
    import tiktoken
    spec = json.load(open(path, encoding="utf-8"))
    model, before, special = spec["model"], spec.get("pre_tokenizer") or {}, {t["content"] for t in spec.get("added_tokens", [])}
    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or any(before.get(k) != v for k, v in usual.items()):
        return None
    vocab = {w: i for w, i in model["vocab"].items() if w not in special}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if any(c not in _BYTE_OF for w in vocab for c in w) or not set(_BYTE_OF) <= set(vocab) or [vocab[m] for m in merges] != list(range(256, 256 + len(merges))):
        return None
    ranks = {bytes(map(_BYTE_OF.__getitem__, w)): i for w, i in vocab.items()}
    return tiktoken.Encoding("ranked", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


def parts(text: str):
    """The chunks of a space and ``text``, some at a time."""
    full = " " + text
    if WIDE_BLANK.search(text):
        yield [full]
    elif len(text) < PART:
        yield CHUNK.findall(full)
    else:
        found = (m.group() for m in CHUNK.finditer(full))
        while part := list(islice(found, PART)):
            yield part


def token_table(lists: pa.Array, widths: pa.Array, name: str) -> pa.Table:
    """One row a token: its id as ``name`` and the key of its document and byte end there."""
    ids, parent = pc.list_flatten(lists), pc.cast(pc.list_parent_indices(lists), pa.int64())
    ends = pc.cumulative_sum(widths.take(ids))
    first = np.asarray(lists.offsets)[:-1]
    before = np.concatenate([[0], np.asarray(ends)])[first]  # bytes of the documents before this one
    return pa.table({"key": pc.add(pc.shift_left(parent, 40), pc.subtract(ends, pa.array(before).take(parent))), name: ids})


def lists_of(store: Store, numbers: np.ndarray, first: np.ndarray) -> pa.Array:
    """The ids of each document; ``first``: where its chunks begin in ``numbers`` (and the end)."""
    sums = np.concatenate([[0], np.cumsum(store.lengths[numbers])])
    return pa.LargeListArray.from_arrays(pa.array(sums[first]), pa.array(store.take(numbers)))


def align(tools: Tokenizers, numbers: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[pa.Table, np.ndarray, list[bytes]]:
    """Links and groups of documents, or parts of them, that are given as chunk numbers.

    A hash join of the two token tables on the document-end key finds the
    bytes where tokens of both end. Between one end, of either, and the next
    lies one link: of the A and the B token that end next. Returned are (doc,
    pair, n), per document (n_a, n_b, n_groups), and its part of the groups
    string. ``last``: whether a document's last chunk is here.
    """
    if not len(numbers):
        none = pa.array([], pa.int64())
        return pa.table({"doc": none, "pair": none, "count_all": none}), np.zeros((len(first) - 1, 3), np.int64), [b""] * (len(first) - 1)
    lists = [lists_of(s, numbers, first) for s in (tools.store_a, tools.store_b)]
    ends = (token_table(lists[0], tools.width_a, "a").join(token_table(lists[1], tools.width_b, "b"), "key", join_type="full outer", use_threads=False)
            .sort_by("key").combine_chunks())
    ends_a, ends_b = (np.asarray(pc.is_valid(ends[c])) for c in "ab")
    both = ends_a & ends_b
    doc = np.asarray(ends["key"]) >> 40
    a, b = (np.asarray(pc.fill_null_backward(ends[c])).astype(np.int64) for c in "ab")
    docs = len(first) - 1
    links = pa.table({"doc": doc, "pair": a * tools.size_b + b}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    counts = np.stack([np.bincount(doc[x], minlength=docs) for x in (ends_a, ends_b, both)], 1)

    # Tokens in the order of the string: group by group, A before B.
    group = np.cumsum(both) - both
    of_a, of_b = np.flatnonzero(ends_a), np.flatnonzero(ends_b)
    until_a, until_b = (np.concatenate([[0], np.cumsum(x)[both]]) for x in (ends_a, ends_b))  # tokens until each group's end
    code = np.empty(len(of_a) + len(of_b), np.int64)
    code[np.arange(len(of_a)) + until_b[group[of_a]]] = a[of_a] * 2 + both[of_a]
    final = np.zeros(len(both), bool)
    final[np.searchsorted(doc, np.flatnonzero(last & (np.diff(first) > 0)), "right") - 1] = True
    code[np.arange(len(of_b)) + until_a[group[of_b] + 1]] = 2 * tools.size_a + b[of_b] * 3 + both[of_b] + final[of_b]
    text = tools.names.take(pa.array(code))
    at = np.frombuffer(text.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(counts[:, :2].sum(1))])]
    raw = memoryview(text.buffers()[2] or b"")
    return links, counts, [raw[i:j] for i, j in zip(at[:-1], at[1:])]


def align_texts(tools: Tokenizers, texts: list[str | None]) -> tuple[np.ndarray, list[str], pa.Table]:
    """Of each text n_a, n_b and n_groups, the groups' SHA-256, and (row, pair, n) of all; zeros, '' and no pairs for those without tokens."""
    n = len(texts)
    counts, ok, hashes, links = np.zeros((n, 3), np.int64), np.ones(n, bool), [None] * n, []
    held: list[tuple[int, list[str], bool]] = []

    def flush():
        first = np.concatenate([[0], np.cumsum([len(c) for _, c, _ in held])])
        row = np.array([r for r, _, _ in held])
        numbers = tools.numbers(list(chain.from_iterable(c for _, c, _ in held)))
        same = np.logical_and.reduceat(tools.same[numbers], first[:-1])
        ok[row[~same]] = False
        numbers = numbers[np.repeat(same, np.diff(first))]
        first = np.concatenate([[0], np.cumsum(np.diff(first) * same)])
        found, new, text = align(tools, numbers, first, np.array([e for _, _, e in held]))
        np.add.at(counts, row, new)
        for r, x in zip(row, text):
            hashes[r] = hashes[r] or hashlib.sha256()
            hashes[r].update(x)
        links.append(pa.table({"row": pa.array(row).take(found["doc"].combine_chunks()), "pair": found["pair"], "n": found["count_all"]}))
        held.clear()

    size = 0
    for r, text in enumerate(texts):
        ok[r] = bool(text)
        if text:
            ahead = parts(text)
            part = next(ahead)
            while part:
                after = next(ahead, None)
                held.append((r, part, after is None))
                size += sum(map(len, part))
                if size > BLOCK:
                    flush()
                    size = 0
                part = after
    if held:
        flush()
    counts[~ok] = 0
    table = pa.concat_tables(links) if links else pa.table({"row": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    if len(links) > 1:  # a long text's parts may hold a pair each
        table = table.group_by(["row", "pair"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["row", "pair", "n"])
    table = table.filter(pa.array(ok).take(table["row"].combine_chunks())).sort_by([("row", "ascending"), ("pair", "ascending")])
    return counts, [h.hexdigest() if k else "" for h, k in zip(hashes, ok)], table


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its id pairs with their number of links.

    A pair is A's id times the size of B's vocabulary plus B's id."""
    kind = dict(docs.dtypes)[id_col]
    bound_batches(docs.sparkSession)

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache = worker_cache()
        tools = cache.get((path_a, path_b)) or cache.setdefault((path_a, path_b), Tokenizers(path_a, path_b))
        for batch in batches:
            counts, sha, pairs = align_texts(tools, batch.column("text").to_pylist())
            first = pa.array(np.searchsorted(np.asarray(pairs["row"]), np.arange(len(sha) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(counts[:, k]) for k in range(3)), pa.array(counts[:, 0] + counts[:, 1] - counts[:, 2]),
                 pa.array(sha, pa.string()), *(pa.ListArray.from_arrays(first, pc.cast(pairs[c], pa.int64()).combine_chunks()) for c in ("pair", "n"))],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): links of each id pair in the corpus, and whether none of its B id has more.

    Each task counts its rows' pairs in Arrow; Spark adds the tasks' counts."""
    def partial(batches):
        held = None
        for batch in batches:
            lists = batch.column("pairs")
            new = pa.table({"pair": pc.list_flatten(lists), "n": pc.list_flatten(batch.column("times"))})
            held = pa.concat_tables([held, new]) if held is not None else new
            if len(held) > HELD:
                held = held.group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
                if len(held) > HELD // 2:
                    yield from held.to_batches()
                    held = None
        if held is not None and len(held):
            yield from held.group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"]).to_batches()

    counts = materialize(aligned.select("pairs", "times").mapInArrow(partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    b = F.pmod("pair", F.lit(size_b))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(most, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def token_alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A's tokens of a space and the text, and B's of the text (B adds the space),
    are set against each other by their bytes. Where tokens of both end, a group
    ends; a link is an A and a B token whose bytes overlap. ``count_sum`` adds,
    over a document's links, how many links of the corpus have the same id pair;
    ``n_best`` counts its links whose pair no other pair of the same B id beats.

    Each task aligns its texts on its own, 1 MB at a time; what it keeps of a
    document are its different id pairs. The corpus-wide counts have one row for
    each id pair that ever overlaps, a number that the vocabularies bound. They
    are read in broadcast slices of ``slice_pairs`` pairs at most on average,
    each slice adding to the documents' sums, so that neither the driver nor a
    worker holds more, and no document list is shuffled.

    Null and empty texts, and those whose token bytes aren't the text (such as
    texts with U+2581), have zeros and ''. Repeated rows count each. Very long
    texts are aligned part by part. An empty table gives an empty result; other
    columns are ignored. Null ids are allowed.
    """
    import sentencepiece
    spark = docs.sparkSession
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    aligned = materialize(alignments(docs, path_a, path_b, id_col, text_col), "align-documents")
    counts = materialize(pair_counts(aligned, size_b), "align-pairs")
    out = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    slices = math.ceil(counts.count() / slice_pairs)
    for k in range(slices):
        part = counts.where(F.pmod(F.hash("pair"), F.lit(slices)) == k).toArrow().sort_by("pair")
        shared = spark.sparkContext.broadcast(tuple(part[c].to_numpy() for c in ("pair", "n", "best")))
        out = out.mapInArrow(_adder(shared), out.schema)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _adder(shared):
    """Adds one slice's counts to the sums of each document."""
    def run(batches):
        pair, n, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            flat, row = np.asarray(pc.list_flatten(lists)), np.asarray(pc.list_parent_indices(lists))
            times = np.asarray(pc.list_flatten(batch.column("times")))
            at = np.minimum(np.searchsorted(pair, flat), len(pair) - 1) if len(pair) else np.zeros(0, np.int64)
            here = pair[at] == flat if len(pair) else np.zeros(len(flat), bool)
            at, times, row = at[here], times[here], row[here]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row, times * best[at])
            np.add.at(sums[1], row, times * n[at])
            columns = {name: batch.column(name) for name in batch.schema.names}
            for name, more in zip(("n_best", "count_sum"), sums):
                columns[name] = pc.add(columns[name], pa.array(more))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return run
