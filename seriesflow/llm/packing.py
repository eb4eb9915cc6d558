"""Harmonic packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import gc
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesflow.llm.common import ragged, row_slices, text_buffers, worker_cache

CAPACITY, END_ID, SLICE = 4096, 2, 1 << 20
#: Remainders below capacity / FINEST aren't cut further: their class loses less than 1 / FINEST of a bin.
FINEST = 32
#: Pieces kept in each worker (a cache; its size changes no result).
CACHED_PIECES = 400_000


#: Letters with one lower-case form of their own: Latin without dotted and dotless i and long s.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u017e"
#: Bytes as the letters that a byte-level vocabulary writes them with: visible Latin-1 stands for itself.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class Pieces:
    """Token ids of whole texts, by pieces whose ids don't depend on their neighbours.

    The vocabulary lower-cases a text, splits it (white space, contractions,
    runs of letters, single digits, runs of the rest) and runs its merges
    inside each piece. A text of ASCII and Latin letters is split here and
    each different piece goes to the model once; any other text (and one
    that may hold a special token) goes to the tokenizer as a whole.
    """

    SPLIT = re.compile("[a-z\u00df-\u00f6\u00f8-\u017e]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u017e]+")
    PLAIN = re.compile(f"[\t-\r -~{_LETTERS}]*")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.n_ids = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.lengths = np.zeros(1 << 17, np.int64), np.zeros(1 << 17, np.int64)

    def learn(self, parts: list) -> range:
        """Keep these id lists; the numbers they got."""
        known = len(self.index)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.fromiter(chain.from_iterable(parts), np.uint32, int(lengths.sum()))
        self._grow(known + len(parts), self.n_ids + len(flat))
        self.ids[self.n_ids:self.n_ids + len(flat)] = flat
        self.starts[known:known + len(parts)] = self.n_ids + np.cumsum(lengths) - lengths
        self.lengths[known:known + len(parts)] = lengths
        self.n_ids += len(flat)
        return range(known, known + len(parts))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each text's ids followed by the end id; and where each text's begin."""
        if len(self.index) > CACHED_PIECES:
            self.clear()
        plain = [self.PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        lists = [self.SPLIT.findall(t.lower()) if p else [] for t, p in zip(texts, plain)]
        pieces = list(chain.from_iterable(lists))
        new = list(set(pieces).difference(self.index))
        model = self.tokenizer.model
        letters = lambda x: x if x.isascii() else x.encode().decode("latin-1").translate(_BYTE_LETTERS)
        self.index.update(zip(new, self.learn([[t.id for t in model.tokenize(letters(x))] for x in new])))
        per = np.fromiter(map(len, lists), np.int64, len(lists))
        number = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        sums = np.concatenate([[0], np.cumsum(self.lengths[number])])
        ends = np.cumsum(per)
        tokens = sums[ends] - sums[ends - per]
        whole = [k for k, p in enumerate(plain) if not p]
        encoded = [e.ids for e in self.tokenizer.encode_batch([texts[k] for k in whole], add_special_tokens=False)]
        tokens[whole] = [len(x) for x in encoded]
        out = np.full(int(tokens.sum()) + len(texts), END_ID, np.uint32)
        body = np.ones(len(out), bool)
        last = np.cumsum(tokens + 1)
        body[last - 1] = False
        for k, ids in zip(whole, encoded):
            begin = last[k] - 1 - tokens[k]
            out[begin:begin + tokens[k]] = ids
            body[begin:begin + tokens[k]] = False
        out[body] = self.ids[ragged(self.starts[number], self.lengths[number])]
        return out, np.concatenate([[0], last])

    def _grow(self, pieces: int, ids: int) -> None:
        while len(self.ids) < ids:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.starts) < pieces:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])


def harmonic_pieces(length: int, capacity: int = CAPACITY, finest: int = FINEST) -> list[int]:
    """Cuts of a document: whole bins, then for a rest between C/(k+1) and C/k a piece of exactly
    floor(C/(k+1)) (of which k+1 fill a bin), and so on until the rest's class is ``finest`` or more."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        piece = rest if k >= finest or rest == capacity // k else capacity // (k + 1)
        out.append(piece)
        rest -= piece
    return out


class Bins:
    """Bins of one worker: a class's open bin takes as many pieces as the class says; what stays open at the end shares bins."""

    def __init__(self, worker: int, capacity: int):
        self.next, self.capacity = worker << 33, capacity
        self.open: dict[int, list] = {}

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def put(self, piece: tuple, length: int):
        """The placed pieces of the class's bin once it is full, as (piece, sequence, offset)."""
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((piece, length))
        if len(held) < k:
            return []
        del self.open[k]
        return self._place(held)

    def _place(self, held):
        sequence, at, out = self.new(), 0, []
        for piece, length in held:
            out.append((piece, sequence, at))
            at += length
        return out

    def close(self):
        """Pieces of bins that never filled (fewer than k in each class k), longest first into the first bin with room."""
        left = sorted((x for held in self.open.values() for x in held), key=lambda x: -x[1])
        bins: list[list] = []
        room: list[int] = []
        for x in left:
            at = next((i for i, r in enumerate(room) if r >= x[1]), None)
            if at is None:
                bins.append([])
                room.append(self.capacity)
                at = len(bins) - 1
            bins[at].append(x)
            room[at] -= x[1]
        self.open = {}
        return [y for held in bins for y in self._place(held)]


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, class.

    Each worker tokenises the documents of its partition, cuts them by
    ``harmonic_pieces`` and fills the bins of each reciprocal class C/(k+1) <
    length <= C/k with k pieces, on its own: no shuffle and nothing shared.
    Bins that are still open when the partition ends (fewer than k pieces in
    each class k) share bins longest first. Null and empty texts are one end
    id; repeated rows are packed each; null ids are allowed; other columns are ignored; an empty
    table gives no pieces. A very long text is tokenised on its own, in memory in proportion to its length. Sequence ids hold the partition in their upper bits.
    """
    path, kind = vocabulary, dict(docs.dtypes)[id_col]

    def run(batches):
        cache = worker_cache()
        pieces = cache.get(path) or cache.setdefault(path, Pieces(path))
        bins = Bins(TaskContext.get().partitionId(), capacity)

        def rows(placed):
            piece, sequence, offset = zip(*placed)
            doc, start, length, crc, total = zip(*piece)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, id_type), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()),
                 pa.array([capacity // x for x in length], pa.int32())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class"])

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column("doc_id").type
            _, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                gc.disable()  # many small objects, no cycles: searching them for cycles costs a third of the time
                ids, first = pieces.encode([t or "" for t in batch.column("text").slice(i, j - i).to_pylist()])
                gc.enable()
                placed = []
                for doc, a, b in zip(batch.column("doc_id").slice(i, j - i).to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                    start = 0
                    for length in harmonic_pieces(b - a, capacity):
                        crc = zlib.crc32(ids[a + start:a + start + length].astype("<u4", copy=False))
                        placed += bins.put((doc, start, length, crc, b - a), length)
                        start += length
                if placed:
                    yield rows(placed)
        if placed := bins.close():
            yield rows(placed)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, class int")
