"""Fill-in-the-middle: texts cut at two unit ranks that an indexable skip list finds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from seriesflow.llm.common import BLANK, bound_batches, mix64, row_slices, text_buffers, word_spans

#: Fixed marks of the transformation.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE = 1 << 20
#: A node is in the next lane with a probability of one in so many.
SPREAD_BITS = 2


class SkipLists:
    """One indexable skip list a text, all in the same arrays.

    A node is a rank: the place before a text's unit, its head being rank 0.
    Lane 0 holds every rank, each lane above it about a quarter of the ranks
    below it and all heads. The link from a node to the next one in its lane
    carries how many units and how many code points it skips; a text's last
    link in a lane ends the lane.
    """

    def __init__(self, unit_chars: np.ndarray, first: np.ndarray):
        """``unit_chars``: code points of all units; ``first``: where each text's units begin (and the end)."""
        n = np.diff(first)
        rank = np.arange(len(unit_chars) + len(n)) - np.repeat(first[:-1] + np.arange(len(n)), n + 1)
        head = first[:-1] + np.arange(len(n))
        last = head + n
        units, chars = np.ones(len(rank), np.int64), np.zeros(len(rank), np.int64)
        inner = np.ones(len(rank), bool)
        inner[last] = False
        chars[inner] = unit_chars
        units[last] = 0  # no link
        with np.errstate(over="ignore"):
            coin = mix64(rank.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        self.lanes, self.heads, level = [(units, chars, None)], head, 0
        here = np.arange(len(rank))  # lane 0's node of each node of the present lane
        while True:
            level += 1
            up = coin[here] & np.uint64((1 << SPREAD_BITS * level) - 1) == 0
            if level * SPREAD_BITS >= 64 or not (up & (rank[here] > 0)).any():
                return
            up |= rank[here] == 0
            at = np.flatnonzero(up)
            units_up, chars_up = np.add.reduceat(units, at), np.add.reduceat(chars, at)
            here = here[at]
            ends = np.append(rank[here][1:] == 0, True)  # a text's last node here: no link on
            units, chars = np.where(ends, 0, units_up), np.where(ends, 0, chars_up)
            self.lanes.append((units, chars, at))
            self.heads = np.searchsorted(at, self.heads)

    def chars_before(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Code points before the ``rank``-th unit of each ``text``: descend, going on in a lane while its link doesn't pass the rank."""
        at, left, out = self.heads[text], rank.copy(), np.zeros(len(rank), np.int64)
        for units, chars, down in reversed(self.lanes):
            while True:
                go = np.flatnonzero((units[at] > 0) & (units[at] <= left))
                if not len(go):
                    break
                left[go] -= units[at[go]]
                out[go] += chars[at[go]]
                at[go] += 1
            if down is not None:
                at = down[at]
        return out


def text_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each unit (white space and the word after it; white space at the end), and where each text's units begin."""
    _, ends, word_first = word_spans(data, offsets, BLANK)
    per = np.diff(word_first)
    last_end = np.where(per > 0, ends[np.maximum(word_first[1:] - 1, 0)] if len(ends) else 0, offsets[:-1])
    tail = last_end < offsets[1:]
    first = np.concatenate([[0], np.cumsum(per + tail)])
    cuts = np.empty(first[-1], np.int64)
    cuts[np.arange(len(ends)) + np.repeat(np.concatenate([[0], np.cumsum(tail)[:-1]]) if len(tail) else np.zeros(0, np.int64), per)] = ends
    cuts[first[1:][tail] - 1] = offsets[1:][tail]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    begin = np.concatenate([[0], cuts])[:-1]
    return points[cuts] - points[begin], first


@arrow_udf(StructType([StructField(c, LongType()) for c in ("n", "a", "b")]))
def cut_places(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    """Units of each text, and the code points before its two cut ranks."""
    data, offsets = text_buffers(text)
    h = np.stack([h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)])
    out = []
    for i, j in row_slices(offsets, SLICE):
        chars, first = text_units(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        n = np.diff(first)
        ranks = np.sort(h[:, i:j] % (n + 1), axis=0)
        lists, texts = SkipLists(chars, first), np.arange(j - i)
        out.append(np.stack([n, *(lists.chars_before(texts, r) for r in ranks)]))
    n, a, b = np.concatenate(out, 1) if out else np.zeros((3, 0), np.int64)
    return pa.StructArray.from_arrays([pa.array(n), pa.array(a), pa.array(b)], names=["n", "a", "b"])


def _hash(id_col: str, group: int, seed: int) -> Column:
    """The ``group``-th 8 hex digits of sha256('<seed>:<id>') as a number; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, percent: int = 50,
                   spm_percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output.

    A text of n units (white space with the word after it) is cut after two
    ranks that its id's hash picks from 0 to n. ``percent`` of the documents
    are transformed, of these ``spm_percent`` suffix first (spm), the others
    prefix first (psm). Texts that are empty or hold a mark stay plain.

    The cut places come from an indexable skip list of each text, built and
    searched for all texts of a slice at once; only text and hash go to Python
    and three numbers come back, the text itself is cut by Spark. Nothing is
    shuffled. Memory: one slice of 1 MB, or one text.

    Null texts count as empty (plain, n 0, output ''). Very long texts take
    memory in proportion to their own length only. Repeated rows give equal
    rows; a null id is hashed as the empty text. An empty table gives an empty
    result; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *[_hash(id_col, k, seed).alias(f"h{k + 1}") for k in range(4)])
    rows = rows.withColumn("cut", cut_places("text", "h1", "h2"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= percent)
    rows = rows.select("doc_id", "text", F.col("cut.n").alias("n"), F.col("cut.a").alias("a"), (F.col("cut.b") - F.col("cut.a")).alias("m"),
                       F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm").alias("form"))
    part = lambda start, length: F.expr(f"substring(text, cast({start} as int), cast({length} as int))")
    prefix, middle, suffix = part("1", "a"), part("a + 1", "m"), part("a + m + 1", "2147483647")
    out = (F.when(F.col("form") == "plain", F.col("text"))
           .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
           .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    cut = F.col("form") != "plain"
    return rows.select("doc_id", "n", "form", F.when(cut, F.col("a")).alias("prefix_chars"), F.when(cut, F.col("m")).alias("middle_chars"),
                       out.alias("output"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that a transformed output was made from. Its three marks are the only ones, as texts with a mark stay plain."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    order = lambda *k: F.concat(*[F.get(parts, F.lit(i)) for i in k])
    return (F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", order(1, 3, 2)).otherwise(order(2, 3, 1)))
