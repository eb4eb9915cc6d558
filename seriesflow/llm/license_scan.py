"""License scans by diagonal voting."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesflow.llm.common import LOWER_TABLE, chain_hashes, classes, ragged, row_slices, span_hashes, text_buffers, word_spans

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Other notices, as (label, text); found also with changed words.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
                   " license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
                   " documentation files the software to deal in the software without restriction"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the"
                   " following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("all-rights-reserved", "all rights reserved"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the"
                 " software to deal in the software without restriction including without limitation the rights to use copy modify merge publish"
                 " distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject"
                 " to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial"
                 " portions of the software the software is provided as is without warranty of any kind express or implied including but not limited"
                 " to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or"
                 " copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising"
                 " from out of or in connection with the software or the use or other dealings in the software"),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that"
                 " the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims"
                 " all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the"
                 " author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data"
                 " or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or"
                 " performance of this software"),
    ("apache-header", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may"
                      " obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in"
                      " writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"
                      " either express or implied see the license for the specific language governing permissions and limitations under the license"),
]
#: Bytes between words (after lower-casing): all below 0x80 but digits and letters.
BREAKS = classes(bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80)))
BREAK_PATTERN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
K, BAND, LEAST_COVER, SLICE, CHUNK = 2, 3, 0.6, 1 << 20, 4096


def rolling(data: np.ndarray, offsets: np.ndarray, k: int = K):
    """Word starts, word ends, first word of each text, and the hash of each ``k`` words (of one text) from each word on."""
    lowered = LOWER_TABLE[data]
    starts, ends, first = word_spans(lowered, offsets, BREAKS)
    return starts, ends, first, chain_hashes(span_hashes(lowered, starts, ends), k)


def template_table(spark: SparkSession, k: int = K) -> DataFrame:
    """(hash, template, label, base, place, grams, gram): every k-gram of every template; a few hundred rows of fixed text."""
    rows = []
    for t, (label, text, base) in enumerate([(v, p, True) for p, v in BASE.items()] + [(v, p, False) for v, p in NOTICES]):
        data = text.encode()
        _, _, _, hashes = rolling(np.frombuffer(data, np.uint8), np.array([0, len(data)]), k)
        words = text.split()
        rows += [(int(h.astype(np.int64)), t, label, base, q, len(words) - k + 1, " ".join(words[q:q + k])) for q, h in enumerate(hashes)]
    return spark.createDataFrame(rows, "hash long, template int, label string, base boolean, place int, grams int, gram string")


def chains(hits: list[tuple[int, int]], grams: int) -> list[tuple[int, int, float]]:
    """(first word, last word, cover) of the longest chains of ``hits`` (position in the text, place in the notice).

    Position and place rise along a chain, and the diagonal moves by at most
    BAND from one hit to the next. Of equally long chains the one that begins
    last counts, then the one that ends first; the text before and after it goes
    on without it. A chain reaches back over a bounded number of words, so taking
    one changes only the chains of hits shortly behind it: those alone are
    computed again, and the time is linear in the hits, however often a notice repeats.
    """
    part = sorted(set(hits))
    at = [x for x, _ in part]
    least, reach = LEAST_COVER * grams, grams * (1 + BAND)
    free, wall, best = [True] * len(part), [-1] * len(part), []

    def longest(k: int) -> tuple[int, int]:
        """Hits and first position of the best chain that ends here, of free hits beyond the wall."""
        here, place = part[k]
        n, first = 0, here
        for j in range(bisect_left(at, max(here - grams - BAND, wall[k] + 1), 0, k), k):
            x, q = part[j]
            if free[j] and x < here and q < place and abs((here - place) - (x - q)) <= BAND and best[j] > (n, first if n else -1):
                n, first = best[j]
        return n + 1, first

    heap = []
    for k in range(len(part)):
        best.append(longest(k))
        if best[k][0] >= least:
            heap.append((-best[k][0], -best[k][1], at[k], k))
    heapify(heap)
    spans = []
    while heap:
        n, first, _, k = heappop(heap)
        if not free[k] or best[k] != (-n, -first):
            continue
        n, first, last = -n, -first, at[k] + K - 1
        spans.append((first, last, n / grams))
        low, high = bisect_left(at, first - K + 1), bisect_right(at, last)
        free[low:high] = [False] * (high - low)
        for k in range(high, bisect_right(at, last + reach)):
            wall[k] = max(wall[k], last)
            if free[k] and best[k][1] <= last:
                best[k] = longest(k)
                if best[k][0] >= least:
                    heappush(heap, (-best[k][0], -best[k][1], at[k], k))
    return spans


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents, one row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.
    spans, one row per place: doc_id, key, template, label, base, first, last (words from 0), cover.

    All rolling 2-word hashes of all texts are joined to the templates'
    positions (a broadcast of fixed text). Hits are checked word by word
    against the template, then counted by document, template and diagonal
    (position in the text minus position in the template). A base phrase
    stands where its diagonal has all its k-grams. For longer notices
    neighbouring diagonals (up to 3 words apart) merge, so changed, added or
    dropped words split no span. A merged span is checked again: its k-grams
    must follow each other in the text as in the notice (``chains``), which
    drops stray hits of repeated k-grams. It counts when it covers 60 % of the
    notice's k-grams. ``score`` is the best cover of any span.

    Null texts count as empty and have no words; rows with the same doc_id and
    text share their spans (hits of repeated rows count once). Very long texts
    are hashed in chunks of 4096 words; a document's hits of one notice are checked together, in time linear
    in their number. Other columns are ignored; empty tables give empty results.
    """
    kind = dict(docs.dtypes)[id_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))

    def grams(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                part = data[offsets[i]:offsets[j]]
                starts, ends, first, hashes = rolling(part, offsets[i:j + 1] - offsets[i])
                per = np.maximum(np.diff(first) - K + 1, 0)
                chunks = -(-per // CHUNK)  # a long text becomes several rows; a k-gram lies in one
                doc = np.repeat(np.arange(i, j), chunks)
                number = ragged(np.zeros(len(per), np.int64), chunks)
                low = np.repeat(first[:-1], chunks) + number * CHUNK
                size = np.minimum(CHUNK, np.repeat(first[:-1] + per, chunks) - low)
                take = ragged(low, size)
                begin, end = starts[low], ends[np.maximum(low + size + K - 2, 0)]
                at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in (
                    hashes[take].view(np.int64), (starts[take] - np.repeat(begin, size) + 1).astype(np.int32),
                    (ends[take + K - 1] - starts[take]).astype(np.int32))]
                whole = part.tobytes()
                text = pa.array([whole[x:y] for x, y in zip(begin, end)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc)), batch.column("key").take(pa.array(doc)), text,
                     pa.array(number * CHUNK)] + lists, names=["doc_id", "key", "text", "before", "hashes", "starts", "sizes"])

    def count(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                _, _, first = word_spans(LOWER_TABLE[data[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i], BREAKS)
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i) for c in ("doc_id", "key")] + [pa.array(np.diff(first))],
                                                 names=["doc_id", "key", "n_words"])

    spark = docs.sparkSession
    hits = (rows.mapInArrow(grams, f"doc_id {kind}, key long, text binary, before long, hashes array<long>, starts array<int>, sizes array<int>")
            .select("doc_id", "key", "text", "before", "starts", "sizes", F.posexplode("hashes").alias("at", "hash"))
            .join(F.broadcast(template_table(spark)), "hash"))
    # Verify the words themselves: the hit's bytes must read as the k-gram.
    begin = F.expr("substring(text, starts[at], sizes[at])").cast("string")
    pattern = F.concat(F.lit("(?i)^"), F.replace("gram", F.lit(" "), F.lit(BREAK_PATTERN)), F.lit("$"))
    hits = hits.where(F.regexp_like(begin, pattern)).select(
        "doc_id", "key", "template", "label", "base", "grams", "place",
        (F.col("before") + F.col("at") - F.col("place")).alias("diagonal"))
    votes = hits.groupBy("doc_id", "key", "template", "label", "base", "grams", "diagonal").agg(
        F.collect_set("place").alias("places"), F.min("place").alias("low"), F.max("place").alias("high"))
    exact = votes.where("base and size(places) = grams").select(
        "doc_id", "key", "template", "label", "base", F.col("diagonal").cast("long").alias("first"),
        (F.col("diagonal") + F.col("grams") + (K - 2)).cast("long").alias("last"), F.lit(1.0).alias("cover"))
    # Diagonals of one document and notice, in order: a cluster ends where the next one is more than BAND away, so a chain
    # lies in one cluster, and one with too few places holds none.
    w = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    notice = votes.where("not base").withColumn("new", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(w) > BAND).cast("int"), F.lit(1)))
    merged = (notice.withColumn("cluster", F.sum("new").over(w)).groupBy("doc_id", "key", "template", "label", "base", "grams", "cluster")
              .agg(F.collect_list(F.struct(F.col("diagonal").cast("long").alias("diagonal"), "places")).alias("votes"),
                   F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"))
              .where(F.col("n") >= LEAST_COVER * F.col("grams")).drop("cluster", "n"))

    def verify(batches):
        for batch in batches:
            found = [(i, *span) for i, (votes, grams) in enumerate(zip(batch.column("votes").to_pylist(), batch.column("grams").to_pylist()))
                     for span in chains([(v["diagonal"] + q, q) for v in votes for q in v["places"]], grams)]
            rows, first, last, cover = map(list, zip(*found)) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "key", "template", "label", "base")]
                + [pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(cover, pa.float64())],
                names=["doc_id", "key", "template", "label", "base", "first", "last", "cover"])

    spans = exact.unionByName(merged.mapInArrow(
        verify, f"doc_id {kind}, key long, template int, label string, base boolean, first long, last long, cover double"))
    found = spans.groupBy("doc_id", "key").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"), F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("cover").alias("score"))
    counted = rows.mapInArrow(count, f"doc_id {kind}, key long, n_words long")
    same = counted["doc_id"].eqNullSafe(found["doc_id"]) & (counted["key"] == found["key"])
    documents = counted.join(found, same, "left").select(
        counted["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
    return documents, spans
