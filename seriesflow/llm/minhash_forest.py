"""N-gram Jaccard join by a MinHash LSH forest with exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesflow.llm.common import (BLANK, LOWER_TABLE, chain_hashes, materialize, mix64, row_slices, span_hashes, text_buffers,
                                   word_spans)
from seriesflow.llm.components import connected_components

NGRAM, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.9995
TREES, LONGEST = 16, 6
#: A pair goes to verification when this share of its hashes agrees (at a similarity of 0.8 the chance to fail is below 1e-9).
LEAST_AGREE = 0.5
BLOCK, VERIFY_BLOCK, SLICE, COLUMNS = 512, 256, 1 << 19, 8192


def prefix_lengths(trees: int = TREES, longest: int = LONGEST, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> list[int]:
    """The lengths of matched prefixes, from a tree's whole key up to the first one at which a pair exactly at the
    threshold shares a prefix in some tree with the target probability 1 - (1 - s^k)^trees. Raises if even one hash isn't enough."""
    for k in range(longest, 0, -1):
        if 1 - (1 - threshold ** k) ** trees >= target:
            return list(range(longest, k - 1, -1))
    raise ValueError("the target recall needs more trees")


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the ``n``-word shingles of each text (all its words as one if it has fewer), sorted, and
    where each text's begin. Words: lower-cased A-Z, between white space."""
    lowered = LOWER_TABLE[data]
    begin, end, first = word_spans(lowered, offsets, BLANK)
    words = span_hashes(lowered, begin, end)
    grams = chain_hashes(words, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        else:
            out.append(mix64(chain_hashes(words[a:b], b - a) + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)


def signatures(held: np.ndarray, first: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash signatures (texts x hashes, 32 bits); texts without shingles get zeros."""
    n = len(first) - 1
    out = np.zeros((n, hashes), np.uint32)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        seeds = mix64(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(hashes, 2)
        for k, (a, b) in enumerate(seeds):
            out[some, k] = np.minimum.reduceat((held * (a | np.uint64(1)) + b) >> np.uint64(32), first[:-1][some])
    return out


def groups_of(batches, key: list[str]):
    """Whole groups of a partition sorted by ``key``: lists of record batches, each of one or more whole groups.

    A partition is read batch by batch; only the last, perhaps unfinished group is carried over."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        values = [held.column(c).to_numpy() for c in key]
        last = np.ones(held.num_rows, bool)
        for v in values:
            last &= v == v[-1]
        cut = int(np.argmax(last))
        if cut:
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def starts_of(table, key: list[str]) -> np.ndarray:
    """Where each group begins in a table sorted by ``key``, with the end as last."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in key:
        v = table.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.concatenate([np.flatnonzero(new), [table.num_rows]])


def reach(sig: np.ndarray, least: int) -> np.ndarray:
    """Component number of each row, rows being joined when at least ``least`` of their hashes agree.

    Breadth first: one row at a time is compared with all rows not yet reached, so a dense group takes few comparisons."""
    label = np.full(len(sig), -1)
    left = np.arange(len(sig))
    queue: list[int] = []
    while len(left):
        if not queue:
            label[left[0]] = left[0]
            queue, left = [int(left[0])], left[1:]
            continue
        at = queue.pop()
        near = (sig[left] == sig[at]).sum(1) >= least
        label[left[near]] = label[at]
        queue += left[near].tolist()
        left = left[~near]
    return label


def smallest(part: np.ndarray, label: np.ndarray) -> np.ndarray:
    """For each row the smallest ``part`` of its component; ``label`` is a row of it."""
    low = part.copy()
    np.minimum.at(low, label, part)
    return low[label]


def spanning(part: np.ndarray, side: np.ndarray, sig: np.ndarray, least: int, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the rows' ``part`` wherever ``reach`` joins the rows: to the smallest one of a component from each other.

    Rows of two blocks: only what joins components of the one and the other; those inside a block are joined where it meets itself."""
    low = smallest(part, reach(sig, least))
    if within:
        return low, part
    own = np.empty_like(part)
    for s in (0, 1):
        at = np.flatnonzero(side == s)
        own[at] = smallest(part[at], reach(sig[at], least))
    return low, own


def _block_pairs(df: DataFrame, size: str, block: int, ident: str) -> DataFrame:
    """Deal the rows of each group to blocks of about ``block`` rows, and each block to every pair of blocks it is part
    of: bi, bj, side (0: the row is of block bi). A group of n rows gives n * ceil(n / block) rows, not n * n."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), ident), blocks).cast("int")
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("__blocks") - 1), lambda o: F.struct(
        F.least(F.col("__own"), o).alias("bi"), F.greatest(F.col("__own"), o).alias("bj"), (F.col("__own") > o).cast("int").alias("side"))))
    return (df.withColumn("__blocks", blocks).withColumn("__own", own).withColumn("__pair", pair)
            .select("*", "__pair.*").drop("__blocks", "__own", "__pair"))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    trees: int = TREES, longest: int = LONGEST, target: float = TARGET_RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_similar_texts, n_shingles; one row per row of ``docs``.

    Links join documents whose sets of 5-word shingles have a Jaccard
    similarity of at least ``threshold``; a class is a component of links, and
    ``class_id`` its smallest doc_id. ``n_links`` counts the other documents
    linked to this one (copies too), ``n_similar_texts`` the different shingle
    sets among them. Similarities are exact, over whole texts; a pair is missed only
    if no tree brings it together (at the threshold: one in 2,000; at 0.9: fewer than one in 10^7)
    and no other document joins the two.

    Documents with equal sets become one row (a 128-bit digest of the set).
    Each of 16 trees is a prefix trie over the rows' keys of 6 of its own
    hashes. Rows meet first where whole keys are equal; then the prefix is shortened,
    hash by hash, until it reaches the target recall (``prefix_lengths``), and
    at each length only the trie nodes are opened whose rows aren't all joined yet: a
    hot group of near copies meets under its long prefixes once and not again under the
    short ones. Meeting
    rows whose whole signatures agree in half their hashes form candidate
    components; inside these all pairs are verified. Large groups (a hot prefix
    or component) are cut into blocks and worked off block pair by block pair, in
    different tasks; only counts and spanning edges leave a task, never pairs.

    Documents without a word (null, empty, blank) have no links and are a class
    of their own. Null doc_ids are allowed (a class of only such rows has a
    null class_id). Repeated rows count as copies. A very long text takes memory in proportion to its own
    shingles. An empty table gives an empty result. Other columns are ignored.
    """
    kind = dict(docs.dtypes)[id_col]
    hashes = trees * longest
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def sketch(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                held, first = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                sig = signatures(held, first, hashes)
                s1, s2 = set_digests(held, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(np.diff(first)),
                     pa.array([x.tobytes() for x in sig.astype(">u4")], pa.binary())], names=["doc_id", "set1", "set2", "n_shingles", "sig"])

    sketched = materialize(rows.mapInArrow(sketch, f"doc_id {kind}, set1 long, set2 long, n_shingles long, sig binary"), "forest-sketch")
    sets = materialize(sketched.where("n_shingles > 0").groupBy("set1", "set2").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"), F.max("n_shingles").alias("n_shingles"), F.max("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()), "forest-sets")

    candidates = _candidates(sets, trees, longest, prefix_lengths(trees, longest, threshold, target))
    linked = _verified(rows, sets, candidates, threshold)
    roots = connected_components(linked.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("cid").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    named = (sets.select("cid", "set1", "set2", "copies", "least").join(roots.withColumnRenamed("id", "cid"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    named = materialize(named, "forest-named")
    names = named.groupBy("root").agg(F.min("least").alias("class_id"))
    classes = (named.join(names, "root").join(counts, "cid", "left")
               .select("set1", "set2", "class_id", (F.col("copies") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"),
                       F.coalesce("texts", F.lit(0)).cast("long").alias("n_similar_texts")))
    classes = materialize(classes, "forest-classes")
    out = sketched.where("n_shingles > 0").select("doc_id", "set1", "set2", "n_shingles").join(classes, ["set1", "set2"])
    alone = sketched.where("n_shingles = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                                    F.lit(0).cast("long").alias("n_similar_texts"), "n_shingles")
    return out.select(*alone.columns).unionByName(alone)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose doc_id is the smallest of its class.

    Rows that share a doc_id are decided together; rows with a null doc_id stay."""
    classes = jaccard_classes(docs, **options)
    gone = materialize(classes.where("class_id <> doc_id").select("doc_id").distinct(), "forest-gone")
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def set_digests(held: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's shingle set: sums of two mixes of its members."""
    out = []
    with np.errstate(over="ignore"):
        for salt in (0x51ED2701F35C9C1D, 0xA24BAED4963EE407):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(held ^ np.uint64(salt)), dtype=np.uint64)])
            out.append(mix64(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)))
    return out[0], out[1]


def _candidates(sets: DataFrame, trees: int, longest: int, lengths: list[int]) -> DataFrame:
    """(id, root): the candidate components of two sets or more, by shortening prefixes; ``root`` is the smallest id."""
    labels = sets.sparkSession.createDataFrame([], "id long, root long")
    for length in lengths:
        joined = connected_components(_meetings(sets, labels, trees, longest, length))
        # Components that met become one; a set that met for the first time gets a label.
        known = labels.unionByName(joined.select("id", F.col("id").alias("root")).join(labels, "id", "left_anti"))
        joined = joined.select(F.col("id").alias("old"), F.col("root").alias("new"))
        labels = materialize(known.join(joined, F.col("root") == F.col("old"), "left").select("id", F.coalesce("new", "root").alias("root")), "forest-labels")
    return labels


def _meetings(sets: DataFrame, labels: DataFrame, trees: int, longest: int, length: int) -> DataFrame:
    """(a, b): edges that span the components of which two sets share a trie node at this prefix length and agree in
    enough hashes: about one a set and node, and to the same smallest id from many nodes, however many pairs agree."""
    prefixes = F.array(*[F.struct(F.lit(t).alias("tree"), F.xxhash64(F.expr(f"substring(sig, {4 * longest * t + 1}, {4 * length})")).alias("prefix"))
                         for t in range(trees)])
    placed = (sets.select("cid", F.explode(prefixes).alias("p")).select("cid", "p.tree", "p.prefix")
              .join(labels, F.col("cid") == F.col("id"), "left").select("cid", "tree", "prefix", F.coalesce("root", "cid").alias("root")))
    nodes = materialize(placed.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
                        .where("low <> high").drop("low", "high"), "forest-nodes")
    members = materialize(placed.join(nodes, ["tree", "prefix"]), "forest-members")
    dealt = _block_pairs(members, "n", BLOCK, "cid").join(sets.select("cid", "sig"), "cid")
    key = ["tree", "prefix", "bi", "bj"]
    least = int(np.ceil(LEAST_AGREE * trees * longest))

    def meet(batches):
        for table in groups_of(batches, key):
            first = starts_of(table, key)
            part, side = table.column("root").to_numpy(), table.column("side").to_numpy()
            within = table.column("bi").to_numpy() == table.column("bj").to_numpy()
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), ">u4").reshape(len(part), -1).astype(np.uint32)
            sizes, a, b = np.diff(first), [], []
            for m in np.unique(sizes[(sizes > 1) & (sizes <= 32)]):  # small groups of one size at once
                at = first[:-1][sizes == m]
                i, j = np.triu_indices(m, 1)
                for some in np.array_split(at, max(1, len(at) * len(i) // 50_000)):
                    left, right = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
                    near = part[left] == part[right]
                    apart = np.flatnonzero(~near)
                    near[apart] = (sig[left[apart]] == sig[right[apart]]).sum(1) >= least
                    near = near.reshape(len(some), -1)
                    own = part[some[:, None] + np.arange(m)]
                    joined = np.zeros((len(some), m, m), bool)
                    joined[:, i, j] = joined[:, j, i] = near
                    joined[:, np.arange(m), np.arange(m)] = True
                    low, was = own, None
                    while was is None or (low != was).any():
                        low, was = np.where(joined, low[:, None, :], np.iinfo(np.int64).max).min(2), low
                    a.append(low.ravel())
                    b.append(own.ravel())
            for at, m in zip(first[:-1][sizes > 32], sizes[sizes > 32]):
                rows = slice(at, at + m)
                low, own = spanning(part[rows], side[rows], sig[rows], least, within[at])
                a.append(low)
                b.append(own)
            if a:
                x, y = np.concatenate(a), np.concatenate(b)
                pairs = np.unique(np.stack([x, y], 1)[x != y], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return (dealt.select(*key, "side", "root", "sig").repartition(*key).sortWithinPartitions(*key).mapInArrow(meet, "a long, b long").distinct())


def _verified(rows: DataFrame, sets: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """(cid, root, texts, documents): of each candidate row and block pair, the linked rows' count and one edge to their smallest cid."""
    sizes = candidates.groupBy("root").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("root", "component")
    wanted = candidates.select(F.col("id").alias("cid"), F.col("root").alias("component")).join(sizes, "component")
    wanted = materialize(wanted.join(sets.select("cid", "set1", "set2", "copies", "least"), "cid"), "forest-wanted")
    text = rows.join(wanted.select(F.col("least").alias("doc_id")).distinct(), "doc_id", "left_semi")
    lost = rows.where("doc_id is null")  # sets that only rows without an id have

    def cut(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, j in row_slices(offsets, SLICE):
                held, first = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                s1, s2 = set_digests(held, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                     pa.array([held[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())], names=["set1", "set2", "held"])

    held = text.unionByName(lost).select("text").mapInArrow(cut, "set1 long, set2 long, held binary").dropDuplicates(["set1", "set2"])
    ready = materialize(wanted.join(held, ["set1", "set2"]).select("component", "n", "cid", "copies", "held"), "forest-held")
    key = ["component", "bi", "bj"]

    def verify(batches):
        for table in groups_of(batches, key):
            first = starts_of(table, key)
            cid, copies, side = (table.column(c).to_numpy() for c in ("cid", "copies", "side"))
            within = table.column("bi").to_numpy() == table.column("bj").to_numpy()
            data = table.column("held").to_pylist()
            roots, texts, documents = cid.copy(), np.zeros(len(cid), np.int64), np.zeros(len(cid), np.int64)
            for a, b in zip(first[:-1], first[1:]):
                if b - a < 2:
                    continue
                link = linked_pairs([np.frombuffer(x, np.uint64) for x in data[a:b]], threshold)
                if not within[a]:
                    link &= side[a:b, None] != side[None, a:b]
                texts[a:b] = link.sum(1)
                documents[a:b] = link @ copies[a:b]
                roots[a:b] = smallest_reached(link, cid[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(roots), pa.array(texts), pa.array(documents)],
                                             names=["cid", "root", "texts", "documents"])

    dealt = _block_pairs(ready, "n", VERIFY_BLOCK, "cid").repartition(*key).sortWithinPartitions(*key)
    return materialize(dealt.select(*key, "side", "cid", "copies", "held").mapInArrow(verify, "cid long, root long, texts long, documents long"),
                       "forest-linked")


def linked_pairs(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of these sets have a Jaccard similarity of at least ``threshold`` (False on the diagonal)."""
    n = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), n)
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # A member of all sets adds one to every pair, a member of one set adds nothing.
    everywhere = int((count == len(sets)).sum())
    shared = (count > 1) & (count < len(sets))
    number = np.cumsum(shared) - 1
    take = shared[place]
    row, column = row[take], number[place[take]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.full((len(sets), len(sets)), float(everywhere), np.float32)
    for low in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, int(shared.sum()) - low)), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        both += part @ part.T
    both = both.astype(np.float64)
    union = n[:, None] + n[None, :] - both
    link = both >= threshold * union - 1e-9
    np.fill_diagonal(link, False)
    return link


def smallest_reached(link: np.ndarray, cid: np.ndarray) -> np.ndarray:
    """For each row the smallest cid that its links reach."""
    root, left = cid.copy(), np.ones(len(cid), bool)
    for start in np.argsort(cid):
        if left[start]:
            left[start] = False
            found = np.array([start])
            while len(found):
                root[found] = cid[start]
                found = np.flatnonzero(link[found].any(0) & left)
                left[found] = False
    return root
