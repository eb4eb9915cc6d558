import hashlib
import re

import numpy as np
from edge import EDGE, edge_docs, empty_docs, table
from pyspark.sql import functions as F

from seriesflow.llm.fill_middle import SkipLists, fill_in_middle, restored

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [(21, " lead  two\tthree \n"), (22, "<P> stays"), (23, "a<S>b"), (24, "<M>"), (25, "𝒳 𝒴é  x y <"), (26, "<"), (27, "< P> <P <S M>"),
       (28, "\x0b\x0c"), (29, "x" * 70_000), (30, "é " * 50_000), (31, " \n" * 40_000), (32, "naïve <|P|> text \x00 nul")]


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(docs, rows):
    got = sorted(map(repr, ((r.doc_id, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.back) for r in
                            fill_in_middle(docs).withColumn("back", restored()).collect())))
    assert got == sorted(map(repr, ((i, brute(i, t), t or "") for i, t in rows)))


def test_equals_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), [r[:2] for r in table()])
    check(edge_docs(spark), [r[:2] for r in EDGE])
    check(empty_docs(spark), [])


def test_odd_texts_under_many_ids(spark):
    rows = [(1000 * k + i, t) for i, t in ODD for k in range(12)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    forms = {r.form for r in fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert forms == {"plain", "psm", "spm"}


def test_megabytes_in_one_text(spark):
    rows = [(k, ("wörd " * 400_000) + "end ") for k in range(6)]
    out = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("back", restored())
    got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.out, r.back) for r in
           out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("out"), F.sha2("back", 256).alias("back")).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {i: (*(b := brute(i, t))[:4], sha(b[4]), sha(t)) for i, t in rows}


def test_descent_reaches_every_rank():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 2, 17, 300, 0, 5000]
    widths = [rng.integers(1, 9, n) for n in sizes]
    first = np.concatenate([[0], np.cumsum(sizes)])
    lists = SkipLists(np.concatenate(widths), first)
    assert len(lists.lanes) > 4
    for k, w in enumerate(widths):
        ranks = np.arange(len(w) + 1)
        assert lists.chars_before(np.full(len(ranks), k), ranks).tolist() == np.concatenate([[0], np.cumsum(w)]).tolist()
    # Links of a lane add up those below them.
    for (low_units, low_chars, _), (units, chars, down) in zip(lists.lanes, lists.lanes[1:]):
        assert len(units) < len(low_units)
        for i in np.flatnonzero(units):
            assert units[i] == low_units[down[i]:down[i + 1]].sum() and chars[i] == low_chars[down[i]:down[i + 1]].sum()
