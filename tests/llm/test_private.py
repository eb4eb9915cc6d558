import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
from edge import EDGE, edge_docs, empty_docs, table
from pyspark.sql import functions as F

from seriesflow.llm.private_data import Slice, bootstrap, find_private

GRAMMAR = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
           ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
ODD = ["a@b.c a@b@c.d x@y z@-.- é.q@w.e-r.t. @a.b a@b.c@d.e %+_@0.0", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.01 1..2.3.4 1.2.3 9.9.9.9999 300.1.1.1.1.1.1.1",
       "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 41111111111111110 5 4111111111111111é", "378282246310005 30569309025904 6011111111111117-",
       "+1 (523) 555-7040. +49 30 123456 +12345678901234567 ++1 234 567 8901 +1() 2 +1234567890 +1 2", "+1 234\n567 8901 +1.234.567.8901) +1 234 567 8901 ( +12 345 678 90",
       "é@ü.com 日本+81 3-1234-5678日本 0.0.0.0", "1" * 4000, "a" * 4000, "1." * 2000, "@" * 3000, "+1" * 2000, "a@" * 2000, "a.b@c." * 1500, "\x00a@b.c\x00 1.1.1.1\x00",
       "mail@host.org," * 400, "4111111111111111 " * 300]


def base(text):
    text, found = text or "", []
    for k, (kind, pattern) in enumerate(GRAMMAR):
        for m in re.finditer(pattern, text):
            got = m.group()
            digits = re.sub("[^0-9]", "", got)
            if kind == "ip" and any(int(x) > 255 for x in got.split(".")):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                d = [int(x) for x in digits[::-1]]
                if not 14 <= len(d) <= 19 or (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10:
                    continue
            found.append((m.start(), k, m.end()))
    found.sort()
    joined = ",".join(f"{GRAMMAR[k][0]}:{s}:{e}" for s, k, e in found)
    return (*(sum(x[1] == k for x in found) for k in range(4)), hashlib.sha256(joined.encode()).hexdigest()), set(filter(None, joined.split(",")))


def check(docs, rows):
    got = find_private(docs).collect()
    want = [(i, *base(t)[0]) for i, t in rows]
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == Counter(want)
    spans = {i: base(t)[1] for i, t in rows}
    for r in got:
        all_ = list(filter(None, r.spans.split(",")))
        assert spans[r.doc_id] <= set(all_) and len(all_) == len(spans[r.doc_id]) + r.n_added
        assert [int(x.split(":")[1]) for x in all_] == sorted(int(x.split(":")[1]) for x in all_)


def test_base_equals_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), [r[:2] for r in table()])
    rows = [r[:2] for r in EDGE] + [(100 + k, t) for k, t in enumerate(ODD)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_other_columns_and_empty_table(spark):
    assert find_private(edge_docs(spark)).count() == len(EDGE) and find_private(empty_docs(spark)).count() == 0


def test_long_texts_take_linear_time(spark):
    """Megabytes that a plain search would go through again from every place."""
    rows = [(k, x * (2_000_000 // len(x))) for k, x in enumerate(("1", "a", "1.", "1 ", "a@", "+1", "+1 ", "a.b@", "1-1.", "@"))]
    assert find_private(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)


def planted():
    """Letters with phones after 'reach me at', of which some are written as no grammar knows them, and numbers elsewhere."""
    rows = []
    for k in range(12):
        rows.append((k, f"Dear reader {'abcdefghijkl'[k] * 3}. Please reach me at +1 (20{k % 10}) 555-{1000 + 37 * k} before noon. Bye."))
    rows += [(20, "For help reach me at 555 0188 421 before noon."), (21, "Or reach me at (0)30-5554433 before night"),
             (22, "The order 555 0199 777 was late."), (23, "Again: order 1 (200) 555-1000 came."), (24, "reach me at dawn before noon")]
    return rows


def test_contexts_find_unseen_identifiers(spark):
    rows = planted()
    got = {r.doc_id: r for r in find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    span = lambda i, part: f"phone:{text[i].index(part)}:{text[i].index(part) + len(part)}"
    assert got[20].spans == span(20, "555 0188 421") and got[20].n_added == 1 and got[20].n_phone == 0
    assert got[21].spans == span(21, "0)30-5554433")
    assert got[22].spans == "" and got[24].spans == ""  # no pattern leads there
    assert got[23].spans == span(23, "1 (200) 555-1000")  # a seed's digits
    assert all(got[k].n_phone == 1 and got[k].n_added == 0 for k in range(12))


def twin(edges, plain, support, confidence, accept, doubt=0.5):
    """``bootstrap`` in plain Python."""
    graph, number, known = defaultdict(int), {}, {}
    for ctx, shape, value, num, kind, n in edges:
        graph[ctx, shape, value] += n
        number[value] = num
        if kind:
            known[value] = (min(kind, known.get(value, (9,))[0]), 1.0)
    while True:
        by = defaultdict(list)
        for (ctx, shape, value), n in graph.items():
            by[ctx].append((value, n))
        trust = {}
        for ctx, held in by.items():
            total = plain.get(ctx, 0) + sum(n if v in known else doubt * n for v, n in held)
            for k in range(1, 5):
                mine = [(n, known[v][1]) for v, n in held if v in known and known[v][0] == k]
                t = sum(n * s for n, s in mine) / total
                if len(mine) >= support and t >= confidence:
                    trust[ctx, k] = t
        best = {}
        votes = defaultdict(float)
        for (ctx, shape, value), n in graph.items():
            for k in range(1, 5):
                if value not in known and (ctx, k) in trust and (number[value] == 1) == (k > 1):
                    votes[value, k, shape] += math.log(1 - min(trust[ctx, k], 0.999))
        for (value, k, _), x in votes.items():
            score = 1 - math.exp(x)
            best[value] = max(best.get(value, (0, 0)), (score, -k))
        new = {v: (-k, s) for v, (s, k) in best.items() if s >= accept}
        if not new:
            return known
        known.update(new)


def test_bootstrap_equals_its_twin(spark):
    rng = np.random.default_rng(5)
    rounds = 0
    for trial in range(3):
        edges = {}
        kinds = {v: int(rng.choice([0, 0, 0, 2, 4])) for v in range(60)}
        for v, kind in kinds.items():
            for _ in range(rng.integers(1, 5)):
                ctx = int(rng.integers(0, 6)) + (6 if kind == 4 or v % 3 == 0 else 0) + (12 if v % 7 == 0 else 0)
                key = (ctx, ctx % 3, v, 1, kind)
                edges[key] = edges.get(key, 0) + int(rng.integers(1, 4))
        edges = [(*k, n) for k, n in edges.items()]
        plain = {c: int(rng.integers(0, 4)) for c in range(0, 20, 2)}
        df = spark.createDataFrame(edges, "ctx long, shape int, value long, number int, kind int, n long")
        got = bootstrap(df, spark.createDataFrame(list(plain.items()), "ctx long, plain long"), 2, 0.3, 0.5).collect()
        want = twin(edges, plain, 2, 0.3, 0.5)
        assert {r.value: r.kind for r in got} == {v: k for v, (k, _) in want.items()}
        assert all(abs(r.score - want[r.value][1]) < 1e-9 for r in got)
        rounds += len(want) > len({v for v, k in kinds.items() if k})
    assert rounds  # something was found


def test_places_of_words_and_identifiers():
    texts = ["one two +1 200 555 1000 three", "", "alone", "a@b.c last"]
    raw = [t.encode() for t in texts]
    s = Slice(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert s.row.tolist() == [0, 3] and s.kind.tolist() == [4, 1]
    left = s.identifier_contexts()
    same = Slice(np.frombuffer(b"one TWO 555 0000 111 Three", np.uint8), np.array([0, 26]))
    assert (same.identifier_contexts()[:, 0] == left[:, 0]).all() and same.kind.tolist() == [0]
    assert len(s.word_contexts()) == 3 * 5


def test_one_value_in_a_third_of_all_rows(spark):
    rows = [(k, f"call +1 200 555 1000 now x{k}" if k % 3 == 0 else f"word number {k} and 12{k:05d} more") for k in range(3000)]
    out = find_private(spark.createDataFrame(rows, "doc_id long, text string")).agg(F.sum("n_phone"), F.count("*")).first()
    assert tuple(out) == (1000, 3000)
