import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from edge import EDGE, edge_docs, empty_docs, lower, table
from tokenizers import Tokenizer

from seriesflow.llm.license_scan import BAND, BASE, K, LEAST_COVER, NOTICES, chains, scan
from seriesflow.llm.packing import harmonic_pieces, pack

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def base_places(text):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i:i + len(p := phrase.split())] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_phrases_equal_brute_force(spark):
    for docs, rows in ((spark.read.parquet(f"{SF}/documents.parquet"), [r[:2] for r in table()]), (edge_docs(spark), [r[:2] for r in EDGE])):
        got = scan(docs)[0].collect()
        want = Counter((i, *base_places(t)) for i, t in rows)
        assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
        assert all(r.labels == ",".join(sorted(set(r.labels.split(",")))) for r in got)
    assert scan(empty_docs(spark))[0].count() == 0


def test_notices_with_changed_words(spark):
    text = ("intro words here. Redistribution and use in source and binary forms, with or WITHOUT any modification, are hereby permitted"
            " provided that following conditions are met: more")
    rows = [(1, text), (2, "redistribution and use of the land"), (3, "MIT License MIT LicenseX mit...license Émit license"),
            (4, "Apache\n\tLicense apache licenses cc by-nc CC BÝ gnu general public license gnu general public license")]
    out, spans = scan(spark.createDataFrame(rows, "doc_id long, text string"))
    out = {r.doc_id: r for r in out.collect()}
    assert out[1].labels == "bsd-notice" and out[1].n_base == 0 and 0.6 <= out[1].score < 1
    assert out[2].labels == "" and out[2].score == 0
    for i, t in rows[2:]:
        assert (out[i].n_words, out[i].n_base, out[i].first_word, out[i].last_word, out[i].base_labels) == base_places(t)
    span = spans.where("doc_id = 1").first()
    assert span["first"] == 3 and 20 <= span["last"] <= 24


def test_notices_with_any_one_word_edit(spark):
    """Every insertion, deletion and change of one word of every notice, between other texts with its repeated words."""
    rows, want = [], {}
    for label, text in NOTICES:
        words, grams = text.split(), len(text.split()) - 1
        edits = [(words, grams)]
        for k in range(len(words)):
            hit = grams - (1 if k in (0, grams) else 2)  # k-grams of two words that a change or a deletion breaks
            edits += [([*words[:k], "zebra", *words[k + 1:]], hit), ([*words[:k], *words[k + 1:]], hit),
                      ([*words[:k], "zebra", *words[k:]], grams - (k > 0))]
        for edit, hit in edits:
            i = len(rows)
            rows.append((i, "some of the first words " + " ".join(edit) + " and the end of the free software text"))
            want[i] = (label, hit / grams, 5, 5 + len(edit) - 1)
    out, spans = scan(spark.createDataFrame(rows, "doc_id long, text string"))
    out, places = {r.doc_id: r for r in out.collect()}, defaultdict(list)
    for r in spans.where("not base").collect():
        places[r.doc_id, r.label].append(r)
    for i, (label, cover, first, last) in want.items():
        if cover >= 0.6:
            assert label in out[i].labels.split(",") and out[i].score >= cover, rows[i]
            span, = places[i, label]
            assert span.cover >= cover and first <= span["first"] <= first + 3 and last - 3 <= span["last"] <= last, (rows[i], span)


def test_chains_drop_strays():
    whole = [(10 + q, q) for q in range(8)]
    assert chains(whole, 8) == [(10, 18, 1.0)]
    assert chains(whole + [(4, 3), (12, 5), (25, 0), (30, 7)], 8) == [(10, 18, 1.0)]
    assert sorted(chains([(a + q, q) for a in (0, 3) for q in (0, 1)], 2)) == [(0, 2, 1.0), (3, 5, 1.0)]
    assert chains([(40 * (8 - q), q) for q in range(8)], 8) == [] and chains([], 8) == []


def chains_by_searching_again(hits, grams):
    """The definition: take the best chain, then search the text before and after it from the start."""
    spans, parts = [], [sorted(set(hits))]
    while parts:
        part, best = parts.pop(), []
        for k, (at, place) in enumerate(part):
            n, first = 0, at
            for j, (x, q) in enumerate(part[:k]):
                if at - x <= grams + BAND and x < at and q < place and abs((at - place) - (x - q)) <= BAND and best[j] > (n, first if n else -1):
                    n, first = best[j]
            best.append((n + 1, first))
        if part:
            k = max(range(len(part)), key=lambda i: (*best[i], -part[i][0]))
            n, first = best[k]
            if n >= LEAST_COVER * grams:
                last = part[k][0] + K - 1
                spans.append((first, last, n / grams))
                parts += [[h for h in part if h[0] + K - 1 < first], [h for h in part if h[0] > last]]
    return spans


def test_chains_equal_their_definition():
    rng = np.random.default_rng(8)
    found = 0
    for trial in range(400):
        grams = int(rng.integers(1, 9))
        hits = [(int(a), int(q)) for a, q in zip(rng.integers(0, 60, 70), rng.integers(0, grams, 70))]
        for start in rng.integers(0, 60, 4):
            hits += [(int(start) + q + int(rng.integers(0, 2)), q) for q in range(grams) if rng.random() < 0.8]
        got = sorted(chains(hits, grams))
        assert got == sorted(chains_by_searching_again(hits, grams)), trial
        found += len(got)
    assert found > 400


def test_a_notice_a_hundred_thousand_times_in_one_text(spark):
    began = time.time()
    n = 100_000
    rows = [(1, "all rights reserved " * n), (2, "of the " * n), (3, "free software foundation either of the " * (n // 5)), (4, "word" * 500_000)]
    out, spans = scan(spark.createDataFrame(rows, "doc_id long, text string"))
    out = {r.doc_id: r for r in out.collect()}
    assert out[1].labels == "all-rights-reserved" and out[1].n_words == 3 * n and out[2].n_words == 2 * n and out[4].n_words == 1
    assert spans.where("doc_id = 1").count() == n and out[2].labels == out[4].labels == ""
    assert time.time() - began < 120


def test_harmonic_pieces():
    for n in [*range(0, 9000, 7), 4096, 2048, 1365, 1366]:
        pieces = harmonic_pieces(n)
        assert sum(pieces) == n and all(0 < p <= 4096 for p in pieces)


def check_packing(out, rows):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        copies = len(texts[i])
        ids = texts[i][0]
        assert sum(p.length for p in pieces) == copies * len(ids)
        for p in pieces:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
        starts = sorted((p.start, p.length) for p in pieces)[::copies]
        assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1]]
    for pieces in by_bin.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    return sum(p.length for p in out) / (4096 * len(by_bin))


def test_packing_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fill = check_packing(pack(docs, VOCABULARY).collect(), [r[:2] for r in table(sf="/root/testdata/sf0.01")])
    assert fill > 0.95
    check_packing(pack(edge_docs(spark), VOCABULARY).collect(), [r[:2] for r in EDGE])
    odd = [(1, "a b ́c <|endoftext|> it's 'S x<|startoftext|>y   Ǆ ﬁ 日本語 \x00 \x85z"), (2, "İSTANBUL ΣΑΣ")]
    check_packing(pack(spark.createDataFrame(odd, "doc_id long, text string"), VOCABULARY).collect(), odd)
    assert pack(empty_docs(spark), VOCABULARY).count() == 0
