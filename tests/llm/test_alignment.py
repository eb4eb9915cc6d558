import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from edge import EDGE, edge_docs, empty_docs, table
from tokenizers import Tokenizer

from seriesflow.llm import alignment
from seriesflow.llm.alignment import token_alignment

PATHS = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = [(41, " lead  two\tthree \n"), (42, "<|endoftext|> <s> </s> <unk> <0x41> <|startoftext|>"), (43, "a ▁ b"), (44, "▁"), (45, "x  y \n z　 w"),
       (46, "tab\t\ttab \r\n;\r\n  }\r end"), (47, "日本語 テキスト 😀😀 ½ ﬁ Å Å"), (48, "x" * 5000), (49, "   "), (50, "a\x00b \x1c c\x1f!"), (51, "\n"), (52, "don't we'll 1234567 !!??  ..."),
       (53, " "), (54, "x "), (55, "ab ab ab ab"), (56, "ab ab ab ab"), (57, "end\n\n\n   \n"), (58, "﻿bom ​zeró ")]


def brute(rows):
    a_tok = Tokenizer.from_file(PATHS[0])
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in visible)}
    docs, links = [], []
    for _, text in rows:
        full = (" " + (text or "")).encode()
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in a_tok.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_tok.id_to_piece(i)]]
        if not text or b"".join(raw_a) != full or b"".join(raw_b) != full:
            docs.append(None)
            links.append([])
            continue
        spans = []
        for raw in (raw_a, raw_b):
            at, out = 0, []
            for x in raw:
                out.append((at, at + len(x)))
                at += len(x)
            spans.append(out)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, span) if low <= s and e <= cut) for ids, span in ((a, spans[0]), (b, spans[1])))
                          if len(full) < 3000 else None)
            low = cut
        found, j = [], 0
        for i, (s, e) in zip(a, spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                found.append((i, b[k]))
                k += 1
        links.append(found)
        docs.append((len(a), len(b), len(cuts), len(found), hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None))
    counts = Counter(x for found in links for x in found)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), d, found in zip(rows, docs, links):
        n_best, total = sum(counts[x] == most[x[1]] for x in found), sum(counts[x] for x in found)
        out.append((i, *(d[:4] if d else (0, 0, 0, 0)), n_best, total, d[4] if d else ""))
    return out


def check(docs, rows, **options):
    got = sorted((tuple(r) for r in token_alignment(docs, *PATHS, **options).collect()), key=repr)
    want = sorted(brute(rows), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7]), (g, w)


def test_equals_brute_force(spark):
    rows = [r[:2] for r in EDGE] + ODD
    check(edge_docs(spark).select("doc_id", "text").union(spark.createDataFrame(ODD, "doc_id long, text string")), rows)
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), [r[:2] for r in table()])


def test_counts_in_slices_and_texts_in_parts(spark, monkeypatch):
    for name, value in (("BLOCK", 60), ("PART", 3), ("CACHED", 20), ("LONG", 4), ("HELD", 10)):
        monkeypatch.setattr(alignment, name, value)
    rows = [r[:2] for r in EDGE if len(r[1] or "") < 5000] + ODD + [(60, "ab " * 300), (61, "good words and then ▁ bad ones " * 20)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, slice_pairs=25)


def test_ranks_encode_as_the_tokenizer_file(monkeypatch):
    texts = [" ".join(t for _, t in ODD), *(r[1] for r in table()[:60])]
    fast = alignment.Tokenizers(*PATHS)
    assert fast.ranked
    monkeypatch.setattr(alignment, "_ranked", lambda path: None)
    slow = alignment.Tokenizers(*PATHS)
    assert slow.ranked is None
    for x, y in zip(alignment.align_texts(fast, texts), alignment.align_texts(slow, texts)):
        assert x.tolist() == y.tolist() if hasattr(x, "tolist") else x == y


def test_other_columns_and_empty_table(spark):
    out = token_alignment(edge_docs(spark), *PATHS)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] and out.count() == len(EDGE)
    assert token_alignment(empty_docs(spark), *PATHS).count() == 0


def test_megabytes_in_one_text(spark):
    word = "alignment of words; "
    one, many = token_alignment(spark.createDataFrame([(1, word)], "doc_id long, text string"), *PATHS).first(), \
        token_alignment(spark.createDataFrame([(1, word * 150_000)], "doc_id long, text string"), *PATHS).first()
    assert one.n_groups > 2 and many.n_a > 150_000 * 4 and many.n_links == many.n_a + many.n_b - many.n_groups and many.n_best <= many.n_links
