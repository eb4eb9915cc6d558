import hashlib
import math
import re
from collections import Counter

import pytest
import regex
from edge import EDGE, edge_docs, empty_docs, lower, table
from pyspark.sql import functions as F

from seriesflow.llm.line_rules import clean_lines
from seriesflow.llm.radix_dedup import keep_first, radix_dedup
from seriesflow.llm.raking import KEEP, TOPICS, mix, rake, topic_of
from seriesflow.llm.sharding import balanced_shards, cut_edges


def spark_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_radix_dedup_equals_brute_force(spark):
    for docs, rows in ((spark_docs(spark), [(r[0], r[1]) for r in table()]), (edge_docs(spark), [r[:2] for r in EDGE])):
        groups = {}
        for i, t in rows:
            groups.setdefault(lower(t), []).append(i)
        want = Counter()
        for t, ids in groups.items():
            keep = max((i for i in ids if i is not None), default=None)
            left = ids.count(keep) if keep in ids else 0
            for i in ids:
                kept = i == keep and left == ids.count(keep)
                left -= i == keep
                want[(i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest())] += 1
        for width in (64, 3):
            got = radix_dedup(docs, first_digit=width, growth=4)
            cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
            assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == want


def test_radix_dedup_keeps_whole_rows(spark):
    docs = edge_docs(spark)
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({lower(r[1]) for r in EDGE})
    assert radix_dedup(empty_docs(spark)).count() == 0


def base_rules(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_line_rules_base_equals_brute_force(spark):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for docs, rows in ((spark_docs(spark), [(r[0], r[1]) for r in table()]), (edge_docs(spark), [r[:2] for r in EDGE])):
        got = clean_lines(docs).collect()
        assert Counter((r.doc_id, *(r[c] for c in cols)) for r in got) == Counter((i, *base_rules(t)) for i, t in rows)
        assert not any(r.kept and r.base_failed for r in got)
    assert clean_lines(empty_docs(spark)).count() == 0


def line_verdict(text):
    """cleaned, share_left and kept in plain Python, from the rules' definitions."""
    def why(line):
        words = [w for w in re.split("[ \t-\r]+", line) if w]
        symbols = sum(c in "#*$%&<>{}" for c in line) + sum(len(m) for m in re.findall("!{2,}", line))
        letters, capitals = len(regex.findall(r"\p{L}", line)), len(regex.findall(r"\p{Lu}", line))
        separators = sum(c in "|>»·•" for c in line)
        furniture = ["cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "javascript", "lorem ipsum", "login to", "log in to",
                     "sign up", "subscribe to", "subscribe now", "skip to content", "skip to main content", "powered by", "copyright ©", "copyright (c)"]
        return (symbols / max(len(line), 1) > 0.06 or len(words) >= 5 and capitals / max(letters, 1) > 0.6 or separators >= 2 and separators / len(words) > 0.2
                or any(f in lower(line) for f in furniture) or len(words) >= 10 and len(set(words)) / len(words) < 0.3)

    lines = list(dict.fromkeys(x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)))
    cleaned = "\n".join(x for x in lines if not why(x))
    size = lambda t: len(re.sub("[ \t-\r]+", "", t))
    share = size(cleaned) / max(size(text or ""), 1)
    return cleaned, round(share, 12), not base_rules(text)[-1] and share >= 0.5


def test_line_verdicts_equal_brute_force(spark):
    odd = ["Log In To your account\nlogin  to\nPlain words of a longer line stay here.", "!! one ! two !!! three words and more of them for the line to stay",
           "A | B | C | D\na > b is fine in a line with many more words than this one", "ÀÉÎ ÕÜ ÇA VA BIEN\nàéî õü ça va bien", "{} {} {}\n" * 3, "x\r\nx\r\n\x0b\ny",
           "one two one two one two one two one two one two\nCopyright (C) 2020", "Copyright © 2020 by some people who wrote some words here", "𝒳𝒴 𝒳𝒴 a b c d e f g h"]
    for docs, rows in ((spark_docs(spark), [(r[0], r[1]) for r in table()]), (edge_docs(spark), [r[:2] for r in EDGE]),
                       (spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), list(enumerate(odd)))):
        got = Counter((r.doc_id, r.cleaned, round(r.share_left, 12), r.kept) for r in clean_lines(docs).collect())
        assert got == Counter((i, *line_verdict(t)) for i, t in rows)


def test_line_rules_remove_lines_and_reject(spark):
    good = "The first of these lines is a plain sentence.\nAnd here is another one that stays."
    rows = [(1, good + "\nHome | About | Contact | Help\nWe use cookies, see our policy."),
            (2, "Home | About | Contact | Help | More\nBUY NOW BUY NOW THIS IS IT!!! !!!\n" + "x " * 4),
            (3, "One&&& two*** three%%% four### five&&& six*** seven%%% eight### nine&&& ten***")]
    out = {r.doc_id: r for r in clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].cleaned == good and out[1].kept
    assert not out[2].kept and not out[3].kept and out[3].cleaned == ""


def test_line_rules_agree_with_labels(spark):
    label = {r[0]: r[1] for r in table("labels", "/root/testdata/sf0.01")}
    out = clean_lines(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    good = [r.kept for r in out if label.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in out if label.get(r.doc_id) == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def check_shards(out, shards):
    sizes = Counter(r.shard for r in out)
    n = len(out)
    assert all(0 <= r.shard < shards for r in out)
    assert max(sizes.values(), default=0) - min((sizes[s] for s in range(shards)), default=0) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    return n


def test_shards_even_and_linked(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = balanced_shards(docs).cache()
    assert check_shards(out.collect(), 16) == 1000
    edges = cut_edges(out).first()
    assert edges.edges > 0 and edges.cut <= 0.1 * edges.edges
    got = balanced_shards(edge_docs(spark), shards=4)
    assert check_shards(got.collect(), 4) == len(EDGE)
    want = Counter((i, len((t or "").encode()) + 1) for i, t, *_ in EDGE)
    assert Counter((r.doc_id, r["size"]) for r in got.collect()) == want
    assert balanced_shards(empty_docs(spark)).count() == 0


def test_one_group_larger_than_a_shard(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "if(id < 1500, 'copy', concat('text ', if(id < 2500, id div 2, id))) text")
    out = balanced_shards(docs).cache()
    assert check_shards(out.collect(), 16) == 4000
    hot = Counter(r.shard for r in out.where("text_crc32 = crc32('copy')").collect())
    assert len(hot) <= 10  # eight would hold it beside the pairs
    pairs = out.where("text_crc32 <> crc32('copy')").groupBy("link").count().count()
    cut = cut_edges(out.where("text_crc32 <> crc32('copy')")).first()
    assert pairs == 2000 and cut.edges == 500 and cut.cut <= 0.2 * cut.edges


def test_raking_meets_targets(spark):
    cells = spark.createDataFrame([(s, x, t, float(1 + 7 * i + 3 * j * j + k)) for i, s in enumerate("abc")
                                   for j, x in enumerate("uvw") for k, t in enumerate("pq")],
                                  "source string, lang string, topic string, tokens double")
    share = {"source": {"a": .2, "b": .3, "c": .5}, "lang": {"u": .6, "v": .3, "w": .1}, "topic": {"p": .25, "q": .75}}
    targets = spark.createDataFrame([(m, v, x) for m, d in share.items() for v, x in d.items()],
                                    "margin string, value string, share double")
    out = rake(cells, targets, sweeps=30).collect()
    for m, d in share.items():
        for v, x in d.items():
            assert abs(sum(r.weight for r in out if r[m] == v) - x) < 1e-5
    # brute force: the same fitting in plain Python
    w = {(r.source, r.lang, r.topic): r.tokens for r in out}
    for _ in range(60):
        for at, m in enumerate(share):
            for v, x in share[m].items():
                now = sum(y for k, y in w.items() if k[at] == v)
                w |= {k: y * x / now for k, y in w.items() if k[at] == v}
    assert all(abs(w[(r.source, r.lang, r.topic)] - r.weight) < 1e-5 for r in out)


def test_mix_samples_by_probability(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = mix(docs).collect()
    assert len(out) == 1000 and all(0 <= r.probability <= 1 + 1e-12 for r in out)
    expected = sum(r.probability for r in out)
    assert abs(sum(r.sampled for r in out) - expected) < 4 * expected ** 0.5
    cells = {}
    for r in out:
        if r.n_tokens:
            cells.setdefault((r.source, r.lang, r.topic), set()).add(round(r.probability, 12))
    assert all(len(v) == 1 for v in cells.values()) and any(min(v) > 0.999999 for v in cells.values())
    got = mix(edge_docs(spark)).collect()
    assert len(got) == len(EDGE) and all(r.probability == 1.0 and r.sampled for r in got if not (r.text or "").split())
    assert mix(empty_docs(spark)).count() == 0


def capped_rake(tokens, keep, temper=0.7, sweeps=200):
    """Brute force: each cell's probability, a value's scale found by bisection instead of a step."""
    total = sum(tokens.values())
    own, goal = {k: n / total for k, n in tokens.items()}, []
    for at in range(3):
        have = Counter()
        for k, x in own.items():
            have[k[at]] += x
        power, low, high = {v: x ** temper for v, x in have.items()}, 0.0, 1e9
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(x, mid * power[v]) for v, x in have.items()) < keep else (low, mid)
        goal.append({v: min(x, high * power[v]) for v, x in have.items()})
    scale = [dict.fromkeys(g, 1.0) for g in goal]
    for _ in range(sweeps):
        for at in range(3):
            for v, x in goal[at].items():
                mine = [(own[k], own[k] * math.prod(scale[i][k[i]] for i in range(3) if i != at)) for k in own if k[at] == v]
                low, high = 0.0, 1e3
                for _ in range(60):
                    mid = (low + high) / 2
                    low, high = (mid, high) if sum(min(o, mid * w) for o, w in mine) < x else (low, mid)
                scale[at][v] = high
    return {k: min(1.0, math.prod(scale[i][k[i]] for i in range(3))) for k in own}


def test_a_rare_source_scales_no_other(spark):
    """One 100-word document of a source of its own leaves the others' probabilities as they are."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    rare = spark.createDataFrame([(-1, "telling " * 100, "en", "rare")], docs.schema)
    plain, out = mix(docs).collect(), mix(docs.union(rare)).collect()
    for got in (plain, out):
        words = sum(r.n_tokens for r in got)
        assert abs(sum(r.n_tokens * r.probability for r in got) / words - KEEP) < 1e-4
        assert abs(sum(r.n_tokens for r in got if r.sampled) / words - KEEP) < 0.1
    before = {r.doc_id: r.probability for r in plain}
    assert all(abs(r.probability - before[r.doc_id]) < 0.01 for r in out if r.source != "rare")
    assert [r.sampled for r in out if r.source == "rare"] == [True]


def test_mix_equals_brute_force(spark):
    words = {("a", "u"): 900, ("a", "v"): 400, ("b", "u"): 300, ("b", "v"): 700, ("c", "u"): 3, ("d", "v"): 40}
    texts = ["alpha", "gamma", "omega"]
    docs = [(i, f"{w} " * (n + 7 * j), x, s) for i, (((s, x), n), (j, w)) in
            enumerate((c, t) for c in words.items() for t in enumerate(texts))]
    got = mix(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()
    tokens = Counter()
    for r in got:
        tokens[r.source, r.lang, r.topic] += r.n_tokens
    want = capped_rake(tokens, KEEP)
    assert all(abs(r.probability - want[r.source, r.lang, r.topic]) < 1e-3 for r in got)
    assert sum(p == 1 for p in want.values()) and min(want.values()) < 0.9


def test_topics_from_all_words(spark):
    texts = ["This file is free. " + x for x in ("The hospital and its doctors, a patient's blood", "Zwei Spieler der Liga", "nothing told")]
    texts += ["license " + "filler " * 9000 + "Player, PLAYER", "Le médecin à l'Hôpital; le prix", "court bank bank court", "", None]
    got = spark.createDataFrame(enumerate(texts), "i int, text string").select("i", topic_of(F.coalesce("text", F.lit(""))).alias("t"))
    assert [r.t for r in got.orderBy("i").collect()] == ["health", "sport", "other", "sport", "health", "business", "other", "other"]
    every = [w for words in TOPICS.values() for w in words]
    assert all(w == w.lower() and re.fullmatch(r"[^\x00-\x60\x7b-\x7f]+", w) for w in every)
    told = {w: name for name, words in TOPICS.items() for w in words}
    for r in mix(edge_docs(spark)).select("text", "topic").collect():
        n = Counter(told[w] for w in re.split(r"[\x00-\x60\x7b-\x7f]+", (r.text or "").lower()) if w in told)
        assert r.topic == (max(TOPICS, key=lambda x: n[x]) if n else "other")
    assert all(len({k for k, words in TOPICS.items() if w in words}) == 1 for w in every)


def test_raking_ends_within_tolerance(spark):
    """Slow targets (a hot source, one row with neither source nor language) are met by the default bound; contradictions are told."""
    tokens = {(f"s{i}", x, t): 50.0 + 17 * ((5 * i + 3 * j + 2 * k) % 11) for i in range(4) for j, x in enumerate("uvw") for k, t in enumerate("pq")}
    tokens |= {("hot", x, t): 4000.0 if x == "u" else 1.0 for x in "uvw" for t in "pq"} | {("-", "-", "p"): 1.0}
    cells = spark.createDataFrame([(*k, n) for k, n in tokens.items()], "source string, lang string, topic string, tokens double")
    share = {"source": {"hot": .2, "-": .01, **{f"s{i}": .1975 for i in range(4)}}, "lang": {"u": .05, "v": .47, "w": .47, "-": .01}}
    targets = spark.createDataFrame([(m, v, x) for m, d in share.items() for v, x in d.items()], "margin string, value string, share double")
    out = rake(cells, targets, margins=("source", "lang")).collect()
    assert 0 <= out[0].gap <= 1e-6
    for m, d in share.items():
        for v, x in d.items():
            assert abs(sum(r.weight for r in out if r[m] == v) - x) < 3e-6
    clash = targets.where("value <> '-'").union(spark.createDataFrame([("source", "-", .01), ("lang", "-", .2)], targets.schema))
    with pytest.warns(UserWarning, match="off by"):
        assert rake(cells, clash, margins=("source", "lang")).first().gap > 0.01
