"""Every operator on texts of megabytes: one long line, one long word, one line many times."""
import public_tokenizers
import pytest

from seriesflow.llm import language_id, license_scan, line_crf, minhash_forest, tree_weighting
from seriesflow.llm.alignment import token_alignment
from seriesflow.llm.fill_middle import fill_in_middle
from seriesflow.llm.line_rules import clean_lines
from seriesflow.llm.packing import pack
from seriesflow.llm.private_data import find_private
from seriesflow.llm.radix_dedup import radix_dedup
from seriesflow.llm.raking import mix
from seriesflow.llm.sharding import balanced_shards

LONG = [(1, "word and more words. " * 100_000, "en"), (2, "x" * 2_000_000, "en"), (3, "the same line of text\n" * 90_000, "en"), (4, "été " * 400_000, "fr"),
        (5, "a short text of some words", "en"), (6, "un texte court et simple", "fr"), (7, "A SHORT text of some words", "en"), (8, None, None)]
PATH = public_tokenizers.path


def docs(spark):
    rows = [(i, t, lang, "web", len(t or "")) for i, t, lang in LONG]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)


OPERATORS = {
    "op1": lambda d: tree_weighting.score(d, folds=3),
    "op2": lambda d: language_id.identify(d),
    "op3": lambda d: license_scan.scan(d)[0],
    "op4": lambda d: radix_dedup(d),
    "op5": lambda d: balanced_shards(d),
    "op6": lambda d: clean_lines(d.select("doc_id", "text")),
    "op7": lambda d: mix(d),
    "op8": lambda d: minhash_forest.jaccard_classes(d),
    "op9": lambda d: line_crf.score(d, line_crf.fit(d, d.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality"))),
    "op11": lambda d: find_private(d),
    "op12": lambda d: token_alignment(d, PATH("byte_bpe_50k.json"), PATH("piece_bpe_32k.model")),
    "op13": lambda d: fill_in_middle(d),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_one_row_a_document(spark, name):
    out = OPERATORS[name](docs(spark))
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == [i for i, _, _ in LONG]


def test_packing_keeps_all_tokens(spark):
    out = pack(docs(spark), PATH("word_bpe_49k.json"))
    held = {r.doc_id: (r.total, r.n) for r in out.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).toDF("doc_id", "total", "n").collect()}
    assert len(held) == len(LONG) and all(total == n for total, n in held.values()) and held[1][0] == 500_001 and held[8] == (1, 1)
