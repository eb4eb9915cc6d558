from collections import Counter

import corpus_pipeline
from edge import edge_docs, empty_docs, lower, table
from test_forest import brute
from test_scan_pack import VOCABULARY, check_packing

import __spark_entry__ as entry
from seriesflow.llm import language_id

SF = "/root/testdata/sf0.001"


def step(spark, k, docs):
    name, stage = corpus_pipeline.STAGES[k]
    return stage(spark, docs, SF).collect()


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r for r in table()]
    told = {r.doc_id: r for r in language_id.identify(docs).collect()}
    out = step(spark, 0, docs)
    assert Counter(map(tuple, out)) == Counter(r for r in rows if told[r[0]].lang_pred != "und" and told[r[0]].score >= 0.5)
    assert len(out) >= 0.98 * len([r for r in rows if any(c.isalpha() for c in r[1])])

    last = {}
    for r in sorted(rows):
        last[lower(r[1])] = r
    assert Counter(map(tuple, step(spark, 1, docs))) == Counter(last.values())

    classes = brute([r[:2] for r in rows])
    stay = {i for i, c, *_ in classes if i == c}
    assert Counter(map(tuple, step(spark, 2, docs))) == Counter(r for r in rows if r[0] in stay)

    mixed = list(map(tuple, step(spark, 3, docs)))
    assert not Counter(mixed) - Counter(rows) and len(mixed) > len(rows) / 4


def test_run_and_awkward_rows(spark):
    out = corpus_pipeline.run(spark, SF)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    check_packing(out.collect(), [r[:2] for r in table() if r[0] in ids])
    docs = edge_docs(spark)
    for k in range(4):
        got = step(spark, k, docs)
        assert got and list(got[0].asDict()) == docs.columns
        assert not Counter(map(tuple, got)) - Counter(map(tuple, docs.collect()))
        assert step(spark, k, empty_docs(spark)) == []
    check_packing(step(spark, 4, docs), [r[:2] for r in docs.collect()])


def test_registered():
    names = entry.queries()
    assert {"pipeline"} | {f"op{n}_" for n in range(1, 11)} <= {"pipeline"} | {k.split("_")[0] + "_" for k in names}
    assert VOCABULARY
