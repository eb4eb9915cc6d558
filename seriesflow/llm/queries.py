"""One thin query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from seriesflow.llm import language_id, line_crf, license_scan, minhash_forest, tree_weighting
from seriesflow.llm.alignment import token_alignment
from seriesflow.llm.common import documents
from seriesflow.llm.fill_middle import fill_in_middle, restored
from seriesflow.llm.line_rules import clean_lines
from seriesflow.llm.raking import mix
from seriesflow.llm.packing import pack
from seriesflow.llm.private_data import find_private
from seriesflow.llm.radix_dedup import radix_dedup
from seriesflow.llm.registry import query
from seriesflow.llm.sharding import balanced_shards

EXACT_DEDUP_SQL = """
with t as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
           from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by 1)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, t.text_sha256 from t join g using (text_sha256)
"""


@query("op4_radix_dedup", EXACT_DEDUP_SQL)
def op4_radix_dedup(spark, sf_dir):
    return radix_dedup(documents(spark, sf_dir)).drop("n_digits")


@query("op5_label_sharding")
def op5_label_sharding(spark, sf_dir):
    out = balanced_shards(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "linked")


@query("op6_line_rules")
def op6_line_rules(spark, sf_dir):
    out = clean_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "share_left")


@query("op7_raking")
def op7_raking(spark, sf_dir):
    return mix(documents(spark, sf_dir)).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "sampled")


@query("op2_output_codes")
def op2_output_codes(spark, sf_dir):
    return language_id.identify(documents(spark, sf_dir))


@query("op9_line_crf")
def op9_line_crf(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return line_crf.score(docs, line_crf.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query("op10_harmonic_packing")
def op10_harmonic_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir), vocabulary())


def vocabulary() -> str:
    """Where the tokenizer's file lies on every machine; never copied."""
    return public_tokenizers.path("word_bpe_49k.json")


@query("op3_diagonal_voting")
def op3_diagonal_voting(spark, sf_dir):
    return license_scan.scan(documents(spark, sf_dir))[0]


@query("op1_tree_weighting")
def op1_tree_weighting(spark, sf_dir):
    return tree_weighting.score(documents(spark, sf_dir))


@query("op8_minhash_forest")
def op8_minhash_forest(spark, sf_dir):
    return minhash_forest.jaccard_classes(documents(spark, sf_dir))


@query("op11_contextual_extraction")
def op11_contextual_extraction(spark, sf_dir):
    return find_private(documents(spark, sf_dir))


@query("op12_arrow_alignment")
def op12_arrow_alignment(spark, sf_dir):
    return token_alignment(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


FILL_MIDDLE_SQL = """
with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as h from documents),
u as (select *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units,
  ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
c as (select *, len(units) as n, h1 % (len(units) + 1) as x, h2 % (len(units) + 1) as y,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
       when h4 % 100 < 80 then 'spm' else 'psm' end as form from u),
p as (select *, array_to_string(units[1:least(x, y)], '') as pre, array_to_string(units[least(x, y) + 1:greatest(x, y)], '') as mid,
  array_to_string(units[greatest(x, y) + 1:n], '') as suf from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(text) as restored_sha256 from p
"""


@query("op13_skip_list_middle", FILL_MIDDLE_SQL)
def op13_skip_list_middle(spark, sf_dir):
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(documents(spark, sf_dir)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                                                           sha(restored()).alias("restored_sha256"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
