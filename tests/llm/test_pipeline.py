"""The corpus pipeline and the registered queries against brute force on the smallest tables."""

import hashlib

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from recurra.llm import byte_bpe, language_id, line_dedup, queries
from tests.llm.test_pairs import close, least_reachable, shingles

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), None if name == "byte_bpe" else docs.schema)
        seen[name] = (before, docs.collect())
        assert name == "byte_bpe" or docs.columns == columns
    before, after = seen["language_id"]
    assert {r.doc_id for r in after} == {i for i, r in before.items() if any(c.isalpha() for c in r.text)}
    before, after = seen["line_dedup"]
    first = line_dedup.deduplicated(spark.createDataFrame(list(before.values()))).collect()
    assert {r.doc_id: r.text for r in after} == {r.doc_id: r.text for r in first if r.n_dropped == 0 or r.text.strip()}
    assert all(len(r.text) == r.n_chars for r in after if r.text != before[r.doc_id].text)
    before, after = seen["minhash_dedup"]
    sets = {i: shingles(r.text) for i, r in before.items()}
    least = least_reachable(list(sets), lambda a, b: close(sets[a], sets[b]))
    assert sorted(r.doc_id for r in after) == sorted(set(least.values()))
    before, after = seen["mixing"]
    assert {r.doc_id for r in after} <= set(before) and all(r == before[r.doc_id] for r in after)
    before, after = seen["byte_bpe"]
    ranks = byte_bpe.read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    encoding = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(r.exact and r.ids == encoding.encode_ordinary(before[r.doc_id].text) for r in after)


def test_run(spark):
    got = spark_entry.queries()["pipeline"](spark, SF)
    assert got.count() > 100 and got.where("not exact").count() == 0


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        assert docs.count() == 0


def test_documents_without_any_lang_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(3)
    rows = [{**docs.first().asDict(), "doc_id": i, "text": text, "lang": None} for i, text in enumerate(["12 a b 3", None, "", "12 !!", "字"])]
    bare = spark.createDataFrame(rows, docs.schema)
    kept = corpus_pipeline.identify_language(spark, bare, SF).collect()
    assert {(r.doc_id, r.text, r.lang) for r in kept} == {(0, "12 a b 3", "und"), (4, "字", "und")}
    spans = language_id.identified(bare, bare).where("doc_id = 0").first().lang_spans
    assert [tuple(s) for s in spans] == [(1, 3, "und")]
    named = bare.withColumn("lang", F.lit("und"))
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, named, SF).collect()} == {0, 4}


def test_every_operator_has_its_query():
    names = [name.split("_")[0] for name in queries.QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)


def test_chat_query(spark):
    got = {r.conv_id: r for r in queries.op6_chat_format(spark, SF).collect()}
    text = queries.CONTROL_TEXT
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (got[-1].n_turns, got[-1].loss_chars) == (2, len(text))
