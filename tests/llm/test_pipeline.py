from collections import defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from daytally.llm import toxicity_chain
from tests.llm.test_secrets import brute as secret_spans
from tests.llm.test_sketch_dedup import brute as near_groups

FOLDER = "/root/testdata/sf0.001"


def redacted(text):
    out, at = "", 0
    for start, _, stop in secret_spans(text)[1]:
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, stop)
    return out + text[at:]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "secret_scan", "packing"]


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, None, "en", "s", 0), (-2, "", None, None, None), (-3, "token = abcdef12", "en", "s", 16)], docs.schema)
    docs = docs.union(odd).union(docs.where("doc_id in (3, 4)"))
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda frame: sorted(map(tuple, frame.collect()), key=repr)

    clean = stages["toxicity"](spark, docs, FOLDER).cache()
    said = {row.doc_id for row in toxicity_chain.scored(docs, labels).where("toxic").collect()}
    assert clean.columns == docs.columns and rows(clean) == [r for r in rows(docs) if r[0] not in said]

    single = stages["exact_dedup"](spark, clean, FOLDER).cache()
    largest = defaultdict(lambda: -(10**9))
    for doc, text, *_ in rows(clean):
        largest[text or ""] = max(largest[text or ""], doc if doc is not None else -(10**9))
    assert rows(single) == [r for r in rows(clean) if r[0] == largest[r[1] or ""]]

    apart = stages["near_dedup"](spark, single, FOLDER).cache()
    distinct = sorted({(r[0], r[1] or "") for r in rows(single)})
    kept = {doc for doc, _, _, keep in near_groups(distinct, 5, 0.8) if keep}
    assert rows(apart) == [r for r in rows(single) if r[0] in kept]

    safe = stages["secret_scan"](spark, apart, FOLDER).cache()
    want = [(r[0], redacted(r[1]), *r[2:4], len(redacted(r[1]))) if r[1] and secret_spans(r[1])[1] else r for r in rows(apart)]
    assert safe.schema == docs.schema and rows(safe) == sorted(want, key=repr)

    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    packed = stages["packing"](spark, safe, FOLDER)
    total = sum(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows(safe))
    assert packed.agg(F.sum("length")).first()[0] == total


def test_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a clean text", 5, "x")], "doc_id long, text string, _text int, base string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert [tuple(r) for r in stage(spark, docs, FOLDER).collect()] == [(1, "a clean text", 5, "x")], name
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns[:3] == ["doc_id", "start", "length"] and out.count() > 0
