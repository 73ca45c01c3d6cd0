"""The pipeline against its stages by brute force, and the registered queries' contracts."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline as cp
from ratewise.llm import bpe_codec
from ratewise.llm.catalog import LLM_ORACLE, LLM_QUERIES

from test_lines_leaks import brute_leaks, brute_lines, words
from test_ngram_join import brute as brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with short documents, planted cases and a few benchmark items."""
    d = str(tmp_path_factory.mktemp("corpus"))
    items = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(12)
    items.write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars between 300 and 1500")
    rows = [tuple(r) for r in docs.orderBy("doc_id").collect()]
    leak = items.first().text
    base = rows[3]
    near = " ".join("edited" if k == 20 else w for k, w in enumerate(base[1].split(" ")))
    planted = [(9001, base[1], "en", "s", 1), (9002, near, None, None, None), (9003, f"{rows[5][1]} {leak}", "en", "s", 1),
               (9004, None, "en", "s", 0), (9005, "", None, "s", 0), (9006, "1234 -- 5678", "en", "s", 12),
               (9007, rows[6][1].split("\n")[0] + "\nA line that nothing else has in this small corpus of texts.", "en", "s", 1)]
    spark.createDataFrame(rows + planted, docs.schema).repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


def test_pipeline_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = docs
    seen = {}
    for name, stage in cp.STAGES:
        path = f"{small}/out-{name}"
        stage(spark, out, small).write.parquet(path)
        out = spark.read.parquet(path)
        seen[name] = out
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    before = texts(docs)
    first = texts(seen["language_id"])
    # only texts without letters may go here
    assert set(before) - set(first) == {9004, 9005, 9006} and all(first[i] == before[i] for i in first)
    want = {i: t for i, t in brute_lines(list(first.items())).items() if t == first[i] or words(t)}
    lines = texts(seen["line_dedup"])
    assert lines == want and 9001 not in lines and 9007 in lines
    groups = brute_components(sorted(lines.items()))
    kept = {d for d, _, c in groups if d == c}
    joined = texts(seen["ngram_jaccard_join"])
    assert set(joined) == kept
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, _ in brute_leaks(sorted(joined.items()), items)}
    clean = texts(seen["benchmark_decontamination"])
    assert 9003 in bad and set(clean) == set(joined) - bad
    enc = bpe_codec._codec("byte_bpe_50k.tiktoken")
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == set(clean)
    for i, t in clean.items():
        assert list(got[i].ids) == enc.encode_ordinary(t)
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_pipeline_on_odd_rows(spark, small):
    """Nulls in any column, repeated rows, an extra column, no rows at all."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = docs.limit(6).unionByName(docs.limit(2)).withColumn("_th", F.lit(1)).withColumn("score", F.lit("x"))
    odd = odd.unionByName(odd.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, odd, small).columns == odd.columns, name
        assert stage(spark, docs.where("false"), small).count() == 0, name


def test_repeated_ids_own_columns_and_long_texts(spark, small):
    """Equal ids with different texts, columns named like the stages' own, a text of 200,000 words."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    base = docs.where("doc_id < 9000 and n_chars > 600").orderBy("doc_id").first()
    t, other = base.text.replace("\n", " "), docs.where("doc_id < 9000").orderBy(F.desc("doc_id")).first().text.replace("\n", " ")
    long = " ".join(f"{w}{i % 977}" for i, w in enumerate((t.split() * (200_000 // len(t.split()) + 1))[:200_000]))
    rows = [(1, t, "en", "s", 1, 77, "a"), (2, t, "en", "s", 1, 88, "b"), (2, other, "en", "s", 1, 99, "c"), (2, other, "en", "s", 1, 99, "c"),
            (None, t, "en", "s", 1, 5, "d"), (3, long, "en", "s", 1, 6, "e"), (4, long + " end", "en", "s", 1, 7, "f"),
            (5, f"{other[:400]} " + " \n" * 60_000 + t[:300], "en", "s", 1, 8, "g")]
    odd = spark.createDataFrame(rows, T.StructType([*docs.schema.fields, T.StructField("n_removed", T.IntegerType()), T.StructField("kept_th", T.StringType())])).repartition(3)
    joined = cp.ngram_jaccard(spark, odd, small)
    assert joined.columns == odd.columns
    assert sorted((r.doc_id, r.text == t, r.n_removed) for r in joined.collect()) == [(1, True, 77), (2, False, 99), (3, False, 6), (5, False, 8)]
    lines = {(r.doc_id, r.text): r.n_removed for r in cp.line_dedup_stage(spark, odd, small).collect()}
    assert set(lines.values()) <= {77, 88, 99, 5, 6, 7, 8} and lines[None, t] == 5 and (1, t) not in lines  # a null id sorts first
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, odd, small)
        assert out.columns == odd.columns and out.where("doc_id = 3").count() == 1, name
    got = {r.doc_id: r.decoded_sha256 for r in cp.byte_bpe(spark, odd.where("doc_id in (3, 5)"), small).collect()}
    assert got[3] == hashlib.sha256(long.encode()).hexdigest() and got[5] == hashlib.sha256(rows[7][1].encode()).hexdigest()


CONTRACTS = {
    1: {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    2: {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    3: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    4: {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    6: {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    7: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    9: {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
        "base_score": "double", "score": "double"},
    10: {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
         "near_edited": "double", "near_next": "double"},
    11: {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    12: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    13: {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
}


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_registered_queries(spark, name):
    df = LLM_QUERIES[name](spark, SF)
    n = int(name[2:].split("_")[0])
    for column, kind in CONTRACTS.get(n, {}).items():
        assert dict(df.dtypes)[column] == kind
    rows = df.collect()
    table = {1: "pages", 13: "embeddings"}.get(n, "documents")
    if n not in (5, 13):
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in LLM_ORACLE:
        con = duckdb.connect()
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        rel = con.execute(LLM_ORACLE[name])
        order = [[d[0] for d in rel.description].index(c) for c in df.columns]
        assert sorted(map(str, (tuple(r) for r in rows))) == sorted(str(tuple(r[i] for i in order)) for r in rel.fetchall())
