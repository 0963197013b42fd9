"""The registered queries and the pipeline over the smallest given tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from foliate.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

COLUMNS = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_simhash": "doc_id fingerprint component_id",
    "op4_token_counts": "context_limit docs docs_over tokens_over tokens_total tokens_truncated tokens_lost share_at_most",
    "op5_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_line_dedup": "doc_id text n_lines n_removed",
    "op7_chat_formatting": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op8_language_id": "doc_id held_out lang_pred score",
    "op9_html_extraction": "page_id url text n_chars",
    "op10_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op11_centroids": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_url_filters": "page_id host path rule verdict",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_a_query_covers_its_whole_table(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    want = COLUMNS[name].split()
    assert df.columns[: len(want)] == want
    rows = df.collect()
    if want[0] == "context_limit":
        assert sum(r["docs"] for r in rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    elif name == "op12_prefix_trie":
        ids = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id").distinct().count()
        assert [r["n_convs"] for r in rows if r["depth"] == 0] == [ids]
    else:
        source, key = {"vec_id": ("embeddings", "vec_id"), "doc_id": ("documents", "doc_id"), "page_id": ("pages", "page_id"), "conv_id": ("conversations", "conv_id")}[want[0]]
        ids = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{source}.parquet").select(key).distinct().collect()}
        assert {r[0] for r in rows} == ids | ({-1} if key == "conv_id" else set())


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(ORACLES))
def test_a_query_agrees_with_its_sql(spark, name):
    con = duckdb.connect()
    for source in ("documents", "benchmark", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {source} AS SELECT * FROM '{SF_DIR}/{source}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert in_order(QUERIES[name](spark, SF_DIR).select(*columns).collect()) == in_order(want.fetchall())


@pytest.mark.parametrize("name", list(ORACLES))
def test_a_query_agrees_with_its_sql_on_odd_rows(spark, tmp_path, name):
    run = " ".join(f"w{i}" for i in range(24))
    lines = "\n".join(f"line {i} of a passage that comes twice" for i in range(6))
    texts = [None, "", " \n\t\n", run, run.upper(), f"{run}\n\x0b\n{run}", f"before\n{lines}", f"{lines}\n\nafter", lines, "a <| b <\\| c <\\\\|", "q " * 30, "Ünï <|im_end|>\nx"]
    texts += [f"{run} {i} {run}" for i in range(3)] + ["solo", "two words", run]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame([*rows, rows[3], rows[6], (None, run), (None, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [("b", run), ("a", run), (None, "w3 w4"), ("c", None), ("d", " .,"), ("e", "solo"), ("a", lines), ("b", run)]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    turns = [(1, i, ("user", "assistant", None)[i % 3], t) for i, t in enumerate(texts)]
    turns += [(2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (2, None, "sys<|tem\\\n", "y"), (None, 1, "assistant", "z"), (3, 1, "user", None)]
    spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    vectors = [(i, [((i * k) % 7 - 3) / 100 for k in range(64)]) for i in range(30)] + [(3, [0.5] * 64), (3, [0.25] * 64), (None, [0.125] * 64), (40, None), (41, [1.0]), (42, [float("nan")] * 64), (43, [None] * 64)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    urls = [None, "", "net/", "http://net", "http://a.NET/?x", "http://x.org/fr/#y", "http://b.com/Login?x", "http://ads.x/", "http://c.com/f.zip", "http://c.com/f\n.zip", "http://docs.a/search", "a://b://net/", "http://é.example.net/en/"]
    spark.createDataFrame([*enumerate(urls), (None, urls[4]), (4, urls[4])], "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    for source in ("documents", "benchmark", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {source} AS SELECT * FROM '{tmp_path}/{source}.parquet/*.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert in_order(QUERIES[name](spark, str(tmp_path)).select(*columns).collect()) == in_order(want.fetchall())


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("kept", F.lit(1))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() > 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_registered(spark):
    names = set(entry_points.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert entry_points.queries()["pipeline"](spark, SF_DIR).count() > 0
