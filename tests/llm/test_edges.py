"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest

import corpus_pipeline
from postsift.llm import (chat, decontaminate, html_text, lang_id, line_quality, lm_score, near_dup, packing, queries,
                          secret_scan, token_files)
from test_near_copies import brute

LONG = "The long text goes on and on with token = \"0123456789abcdef0123456789\" in it.\n" * 4000
ROWS = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "Some words of a text.", "en", "s", 21),
        (3, "Some words of a text.", "en", "s", 21), (None, "Ein Wort und noch eins.", "de", None, None),
        (5, LONG, "en", "s", len(LONG)), (6, " \n ", "de", "s", 3), (7, "1234 !!", None, "s", 7)]
CLASH = ("kept", "row", "key", "n", "word", "held_out", "__row", "__print", "fingerprint", "cleaned", "rank", "part", "ids")


@pytest.fixture(scope="module")
def docs(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def by_row(spark, docs):
    path = queries.tokenizer("byte_bpe_50k.json")
    return {
        "language": lambda d: lang_id.identify(d), "score": lambda d: lm_score.scores(d),
        "quality": lambda d: line_quality.report(d), "near": lambda d: near_dup.near_dups(d),
        "secrets": lambda d: secret_scan.scan(d), "files": lambda d: token_files.round_trip(spark, d, path, 2),
        "packing": lambda d: packing.pack(d, queries.tokenizer("word_bpe_49k.json")).where("piece = 0"),
    }


@pytest.mark.parametrize("name", ["language", "score", "quality", "near", "secrets", "files", "packing"])
def test_every_row_has_a_result(spark, docs, name):
    run = by_row(spark, docs)[name]
    ids = lambda df: sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())
    assert ids(run(docs)) == ids(docs)
    assert run(docs.limit(0)).collect() == []


def test_letterless_texts_have_no_language(spark, docs):
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(docs).collect()}
    assert [got[k] for k in (1, 2, 6, 7)] == [("und", 0.0)] * 4


def test_empty_text_scores_its_end(spark, docs):
    got = {r.doc_id: r for r in lm_score.scores(docs).collect()}
    assert got[1].n_tokens == got[2].n_tokens == 1 and got[1].score == got[2].score


def test_empty_texts_are_one_group(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_dup.near_dups(docs).collect()}
    assert got[1] == got[2] == got[6] == ("0" * 16, 1) and got[3][1] == 3


def test_one_row_of_a_group_stays(spark, docs):
    kept = near_dup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "7", "None"]


def test_pages_and_turns(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (2, "u", "", 2), (2, "u", "<p>x</p>", 3), (None, None, "<p>y" * 20000, 4)],
                                  "page_id long, url string, html string, text int")
    got = html_text.extract(pages)
    assert sorted((r.page_id or 0, r.n_chars) for r in got.collect()) == [(0, 39999), (1, 0), (2, 0), (2, 1)]
    assert html_text.extract(pages.limit(0)).collect() == []
    turns = spark.createDataFrame([(None, None, None, None, 1), (1, 0, "user", "a", 2), (1, 0, "user", "a", 2), (1, 0, "assistant", "\\", 2)],
                                  "conv_id long, turn long, role string, text string, node int")
    assert sorted((r.conv_id or 0, r.n_turns, r.loss_chars) for r in chat.digests(turns).collect()) == [(0, 1, 0), (1, 3, 1)]
    assert chat.digests(turns.limit(0)).collect() == []


def test_leaks_without_items_or_documents(spark, docs):
    items = spark.createDataFrame([(1, "Some words of a text."), (None, None), (2, "")], "item_id long, text string")
    assert sorted(tuple(r)[:2] for r in decontaminate.leaks(docs, items).collect()) == [(3, 1), (3, 1)]
    assert decontaminate.leaks(docs, items.limit(0)).collect() == [] == decontaminate.leaks(docs.limit(0), items).collect()
    assert decontaminate.clean(docs, items).count() == len(ROWS) - 2
    assert decontaminate.clean(docs, items.limit(0)).count() == len(ROWS)
    more = items.unionByName(spark.createDataFrame([(5, "Ein Wort und noch eins."), (6, "nowhere to be found")], items.schema))
    got = decontaminate.clean(docs, more, block_bytes=20)
    assert got.columns == docs.columns and got.count() == len(ROWS) - 3


def test_secrets_are_masked(spark, docs):
    got = secret_scan.redact(docs)
    assert got.columns == docs.columns
    texts = {r.doc_id: r for r in got.collect()}
    assert texts[1].text is None and "[SECRET]" in texts[5].text and "0123456789abcdef" not in texts[5].text
    assert texts[5].n_chars == len(texts[5].text) and texts[3].text == "Some words of a text."


def test_stages(spark, sf_dir, tmp_path):
    """Every stage against its own input; all but the last keep the columns of documents."""
    docs = queries.table(spark, sf_dir, "documents")
    columns, made = docs.dtypes, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        made[name] = (docs, spark.read.parquet(f"{tmp_path}/{name}"))
        docs = made[name][1]
        if name != "packed":
            assert docs.dtypes == columns
    keys = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = made["quality_rules"]
    assert keys(after) == keys(line_quality.report(before).where("kept"))
    before, after = made["near_duplicates"]
    rows = before.orderBy("doc_id").collect()
    assert keys(after) == sorted({rows[i].doc_id for i in brute([r.text for r in rows])[0]})
    before, after = made["benchmark_passages"]
    leaked = decontaminate.leaks(before, queries.table(spark, sf_dir, "benchmark")).select("doc_id")
    assert keys(after) == keys(before.join(leaked, "doc_id", "left_anti"))
    before, after = made["secrets"]
    assert keys(after) == keys(before)
    assert secret_scan.scan(after).selectExpr("sum(n_assign + n_access + n_hex)").first()[0] == 0
    before, after = made["packed"]
    assert keys(after.where("piece = 0")) == keys(before)


def test_stages_on_empty_and_odd_tables(spark, docs, sf_dir, tmp_path):
    for label, start in (("odd", docs), ("none", docs.limit(0))):
        df = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, sf_dir)
            out.write.parquet(f"{tmp_path}/{label}-{name}")
            df = spark.read.parquet(f"{tmp_path}/{label}-{name}")
