"""Deep nesting, many tokens, captions and formulas, wide ids, files read by many tasks."""

import time

import pytest

from postsift.llm import html_text, secret_scan, token_files
from postsift.session import shared_dir


def text_of(page):
    return html_text.main_text(page, html_text.Weights())


def test_captions_and_formulas_stay():
    body = "<p>" + "Some words of the story. " * 12 + "</p>"
    assert "A caption here" in text_of(f"<article>{body}<figure><img><figcaption>A caption here</figcaption></figure>{body}</article>")
    page = f"<article>{body}<p>Set <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x = 1</annotation></math> then go on.</p>{body}</article>"
    assert "Set x=1 then go on." in text_of(page)


@pytest.mark.parametrize("page", [
    "<div>word " * 20000, "<b>word " * 20000 + "</i>" * 20000, "<div>word " * 10000 + "</section>" * 10000,
    "<b><div>" * 10000 + "word " + "</b>" * 10000, "<p>word <i>" * 10000])
def test_deep_nesting_takes_seconds(page):
    start = time.monotonic()
    list(html_text.tokens(page))
    assert time.monotonic() - start < 10


def test_many_tokens_take_seconds():
    formats = secret_scan.Formats({0: ["abcDEF123456ghi", "zzzYYY987654qqq"]}, ["ordinary", "words"])
    text = "token = abcDEF123456ghi and other0words1of2length here\n" * 20000
    start = time.monotonic()
    spans = formats.spans(text)
    assert time.monotonic() - start < 30 and sum(k == 0 for _, _, k in spans) == 20000
    base = [(s, e) for s, e, k in spans if k != 3]
    assert not [1 for s, e, k in spans[:300] if k == 3 and any(a <= s and e <= b for a, b in base[:400])]


def test_files_are_read_by_several_tasks(spark):
    import public_tokenizers

    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('some words of text ', 20) AS text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = token_files.write(docs, shared_dir(spark, "files"), path, 2, file_ids=2000)
    rows = token_files.read(manifest)
    assert manifest.count() > 8 and rows.rdd.getNumPartitions() > 1
    got = [tuple(r)[:3] for r in rows.orderBy("doc_id").collect()]
    assert [g[0] for g in got] == list(range(400)) and all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    with pytest.raises(Exception, match="doesn't fit 1 bytes"):
        token_files.write(docs, shared_dir(spark, "files"), path, 2, id_bytes=1)
