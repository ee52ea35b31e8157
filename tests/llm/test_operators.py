"""Each training-data query against a plain walk over the same rows."""

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from postsift.llm import (chat, decontaminate, html_text, lang_id, line_quality, lm_score, near_dup, packing, queries,
                          secret_scan, token_files, tokens)

WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_languages_of_held_out_texts(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    got = {r.doc_id: r for r in queries.op1_language_id(spark, sf_dir).collect()}
    right = []
    for r in docs.collect():
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= got[r.doc_id].score <= 1
        if got[r.doc_id].held_out and len(r.text) > 200:
            right.append(got[r.doc_id].lang_pred == r.lang)
    assert np.mean(right) >= 0.9


def test_network_gradients():
    net = lang_id.Network(["a", "b"])
    net.params = {k: v.astype("f8") for k, v in net.params.items()}
    ids, target = lang_id.byte_windows(["abc def", "xyz" * 9])[:9], np.array([0, 1])
    _, grads = net.gradients(ids, target)
    for name, at in (("loop_f", (3, 2)), ("loop_b", (9, 1)), ("out_f", (1, 4)), ("table_b", (ord("x"), 5)), ("bias", (0, 0))):
        kept, losses = net.params[name][at], []
        for step in (1e-3, -1e-3):
            net.params[name][at] = kept + step
            losses.append(net.gradients(ids, target)[0])
        net.params[name][at] = kept
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(float(grads[name][at]), abs=1e-4)


def test_short_texts_are_not_read_past_their_end():
    net = lang_id.Network(["a", "b"])
    import pyarrow as pa
    sums, sizes = net.predict(pa.array(["ab", None, "x" * 300, "ab"], pa.string()))
    assert sizes.tolist() == [2, 0, 300, 2] and sums[1].sum() == 0
    assert np.allclose(sums.sum(1), sizes, rtol=1e-4) and np.allclose(sums[0], sums[3])


def test_token_scores(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op2_lm_score(spark, sf_dir).collect()}
    split = {k: t.encode().lower().split() for k, t in documents}
    counts, ends = Counter(), 0
    for k, words in split.items():
        if zlib.crc32(str(k).encode()) % 7 != 2:
            counts.update(words)
            ends += 1
    total, different = sum(counts.values()) + ends, len(counts) + 1
    for k, words in split.items():
        want = sum(math.log10((c + 1) / (total + different + 1)) for c in [counts[w] for w in words] + [ends])
        assert got[k].base_score == pytest.approx(want, rel=1e-9)
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (
            len(words) + 1, 1 + sum(w in counts for w in words), total)
        assert got[k].score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_class_probabilities_sum_to_one():
    model = lm_score.LogBilinear(np.arange(1, 20.0))
    total = sum(np.exp(model.log_probs(np.array([3, k, 0], np.int32), np.array([3]))[1]) for k in range(19))
    assert total == pytest.approx(1, abs=1e-5)


def test_main_text_of_pages(spark, sf_dir):
    got = {r.page_id: r for r in queries.op3_html_text(spark, sf_dir).collect()}
    for page in queries.table(spark, sf_dir, "pages").collect():
        body = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", body))).split())
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (want, len(want), page.url)


PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div id="cookie-notice"><p>We use
cookies and more words of this notice.</p></div><div class="x"><h2>Head&amp;line</h2><p>First <a href=x>link</a> te<b>xt</b>.
<p>Second &lt;b&gt;<br>line<div class="ad">Buy this</div><ul><li>one</li><li>two</li></ul><p>Last of all words.</p></div>
<form><label>Name</label><p>Fill in</p></form><section class="comments"><p>I like it and have more to say than
the article itself.</p></section><aside>side bar</aside><script>if(a<b){x="</p>"}</script></body></html>"""


def test_page_without_article():
    weights = html_text.learn_weights([])
    assert html_text.main_text(PAGE, weights) == (
        "Head&line First link text. Second <b> line one two Last of all words.")
    assert [html_text.main_text(p, weights) for p in (None, "", "<p", "a < b", "<p>x</p>" * 2, "<script>x")] == [
        "", "", "", "a < b", "x x", ""]


def test_leaks(spark, sf_dir, documents):
    items = {}
    for r in sorted(queries.table(spark, sf_dir, "benchmark").collect()):
        items.setdefault(frozenset(decontaminate.shingle_set(r.text)), r.item_id)
    want = []
    for k, text in documents:
        held = decontaminate.shingle_set(text)
        want += [(k, i, len(s), len(s & held)) for s, i in items.items() if len(s & held) >= 0.8 * len(s)]
    got = queries.op4_decontamination(spark, sf_dir)
    assert rows(got, "doc_id", "item_id", "n_shingles", "n_found") == sorted(want) and want


def test_leaks_of_every_size_and_in_blocks(spark):
    rng = random.Random(2)
    word = lambda: "w%d" % rng.randrange(10**6)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 5, 6, 9, 17, 40, 200, 900])]
    docs = []
    for i, text in items:
        around = [" ".join(word() for _ in range(700)) for _ in range(2)]
        docs += [(i, f"{around[0]} {text.upper()}\n{around[1]}"), (100 + i, text)]
    docs += [(200, None), (201, ""), (202, " ".join(word() for _ in range(3000)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(items + [(50, items[8][1]), (60, None), (61, " ")], "item_id long, text string")
    want = sorted([(i, i) for i, t in items if len(t.split()) >= 5] + [(100 + i, i) for i, _ in items])
    for size in (decontaminate.ITEM_BLOCK_BYTES, 2000):
        assert rows(decontaminate.leaks(df, known, block_bytes=size), "doc_id", "item_id") == want


def base_counts(text):
    found = WORD.findall(text or "")
    windows = [tuple(found[i: i + 3]) for i in range(len(found) - 2)]
    often, inside, seen, repeated = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        inside |= {i, i + 1, i + 2} if often[w] > 1 else set()
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(found) < 50 or 100 * len(inside) > 50 * len(found)
    return len(found), sum(map(len, found)), len(re.findall("[#*$%&|<>]", text or "")), repeated, len(inside), failed


ODD = [None, "", " \n\t ", "a b c a b c", "x y   z\x1cq", "a a a a\n a\n\n a", "a b", "\x0b\x0c\r\n", "a b c " * 40000,
       "\n".join(["same line of words"] * 300), "é" * 5000]


def test_line_quality(spark, sf_dir, documents):
    own = [(-i - 1, t) for i, t in enumerate(ODD)]
    df = queries.table(spark, sf_dir, "documents").select("doc_id", "text").union(
        spark.createDataFrame(own, "doc_id long, text string"))
    got = {r.doc_id: r for r in line_quality.report(df).collect()}
    for k, text in documents + own:
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(text), k
        assert not (r.kept and r.base_failed)


def test_line_verdicts_follow_the_labels(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    got = [(labels[r.doc_id], r.kept) for r in queries.op5_line_quality(spark, sf_dir).collect()
           if r.doc_id in labels and not r.base_failed]
    assert all(kept == (quality == 1) for quality, kept in got) and got


def test_fingerprint_groups(spark, sf_dir, documents):
    prints = {k: near_dup.fingerprint(t) for k, t in documents}
    group = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= 3 and group[b] > group[a]:
                    group[b], changed = group[a], True
    want = sorted((k, f"{prints[k] & (2**64 - 1):016x}", group[k]) for k in prints)
    assert rows(queries.op6_simhash_near_dup(spark, sf_dir), "doc_id", "fingerprint", "component_id") == want


@pytest.mark.parametrize("tree_size", [4096, 7])
def test_links_join_all_that_is_near(spark, tree_size):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:40]:
        for _ in range(8):
            p ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            prints.add(p)
    signed = sorted(p - (p >> 63 << 64) for p in prints)
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    roots = {r.node: r.root for r in near_dup.components(near_dup.links(df, tree_size)).collect()}
    label = np.arange(len(signed))
    whole = np.array(signed).view(np.uint64)
    near_dup.unite(label, *np.nonzero(np.bitwise_count(whole[:, None] ^ whole) <= 3))
    assert [roots.get(p, p) for p in signed] == [signed[i] for i in label]


def test_secrets(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op7_secret_scan(spark, sf_dir).collect()}
    any_case = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
    assign = re.compile(any_case + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for k, text in documents:
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        base = ",".join(f"{secret_scan.KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(spans))
        assert got[k].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[k].spans.split(","))


def test_learnt_formats():
    rng = random.Random(1)
    make = lambda chars, n, head="": head + "".join(rng.choices(chars, k=n))
    known = [make("ABCDEFGHJKLMNPQR0123456789", 18, "XQ7-") for _ in range(200)]
    formats = secret_scan.Formats({0: known}, ["ordinaryprosewords", "considerations", "notwithstanding"] * 30)
    text = f"see {make('ABCDEFGHJKLMNPQR0123456789', 18, 'XQ7-')} and notwithstanding prose, https://example.org/index.html"
    assert [s[2] for s in formats.spans(text)] == [3]
    assert formats.spans("")  == [] and secret_scan.Formats({}, []).spans(text) == []
    assert secret_scan.masked("a token=0123456789abcdef0 b", secret_scan.base_spans("a token=0123456789abcdef0 b")) == "a [SECRET] b"


def test_conversations(spark, sf_dir):
    talks = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in sorted(queries.table(spark, sf_dir, "conversations").collect(), key=lambda r: (r.conv_id, r.turn)):
        talks.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    want = []
    for k, turns in talks.items():
        said, loss = "".join(f"{r}\n{t}\n" for r, t in turns), "".join(t for r, t in turns if r == "assistant")
        want.append((k, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    assert rows(queries.op8_chat_formatting(spark, sf_dir), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want)


TREE = [(1, 1, None, 1.0, "user", "q\\</s>"), (1, 2, 1, 2.0, "assistant", "a[INST]"), (1, 3, 1, 5.0, "assistant", None),
        (1, 4, 2, 9.0, "user", "<\\/s>x"), (1, 5, 4, 0.0, "assistant", "\\\\<s>"), (2, 1, 99, None, None, "x"),
        (2, 2, 1, 1.0, "assistant", "")]


def test_reply_trees(spark):
    df = spark.createDataFrame(TREE, "tree long, node long, parent long, score double, role string, text string")
    got = rows(chat.paths(df, 2), "tree", "path_rank", "depth", "node")
    assert got == [(1, 1, 0, 1), (1, 1, 1, 2), (1, 1, 2, 4), (1, 1, 3, 5), (1, 2, 0, 1), (1, 2, 1, 3), (2, 1, 0, 1), (2, 1, 1, 2)]
    back = {r.conv_id.leaf: r for r in chat.parsed(chat.chat(df.where("tree = 1"))).collect()}
    assert [t.text for t in back[5].turns] == ["q\\</s>", "a[INST]", "<\\/s>x", "\\\\<s>"]
    assert back[5].loss_text == "a[INST]\\\\<s>"


def test_packing(spark, sf_dir, documents):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
    want = []
    for k, text in documents:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        for i, at in enumerate(range(0, len(ids), 4096)):
            own = np.array(ids[at: at + 4096], "<u4")
            want.append((k, i, at, len(own), zlib.crc32(own.tobytes())))
    got = queries.op9_best_fit_packing(spark, sf_dir).cache()
    assert rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want)
    bins = {}
    for sequence, offset, length in rows(got, "sequence_id", "offset", "length"):
        assert offset == bins.get(sequence, 0)
        bins[sequence] = offset + length
    assert max(bins.values()) <= 4096 and len(bins) <= math.ceil(sum(bins.values()) / 4096) + 1


def test_packing_plans_fill_bins_without_overlap():
    rng = random.Random(9)
    for _ in range(200):
        capacity = rng.choice([8, 12, 30, 100])
        counts = np.zeros(capacity + 1, int)
        for _ in range(rng.randint(0, 60)):
            counts[rng.randint(1, capacity)] += rng.choice([1, 1, 2, 7])
        bins, placed = {}, Counter()
        for length, first, per_bin, first_bin, n, offset in packing.plan(counts, capacity).tolist():
            assert first == placed[length]
            placed[length] += per_bin * n
            for b in range(first_bin, first_bin + n):
                bins.setdefault(b, []).extend((offset + i * length, length) for i in range(per_bin))
        assert all(placed[n] == counts[n] for n in range(1, capacity + 1))
        for parts in bins.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= capacity


def test_token_files(spark, sf_dir, documents):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    want, start = [], 0
    for k, text in sorted(documents):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        want.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows(queries.op10_token_files(spark, sf_dir), "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_token_file_documents(spark, tmp_path):
    docs = spark.createDataFrame([(5, "b b"), (None, None), (2, "a"), (5, "")], "doc_id long, text string")
    manifest = token_files.write(docs, f"file://{tmp_path}", queries.tokenizer("byte_bpe_50k.json"), 2, file_ids=3)
    keys = []
    for r in manifest.orderBy("part", "file").collect():
        file = token_files.TokenFile(r.path)
        keys += file.doc_ids()
        assert sum(len(file.document(i)) for i in range(r.n_docs)) == r.n_ids
    assert keys == [None, 2, 5, 5]
    read = rows(token_files.read(manifest), "start", "n_tokens", "doc_id")
    assert [(k, n) for _, n, k in read][:2] == [(None, 1), (2, 2)] and sorted(n for _, n, k in read if k == 5) == [1, 3]
    assert [start for start, _, _ in read] == [sum(n for _, n, _ in read[:i]) for i in range(4)]


def test_elias_fano():
    rng = np.random.default_rng(0)
    for top in (1, 5, 1000, 1 << 40):
        for n in (0, 1, 255, 256, 257, 2000):
            values = np.sort(rng.integers(0, top, n))
            coded = token_files.EliasFano.of(values)
            assert (coded.decode() == values).all()
            assert all(coded.select(i) == values[i] for i in range(0, n, 37))


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoder_equals_the_library(name, spaced):
    from tokenizers import Tokenizer
    path = queries.tokenizer(name)
    plain, own, rng = Tokenizer.from_file(path), tokens.Encoder(path, spaced), random.Random(3)
    plain.encode_special_tokens = True
    pool = ["a", "B", "'s", " ", "  ", "\n", "\t", "\x1c", "\x1f", "é", "é", "́", "12", "!!", "<|endoftext|>",
            " ", "　", "Σ", "İ", "漢", "\U0001f642", "\x85", "'LL", "​", "\x00", "\x01", "\x0b", "\xa0"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 14))) for _ in range(5000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
