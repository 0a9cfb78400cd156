"""Page text, token files and the two classifiers: round trips, brute force and held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelake.llm import extract, langid, queries, tokens, trees
from carelake.llm.common import held_out

from .conftest import prose


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(queries.vocabulary())


def expected(rows, plain):
    at, out = 0, []
    for doc_id, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_pieces_give_the_ids_of_whole_texts(plain):
    r = random.Random(1)
    signs = ["a", "B", "é", "1", ".", ",", " ", "  ", "\n", "\n\n", "\t", "\xa0", "'s", "'", " '", "\r\n", "\x1c", "\x85",
             "<|endoftext|>", "\0", "😀", "字", "ll", "́", "​", "_", "-", "　"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(4000)] + ["", " a", "a ", "\n", "a \nb"]
    made = tokens.Encoder(queries.vocabulary())(texts)
    for text, ids in zip(texts, made, strict=True):
        assert ids == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_a_word_is_encoded_once_whatever_signs_follow(plain, monkeypatch):
    made = tokens.Encoder(queries.vocabulary())
    words, others = [], []
    encode_words, encode_others = made._encode_words, made._encode_others
    monkeypatch.setattr(made, "_encode_words", lambda new: words.extend(new) or encode_words(new))
    monkeypatch.setattr(made, "_encode_others", lambda new: others.extend(new) or encode_others(new))
    texts = ["Haanth ción\nHaanth, ción. Ωmega ción...\nción!", "ción; (x it's 3rd 漢字. ſ ² ª. Ǆ \nĠ ΐ", "ción Haanth", "Ċ Ġ, ġ a-b .a"]
    for text in texts:
        assert made([text]) == [np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()], text
    assert sorted(w for w in words if w.strip() in ("ción", "Haanth")) == [" Haanth", " ción", "Haanth", "ción"]
    assert {" (x", " it's", " 3rd", " 漢字."} <= set(others) and not any(w.strip(" \n").isalpha() and w.isascii() for w in others)
    assert len(words) == len(set(words))


class Counted(dict):
    lookups = 0

    def get(self, *key):
        self.lookups += 1
        return super().get(*key)


def test_a_distinct_piece_of_a_batch_is_looked_up_once(plain):
    made = tokens.Encoder(queries.vocabulary())
    made.known = Counted()
    texts = ["Haanth ción, thon.\nHaanth thon, ción." * 50, None, "", "thon. " * 100, "a.b@c\u3000d «e f\u2028 g ế\xa0h"]
    want = [np.array(plain.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes() for text in texts]
    assert made([text or "" for text in texts]) == want
    assert made.known.lookups < 40


def test_words_met_again_are_not_forgotten(plain, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 60)
    made = tokens.Encoder(queries.vocabulary())
    words, encode_words = [], made._encode_words
    monkeypatch.setattr(made, "_encode_words", lambda new: words.extend(new) or encode_words(new))
    for batch in range(50):
        fresh = " ".join(f"{chr(97 + batch % 26)}{chr(97 + batch // 26)}{chr(97 + i)}ux" for i in range(9))
        text = f"Haanth thon ción, {fresh} thon"
        assert made([text]) == [np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
        assert len(made.known) < 80
    assert words.count(" thon") == 1 and words.count("Haanth") == 1 and len(words) >= 450


@pytest.mark.parametrize("top", [0, 1, 300, 65_535, 2**32 - 1])
def test_blocks_round_trip(top):
    r = np.random.default_rng(top)
    for n in (1, 127, 128, 129, 1000):
        ids = np.where(r.random(n) < 0.9, r.integers(0, min(top, 50) + 1, n), r.integers(0, top + 1, n)).astype(np.uint32)
        counts = np.array([n // 2, n - n // 2])
        data = tokens.pack(ids, counts)
        got, sizes = tokens.unpack(data)
        assert (got == ids).all() and sizes.tolist() == counts.tolist()
        assert (tokens.unpack(data, 1, 3)[0] == ids[128:384]).all()
    flat = tokens.pack(np.full(12_800, 7, np.uint32), np.array([12_800]))
    assert len(flat) < 1100  # a block of one value is its head alone
    with pytest.raises(ValueError):
        tokens.unpack(b"nope" + flat[4:])


def test_token_files_of_the_small_table(small, scratch, plain):
    docs = small("documents")
    got = sorted(map(tuple, tokens.digest(docs, scratch, queries.vocabulary()).collect()))
    assert got == expected(sorted((r.doc_id, r.text) for r in docs.collect()), plain)


def test_token_files_of_odd_rows(odd, empty, scratch, plain, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT_IDS", 50)
    got = tokens.digest(odd, scratch, queries.vocabulary()).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11, 12]
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert [tuple(r) for r in got] == expected([(r.doc_id, texts[r.doc_id]) for r in got], plain)
    assert tokens.digest(empty, type(scratch)(odd.sparkSession, "none"), queries.vocabulary()).count() == 0


PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li>About</ul></nav><div class="cookie-notice">Cookies</div>
<div id="ad-1" class='ad'>Buy</div><article class="post"><header><h1>Head &amp; line</h1></header><p>One <b>two</b>&nbsp;three<br>
four<p>Five <script>var t="</p>"</script>six {0}<div class="share">Share</div><ul><li>a<li>b</ul><div>Join us</div>
<form><input><p>mail</form><div class=comments><p>nice</div></article><aside>side</aside><footer>f</footer></body></html>"""


def test_structure_of_a_page():
    parsed = extract.lines(PAGE.format("&lt;7"))
    keep, may = extract.content(parsed)
    assert [t for (t, _, _), k in zip(parsed, keep, strict=True) if k] == [
        "Head & line", "One two three four", "Five six <7", "a", "b", "Join us"] or [
        t for (t, _, _), k in zip(parsed, keep, strict=True) if k] == [
        "Head & line", "One two three", "four", "Five six <7", "a", "b", "Join us"]
    assert [t for (t, _, _), m in zip(parsed, may, strict=True) if m] == ["Join us"]
    assert extract.lines(None) == extract.lines("") == [] and extract.lines("<p") == [] and extract.lines("a<b")[0][0] == "a"
    assert [t for t, _, _ in extract.lines("<!-- x <p>no</p> --><p>yes &am <!-- open <p>no")] == ["yes &am"]


def test_longest_common_subsequence():
    r = random.Random(4)
    for _ in range(400):
        a, b = ([r.randint(0, 6) for _ in range(r.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = extract.common(a, b)
        assert len(got) == best[-1][-1] and all(a[i] == b[j] for i, j in got)
        assert all(i < k and j < m for (i, j), (k, m) in zip(got, got[1:], strict=False))


def test_template_lines_go_copies_stay(spark, scratch):
    def page(body):
        return f"<html><body><div>Home Shop Help</div><div>Top</div><p>{body}</p><div>All rights kept</div></body></html>"

    own = "text {} which is its own and long enough for a page"
    rows = [(i, f"http://h.org/a/{i}", page(own.format(i))) for i in range(20)]
    rows += [(3, "http://h.org/a/3", page(own.format(3))), (30, "http://h.org/b/1", page(own.format(7))),
             (100, None, page("nowhere")), (101, "http://h.org/a/7", None), (102, "http://solo.org/x", page("only one")),
             (103, "http://art.org/1", PAGE.format(1)), (104, "http://art.org/2", PAGE.format("2 and more words of its own here")),
             (105, "http://e.org/", "")]
    df = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], "page_id long, url string, html string, key int, host string, nth int")
    got = extract.main_text(df, scratch).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [text[i] for i in range(20)] == [own.format(i) for i in range(20)] and text[30] == own.format(7)
    assert text[100] == "Home Shop Help Top nowhere All rights kept" and text[101] == text[105] == ""
    assert text[102] == "Home Shop Help Top only one All rights kept"
    assert text[104] == "Head & line One two three four Five six 2 and more words of its own here a b"
    assert extract.main_text(df.limit(0), type(scratch)(spark, "none")).count() == 0


def test_template_paragraphs_of_marked_articles_go_quotes_stay(spark, scratch):
    own = "paragraph {0} which nobody else has, long enough for the page number {0} of this host"
    quote = "a line that two pages quote"
    rows = [(i, f"http://art.org/{i}", f"<body><article><h1>Head {i}</h1><p>{own.format(i)}</p>{f'<p>{quote}</p>' if i in (3, 4) else ''}"
             f"<ul><li>Read next</ul><p>Subscribe now</p></article></body>") for i in range(extract.SHARED_BY + 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in extract.main_text(df, scratch).collect()}
    assert text == {i: f"Head {i} {own.format(i)}" + (f" {quote}" if i in (3, 4) else "") for i, _, _ in rows}
    few = {r.page_id: r.text for r in extract.main_text(df.where("page_id < 2"), type(scratch)(spark, "few")).collect()}
    assert few == {i: f"Head {i} {own.format(i)} Read next Subscribe now" for i in range(2)}


def test_languages(small, odd, empty):
    docs = small("documents")
    got = langid.predicted(docs, langid.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.held_out]
    assert unseen and sum(r.lang_pred == r.lang for r in unseen) >= 0.97 * len(unseen)
    strange = langid.predicted(odd, langid.learn(docs)).collect()
    assert len(strange) == odd.count()
    assert {r.doc_id for r in strange if r.lang_pred == "und"} == {4, 5, 6}
    assert {r.lang_pred for r in langid.predicted(odd, langid.learn(empty)).collect()} == {"und"}
    assert langid.predicted(empty, langid.learn(docs)).count() == 0


def test_languages_learn_from_no_held_out_row(small):
    docs = small("documents")
    spoiled = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "wrong").otherwise(F.col("lang")))
    a, b = langid.learn(docs), langid.learn(spoiled)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def test_statistics_do_not_depend_on_the_batch():
    texts = [prose(1, 90), None, "", "A! B? | c\nA! B? | c\n\n x", "é" * 30, " \n ", "one"]
    whole = trees.statistics(pa.array(texts, pa.string()))
    each = np.concatenate([trees.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, each) and np.isfinite(whole).all() and (whole[1] == whole[2]).all()
    named = dict(zip(trees.FEATURES, whole[3], strict=True))
    assert named["repeat_lines"] == pytest.approx(1 / 3) and named["shout"] == pytest.approx(2 / 23)


def test_flat_trees_match_a_walk_by_node():
    r = np.random.default_rng(1)
    x = r.normal(size=(600, len(trees.FEATURES)))
    y = ((x[:, 3] > 0.3) ^ (x[:, 5] < 0)).astype(float)
    forest = trees.fit(x, y, np.ones(600))

    def walk(row):
        total = forest.start
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.feature[node]] <= forest.cut[node] else forest.right[node]
            total += forest.value[node]
        return total

    assert np.allclose(forest.margin(x[:50]), [walk(row) for row in x[:50]])
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.97
    assert (trees.fit(x[:0], y[:0], y[:0]).score(x) == 0.5).all() and (trees.fit(x, y * 0, y + 1).score(x) < 1e-6).all()


def test_quality(small, odd, empty, spark):
    docs, labels = small("documents"), small("labels")
    forest = trees.learn(docs, labels)
    got = trees.scored(docs, forest).join(labels, "doc_id").collect()
    unseen = [r for r in got if r.held_out]
    assert unseen and sum(r.predicted == r.quality for r in unseen) >= 0.9 * len(unseen)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert trees.scored(odd, forest).count() == odd.count() and trees.scored(empty, forest).count() == 0
    none = trees.learn(docs, labels.limit(0))
    assert {r.score for r in trees.scored(odd, none).collect()} == {0.5}
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = trees.learn(docs, flipped)
    assert np.array_equal(forest.value, again.value)


def test_pipeline(spark, small, odd):
    import corpus_pipeline
    from carelake.llm import dart, decontam, mixing, rules
    from carelake.llm.common import Scratch

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "benchmark_passages", "mix", "token_blocks"]
    docs = small("documents")
    folder = "/root/testdata/sf0.001"
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_rules"](spark, docs, folder)
    assert good.columns == docs.columns
    kept = {r.doc_id for r in rules.digest(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    one = stage["near_duplicates"](spark, good, folder)
    firsts = {r.class_id for r in dart.grouped(good, Scratch(spark, "t")).collect()}
    assert {r.doc_id for r in one.collect()} == firsts and one.columns == docs.columns
    clean = stage["benchmark_passages"](spark, one, folder).cache()
    leaked = {r.doc_id for r in decontam.found(one, small("benchmark")).collect()}
    assert {r.doc_id for r in clean.collect()} == firsts - leaked
    mixed = stage["mix"](spark, clean, folder)
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.digest(clean, Scratch(spark, "t")).collect() if r.taken}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == taken
    assert stage["token_blocks"](spark, mixed, folder).count() == mixed.count()
    for _, f in corpus_pipeline.STAGES:  # odd rows go through every stage
        odd = f(spark, odd, folder)
        assert odd.count() >= 1
