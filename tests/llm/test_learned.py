"""Classifiers, rules and page extraction: held-out accuracy, known answers and odd rows."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.check_oracles import compare, connect
from tests.llm.cases import frame, odd_rows, random_text
from wordlode.llm import chars, dom, langid, quality, rules, sitetree, toxic
from wordlode.llm.sample import excerpt, held_out, in_order, labelled_sample

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"
LABELLED = "/root/testdata/sf0.1"  # enough labels of either kind


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


# Characters


def test_each_distinct_word_once():
    texts = ["The cat, the hat.", "", "42 !", "Ünïcode the"]
    points, inside, begin, types, word_text = chars.word_types(texts)
    words = ["".join(map(chr, points[a : b])).strip() for a, b in zip(begin, [*begin[1:], len(points)])]
    assert [words[t] for t in types] == ["the", "cat", "the", "hat", "ünïcode", "the"]
    assert word_text.tolist() == [0, 0, 0, 0, 3, 3]


def test_ngrams_stay_in_words():
    points, inside, _, _ = chars.framed(["ab c"])
    text = "".join(map(chr, points))
    assert text == " ab c "
    for size, want in ((1, ["a", "b", "c"]), (2, [" a", "ab", "b ", " c", "c "]), (3, [" ab", "ab ", " c "])):
        at, _ = chars.ngrams(points, inside, size, 16)
        assert [text[i : i + size] for i in at] == want


def test_hash_tells_orders_apart():
    words = ["xyyx", "yxxy", "abba", "baab", "a", "aa", "aaa"]
    points, _, starts, _ = chars.framed([" ".join(words)])
    ends = starts + np.array([len(w) for w in words])
    assert len(set(chars.word_hashes(points, starts, ends).tolist())) == len(words)


def test_document_frequency_counts_texts_once():
    rnd = random.Random(1)
    texts = [random_text(rnd, rnd.randint(0, 60)) for _ in range(40)] + ["", "..."]
    want = np.zeros(1 << langid.BITS, np.int64)
    for t in texts:
        want[langid._counts(t)[0]] += 1
    assert np.array_equal(langid._frequency(texts), want)


# Samples


def test_sample_is_bounded_and_never_held_out(spark):
    docs = spark.createDataFrame([(i, "text " * (i % 9)) for i in range(400)] + [(None, "x"), (1, "twice")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(3, None), (None, 1), (5, 0)],
                                   "doc_id long, label int")
    got = in_order(labelled_sample(docs, labels, [], 50))
    assert (got["label"].value_counts() <= 50).all() and got["doc_id"].is_unique
    assert all(remainder(d) != 2 for d in got["doc_id"])
    assert got["text"].str.len().between(1, 40).all() and got["text"].str.len().max() == 40
    again = in_order(labelled_sample(docs, labels, [], 50))
    assert got.equals(again)
    flags = docs.select("doc_id", held_out(docs["doc_id"]).alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and remainder(r["doc_id"]) == 2) for r in flags)


def test_excerpt_covers_long_texts(spark):
    texts = ["", "short", "a" * 80, "".join(chr(97 + i % 26) for i in range(10_000))]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in rows.select(excerpt(F.col("text"), 80)).collect()]
    assert got[:3] == texts[:3]
    parts = got[3].split("\n")
    assert [len(p) for p in parts] == [10] * 8 and all(p in texts[3] for p in parts)
    assert parts[0] == texts[3][:10] and parts[-1] == texts[3][-10:]


# Classifiers


def test_long_texts_are_learned_from(spark):
    """All labelled texts are long: models exist, scores differ, no text with letters is unknown."""
    rows = []
    for i in range(80):
        words = "the cat sat on a mat and then it slept" if i % 2 else "der hund und das kind sind nicht zu haus"
        text = f"{words} {'idiot### fool%%%' if i % 2 else 'fine day'} " * 700
        rows.append((i, text, "en" if i % 2 else "de", "s", len(text)))
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, label int")
    learn = docs.select("doc_id", "text", docs["n_chars"].alias("recorded"))
    for scored in (quality.score(docs, quality.train(learn, labels)), toxic.score(docs, toxic.train(docs, labels))):
        got = {r["row"]["doc_id"]: r["result"] for r in scored.collect()}
        assert all((got[i] > 0.5) == (i % 2 == 1) for i in range(80))
    found = langid.predict(docs, langid.train(docs)).collect()
    assert all(r["result"]["lang_pred"] == r["row"]["lang"] for r in found)


def test_one_class_of_labels(spark):
    docs = frame(spark, odd_rows())
    learn = docs.select("doc_id", "text", docs["n_chars"].alias("recorded"))
    for only in (0, 1):
        labels = spark.createDataFrame([(i, only) for i in range(20)], "doc_id long, label int")
        for scored in (quality.score(docs, quality.train(learn, labels)), toxic.score(docs, toxic.train(docs, labels))):
            assert {r["result"] for r in scored.collect()} == {float(only)}


def test_classifiers_take_empty_tables(spark):
    docs = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, label int")
    learn = docs.select("doc_id", "text", docs["n_chars"].alias("recorded"))
    assert quality.score(docs, quality.train(learn, labels)).count() == 0
    assert toxic.score(docs, toxic.train(docs, labels)).count() == 0
    assert langid.predict(docs, langid.train(docs)).count() == 0


def test_language_held_out(spark):
    got = {r["doc_id"]: r for r in queries()["op8_language_id"](spark, BIG).collect()}
    truth = dict(spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect())
    assert set(got) == set(truth)
    aside = [d for d in truth if remainder(d) == 2]
    assert all(got[d]["held_out"] == (remainder(d) == 2) for d in truth)
    assert np.mean([got[d]["lang_pred"] == truth[d] for d in aside]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


@pytest.mark.parametrize("name,label,threshold,least", [
    # There are few bad and very few toxic texts to learn from here.
    ("op9_quality_classifier", "quality", 0.7, (0.9, 0.97)), ("op5_toxicity", "toxic", 0.3, (0.97, 0.7)),
])
def test_classifier_held_out(spark, name, label, threshold, least):
    got = {r["doc_id"]: r for r in queries()[name](spark, LABELLED).collect()}
    truth = dict(spark.read.parquet(f"{LABELLED}/labels.parquet").select("doc_id", label).collect())
    aside = [d for d in truth if remainder(d) == 2]
    for kind in (0, 1):
        assert np.mean([got[d]["predicted"] == truth[d] for d in aside if truth[d] == kind]) > least[kind]
    for d, r in got.items():
        assert r["predicted"] == int(r["score"] >= threshold) and 0 <= r["score"] <= 1
        assert r["held_out"] == (remainder(d) == 2)


def test_classifiers_take_odd_rows(spark):
    rows = odd_rows() + [(100 + i, f"good plain words here {i}", "en", "s", 20) for i in range(40)]
    rows += [(200 + i, f"awful idiot### text%%% {i}", "de", "s", None) for i in range(40)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(100 + i, 1) for i in range(40)] + [(200 + i, 0) for i in range(40)],
                                   "doc_id long, label int")
    model = quality.train(docs.select("doc_id", "text", docs["n_chars"].alias("recorded")), labels)
    scores = quality.score(docs, model).collect()
    assert len(scores) == len(rows) and all(0 <= r["result"] <= 1 for r in scores)
    tox = toxic.train(docs, labels)
    assert len(toxic.score(docs, tox).collect()) == len(rows)
    found = langid.predict(docs, langid.train(docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        if not any(c.isalpha() for c in r["row"]["text"] or ""):
            assert (r["result"]["lang_pred"], r["result"]["score"]) == ("und", 0.0)
    assert found[0]["row"].asDict().keys() == set(docs.columns)


def test_classifiers_without_labels(spark):
    docs, none = frame(spark, odd_rows()), spark.createDataFrame([], "doc_id long, label int")
    assert {r["result"] for r in toxic.score(docs, toxic.train(docs, none)).collect()} == {0.0}
    learn = docs.select("doc_id", "text", docs["n_chars"].alias("recorded"))
    assert {r["result"] for r in quality.score(docs, quality.train(learn, none)).collect()} == {0.5}
    no_lang = docs.where("false").select("doc_id", "text", "lang")
    assert langid.train(no_lang) is None
    assert {r["result"]["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}


def test_factorisation_identity():
    rnd = np.random.default_rng(0)
    rows, feature = np.repeat(np.arange(4), 5), rnd.integers(0, 30, 20)
    value, w, v = rnd.normal(size=20), rnd.normal(size=30), rnd.normal(size=(30, quality.RANK))
    got, _ = quality._margins(4, rows, feature, value, 0.5, w, v)
    for t in range(4):
        f, x = feature[rows == t], value[rows == t]
        pairs = sum(v[f[i]] @ v[f[j]] * x[i] * x[j] for i in range(5) for j in range(i + 1, 5))
        assert got[t] == pytest.approx(0.5 + w[f] @ x + pairs)


def test_unseen_misspelling_shares_ngrams():
    rnd = random.Random(0)
    texts, y = [], []
    for i in range(400):
        words = random_text(rnd, 30).split()
        if i % 2:
            words.insert(rnd.randrange(30), rnd.choice(["stupidity", "stupidly", "stupid", "stupidest"]))
        texts.append(" ".join(words))
        y.append(i % 2)
    embed, used, soft = toxic._train_windows(texts, np.array(y), 3, 20)
    effect = np.zeros(1 << toxic.BITS)
    effect[used] = embed @ (soft[: toxic.DIM, 1] - soft[: toxic.DIM, 0])
    clean, bad = toxic._worst([random_text(rnd, 30), random_text(rnd, 30) + " stupidd"], effect, 0.0)
    assert bad > clean + 1


def test_temperature():
    rnd = np.random.default_rng(1)
    labels = rnd.integers(0, 3, 3000)
    logits = np.eye(3)[labels] * 1.0 + rnd.normal(size=(3000, 3)) * 0.5
    assert langid.fit_temperature(logits * 8, labels) == pytest.approx(8 * langid.fit_temperature(logits, labels), rel=0.1)


def test_weights_are_sparse():
    rnd = np.random.default_rng(2)
    labels = rnd.integers(0, 2, 400)
    examples = [(np.array([y, 2 + rnd.integers(0, 50), 60]), np.ones(3)) for y in labels]
    w = langid.train_ftrl(examples, labels, 2, 61, l1=2.0)
    assert (w[:2] != 0).all() and (w[2:52] == 0).mean() > 0.8


# Rules


def test_rules_on_odd_rows(spark):
    rows = odd_rows()
    got = rules.judge(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_words = {(r["doc_id"], r["n_words"]): r for r in got}
    assert by_words[1, 0]["base_failed"] and not by_words[1, 0]["kept"]
    long = by_words[8, 60_000]
    assert (long["n_repeat_words"], long["word_chars"], long["base_failed"]) == (60_000, 60_000, True)
    assert rules.judge(frame(spark, [])).count() == 0


def test_repeated_words_overlap(spark):
    text = "a b c d e f g h x a b c d e f g h y " + " ".join(map(str, range(10)))
    docs = spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string")
    row = rules.judge(docs).first()
    assert (row["n_words"], row["n_repeat_words"]) == (28, 16)


def test_small_groups_take_the_fence_of_their_language(spark):
    rows = [(i, "word " * 25 + f"w{i}", "en", "big") for i in range(60)]
    rows += [(100, "word### " * 25, "en", "small"), (101, "plain " + " ".join(f"v{i}" for i in range(30)), "en", "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    texts = docs.where("doc_id >= 100 or doc_id < 1")
    bounds = rules.measured(docs).select("row.lang", "row.source", *[
        c.alias(m) for m, c in rules._measures().items()
    ])
    found = {r["source"]: r for r in rules.fences(bounds, 50).collect()}
    assert found["small"]["high_symbol_ratio"] == pytest.approx(0.3)
    assert rules.fences(bounds, 1).where("source = 'small'").first()["high_symbol_ratio"] > 3
    assert texts.count() == 3


def test_rules_match_sql(spark):
    assert compare(spark, connect(SF), "op7_quality_rules", SF) == ""
    assert "op7_quality_rules" in oracle_sql()


def test_rules_run_no_python(spark):
    plan = rules.measured(frame(spark, odd_rows()))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# Pages


def test_very_long_and_no_pages(spark):
    schema = "page_id long, url string, html string, host string, salt int, at long, result string"
    long = "<p>" + "word " * 200_000 + "</p>" + "<div>" * 3000 + "deep"
    rows = [(i, u, h, "x", 1, 2, "r") for i, (u, h) in enumerate([
        ("http://a.b/", long), (None, "<p>x</p>"), ("no host", "<article>y</article>"), ("http://a.b/2", None), ("http://a.b/3", "")])]
    pages = spark.createDataFrame(rows + rows[1:3], schema)
    found = sitetree.main_text(pages).collect()
    got = {r["row"]["page_id"]: r["result"] for r in found}
    assert len(found) == 7 and got[0].split() == ["word"] * 200_000 + ["deep"]
    assert (got[1], got[2], got[3], got[4]) == ("x", "y", "", "")
    assert sitetree.main_text(pages.where("false")).count() == 0


@pytest.mark.parametrize("html,want", [
    ("<div class=ad>x</div><p>a<b>b</b> c &amp; d&nbsp;e<p>f", "ab c & d e f"),
    ("<body><form><p>all in a form</p><select><option>no</select></form>", "all in a form"),
    ("x < y and <b>z", "x < y and z"),
    ("<nav>m</nav><article><header><h1>T</h1></header><p>one<aside>no</aside><div class='comments'><article>c"
     "</article></div></article>after", "T one"),
    ("<header>top</header><main><p>in</p></main><footer>end</footer>", "in"),
    ("<script>if(a<b){'</p>'}</script>t<style>p{}</style><!-- no -->", "t"),
    ("<p title='a>b'>k</p><p>l<!-- unclosed", "k l"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("a<span class='ad'>NO</span>b <a href=x>l</a>ink", "ab link"),
    ("<div role=navigation>n</div><div id='cookie-notice'>c</div><ul><li>1<li>2</ul>", "1 2"),
    ("&lt;p&gt; &#233;&eacute; &unknown;", "<p> éé &unknown;"), ("", ""), (None, ""), ("<p", ""), ("a<br>b", "a b"),
])
def test_blocks_of_a_page(html, want):
    assert " ".join(b.text for b in dom.content(dom.read(html)[0])) == want


@pytest.mark.parametrize("html,want", [
    *[(f"<nav>m</nav><div class='{name}'><h1>T</h1><p>one two</p></div><div class=ad>x</div>", "T one two")
      for name in ("content with-sidebar", "no-sidebar", "has-menu", "no-comments", "search-results")],
    ("<div class='page sidebar'><article><p>one</p></article></div><p>by</p>", "one"),
    ("<div class=widget><p>one two three</p></div><p>by</p>", "one two three by"),
    ("<span class=widget>one two three</span> by", "one two three by"),
    ("<main><div class=widget><p>one two three</p></div><p>by</p></main>", "one two three by"),
    ("<article>one</article><div class=ad>buy two or three</div>", "one"),
    ("<article>card</article><div><p>the main text in a plain element</p></div><article>other</article>",
     "card the main text in a plain element other"),
    ("<article>the main text is here</article><article>card</article><p>by</p>", "the main text is here"),
    ("<article>这是一个很长的正文</article><p>one two three</p>", "这是一个很长的正文"),
    ("<p>the main text</p><div class='nav-menu'>x</div><div id=sidebar>y</div>", "the main text"),
    # What readers wrote stays out, whatever holds it and however long it is.
    ("<article>the text</article><section class='comments'><article>nice one</article></section>", "the text"),
    ("<div class=post>the text</div><section id='comments'><p>a much longer thread of what readers said</p></section>",
     "the text"),
    ("<main><p>the text</p><section id='comments'><p>a much longer thread of what readers said</p></section></main>",
     "the text"),
    ("<article>the text<div id='disqus_thread'><article>a much longer reply to it all</article></div></article>", "the text"),
    ("<p>the main text</p><div class='comments-area'>x</div><div id=main-menu>y</div>", "the main text"),
    ("<div class=site-header>a</div><div class='page-header'>b</div><p>the main text</p>", "the main text"),
    ("<article><div class=header><h1>T</h1></div>text</article>", "T text"),
    # Without other text it is the page.
    ("<div id=comments><p>all there is</p></div>", "all there is"),
])
def test_marks_do_not_take_the_main_text(html, want):
    assert " ".join(b.text for b in dom.content(dom.read(html)[0])) == want


def test_doubtful_names_are_left_to_the_tree(spark):
    rnd = random.Random(4)
    rows = [
        (i, f"https://a.example/{i}", "<div class='content with-sidebar'>"
         f"<p>{random_text(rnd, 30)}</p></div><div class='site-footer'>All rights with us</div>")
        for i in range(20)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in sitetree.main_text(pages).collect():
        body = r["row"]["html"].split("<p>")[1].split("</p>")[0]
        assert r["result"] == body


def test_template_text_is_cut(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(30):
        body = "".join(f"<p>{random_text(rnd, 12)}</p>" for _ in range(rnd.randint(2, 6)))
        rows.append((i, f"https://Site.example/{i}", f"<div class=x{'1'}><div class=tip>Members get more</div>{body}</div>"))
    rows += [(50, None, rows[0][2]), (51, "no host", rows[1][2]), (52, "https://other.example/", rows[2][2]),
             (53, "https://site.example/n", None), (54, "https://site.example/o", "<div class=tip>Members get more</div>")]
    rows += [(i, "https://site.example/copy", rows[3][2]) for i in range(60, 160)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, cut string")
    got = {r["row"]["page_id"]: r["result"] for r in sitetree.main_text(pages).collect()}
    assert len(got) == len(rows)
    for i in [*range(30), *range(60, 160)]:
        assert "Members" not in got[i] and got[i]
    assert got[60] == got[3]
    # Without a site there is nothing to compare with.
    assert all(got[i].startswith("Members get more") for i in (50, 51, 52))
    assert got[53] == "" and got[54] == "Members get more"


def test_importance_follows_the_formula(spark):
    # Ten pages, one path whose text is on all of them: importance (1 - 0.9) * 0 + 0.9 * 0.
    rows = [(i, f"http://h.example/{i}", f"<div><p>same</p><h2>{'abcdefghij'[i]}</h2></div>") for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    cut = sitetree.unimportant(pages).collect()
    root = dom._hash("0/div.")
    assert [r["cut"] for r in cut] == [[dom._hash(f"{root}/p.")]]
    assert math.isclose(sitetree.GAMMA, 0.9)


def test_extraction_query(spark):
    rows = queries()["op4_html_extraction"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert not any(mark in r["text"] for r in rows for mark in ("<article", "track(", "margin:0", "&middot;"))
