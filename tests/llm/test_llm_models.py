"""Learned operators by held-out accuracy, page extraction, and the pipeline against a plain version."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, score string, row string"


def test_language_accuracy_and_rejection(spark):
    out = E.queries()["op3_language_id"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_cases(spark):
    from tidewell.llm.language_id import identify_languages, train_language_model
    texts = {"en": "the of and to in that is was for it with as his on be at by", "de": "der die und den von zu das mit sich des auf ist im dem"}
    rows = [(i, " ".join(texts[lang].split()[(i + k) % 14] for k in range(40)), lang, "s", "r")
            for i in range(60) for lang in ("en", "de")]
    model = train_language_model(spark.createDataFrame(rows, DOC))
    odd = [None, "", "123 ++", "der die das und", "x" * 200_000, "the " * 50_000, "漢字"]
    docs = spark.createDataFrame([(i % 3, t, None, "s", "r") for i, t in enumerate(odd)], DOC).repartition(2)
    got = {r["row"]["text"]: r for r in identify_languages(docs, model, "doc_id", "text", F.struct(*docs.columns).alias("row")).collect()}
    for t in (None, "", "123 ++"):
        assert (got[t]["lang_pred"], got[t]["score"], got[t]["rejected"]) == ("und", 0.0, True)
    assert got["der die das und"]["lang_pred"] == "de" and got["the " * 50_000]["lang_pred"] == "en"
    assert not got["the " * 50_000]["rejected"] and not got["der die das und"]["rejected"]
    assert got["漢字"]["lang_pred"] in ("en", "de")
    # nothing learned: every text is unknown
    nothing = identify_languages(docs, train_language_model(docs)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and len(nothing) == len(odd)


def test_other_scripts_are_rejected_and_clean_rows_stay(spark):
    from tidewell.llm.language_id import identify_languages, train_language_model
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mislabelled = docs.limit(20).withColumn("lang", F.lit("de")).withColumn("doc_id", F.col("doc_id") + 1_000_000)
    model = train_language_model(docs.unionByName(mislabelled))
    foreign = ["Это предложение написано на языке, которого модель не знает", "это", "これは学習していない言語の文章です", "漢字",
               "Αυτό το κείμενο είναι σε άλλη γλώσσα " * 50, "هذا نص بلغة أخرى"]
    other = spark.createDataFrame([(i, t) for i, t in enumerate(foreign)], "doc_id long, text string")
    assert all(r["rejected"] for r in identify_languages(other, model).collect())
    # texts in a language that was not learned are rejected, those in the others are not
    for lang, least in (("fr", 0.9), ("en", 0.6)):
        fewer = train_language_model(docs.where(F.col("lang") != lang))
        rejected = {r["known"]: r["share"] for r in identify_languages(docs, fewer, "doc_id", "text", (F.col("lang") != lang).alias("known"))
                    .groupBy("known").agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
        assert rejected[False] > least and rejected[True] < 0.01
    short = docs.select("doc_id", F.substring_index("text", " ", 6).alias("text")).where(F.col("text").rlike("[a-z]{4}"))
    for frame_, most in ((docs.where(F.length("text") > 100), 0.005), (short, 0.05)):
        out = identify_languages(frame_, model).collect()
        assert sum(r["rejected"] for r in out) <= most * len(out)


def test_kept_columns_may_have_any_name(spark):
    from tidewell.llm.decontaminate import find_contamination
    from tidewell.llm.language_id import identify_languages, train_language_model
    docs = spark.createDataFrame([(1, "a b c d", "src", 5, "x"), (2, None, None, None, "y")], "doc_id long, text string, _src string, _hit int, _letter string")
    items = spark.createDataFrame([(7, "b c")], "item_id long, text string")
    names = ["_src", "_hit", "_letter"]
    out = {r["doc_id"]: r for r in find_contamination(docs, items, *names).collect()}
    assert [out[1][n] for n in names] == ["src", 5, "x"] and [out[2][n] for n in names] == [None, None, "y"] and out[1]["n_hit"] == 2
    model = train_language_model(spark.createDataFrame([], DOC))
    out = {r["doc_id"]: r for r in identify_languages(docs, model, "doc_id", "text", *names).collect()}
    assert [out[1][n] for n in names] == ["src", 5, "x"] and out[2]["lang_pred"] == "und"


def test_toxicity_held_out(spark):
    out = E.queries()["op8_toxicity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(out) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["held_out"] and r["toxic"] is not None]
    right = sum(r["predicted"] == r["toxic"] for r in held) / len(held)
    clean = [r for r in held if r["toxic"] == 0]
    assert right > 0.9 and sum(r["predicted"] == 0 for r in clean) / len(clean) > 0.95


def test_toxicity_chain_equals_brute_force():
    """Marginals by matrix powers over plain runs equal forward-backward over every token."""
    import itertools

    import numpy as np
    from tidewell.llm.toxicity import Chain, ToxicityModel
    model = ToxicityModel(np.arange(3, dtype=np.uint64), np.array([2.0, 4.0, -1.0]), -1.5, np.array([[1.0, -1.0], [-0.5, 0.7]]), 1.0, 0.0)
    token, index, n = np.array([1, 1, 4, 5]), np.array([0, 2, 1, 0]), 8
    emit = np.full(n, model.bias)
    np.add.at(emit, token, model.weights[index])
    total, one = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(emit[i] * v for i, v in enumerate(y)) + sum(model.transitions[a, b] for a, b in zip(y, y[1:])))
        total += w
        one += w * np.array(y)
    at, p = Chain(model).marginals(token, index, n)
    assert at.tolist() == [1, 4, 5] and np.allclose(p, (one / total)[at])


def test_toxicity_cases(spark):
    from tidewell.llm.toxicity import score_toxicity, train_toxicity_model
    before = "red old tall big sad odd dim shy wet raw mad bad".split()
    clean = [f"a {before[i % 12]} quiet day by the {before[i % 7]} sea with boats" for i in range(80)]
    bad = [f"you {before[i % 12]} scoundrel by the {before[i % 5]} sea" for i in range(30)]
    docs = spark.createDataFrame([(i, t, None, "s", "r") for i, t in enumerate(clean + bad)], DOC)
    labels = spark.createDataFrame([(i, 1, int(i >= 80)) for i in range(110)] + [(3, 1, 0), (None, 1, 1), (500, 1, None)],
                                   "doc_id long, quality int, toxic int")
    model = train_toxicity_model(docs, labels)
    odd = [None, "", "what a scoundrel he is", "what a quiet day", "quiet " * 50_000 + "scoundrel", "123 !!"]
    got = [r for r in score_toxicity(spark.createDataFrame([(i, t, None, "s", "r") for i, t in enumerate(odd)], DOC), model)
           .orderBy("doc_id").collect()]
    assert [r["score"] >= 0.5 for r in got] == [False, False, True, False, True, False]
    s = got[2]["spans"]
    assert any(odd[2].encode()[x["start"]:x["start"] + x["length"]] == b"scoundrel" for x in s)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div id="cookie-notice"><p>We use cookies on this site to make it work for you and for us, so read on.</p></div>
<nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
%s
<form><label>Name</label><input name=q></form><div class="comments"><p>I think that this is the best of the articles
that were ever written on the web.</p></div><footer>&copy; us</footer></body></html>"""
BODY = """<h2>A heading</h2><p>The quick &amp; brown fox is one of the animals that were seen in the field<br>by the house on the
hill.</p><p>Short&nbsp; one.<p>It is <b>the second</b> of the paragraphs that are in the text and it has a number of words.
<ul class="share"><li>Tweet</ul><script>x="</p>"</script><p>End."""
TEXT = ["A heading", "The quick & brown fox is one of the animals that were seen in the field by the house on the hill.", "Short one.",
        "It is the second of the paragraphs that are in the text and it has a number of words.", "End."]


@pytest.mark.parametrize("box", ["<article>%s</article>", "<div class='content has-sidebar'>%s</div>", "<main>%s</main>"])
def test_main_text(box):
    from tidewell.llm.html_extract import main_blocks
    assert main_blocks(PAGE % (box % BODY)) == TEXT


def test_empty_svg_hides_no_text():
    from tidewell.llm.html_extract import main_blocks
    for icon in ('<svg class="i"/>', '<SVG viewBox="0 0 1 1" />', "<svg/>"):
        assert main_blocks(f"<p>one {icon}two</p><p>three</p>") == ["one two", "three"], icon
        assert main_blocks(f"<p>one {icon}two <svg><text>no</text></svg>three</p>") == ["one two three"], icon
    assert main_blocks("<p>one <svg class='i'><path d='M0'/>no</svg>two</p>") == ["one two"]
    assert main_blocks("<p>one</p><script src='x'/>no</script><p>two</p>") == ["one", "two"]


def test_pages_cases(spark):
    from tidewell.llm.html_extract import extract_main_text
    pages = [None, "", "plain", "<p", "<article><p>cut off &am", "<article></article>", "<" * 50_000, "<a " * 5_000,
             "<article>" + "<p>" * 20_000 + "x</article>", "<article><p>a</p><p>a</p></article>", "<!-- no end <p>x"]
    df = spark.createDataFrame([(i, p, "old") for i, p in enumerate(pages)], "page_id long, html string, text string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(df).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 4, 5)] == ["", "", "plain", "", "cut off &am", ""]
    assert got[6] == "<" * 50_000 and got[8] == "x" and got[9] == "a\na" and got[10] == ""


def test_page_blocks_are_judged_by_their_words():
    import time
    from tidewell.llm.html_extract import classify, main_blocks, nearest_labels, read_blocks
    prose = "This is a long paragraph of the text that was written for the readers and it has the words that are in all of them."
    plain = "Lorem ipsum dolor amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua"
    links = "<a href=x>one two three four five six seven</a> <a href=y>eight nine ten eleven twelve thirteen fourteen fifteen</a>"
    # no article: density decides, and the short blocks between go with their neighbours
    page = f"<body><div>{links}</div><h2>Menu</h2><div>{links}</div><h1>Title</h1><p>{prose}</p><p>short</p><p>{plain}</p><p>{prose}</p><div>{links}</div></body>"
    assert main_blocks(page) == ["Title", prose, "short", plain, prose]
    kinds = [classify(b) for b in read_blocks(page)]
    assert kinds == [False, None, False, None, True, None, None, True, False]
    # names inside an article drop containers, not its own head or paragraphs
    page = (f"<article><div class='entry-header'><h1>Title</h1></div><p class='tags-intro'>{prose}</p><div class='related-posts'>{prose}</div>"
            f"<p class='advert'>{prose}</p><p>{prose} © 2020</p></article>")
    assert main_blocks(page) == ["Title", prose, prose + " © 2020"]
    # text beside the article, but not the short blocks there
    assert main_blocks(f"<p>skip</p><article><p>x</p></article><div>{prose}</div><p>© me</p>") == ["x", prose]
    assert main_blocks(f"<div><p>{prose} © 2020</p></div><p>© 2020</p>") == [prose + " © 2020"]
    assert nearest_labels([None, True, None, None, False, None]) == [True, True, True, False, False, False]
    assert nearest_labels([False, None, True]) == [False, True, True] and nearest_labels([None]) == [None]
    began = time.time()
    assert len(main_blocks("<body>" + "<li>item</li>" * 50_000 + "</body>")) == 50_000
    assert main_blocks("<div>" * 20_000 + "x" + "</div>" * 20_000) == ["x"]
    assert time.time() - began < 4


def test_pages_equal_their_articles(spark):
    """Every fixture page: the blocks of its article, read off by pattern."""
    import html
    import re
    rows = E.queries()["op7_html_extract"](spark, SF_SMALL).join(
        spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "html"), "page_id").collect()
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*(?:>|$)", "", x.replace("<br>", " "))).split())
                  for x in re.split(r"</?(?:p|h1)>", inner))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_pipeline_equals_plain_version(spark):
    """Stage by stage on the small table: who stays, and with which text."""
    import corpus_pipeline as P
    from test_llm_exact import brute_components, brute_contamination
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = docs.withColumn("row", F.lit("r")).withColumn("found", F.lit(1)).withColumn("clean_text", F.lit(2)).union(
        spark.createDataFrame([(100_001, None, None, None, 0, "r", 1, 2), (None, "the of and to in", None, None, 0, "r", 1, 2),
                               (100_002, "12 34", None, None, 0, "r", 1, 2)],
                              "doc_id long, text string, lang string, source string, n_chars long, row string, found int, clean_text int"))
    stage = dict(P.STAGES)
    first = stage["language_id"](spark, extra, SF_SMALL).cache()
    kept = first.collect()
    assert first.columns == extra.columns and {100_001, 100_002}.isdisjoint(r["doc_id"] for r in kept)
    assert {r["doc_id"] for r in kept} >= {r["doc_id"] for r in docs.collect()}
    second = stage["ngram_jaccard"](spark, first, SF_SMALL).cache()
    named = sorted(kept, key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    want = [r["doc_id"] for i, (r, (_, c)) in enumerate(zip(named, brute_components([r["text"] for r in named], 5, 80, 100))) if c == i]
    assert sorted((r["doc_id"] for r in second.collect()), key=lambda d: (d is None, d)) == want
    third = stage["decontamination"](spark, second, SF_SMALL).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    left = third.collect()
    before = {r["doc_id"]: r["text"] for r in second.collect()}
    hits = dict(zip(before, brute_contamination(before.values(), items)))
    assert {r["doc_id"] for r in left} == {d for d, (n, hit, _) in hits.items() if not hit > 0.8 * n}
    assert all(r["text"] == before[r["doc_id"]] for r in left if not hits[r["doc_id"]][1])
    assert not any(h for _, h, _ in brute_contamination([r["text"] for r in left], items))
    assert all(r["n_chars"] == len(r["text"]) for r in left if r["doc_id"] is not None)
    fourth = stage["pii"](spark, third, SF_SMALL)
    assert fourth.columns == extra.columns and fourth.count() == len(left)
    assert fourth.where(F.col("text").rlike(r"mail\d+\.example\.com")).count() == 0
    last = stage["byte_bpe"](spark, fourth, SF_SMALL).collect()
    assert len(last) == len(left) and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in last)


def test_pipeline_keeps_unrelated_rows_of_one_id(spark):
    import corpus_pipeline as P
    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in ("a", "b", "c"))
    rows = [(7, one, "en", "s", 1), (7, two, "en", "s", 1), (7, two, "de", "s", 1), (None, three, "en", "s", 1), (None, three, "en", "s", 1),
            (3, three + " more", "en", "s", 1), (None, None, "en", "s", 1), (9, one, "en", "s", 1), (11, "", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = P.near_duplicates(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(7, one), (7, two), (3, three + " more"), (None, None), (11, "")], key=str)


def test_pipeline_on_an_empty_table(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), stage(spark, docs, SF_SMALL).schema)
        assert docs.count() == 0
