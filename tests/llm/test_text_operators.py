import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, chat, html_text, toxicity
from tessera.llm.q_text import vocabulary
from tessera.llm.queries import QUERIES, op10_chat


def test_transducer_equals_whole_words():
    rng = random.Random(5)
    for _ in range(1500):
        alphabet = "abc"[: rng.choice([2, 3])]
        vocab = {c: i for i, c in enumerate(alphabet)}
        merges = []
        for _ in range(rng.randrange(1, 14)):
            a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
            if a + b not in vocab:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
        m, sizes = bpe.Merges(vocab, merges), [len(k) for k in vocab]
        ids = [vocab[rng.choice(alphabet)] for _ in range(rng.randrange(1, 80))]
        want = list(ids)
        for a, b in merges:  # brute force: rule by rule over the whole word
            out, i = [], 0
            while i < len(want):
                if want[i : i + 2] == [vocab[a], vocab[b]]:
                    out.append(vocab[a + b])
                    i += 2
                else:
                    out.append(want[i])
                    i += 1
            want = out
        t = bpe.Transducer(m, sizes)
        t.window = m.lookahead + rng.randrange(1, 4)
        got, k = [], 0
        while k < len(ids):
            n = rng.randrange(1, 9)
            got += t.feed(ids[k : k + n])
            assert len(t.held) <= 2 * t.window
            k += n
        assert got + t.finish() == want == m.apply(ids)


def test_ids_and_text_equal_the_librarys(spark, sf, odd_docs):
    from tokenizers import Tokenizer

    ref, tok = Tokenizer.from_file(vocabulary()), bpe.load(vocabulary())
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()] + [r.text or "" for r in odd_docs.collect()]
    texts += ["<|startoftext|>hi<|endoftext|> x<|STARTOFTEXT|>", "it's we'll I'VE", "ΑΣ ΣΑΣ. Σ", "x\x1cy\x85z w　v", "ab" * 40000, "é é 한글"]
    for x in texts:
        e = ref.encode(x, add_special_tokens=False).ids
        ids, said = [], []
        assert tok.encode_decode(x, ids.append, said.append) == len(e)
        assert "".join(ids) == " ".join(map(str, e))
        assert "".join(said) == ref.decode(e, skip_special_tokens=False)
    back = bpe.decode_ids(bpe.encode_ids(odd_docs.select("doc_id", "text"), vocabulary()), vocabulary()).collect()
    assert len(back) == 9


def test_incremental_decoding_of_broken_bytes(tmp_path):
    import json

    spec = json.load(open(vocabulary()))
    spec["decoder"] = {"type": "ByteLevel"}
    (tmp_path / "t.json").write_text(json.dumps(spec))
    tok = bpe.Tokenizer(str(tmp_path / "t.json"))
    euro = "€".encode()
    assert b"".join(tok.bytes_of[tok.first[b]] for b in euro) == euro


def test_chat_round_trip(spark):
    rows = [(1, 1, "assistant", "<|end|>\n&lt; & <b>"), (1, 0, "us|er", "hi <|assistant|>\n"), (1, None, None, None), (None, 0, "user", ""), (1, 1, "assistant", "<|end|>\n&lt; & <b>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = chat.format_chat(df)
    got = {r.conv_id: r for r in out.select("conv_id", "n_turns", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()}
    assert [(t.role, t.text) for t in got[1].t] == [("", ""), ("us|er", "hi <|assistant|>\n"), ("assistant", "<|end|>\n&lt; & <b>"), ("assistant", "<|end|>\n&lt; & <b>")]
    assert got[1].l == "<|end|>\n&lt; & <b>" * 2 and got[None].n_turns == 1
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = "array<struct<type:string,text:string,ref:string,units:int>>"
    df = spark.createDataFrame([(1, 0, "user", None, [("text", "see <", None, None), ("image", None, "s3://a", 2), ("document", None, "d", None)]), (1, 1, "assistant", "ok", None)], f"conv_id long, turn long, role string, text string, parts {parts}")
    r = chat.format_chat(df, parts="parts").first()
    assert r.formatted == "<|user|>\nsee &lt;<|image:1.2|><|document:1.3|><|end|>\n<|assistant|>\nok<|end|>\n"
    assert [(a.turn, a.part, a.type, a.ref, a.tokens) for a in r.attachments] == [(1, 2, "image", "s3://a", 512), (1, 3, "document", "d", 512)] and r.expanded_tokens == 1024


def test_chat_query_has_no_python(spark, sf):
    plan = op10_chat(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><nav>menu</nav></header><div id="cookie-notice">We use cookies</div>
<div class="wrap"><div id="content"><h1>Title &amp; more</h1><p>First&nbsp; para with <a href=x>link</a> text that is long enough.</p>
<ul><li>one item<li>two item</ul><p>Second para <br> after break. 1 < 2 &lt;b&gt;</p><form><input>Send</form></div>
<div class="sidebar"><a>a</a></div><div id="comments"><p>Great read, thanks a lot for this very long reader comment.</p></div></div><footer>c</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "Title & more\nFirst para with link text that is long enough.\none item\ntwo item\nSecond para after break. 1 < 2 <b>"


def test_wrappers_named_after_what_they_lack():
    page = "<body><div class='page has-sidebar comments-open'><main><h1>T</h1><p>Long enough text of the article, as such.</p></main><div class='sidebar'>links</div></div></body>"
    assert html_text.main_text(page) == "T\nLong enough text of the article, as such."
    page = "<body><div class='content-with-sidebar'><p>Long enough text of the article, as such.</p><p>And more of it here.</p></div><div class='menu'>Home</div></body>"
    assert html_text.main_text(page) == "Long enough text of the article, as such.\nAnd more of it here."


@pytest.mark.parametrize(("page", "text"), [(None, ""), ("", ""), ("plain text", "plain text"), ("<p>a", "a"), ("<script>x", ""), ("<!-- x", ""), ('<p a="x>y">z</p>', "z"), ("<div>" * 3000 + "x", "x"), ("<p>a</p><p>b</p>", "a\nb")])
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_fixture_pages(spark, sf):
    """The fixture's pages have one article each: brute force by its tags."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in QUERIES["op3_main_text"](spark, sf).collect():
        a = pages[r.page_id].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        want = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", a)]
        assert r.text == "\n".join(x for x in want if x) and r.n_chars == len(r.text)


def test_toxicity_learns_words_and_their_misspellings():
    rng = random.Random(3)
    words = ["".join(rng.choice(["th", "er", "on", "an", "re", "ing", "ed"]) for _ in range(3)) for _ in range(400)]
    slurs = ["worthless", "disgusting", "pathetic"]

    def text(bad):
        w = [rng.choice(words) for _ in range(rng.randrange(30, 300))]
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(slurs))
        return " ".join(w)

    y = np.array([i % 3 == 0 for i in range(600)])
    m = toxicity.fit([text(b) for b in y], y)
    held = np.array([i % 4 == 0 for i in range(200)])
    s = m.score([text(b) for b in held])
    assert ((s >= 0.3) == held).mean() > 0.97
    assert m.score(["a wortless fool ononer " * 3])[0] > m.score(["a thonan fool ononer " * 3])[0]


def test_toxicity_edges(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (99, None)], "doc_id long, toxic int")
    for docs, n in ((odd_docs, 9), (no_docs, 0)):
        m = toxicity.train(docs, labels)
        got = toxicity.with_score(docs.select("doc_id", "text"), m).collect()
        assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    assert toxicity.with_score(odd_docs.select("doc_id", "text"), toxicity.train(odd_docs, labels.limit(0))).count() == 9
    with pytest.raises(ValueError):
        toxicity.with_score(odd_docs, m)


def test_toxicity_query(spark, sf):
    rows = QUERIES["op1_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)


def test_files_exist():
    assert os.path.exists(vocabulary())


@pytest.mark.parametrize("unit", ['<a "', '<a ">" ""', "<a '>\"", '<div class="x" ', "<!-- ", "<b <", "<b <!", "</b <", "<p>&lt;"])
def test_hostile_pages_take_linear_time(unit):
    import time

    html_text.main_text(unit * 100)
    start = time.process_time()
    html_text.main_text(unit * ((1 << 17) // len(unit)))
    assert time.process_time() - start < 5  # a scan that starts anew at each tag takes a minute


def test_wrapped_articles_and_marked_paragraphs():
    article = "<h1>T</h1><p>Long enough text of the article, as such.</p><p class='legal-history'>A paragraph of legal history.</p><p class=ad-box>Buy.</p><p class='search-results-note'>Notes on results.</p>"
    want = "T\nLong enough text of the article, as such.\nA paragraph of legal history.\nNotes on results."
    form = f"<body><form id=aspnetForm><nav>Home</nav><article>{article}</article><footer>f</footer></form></body>"
    assert html_text.main_text(form) == html_text.main_text(f"<body><article>{article}</article></body>") == want
    assert html_text.main_text("<body><form><p>Long enough text, no article element here.</p></form><nav><a>x</a></nav></body>") == "Long enough text, no article element here."
    assert html_text.main_text("<article><p>Kept text.</p><form><p>Your name</p></form></article>") == "Kept text."
    assert html_text.main_text("<p>A&<i>lt;</i>b &amp;lt;</p>") == "A&lt;b &lt;"


def test_density_decides_without_an_article_element(spark, sf):
    """The fixture's pages with the article's tag made a div or a form: the same texts, where an article is longer than the page's notices."""
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    want = [html_text.main_text(p) for p in pages]
    for open_, close in (("<div>", "</div>"), ("<form><div class=post>", "</div></form>"), ("", "")):
        got = [html_text.main_text(p.replace("<article>", open_).replace("</article>", close)) for p in pages]
        assert all(a == b for a, b in zip(got, want) if len(b) > 200)


def test_extract_edges(spark):
    rows = [(1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, None, None, None), (3, "", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, ""), (1, "a"), (1, "a"), (3, "")]
    assert html_text.extract(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="rename"):
        html_text.extract(df, keep=("page_id", "text"))
