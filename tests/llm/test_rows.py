"""Operators that look at one row at a time, against plain Python."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from bedfeed.llm import html, pii, quality, secrets, token_counts
from bedfeed.llm.automaton import Automaton, Rule


def test_secrets(docs, texts):
    rows = secrets.secret_spans(docs).select("doc_id", secrets.span_text(F.col("spans")).alias("spans")).collect()
    assert {r.doc_id: r.spans for r in rows} == {i: brute.secrets(t or "", secrets.RULES) for i, t in texts}


def test_secrets_of_random_texts():
    random.seed(3)
    automaton = secrets.compiled(secrets.RULES)
    parts = [
        "password", "PassWd", "token", "secret", "api_key", "apikey", '"', "'", " ", "  ", ":", "=", "AKIA", "AKI", "A", "0f", "a1b2c3d4e5f60718", "ABCDEFGHIJKLMN",
        "é", "ghp_", "x" * 36, "-----BEGIN RSA PRIVATE KEY-----", "xoxb-", "123456789012", "\n", ".", "sk_live_", "abcdefghijklmnop",
    ]
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        found = ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in secrets.scanned(automaton, text.encode()))
        assert found == brute.secrets(text, secrets.RULES), text


def test_rules_that_cannot_be_told_apart():
    with pytest.raises(ValueError, match="more than one way"):
        Automaton((Rule("x", "a[ab]*", "[ab]", 1),))


def test_quality(docs, texts):
    rows = quality.quality_rules(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r.doc_id: tuple(r[n] for n in names) for r in rows} == {i: brute.figures(t or "") for i, t in texts}
    assert all(not r.kept for r in rows if r.base_failed)
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in rows if r.kept)


def test_hosts(spark):
    good, odd = " ".join(f"word{i}" for i in range(60)), " ".join(f"wording{i} ** |" for i in range(60))
    rows = [(i, odd if i < 40 or i % 10 == 0 else good, "bad" if i < 50 else f"good{i % 7}", 0) for i in range(300)]
    docs = spark.createDataFrame([*rows, (900, odd, "small", 0), (901, odd, None, 0)], "doc_id long, text string, source string, n_chars long")
    out = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert [out[i].kept for i in (0, 45, 50, 51, 901)] == [False, True, True, True, True]
    assert out[0].host_rules == ["many_symbols"] and out[45].host_rules == ["many_symbols"] and out[50].host_rules == []
    rates = {r.source: r for r in quality.host_rates(quality.measured(docs)).collect()}
    assert rates["small"].rate_many_symbols == 1 and rates["small"].shrunk_many_symbols < rates["bad"].shrunk_many_symbols


def test_personal_data(docs, texts):
    rows = pii.span_texts(pii.personal_spans(docs)).collect()
    assert {r.doc_id: r.base for r in rows} == {i: brute.personal(t or "") for i, t in texts}


def test_personal_data_of_odd_texts(spark):
    random.seed(5)
    parts = ["a", "b.c", "@", ".", "com", "1", "23", "255", "256", "0012", "4000000000000002", "-", " ", "+1", "(", ")", "%", "\n", "é", "_", "9999"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 16))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = pii.span_texts(pii.personal_spans(docs)).collect()
    assert {r.doc_id: r.base for r in rows} == {i: brute.personal(t) for i, t in enumerate(texts)}


def test_identifiers_found_by_context(spark):
    texts = [f"Dear all, customer reach me {x} or not" for x in ("ann@a.org", "bob@b.org", "1.2.3.4", "eve@c.org", "dan1@d.org", "k9@e.org", "joe4@f.org", "z1@g.org", "8.8.8.8", "9.9.9.9")]
    texts = [t.replace("@a.org", "1@a.org").replace("bob", "b0b").replace("eve", "ev3") for t in texts] + ["please reach me ID-77123-X today", "nothing about model X-90210 here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.span_texts(pii.personal_spans(docs)).collect()}
    assert spans[10] == "context:16:26" and spans[11] == ""
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert clean[10] == "please reach me <CONTEXT> today" and clean[11] == texts[11]
    assert clean[2] == "Dear all, customer reach me <IP> or not"


@pytest.mark.parametrize("seeds", [
    [f"{n}@{d}.org" for n in ("ann", "bob", "eve") for d in "ab"],
    ["4000 0000 0000 0002", "4000 0000 0000 0010", "4000 0000 0000 0028", "4000 0000 0000 0036", "4000 0000 0000 0044", "4000 0000 0000 0051"],
    [f"+1 (555) 010 999{i}" for i in range(6)],
])
def test_all_exact_forms_are_seeds(spark, seeds):
    assert all(brute.personal(x).count(":") == 2 for x in seeds)
    texts = [f"Dear all, customer reach me {x} or not" for x in seeds] + ["please reach me ID-77123-X today", "nothing about model X-90210 here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.span_texts(pii.personal_spans(docs)).collect()}
    assert spans[len(seeds)] == "context:16:26" and spans[len(seeds) + 1] == ""


def test_identifiers_of_the_shapes_of_seeds(spark):
    long = "w" * 80
    seeds = [f"{n}@{d}.org" for n in ("ann", "bob", "eve", "dan") for d in "abc"]
    texts = [f"please {w} {x} today" for w in ("reach me", "ask unit7", f"{long} me") for x in seeds]
    found = ["please reach me 555 010 9999 today", "please reach me bob@intranet today", "please ask unit7 ID-77123-X today", f"please {long} me ID-77123-X today"]
    not_found = ["it took 555 010 9999 years", "nothing for bob@intranet today", "please " + "w" * 90 + " me ID-77124-X today"]
    docs = spark.createDataFrame(list(enumerate(found + not_found + texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.span_texts(pii.personal_spans(docs)).collect()}
    assert [spans[i] for i in range(7)] == ["context:16:28", "context:16:28", "context:17:27", "context:91:101", "", "", ""]


def test_redaction_of_overlapping_spans(spark):
    text = "é +1 (555) 010-9999 x 10.0.0.1@b.com end"
    docs = spark.createDataFrame([(1, text, 5), (2, None, 0), (2, "", 0)], "doc_id long, text string, n_chars long")
    rows = pii.redacted(docs).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in rows} == {(1, "é <PHONE> x <EMAIL> end", 23), (2, None, None), (2, "", 0)}


def test_token_counts(docs, texts):
    vocabulary = token_counts.loaded(token_counts.VOCABULARY)
    rows = {r.doc_id: r for r in token_counts.token_counts(docs).collect()}
    for i, t in texts:
        words = (t or "").lower().encode().split()
        assert (rows[i].n_words, rows[i].n_tokens, rows[i].n_unknown) == (len(words), sum(map(vocabulary.count, words)), 0)


def test_pieces():
    random.seed(7)
    for _ in range(400):
        vocabulary = {bytes(random.choice(b"abc") for _ in range(random.randint(1, 5))) for _ in range(random.randint(1, 8))}
        trie = token_counts.Pieces(vocabulary)
        for _ in range(30):
            word = bytes(random.choice(b"abcd") for _ in range(random.randint(0, 10)))
            assert trie.count(word) == brute.pieces(vocabulary, word)


def test_pieces_that_end_words():
    random.seed(8)

    def drawn():
        return {bytes(random.choice(b"abc") for _ in range(random.randint(1, 4))) for _ in range(random.randint(1, 8))}

    for _ in range(400):
        inner, final = drawn(), drawn()
        trie = token_counts.Pieces(inner, final)
        marked = {tuple(p) for p in inner} | {(*p[:-1], (p[-1], "</w>")) for p in final}
        for _ in range(30):
            word = bytes(random.choice(b"abc") for _ in range(random.randint(1, 10)))
            assert trie.count(word) == brute.pieces(marked, (*word[:-1], (word[-1], "</w>")))


def test_marks_of_the_given_vocabulary():
    import json

    with open(token_counts.VOCABULARY, encoding="utf-8") as file:
        vocabulary = set(json.load(file)["model"]["vocab"])

    def greedy(word):
        at, count = 0, 0
        while at < len(word):
            at = next(e for e in range(len(word), at, -1) if word[at:e] + "</w>" * (e == len(word)) in vocabulary)
            count += 1
        return count

    pieces = token_counts.loaded(token_counts.VOCABULARY)
    words = ["via", "viaduct", "their", "theirx", "tonight", "tonightq", *random.Random(9).sample(sorted(w.removesuffix("</w>") for w in vocabulary if w.isascii() and w.removesuffix("</w>").isalpha()), 2000)]
    assert [pieces.count(w.encode()) for w in words] == [greedy(w) for w in words]
    assert (pieces.count(b"tonight"), pieces.count(b"tonightq")) == (1, 3)


PAGES = {
    "": "",
    "<p>a": "a",
    "<article><h1>T &amp; U</h1><p>a\n  b<br>c<p><b>d</b>e</article><footer>f</footer>": "T & U\na b c\nde",
    "<nav>n</nav><article><header><h1>T</h1></header><p>x<div class='share'>s</div><aside>no</aside><p>e &am; f</article>": "T\nx\ne &am; f",
    "<article><p>1 < 2<script>if (a<b) {'</p>'}</script><p>ok<!-- <p>no --></article>": "1 < 2\nok",
    "<div id=menu><a>Home</a></div><div class=content><h2>Title</h2><p>Long text, with commas, and dots. It goes on for a while.</p><p>Short.</p>"
    "<ul><li>One item</li></ul><p>Another paragraph, with much more text; it ends here.</p></div><div class='comments'><p>nice!</p></div>":
    "Title\nLong text, with commas, and dots. It goes on for a while.\nShort.\nOne item\nAnother paragraph, with much more text; it ends here.",
    "<p>unclosed <b attr='x": "unclosed <b attr='x",
}


def test_pages(spark):
    rows = [(i, "u", h, "t", 1) for i, h in enumerate(PAGES)] + [(100, None, None, "t", 1), (0, "u", "", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    out = html.extracted(pages).collect()
    assert sorted((r.page_id, r.text) for r in out) == sorted([*enumerate(PAGES.values()), (100, ""), (0, "")])
    assert all(r.n_chars == len(r.text) for r in out)
    assert html.extracted(pages.limit(0)).collect() == []


def test_articles_of_the_given_pages(spark):
    """The given pages have one article each, so its blocks are known from the markup alone."""
    import re
    from html import unescape

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r.text for r in html.extracted(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    for r in rows:
        blocks = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in blocks]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


PARAS = [f"Paragraph {i} of the text, which is long enough; it has commas, marks, and some more words to read." for i in range(6)]
BODY = "".join(f"<p>{x}</p>" for x in PARAS)
SIDES = {
    # Article elements around teasers do not outweigh the text beside them.
    "teasers": (f"<div class=text><h1>T</h1>{BODY}</div>" + "<article class=teaser><h3>More</h3><p>Short one.</p></article>" * 3, ["T", *PARAS]),
    # Blocks behind the last long paragraph.
    "tail": (f"<body><div class=text><h1>T</h1>{BODY}<ul><li>a</li><li>b</li></ul><pre>x = 1</pre></div><div>Imprint</div></body>", ["T", *PARAS, "a", "b", "x = 1"]),
    "tail of a body": (f"<body><h1>T</h1>{BODY}<ul><li>a</li></ul><div>Imprint</div></body>", ["T", *PARAS, "a"]),
    "one long block outside": (f"<article><h1>T</h1>{BODY}</article><div>" + "Terms, and more terms. " * 80 + "</div>", ["T", *PARAS, ("Terms, and more terms. " * 80).strip()]),
    "main": (f"<main><h1>T</h1><ul><li>a</li></ul>{BODY}<blockquote><p>q</p></blockquote><div class=related><p>r</p></div></main><p>o", ["T", "a", *PARAS, "q"]),
}
WORDS = {
    "category": (f'<article class="post category-discussion"><h1>T</h1>{BODY}</article><div class=comments><p>Nice!</p></div>', ["T", *PARAS]),
    "open": (f'<article class="post comments-open"><h1>T</h1>{BODY}</article>', ["T", *PARAS]),
    "frame": (f'<div id=page class="site comments-open"><article><h1>T</h1>{BODY}</article><div class=comments><p>Nice!</p></div></div>', ["T", *PARAS]),
    "state": (f'<div id=page class="site share-enabled"><div><h1>T</h1>{BODY}</div><div class=share>Like</div></div>', ["T", *PARAS]),
    "layout": (f'<div class="layout-sidebar-right"><div><h1>T</h1>{BODY}</div><div class=sidebar>Links</div></div>', ["T", *PARAS]),
    "unknown state": (f'<div class="page-social-widget"><div><h1>T</h1>{BODY}</div><div class=sidebar>Links</div></div>', ["T", *PARAS]),
    "header": (f"<article><div class=article-header><h1>T</h1><p>Lead.</p></div>{BODY}</article>", ["T", "Lead.", *PARAS]),
    "inline": (f"<div><h1>T</h1>{BODY}<p>Read <span class=share>Like</span> on, and on; it is <b>not</b> over.</p></div>", ["T", *PARAS, "Read on, and on; it is not over."]),
    "comments": (f"<div class=text><h1>T</h1>{BODY}</div><div class=comments>" + "<p>A comment, rather long, and with marks. Yes!</p>" * 30 + "</div>", ["T", *PARAS]),
}


@pytest.mark.parametrize("name", SIDES)
def test_article_elements_and_ends_of_texts(name):
    assert html.main_text(SIDES[name][0]).split("\n") == SIDES[name][1]


@pytest.mark.parametrize("name", WORDS)
def test_words_for_what_is_beside_the_text(name):
    assert html.main_text(WORDS[name][0]).split("\n") == WORDS[name][1]


def test_texts_meet_their_cuts_by_one_plan_at_all_sizes(spark):
    """A few cuts are not broadcast: a plan that changes with the size grows in a step."""
    docs = spark.createDataFrame([(1, "write to ann@example.org"), (2, "nothing here")], "doc_id long, text string")
    out = pii.redacted(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r.doc_id: r.text for r in out.collect()} == {1: "write to <EMAIL>", 2: "nothing here"}
