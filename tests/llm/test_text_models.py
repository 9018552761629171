"""Scores, rules, URL reputation and HTML text."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from veritab.llm import common, compression_quality, html_text, quality_rules, toxicity, url_reputation
from veritab.llm.models import fit_logistic, fit_tree
from veritab.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, score string, label int"
ODD = [None, "", " ", "\n\n", "one", "ÉCOLE ünïcode", "x" * 60_000, "word " * 3000, "you idiot\x00", "a\tb\x0bc"]
MID = "/root/testdata/sf0.01"


def accuracy(spark, name, label):
    got = QUERIES[name](spark, MID)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{MID}/documents.parquet").count()
    held = [r for r in rows if r["held_out"]]
    assert 0 < len(held) < len(rows) and all(0 <= r["score"] <= 1 for r in rows)
    return sum(r["predicted"] == r[label] for r in held) / len(held)


@pytest.fixture(scope="module")
def odd(spark):
    rows = list(enumerate(ODD)) + [(None, "no id"), (3, "same id"), (4, "one")]
    return spark.createDataFrame([(i, t, "x", 5) for i, t in rows], DOCS), len(rows)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{MID}/labels.parquet")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{MID}/documents.parquet")


# -- scores

def test_toxicity_held_out(spark):
    assert accuracy(spark, "op1_toxicity", "toxic") >= 0.9


def test_quality_held_out(spark):
    assert accuracy(spark, "op3_compression_quality", "quality") >= 0.93


@pytest.mark.parametrize("module", [toxicity, compression_quality])
def test_scores_of_odd_rows(spark, odd, documents, labels, module):
    df, n = odd
    # the odd texts are scored by a model of the tables: union both, look at the odd ones
    both = documents.select("doc_id", "text").unionByName(df.select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    rows = [r for r in module.classify(both, labels).collect() if r["doc_id"] is None or r["doc_id"] >= 10**6]
    assert len(rows) == n and all(0 <= r["score"] <= 1 for r in rows)
    scores = {}
    for r in rows:
        scores.setdefault(r["doc_id"], set()).add(r["score"])
    assert scores[10**6] == scores[10**6 + 1]  # null and empty text
    # without labels, or with one class
    for some in (labels.limit(0), labels.where("quality = 1 and toxic = 0")):
        assert module.classify(df, some).count() == n
    assert module.classify(df.limit(0), labels.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, 1, None), (1, None, None)], "doc_id bigint, quality int, toxic int")
    assert module.classify(df, nulls).count() == n


def test_held_out_rows_are_never_learned_from(spark):
    rows = [(i, f"text {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labelled = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, quality int")
    import zlib

    allowed = {t for i, t in rows if zlib.crc32(str(i).encode()) % 5}
    got = common.training_rows(df, labelled, "quality", 10_000).collect()
    assert {r["text"] for r in got} == allowed
    assert len(common.training_rows(df, labelled, "quality", 7).collect()) == 14


def test_clauses_not_words():
    read = toxicity.reader(toxicity.Lexicon(dict.fromkeys(toxicity.INSULTS, 3.0), {"vequt": 3.0}))

    def strongest(text):
        return read(text)[0]

    assert strongest("a fine day.") == 0
    assert strongest("You are an idiot.") > strongest("What an idiot.") > 0
    assert strongest("You idiot.") > strongest("You are not an idiot.")
    assert strongest("You are an idiot.") > strongest("He said that you are an idiot.")
    assert strongest("I will kill you.") > strongest("They kill time.")
    assert strongest("Idiot, you.") > strongest("Idiot.")
    assert strongest("you vequtas") > 0 and strongest("idiotic") == 0  # a stem; a word needs its end
    assert read("You idiot. You moron! fine.")[2] == 2
    assert read("")[0] == 0


def test_machine_is_the_product_of_its_parts():
    machine = toxicity.grammar()
    assert len(machine.follow) == 3 * 2 * 4 * 4 * 2
    rng = np.random.default_rng(1)
    rules = (toxicity._insult, toxicity._threat, toxicity._target, toxicity._negation, toxicity._report)
    state, parts = 0, [0] * 5
    for x in rng.integers(0, 6, 500).tolist():
        steps = [rule(s, x) for rule, s in zip(rules, parts)]
        assert machine.factor[state][x] == pytest.approx(math.prod(f for _, f in steps))
        state, parts = machine.follow[state][x], [s for s, _ in steps]


def test_small_models():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + 0.1 * rng.normal(size=400) > 0).astype(float)
    assert ((fit_logistic(x, y)(x) > 0.5) == y).mean() > 0.95
    tree = fit_tree(x, (x[:, 1] > 0.3).astype(float))
    assert all((tree(r) > 0.5) == (r[1] > 0.3) for r in x)


# -- rules

def test_rules_against_plain_counts(spark, odd, documents):
    df = documents.select("doc_id", "text").unionByName(odd[0].select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    repeats = spark.createDataFrame([(2 * 10**6 + i, t) for i, t in enumerate(
        ["a b c d e f a b c d e g", "a a a a a a a", "a b c d e a b c d e", "x\nx\n\nx y\nx", "1 2 3 4 5 6 1 2 3 4 5 6 9"])],
        "doc_id bigint, text string")
    df = df.unionByName(repeats)
    text = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
    rows = quality_rules.judge(df).collect()
    assert len(rows) == df.count()
    for r in rows:
        if r["doc_id"] not in (None, 10**6 + 3, 10**6 + 4):  # ids that stand twice
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                    r["base_failed"]) == brute.op6(text[r["doc_id"]]), r["doc_id"]
        assert not (r["base_failed"] and r["kept"]) and r["kept"] is not None
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_rules_keep_good_texts(spark, labels):
    rows = QUERIES["op6_quality_rules"](spark, MID).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.3


def test_rules_are_one_projection(documents):
    plan = quality_rules.judge(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


# -- urls

URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "http://example.com/en/1",
        "http://a.b.example.com/en/", "http://notexample.com/en/", "https://x.net/es/2", "https://x.net/fr", "https://net/fr/",
        "http://x.com?q=/en/", "http://y.org/a://b/c", "://odd/p", "http://ÄÖ.com/ü#z", "http://x.co.uk/a\nb?c"]


def plain_url(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(v, h + p) for v, h, p in [("allow", "com", "/"), ("block", "example.com", "/en/"),
            ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda f: len(f[1]), default=None)


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS + URLS[4:6])], "page_id int, url string, host string, a int")
    none = spark.createDataFrame([], "url string, good int")
    rows = url_reputation.judge(pages, none).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        host, path, rule = plain_url((URLS + URLS[4:6])[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[1])
        assert r["verdict"] == (rule[0] if rule else "allow")
    assert url_reputation.judge(pages.limit(0), none).count() == 0


def test_url_query_covers_the_table(spark):
    rows = QUERIES["op7_url_reputation"](spark, MID).collect()
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{MID}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        host, path, rule = plain_url(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[1])
        assert r["verdict"] == rule[0] if rule else r["verdict"] == ("block" if r["bound"] < url_reputation.FLOOR else "allow")


def test_reputation_shrinks(spark):
    outcomes = [("http://spam.bad.org/", 0)] * 60 + [("http://good.fine.org/", 1)] * 500 + [("http://one.fine.org/", 0)] \
        + [(f"http://h{i}.site{i}.org/", 1) for i in range(40)] + [("http://other.bad.org/", 0)] * 50
    labelled = spark.createDataFrame(outcomes, "url string, good int")
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(
        ["spam.bad.org", "good.fine.org", "one.fine.org", "new.bad.org", "new.fine.org", "unknown.museum"])], "page_id int, url string")
    verdict = {r["host"]: (r["verdict"], r["bound"]) for r in url_reputation.judge(pages, labelled).collect()}
    assert verdict["spam.bad.org"][0] == "block" and verdict["good.fine.org"][0] == "allow"
    assert verdict["one.fine.org"][0] == "allow"  # one bad page among its domain's many good ones
    assert verdict["new.bad.org"][1] < verdict["new.fine.org"][1]
    assert verdict["unknown.museum"][0] == "allow"


# -- html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><p>Site name and slogan</p></header>
<nav><ul><li><a href="/a">Menu</a><li><a href="/b">More</a></ul></nav><div class="cookie-notice">We use cookies &amp; more</div>
<article><header><h1>Title of it</h1></header><p>First   paragraph with <b>bold</b> and <a href=x>a link</a> &eacute;&#233;&lt;tag&gt; here,
on two lines.<br>After the break<script>var x = "<p>no</p>";</script> it goes on.</p><!-- <p>hidden</p> --><div class="ad">Buy now, a lot of words to buy it</div>
<p>Ok.<p>Unclosed paragraph, with a quote &ldquo;x&rdquo; and 1 < 2</article>
<aside>Side bar text</aside><section id="comments"><p>A long reader comment that says a lot about nothing at all, really.</p></section>
<form><label>Name</label><input name=n></form><footer>&copy; somebody</footer></body></html>"""


def test_main_text():
    tree = html_text.trained_tree()
    assert html_text.main_text(PAGE, tree) == (
        "Title of it\nFirst paragraph with bold and a link éé<tag> here, on two lines. After the break it goes on.\nOk.\n"
        "Unclosed paragraph, with a quote “x” and 1 < 2")
    table = html_text.LABELLED
    assert all((tree(row[:-1]) > 0.5) == bool(row[-1]) for row in table)
    plain = "<div><a href=a>one</a> <a href=b>two</a></div><div>" + "Running text of a page without an article element. " * 4 + "</div>"
    assert html_text.main_text(plain, tree) == ("Running text of a page without an article element. " * 4).strip()
    for odd in ("", "<", "<p", "<!--", "<script>x", "</p></div>", "<a href='x>y", "&amp;&bogus;&#xZ;", "<p>" * 3000):
        html_text.main_text(odd, tree)


def test_html_query_restores_the_documents(spark):
    """A page shows a document's lines as its paragraphs."""
    rows = QUERIES["op9_html_text"](spark, MID)
    assert rows.columns == ["page_id", "url", "text", "n_chars"]
    documents = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    rows = rows.collect()
    assert len(rows) == spark.read.parquet(f"{MID}/pages.parquet").count()
    for r in rows:
        number = int(re.search(r"/(\d+)(?:\.html|/)?(?:[?#]|$)", r["url"])[1])
        lines = [" ".join(x.split()) for x in documents[number].split("\n") if x.strip()]
        title, *rest = r["text"].split("\n")
        assert rest == lines and lines[0].startswith(title) and r["n_chars"] == len(r["text"])


def test_html_edges(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (1, "u", "", "t"), (None, "u", PAGE, "t"), (2, "u", PAGE, "t"), (3, "u", "<p>" + "word " * 200_000, "t")],
                                  "page_id bigint, url string, html string, text string")
    rows = html_text.extract(pages).collect()
    assert len(rows) == 5 and [r["text"] for r in rows[:2]] == ["", ""]
    assert rows[2]["text"] == rows[3]["text"] and rows[4]["n_chars"] == 999_999
    assert html_text.extract(pages.limit(0)).count() == 0


LONG = "Running text that a page is about, and that nobody would call a side matter of it. " * 6


@pytest.mark.parametrize("page", [
    '<body class="has-sidebar"><article><h1>Head line</h1><p>{}</article></body>',
    '<html class="menu"><body id="search"><main class="with-comments comments"><h1>Head line</h1><p>{}</main></body>',
    '<body><article class="share"><div class="article-header"><h1>Head line</h1></div><p>{}</article></body>',
    '<div class="content no-sidebar"><h1>Head line</h1><p>{}</div>',
    '<div class="banner widget"><article><h1>Head line</h1><p>{}</article><div class="ad">Buy it now</div></div>',
    '<article><h1>Head line</h1><section id="search-trees"><p>{}</section></article>',
    '<article><h1>Head line</h1><p class="share">{}</article>',
    '<article><p class="share">Share it<h1>Head line</h1><p>{}</article>',
    '<div class="notice">Short notice</div><div class="post"><h1>Head line</h1></div><div class="related"><p>{}</div>'
    '<section id="comments"><article class="comment">Nice words of a reader</article></section>',
])
def test_names_do_not_decide_alone(page):
    assert html_text.main_text(page.format(LONG), html_text.trained_tree()) == "Head line\n" + LONG.strip()


def test_short_named_boxes_are_left_out():
    page = ('<body class="has-sidebar"><div class="cookie-notice">We use cookies</div><article><p>{0}<div class="ad">Buy it now</div><p>{0}'
            '<article class="comment"><p>Nice words of a reader</article></article><div id="comment-list"><p>So it is, he said</div></body>')
    assert html_text.main_text(page.format(LONG), html_text.trained_tree()) == f"{LONG.strip()}\n{LONG.strip()}"


@pytest.mark.parametrize("before", [
    "<button>Menu", "<svg><path d='M0 0'>", "<select><option>One<option>Two", "<iframe src=x>", "<math><mi>x", "<object data=x>",
    "<template>", "<noscript>", "<title>Site", "<button>One <button>Two</button>", "<svg><!-- </svg> <p> --><script>'<p></svg>'</script>",
])
def test_unclosed_elements_end_at_the_next_block(before):
    page = f"<body>{before}<article><h1>Head line</h1><p>{LONG}</article><form><button>Send</button></form>"
    assert html_text.main_text(page, html_text.trained_tree()) == "Head line\n" + LONG.strip()


def test_closed_elements_end_where_they_did():
    inner = "<svg><svg><p>no</p></svg><p>no</p></svg><template><div><p>no</div></template><button/><select><option>no</select>"
    page = f"<article>{inner}<p>{LONG}<textarea><p>no</button></p></textarea></article><script>var x = '{LONG}'"
    assert html_text.main_text(page, html_text.trained_tree()) == LONG.strip()
    for name in ("textarea", "style"):  # raw text without an end runs to the end of the page
        assert html_text.main_text(f"<article><p>{LONG}</p><{name}><p>{LONG}", html_text.trained_tree()) == LONG.strip()


def test_a_listed_word_that_is_also_a_stem_starts_clauses_of_its_forms():
    listed = dict.fromkeys(toxicity.INSULTS, 3.0)
    for word, form in (("idiot", "idiotic"), ("idiot", "idioten"), ("trash", "trashy"), ("crush", "crusher")):
        read = toxicity.reader(toxicity.Lexicon(listed, {word: 2.5}))
        assert word in listed or word in toxicity.THREATS
        assert read(f"a {form} plan.")[0] > 0 and read(f"a {form} plan.")[2] == 1
        assert read(f"you {word}")[0] > 0 and read(f"x{form}")[0] == 0
    assert toxicity.reader(toxicity.Lexicon(listed, {}))("an idiotic plan")[0] == 0


def test_quality_orders_texts_by_the_size_difference(documents, labels):
    """Also beyond the length of any labelled text."""
    model = compression_quality.fit(documents.select("doc_id", "text"), labels)
    measure = compression_quality.measurer(model.good, model.bad, model.raw)
    texts = documents.select("text").union(documents.limit(20).select(F.repeat("text", 60).alias("text")))
    rows = texts.select("text", compression_quality.score(F.col("text"), model).alias("score")).collect()
    found = sorted((float(np.ravel(measure(r["text"]))[0]), r["score"]) for r in rows)
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(found, found[1:])) and found[0][1] < 0.3 < found[-1][1]


def test_a_host_of_bad_pages_is_blocked_in_an_even_corpus(spark):
    pages = spark.range(400).crossJoin(spark.range(100).withColumnRenamed("id", "n")).select(
        F.format_string("http://w%d.d%d.org/%d", F.col("id") % 2, F.col("id"), F.col("n")).alias("url"), (F.col("n") < 74).cast("int").alias("good"))
    planted = spark.range(300).select(F.format_string("http://bad.planted.org/%d", "id").alias("url"), F.lit(0).alias("good"))
    outcomes = pages.unionByName(planted)
    judged = url_reputation.judge(outcomes.select(F.lit(1).alias("page_id"), "url"), outcomes).groupBy("host", "verdict").count()
    assert [(r["host"], r["count"]) for r in judged.where("verdict = 'block'").collect()] == [("bad.planted.org", 300)]
    for mean in (0.5, 0.74, 0.9, 0.999):  # whatever the parent
        strong = url_reputation.STRONGEST
        bound = spark.range(1).select(url_reputation.optimistic(F.lit(mean * strong), F.lit((1 - mean) * strong + 200))).first()[0]
        assert bound < url_reputation.FLOOR


@pytest.mark.parametrize("host, domain, suffix", [
    ("www.example.com", "example.com", "com"), ("a.co.in", "a.co.in", "co.in"), ("x.b.co.in", "b.co.in", "co.in"),
    ("shop.site.com.br", "site.com.br", "com.br"), ("example.com:8080", "example.com", "com"),
    ("user@www.example.org:80", "example.org", "org"), ("10.0.0.1", "10.0.0.1", "10.0.0.1"),
    ("192.168.0.1:81", "192.168.0.1", "192.168.0.1"), ("[::1]:80", "[::1]", "[::1]"), ("localhost", "localhost", "localhost"),
    ("", "", ""), ("co.uk", "co.uk", "co.uk"), ("www.company.de", "company.de", "de"),
])
def test_registered_domains(spark, host, domain, suffix):
    h = F.lit(host)
    assert tuple(spark.range(1).select(url_reputation.domain_of(h), url_reputation.suffix_of(h)).first()) == (domain, suffix)


def test_reputation_plans_no_cross_join(spark):
    outcomes = spark.createDataFrame([("http://a.b.co.uk/1", 1), ("http://10.0.0.1:80/2", 0)], "url string, good int")
    judged = url_reputation.judge(outcomes.select(F.lit(1).alias("page_id"), "url"), outcomes)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert judged.count() == 2


# -- pages whose elements mislead

RUNNING = "Long running words of the article follow here and go on for quite some time so that nobody doubts it. " * 3


@pytest.mark.parametrize("page, lines", [
    (f'<form id="aspnetForm"><nav><a href=x>Home</a></nav><div><p>{RUNNING}</p><p>{RUNNING}</p></div><footer>Foot</footer></form>',
     [RUNNING, RUNNING]),
    (f"<form><article><h1>Title</h1><p>{RUNNING}</p></article></form>", ["Title", RUNNING]),
    (f"<dialog open><article><p>{RUNNING}</p></article></dialog>", [RUNNING]),
    (f"<fieldset><main><p>{RUNNING}</p></main><form>Search here</form></fieldset>", [RUNNING]),
    (f"<body><header><h1>Title</h1><p>{RUNNING * 3}</p></header><footer>Foot</footer>", ["Title", RUNNING * 3]),
    (f"<body><form><input>Search the site</form><div><p>{RUNNING}</p><p>{RUNNING}</p></div>", [RUNNING, RUNNING]),
    # quotes outside a value, a value without an end
    (f'<article><p class="a"">First</p><p data-x=it\'s>Second {RUNNING}</p><p>Third</p></article>', ["First", "Second " + RUNNING, "Third"]),
    (f"<article><p title='a > b' data-y = \"c > d\">{RUNNING}</p></article>", [RUNNING]),
    (f"<article><p>{RUNNING}</p></article><p class='never", [RUNNING]),
    # a menu inside the article goes, a link between texts stays
    (f"<article><p>{RUNNING}</p><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li><li><a href=c>Three</a></li></ul>"
     f"<p>{RUNNING}</p></article>", [RUNNING, RUNNING]),
    (f"<article><p>{RUNNING}</p><p><a href=a>A link of eight words in the text</a></p><p>{RUNNING}</p></article>",
     [RUNNING, "A link of eight words in the text", RUNNING]),
    # a sidebar stays out, even a long one beside a short article
    (f"<main><p>{RUNNING}</p></main><aside><p>{RUNNING * 4}</p></aside>", [RUNNING]),
])
def test_elements_around_the_article(page, lines):
    want = "\n".join(" ".join(line.split()) for line in lines)
    assert html_text.main_text(page, html_text.trained_tree()) == want


def test_unclosed_tags_take_linear_time():
    import time

    tree = html_text.trained_tree()
    start = time.process_time()
    for page in ("<a " * 350_000, "<p>x</p>" + "<a " * 350_000, '<a href="x ' * 90_000 + ">", "<div class='" * 90_000 + ">", "<!-" * 350_000,
                 "<p>" * 350_000):
        html_text.main_text(page, tree)
    assert time.process_time() - start < 12


def test_a_long_text_without_marks_scores_in_linear_time():
    import time

    read = toxicity.reader(toxicity.Lexicon(toxicity._listed(), {}))
    text = "you are an idiot, " + "some words and an idiot; " * 120_000   # 3 MB, a clause end a hit
    start = time.process_time()
    scores = read(text)
    assert time.process_time() - start < 8 and scores[2] == 120_001 - 1
    assert read("no hit. " * 10 + "you idiot") [2] == 1
