"""HTML extraction, chat formatting, URL rules and the classifiers on small tables of edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panel_edit.llm import chat, html_text, quality, queries, toxicity, url_rules

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("source,want", [
    (None, ""), ("", ""), ("plain  text\n &eacute;", "plain text é"), ("<p>a<p>b&nbsp;&lt;c&gt;", "a\nb <c>"),
    ("<script>var x='</p>';</script><style>p{}</style>", ""), ("<!-- <p>x</p> -->y", "y"), ("<div hidden>no</div><p>yes</p>", "yes"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2\n3"), ("<p>one<br>two</p>", "one two"), ("a < b and <3", "a < b and <3"),
])
def test_main_text_of_small_sources(source, want):
    assert html_text.main_text(source) == want


ARTICLE = ["A title that is long enough", "First paragraph of the article, with some words in it.", "Second one, which is a little longer than the first & last."]


@pytest.mark.parametrize("wrap", [
    "{0}", '<header><h1>Site</h1></header>{0}<div class="sidebar"><p>Side text that is long and boring, really quite long.</p></div>',
    '<div id="cookie-notice"><p>We use cookies, and so do you, and they are many.</p></div>{0}<form><p>Your name and your address here</p></form>',
    '{0}<section class="comments"><article class="comment"><p>Great post, I liked it a lot, thank you so much for it!</p></article></section>',
    '<div class="layout has-sidebar">{0}<aside>Other things to read about on this site</aside></div>',
    '<ul class="menu"><li><a href="/a">One</a><li><a href="/b">Two</a></ul>{0}<p class="advert">Buy this thing now, it is cheap and it is good.</p>',
])
def test_article_without_its_surroundings(wrap):
    inner = f"<h1>{ARTICLE[0]}</h1><p><b>{ARTICLE[1]}<br><p>{ARTICLE[2].replace('&', '&amp;')}</p>"
    page = f"<!DOCTYPE html><html><head><title>t</title></head><body><nav><a href=/>Home</a></nav>{wrap.format(f'<article>{inner}</article>')}<footer>&copy; us</footer>"
    assert html_text.main_text(page).split("\n") == ARTICLE


def _blocks(tag, n, chars):
    return [f"{k} " + "word " * (chars // 5) for k in range(n)], "".join(f"<{tag}>{k} {'word ' * (chars // 5)}</{tag}>" for k in range(n))


@pytest.mark.parametrize("page", ["<article>{0}</article>", "<main><div>{0}</div></main>", "<div class=post>{0}</div>"])
def test_parts_beside_the_densest_belong_to_the_article(page):
    """Sections of long and of short paragraphs, and a heading beside the div of the text."""
    (a, long), (b, short) = _blocks("p", 10, 200), _blocks("p", 8, 60)
    nav = "<nav><a href=/>Home</a></nav><div><a href=/a>One more thing</a> <a href=/b>and another</a></div>"
    got = html_text.main_text(f"<body>{nav}{page.format(f'<section>{long}</section><section>{short}</section>')}<footer>us</footer></body>")
    assert got.split("\n") == [x.strip() for x in [*a, *b]]
    got = html_text.main_text(f"<body>{nav}{page.format(f'<h1>A title</h1><div>{long}</div>')}<footer>us</footer></body>")
    assert got.split("\n") == ["A title", *(x.strip() for x in a)]


BODY = "".join(f"<p>{x.replace('&', '&amp;')}</p>" for x in ARTICLE)


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "elementor-widget", "skip-lazy", "with-header", "noComments isModal", "widget"])
def test_class_words_that_only_describe_the_layout_drop_nothing(name):
    assert html_text.main_text(f'<body><nav><a href=/>Home</a></nav><div class="{name}">{BODY}</div>').split("\n") == ARTICLE
    assert html_text.main_text(f'<body><article><div id="{name}">{BODY}</div></article><div class="sidebar">{BODY * 9}</div>').split("\n") == ARTICLE


@pytest.mark.parametrize("name", ["site-footer", "sidebar", "sidebar-left", "cookie-notice", "comments", "commentList", "ad-slot-2", "main_nav"])
def test_class_tokens_made_of_dropped_words_still_drop(name):
    assert html_text.main_text(f'<body><div>{BODY}</div><div class="x {name}"><p>Something else, of about as many words as the rest has.</p></div>').split("\n") == ARTICLE


def test_where_nothing_would_be_left_text_stays():
    part = '<div class="widget"><p>A third of the text of this page</p></div>'
    assert html_text.main_text(f"<body>{part * 3}") == "\n".join(["A third of the text of this page"] * 3)
    assert html_text.main_text(f'<body><div class="cookie-notice">{BODY}</div>') == ""


def test_formulas_belong_to_the_text():
    source = "<article><p>So <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></semantics></math> holds.</p></article>"
    assert html_text.main_text(source) == "So x=2 holds."


def paragraphs(n, size, word):
    return "".join(f"<p>{word}{i} " + "lorem ipsum dolor " * (size // 18) + "</p>" for i in range(n))


def lines(n, size, word):
    return [f"{word}{i} " + " ".join(["lorem ipsum dolor"] * (size // 18)) for i in range(n)]


LONG, MORE, SHORT = (paragraphs(8, 200, "a"), lines(8, 200, "a")), (paragraphs(8, 200, "b"), lines(8, 200, "b")), (paragraphs(6, 36, "c"), lines(6, 36, "c"))
MENU = '<div><a href="/1">one</a> <a href="/2">two</a> <a href="/3">three</a></div>'


@pytest.mark.parametrize("page,want", [
    (f"<body><div>{LONG[0]}</div><p>Yes.</p><div>{MORE[0]}</div></body>", [*LONG[1], "Yes.", *MORE[1]]),
    (f"<body>{MENU}<div>{LONG[0]}</div><div>{SHORT[0]}</div>{MENU}</body>", [*LONG[1], *SHORT[1]]),
    (f"<body><div>{LONG[0]}</div>{MENU}<div>{MORE[0]}</div></body>", [*LONG[1], *MORE[1]]),
    (f"<body><form id=aspnetForm><input name=x>{MENU}<div>{LONG[0]}</div></form></body>", LONG[1]),
    (f"<body><div>{LONG[0]}</div><form><p>Your name and your address, please, in full.</p></form></body>", LONG[1]),
    (f'<body><article><h1>T</h1>{SHORT[0]}<section id="user-comments">{LONG[0]}</section></article></body>', ["T", *SHORT[1]]),
    (f'<body><div id="reader-comments-list">{SHORT[0]}</div><div>{LONG[0]}</div></body>', LONG[1]),
    (f'<body class="page has-comments"><div class="post-with-comments">{LONG[0]}</div></body>', LONG[1]),
    (f'<body><div class="comments-enabled-page"><article>{LONG[0]}</article></div></body>', LONG[1]),
    (f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1><nav>share</nav></header>{LONG[0]}<footer>end</footer></article></body>", ["Title", *LONG[1]]),
], ids=["short block between", "short paragraphs", "links between", "form round the page", "form beside", "comments in the article", "comments beside", "modifiers",
        "class round the article", "own header"])
def test_nothing_but_surroundings_is_lost(page, want):
    assert html_text.main_text(page).split("\n") == want


def test_hostile_markup_ends_quickly(spark):
    sources = ["<b>" * 30000 + "x" + "</i>" * 500, "<div>" * 20000 + "x" + "</div>" * 20000, "<p" * 30000, "<!--" * 30000, '<a href="' * 20000]
    df = spark.createDataFrame([(i, "u", s, 0) for i, s in enumerate([*sources, None, "<p>q"])], "page_id bigint, url string, html string, n_chars int")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    assert got[0].text == "x" and got[1].text == "x" and (got[5].text, got[5].n_chars) == ("", 0) and got[6].text == "q"
    assert html_text.extract(df.where("page_id < 0")).count() == 0


def test_pages_table_gives_each_article(spark):
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op6_html_text(spark, SF).collect():
        inner = re.search(r"<article>(.*)</article>", rows[r.page_id], re.S)[1]
        blocks = (" ".join(html_text.html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


CHAT = [(1, 0, "system", "be </turn> <turn user>\nbrief \\0 \\1"), (1, 1, "user", None), (1, 2, "assistant", "ok\n<turn "), (1, 2, "assistant", "ok\n<turn "),
        (1, 3, None, "x"), (2, None, "user", "first"), (2, 0, "assistant", ""), (3, 0, "assistant", "é日<😀\\")]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*r, "pos") for r in CHAT], "conv_id bigint, turn int, role string, text string, pos string").repartition(3)
    got = {r.conv_id: r for r in chat.digests(chat.text_messages(df)).collect()}
    assert set(got) == {1, 2, 3}
    for conv, r in got.items():
        turns = sorted(((t if t is not None else -1), role or "", text or "") for c, t, role, text in CHAT if c == conv)
        line = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(line.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.text_messages(df.where("conv_id < 0"))).count() == 0


def test_control_strings_in_roles_and_types_read_back(spark):
    roles = ["us>\ner", ">", ">\n", "a</turn>\n<turn b", "\\2", "\\", "\\\\2>", "<>\\0", "assistant", "é> \n>"]
    rows = [(k, t, role, f"text {t} >\n \\2 </turn>\n {role}") for k in range(2) for t, role in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    back = chat.read_back(chat.format_conversations(chat.text_messages(df))).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back} == {k: [(x[2], x[3]) for x in rows if x[0] == k] for k in range(2)}
    part = spark.createDataFrame([(1, 0, "u", [("a>b<\\", None, "x", 3)])], f"conv_id bigint, turn int, role string, parts array<{chat.PART_TYPE}>")
    assert chat.format_conversations(part).first().formatted == "<turn u>\n<a\\2b\\1\\0 0></turn>\n"


def test_typed_parts_leave_numbered_placeholders(spark):
    part = f"array<{chat.PART_TYPE}>"
    rows = [(1, 0, "user", [("text", "see <this>", None, 0), ("image", None, "a.png", 64), ("audio", None, "b.wav", 200)]),
            (1, 1, "assistant", [("text", "fine", None, 0)]), (1, 2, "user", [("document", None, "c<.pdf", None), ("text", "?", None, 0), (None, None, "d", 1)]),
            (1, 3, "assistant", None)]
    r = chat.format_conversations(spark.createDataFrame(rows, f"conv_id bigint, turn int, role string, parts {part}")).first()
    assert r.formatted == ("<turn user>\nsee \\1this><image 0><audio 1></turn>\n<turn assistant>\nfine</turn>\n"
                           "<turn user>\n<document 2>?<unknown 3></turn>\n<turn assistant>\n</turn>\n")
    assert [(a.number, a.type, a.uri, a.tokens) for a in r.attachments] == [
        (0, "image", "a.png", 64), (1, "audio", "b.wav", 200), (2, "document", "c<.pdf", None), (3, None, "d", 1)]
    assert r.expanded_tokens == 265
    assert [r.formatted[s.start:s.start + s.length] for s in r.loss_spans] == ["fine", ""]


URLS = [None, "", "no scheme", "http://", "HTTP://Ads.Example.NET/en/1?x=/de/", "https://example.com/de/", "https://a.example.com/de/x#y", "https://a.example.com/DE/x",
        "https://b.org/fr/1", "https://fr.org?/fr/", "https://notnet/x", "https://x.net", "https://x.net/", "https://example.net/en", "ftp://q.test/a://b/c?d", "http://example.net/en/\nz"]


def test_rule_list_equals_plain_python(spark):
    pages = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(URLS)], "page_id bigint, url string, rule string, verdict string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for r in url_rules.judge(pages, labels).collect():
        u = URLS[r.page_id]
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path, low = re.match(r"[^?#]*", rest[len(host):])[0], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (low == h or low.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (low, path)
        assert (r.rule, r.verdict) == (max(fits)[1:] if fits else (None, "allow"))


def test_mined_rules_equal_enumeration(spark):
    """Every combination of tokens, counted by hand; the token that all urls share is mined like any other."""
    import itertools

    rnd = random.Random(11)
    rows = []
    for i in range(400):
        words = [w for w in ("win", "cash", "blog", "news") if rnd.random() < 0.4]
        bad = rnd.random() < (0.9 if {"win", "cash"} <= set(words) else 0.75 if "cash" in words else 0.1)
        rows.append((i, "https://h.test/" + "/".join(words), int(bad)))
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id bigint, url string")
    labels = spark.createDataFrame([(r[0], 1 - r[2], 0) for r in rows], "doc_id bigint, quality int, toxic int")
    host, path = url_rules.parts(F.col("url"))
    own = {r.page_id: set(r.t) for r in pages.select("page_id", url_rules.tokens(host, path, F.col("url")).alias("t")).collect()}
    share = [len(own), max(sum(t in x for x in own.values()) for t in set.union(*own.values()))]
    assert share[0] == share[1]  # some token is in all urls
    found = {}
    for size in range(1, max(map(len, own.values())) + 1):
        for items in itertools.combinations(sorted(set.union(*own.values())), size):
            have = [i for i, t in own.items() if set(items) <= t]
            hits = sum(rows[i][2] for i in have)
            if hits >= 20 and hits >= 0.6 * len(have):
                found[items] = hits / len(have)
    best = {k for k, c in found.items() if not any(found.get(p, -1) >= c for n in range(1, len(k)) for p in itertools.combinations(k, n))}
    got = {tuple(r["items"]) for r in url_rules.mined_rules(pages, labels).collect()}
    assert got == best and len(found) > len(best) > 1


def test_mined_combination_blocks(spark):
    """Spam is a word of the path on one host; either alone is fine."""
    rnd = random.Random(1)
    urls = [(i, f"https://{rnd.choice(['one', 'two'])}.test/{rnd.choice(['buy', 'read', 'see'])}/{i}") for i in range(600)]
    bad = [i for i, u in urls if "one.test/buy" in u]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, 0 if i in bad else 1, 0) for i, _ in urls[:400]], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.judge(pages, labels, min_support=0.01).collect()}
    assert {i for i, v in got.items() if v == "block"} == set(bad)
    rules = url_rules.mined_rules(pages, labels, min_support=0.01).collect()
    assert [r["items"] for r in rules] == [["host:one", "path:buy"]] and rules[0].confidence == 1.0


def _accuracy(df, spark, column, held=True):
    labels = spark.read.parquet(f"{SF}/../sf0.1/labels.parquet")
    rows = df.join(labels, "doc_id").where(F.col("held_out") == held).select("score", "predicted", column).collect()
    return sum(r.predicted == r[column] for r in rows) / len(rows), rows


def test_toxicity_on_held_out_labels(spark):
    df = queries.op7_toxicity(spark, f"{SF}/../sf0.1")
    accuracy, rows = _accuracy(df, spark, "toxic")
    assert accuracy > 0.96 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted for r in rows if r.toxic) > 0.8 * sum(r.toxic for r in rows)


def simulated_votes(n=4000, prior=0.3, seed=1):
    """Votes of seven voters of known rates; the last one repeats the first."""
    import numpy as np

    rng = np.random.default_rng(seed)
    y = rng.random(n) < prior
    toxic, clean = np.array([.9, .7, .6, .5, .8, .55]), np.array([.05, .1, .2, .05, .3, .5])
    votes = rng.random((n, 6)) < np.where(y[:, None], toxic, clean)
    return y, np.column_stack([votes, votes[:, 0]]), toxic, clean


def test_label_model_finds_rates_and_soft_labels_without_labels():
    import numpy as np

    y, votes, toxic, clean = simulated_votes()
    share = votes.mean(axis=1)
    model = toxicity.LabelModel(votes, share >= np.sort(share)[-1200], 0.3)
    assert np.abs(model.toxic[:6] - toxic).max() < 0.1 and np.abs(model.clean[:6] - clean).max() < 0.1
    p = model.posterior
    assert ((p > 0.05) & (p < 0.95)).mean() > 0.05 and 0 < ((p > 0.5) != y).mean() < 0.12
    # By hand: the posterior of every vote pattern, from the prior, the rates and the voters' weights.
    for x in np.unique(votes, axis=0):
        odds = math.log(0.3 / 0.7)
        for fired, t, c, w in zip(x, model.toxic, model.clean, model.weights):
            odds += w * math.log(t / c if fired else (1 - t) / (1 - c))
        assert abs(p[(votes == x).all(axis=1)] - 1 / (1 + math.exp(-odds))).max() < 1e-4


def test_a_repeated_voter_counts_once():
    import numpy as np

    _, votes, *_ = simulated_votes()
    share = votes[:, :6].mean(axis=1)
    start = share >= np.sort(share)[-1200]
    once, twice = toxicity.LabelModel(votes[:, :6], start, 0.3), toxicity.LabelModel(votes, start, 0.3)
    assert abs(twice.weights[0] - 0.5) < 0.02 and twice.weights[0] == twice.weights[6] and once.weights.min() > 0.9
    assert np.abs(once.posterior - twice.posterior).max() < 0.1


def test_repeated_voters_weigh_exactly_the_same():
    import numpy as np

    for seed in range(40):
        _, votes, *_ = simulated_votes(n=1500, seed=seed)
        share = votes[:, :6].mean(axis=1)
        weights = toxicity.LabelModel(votes, share >= np.sort(share)[-450], 0.3).weights
        assert weights[0] == weights[6]


def test_the_given_label_is_no_voter(spark, monkeypatch):
    """The voters' names, and posteriors that contradict some labels."""
    seen = {}

    class Spy(toxicity.LabelModel):
        def __init__(self, votes, start, prior):
            super().__init__(votes, start, prior)
            seen.update(votes=votes, posterior=self.posterior)

    monkeypatch.setattr(toxicity, "LabelModel", Spy)
    docs, labels = (spark.read.parquet(f"{SF}/../sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    assert model.rates and set(model.rates) <= {*(f"words {g}" for g in range(toxicity.GROUPS)), *(f"lexicon {x}" for x in toxicity.LEXICON), *toxicity.PATTERNS}
    assert seen["votes"].shape[1] == len(model.rates)
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    found = toxicity.training_ids(labels, "toxic", toxicity.PER_CLASS).collect()
    assert (seen["posterior"] > 0.5).sum() != sum(r.doc_id in toxic for r in found)


def test_quality_on_held_out_labels(spark):
    accuracy, rows = _accuracy(queries.op9_quality(spark, f"{SF}/../sf0.1"), spark, "quality")
    assert accuracy > 0.98 and all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("module,column,extra", [(toxicity, "toxic", "_score"), (quality, "quality", "lines")])
def test_classifiers_on_edge_cases(spark, module, column, extra):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "you idiot " * 30000, 0), (4, "fine words here", 0), (4, "fine words here", 0), (None, "a", 0)],
                                 f"doc_id bigint, text string, {extra} int")
    for rows in ([], [(1, 1)], [(3, 1), (3, 0), (4, 0), (4, 0), (9, 1), (1, None)]):
        labels = spark.createDataFrame(rows, f"doc_id bigint, {column} int")
        got = module.score(docs, labels).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 4}) == 1
        for r in got:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert module.score(docs.where("doc_id < 0"), labels).count() == 0


def test_labels_of_held_out_rows_are_not_learnt(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id bigint, toxic int")
    ids = {r.doc_id for r in toxicity.training_ids(labels, "toxic", 1000).collect()}
    assert ids == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2}
    few = Counter(r.y for r in toxicity.training_ids(labels, "toxic", 10).collect())
    assert few == {0: 10, 1: 10}


def test_forward_backward_equals_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    row = np.array([0, 0, 0, 0, 1, 2, 2])
    x, crf = rng.normal(size=(7, 3)), quality.Crf(rng.normal(size=3), rng.normal(size=(2, 2)))
    got = crf.passes(x, quality.Chains(row, 3))[0]
    for text in range(3):
        lines = np.flatnonzero(row == text)
        total, good = 0.0, np.zeros(len(lines))
        for labels in itertools.product((0, 1), repeat=len(lines)):
            w = np.exp(sum(y * (x[i] @ crf.weights) for y, i in zip(labels, lines)) + sum(crf.pairs[a, b] for a, b in zip(labels, labels[1:])))
            total, good = total + w, good + w * np.array(labels)
        assert np.allclose(got[lines, 1], good / total)


@pytest.mark.parametrize("segment", [1, 2, 3, 256])
def test_segments_give_the_same_passes(monkeypatch, segment):
    import numpy as np

    rng = np.random.default_rng(1)
    row = np.repeat(np.arange(6), [1, 7, 2, 13, 3, 6])
    x, crf = rng.normal(size=(len(row), 3)), quality.Crf(rng.normal(size=3), rng.normal(size=(2, 2)))
    score, forward, backward, unary = np.zeros(2), np.zeros((len(row), 2)), np.zeros((len(row), 2)), np.column_stack([np.zeros(len(row)), x @ crf.weights])
    for i in range(len(row)):  # line after line
        score = unary[i] + (np.logaddexp(*(score[:, None] + crf.pairs)) if i and row[i] == row[i - 1] else 0)
        forward[i] = score
    for i in range(len(row) - 1, 0, -1):
        if row[i] == row[i - 1]:
            backward[i - 1] = np.logaddexp(*(crf.pairs + unary[i] + backward[i]).T)
    monkeypatch.setattr(quality, "SEGMENT", segment)
    got = crf.passes(x, quality.Chains(row, 6))
    assert np.allclose(got[1], forward) and np.allclose(got[2], backward)


def test_quality_learns_from_whole_texts(spark):
    """Good and bad documents begin alike and differ after line 100: prefixes would teach nothing."""
    rnd = random.Random(3)
    plain = lambda: " ".join("".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8))) for _ in range(8)) + "."
    junk = lambda: "### $$$ " + "BUY!!! " * rnd.randint(2, 6)
    rows = [(i, "\n".join([plain() for _ in range(100)] + [(plain if i % 2 else junk)() for _ in range(300)])) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    got = quality.score(spark.createDataFrame(rows, "doc_id bigint, text string"), labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)


def test_training_sample_takes_whole_documents_up_to_a_line_budget(spark):
    docs = spark.createDataFrame([(i, "a\n" * (i % 5)) for i in range(200)] + [(500, "a\n" * 99), (501, None)], "doc_id bigint, text string")
    ids = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(500, 0), (501, 1)], "doc_id bigint, y int")
    got = quality.whole_documents(docs, ids, 60).collect()
    lines = {y: sum(1 if r.doc_id == 501 else r.doc_id % 5 + 1 for r in got if r.y == y) for y in (0, 1)}
    assert all(55 < n <= 60 for n in lines.values()) and 500 not in {r.doc_id for r in got}
    assert quality.whole_documents(docs, ids, 10_000).count() == 202


@pytest.mark.parametrize("module,column", [(toxicity, "toxic"), (quality, "quality")])
def test_class_shares_need_no_sort_of_all_labels(spark, monkeypatch, module, column):
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(400)] + [(3, False)], f"doc_id bigint, {column} boolean")
    seen, ids = [], toxicity.training_ids
    monkeypatch.setattr(module, "training_ids", lambda labels, column, n: seen.append(n) or ids(labels, column, n))
    module.fit(spark.createDataFrame([(0, "a bad one"), (1, "a good one")], "doc_id bigint, text string"), labels)
    assert seen == [module.PER_CLASS]
    counts = toxicity.class_counts(labels, column)
    kept = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert {r.y: r.n for r in counts.collect()} == Counter(int(i % 3 == 0) for i in kept)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "Sort " not in plan and "TakeOrdered" not in plan
