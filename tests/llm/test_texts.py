"""Operators on single texts against plain versions, and the models on made-up labels."""

import random
import re
import time

import numpy as np
import pytest

from ledgerloom.llm import (
    factorization, html_text, mixing, quality_rules, token_counts, toxicity, url_filter,
)
from ledgerloom.llm.frames import in_held_out_fold
from ledgerloom.llm.queries import URL_RULES

DOCS = "doc_id bigint, text string, id int, label int, score int"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in texts], DOCS)


# --- quality rules ------------------------------------------------------------

def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    again = {k + d for at in windows.values() if len(at) > 1 for k in at for d in range(8)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates,
            len(again), failed)


def test_base_counts(spark):
    rng = random.Random(2)
    words = ["a", "é", "b#", "<x>", " y", "d,", "\x1cz"]
    texts = [None, "", " \t\n\x0b", "x " * 20_000]
    for _ in range(150):
        texts.append("".join(rng.choice(words[:rng.randint(2, 7)]) + rng.choice([" ", "\n", " ", "\x0c", "\t "])
                             for _ in range(rng.randint(0, 60))))
    rows = quality_rules.quality_rules(documents(spark, enumerate(texts))).collect()
    for r in rows:
        assert tuple(r)[1:7] == slow_counts(texts[r.id]), texts[r.id]
        assert not (r.base_failed and r.kept)
    assert len(rows) == len(texts)


def test_verdict_does_not_depend_on_the_order():
    plain = " ".join(f"word{k} and" for k in range(40))
    texts = [plain, plain.upper(), plain.replace(" ", "## "), "same same same " * 3 + plain * 0, plain + "\n- x" * 3]
    for text in map(quality_rules.Text, texts):
        verdicts = {any(r.rejects(text) for r in order)
                    for order in (quality_rules.RULES, quality_rules.RULES[::-1])}
        assert len(verdicts) == 1
    rejected = [any(r.rejects(quality_rules.Text(t)) for r in quality_rules.RULES) for t in texts]
    assert rejected[:3] == [False, True, True]


def test_cascade_puts_the_worthwhile_rule_first(spark):
    never = quality_rules.Rule("never", lambda t: sum(map(len, t.words)) < 0)
    always = quality_rules.Rule("always", lambda t: True)
    docs = documents(spark, [(k, " ".join(f"w{k}x{j}" for j in range(50))) for k in range(20)])
    order = quality_rules.cascade(docs.selectExpr("doc_id id", "text"), (never, always))
    assert [r.name for r in order] == ["always", "never"]


# --- token counts -------------------------------------------------------------

def slow_count(word, pieces):
    at = tokens = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        tokens += 1 if end else len(word[at].encode())
        at = end or at + 1
    return tokens


def test_counts_equal_longest_match(spark):
    rng = random.Random(8)
    for _ in range(60):
        pieces = {"".join(rng.choice("abcé▁") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 25))}
        automaton = token_counts.Automaton(pieces)
        for _ in range(60):
            word = "".join(rng.choice("abcé▁x漢") for _ in range(rng.randint(0, 14)))
            assert automaton.count(word) == slow_count(word, pieces), (word, pieces)
    docs = documents(spark, [(1, None), (2, ""), (3, "ab ab"), (3, "ab ab"), (4, "a" * 50_000)])
    got = token_counts.token_counts(docs, ["▁a", "b", "aa", "a"]).collect()
    assert sorted((r.id, r.n_tokens) for r in got) == [(1, 0), (2, 0), (3, 4), (3, 4), (4, 25_001)]


# --- pages --------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="cookie-notice">We
use cookies</div><div class="ad">Buy, buy, buy, now and forever, cheap</div><aside>Related, things, here</aside>
<article><h1>Head &amp; line</h1><p><b>First  para,
with a <a href="/y">link</a>.<br>More<p>Second&nbsp;one, caf&eacute; &#8364;.</p><form><p>Mail me</p></form>
<div class="comments"><p>Great post, friend, really, great</p></div></article><footer>&copy; me</footer></body>"""


def test_the_article_alone():
    assert html_text.main_text(PAGE) == (
        "Head & line\nFirst para, with a link. More\nSecond one, café €.")


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("<script>x", ""), ("just words", "just words"),
    ("<p>a<p>b</i></div>c", "a\nb\nc"), ("<!-- x", ""), ("<div><p>one, two</p></div>", "one, two"),
    ("a < b and <b>c</b>d", "a < b and cd"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep")])
def test_broken_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ('<div class="content has-sidebar"><p>One, two, three</p></div><div class="comment-list"><p>Hi</p></div>',
     "One, two, three"),
    ('<div id="no-sidebar"><article><p>Short</p></article></div><div class="related-posts"><p>Long, long, long</p></div>',
     "Short"),
    ('<div class="widget"><p>All, there, is</p></div>', "All, there, is"),
    ("<article><p>One, two</p><figure><img><figcaption>A caption</figcaption></figure></article>",
     "One, two\nA caption"),
    ("<article><p>One, two</p></article><div class='comments'><article><p>Great, great, great post</p></article></div>",
     "One, two")])
def test_names_do_not_take_the_article(page, text):
    assert html_text.main_text(page) == text


LONG = "Words, and more words, that go on for a while and say much. " * 8


@pytest.mark.parametrize("page, text", [
    ("<article><section><p>L</p><p>L</p></section><section><p>Short.</p></section></article>", "L\nL\nShort."),
    ("<div><p>L</p><p>L</p></div><div><p>Short.</p></div>", "L\nL\nShort."),
    ("<div><p>L</p></div><div><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div>", "L"),
    ("<article><div><p>L</p></div><div><a href=x>One</a> <a href=y>Two</a></div><p>End.</p></article>", "L\nEnd."),
    ("<main><article><p>L</p></article><article><p>Other.</p></article></main>", "L"),
    ("<article><p>L</p><dialog>Said</dialog><fieldset><p>Set</p></fieldset>"
     "<form><fieldset>Mail</fieldset></form></article><dialog>Box</dialog>", "L\nSaid\nSet"),
    ('<div class="content share"><article><p>L</p></article></div><p>Stray line</p>', "L"),
    ('<div class="page search"><article><p>L</p></article></div><p>Stray line</p>', "L"),
    ('<div class="list comments"><article><p>L</p></article></div><p>Stray line</p>', "Stray line"),
    ('<div class="share"><article><p>L</p></article></div><p>Stray line</p>', "Stray line"),
    ('<div title="not hidden class=ad"><p>L</p></div>', "L"), ('<div title=x HIDDEN><p>L</p></div><p>M', "M")])
def test_the_whole_article(page, text):
    assert html_text.main_text(page.replace("L<", LONG + "<")) == text.replace("L", LONG.strip())


@pytest.mark.parametrize("page, text", [
    ('<p><a href="x"">One</a> two</p>', "One two"), ("<p title=don't>One</p><p>it's</p>", "One\nit's"),
    ('<p title="x>One</p><p>Two</p>', "One\nTwo"), ('<p title=">">One</p>', "One"),
    ("<p>One <!--> two <!---> three <!-- x --!> four </ x></> five <3", "One two three four five <3"),
    ("<p/class=x/>One<br/>two", "One two"), ("<p>One</p><a href", "One"), ("<p>One</p><a x='>' y", "One")])
def test_tags_end_where_a_tokeniser_ends_them(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page", [
    "<a " * 40_000, '<a x=">" ' * 20_000, '<a x="' * 20_000 + ">", "<!-- " * 40_000, "</script " * 40_000,
    "<div>" * 20_000 + "<p>x</p>" * 20_000, "<div><p>x</p></b></q></div>" * 10_000 + "</x>" * 20_000,
    "<div class=share>" * 20_000 + "<p>x</p>" * 10_000])
def test_long_pages_take_linear_time(page):
    before = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - before < 5


def slow_main_text(blocks):
    """The text of an article whose blocks are given with the containers above each, from outside in."""
    return "\n".join(text for path, text in blocks if not {"nav", "form", "ad"} & set(path))


def test_random_articles_keep_every_block():
    rng = random.Random(4)

    def tree(path, depth, blocks):
        if depth == 0 or rng.random() < 0.3:
            text = f"Line {len(blocks)}, " + "word " * rng.randint(0, 60) + "end"
            blocks.append((path, text))
            return f"<p>{text}</p>" if rng.random() < 0.7 else f"<blockquote title='<p>'>{text}</blockquote>"
        tag = rng.choice(["div", "section", "section", "nav", "form", "ad"])
        inside = "".join(tree([*path, tag], depth - 1, blocks) for _ in range(rng.randint(1, 3)))
        return f"<div class=ad>{inside}</div>" if tag == "ad" else f"<{tag}>{inside}</{tag}>"

    for _ in range(200):
        blocks = [([], "Opening line")]
        body = "<p>Opening line</p>" + "".join(tree([], 4, blocks) for _ in range(4))
        page = f"<body><nav><a href=x>Menu</a></nav><article>{body}</article><footer>me</footer></body>"
        assert html_text.main_text(page) == slow_main_text(blocks), page


def test_pages_keep_their_rows(spark):
    pages = spark.createDataFrame([(1, PAGE, "x"), (1, PAGE, "y"), (None, None, "z")],
                                  "page_id int, html string, text string")
    text = html_text.main_text(PAGE)
    assert sorted(((r.id, r.text) for r in html_text.extract(pages).collect()), key=repr) == [
        (1, text), (1, text), (None, "")]


# --- urls ---------------------------------------------------------------------

def test_rules_and_links(spark):
    link = '<a class="x" href="https://bad.net/fr/">b</a>'
    rows = [(1, "http://WWW.Example.com/en/a?b", ""), (2, "https://m.example.com/en/", ""), (3, None, None),
            (4, "no scheme", link), (5, "https://bad.net/fr/1", ""), (6, "http://friend.org/x", link * 2),
            (7, "http://else.org#//x", "<a href='/y'>"), (7, "http://else.org#//x", ""),
            (8, "http://example.com", ""), (9, "ftp://a.com:8/p/q#f", "")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, URL_RULES).collect()}
    assert got == {
        1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        2: ("m.example.com", "/en/", "example.com/en/", "block"), 3: ("", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("bad.net", "/fr/1", "net/fr/", "block"),
        6: ("friend.org", "/x", None, "block"), 7: ("else.org", "", None, "allow"),
        8: ("example.com", "", None, "allow"), 9: ("a.com:8", "/p/q", None, "allow")}
    assert url_filter.judge(pages, URL_RULES).count() == len(rows)
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0


def test_distrust_reaches_as_far_as_it_counts(spark):
    """A chain of links to a blocked host, longer than any fixed small number of rounds."""
    rows = [(0, "https://bad.net/fr/", "")]
    rows += [(k, f"https://h{k}.org/", f"<a href='https://{f'h{k - 1}.org' if k > 1 else 'bad.net'}/'>x</a>")
             for k in range(1, 13)]
    rows += [(100 + k, f"https://alone{k}.org/", "") for k in range(20)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r.id: (r.verdict, r.distrust) for r in url_filter.judge(pages, URL_RULES).collect()}
    for k in range(1, 13):  # 0.15 * 0.85^12 is more than a tenth of 1 / 33
        assert got[k][0] == "block" and abs(got[k][1] - 0.15 * 0.85 ** k) < 1e-5
    assert all(got[100 + k][0] == "allow" for k in range(20))


# --- classifiers --------------------------------------------------------------

def labelled(spark):
    rng = random.Random(6)
    words = [f"plain{k}" for k in range(80)]
    rows, labels = [], []
    for k in range(400):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic, poor = k % 5 == 0, k % 4 == 0
        if toxic:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(["m0ron", "Idi0t,", "ѕcum"]))
        rows.append((k, " ".join(w + "##" if poor else w for w in text)))
        labels.append((k, int(not poor), int(toxic)))
    rows += [(1000, None), (1001, ""), (0, rows[0][1])]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels = labelled(spark)
    lexicon = toxicity.fit(docs, labels, held_out=in_held_out_fold())
    assert {" moron ", " idiot ", " scum "} <= set(lexicon.weights)
    scored = toxicity.toxicity(docs, lexicon)
    held = scored.join(labels, scored.id == labels.doc_id).where(in_held_out_fold())
    assert held.where("predicted <> toxic").count() == 0 and held.count() > 50
    assert scored.count() == docs.count() and scored.where("score is null").count() == 0
    assert scored.where("id >= 1000 and predicted = 1").count() == 0


def test_exceptions_and_folding():
    lexicon = toxicity.Lexicon({" trash ": 2.0, " lowei": 3.0}, ("trash can",))
    automaton = lexicon.automaton()
    measure = lambda t: round(toxicity.measures(t, automaton)[1], 6)
    assert measure("The trash can.") == 0 == measure("")
    assert measure("TR4SH!") == measure("trаѕh") == measure("a trash") > 0
    assert measure("loweix") > measure("trash") and measure("yellowei") == 0


def slow_total(text, lexicon):
    """Weight of the lexicon's terms at every place, one by one, outside every exception phrase."""
    def places(folded, term):
        return [k for k in range(len(folded)) if folded.startswith(term, k)]

    def total(folded):
        harmless = [(k, k + len(p) + 1) for p in lexicon.exceptions for k in places(folded, f" {p} ")]
        return sum(w for t, w in lexicon.weights.items() for k in places(folded, t)
                   if not any(a <= k and k + len(t) - 2 <= b for a, b in harmless))

    folded, ends = toxicity.fold(text)
    return total(folded) + sum(total(other) for plain, other in ends if total(plain) == 0)


def test_matches_equal_brute_force():
    rng = random.Random(21)
    lexicon = toxicity.Lexicon({" trash ": 2.0, " tras": 1.0, " hats ": 4.0, " ass ": 8.0, " idiot ": 16.0, " the hat": 32.0},
                               ("trash can", "the trash", "can the hats", "a idiot"))
    automaton = lexicon.automaton()
    words = ["trash", "TR4SH", "can", "the", "hat5", "hats", "a$$", "idio7", "idiot!", "a", "trasher", "h@t", "5", "!!", "mail5"]
    for _ in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\n", ", ", ""]) for _ in range(rng.randint(0, 12)))
        want = slow_total(text, lexicon)
        assert abs(toxicity.measures(text, automaton)[1] - np.log1p(want)) < 1e-9, text


def test_word_ends_are_folded_only_where_that_finds_something():
    automaton = toxicity.Lexicon({" idiot ": 2.0, " ass ": 2.0, " mail5 ": 3.0}, ()).automaton()
    found = {t: toxicity.measures(t, automaton)[1] > 0 for t in ("idio7", "a$$", "idiot!", "DE!!", "mail", "hat3", "a")}
    assert found == {"idio7": True, "a$$": True, "idiot!": True, "DE!!": False, "mail": False, "hat3": False, "a": False}


def test_many_hits_and_exceptions_take_linear_time():
    automaton = toxicity.Lexicon({" trash ": 2.0}, ("trash can",)).automaton()
    start = time.process_time()
    assert toxicity.measures("trash can " * 40_000, automaton)[1] == 0
    assert time.process_time() - start < 3


def test_harmless_phrases_are_learned(spark):
    rng = random.Random(4)
    words = [f"plain{k}" for k in range(60)]
    rows, labels = [], []
    for k in range(1600):
        text = [rng.choice(words) for _ in range(40)]
        text[5:5] = [rng.choice(words), "moron"] if k % 4 == 0 else ["oxy", "moron"] if k % 60 == 1 else ["fine", "thing"]
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(k % 4 == 0)))
    docs = documents(spark, rows)
    lexicon = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), exceptions=())
    assert "oxy moron" in lexicon.exceptions and " moron " in lexicon.weights
    assert not any(p.startswith("plain") and p.endswith(" moron") for p in lexicon.exceptions)
    wrong = toxicity.toxicity(docs, lexicon).where("predicted <> cast(id % 4 = 0 as int)")
    assert wrong.count() == 0


@pytest.mark.parametrize("kept", ["doc_id < 0", "toxic = 0", "toxic = 1"])
def test_without_labels_of_both_kinds_nothing_is_dropped(spark, kept):
    docs, labels = labelled(spark)
    lexicon = toxicity.fit(docs, labels.where(kept))
    assert toxicity.toxicity(docs, lexicon).where("score >= 0.5 or predicted = 1").count() == 0
    assert toxicity.drop_toxic(docs, lexicon).count() == docs.count()


def test_no_labels(spark):
    docs, labels = labelled(spark)
    none = labels.where("doc_id < 0")
    assert toxicity.toxicity(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0
    assert factorization.quality(docs, factorization.fit(docs, none)).count() == docs.count()
    model = mixing.fit(docs, none.selectExpr("doc_id", "'a' domain"), ("a", "b"), "domain")
    assert mixing.rates(docs, model, {"a": 1.0, "b": 1.0}).count() == docs.count()
    assert mixing.rates(docs.limit(0), model, {"a": 1.0, "b": 1.0}).count() == 0


def test_factorization_machine(spark):
    docs, labels = labelled(spark)
    machine = factorization.fit(docs, labels, held_out=in_held_out_fold())
    scored = factorization.quality(docs, machine)
    held = scored.join(labels, labels.doc_id == scored.id).where(in_held_out_fold())
    assert held.where("predicted <> quality").count() == 0
    x = machine.prepare(np.random.default_rng(0).normal(size=(3, len(machine.weights))))
    v = machine.factors
    for row, logit in zip(x, machine.logits(x)):
        gram = (row[:, None] * v) @ (row[:, None] * v).T
        slow = machine.bias + row @ machine.weights + (gram.sum() - gram.trace()) / 2
        assert abs(slow - logit) < 1e-3


def test_rates_meet_the_targets(spark):
    docs, labels = labelled(spark)
    domains = labels.selectExpr("doc_id", "case when quality = 1 then 'good' else 'poor' end domain")
    model = mixing.fit(docs, domains, ("good", "poor"), "domain")
    rates = mixing.rates(docs, model, {"good": 0.9, "poor": 0.1}).cache()
    totals = rates.selectExpr("sum(n_tokens) a", "sum(rate * n_tokens * posteriors[0]) g",
                              "sum(rate * n_tokens * posteriors[1]) p", "min(rate) m").first()
    assert totals.m >= 0
    assert abs(totals.g / totals.a - 0.9) < 1e-3 and abs(totals.p / totals.a - 0.1) < 1e-3
    mixed = mixing.mix(docs, model, {"good": 0.9, "poor": 0.1})
    assert mixed.columns[:5] == docs.columns and mixed.count() == docs.count()


def slow_nearest(tokens, p, goal):
    """Least squares over nonnegative rates by many plain projected steps; the distance reached."""
    a = (p * tokens[:, None]).T
    weigh = np.linalg.pinv(a @ p)
    rate = np.ones(len(p))
    scale = np.linalg.norm(p @ weigh @ a, 2)
    for _ in range(20_000):
        rate = np.maximum(0, rate - p @ weigh @ (a @ rate - goal) / scale)
    return np.abs(a @ rate - goal).max() / tokens.sum()


@pytest.mark.parametrize("k, targets, reachable", [
    (3, [0.98, 0.01, 0.01], True), (3, [1.0, 0.0, 0.0], False),
    (20, [k + 1.0 for k in range(20)], True), (20, [1.0] * 3 + [0.05] * 17, False)])
def test_rates_reach_what_can_be_reached(spark, k, targets, reachable):
    rng = np.random.default_rng(k)
    p = rng.dirichlet(np.full(k, 0.15), 600)
    p[:, -1] = np.maximum(p[:, -1], 0.0 if reachable else 0.02)
    p = np.round(p / p.sum(axis=1, keepdims=True), 6)
    tokens = rng.integers(1, 400, 600)
    table = spark.createDataFrame([(int(t), row.tolist()) for t, row in zip(tokens, p)], "tokens bigint, p array<double>")
    fitted = mixing.fit_rates(table, targets)
    got = np.abs(fitted.residual).max()
    goal = np.array(targets) / sum(targets) * tokens.sum()
    assert (got <= 1e-3) == reachable and fitted.passes < 60
    assert got < slow_nearest(tokens.astype(float), p, goal) + 2e-3
    rate = np.array([r[0] for r in table.select(mixing.rate_at(fitted.moved, table.p)).collect()])
    assert rate.min() >= 0
    assert np.allclose((p * (tokens * rate)[:, None]).sum(axis=0) - goal, fitted.residual * tokens.sum(), atol=1e-6 * tokens.sum())


def test_columns_of_the_documents_stay(spark):
    docs, labels = labelled(spark)
    docs = docs.selectExpr("*", "7.5D rate", "'x' n_tokens", "3 mix")
    domains = labels.selectExpr("doc_id", "case when quality = 1 then 'good' else 'poor' end domain")
    mixed = mixing.mix(docs, mixing.fit(docs, domains, ("good", "poor"), "domain"), {"good": 1.0, "poor": 1.0})
    assert mixed.columns == [*docs.columns, "n_tokens_", "posteriors", "rate_"]
    assert mixed.where("rate = 7.5 and n_tokens = 'x' and rate_ >= 0").count() == docs.count()
