"""Operators with a model: held-out accuracy, round trips and defined cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MED, SF_SMALL
from tidyload.llm import html_text, language_id, token_counts, url_filter, weak_quality
from tidyload.llm.queries import QUERIES

SF = SF_MED


# -- URLs ---------------------------------------------------------------------

def test_url_parts_and_rules(spark):
    urls = ["https://WWW.Example.NET/en/1?x#y", "http://a.example.net/EN/", "https://b.net", "https://b.net/", "https://mynet/", "http://example.com/de/x",
            "http://x.org/fr/y", "http://xorg/fr/", "ftp://h?q", "nope", None, "", "a://b://c/d", "http://example.net/en", "http://é.org/frz/", "x://H\n.net/p\nq?"]
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()}
    want = [("www.example.net", "/en/1", "example.net/en/", "allow"), ("a.example.net", "/EN/", "net/", "block"), ("b.net", "", None, "allow"),
            ("b.net", "/", "net/", "block"), ("mynet", "/", None, "allow"), ("example.com", "/de/x", "example.com/de/", "block"),
            ("x.org", "/fr/y", "org/fr/", "allow"), ("xorg", "/fr/", None, "allow"), ("h", "", None, "allow"), ("", "", None, "allow"),
            ("", "", None, "allow"), ("", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("example.net", "/en", "net/", "block"),
            ("é.org", "/frz/", None, "allow"), ("h\n.net", "/p\nq", "net/", "block")]
    assert got == dict(enumerate(want))


def brute_split(model, name):
    """The least cost over all ways to cut a name."""
    if not name:
        return 0.0
    return min((model.cost[name[:i]] if name[:i] in model.cost else url_filter.UNKNOWN_WORD + url_filter.UNKNOWN_LETTER * i)
               + brute_split(model, name[i:]) for i in range(1, len(name) + 1))


def test_segmentation_is_cheapest():
    model = url_filter.Model()
    for name in ("cheappills", "newsdaily", "freebetsx", "qzcasinoq", "adultx", "thth"):
        words = model.split(name)
        assert "".join(words) == name
        cost = sum(model.cost.get(w, url_filter.UNKNOWN_WORD + url_filter.UNKNOWN_LETTER * len(w)) for w in words)
        assert cost == pytest.approx(brute_split(model, name))
    assert model.split("cheappillsonline") == ["cheap", "pills", "online"]


def test_url_verdicts(spark):
    names = {"cheappills": "block", "casino-win": "block", "freebets": "block", "spamfarm": "block", "ads-track": "block", "adult-x": "block",
             "dailynews": "allow", "universitylibrary": "allow", "ththwh": "allow"}
    df = spark.createDataFrame([(n, f"https://www.{n}.com/en/7") for n in names], "page_id string, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(df).collect()} == names


def test_names_in_the_pages_are_labelled_once():
    block = [" ".join(re.findall("[a-z]+", x)) for x in url_filter.EXAMPLES["block"].split(";")]
    for name in ("adult x", "ads track", "casino win", "cheap pills", "free bets", "spam farm"):
        assert sum(f" {name} " in f" {x} " for x in block) == 1


def test_verdicts_of_unseen_names(spark):
    names = {"pokerbonus": "block", "onlinelottery": "block", "escort-dating": "block", "cashloan": "block", "torrentcrack": "block",
             "gardenrecipes": "allow", "historyarchive": "allow", "schoolforum": "allow", "city-museum": "allow", "qzkvv": "allow",
             "gamblingden": "allow"}  # a block name, but of words that the table has not
    df = spark.createDataFrame([(n, f"https://www.{n}.com/en/7") for n in names], "page_id string, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(df).collect()} == names


# -- pages --------------------------------------------------------------------

def test_pages_of_the_tables(spark):
    from html import unescape

    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op6_html_text"](spark, SF).collect():
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", html[r.page_id])[1]
        parts = [" ".join(unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text)


PAGES = {
    None: "", "": "", "<p": "", "<nav><a href=x>Home</a></nav>": "",
    "<article><p>a &lt;b&gt; &amp; c&#233;&nbsp;d</p></article>": "a <b> & cé d",
    "<article><p>one<p>two &am</article><footer>x</footer>": "one\n\ntwo &am",
    "<article><script>var a='<p>no</p>';</script><p title='a>b'>yes<!-- <p>no</p> --></p></article>": "yes",
    "<article><h1>T</h1><div class='comments'><p>me too, I think so as well</p></div><p>x\n \ty</p><form>Name</form></article>": "T\n\nx y",
    "<article><ul><li>1<li>2</ul><p>3 < 4": "1\n\n2\n\n3 < 4",
}


def test_page_cases(spark):
    df = spark.createDataFrame([(i, h, "own") for i, h in enumerate(PAGES)], "page_id long, html string, text string")
    got = {r[0]: r[1] for r in html_text.extract(df).select("doc.page_id", "text").collect()}
    assert got == dict(enumerate(PAGES.values()))


def test_nearest_role_of_a_block_wins():
    tree = html_text.trained()
    pages = {
        "<div class='sticky-header-page'><article><p>All of it is here.</p></article></div>": "All of it is here.",
        "<header><a href=/>Home</a><article><h1>T</h1><p>Never closed before.</p></article>": "T\n\nNever closed before.",
        "<article><p class=ad>Buy this now.</p><p>Text of it.</p></article>": "Text of it.",
        "<article><ul><li class='share'><p>Send it on</p><li>Flour</ul><p>End.</p></article>": "Flour\n\nEnd.",
        "<main class=content><div class=comments><p>Me too.</p></div><p>Yes.</p></main>": "Yes.",
        "<article><ul><li class=ad>Buy</li></ul><p>One.<div><p>Two.</div></article>": "One.\n\nTwo."}
    for page, text in pages.items():
        found = html_text.blocks(page)
        assert "\n\n".join(b.text for b, s in zip(found, tree.predict(html_text.features(found))) if s > 0.5) == text


def test_page_tree_fits_its_labels():
    tree = html_text.trained()
    for page in html_text.LABELLED:
        found = html_text.blocks("".join(h for _, h in page))
        marks = "".join(m for m, _ in page)
        assert [s > 0.5 for s in tree.predict(html_text.features(found))] == [m == "1" for m in marks]


# -- languages ----------------------------------------------------------------

def test_language_held_out(spark):
    found = QUERIES["op7_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").select(
        "held_out", (F.col("lang") == F.col("lang_pred")).alias("right"), "score")
    rows = found.where("held_out").collect()
    assert len(rows) > 200 and sum(r.right for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_spans_and_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    greek = [(10**6 + i, "αυτο ειναι ενα κειμενο και ο λογος", "el") for i in range(30)]
    learn = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(greek, "doc_id long, text string, lang string"))
    model = language_id.train(learn)
    assert model.languages == ["de", "el", "en", "es", "fr"]
    by = {r.lang: r.text[:400] for r in docs.where("length(text) > 600").groupBy("lang").agg(F.first("text").alias("text")).collect()}
    rows = [(0, by["en"] + " " + by["de"][:150], "x"), (1, None, "x"), (2, "12 -- 7!", "x"), (3, "", "x"), (4, "λογος", "x"), (5, by["fr"].upper(), "x"),
            (6, "λογος και κειμενο " + by["es"], "x"), (7, "語", "x")]
    got = {r[0]: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).select(
        "doc.doc_id", "lang_pred", "score", "lang_spans").collect()}
    assert got[0][1] == "en" and {s.lang for s in got[0][3]} == {"en", "de"}
    assert all(got[i][1:3] == ("und", 0.0) for i in (1, 2, 3))
    assert got[4][1] == "el" and got[5][1] == "fr" and got[6][1] == "es" and got[6][3][0].lang == "el"
    assert rows[6][1][got[6][3][0].start: got[6][3][0].end] == "λογος και κειμενο"
    assert got[7][1] in model.languages


def test_viterbi_is_best_path():
    import numpy as np

    rng = np.random.default_rng(2)
    model = language_id.Model(["a", "b", "c"], rng.normal(0, 4, (language_id.BUCKETS, 3)).astype(np.float32), np.array([1, 1, 1], np.uint32))
    texts = [b"xy zq w", b"", b"q w e r t", b"ab"]
    letters = language_id.Letters.of(texts)
    got = language_id.label(letters, model, len(texts))
    scores = np.add.reduceat(model.scores[letters.buckets], letters.first, axis=0)
    from itertools import product

    for row in (0, 2, 3):
        at = np.flatnonzero(letters.row == row)

        def worth(path):
            return sum(scores[i, k] for i, k in zip(at, path)) - language_id.SWITCH * sum(a != b for a, b in zip(path, path[1:]))

        assert worth(got[at]) == pytest.approx(max(map(worth, product(range(3), repeat=len(at)))))


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language_id.train(empty)
    one = language_id.identify(spark.createDataFrame([(1, "abc", None)], empty.schema), model).collect()
    assert one[0].lang_pred == "und" and language_id.identify(empty, model).count() == 0


def test_rejects(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = language_id.known_language(docs.unionByName(spark.createDataFrame([(10**7, None, None, None, None), (10**7 + 1, "1 2", "en", "s", 3)], docs.schema)))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_unlearned_scripts_and_random_letters_go(spark):
    rnd = random.Random(4)

    def letters(n):
        return " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 10))) for _ in range(n))

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    clean = {r.lang: r.text for r in docs.where("length(text) > 600").groupBy("lang").agg(F.first("text").alias("text")).collect()}
    russian, chinese = "Все люди рождаются свободными и равными в своем достоинстве и правах. ", "人人生而自由,在尊严和权利上一律平等。"
    gone = [letters(10), letters(100), letters(1000), russian, russian * 50, chinese, chinese * 50, russian * 9 + clean["en"][:100]]
    stay = [*clean.values(), "".join(t[:300] for t in clean.values()), clean["de"][:600] + letters(60), chinese + clean["fr"], clean["es"][:20]]
    rows = [(10**7 + i, t, None) for i, t in enumerate(gone + stay)]
    kept = {r.doc_id for r in language_id.known_language(docs.unionByName(spark.createDataFrame(rows, docs.schema))).collect()}
    assert not kept & {i for i, _, _ in rows[:len(gone)]} and {i for i, _, _ in rows[len(gone):]} <= kept
    assert len(kept) == docs.count() + len(stay)


def test_documents_stay_if_nothing_can_be_learned(spark):
    held_out = next(i for i in range(100) if not spark.range(i, i + 1).where(language_id.admitted("id")).count())
    for extra in ((1000, "abc", None), (held_out, "abc", "en"), (None, "abc", "en"), (1001, "12", "en")):
        rows = [(200, "Some words.", None), (201, "語", None), (202, "12 - 7", None), (203, None, None), (204, "", None), extra]
        kept = language_id.known_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
        assert {r.text for r in kept.collect()} == {"Some words.", "語", extra[1]} - {"12"}


def test_known_words_do_not_hang_on_the_number_of_languages(spark):
    # ten languages of an alphabet each, and a text in equal parts of all
    rnd = random.Random(5)
    words = {f"l{k}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz"[2 * k:2 * k + 6]) for _ in range(rnd.randrange(2, 8))) for _ in range(60)] for k in range(10)}
    rows = [(k * 100 + i, " ".join(rnd.choices(w, k=80)), lang) for k, (lang, w) in enumerate(words.items()) for i in range(30)]
    rows.append((10**6, ". ".join(" ".join(rnd.choices(w, k=30)) for w in words.values()), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language_id.known_language(docs).count() == len(rows)


def test_sparsely_learned_alphabet_stays(spark):
    # so many letters that most trigrams of the held-out texts were never learned
    rnd = random.Random(6)
    words = ["".join(chr(0x4E00 + rnd.randrange(2000)) for _ in range(2)) for _ in range(3000)]
    draw = [1 / (r + 20) for r in range(len(words))]
    rows = [(i, ",".join("".join(rnd.choices(words, draw, k=5)) for _ in range(8)), "zh") for i in range(60)]
    assert language_id.known_language(spark.createDataFrame(rows, "doc_id long, text string, lang string")).count() == len(rows)


# -- quality ------------------------------------------------------------------

def test_quality_against_labels(spark):
    found = QUERIES["op8_weak_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    good, bad = [r for r in found if r.quality == 1], [r for r in found if r.quality == 0]
    assert sum(r.good for r in good) >= 0.97 * len(good)
    assert sum(not r.good for r in bad) >= 0.9 * len(bad)


def test_em_finds_accuracies():
    import numpy as np

    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.7
    accuracy = [0.9, 0.8, 0.75, 0.95]
    votes = np.column_stack([np.where(rng.random(20000) < 0.2, -1, np.where(rng.random(20000) < a, truth, ~truth)) for a in accuracy])
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    chance, good, prior = weak_quality.estimate(patterns, counts.astype(float))
    assert abs(prior - 0.7) < 0.03
    for k, a in enumerate(accuracy):
        assert abs(chance[1, k, 2] / (chance[1, k, 1] + chance[1, k, 2]) - a) < 0.03
    assert ((good[place.ravel()] > 0.5) == truth).mean() > 0.9


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (4, "x " * 30000, "d"), (4, "x " * 30000, "d"), (None, "One two.", "e")],
                                 "doc_id long, text string, score string")
    got = weak_quality.quality(docs).collect()
    assert len(got) == 6 and all(r.score == 0.0 and not r.good for r in got if r.doc.doc_id in (1, 2, 3))
    assert weak_quality.quality(docs.limit(0)).count() == 0


# -- tokens -------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    with open(token_counts.VOCABULARY, "rb") as f:
        return token_counts._tokenizer(f.read())


def test_tree_equals_encoding(tokenizer, spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).collect()] + ["", " ", "a", "'ll  \n\n x'", "it's  we'll\t\t" * 40]
    rnd = random.Random(6)
    bits = ["", " ", "'", "ll", "s", "\n", "  ", "word", "éa", "12", "x" * 70, " " * 90, "'re", "!?"]
    for text in texts:
        tree = token_counts.Tree(text, tokenizer)
        assert tree.total() == len(tokenizer.encode(text))
        for _ in range(25):
            start = rnd.randrange(len(text) + 1)
            end = min(len(text), start + rnd.choice([0, 0, 1, 2, 5, 30, 400]))
            new = rnd.choice(bits)
            tree.edit(start, end, new)
            text = text[:start] + new + text[end:]
            assert tree.text() == text
            assert [p for c in tree.pieces for p in c] == tokenizer.cut(text)
            assert tree.total() == len(tokenizer.encode(text)) and tree.size() == len(text) and tree.chars[1] == len(text)


def test_edit_is_local(tokenizer):
    tree = token_counts.Tree("some words here " * 5000, tokenizer)
    tree.edit(40000, 40004, "other")
    assert tree.encoded < 40


def test_counts_of_edited_rows(spark, tokenizer):
    text = "Mail me at a.b@c.example.com or 10.1.2.3, please."
    rows = [(1, text, [(11, 28, "[mail]"), (0, 4, None), (None, 3, "x"), (2, 9, "overlaps")]), (2, None, [(0, 5, "new")]), (3, text, None), (3, text, []),
            (4, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits " + token_counts.EDITS)
    got = [r for r in token_counts.count_tokens(df, edits_col="edits").collect()]
    edited = " me at " + "[mail]" + text[28:]
    assert got[0].n_tokens_before == len(tokenizer.encode(text)) and got[0].n_tokens == len(tokenizer.encode(edited)) and got[0].n_edits == 2
    assert (got[1].n_tokens_before, got[1].n_tokens, got[1].n_edits) == (0, len(tokenizer.encode("new")), 1)
    assert got[2].n_tokens == got[2].n_tokens_before == got[3].n_tokens and got[4].n_tokens == 0


def test_query_masks_personal_data(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in QUERIES["op9_token_counts"](spark, SF_SMALL).collect():
        text = texts[r.doc_id]
        assert r.n_tokens_before == len(tokenizer.encode(text))
        for mask, pattern in token_counts.PERSONAL.items():
            text = re.sub(pattern, mask, text)
        assert r.n_tokens == len(tokenizer.encode(text))


def test_more_languages_than_the_table_has_room_for_at_full_width(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TABLE_CELLS", 1 << 15)
    names = [f"l{k:03d}" for k in range(60)]
    rnd = random.Random(3)
    words = {n: ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(3, 9))) for _ in range(25)] for n in names}
    rows = [(i, " ".join(rnd.choices(words[n], k=60)), n) for i, n in enumerate(names * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.scores.shape == (512, 60) and model.languages == names
    found = language_id.identify(docs, model, keep=["lang"]).select("doc.lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.95 * len(rows)


def test_five_hundred_and_one_languages(spark):
    rows = [(i, f"wort{chr(97 + i % 26)}{chr(97 + i // 26)} text", f"l{i}") for i in range(501)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 501 and model.scores.shape[0] == language_id.BUCKETS


@pytest.mark.parametrize("page, text", [
    ("<article><svg/><p>One two.</p></article>", "One two."),
    ("<article><svg viewBox='0 0 1 1'><title>t</title><text>no</text></svg><p>One two.</p></article>", "One two."),
    ("<article><p>Pick one. <select><option>a<option>b</p><p>Main text stays.</p></article>", "Pick one.\n\nMain text stays."),
    ("<article><p>Pick one. <select><option>a</option></select> Then go.</p></article>", "Pick one. Then go."),
    ("<article><button>Go<p>Main text stays.</p><p>More of it.</p></article>", "Main text stays.\n\nMore of it."),
    ("<article><button>Go</button><p>Main text stays.</p><button>Stop<p>More of it.</p><button>x</button></article>", "Main text stays.\n\nMore of it."),
    ("<article><iframe src=x><p>After the frame.</p></article>", "After the frame."),
    ("<article><iframe src=x><p>no</p></iframe><object><p>no</p></object><p>After the frame.</p></article>", "After the frame."),
    ("<article><template><p>no</p></template><noscript><p>no</p></noscript><p>The end of it.</p></article>", "The end of it."),
    ("<article><p>Before it.</p><script>if (a < b) <p>no</p>", "Before it."),
])
def test_elements_without_text_end_where_they_should(page, text):
    assert html_text.main_text(page, html_text.trained()) == text


@pytest.mark.parametrize("name, kept", [("nav-open", True), ("has-nav", True), ("no-sidebar layout", True), ("sticky-header-page", True),
                                        ("nav", False), ("main-nav", False), ("site-footer", False), ("cookie-notice", False), ("comment-list", False)])
def test_a_wrapper_is_around_by_a_whole_name(name, kept):
    words = "Long words in a text that goes on for a while here and says what it has to say. " * 3
    text = html_text.main_text(f"<body><div class='{name}'><h1>The title of it</h1><p>{words}</p></div></body>", html_text.trained())
    assert (words.strip() in text) == kept


def test_a_very_long_page_of_unclosed_elements():
    page = "<article>" + "<button>x<p>word word</p>" * 20000 + "<svg>" * 2000 + "</article>"
    assert html_text.main_text(page, html_text.trained()).count("word word") == 20000
