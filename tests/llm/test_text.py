"""Scores, languages and pages: against brute force, held-out accuracy and hand-made pages."""

import math
import random
import zlib
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import duckdb
import numpy as np
import pytest
from llm_reference import words
from pyspark.sql import functions as F

from quayside.llm import language, lattice_lm, main_text
from quayside.llm.queries import remainder

SF = "/root/testdata/sf0.01"


def learns(doc_id, divisor, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % divisor != value


# --- Lattice scores


def all_segmentations(spelled, scores):
    """The probability of a word, summed over every way to spell it."""
    if not spelled:
        return 1.0
    total = 0.0
    if spelled[0] not in scores:
        total += math.prod(math.exp(scores[f"<0x{b:02X}>"]) for b in spelled[0].encode()) * all_segmentations(
            spelled[1:], scores
        )
    for n in range(1, len(spelled) + 1):
        if spelled[:n] in scores and not spelled[:n].startswith("<0x"):
            total += math.exp(scores[spelled[:n]]) * all_segmentations(spelled[n:], scores)
    return total


def toy_scores():
    rng = random.Random(3)
    pieces = ["▁", "a", "b", "c", "ab", "▁a", "▁ab", "bca", "abc", "▁abcab", "é", "cc"]
    pieces += [f"<0x{b:02X}>" for b in range(256)]
    raw = {p: rng.random() for p in pieces}
    return {p: math.log(v / sum(raw.values())) for p, v in raw.items()}


@pytest.mark.parametrize("word", ["a", "abc", "abcabc", "", "éa", "xab", "ccc", "中b", "bcabcabcaab", "▁a", "<0x41>"])
def test_forward_recursion_is_the_sum_over_all_segmentations(word):
    scores = toy_scores()
    found = lattice_lm.Lattice(scores).log_probability(word)
    assert found == pytest.approx(math.log(all_segmentations("▁" + word, scores)), rel=1e-9)


def test_a_very_long_word_does_not_underflow():
    found = lattice_lm.Lattice(toy_scores()).log_probability("abc" * 20_000)
    assert math.isfinite(found) and found < -20_000


def slow_scores(rows):
    """n_tokens, n_known, N and base score by the definition, and the score by plain counting."""
    train = [words(t) for i, t in rows if learns(i, 10, 0)]
    counts = Counter(w for text in train for w in [*text, "\n"])
    total = sum(counts.values())
    processor = lattice_lm._processor(None)
    pieces = np.zeros(processor.vocab_size(), np.int64)
    for text in train:
        for w in text:
            np.add.at(pieces, processor.encode(w), 1)
    scores, end = lattice_lm.piece_scores(pieces, len(train))
    lattice = lattice_lm.Lattice(scores)
    answers = []
    for doc_id, text in rows:
        tokens = [*words(text), "\n"]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (len(counts) + 1))) for t in tokens)
        score = (sum(lattice.log_probability(t) for t in tokens[:-1]) + end) / math.log(10)
        answers.append((doc_id, len(tokens), sum(counts[t] > 0 for t in tokens), total, base, score))
    return answers


def check_scores(found, expected):
    got = defaultdict(list)
    for r in found.collect():
        got[r.doc_id].append((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    for doc_id, *rest in expected:
        assert any(g == pytest.approx(tuple(rest), rel=1e-9) for g in got[doc_id])
    assert sum(map(len, got.values())) == len(expected)


ODD = ["", None, " \n", "The THE the", "é " * 50, "x" * 3_000, "a\x00b ▁ 中文", "the " * 30_000, "The the the", "a b"]


@pytest.mark.parametrize("frequent", [1, 20, 1_000_000])
def test_scores_whatever_words_are_sent_to_all_tasks(docs, monkeypatch, frequent):
    monkeypatch.setattr(lattice_lm, "FREQUENT", frequent)
    rows = [*enumerate(ODD), (3, "again the"), (None, "no id the")]
    found = lattice_lm.score_texts(docs(*rows).withColumn("word", F.lit(1)), remainder(10) != 0)
    check_scores(found, slow_scores(rows))


def test_scores_in_small_batches(docs, monkeypatch):
    monkeypatch.setattr(lattice_lm, "COUNTED_AT_ONCE", 3)
    rows = list(enumerate(ODD[:7]))
    check_scores(lattice_lm.score_texts(docs(*rows), remainder(10) != 0), slow_scores(rows))


def test_scores_without_training_documents_and_without_any(docs):
    rows = [(1, "a b"), (2, None)]
    found = lattice_lm.score_texts(docs(*rows), F.lit(False)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found} == {
        (1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)
    }
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert lattice_lm.score_texts(docs(), remainder(10) != 0).count() == 0


def test_familiar_texts_score_higher_than_shuffled_letters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 3000")
    mixed = F.array_join(F.array_sort(F.split("text", "(?<=.)")), "")
    held = docs.where(remainder(10) == 0).select((-F.col("doc_id") - 1).alias("doc_id"), mixed.alias("text"))
    both = docs.select("doc_id", "text").unionByName(held)
    scores = {r.doc_id: r.score for r in lattice_lm.score_texts(both, (F.col("doc_id") >= 0) & (remainder(10) != 0)).collect()}
    pairs = [(scores[-i - 1], scores[i]) for i in scores if i >= 0 and -i - 1 in scores]
    assert len(pairs) > 30 and sum(a < b for a, b in pairs) > 0.9 * len(pairs)


# --- Language


@pytest.fixture(scope="module")
def net(spark):
    return language.fit(spark.read.parquet(f"{SF}/documents.parquet"), remainder(4) != 2)


def test_held_out_accuracy(spark, net):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(remainder(4) == 2)
    right = language.predict(docs, net).join(docs.select("doc_id", "lang"), "doc_id")
    assert right.where("lang = lang_pred").count() >= 0.95 * right.count()
    assert right.where("score < 0 or score > 1").count() == 0


def test_tables_give_what_filters_give(net):
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (5, language.WINDOW)).astype(np.uint8)
    windows[4, 10:] = 0
    embedded = net.embedding[windows]
    pooled = []
    for width, filters, bias in zip(language.WIDTHS, net.filters, net.biases):
        tops = np.full((5, language.FILTERS), -np.inf)
        for i in range(language.WINDOW - width + 1):
            tops = np.maximum(tops, embedded[:, i : i + width].reshape(5, -1) @ filters + bias)
        pooled.append(np.maximum(tops, 0))
    expected = language.softmax(np.concatenate(pooled, axis=1) @ net.weights + net.offset)
    assert np.allclose(language.Predictor(net).probabilities(windows), expected, atol=1e-4)


def test_gradients():
    rng = np.random.default_rng(1)
    net = language.new_network(["a", "b", "c"], rng)
    windows = rng.integers(97, 123, (4, language.WINDOW)).astype(np.uint8)
    labels = np.array([0, 2, 1, 0])

    def loss():
        tops = []
        for width, filters, bias in zip(language.WIDTHS, net.filters, net.biases):
            e = net.embedding[windows]
            n = language.WINDOW - width + 1
            responses = np.concatenate([e[:, i : n + i] for i in range(width)], axis=2) @ filters + bias
            tops.append(np.maximum(responses.max(axis=1), 0))
        p = language.softmax(np.concatenate(tops, axis=1) @ net.weights + net.offset)
        return -np.log(p[np.arange(4), labels]).mean()

    for parameter, gradient in zip(net.parameters(), language._step(net, windows, labels)):
        where = tuple(np.array(np.unravel_index(np.abs(gradient).argmax(), gradient.shape)))
        kept = parameter[where]
        parameter[where] = kept + 1e-5
        up = loss()
        parameter[where] = kept - 1e-5
        down = loss()
        parameter[where] = kept
        assert gradient[where] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_texts_are_judged_whole_and_alike_alone_and_together(net):
    sample = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' LIMIT 30").fetchall()
    texts = [t for (t,) in sample] + ["", None, "123 $$", "the of and", "x" * 300_000]
    predictor = language.Predictor(net)
    together = language.predict_texts(predictor, texts)
    alone = [language.predict_texts(predictor, [t])[0] for t in texts]
    assert [a[0] for a in together] == [a[0] for a in alone]
    assert np.allclose([a[1] for a in together], [a[1] for a in alone], atol=1e-5)
    assert [together[30 + i] for i in range(3)] == [("und", 0.0)] * 3
    french = next(t for t, a in zip(texts, alone) if a[0] == "fr")
    english = next(t for t, a in zip(texts, alone) if a[0] == "en")
    assert language.predict_texts(predictor, [english[:200] + " " + french * 30])[0][0] == "fr"


def test_language_of_odd_tables(docs, net):
    table = docs((1, None), (2, ""), (3, "12 %"), (4, "é"), (4, "the and of that"), (None, "the of in and"), (6, "z" * 50))
    found = language.predict(table.withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1)), net).collect()
    assert sorted((r.doc_id for r in found), key=repr) == sorted([1, 2, 3, 4, 4, None, 6], key=repr)
    assert all((r.lang_pred == "und") == (r.doc_id in (1, 2, 3)) for r in found)
    kept = language.keep_identified(table, net)
    assert kept.columns == table.columns and kept.count() == 4
    assert language.predict(docs(), net).count() == 0
    nothing = language.fit(docs((1, "text", None)), F.lit(True))
    assert [(r.lang_pred, r.score) for r in language.predict(docs((1, "text")), nothing).collect()] == [("und", 0.0)]


def test_only_permitted_documents_teach_and_the_sample_is_bounded(docs, monkeypatch):
    monkeypatch.setattr(language, "DOCS_PER_LANGUAGE", 20)
    rows = [(i, f"text number {i} " * 5, "en" if i % 3 else "de") for i in range(600)]
    windows = language.training_windows(docs(*rows), remainder(4) != 2)
    seen = Counter(lang for lang, _ in windows)
    assert set(seen) == {"en", "de"} and max(seen.values()) <= 3 * 45
    marked = [(i, ("held" if not learns(i, 4, 2) else "given") + " words " * 5, "en") for i in range(200)]
    monkeypatch.setattr(language, "DOCS_PER_LANGUAGE", 1000)
    assert not any(b"held" in w for _, w in language.training_windows(docs(*marked), remainder(4) != 2))


# --- Pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><p>no";</script></head>
<body class="home"><header><a href="/">Site</a></header><nav><ul><li>Menu</ul></nav>
<div class="cookie-notice">We use cookies</div><div id="wrap"><div class="post-%d content"><h1>Title &amp; more</h1>
<p>First <b>bold</b>&nbsp; text <a href="x">link</a>,<br>second   line.<p>Unclosed &lt;p&gt; &#233;&eacute;
<ul><li>one<li>two</ul><div class="ad-box">Buy</div><form>Mail <input><button>Send</button></form></div>
<aside>Other</aside><div class="comments"><p>Nice article by a reader who has very much to say about it all.</p></div>
</div><footer>&copy; me</footer></body></html>"""
TEXT = "Title & more\nFirst bold text link, second line.\nUnclosed <p> éé\none\ntwo"


def test_a_page_without_its_surroundings():
    assert main_text.main_text(PAGE % 7, {}) == TEXT
    assert main_text.best_path(main_text.blocks_of(PAGE % 7)) == "body.home/div/div.content.post-#"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("   ", ""), ("plain & simple", "plain & simple"), ("<", "<"), ("<p>a<![foo x]>b", "ab"),
        ("<article><p>a</p>tail<p>b</article><p>outside", "a\ntail\nb"), ("<!-- x --><p>a<!-- y -->b</p>", "ab"),
        ("<body><main><section><p>a</section><section><p>b</section></main><div><p>c</div>", "a\nb"),
        ("<article><header><h1>H</h1></header><p>x</article>", "H\nx"), ("<nav>only menus</nav>", ""),
        ("<article><p>&#x110000; &bogus; &amp;amp;</article>", "� &bogus; &amp;"),
        ("<table><tr><td>a<td>b</table>", "a\nb"), ("<ul><li><p>a<li>b</ul>", "a\nb"),
        ("<article><p>x<div role=navigation>n</div><textarea><p>t</textarea><p>y</article>", "x\ny"),
    ],
)
def test_odd_pages(html, text):
    assert main_text.main_text(html, {}) == text


def test_a_host_outvotes_a_page_with_a_long_sidebar(spark):
    usual = "<body><div class='text'><p>{}</div><div class='right'><p>{}</div>"
    pages = [(i, "http://a.example/x", usual.format("word " * 40, "other " * 3)) for i in range(5)]
    pages += [(9, "http://A.example:80/y", usual.format("short", "longer than the text it stands beside"))]
    pages += [(10, "http://b.example/z", usual.format("short", "longer than the text it stands beside"))]
    pages += [(11, "http://a.example/w", "<body><section><p>Another layout</section>"), (12, None, "<p>x"), (13, "::", None)]
    pages += [(None, "http://[bad", "<p>y"), (12, "http://c.example", "<p>z")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumns(
        {"host": F.lit("h"), "paths": F.lit("p"), "text": F.lit("t")}
    )
    found = [(r.page_id, r.url, r.text, r.n_chars) for r in main_text.extract(table).collect()]
    text = {i: t for i, _, t, _ in found if i not in (12, None)}
    assert text[9] == "short" and text[10] == "longer than the text it stands beside"
    assert text[0] == ("word " * 40).strip() and text[11] == "Another layout" and text[13] == ""
    assert {t for i, _, t, _ in found if i in (12, None)} == {"x", "y", "z"}
    assert {(i, u) for i, u, _, _ in found} == {(i, u) for i, u, _ in pages} and len(found) == len(pages)
    assert all(n == len(t) for _, _, t, n in found)
    assert main_text.extract(table.limit(0)).count() == 0


def test_long_pages():
    html = "<body><article>" + "<p>" + "x &lt; y " * 200_000 + "<b>" * 50_000 + "</article>"
    assert len(main_text.main_text(html, {})) == len("x < y " * 200_000) - 1
    assert main_text.main_text("<div>" * 3_000 + "deep", {}) == "deep"


WORDS = "The article goes on at some length and says what it has to say. " * 6
BESIDE = "<div class='x-sidebar'><p>Beside it</div><div class='cookie-notice'><p>We use cookies and so on.</div>"


@pytest.mark.parametrize(
    "html",
    [
        f"<div class='content-sidebar-wrap'><main><article><p>{WORDS}</article></main>{BESIDE}</div>",
        f"<div id='page' class='site right-sidebar'><div class='content'><p>{WORDS}</div>{BESIDE}</div>",
        f"<div class='page has-cookie-notice'><p>{WORDS}</p>{BESIDE}</div>",
        f"<div class='social-history-article'><p>{WORDS}</div>{BESIDE}",
        f"<article class='post search-result'><p>{WORDS}</article>{BESIDE}",
        f"<form id='aspnetForm'><div class='text'><p>{WORDS}</div><input><button>Go</button>{BESIDE}</form>",
        f"<div class='has-comments'><article><p>{WORDS}</article><div id='comments'><article class='comment-body'><p>"
        f"I have read it.</article><article class='comment-body'><p>{WORDS}{WORDS}</article></div>{BESIDE}</div>",
        f"<article><p>{WORDS}</article><div class='related'><article class='card'><p>Another story</article></div>",
    ],
)
def test_words_in_a_class_drop_no_article(html):
    assert main_text.main_text(f"<body>{html}</body>", {}) == WORDS.strip()


def test_a_page_of_a_rare_layout_keeps_its_article(spark):
    usual = [(i, "http://h.example/", f"<body><div><p>{WORDS}{i}</div>") for i in range(300)]
    rare = [(1000, "http://h.example/", f"<body><div><p>One short line</div><main><article><p>{WORDS}</article></main>")]
    table = spark.createDataFrame(usual + rare, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in main_text.extract(table).collect()}
    assert found[1000] == WORDS.strip() and found[7] == f"{WORDS}7"
    many = [(i, "http://h.example/", f"<body><div class='c{chr(97 + i)}x'><p>{WORDS}</div><p>end") for i in range(26)]
    table = spark.createDataFrame(many, "page_id bigint, url string, html string")
    assert {r.text for r in main_text.extract(table).collect()} == {WORDS.strip()}


def slow_extract(rows):
    """Vote and extraction over all pages at once."""
    seen, best = defaultdict(set), defaultdict(set)
    for i, (_, url, html) in enumerate(rows):
        blocks = main_text.blocks_of(html)
        scores = main_text.container_scores(blocks)
        host = (urlsplit(url or "").hostname or "").lower()
        for path in scores:
            seen[host, path].add(i)
        if scores:
            top = max(scores.values())
            best[host, min(p for p in scores if scores[p] == top)].add(i)
    found = []
    for i, (page_id, url, html) in enumerate(rows):
        blocks = main_text.blocks_of(html)
        scores = main_text.container_scores(blocks)
        host = (urlsplit(url or "").hostname or "").lower()
        voters = {j for (h, _), pages in best.items() for j in pages if h == host}
        known = {p for p in scores if host and len(seen[host, p]) * 100 >= len(voters)}
        chosen = None
        if scores:
            own = min(p for p in scores if scores[p] == max(scores.values()))
            winners = [p for p in known if len(best[host, p]) * 2 >= len(seen[host, p])]
            chosen = own
            if winners:
                top = max(scores[p] for p in winners)
                if own in known or 2 * top >= scores[own]:
                    chosen = min(p for p in winners if scores[p] == top)
        found.append((page_id, "\n".join(t for path, t, _ in blocks if not chosen or path[: len(chosen)] == chosen)))
    return sorted(found, key=repr)


def test_votes_and_texts_of_whole_tables(spark):
    pick = random.Random(4)
    layouts = ["<div class='a'><p>{}</div><div class='b'><p>{}</div>", "<main><p>{}</main><div><p>{}</div>", "<p>{}<p>{}"]
    layouts += ["<section><div class='t-{}'><p>x</div><p>{}</section>", "<article><p>{}</article><article><p>{}</article>"]
    pages = []
    for i in range(240):
        html = pick.choice(layouts).format("word " * pick.randrange(9), "other " * pick.randrange(9))
        host = pick.choice(["a.example", "A.example:8080", "u:p@b.example", "[::1]:80", "", None])
        pages.append((i % 200, None if host is None else f"http://{host}/p?q#f", pick.choice([html, html, html, None, ""])))
    stored = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    for rows in (pages, stored):
        table = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
        assert sorted(((r.page_id, r.text) for r in main_text.extract(table).collect()), key=repr) == slow_extract(rows)
