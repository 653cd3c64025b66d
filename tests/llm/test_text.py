import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesmart.llm import llr_quality, simhash_decontam, style_tree

from .conftest import passage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_quality_counts_and_verdict(spark, both, empty):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select(
        (F.col("doc_id") + 100).alias("doc_id"), "quality", "toxic")
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 0), (5, None, None)], labels.schema))
    rows = llr_quality.score(both, labels).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                 for r in rows)
    assert got == sorted((str(r.doc_id), *base_counts(r.text)) for r in both.collect())
    assert all(not (r.base_failed and r.kept) for r in rows)
    assert all(r.kept == (r.llr >= -0.1) for r in rows if not r.base_failed and abs(r.llr + 0.1) > 1e-5)
    truth = {r.doc_id: r for r in labels.where("doc_id >= 100").collect()}
    good = [r.kept for r in rows if r.doc_id in truth and not r.base_failed and truth[r.doc_id].quality == 1]
    bad = [r.kept for r in rows if r.doc_id in truth and not r.base_failed and truth[r.doc_id].quality == 0]
    assert sum(good) >= 0.8 * len(good) and sum(bad) <= 0.2 * len(bad)
    assert llr_quality.score(empty, labels).count() == 0
    assert llr_quality.score(both, labels.limit(0)).where("kept").count() > 0


def leaks(rows, items, least=0.75):
    low = lambda t: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                     for w in WORD.findall(t or "")]
    out = {}
    for item, text in items:
        w = low(text)
        if not w:
            continue
        k = min(5, len(w))
        own = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        n = len(w) - k + 1
        for r in rows:
            d = low(r.text)
            s = [tuple(d[i : i + k]) for i in range(len(d) - k + 1)]
            for at in range(len(s) - n + 1):
                both = sum((Counter(s[at : at + n]) & own).values())
                if both >= least * (2 * n - both):
                    key = (str(r.doc_id), str(item))
                    out[key] = max(out.get(key, (0, 0)), (both / (2 * n - both), -at))
    return out


def test_decontamination(spark, odd, empty):
    items = [(1, passage(1, 40)), (2, passage(2, 30)), (3, "a b c"), (4, "one"), (5, None), (6, " "), (None, passage(3, 18)),
             (7, " ".join(["same"] * 12)), (8, passage(1, 40).upper()), (9, "not to be found anywhere at all")]
    benchmark = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, k int")
    rows = odd.where("doc_id is null or doc_id not in (10, 11, 12)")
    got = {(str(r.doc_id), str(r.item_id)): (r.similarity, -r.start) for r in simhash_decontam.contaminated(
        rows, benchmark).collect()}
    want = leaks(rows.collect(), items)
    assert {k: (pytest.approx(s), a) for k, (s, a) in want.items()} == got
    kept = simhash_decontam.clean(rows, benchmark)
    assert kept.columns == rows.columns
    bad = {i for i, _ in want}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows.collect() if str(r.doc_id) not in bad)
    assert simhash_decontam.contaminated(empty, benchmark).count() == 0
    assert simhash_decontam.contaminated(rows, benchmark.limit(0)).count() == 0


def test_blocks_find_all_within_radius():
    edges = simhash_decontam._edges(24)
    assert len(edges) == 25 and sum(mask.bit_length() for _, mask in edges) == 64
    assert all(lo + mask.bit_length() == nxt for (lo, mask), (nxt, _) in zip(edges, edges[1:]))


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><b";</script></head><body>
<nav><ul><li><a href="x">Home</a></ul></nav><div class="ad">Buy</div><div id="cookie-notice">Ok</div>
<article><h1>T&eacute;st &amp; <i>more</i></h1><p><b>One<br>two<p>Three   four
five<div class="comments"><p>Reader</div><form>f</form><aside>z</aside>tail</article><footer>&copy;</footer>"""


def test_main_text():
    assert style_tree.main_text(PAGE) == "Tést & more\n\nOne two\n\nThree four five\n\ntail"
    for broken in ("", "<", "<p", "a < b", "</p></p>", "<script>x", "<!-- x", "<p a='", "<div>" * 3000 + "deep", "\x00&#0;&bogus;"):
        style_tree.main_text(broken)
    assert style_tree.main_text("<div>" * 3000 + "deep") == "deep"


def test_style_tree_removes_what_a_site_repeats(spark):
    body = lambda i: f"<body><div class=top><p>Welcome to us</p><p>All you need</p></div><div class=text><p>{passage(i, 30)}</p></div></body>"
    rows = [(i, f"http://a.org/{i}", body(i), 1) for i in range(1, 9)]
    rows += [(20, "http://b.org/1", body(20), 1), (21, None, None, 1), (22, "http://a.org/x", "", 1), (22, "http://a.org/x", "", 1),
             (None, "HTTP://A.org/9", body(9), 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, noise int")
    got = style_tree.extract(pages).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert all(texts[i] == passage(i, 30) for i in range(1, 9)) and texts[None] == passage(9, 30)
    assert texts[20] == f"Welcome to us\n\nAll you need\n\n{passage(20, 30)}"  # a single page has nothing to compare
    assert texts[21] == texts[22] == "" and all(r.n_chars == len(r.text) for r in got)
    assert style_tree.extract(pages.limit(0)).count() == 0


def test_style_tree_decides_inside_articles(spark):
    box = "<div class=who><p>All of us write here every day</p></div>"
    page = lambda i: f"<body><article><h1>{passage(i, 5)}</h1><p>{passage(i, 30)}</p>{box}</article></body>"
    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(1, 13)]
    rows += [(20 + i, f"http://b.org/{i}", page(i)) for i in range(1, 6)]  # too few pages to judge articles by
    rows += [(40 + i, f"http://c.org/{i}", page(1)) for i in range(1, 13)]  # copies throughout
    texts = {r.page_id: r.text for r in style_tree.extract(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect()}
    assert all(texts[i] == f"{passage(i, 5)}\n\n{passage(i, 30)}" for i in range(1, 13))
    whole = lambda i: f"{passage(i, 5)}\n\n{passage(i, 30)}\n\nAll of us write here every day"
    assert all(texts[20 + i] == whole(i) for i in range(1, 6)) and all(texts[40 + i] == whole(1) for i in range(1, 13))


def test_text_around_a_teaser_stays():
    teaser, body = "<article><p>Read on</p></article>", f"<div class=body><p>{passage(2, 40)}</p></div>"
    assert style_tree.main_text(body + teaser) == f"{passage(2, 40)}\n\nRead on"
    assert style_tree.main_text(f"<main>{teaser}</main>{body}") == "Read on"


@pytest.mark.parametrize("name", ["has-sidebar", "with-sidebar", "no-comments", "fixed-header", "page-with-nav",
                                  "search-results", "social-science", "sidebar", "menu"])
def test_names_of_wrappers_empty_no_page(name):
    body = "<h1>Title</h1><p>Some text</p>"
    noise = "<div class=sidebar><p>Links</p></div><div id=cookie-notice>Ok</div>"
    for page in (f"<body class='{name}'>{body}{noise}</body>", f"<html id={name}><div>{body}</div>{noise}",
                 f"<div class='{name} x'><article>{body}</article>{noise}</div>", f"<main class={name}>{body}{noise}</main>",
                 f"<main><div class={name}><article>{body}</article></div>{noise}</main>"):
        assert style_tree.main_text(page) == "Title\n\nSome text"


def test_names_that_hold_a_noise_word_are_left_to_the_tree():
    assert style_tree.main_text("<div class=post-header><h1>Title</h1></div><p>Text</p>") == "Title\n\nText"
    assert style_tree.main_text("<div class=header>Site</div><p>Text</p><div class=main-nav>Go</div><div class=ad1>Buy</div>") == "Text"
    assert style_tree.main_text("<article><div class=header>By me</div><p>Text</p><p class=sidebar>Off</p></article>") == "By me\n\nText"
    comments = "<div class=comments><article><p>Reader</p></article></div>"
    assert style_tree.main_text(f"<article><p>Text</p></article>{comments}") == "Text"


def test_documents_shorter_than_the_item(spark):
    words = passage(1, 40).split()
    items = spark.createDataFrame([(1, " ".join(words)), (2, passage(2, 12)), (3, "a b c")], "item_id long, text string")
    texts = [words[:39], words[1:], words[:32], words[:31], words[:30] + ["x"] * 9, words[5:39], words[:4], passage(2, 12).split()[:-2],
             ["a", "b"], words[3:36], words, ["x"] * 3 + words[:39]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    want = {}
    for item in items.collect():
        w = item.text.split()
        k = min(5, len(w))
        grams = lambda x: [tuple(x[i : i + k]) for i in range(len(x) - k + 1)]  # noqa: B023, E731
        own = Counter(grams(w))
        for i, t in enumerate(texts):
            s = grams(t)
            n = min(len(s), len(w) - k + 1)
            for at in range(len(s) - n + 1):
                window = Counter(s[at : at + n])
                both = (window & own).total()
                like = both / ((window | own).total())
                if like >= 0.75:
                    want[i, item.item_id] = max(want.get((i, item.item_id), (0, 0, 0)), (like, -at, n + k - 1))
    got = {(r.doc_id, r.item_id): (r.similarity, -r.start, r.n_words) for r in simhash_decontam.contaminated(docs, items).collect()}
    assert len(want) >= 7 and {k: (pytest.approx(s), a, n) for k, (s, a, n) in want.items()} == got
    bad = {i for i, _ in want}
    assert sorted(r.doc_id for r in simhash_decontam.clean(docs, items).collect()) == [i for i in range(len(texts)) if i not in bad]
