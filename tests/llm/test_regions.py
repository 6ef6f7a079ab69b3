"""Main text: whole articles without readers' words and adverts, region choice against all intervals."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tillwise.llm import html_text

SENTENCE = "The harbour was quiet that morning and the boats lay still under a pale sky until noon came. "
BODY = "<h1>Quiet harbour</h1>" + "".join(f"<p>{SENTENCE * 3}{i}</p>" for i in range(4))
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/a'>About us</a></li></ul></nav>"
FOOT = "<footer><p>All rights reserved by the harbour news company in this town</p></footer>"


@pytest.fixture(scope="module")
def weights(spark):
    sf = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    return html_text.learn(sf)


def text_of(html):
    return " ".join(re.sub(r"<[^>]+>", " ", html).split())


def page(inside, after="", open_tag="<article>", close="</article>"):
    return f"<html><body>{MENU}{open_tag}{inside}{close}{after}{FOOT}</body></html>"


KEPT = [
    "<ul><li>list item one</li><li>list item two</li></ul>",
    "<p><a href=x>Read this linked paragraph too</a></p>",
    "<table><tr><td>1</td><td>two</td></tr></table>",
    "<blockquote>So it was</blockquote>",
    "<p>ok</p>",
]


@pytest.mark.parametrize("extra", KEPT)
@pytest.mark.parametrize("hidden", [False, True])
def test_short_parts_stay(weights, extra, hidden):
    tags = ("<div>", "</div>") if hidden else ("<article>", "</article>")
    for inside in (BODY + extra, extra + BODY, BODY + extra + BODY):
        assert html_text.main_text(page(inside, "", *tags), weights) == text_of(inside)


@pytest.mark.parametrize("name", [
    "user-comments", "user-reviews", "adsbygoogle", "ad-slot-1", "comments", "comment-list", "post-ads2", "site-footer", "cookie-notice",
])
@pytest.mark.parametrize("words", ["short one", SENTENCE * 4])
def test_readers_and_adverts_go(weights, name, words):
    if name == "post-ads2":
        name = "ads2"
    extra = f"<div class='{name}'><p>{words}</p></div>"
    for inside, after in ((BODY + extra, ""), (BODY, extra), (BODY.replace("</h1>", "</h1>" + extra), "")):
        for tags in (("<article>", "</article>"), ("<div>", "</div>")):
            assert html_text.main_text(page(inside, after, *tags), weights) == text_of(BODY)


@pytest.mark.parametrize("name", ["entry-content no-ads", "post comments-open", "article-body", "no-sidebar", "has-comments"])
def test_states_and_own_words_stay(weights, name):
    inside = f"<div class='{name}'>{BODY}</div>"
    assert html_text.main_text(page(inside), weights) == text_of(BODY)


def test_long_asides_without_any_mark():
    extra = f"<aside>{SENTENCE * 5}</aside><div class='sidebar'>{SENTENCE * 5}</div><div class='cookie-notice'>{SENTENCE * 5}</div>"
    html = f"<html><body>{extra}<div>{BODY}</div>{extra}</body></html>"
    assert html_text.main_text(html, {}) == text_of(BODY)


def test_region_is_the_best_interval(weights, monkeypatch):
    monkeypatch.setattr(html_text, "widened", lambda start, end, _: (start, end))
    rng = random.Random(4)
    bits = ["<p>", "</p>", "<div>", "</div>", "<a href=x>", "</a>", "<br>", "<b>", "</b>", "word ", "two words ", SENTENCE, "<li>"]
    for _ in range(300):
        html = "".join(rng.choices(bits, k=rng.randint(0, 25)))
        found, _, _ = html_text.items(html)
        scores = [n * html_text.weigh(name, weights) for name, n in html_text.described(found)]
        best = max([sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)], default=0)
        texts = {""} if best <= 1e-9 else {
            text_of("".join(t if k != "tag" else ("" if t.removeprefix("/") in html_text.INLINE else " ") for t, k, *_ in found[i:j]))
            for i in range(len(scores)) for j in range(i + 1, len(scores) + 1) if sum(scores[i:j]) >= best - 1e-9
        }
        assert html_text.main_text(html, weights) in texts


def test_given_pages_with_hidden_marks(spark, weights):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    hidden = pages.withColumn("html", F.regexp_replace("html", r"(?i)(</?)article\b", "$1div"))
    own = {r.page_id: r.text for r in html_text.extract_text(pages, weights).collect()}
    assert {r.page_id: r.text for r in html_text.extract_text(hidden, weights).collect()} == own
