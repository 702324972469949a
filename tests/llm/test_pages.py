"""Pages whose frames, comments or broken tags used to mislead the extraction, and the ratios in plain Python."""

import math
import random
import time

import numpy as np
import pytest

from bedfeed.llm import html

PARAGRAPH = "This is paragraph number {}, with some words, and marks; it goes on for a while."


def paragraphs(n):
    return "".join(f"<p>{PARAGRAPH.format(k)}</p>" for k in range(n))


FRAMES = ["<form id='aspnetForm'>{}</form>", "<fieldset>{}</fieldset>", "<div class='sidebar-left'>{}</div>", "<aside>{}</aside>", "<menu>{}</menu>"]


@pytest.mark.parametrize("frame", FRAMES)
def test_frames_around_a_whole_page(frame):
    assert html.main_text("<html><body>" + frame.format(paragraphs(8)) + "</body></html>").split("\n") == [PARAGRAPH.format(k) for k in range(8)]


@pytest.mark.parametrize("frame", [*FRAMES, "<dialog>{}</dialog>"])
def test_frames_beside_a_text(frame):
    page = "<html><body><div>" + paragraphs(5) + "</div>" + frame.format("<p>Sign up for more, now, and win!</p>") + "</body></html>"
    assert html.main_text(page).split("\n") == [PARAGRAPH.format(k) for k in range(5)]


COMMENTS = [
    "<div id='comments'>{}</div>", "<section class='comment-list'>{}</section>", "<div class='replies'><article class='comment'>{}</article></div>",
    "<div id='disqus_thread'>{}</div>", "<div class='related'><article>{}</article></div>",
]


@pytest.mark.parametrize("comments", COMMENTS)
@pytest.mark.parametrize("story", ["<article><h1>Title</h1>{}</article>{}", "<div class='story'><h1>Title</h1>{}</div>{}", "<article><h1>Title</h1>{}{}</article>"])
def test_many_comments_below_a_short_story(story, comments):
    page = f"<html><body>{story.format(paragraphs(3), comments.format(paragraphs(40)))}</body></html>"
    assert html.main_text(page).split("\n") == ["Title", *[PARAGRAPH.format(k) for k in range(3)]]


def test_a_wrapper_with_comments_in_its_name():
    page = f"<html><body><div class='content-comments'><h1>Title</h1>{paragraphs(6)}</div></body></html>"
    assert len(html.main_text(page).split("\n")) == 7


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a \"'" * 200_000 + ">", "<a " * 300_000 + '">"', "<div>" * 100_000 + "x", "<div>x" * 60_000, "<b>" * 60_000 + "<p>x" * 60_000,
    "<i>" * 50_000 + "</u>" * 100_000, "<!" * 300_000, "<div class=ads>t" * 50_000, '<a href="' + "<b>x</b>" * 100_000, "<!--" * 200_000, "<script>" * 100_000,
])
def test_broken_pages_take_time_and_memory_by_their_length(page):
    start = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - start < 8


def test_unclosed_tags_are_text():
    assert html.main_text("<p>one < two <b") == "one < two <b"
    assert html.main_text("<p title='>'>quoted</p><p title=\"a>b\">twice</p>") == "quoted\ntwice"


def ratios(chars, marks, count, main, side):
    """The fused ratios and thresholds, step by step."""
    n = len(chars)
    ratio = [c / k for c, k in zip(chars, count, strict=True)]
    marked = [1 + m / k for m, k in zip(marks, count, strict=True)]

    def smooth(x):
        return x if n < 3 else [0.25 * x[max(i - 1, 0)] + 0.5 * x[i] + 0.25 * x[min(i + 1, n - 1)] for i in range(n)]

    def spread(x):
        mean = sum(x) / len(x)
        return math.sqrt(sum((v - mean) ** 2 for v in x) / len(x))

    fused = [math.sqrt(a * b * c * d) for a, b, c, d in zip(smooth(ratio), smooth(marked), ratio, marked, strict=True)]
    held = 0
    if any(main):
        held = sum(c for c, m, s in zip(chars, main, side, strict=True) if m and not s) / max(1, sum(c for c, s in zip(chars, side, strict=True) if not s))
        fused = [f if m else f * max(html.OUTSIDE, 1 - 2 * held) for f, m in zip(fused, main, strict=True)]
    fused = [f * html.SIDE if s else f for f, s in zip(fused, side, strict=True)]
    known = fused if all(side) else [f for f, s in zip(fused, side, strict=True) if not s]
    limit = min(max(known), max(spread(known), html.SHARE * max(known)))
    inside = [f for f, m, s in zip(fused, main, side, strict=True) if m and not s]
    own = min(limit, max(inside), max(spread(inside), html.SHARE * max(inside))) if held >= html.HELD else limit
    return fused, [own if m and not s else limit for m, s in zip(main, side, strict=True)]


def test_ratios_of_random_paths():
    random.seed(6)
    for _ in range(300):
        n = random.randint(1, 12)
        count = [random.randint(1, 9) for _ in range(n)]
        chars, marks = [k * random.randint(1, 300) for k in count], [random.randint(0, 20) for _ in count]
        main, side = ([random.random() < p for _ in count] for p in (random.choice([0, 0.4]), 0.3))
        found = html.path_ratios(*(np.array(x, float) for x in (chars, marks, count)), np.array(main), np.array(side))
        for a, b in zip(found, ratios(chars, marks, count, main, side), strict=True):
            assert np.allclose(a, b)


def test_rows_of_pages(spark):
    page = "<p>one, two</p>"
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (1, "u", "<p>other</p>", "x"), (2, None, None, "x"), (None, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(map(str, map(tuple, html.extracted(pages).collect()))) == sorted(map(str, [
        (1, "u", "one, two", 8), (1, "u", "one, two", 8), (1, "u", "other", 5), (2, None, "", 0), (None, "u", "", 0)]))
    assert html.extracted(pages.limit(0)).collect() == []
