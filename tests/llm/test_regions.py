"""No content outside the largest region of a page is lost."""

from __future__ import annotations

import time

from clustrata.llm import html_extract
from clustrata.llm.html_extract import extract

LEAD, BODY, SHORT = ("lead words " * 18).strip(), ("body words " * 18).strip(), "<div>" + "<p>x</p>" * 6 + "</div>"


def test_lead_beside_a_long_body():
    page = f"<body>{SHORT}<div><div>{f'<p>{LEAD}</p>' * 2}</div><div>{f'<p>{BODY}</p>' * 30}</div></div></body>"
    assert extract(page) == [LEAD] * 2 + [BODY] * 30


def test_every_article_with_evidence():
    page = f"<body>{SHORT}<article>{f'<p>{LEAD}</p>' * 3}</article><article>{f'<p>{BODY}</p>' * 6}</article>{SHORT}</body>"
    assert extract(page) == [LEAD] * 3 + [BODY] * 6


LINKS = "<ul>" + "".join(f"<li><a href=/{i}>go {i}</a>" for i in range(30)) + "</ul>"


def test_smoothing_decides_the_region(monkeypatch):
    """One long line among links is no content; without smoothing it would be, and the links come with it."""
    odd = f"<div>{LINKS}<p>{LEAD}</p>{LINKS}</div>"
    page = f"<body>{odd}<div>{f'<p>{BODY}</p>' * 12}<p>Short end.</p></div></body>"
    assert extract(page) == [BODY] * 12 + ["Short end."]
    monkeypatch.setattr(html_extract, "smoothed", lambda values: values)
    assert "go 3" in extract(page)


def test_ratios_decide_the_region(monkeypatch):
    page = f"<body><div>{LINKS}</div><div>{f'<p>{BODY}</p>' * 3}</div></body>"
    assert extract(page) == [BODY] * 3
    monkeypatch.setattr(html_extract, "threshold", min)
    assert "go 3" in extract(page)


def test_words_in_a_sentence_are_never_marked():
    page = '<article><p>See the <span class="search-term">needle</span> and <a class="comment-link" href=x>go</a> on.</p><p class="x">Next <span hidden>nix <b>no</b></span> one.</p></article>'
    assert extract(page) == ["See the needle and go on.", "Next one."]


def test_a_class_that_names_the_page():
    page = f'<body><div class="widget-area">{f"<p>{BODY}</p>" * 5}</div></body>'
    assert extract(page) == [BODY] * 5
    page = f'<body><div>{f"<p>{BODY}</p>" * 5}</div><div class="comments">{f"<p>{LEAD}</p>" * 9}</div></body>'
    assert extract(page) == [BODY] * 5


def test_unended_markup_and_deep_nesting():
    assert extract("<article><p>First one.</p><!-- a <b>x</b> <p>leak") == ["First one."]
    assert extract("<body>" + "<div><p>words that go on and on</p>" * 8000) == ["words that go on and on"] * 8000
    began = time.process_time()
    extract("<div class=a>" * 100_000 + "x" + "</p>" * 100_000)
    assert time.process_time() - began < 10  # linear; the square would take minutes


def test_a_very_long_page():
    assert extract(f"<body>{LINKS}<div>" + f"<p>{BODY}</p>" * 20_000 + "</div></body>") == [BODY] * 20_000
