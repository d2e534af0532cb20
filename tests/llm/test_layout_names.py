"""Pages whose wrapper or markup once cost them their text."""

import pytest

from pairforge.llm.html_text import main_text

LONG = "A long paragraph of the article itself, which says what happened, when and to whom, and why it matters to the readers of this page."
AD = "Buy the very best of our products today, with a discount for all new customers who order before the end of this month."
FRAME = "<nav><a href=/>Home</a></nav>{}<footer>All rights reserved by the owners of this page.</footer>"
BODY = f"<h1>Head of the article</h1><p>{LONG}</p><p>{LONG}</p>"
TEXT = f"Head of the article\n\n{LONG}\n\n{LONG}"


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "layout has-sidebar", "site no-sidebar", "page_with_sidebar", "sidebar-content-wrapper"])
def test_layout_modifiers_are_no_boilerplate(name):
    assert main_text(FRAME.format(f'<div class="{name}">{BODY}</div>')) == TEXT


@pytest.mark.parametrize("box", ["div class='site sidebar'", "section id=search-page", "div class='right-sidebar'"])
@pytest.mark.parametrize("inner", ["main", "article", "div role=main", "article class=post"])
def test_main_and_article_begin_anew(box, inner):
    page = f"<{box}><div><{inner}>{BODY}</{inner.split()[0]}></div><div class=ad><p>{AD}</p></div></{box.split()[0]}>"
    assert main_text(FRAME.format(page)) == TEXT


@pytest.mark.parametrize("box", ["div class=sidebar", "section id=comments", "div class=footer-wrap", "ul class=menu", "div class=related-posts", "div class=sidebar><article class=widget"])
def test_named_boxes_stay_boilerplate(box):
    page = f"<main>{BODY}</main><{box}><div><p>{AD}</p></div></{box.split()[0]}>"
    assert main_text(FRAME.format(page)) == TEXT


def test_articles_of_a_listing_stay_in_it():
    comments = f"<section id=comments><article><p>{AD}</p></article><article class=comment-body><div class=content><p>{AD}</p></div></article></section>"
    assert main_text(FRAME.format(f"<main><article>{BODY}</article>{comments}</main>")) == TEXT
    assert main_text(FRAME.format(f"<aside><article><p>{AD}</p></article></aside><main>{BODY}</main>")) == TEXT


@pytest.mark.parametrize("tag", ["button", "select", "object", "noscript", "svg", "iframe", "video"])
@pytest.mark.parametrize("later", ["", "<div><{0}>Later</{0}></div>"])
def test_unclosed_elements_end_with_their_box(tag, later):
    page = f"<div><{tag} class=x><i>{AD}</div><div>{BODY}</div>" + later.format(tag)
    assert main_text(FRAME.format(page)) == TEXT
    assert main_text(f"<{tag}>{AD}<article>{BODY}</article>" + later.format(tag)) == TEXT


def test_empty_svg_and_closed_elements():
    assert main_text(f"<svg class=x/><article>{BODY}</article><svg><g></g></svg>") == TEXT
    closed = f"<template><article><p>{AD}</p></article></template><noscript><div><p>{AD}</p></div></noscript><object><object>{AD}</object><p>{AD}</p></object>"
    assert main_text(f"{closed}<article>{BODY}</article><script>'<p>' + {AD}") == TEXT
    assert main_text(f"<article><p>{LONG} <select><option>a</option></select> {LONG}</p></article>") == f"{LONG} {LONG}"
