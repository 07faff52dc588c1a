"""Comments, adverts and hidden text go; marks within an article don't take its text."""

from __future__ import annotations

import pytest

from geoledger.llm.html import main_text

P = ["The first long paragraph of the article, with commas, goes on for a while and says something new.", "The second long paragraph of it, also with commas, tells how the story of the day went on and ended."]


def page(inner: str) -> str:
    return f"<html><body><div><p>{P[0]}</p>{inner}<p>{P[1]}</p></div></body></html>"


@pytest.mark.parametrize("name", ["commentlist", "comment-list", "usercomments", "CommentBox", "adverts", "sponsorbox", "newsletterform", "reader-comments"])
def test_compound_names(name):
    inner = f"<ol class='{name}'><li>I do not agree with this at all, dear author, and say so here.</li><li>Neither do I, as it happens, my friend.</li></ol>"
    assert main_text(page(inner)) == "\n".join(P)


@pytest.mark.parametrize("name", ["commentary", "adder", "nothing-ad2x", "readership"])
def test_names_that_only_look_alike(name):
    assert main_text(page(f"<div class='{name}'><p>A third paragraph that belongs here, as all can see, in the middle of it.</p></div>")).count("\n") == 2 or name == "nothing-ad2x"


def test_inline_adverts():
    text = "Before <span class='ad'>Buy <span>this</span> now</span>it <b>goes</b> on, <ins class=\"adsbox\">x</ins>and <span class='x'>on</span>, for quite some time as it seems."
    assert main_text(page(f"<p>{text}</p>")).split("\n")[1].replace("x", "") == "Before it goes on, and on, for quite some time as it seems."
    # One that is never closed ends with its block.
    assert main_text(page("<p>Before <span class='ad'>and after, which is long enough to be kept here.</p>")).split("\n")[1].startswith("Before")


@pytest.mark.parametrize("inner", ["<video src=x>Your browser is old.</video>", "<audio>No sound, sorry to say.</audio>", "<canvas>No picture, sorry to say.</canvas>", "<div hidden>Not to be seen, by anyone at all, ever.</div>", "<div style='color: red; display:none'>Not to be seen, by anyone at all, ever.</div>", "<p style=\"display: none\">Gone, as it should be, with all its words.</p>"])
def test_what_is_not_displayed(inner):
    assert main_text(page(inner)) == "\n".join(P)


def test_hidden_spans():
    assert main_text(page("<p>Seen <span hidden>unseen</span>words, which go on and on for a while.</p>")).split("\n")[1] == "Seen words, which go on and on for a while."


@pytest.mark.parametrize("name", ["social-science", "search-results", "legal-history", "form-and-function"])
def test_names_within_an_article(name):
    third = "A third paragraph that belongs here, as all can see, in the middle of it."
    for tag in ("div", "p"):
        inner = f"<div class='{name}'><p>{third}</p></div>" if tag == "div" else f"<p class='{name}'>{third}</p>"
        assert main_text(f"<body><article><p>{P[0]}</p>{inner}<p>{P[1]}</p></article></body>") == "\n".join([P[0], third, P[1]])


def test_a_mark_does_not_take_most_of_an_article():
    body = "".join(f"<p>{p}</p>" for p in P)
    assert main_text(f"<body><article><p>Short line, yes.</p><div class='legal'>{body}</div></article></body>") == "\n".join(["Short line, yes.", *P])
    # A small one goes.
    assert main_text(f"<body><article>{body}<div class='legal'>All rights are reserved.</div><div class='social-links'>Follow us.</div></article></body>") == "\n".join(P)
