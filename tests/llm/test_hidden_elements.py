"""Hidden elements take their own content and nothing behind it."""

from __future__ import annotations

import time

import pytest

from geoledger.llm import html

ONE, TWO = "First paragraph, with commas, that goes on for a while, as texts do.", "Second one, also long enough, to count as text of the article."


@pytest.mark.parametrize(
    "between",
    [
        "<svg width=5 />",
        "<svg/>",
        "<math />",
        '<svg class="x"/><svg><path d="M0"/><title/><text>no</text></svg>',
        "<button>",
        "<select>",
        "<object data='x'>",
        "<object>no<object>no</object>no</object>",
        "<template><p>no<template><p>no</template><p>no</template>",
        "<svg><g><svg>no</svg>no</g></svg>",
        "<svg><foreignObject><div>no</div></foreignObject></svg>",
        "<svg><path>",
        "<noscript><p>no</noscript><select><option>no</select>",
        "<button>no</button>",
        "<script>'<svg>'</script><textarea><button></textarea>",
    ],
)
def test_text_around_hidden_elements(between):
    got = html.main_text(f"<body><div><p>{ONE}</p>{between}<p>{TWO}</p></div></body>")
    assert got == f"{ONE}\n{TWO}"


def test_a_word_in_a_button_splits_no_block():
    assert html.main_text(f"<div><p>{ONE}<button>no</button> Then <svg/>more.</p></div>") == f"{ONE} Then more."


def test_an_unclosed_button_ends_with_its_block():
    assert html.main_text(f"<article><div><button></div><p>{ONE}</p><p>{TWO}</p><div><button>no</button></div></article>") == f"{ONE}\n{TWO}"


def test_unclosed_raw_text_goes_to_the_end():
    assert html.main_text(f"<div><p>{ONE}</p><script>no<p>{TWO}</p></div>") == ONE


def test_many_hidden_elements_take_linear_time():
    start = time.time()
    html._tags("<div><object><button><svg>" * 20_000 + "<button>" * 20_000 + "</div>" * 20_000 + "<svg/>" * 20_000)
    assert time.time() - start < 10
