"""Tree scoring against a scorer that walks a tree of nodes by recursion, and pages with misleading names."""

from __future__ import annotations

import random
import time

import pytest

from geoledger.llm import html

P = "First paragraph, with commas, that goes on for a while, as texts do."
Q = "Second one, also long enough, to count as text of the article."


class Node:
    def __init__(self, tag, up=None, text="", linked=0, links=0):
        self.tag, self.up, self.text, self.linked, self.links, self.kids = tag, up, text, linked, links, []

    def all(self):
        return [self] + [x for k in self.kids for x in k.all()]

    def source(self):
        inner = self.text[: len(self.text) - self.linked] + (f"<a href=x>{self.text[-self.linked :]}</a>" if self.linked else "")
        return f"<{self.tag}>" + inner + "".join(k.source() for k in self.kids) + f"</{self.tag}>"


def grown(rng, tag, up, depth):
    node = Node(tag, up)
    if tag in ("p", "h1", "li"):
        words = [rng.choice(["word", "more,", "texts", "a", "longer-word,"]) for _ in range(rng.randrange(2, 40 if tag == "p" else 8))]
        node.text = " ".join(words)
        if rng.random() < 0.3:
            node.linked = len(words[-1])
            node.links = 1
        if tag == "li" and rng.random() < 0.5:
            node.text, node.linked, node.links = "linked", 6, 1
        return node
    for _ in range(rng.randrange(1, 5)):
        kinds = ["p", "p", "p", "h1", "ul"] + (["div", "section", "article", "nav"] if depth < 4 else [])
        kind = rng.choice(kinds) if tag != "ul" else "li"
        node.kids.append(grown(rng, kind, node, depth + 1))
    return node


def expected(root):
    def inside(x, tags):
        return x is not None and (x.tag in tags or inside(x.up, tags))

    nodes = [x for x in root.all() if not inside(x, ("nav",))]
    blocks = [x for x in nodes if x.text]

    def points(x):
        total = 0.0
        for b in blocks:
            up, value = b, 1 + b.text.count(",") + min(len(b.text) / 100, 3)
            while up.up is not None and up is not x:
                up, value = up.up, value if up is b else value / 2
            if up is x and x is not b:
                total += value
        held = [b for b in blocks if b in x.all()]
        return (total + 25 * (x.tag in ("article", "main") and total > 0)) * (1 - sum(b.linked for b in held) / max(1, sum(len(b.text) for b in held)))

    order = root.all()
    score = {id(x): points(x) for x in nodes}
    best = max((x for x in nodes), key=lambda x: (round(score[id(x)], 9), -order.index(x)))

    if not score[id(best)]:
        return "\n".join(b.text for b in blocks if 2 * b.linked < len(b.text))

    def menu(x):
        held = [b for b in blocks if b in x.all()]
        return x is not best and sum(b.links for b in held) > 2 and sum(b.linked for b in held) > 0.6 * sum(len(b.text) for b in held) and not inside(x, ("article",)) and x.tag in ("ul", "div", "section")

    def fits(x):
        if x is best:
            return True
        if x.up is not best.up or x.up is None:
            return False
        return x.tag == "h1" or score.get(id(x), 0) >= max(10, 0.2 * score[id(best)]) or x.tag == "p" and len(x.text) > 80 and 4 * x.linked < len(x.text)

    out = []
    for b in blocks:
        up, found = b, False
        while up is not None and not menu(up) and not found:
            found = fits(up)
            up = up.up
        if found:
            out.append(b.text)
    return "\n".join(out)


def test_random_pages_against_a_recursive_scorer():
    rng = random.Random(6)
    seen = set()
    for _ in range(400):
        root = Node("body")
        root.kids = [grown(rng, rng.choice(["div", "section", "article"]), root, 1) for _ in range(rng.randrange(1, 4))]
        want = expected(root)
        assert html.main_text(root.source()) == want
        seen.add(want)
    assert len(seen) > 300


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='page has-sidebar'><p>{P}</p><p>{Q}</p><div class='ad'>Buy, now</div><div class='comments'><p>{P} no, no</p></div></div>",
        f"<div class='page sidebar-right'><p>{P}</p><p>{Q}</p><div class='sidebar'><p>no</p></div></div>",
        f"<p>Hi</p><div id='layout-with-menu'><p>{P}</p><p>{Q}</p></div>",
        f"<form id='aspnetForm'><div><p>{P}</p><p>{Q}</p></div><div class='search'>no</div></form>",
        f"<div class='comments-open ads'><article><p>{P}</p><p>{Q}</p></article><div class='comment'><p>no, no</p></div></div>",
        f"<header class='banner'><p>no, no</p></header><div><p>{P}</p><p>{Q}</p></div><div class='comment-list'><div><p>{P}, {P}, {P}, {P}</p></div></div>",
        f"<main><p>{P}</p><p>{Q}</p></main><div class='newsletter'><form><p>Your name, please</p></form></div>",
    ],
)
def test_marks_on_what_wraps_the_article(page):
    assert html.main_text(f"<html><body class='no-js sidebar'>{page}</body></html>") == f"{P}\n{Q}"


def test_nothing_but_inserts_gives_no_text():
    assert html.main_text(f"<body><div class='ad'>{P}</div><div class='comments'><p>{Q}</p></div><nav><p>{P}</p></nav></body>") == ""


def test_references_and_formulas_of_an_article_stay():
    page = f"<article><p>{P}</p><p>Then <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation encoding='application/x-tex'>no</annotation></math> holds.</p><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></article>"
    assert html.main_text(page) == f"{P}\nThen E=m holds.\nOne\nTwo\nThree"


@pytest.mark.parametrize("page", ["<div>" * 20_000 + P + "</div>" * 20_000, "<div><p>a, b" * 20_000, "<ul><li>" * 20_000 + "</p>" * 20_000, "<div>" * 20_000 + "<li>x" * 20_000])
def test_deep_pages_take_linear_time(page):
    start = time.time()
    html.main_text(page)
    assert time.time() - start < 6


def test_bytes_that_are_no_utf8(spark):
    df = spark.sql(r"select 1 page_id, 'u' url, concat('<p>', cast(x'41ff42' as string), ' and more, of it</p>') html")
    assert [r["text"] for r in html.extract(df).collect()] == ["A�B and more, of it"]
