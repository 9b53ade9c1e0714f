"""Tags and attributes against a plain state machine; choices of nodes against all choices."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from citypulse.llm import html

SPACES = " \t\n\f\r"


def plain_tag(page: str, at: int) -> tuple[int, list[tuple[str, str]]]:
    """Where the tag that begins at ``at`` ends, and its attributes, state by state as the standard has them."""
    i, n = at + 1, len(page)
    while i < n and page[i] not in SPACES + "/>":
        i += 1
    found = []
    while True:
        while i < n and page[i] in SPACES + "/":
            i += 1
        if i >= n or page[i] == ">":
            return min(i + 1, n), found
        name, i = page[i], i + 1
        while i < n and page[i] not in SPACES + "/>=":
            name, i = name + page[i], i + 1
        k = i
        while k < n and page[k] in SPACES:
            k += 1
        value = ""
        if k < n and page[k] == "=":
            i = k + 1
            while i < n and page[i] in SPACES:
                i += 1
            if i < n and page[i] in "\"'":
                end = page.find(page[i], i + 1)
                value, i = (page[i + 1 :], n) if end < 0 else (page[i + 1 : end], end + 1)
            else:
                while i < n and page[i] not in SPACES + ">":
                    value, i = value + page[i], i + 1
        found.append((name.lower(), value))


def test_tags_are_read_as_the_standard_says():
    rng = random.Random(12)
    for _ in range(20_000):
        page = "<p" + rng.choice([" ", "\n", "/", ""]) + "".join(rng.choices("ab=\"'/ >\n", [4, 4, 3, 2, 2, 1, 3, 1, 1], k=rng.randint(0, 25)))
        m = html._MARKUP.match(page)
        end, found = plain_tag(page, 0)
        assert m.end() == end, page
        assert html.attributes(m[3]) == found, page


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p title=don't>Hello world</p><p>second</p>", "Hello world\n\nsecond"),
        ("<p title=don't>Hello world</p><p>it's here</p><p>third</p>", "Hello world\n\nit's here\n\nthird"),
        ("<p title=\"a>b\">one</p><p data-x='>'>two</p>", "one\n\ntwo"),
        ("<p class>one<p id=>two", "one\n\ntwo"),
        ("<p =x \"y>one</p>two", "one\n\ntwo"),
        ("one<p title=\"open>two</p>three", "one"),
        ("<p/>one<br/>two", "one two"),
    ],
)
def test_text_beside_odd_attributes(page, text):
    t = html.tree(page)
    assert html.text_of(t, np.ones(len(t.nodes), bool)) == text


def test_words_of_named_attributes_only():
    assert html.attribute_words(" title='class=ad' class=\"mainNav x\" id=top role='banner'") == {"main", "nav", "x", "top", "banner"}


def test_long_and_deep_pages_end():
    t = html.tree("<div class=a>" * 3000 + "text" + "</div>" * 3000 + "<p title=it's>" * 20_000)
    kept = html.decoded(t, np.full(len(t.nodes), 0.9))
    assert html.text_of(t, kept).startswith("text")


def test_choice_is_the_best_of_all():
    rng = np.random.default_rng(8)
    for _ in range(60):
        n = int(rng.integers(1, 11))
        parent = np.array([-1, *(int(rng.integers(0, i)) for i in range(1, n))])
        own = [["x" * int(rng.integers(0, 40))] for _ in range(n)]
        t = html.Tree([None] * n, parent, own, np.zeros((n, 0)))
        p = np.round(rng.random(n), 1)
        found = html.decoded(t, p)
        q = np.clip(p, 0.01, 0.99)
        weight = 1 + np.log1p([sum(map(len, o)) for o in own])

        def worth(kept, q=q, weight=weight):
            return float((weight * np.where(kept, np.log(q), np.log(1 - q)))[1:].sum())

        choices = [np.array([True, *c]) for c in itertools.product([False, True], repeat=n - 1)]
        allowed = [c for c in choices if all(c[parent[i]] or not c[i] for i in range(1, n))]
        assert any((found == c).all() for c in allowed)
        assert worth(found) == pytest.approx(max(map(worth, allowed)))


def test_equal_chances_are_dropped():
    t = html.Tree([None] * 2, np.array([-1, 0]), [["a"], ["b"]], np.zeros((2, 0)))
    assert html.decoded(t, np.array([0.9, 0.5])).tolist() == [True, False]
