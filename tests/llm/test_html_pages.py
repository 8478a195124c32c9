"""Main text of generated pages whose article is known, and pages that once lost text or took long."""

from __future__ import annotations

import random
import re
import time

import pytest

from strandwise.llm import html_text

WORDS = "river stone cloud paper winter garden window letter market forest silver morning".split()
SHORT = ["End.", "aa", "bb", "So it was.", "Why?"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def beside(rng: random.Random) -> str:
    """A part beside the article."""
    links = "".join(f"<li><a href='/{i}'>{prose(rng, 2)}</a></li>" for i in range(rng.randrange(2, 7)))
    return rng.choice([
        f"<nav><ul>{links}</ul></nav>", f"<footer><p>{prose(rng, 12)}</p></footer>", f"<aside><p>{prose(rng, 30)}</p></aside>", f"<div class='site-footer'><p>{prose(rng, 25)}</p></div>",
        f"<div id=comments><p>{prose(rng, 40)}</p><p>{prose(rng, 8)}</p></div>", f"<form><p>{prose(rng, 9)}</p><button>Send</button></form>", f"<script>var x = '{prose(rng, 50)}';</script>", f"<style>p {{ color: red }} {prose(rng, 20)}</style>",
        f"<div class=\"ad banner\">{prose(rng, 20)}</div>", f"<!-- {prose(rng, 30)} -->", f"<div class='cookie-notice'><p>{prose(rng, 20)}</p></div>", f"<section role=complementary><p>{prose(rng, 30)}</p></section>",
    ])


def within(rng: random.Random) -> tuple[str, str]:
    """(markup, text) of one block of the article."""
    text = rng.choice(SHORT) if rng.random() < 0.4 else prose(rng, rng.randrange(8, 40))
    kind = rng.randrange(8)
    if kind == 0:
        return f"<p data-id='comments' title=\"class=ad\">{text}</p>", text
    if kind == 1:
        return f"<p>{text} <b>bold</b>\n\t  more &amp; &eacute;&#x41;</p>", f"{text} bold more & éA"
    if kind == 2:
        return f"<h2>{text}</h2>", text
    if kind == 3:
        return f"<p>{text} <button>press</button> here<script>no()</script> too</p>", f"{text} here too"
    if kind == 4:
        return f"<blockquote><p>{text}</p></blockquote>", text
    return f"<p>{text}</p>", text


@pytest.mark.parametrize("wrap", ["article", "main", "div"])
def test_generated_pages(wrap):
    rng = random.Random(wrap)
    for _ in range(150):
        body = [within(rng) for _ in range(rng.randrange(3, 14))]
        long = prose(rng, 60)
        body.insert(rng.randrange(len(body) + 1), (f"<p>{long}</p>", long))
        around = [[beside(rng) for _ in range(rng.randrange(4))] for _ in range(2)]
        inner = "".join(m + ("\n" if rng.random() < 0.5 else "") for m, _ in body)
        page = f"<!doctype html><html><head><title>{prose(rng, 4)}</title></head><body><header><h1>{prose(rng, 3)}</h1></header>{''.join(around[0])}<{wrap}>{inner}</{wrap}>{''.join(around[1])}</body></html>"
        assert html_text.main_text(page) == "\n".join(t for _, t in body), page


def naive_parts(sizes: list[int], places: list[int]) -> list[int]:
    """Line numbers of the parts, by growing each surge line by line."""
    n, block = len(sizes), html_text.WINDOW
    ahead = [sum(sizes[i : i + block]) for i in range(n)]
    behind = [sum(sizes[max(0, i - block + 1) : i + 1]) for i in range(n)]
    used = [i for i in range(n) if sizes[i]]
    regions: list[list[int]] = []
    for i in used:
        if regions and i - regions[-1][-1] <= block:
            regions[-1].append(i)
        else:
            regions.append([i])
    parts = []
    for r in regions:
        rise = [i for i in range(r[0], r[-1] + 1) if ahead[i] >= html_text.SURGE]
        fall = [i for i in range(r[0], r[-1] + 1) if behind[i] >= html_text.SURGE]
        if rise:
            parts.append([i for i in r if rise[0] <= i <= fall[-1]])
    parts = parts or ([max(regions, key=lambda r: max(ahead[r[0] : r[-1] + 1]))] if regions else [])
    kept = set()
    for part in parts:
        much = {p: sum(sizes[i] for i in part if places[i] == p) for p in {places[i] for i in part}}
        inside = {p for p, n in much.items() if n >= min(html_text.SURGE, max(much.values()))}
        own = set(part)
        at = used.index(part[0])
        while at and places[used[at - 1]] in inside and used[at] - used[at - 1] <= block:
            at -= 1
            own.add(used[at])
        at = used.index(part[-1])
        while at + 1 < len(used) and places[used[at + 1]] in inside and used[at + 1] - used[at] <= block:
            at += 1
            own.add(used[at])
        kept |= set(range(min(own), max(own) + 1))
    return sorted(kept)


def test_parts_and_containers_against_a_naive_version():
    import numpy as np

    rng = random.Random(1)
    for _ in range(500):
        n = rng.randrange(1, 40)
        sizes = [rng.choice([0, 0, 3, 20, 90]) for _ in range(n)]
        places = sorted(rng.randrange(6) for _ in range(n)) if rng.random() < 0.7 else [rng.randrange(3) for _ in range(n)]
        parts = html_text.to_containers(html_text.main_parts(np.array(sizes)), np.array(sizes), places)
        assert [i for a, b in parts for i in range(a, b)] == naive_parts(sizes, places)


LONG = "word " * 40


@pytest.mark.parametrize(("page", "text"), [
    (f"<article><p>{LONG}</p><div data-id=\"comments\"><p>Kept part of the story.</p></div></article>", f"{LONG.strip()}\nKept part of the story."),
    (f"<div><p>{LONG}</p><p>End.</p><p>aa</p><p>bb</p><p>cc</p></div>", f"{LONG.strip()}\nEnd.\naa\nbb\ncc"),
    (f"<div><p>Intro.</p><p>aa</p><p>bb</p><p>cc</p><p>{LONG}</p></div>", f"Intro.\naa\nbb\ncc\n{LONG.strip()}"),
    (f"<p>See <button>x</button> it {LONG}</p>", f"See it {LONG.strip()}"),
    (f"<article><p>{LONG}</p><div role='comments'><p>{LONG}</p></div></article>", LONG.strip()),
])
def test_pages_that_lost_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("piece", ["<button>", "<select>", "<svg>", "<object>", "<div>x", "</section>", "<title>", "<div class=ad>", "<p><b>", "<li>y"])
def test_time_is_linear(piece):
    took = []
    for n in (20_000, 80_000):
        began = time.process_time()
        html_text.main_text("<div>" * 2000 + f"<p>{LONG}</p>" + piece * (n // len(piece)))
        took.append(time.process_time() - began)
    assert took[1] < 12 * max(took[0], 0.05)


def test_no_markup_is_left():
    rng = random.Random(4)
    for _ in range(50):
        page = "".join(rng.choice([beside(rng), within(rng)[0], "<", "<a ", "</", "<!--", "&lt;b&gt;"]) for _ in range(10))
        assert not re.search(r"</?(?:p|div|nav|script|li)\b", html_text.main_text(page).replace("<b>", ""))
