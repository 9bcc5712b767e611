"""Pages on which names, headers, unclosed elements and depth once misled the extraction."""

import random

import pytest

from tallywright.llm import html_text

PROSE = "The price of a share rose again, as it had before, and nobody on the floor was surprised by that at all."


@pytest.mark.parametrize("page, text", [
    ('<article><p data-hidden="false">Kept, here.</p><p data-id="footer-7">And, here.</p><div data-role="navigation"><p>Also, here.</p></div></article>',
     "Kept, here.\nAnd, here.\nAlso, here."),
    (f'<article><div class="share-price"><p>{PROSE}</p></div><div id="menu-of-the-day"><p>{PROSE}</p></div></article>', f"{PROSE}\n{PROSE}"),
    (f'<article><p>{PROSE}</p><div class="share-buttons">Share, like</div><div class="related-stories"><a href=x>One, two</a></div></article>', PROSE),
    (f'<article><p>{PROSE}</p><div class="site-menu">{PROSE}</div><div class="comments"><p>{PROSE}</p></div></article>', PROSE),
    (f"<header><p>Site, name.</p></header><article><header><h1>Headline</h1></header><p>{PROSE}</p></article>", f"Headline\n{PROSE}"),
    (f"<article><noscript><p>{PROSE}</p></article>", PROSE), (f"<article><template><p>{PROSE}</p></article>", PROSE),
    (f"<article><noscript>gone</noscript><p>{PROSE}</p></article>", PROSE),
    (f'<article><p>Go on. <span class="advert">BUY NOW</span> {PROSE}</p></article>', f"Go on. {PROSE}"),
    (f'<article><p><span class="ad-slot">x</span>{PROSE} <span class="road add">y</span></p></article>', f"{PROSE} y"),
    ("<div><div class=col><p>Left, text.</p></div><div class=col><p>Left, text.</p></div></div>", "Left, text.\nLeft, text."),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_links_count_at_any_depth():
    deep = "<div>" * 60
    menu = "<ul>" + "<li><a href=x>Go, there, now, or, later, please</a></li>" * 40 + "</ul>"
    page = f"<body>{deep}{menu}{'</div>' * 60}<div><p>{PROSE}</p><p>{PROSE}</p></div></body>"
    assert html_text.main_text(page) == f"{PROSE}\n{PROSE}"


def test_sums_equal_those_over_all_pairs():
    random.seed(3)
    for _ in range(40):
        nodes = [html_text.Node("#root", None, False, False)]
        for _ in range(30):
            nodes.append(html_text.Node("div", random.choice(nodes), False, False))
        kept = [(random.choice(nodes), "x," * random.randrange(1, 9), random.randrange(3)) for _ in range(20)]
        found = html_text._summed(kept)

        def above(n):
            out = []
            while n is not None:
                out.append(n)
                n = n.up
            return out

        assert {id(n) for n in found} == {id(a) for n, _, _ in kept for a in above(n)}
        for n in found:
            mine = [(t, k) for x, t, k in kept if n in above(x)]
            assert (n.length, n.linked, n.commas) == (sum(len(t) for t, _ in mine), sum(k for _, k in mine), sum(t.count(",") for t, _ in mine))


def plain_page(seed):
    """A page of known parts, and the text of its article."""
    random.seed(seed)

    def prose(words):
        return " ".join(random.choice(["one", "two,", "three", "four.", "five"]) for _ in range(words)).strip()

    body, lines = [], []
    for _ in range(random.randrange(1, 9)):
        tag, text = random.choice(["p", "p", "h2", "li", "blockquote"]), prose(random.randrange(3, 60))
        lines.append(text)
        body.append(f"<ul><li>{text}</li></ul>" if tag == "li" else f"<{tag}>{text}</{tag}>")
    junk = [f"<nav><ul>{'<li><a href=x>go</a>' * 9}</ul></nav>", f"<aside><p>{prose(40)}</p></aside>", f'<div class="ad">{prose(30)}</div>',
            f"<footer>{prose(20)}</footer>", f"<form><p>{prose(9)}</p></form>", f'<div class="comments"><p>{prose(80)}</p></div>', "<script>'<p>no</p>'</script>"]
    random.shuffle(junk)
    cut = random.randrange(len(junk))
    return f"<html><body>{''.join(junk[:cut])}<article>{''.join(body)}</article>{''.join(junk[cut:])}</body></html>", "\n".join(lines)


@pytest.mark.parametrize("seed", range(25))
def test_generated_pages(seed):
    page, text = plain_page(seed)
    assert html_text.main_text(page) == text
