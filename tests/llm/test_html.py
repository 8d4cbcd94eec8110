"""HTML extraction: path scores spelled out, marked parts, long malformed pages, stripped pages."""

import math
import re
import time
import tracemalloc

import pytest

from tillroll.llm import html

LONG = "Words, and more words; a sentence that ends. " * 4
P = f"<p>{LONG}</p>"


def scores_by_rules(blocks: list[tuple[str, str, bool, bool]]) -> dict[str, float]:
    """Path scores from (path, text, in a link, heading), without numpy."""
    body = [b for b in blocks if not b[3]] or blocks
    squeezed = lambda t: len(re.sub(r"\s+", "", t))
    paths = list(dict.fromkeys(b[0] for b in body))
    length, points, count = ({p: 0 for p in paths} for _ in range(3))
    for path, text, link, _ in body:
        count[path] += 1
        if not link:
            length[path] += squeezed(text)
            points[path] += len(re.findall(r"[.,;:!?…。，！？、]", text))

    def shares(values):
        return [v / max(values) for v in values]

    def smooth(x):
        w = math.exp(-2)
        out = []
        for k in range(len(x)):
            near = [(1, x[k])] + [(w, x[j]) for j in (k - 1, k + 1) if 0 <= j < len(x)]
            out.append(sum(a * b for a, b in near) / sum(a for a, _ in near))
        return out

    texts = smooth(shares([min(length[p] / count[p], 200) for p in paths]))
    marks = smooth(shares([min((points[p] + 1) / count[p], 4) for p in paths]))
    mass = shares([min(length[p], 1000) for p in paths])
    return {p: math.sqrt(a * b) * m ** 0.25 for p, a, b, m in zip(paths, texts, marks, mass)}


def name_of(path) -> str:
    names = []
    while path.parent:
        names.append(path.tag)
        path = path.parent
    return "/".join(reversed(names))


def test_path_scores_equal_the_rules():
    page = ('<body><div><ul><li><a href="/x">Menu one</a></li><li><a>Two</a></li></ul></div><div>Short, ad.</div><div><h1>T</h1>'
            f'{P}<p>Short.</p><blockquote>{LONG[:60]}</blockquote>{P * 6}</div><div>Foot</div></body>')
    blocks = html.text_blocks(page)
    want = scores_by_rules([
        ("body/div/ul/li", "Menu one", True, False), ("body/div/ul/li", "Two", True, False), ("body/div", "Short, ad.", False, False),
        ("body/div/h1", "T", False, True), ("body/div/p", LONG, False, False), ("body/div/p", "Short.", False, False),
        ("body/div/blockquote", LONG[:60], False, False), *[("body/div/p", LONG, False, False)] * 6, ("body/div", "Foot", False, False)])
    got = {name_of(path): s for (path, _), s in html.path_scores(blocks).items()}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p], abs=1e-12) for p in want)
    values = list(want.values())
    mean = sum(values) / len(values)
    limit = max(math.sqrt(sum((v - mean) ** 2 for v in values) / len(values)), max(values) / 2)
    assert html.block_scores(blocks)[1] == pytest.approx(limit)
    assert "Foot" not in html.main_text(page) and "Menu" not in html.main_text(page) and "ad." not in html.main_text(page)


@pytest.mark.parametrize("part, line", [
    ('<section id="related-work"><p>Plain text, here.</p></section>', "Plain text, here."),
    ('<div class="social-history"><p>Plain, text.</p></div>', "Plain, text."),
    ('<p class="alert">A plain sentence, here.</p>', "A plain sentence, here."),
    ('<h2 class="header">Title here</h2>', "Title here")])
def test_a_class_word_removes_nothing_from_an_article(part, line):
    page = f"<body><nav>x</nav><article><h1>T</h1>{P}{part}{P}</article></body>"
    assert html.main_text(page).split("\n") == ["T", LONG.strip(), line, LONG.strip()]


@pytest.mark.parametrize("part", ['<div class="ad">Buy, now.</div>', '<div class="share-box">Tell friends.</div>',
                                  '<div class="comments"><p>Nice, one.</p></div>', '<form>Your name</form>', "<aside>Also, this.</aside>"])
def test_parts_that_are_never_the_text_stay_out_of_an_article(part):
    assert html.main_text(f"<body><article><h1>T</h1>{P}{part}{P}</article></body>").split("\n") == ["T", LONG.strip(), LONG.strip()]


@pytest.mark.parametrize("piece", ["<a ", "<!", "<div>x", '<a "', "<a '\"", "<b>x</i>", "<div class=ad>x", "<p>x<b>", "</p><p>x", "<!--"])
def test_long_malformed_pages_take_linear_time(piece):
    def seconds(size):
        page = piece * (size // len(piece))
        start = time.perf_counter()
        html.main_text(page)
        return time.perf_counter() - start

    small, large = seconds(1 << 18), seconds(1 << 20)
    assert large < 6 and large < 9 * max(small, 0.05)


def test_memory_of_deep_pages_is_bounded():
    tracemalloc.start()
    html.main_text("<div>x" * 40_000)           # 240 kB
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def test_attributes_and_broken_quotes():
    assert html._attributes(' a="1" B=\'2\' data-c=3 d') == {"a": "1", "b": "2", "data-c": "3"}
    assert html._attributes(" " + "x" * 300_000) == {}
    assert html.main_text('<p title="a > b">One, two.</p>') == "One, two."
    assert html.main_text('<p>One, two.</p><p class="x>Three.</p><p>Four, five.</p>') == "One, two.\nThree.\nFour, five."


def test_stripped_pages_are_held_together_by_their_paths(spark):
    """Without class, id and semantic tags only the ratios decide."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    adverts = whole = 0
    for page in pages:
        bare = re.sub(r'\s(?:class|id|role)="[^"]*"', "", re.sub(r"<(/?)(article|main|nav|aside|footer|header)\b", r"<\1div", page))
        advert = html.html.unescape(re.search(r'<div class="ad">(.*?)</div>', page, re.S)[1]).strip()
        lines, want = html.main_text(bare).split("\n"), html.main_text(page).split("\n")
        adverts += advert in lines
        whole += set(want) <= set(lines)
    assert whole >= 0.99 * len(pages) and adverts <= 0.25 * len(pages)
