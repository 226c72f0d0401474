import time

import pytest

from playmart.llm import extract as E, queries
from tests.conftest import tuples


@pytest.fixture(scope="module")
def made_model():
    return E.teach(E.made(E.MADE))


def texts(page):
    return [(b.path[-1] if b.path else "", b.text) for b in E.blocks(page)]


def test_blocks_of_a_page():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p><p>no';"
            "</script></head><body><!-- <p>no</p> --><nav><ul><li><a href='/x>y'>One</a><li>Two</ul>"
            "</nav><article class=\"post mainText\" id=a1><h1>A &amp;\n  B&nbsp;&#233;</h1><p><b>x<br>y"
            "<p>z <i>w</i>v</p>tail<div>in<p>p</div>out</article><p>1 < 2 & 3</body></html>")
    assert texts(page) == [("li", "One"), ("li", "Two"), ("h1", "A & B é"), ("b", "x y"), ("p", "z wv"),
                           (".a", "tail"), ("div", "in"), ("p", "p"), (".a", "out"), ("p", "1 < 2 & 3")]
    first = E.blocks(page)[0]
    assert first.linked == 3 and first.path == ("html", "body", "nav", "ul", "li")
    path = E.blocks(page)[2].path
    assert {".post", ".main", ".text"} <= set(path)


@pytest.mark.parametrize("page", ["", "plain", "<", "<p", "<p>a", "</p></div>x", "<script>never ends",
                                  "<!-- never ends", "<a b='", "<textarea><p>x</textarea>", "\x00<p>\x00"])
def test_broken_pages_have_blocks(page):
    for b in E.blocks(page):
        assert b.text == " ".join(b.text.split()) and b.text


def test_long_pages_are_linear():
    page = "<div>" * 3000 + "text" + "<p>" * 20_000 + "<b" * 20_000 + "&amp;" * 20_000
    assert len(E.blocks(page)) >= 2


def test_gradients_equal_differences():
    """Back-propagation through one direction, checked against small changes."""
    import numpy as np

    rng = np.random.default_rng(1)
    n, t, h = 3, 5, E.HIDDEN
    x = rng.normal(size=(t, n, 4 * h))
    u, bias = rng.normal(size=(h, 4 * h)) * 0.3, np.zeros(4 * h)
    mask = np.arange(t)[:, None] < np.array([5, 3, 1])
    weight = rng.normal(size=(t, n, h))
    out, saved = E.run(x, u, bias, mask)
    dx, du = E.back(weight, saved, u)
    loss = lambda a, b: float((E.run(a, b, bias, mask)[0] * weight).sum())
    for k in range(6):
        i = tuple(rng.integers(0, s) for s in x.shape)
        step = np.zeros_like(x)
        step[i] = 1e-2
        if mask[i[0], i[1]]:
            assert abs((loss(x + step, u) - loss(x - step, u)) / 2e-2 - dx[i]) < 0.05
        j = tuple(rng.integers(0, s) for s in u.shape)
        step = np.zeros_like(u)
        step[j] = 1e-2
        assert abs((loss(x, u + step) - loss(x, u - step)) / 2e-2 - du[j]) < 0.05


def test_labels_on_held_out_pages(made_model, monkeypatch):
    monkeypatch.setattr(E, "SEED", 1234)
    held = E.made(150)
    right = total = 0
    for found, (_, labels) in zip(made_model.label([p for p, _ in held]), held):
        right += int((found == labels).sum())
        total += len(labels)
    assert right / total > 0.97


def test_a_block_is_read_with_its_whole_page(made_model):
    pages = [p for p, _ in E.made(40)]
    together = made_model.label(pages)
    alone = [made_model.label([p])[0] for p in pages]
    assert all((a == b).all() for a, b in zip(together, alone))


ARTICLE = "".join(f"<p>Sentence {k} of the main story, with enough words to be read.</p>" for k in range(9))
MAIN = "\n".join(["Title here", *(f"Sentence {k} of the main story, with enough words to be read."
                                 for k in range(9))])
PARTS = {
    "nav": "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>",
    "ad": '<div class="ad">Buy this now.</div>', "footer": "<footer>&copy; someone</footer>",
    "sidebar": '<aside class="sidebar"><h3>Related</h3><ul><li><a href=/x>Other</a></li></ul></aside>',
    "notice": '<div class="cookie-notice">We use cookies.</div>',
    "form": "<form><label>Mail</label><input name=m><button>Subscribe</button></form>",
    "comments": '<section id="comments"><div class="comment"><p>Nice text, I liked it a lot.</p></div>'
                '</section>',
}


def test_query_takes_the_article_alone(spark, tmp_path):
    page = lambda before, after: (
        f"<html><body>{''.join(PARTS[x] for x in before)}<article><h1>Title here</h1>{ARTICLE}</article>"
        f"{''.join(PARTS[x] for x in after)}</body></html>")
    data = [(1, "u1", page(["nav", "ad"], ["footer"])), (2, "u2", page(["nav"], ["comments", "footer"])),
            (3, "u3", page(["notice", "nav"], ["sidebar", "form", "footer"])), (4, None, None),
            (5, "u5", ""), (None, "u6", page([], [])), (1, "u1", page(["nav", "ad"], ["footer"]))]
    spark.createDataFrame([(*r, "x", "y") for r in data],
                          "page_id bigint, url string, html string, main_text string, text string"
                          ).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(tuples(queries.op10_main_text(spark, str(tmp_path))), key=str)
    want = [(i, u, MAIN if h else "", len(MAIN) if h else 0) for i, u, h in data]
    assert got == sorted(want, key=str)


def test_empty_table(spark, made_model):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert E.extract(none, made_model).count() == 0


def test_pages_without_the_end_of_the_head(made_model):
    body = f"<article><h1>Title here</h1>{ARTICLE}</article>"
    head = "<html><head><title>x</title><meta charset=utf-8><script>var a = '<p>no</p>'</script>"
    for page in (f"{head}<body>{body}</body></html>", f"{head}{body}", f"{head}</head><body>{body}"):
        found = E.blocks(page)
        kept = made_model.label([found])[0]
        assert "\n".join(b.text for b, keep in zip(found, kept) if keep) == MAIN
    for page in ("<head><title>x</title>plain <b>text</b>", "<head><title>x</title>plain text"):
        assert [b.text for b in E.blocks(page)] == ["plain text"]
    assert E.blocks("<html><head><title>x</title><link rel=a></head></html>") == []


@pytest.mark.parametrize("tag", ["svg", "math", "template", "object", "noscript", "iframe"])
def test_nothing_is_lost_behind_an_element_without_an_end(tag):
    for start in (f"<{tag}>", f"<{tag} a='b'>", f"<{tag} / >", f"<{tag}/>"):
        page = f"<article><p>A</p>{start}<path><p>B</p></article><p>C</p>"
        assert [b.text for b in E.blocks(page)] == ["A", "B", "C"], start
    if tag not in ("svg", "math"):
        closed = f"<p>A</p><{tag}><b>gone</b></{tag}><p>B</p><{tag}><p>C</p>"
        assert [b.text for b in E.blocks(closed)] == ["A", "B", "C"]


def test_a_title_without_an_end_and_a_script_without_one():
    assert [b.text for b in E.blocks("<title>T<body><p>A</p>")] == ["A"]
    assert [b.text for b in E.blocks("<p>A</p><script>let x = '<p>B</p>'")] == ["A"]


@pytest.mark.parametrize("part", ["<b>x", "<div>x", "<a>x", "<svg>x", "<li>x", "<p>x", "<b><li>x",
                                  "<ul><li>x", "<i>x</q>", "<table><tr><td>x"])
def test_a_megabyte_of_open_elements_is_linear(part):
    page = part * (1_000_000 // len(part))
    start = time.perf_counter()
    found = E.blocks(page)
    assert time.perf_counter() - start < 10
    assert sum(len(b.text.replace(" ", "")) for b in found) == page.count("x")
