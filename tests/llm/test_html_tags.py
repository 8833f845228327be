"""Tags of any length, their attributes, and character references."""

import time

import pytest

from orrery.llm import htmltext

TEXT = "A sentence of the article that is long enough to be its main text, with all its words."


@pytest.mark.parametrize("size", [1_000, 70_000, 1_000_000])
@pytest.mark.parametrize("mark", ['"', "'"])
def test_long_attributes_leak_nothing(size, mark):
    value = ("a > b <p>leak</p> " * (size // 18)).replace(mark, "")
    page = f"<body><article><p data-x={mark}{value}{mark} class=text>{TEXT}</p><img alt={mark}{value}{mark}><p>{TEXT}</p></article></body>"
    assert htmltext.main_text(page) == f"{TEXT}\n{TEXT}"


def test_attributes():
    end = lambda tag: htmltext.tag_end(tag, 2, {m: tag.rfind(m) for m in ('"', "'")})
    assert end('<p class="a b" ID=c hidden>x') == (26, [("class", "a b"), ("id", "c"), ("hidden", "")])
    assert end("<p title=it's class=ad>") == (22, [("class", "ad")])
    assert end('<p title=\' class="ad"\' role = "x">') == (33, [("role", "x")])
    assert end("<p/>") == (3, []) and end("<p / class='a'/>") == (15, [("class", "a")]) and end("<p ==x =>") == (8, [])
    assert end('<p class="never closed> text') == (22, []) and end("<p class") == (-1, [("class", "")]) and end("<p") == (-1, []) and end('<p a="') == (-1, [])


def test_time_is_linear():
    def took(page):
        began = time.perf_counter()
        htmltext.main_text(page)
        return time.perf_counter() - began

    for part in ('<p a="', "<p a='x", "<p =", "<p a = ", "<p a", '<p a="x" ', "&", "<p / / /"):
        assert took(part * 40_000) < 20, part


def test_references_end_with_their_text():
    page = f"<body><article><p>{TEXT} &<b>lt;</b> &am<i>p;</i> &am<!-- -->p; &amp;lt; &eacute; &#233; &lt;b&gt;</p><p>{TEXT}</p></article></body>"
    assert htmltext.main_text(page).split("\n")[0] == f"{TEXT} &lt; &amp; &amp; &lt; é é <b>"
