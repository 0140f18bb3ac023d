"""Raw elements end where their end tag stands."""

import time

import pytest

from geoloom.llm import htmltext


def texts(page):
    return [t for _, t, _ in htmltext.parse(page).blocks]


def test_letters_that_lower_to_two_do_not_move_the_end():
    assert texts("İ" * 30 + "<script>x=1</SCRIPT ><p>First paragraph text.</p><p>Second.</p>")[1:] == ["First paragraph text.", "Second."]
    assert texts("<style>a</stylex></style\n><p>One.</p>") == ["One."]


@pytest.mark.parametrize("name", ["math", "object", "audio", "video", "svg", "canvas"])
def test_other_elements_keep_their_text_and_what_follows(name):
    assert " ".join(texts(f"<p>a <{name}>b</{name}> c</p>")) == "a b c"
    assert texts(f"<p><{name}></p><p>Second.</p>") == ["Second."]


@pytest.mark.parametrize("unit", ["<a ", "<a <a'", "<a \"'>", "<aaa", "<div>", "<p><table>", "<!", "<a b='", "<div a", "</p", "<li><b>", "a=\"", "<?x "])
def test_a_megabyte_of_odd_markup_takes_linear_time(unit):
    began = time.perf_counter()
    htmltext.parse(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - began < 8
    began = time.perf_counter()
    htmltext.parse("<div " + unit * (1_000_000 // len(unit)) + ">x</div>")
    assert time.perf_counter() - began < 8


def test_a_very_long_page_keeps_all_text():
    words = " ".join(f"word{i}" for i in range(200_000))
    page = f"<html><body><article><h1>A title of the page</h1>{'<p>Some longer sentence of the text.</p>' * 2000}<p>{words}.</p></article></body></html>"
    out = htmltext.texts([page], htmltext.trained(htmltext.labelled_pages(120)))[0].split("\n")
    assert len(out) == 2002 and out[-1] == words + "."


def test_quotes_hide_ends_of_tags():
    assert texts("<p title='a > b' class=\"x>y\">One.</p><p a='>Two.</p>") == ["One.", "Two."]
    assert texts("a < b <c") == ["a < b <c"]


def test_noscript_in_the_article_is_kept_and_in_a_notice_is_not(spark):
    body = "<article><h1>A title of five words</h1><p>" + "Plain words of the story go on and on. " * 8 + "</p><noscript><p>" + "What readers without scripts see of the story, in many words. " * 4 + "</p></noscript><p>" + "More words of the story. " * 9 + "</p></article>"
    page = f'<html><body><div class="notice cookie"><noscript>Please enable scripts</noscript></div>{body}</body></html>'
    text = htmltext.extracted(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).first().text
    assert "without scripts see" in text and "Please enable" not in text
