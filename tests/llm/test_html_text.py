import html
import re

import pytest

from logwarden.llm import html_text as ht
from logwarden.llm.queries import queries


def article_of(page):
    """The text blocks of the article element of the generated pages."""
    inside = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", inside[1]) if inside else []
    texts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_query_against_articles(spark, sf_dir, table):
    got = {r.page_id: r for r in queries()["op7_extract_text"](spark, sf_dir).collect()}
    pages = table("pages", "page_id, url, html")
    assert len(got) == len(pages)
    for page_id, url, page in pages:
        text = article_of(page)
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, text, len(text))


LONG = "This is the first long sentence of the story and it goes on for as long as it has to in order to count."
LONG_2 = "It was then that the people in the town came out to see what had been done to the old bridge by the water."


@pytest.mark.parametrize(("page", "text"), [
    ("", ""),
    ("plain", ""),
    (f"<p>{LONG}", LONG),
    (f"<p>{LONG}<p>Short one.<p>{LONG_2}", f"{LONG}\nShort one.\n{LONG_2}"),
    (f"<div><a href=x>{LONG}</a></div><p>{LONG_2}</p>", LONG_2),
    (f"<nav>{LONG}</nav><header>{LONG}</header><main><h2>Title</h2><p>{LONG_2}</p></main><footer>{LONG}</footer>",
     f"Title\n{LONG_2}"),
    (f"<article><p>Short.</p></article><p>{LONG}</p>", f"Short.\n{LONG}"),
    (f"<article><p>{LONG}</p><div class='comment-list'><p>{LONG_2}</p></div><p>End.</p></article>", f"{LONG}\nEnd."),
    (f"<div id=cookieNotice>{LONG}</div><p>{LONG_2}</p><aside>{LONG}</aside>", LONG_2),
    (f"<article><script>var a = '<p>x</p>';</script><style>p{{}}</style><p>{LONG}<!-- {LONG_2} --></p></article>", LONG),
    (f"<article><form><p>{LONG}</p></form><p>a &amp; b&nbsp;&lt;i&gt;\n\t c &#233; &amp &copy; 1 < 2</p></article>",
     "a & b <i> c é & © 1 < 2"),
    (f"<ARTICLE><P CLASS=x>{LONG}<BR/>more<br><br>apart</ARTICLE>", f"{LONG} more\napart"),
    (f"<article><p title='a > b'>{LONG}</p><p title=\"broken>{LONG_2}</p></article>", f"{LONG}\n{LONG_2}"),
    (f"<article><p>{LONG}</p><p hidden>x</p><p style='display: none'>y</p><ul><li>one<li>two</ul></article>",
     f"{LONG}\none\ntwo"),
    (f"<article><p>{LONG}<script>never closed {LONG_2}", LONG),
    (f"<article><p>{LONG}</p><!-- never closed {LONG_2}", LONG),
    ("<p>Home</p><p>About</p><p>Contact</p>", ""),
    (f"<h1>A title</h1><p>{LONG}</p><p>© 2024 x</p><div class=footer>{LONG}</div>", f"A title\n{LONG}"),
])
def test_pages(page, text):
    assert ht.main_text(page) == text


def test_words_of_other_languages():
    german = "Es war die Zeit, in der die Leute aus dem Dorf mit dem Wagen zu der Stadt und wieder nach Hause fuhren."
    assert ht.main_text(f"<div>{german}</div><div>{'Produkt Angebot Preis Rabatt ' * 5}</div>") == german


def test_long_and_deep_pages():
    deep = "<div>" * 50_000 + f"<p>{LONG}</p>" + "</span>" * 50_000
    assert ht.main_text(deep) == LONG
    assert ht.main_text("<article><p>" + "word " * 500_000 + "</p></article>").count("word") == 500_000
    assert ht.main_text("<" * 100_000 + "<a " * 20_000 + '"' * 50_001) is not None
    assert ht.main_text("<article>" + "<p>x<b>" * 20_000 + "</article>").count("x") == 20_000


def test_edge_cases(spark):
    rows = [(1, "u", None, "x"), (1, "u", f"<article>{LONG}</article>", "x"), (None, None, "", "x"), (2, "v", "\0<p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, ht.extract_text(pages).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", LONG, len(LONG)), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert ht.extract_text(pages.limit(0)).collect() == []


@pytest.mark.parametrize(("page", "text"), [
    (f"<div class='with-sidebar'><article><p>{LONG}</p></article></div>", LONG),
    (f"<div class='no-header'><p>{LONG}</p></div>", LONG),
    (f"<article class='post related comments-open'><p>{LONG}</p></article>", LONG),
    (f"<article class='post category-social tag-search'><p>{LONG}</p></article>", LONG),
    (f"<div class='sidebar'><main><p>{LONG}</p></main></div>", LONG),
    (f"<article><div class='entry-header'><h1>A title</h1></div><p>{LONG}</p></article>", f"A title\n{LONG}"),
    (f"<div class='post category-social'><p>{LONG} {LONG_2}</p></div><p>{LONG}</p>", f"{LONG} {LONG_2}\n{LONG}"),
    (f"<div class='search'><p>{LONG}</p></div>", LONG),
    (f"<article><p>{LONG}</p></article><div class='related'><article><p>{LONG_2}</p></article></div>", LONG),
    (f"<article><p>{LONG}</p><ol class='comment-list'><li><article class='comment'><p>{LONG_2 * 3}</p></article></ol></article>", LONG),
    (f"<div class='comments'><p>{LONG_2} {LONG_2} {LONG_2}</p></div><p>{LONG}</p>", LONG),
])
def test_names_of_wrappers(page, text):
    assert ht.main_text(page) == text


ITALIAN = "Era il tempo in cui la gente del paese andava con il carro alla città e poi tornava a casa per la sera e per la notte."
RUSSIAN = "Это было то время, когда люди из деревни шли в город и не знали, что их там ждёт и как они оттуда вернутся."
CHINESE = "从前有一个村子，村里的人每天都要走很远的路去城里。" * 4
FINNISH = "Kylän asukkaat lähtivät aamulla kaupunkiin vaunuillaan. Illalla kaikki palasivat takaisin kotiin väsyneinä."
JUNK = "Prodotto Offerta Prezzo Sconto " * 5


@pytest.mark.parametrize(("page", "text"), [
    (f"<html lang=it-IT><p>{ITALIAN}</p><div>{JUNK}</div>", ITALIAN),
    (f"<p>{ITALIAN}</p><div>{JUNK}</div>", ITALIAN),
    (f"<html lang='ru'><p>{RUSSIAN}</p>", RUSSIAN),
    (f"<html lang='zh-CN'><p>{CHINESE}</p><div><a href=x>{CHINESE}</a></div>", CHINESE),
    (f"<p>{CHINESE}</p>", CHINESE),
    (f"<html lang=en><p>{CHINESE}</p>", CHINESE),
    (f"<html lang=fi><p>{FINNISH}</p><div>{JUNK}</div>", FINNISH),
    (f"<div>{JUNK}</div>", ""),
    ("<ul><li>Home</li><li>Read this.</li></ul><p>A short one.</p><p>And one more.</p><p>Contact</p>",
     "A short one.\nAnd one more.\nContact"),
    ("<ul><li>Home.</li></ul><p>About</p>", ""),
])
def test_more_languages_and_short_pages(page, text):
    assert ht.main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    # a teaser in an article element beside the story
    (f"<div><p>{LONG} {LONG_2} {LONG} {LONG_2}</p></div><article>short teaser</article>",
     f"{LONG} {LONG_2} {LONG} {LONG_2}\nshort teaser"),
    (f"<div><p>{LONG}</p></div><article><p>{LONG_2}</p></article>", LONG_2),
    # links inside an article
    (f"<article><p>{LONG}</p><p><a href=x>{LONG_2}</a></p></article>", f"{LONG}\n{LONG_2}"),
    (f"<article><p>{LONG}</p><ul><li><a href=x>One thing</a></li><li>Another thing</li></ul></article>",
     f"{LONG}\nOne thing\nAnother thing"),
    (f"<article><p>{LONG}</p><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul><p>End.</p></article>",
     f"{LONG}\nEnd."),
    (f"<article><p>{LONG}</p><p><a href=x>Share</a> <a href=y>Print</a></p></article>", LONG),
    # a reader's comment is an article element of its own
    (f"<article><p>{LONG}</p></article><article class='comment'><p>{LONG_2}</p></article>", LONG),
    (f"<article class='comment'><p>{LONG_2}</p></article>", LONG_2),
])
def test_teasers_links_and_comments(page, text):
    assert ht.main_text(page) == text
