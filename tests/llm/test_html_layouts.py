"""op3 on written layouts that no template makes, on markup as it is found, and in time."""

import time

import pytest

from panelcast.llm import html_crf
from panelcast.llm.html_blocks import leaf_blocks

A = "The council met on Tuesday and agreed on the plan for a new bridge across the river, which will replace the ferry."
B = "Residents had asked for a safer crossing for many years, and several studies had shown the need for one."
C = "Work is to begin in spring. The old landing stays open until the last pier stands."
T = "Council approves new bridge"
NAV = "<a href='/'>Home</a> <a href='/n'>News</a> <a href='/s'>Sports</a> <a href='/c'>Contact</a>"
LIST = "<ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/c'>Contact</a></li></ul>"
P3 = f"<p>{A}</p><p>{B}</p><p>{C}</p>"
FULL = [T, A, B, C]

LAYOUTS = {
    "bare body": (f"<body><h1>{T}</h1>{P3}</body>", FULL),
    "one div": (f"<body><div><h1>{T}</h1>{P3}</div></body>", FULL),
    "no body tag": (f"<h1>{T}</h1>{P3}", FULL),
    "only text": (A, [A]),
    "one paragraph": (f"<html><body><p>{A}</p></body></html>", [A]),
    "two words": ("<body><p>Hello world.</p></body>", ["Hello world."]),
    "post class": (f'<body><div class="post"><p>{A}</p></div></body>', [A]),
    "german names": (f'<body><div class="kopfzeile">{NAV}</div><div class="inhalt"><h1>{T}</h1>{P3}</div><div class="fusszeile"><p>© 2020 Stadt Beispiel</p></div></body>', FULL),
    "spanish names": (f'<body><div id="cabecera">{LIST}</div><div id="cuerpo"><h1>{T}</h1>{P3}</div><div id="pie"><p>© 2019 Ayuntamiento</p></div></body>', FULL),
    "hashed names": (f'<body><div class="x9fa1">{LIST}</div><div class="k2bb0"><h2>{T}</h2>{P3}</div></body>', FULL),
    "table columns": (f"<table><tr><td>{LIST}</td><td><h1>{T}</h1>{P3}</td></tr></table>", FULL),
    "table rows": (f"<table><tr><td>{NAV}</td></tr><tr><td><h1>{T}</h1>{P3}</td></tr><tr><td>© 2001 The Courier</td></tr></table>", FULL),
    "breaks": (f"<body>{A}<br><br>{B}<br><br>{C}</body>", [f"{A} {B} {C}"]),
    "font and center": (f"<center><h2>{T}</h2></center><font size=3><p>{A}<p>{B}<p>{C}</font>", FULL),
    "unclosed paragraphs": (f"<body><h1>{T}</h1><p>{A}<p>{B}<p>{C}", FULL),
    "main": (f"<nav>{LIST}</nav><main><h1>{T}</h1>{P3}</main><footer><p>© The Courier</p></footer>", FULL),
    "article": (f"<header>{NAV}</header><article><h1>{T}</h1>{P3}</article><aside><h3>Popular</h3>{LIST}</aside>", FULL),
    "article header": (f"<article><header><h1>{T}</h1></header>{P3}</article>", FULL),
    "section": (f"<body><nav>{LIST}</nav><section><h1>{T}</h1>{P3}</section><footer>© 2022 Courier</footer></body>", FULL),
    "list inside": (f"<body><div><h1>{T}</h1><p>{A}</p><ul><li>{B}</li><li>{C}</li></ul></div></body>", FULL),
    "quote inside": (f"<article><h1>{T}</h1><p>{A}</p><blockquote><p>{B}</p></blockquote><p>{C}</p></article>", FULL),
    "subheads": (f"<div><h1>{T}</h1><p>{A}</p><h2>Many years of waiting</h2><p>{B}</p><p>{C}</p></div>", [T, A, "Many years of waiting", B, C]),
    "link bar below": (f"<body><div><h1>{T}</h1>{P3}</div><div>{NAV}</div></body>", FULL),
    "piped links above": (f"<div><a href=/>Home</a> | <a href=/a>Archive</a> | <a href=/b>Imprint</a></div><div><h1>{T}</h1>{P3}</div>", FULL),
    "search form above": (f"<form><label>Search</label><input><button>Go</button></form><div><h1>{T}</h1>{P3}</div>", FULL),
    "cookie notice": (f'<div class="cookie-notice"><p>We use cookies to make this site better.</p></div><div><h1>{T}</h1>{P3}</div>', FULL),
    "comments below": (f'<article><h1>{T}</h1>{P3}</article><section class="comments"><h3>2 comments</h3><p>Great news, at last!</p><p>Who pays for it?</p></section>', FULL),
    "scripts between": (f"<body><script>var a='<p>x</p>';</script><h1>{T}</h1><style>p{{}}</style>{P3}<script>b()</script></body>", FULL),
    "deep boxes": ("<div>" * 12 + f"<h1>{T}</h1>{P3}" + "</div>" * 12, FULL),
    "links in prose": (f"<body><h1>{T}</h1><p>{A} <a href=/x>More</a></p><p>{B}</p><p>{C}</p></body>", [T, A + " More", B, C]),
}


@pytest.fixture(scope="module")
def crf():
    pages = html_crf.labelled_pages()
    return html_crf.train([html_crf.features(leaf_blocks(h)) for h, _ in pages], [y for _, y in pages])


def test_written_layouts(crf):
    hit = wrong = missed = 0
    failed = []
    for name, (page, want) in LAYOUTS.items():
        got = html_crf.main_text(crf, page).split("\n") if html_crf.main_text(crf, page) else []
        hit += len(set(got) & set(want))
        wrong += len(set(got) - set(want))
        missed += len(set(want) - set(got))
        if got != want:
            failed.append((name, got))
    assert len(LAYOUTS) == 30
    f1 = 2 * hit / (2 * hit + wrong + missed)
    assert f1 >= 0.97 and len(failed) <= 3, (f1, failed)


@pytest.mark.parametrize("page, want", [
    ("<p data-t=it's>one</p><p>two's</p><p>three</p>", ["one", "two's", "three"]),
    ('<p title=a"b>one</p><p>two</p>', ["one", "two"]),
    ("<!--><p>x</p>", ["x"]), ("<!---><p>x</p><!-- a --!><p>y</p><!-- z", ["x", "y"]),
    ("a < b <c", ["a < b"]), ("<p>1<li>2<li>3</p><x y='>'>z", ["1", "2", "3", "z"]), ("<p>a</p></p>b", ["a", "b"]),
    ('<a href="x>y">l</a> <img alt=\'>\' > t <p class="a"id=b>u', ["l t", "u"]), ("", []), ("<p> &nbsp; </p>", []),
])
def test_markup_as_found(page, want):
    assert [b.text for b in leaf_blocks(page)] == want


def test_names_and_ancestors():
    b = leaf_blocks('<div class="mainPost"id=b3 data-class=no><div class=post><p role="note">u')[0]
    assert [(e.tag, e.names) for e in b.path] == [("div", ("main", "post", "b3")), ("div", ("post",)), ("p", ("note",))]
    # features of a path add up once
    names = [x for e in b.path for x in e.fresh]
    assert len(names) == len(set(names)) and "name:post" in names


HOSTILE = ["<div>x" * 100_000, "<p class=a>x<b>" * 50_000, "<p><div>" + "<b>" * 50_000 + "<li>y" * 50_000, "<p a=\"x" * 100_000 + ">", "<b a='>" * 100_001,
           "<a " * 200_000 + ">z", "<!--" * 100_000, "</i>" * 100_000, "<script>" * 100_000, "&lt" * 200_000, "<" * 200_000 + ">", "<table><tr><td>x" * 30_000]


@pytest.mark.parametrize("page", HOSTILE, ids=[h[:12] for h in HOSTILE])
def test_hostile_pages_take_seconds(crf, page):
    began = time.time()
    html_crf.main_text(crf, page)
    assert time.time() - began < 15


def test_whole_text_of_a_long_page_is_kept(crf):
    page = "<body><h1>Head line of it</h1>" + "".join(f"<p>{A} {i}</p>" for i in range(20_000)) + "</body>"
    assert html_crf.main_text(crf, page).split("\n") == ["Head line of it", *[f"{A} {i}" for i in range(20_000)]]
