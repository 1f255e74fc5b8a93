"""Pages on which markup misleads, text that markup hides, and pages that are slow to read badly."""

import time

from convolens.llm.html_text import main_text

PROSE = "The quick story of the town is that it was founded by people who came from the coast and stayed for years."
RUSSIAN = "Город был основан людьми, которые пришли с побережья и остались в нём на долгие годы, потому что земля была хороша."
STOPS = frozenset("the of is that it was by who from and for".split())


def test_class_names_are_whole():
    for name in ("page no-sidebar", "share-price", "label-free-view", "with-menu"):
        assert main_text(f'<body><div class="{name}"><article><h1>Head</h1><p>{PROSE}</p></article></div></body>', STOPS) == f"Head\n{PROSE}"
    for name in ("hidden", "share", "search", "label", "main sidebar"):
        assert main_text(f'<body><div class="{name}"><article><h1>Head</h1><p>{PROSE}</p></article></div></body>', STOPS) == f"Head\n{PROSE}"
    for name in ("site-footer", "comment-list", "post_comments", "cookieBanner cookie-banner"):
        assert main_text(f'<div><p>{PROSE}</p><div class="{name}"><p>{PROSE} Again.</p></div></div>', STOPS) == PROSE


def test_comments_in_articles():
    page = f'<div class="body"><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p></div><article class="comment"><p>{PROSE} I liked it.</p></article>'
    assert main_text(page, STOPS) == f"Head\n{PROSE}\n{PROSE}"


def test_languages_without_stop_words():
    assert main_text(f"<body><nav><a href=1>Меню</a></nav><div><p>{RUSSIAN}</p><p>{RUSSIAN}</p></div></body>", STOPS) == f"{RUSSIAN}\n{RUSSIAN}"


def test_density_decides():
    keywords = "cheap flights hotels tickets offers deals discounts bargains prices vouchers coupons savings specials"
    assert main_text(f"<body><div>{PROSE}</div><div>{keywords}</div><div>{PROSE}</div></body>", STOPS) == f"{PROSE}\n{PROSE}"
    # Code in an article has no stop words; its neighbours decide.
    code = "for i in range(10): print(i, i * i, i ** 3, sep=', ', end='; ') # squares, cubes"
    assert main_text(f"<article><p>{PROSE}</p><pre>{code}</pre><p>{PROSE}</p></article>", STOPS) == f"{PROSE}\n{code}\n{PROSE}"


def test_markup():
    assert main_text(f'<div title="a < b">{PROSE}</div>', STOPS) == PROSE
    assert main_text(f"<article><p>{PROSE} <math><mi>x</mi>=<mn>1</mn></math></p></article>", STOPS) == f"{PROSE} x=1"
    assert main_text(f"<body><ul><li><a href=/a/>{PROSE}</a></li></ul><p>{PROSE}</p></body>", STOPS) == PROSE


def test_linear():
    for page in ("<div>x" * 20_000, "<div>" * 20_000 + PROSE + "</div>" * 20_000, "<p></span>" * 20_000, '<div class="ad">x' * 20_000, '<article class="x"><h1>' * 10_000, "<a '" * 20_000, "<li><ul>" * 20_000):
        start = time.process_time()
        main_text(page, STOPS)
        assert time.process_time() - start < 3
