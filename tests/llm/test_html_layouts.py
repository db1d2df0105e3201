"""Main text of pages whose parts no tag, class or role names, of layouts that the model has not seen, and of deep or broken pages."""

import time

import pytest

pytest.importorskip("gridspark.llm.queries")
from gridspark.llm import html_extract  # noqa: E402

LINKS = "<div><ul><li><a href=x>Home</a></li><li><a href=y>About us</a></li><li><a href=z>Old news</a></li></ul></div>"
LONG = ["These are some long words that make up a sentence. " * 6, "Here are more of them, and a comma or two, to go on with. " * 5]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<body><h1>Head</h1><p>p</p></body>", "Head\np"),
        ("<body><p>one thing</p><p>another</p></body>", "one thing\nanother"),
        (f"<div><p>{LONG[0]}</p><p>{LONG[1]}</p></div>{LINKS}", f"{LONG[0].strip()}\n{LONG[1].strip()}"),
        (f"{LINKS}<table><tr><td><p>{LONG[0]}</p></td></tr></table>", LONG[0].strip()),
        ("<html><body>plain text in body</body></html>", "plain text in body"),
        ("text without a tag", "text without a tag"),
        ("<main><ul><li><a href=a>first link</a></li><li><a href=b>second link</a></li></ul></main>", "first link\nsecond link"),
        ("<main><p>See these two pages of ours for the rest.</p><ul><li><a href=a>first link</a></li><li><a href=b>second link</a></li></ul></main>", "See these two pages of ours for the rest.\nfirst link\nsecond link"),
        ("<header>Head</header><main><p>Body text</p><form><label>Name</label></form></main><div class='cookie notice'>We use cookies</div>", "Body text"),
        (f"<article><p>{LONG[0]}</p></article><div>Buy this thing now, it is good.</div>", LONG[0].strip()),
        (f"<main><p>{LONG[0]}</p><ul><li><a href=a>first link</a></li><li><a href=b>second link</a></li></ul></main>", f"{LONG[0].strip()}\nfirst link\nsecond link"),
    ],
)
def test_pages_without_named_parts(source, want):
    assert html_extract.default_model().extract(source) == want


UNSEEN = ["<div class=zone7>|</div>", "<div><div><section>|</section></div></div>", "<table><tr><td><div>|</div></td></tr></table>", "<fieldset>|</fieldset>", "<center><table><tbody><tr><td>|</td></tr></tbody></table></center>"]
NAMED = (['<div class="xx article-text">|</div>', '<section role="main">|</section>', '<div><main class="q">|</main></div>'], ['<div class="zz nav-wrap">|</div>', '<nav class="q7">|</nav>', '<footer id="f1">|</footer>', '<div id="cookie-bar">|</div>', '<div class="box advert">|</div>', '<aside><div>|</div></aside>'])


@pytest.mark.parametrize("composer", [html_extract.Composer(77, plain=UNSEEN, named=0.0), html_extract.Composer(78, *NAMED, named=0.7), html_extract.Composer(79)])
def test_unseen_layouts(composer):
    model, hit, kept, there = html_extract.default_model(), 0, 0, 0
    for _ in range(150):
        page, _ = composer.page()
        content = model.marginals(page)
        for holder, text in page.blocks:
            kept += content[holder] >= 0.5
            there += text[0] == "C"
            hit += content[holder] >= 0.5 and text[0] == "C"
    assert hit / kept > 0.9 and hit / there > 0.9


@pytest.mark.parametrize("source", ["<div>" * 100_000 + "some text" + "</div>" * 100_000, "</b>" * 100_000 + "some text", "<p>" * 100_000 + "some text", "<b>" * 100_000 + "<div>some text"])
def test_deep_and_broken_pages_take_linear_time(source):
    html_extract.default_model()
    at = time.process_time()
    page = html_extract.Page(source)
    assert [t for _, t in page.blocks] == ["some text"]
    html_extract.default_model().extract(source)
    assert time.process_time() - at < 6
