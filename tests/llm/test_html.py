import pytest

from framewright.llm import html_text
from framewright.llm.html_text import extract, main_text

PAGE = """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T &amp; U</title><style>p{margin:0}</style>
<script>var t="</p>";track(1);</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav>
<!-- ad 1 --><div class="ad">Buy, buy, buy, it is very cheap, and long enough to look like prose, really.</div>
<article><h1>Title &lt;x&gt;</h1><p><b>Lead   text,
 one.<br><p>Second&nbsp;paragraph, with a <a href="#">link</a>.</p><aside>side</aside><form><p>form</p></form>
<section><h2>Part</h2><ul><li>one<li>two</ul></section><div id="comments"><p>reader, comment, here, and, more</p></div></article>
<footer>&copy; site</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == "Title <x>\nLead text, one.\nSecond paragraph, with a link.\nPart\none\ntwo"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b", "a\nb"),
        ("<div class='content'><p>Some words, more words.</p></div><div class='sidebar'><p>x, y, z, and so on</p></div>", "Some words, more words."),
        ("<script>only()</script>", ""),
        ("<p>cut off <b>bold", "cut off bold"),
        ("<p>x</p><!-- never closed <p>y</p>", "x"),
        ("<table><tr><td>a<td>b</table>", "a\nb"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p>a<br>b</p>", "a b"),
        ("<script>if (a < b) '</p>'", ""),
    ],
)
def test_shapes(html, want):
    assert main_text(html) == want


def test_long_and_deep_pages_are_whole():
    text = "word, " * 50_000
    assert len(main_text(f"<article><p>{text}</p></article>")) == len(text) - 1
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_query(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", PAGE, "", ""), (1, "u", PAGE, "", ""), (2, None, None, "", ""), (None, "v", "<p>x</p>", "", "")]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "", r["n_chars"]) for r in got) == [(0, "v", 1), (1, "u", len(main_text(PAGE))), (1, "u", len(main_text(PAGE))), (2, "", 0)]
    assert extract(spark.createDataFrame([], schema)).count() == 0


PROSE = "A first sentence of the article, with some commas, and enough words to be read as prose by anyone."


@pytest.mark.parametrize("name", ["content no-sidebar", "entry-content with-sidebar", "post has-comments", "layout-has-right-sidebar", "sidebar-left", "layout header-fixed"])
def test_wrappers_are_not_dropped_by_name(name):
    html = f"<body><div class='{name}'><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p><div class='sidebar'><p>x, y, z</p></div></div><div class='footer'>end</div></body>"
    assert main_text(html) == f"Title\n{PROSE}\n{PROSE}"


@pytest.mark.parametrize("name", ["comments", "related", "sidebar", "comments-with-faces", "no-padding-sidebar"])
def test_long_parts_beside_an_article_stay_out(name):
    html = f"<body><div><h1>Title</h1><p>{PROSE}</p></div><div class='{name}'>" + f"<p>{PROSE}</p>" * 9 + "</div></body>"
    assert main_text(html) == f"Title\n{PROSE}"


def test_letters_that_grow_in_lower_case():
    assert main_text(f"<body><p>{'İ' * 40}</p><SCRIPT>var a;</SCRIPT><p>{PROSE}</p></body>") == f"{'İ' * 40}\n{PROSE}"


def test_an_advert_never_stands_for_a_short_article():
    assert main_text(f"<body><div class='ad'>{PROSE}</div><article><h1>Title</h1><p>Short.</p></article></body>") == "Title\nShort."


def grow(rng, depth):
    """A random element: (tag, class, children), texts among the children."""
    if depth == 0 or rng.random() < 0.3:
        words = " ".join(rng.choice(["plain", "words,", "here", "and", "there."]) for _ in range(rng.choice([1, 4, 12, 60])))
        return ("p", "", [("a", "", [words]) if rng.random() < 0.2 else words])
    tag, name = rng.choice(["div", "section", "div", "blockquote", "nav", "footer"]), rng.choice(["", "", "body-text", "sidebar", "wide"])
    return (tag, name, [grow(rng, depth - 1) for _ in range(rng.randint(1, 4))])


def markup(node):
    if isinstance(node, str):
        return node
    tag, name, children = node
    return f'<{tag}{f" class={name!r}" if name else ""}>{"".join(map(markup, children))}</{tag}>'


def plain_main_text(root):
    """The scoring by its definition: every block looks at each of its ancestors, every ancestor at each of its blocks."""
    nodes, blocks = [], []

    def walk(node, path, linked):
        if isinstance(node, str):
            blocks.append((path, node, linked))
            return
        tag, name, children = node
        if tag in ("nav", "footer") or name == "sidebar":
            return
        nodes.append([*path, len(nodes)])
        own = nodes[-1]
        tags.append(tag)
        names.append(name)
        for child in children:
            if tag == "a":
                walk(child, path, True)
            else:
                walk(child, own, linked)

    tags, names = [], []
    walk(root, [], False)
    size = {}
    for own in nodes:
        inside = [b for b in blocks if b[0][: len(own)] == own]
        volume = sum(len(t) for _, t, _ in inside)
        links = sum(len(t) for _, t, is_link in inside if is_link)
        points = 0
        for path, text, is_link in inside:
            level = len(path) - len(own) - (tags[path[-1]] in ("p", "blockquote"))
            points += 0 if is_link or level < 0 else (1 + text.count(",") + min(len(text) / 100, 3)) / 2**level
        size[own[-1]] = (points * (1 - links / volume) if volume else 0.0, volume, links / volume if volume else 0.0)
    best = max(nodes, key=lambda own: (size[own[-1]][0], own[-1]))
    if size[best[-1]][0] <= 0:
        return "\n".join(t for _, t, _ in blocks)
    # Three boxes of one kind or more, of which none has more than two thirds: up to their parent.
    whole = {own[-1]: sum((1 + t.count(",") + min(len(t) / 100, 3)) * (not link) for path, t, link in blocks if path[: len(own)] == own) for own in nodes}
    path = best
    while len(path) > 1:
        boxes = [o for o in nodes if o[:-1] == path[:-1] and tags[o[-1]] == tags[path[-1]] and names[o[-1]] == names[path[-1]] and whole[o[-1]] > 0 and size[o[-1]][2] < 0.25]
        if tags[path[-1]] in ("div", "section") and len(boxes) >= 3 and 3 * whole[path[-1]] <= 2 * sum(whole[o[-1]] for o in boxes):
            best = path[:-1]
        path = path[:-1]
    kept = [best]
    for own in nodes:
        points, volume, density = size[own[-1]]
        if own[:-1] == best[:-1] and own != best and volume and best[:-1]:
            if points >= max(10.0, 0.2 * size[best[-1]][0]) or (tags[own[-1]] == "p" and volume > 80 and density < 0.25):
                kept.append(own)
    return "\n".join(t for path, t, _ in blocks if any(path[: len(k)] == k for k in kept))


def test_against_a_plain_twin():
    import random

    rng = random.Random(6)
    found = 0
    for _ in range(400):
        page = ("div", "", [grow(rng, 4) for _ in range(4)])
        html = markup(page)
        # Where a container is spared, the page is read by another rule.
        if html_text._read(html, frozenset())[1]:
            continue
        found += 1
        assert html_text.main_text(html) == plain_main_text(page)
    assert found > 200


def test_wrappers_that_tell_what_a_page_has():
    text = "Plain words, here and there. " * 20
    for name in ("content has-sidebar", "main-content no-sidebar", "post share-enabled", "entry with-comments", "page nav-open", "layout-header-fixed", "article-body related-off"):
        page = f'<html><body><div class="{name}"><h1>Title</h1><p>{text}</p></div></body></html>'
        assert html_text.main_text(page) == f"Title\n{text.strip()}"


def test_work_grows_with_the_page():
    import time

    for n in (8000, 32_000):
        for page in ("<b>" * n + "<p>x</p>" * n, "<div>" * n + "<p>some text, here</p>" * n, '<div class="sidebar">' * n + "<p>" + "text " * n, '<b>' * n + "</i>" * n + "<p>x", '<a "' * n + ">t"):
            began = time.time()
            html_text.main_text(page)
            assert time.time() - began < n / 8000


ARTICLE = [f"Paragraph {n} of the article, with a comma, and enough words to be read as prose by anyone who reads it." for n in range(6)]
WHOLE = "\n".join(["Title", *ARTICLE])
INNER = "<h1>Title</h1>" + "".join(f"<p>{t}</p>" for t in ARTICLE)
MENU = "<ul><li><a href='/a'>menu</a></li><li><a href='/b'>more</a></li></ul>"


@pytest.mark.parametrize(
    "html",
    [
        f"<body><div class='overflow-hidden'>{INNER}</div></body>",
        f"<body><div style='overflow: hidden'>{INNER}</div></body>",
        f"<body><div data-sidebar='hidden'>{INNER}</div></body>",
        f"<body><div class='hidden-print' title='a hidden aria-hidden=true thing'>{INNER}</div></body>",
        f"<body><div aria-hidden='false' data-hidden>{INNER}</div></body>",
        f"<html><head><title>t</title><meta charset='utf-8'><body><div>{INNER}</div></body></html>",
        f"<html><head><title>t</title><link href='x'><div>{INNER}</div></html>",
        f"<body><form action='/x'><nav>{MENU}</nav><div>{INNER}</div><input name='q'></form></body>",
        f"<body><nav>{MENU}<div>{INNER}</div></body>",
        f"<body><nav>{MENU}<article>{INNER}</article></body>",
        f"<body><aside><div>{INNER}</div></body>",
        f"<body><header><h2>Site</h2></header><div class=\"c\"\">{INNER}</div></body>",
        f"<body><div class='c' '>{INNER}</div><div id=x\" y=>end</div></body>",
        f"<body><div class=a=b \"quoted\" x = 'y>z'>{INNER}</div></body>",
    ],
)
def test_articles_in_odd_markup_are_whole(html):
    assert main_text(html) == WHOLE


def sections(wrap, counts=(1, 5, 2, 4, 3, 1)):
    texts = [[f"Section {n}, paragraph {i}, with words enough to be read as prose by anyone who reads it." for i in range(c)] for n, c in enumerate(counts)]
    return "".join(wrap("".join(f"<p>{t}</p>" for t in own)) for own in texts), "\n".join(t for own in texts for t in own)


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
@pytest.mark.parametrize("around", ["<div class='page'><h1>Title</h1>{}</div>", "<h1>Title</h1>{}", "<div><div class='inner'><h1>Title</h1>{}</div><div class='sidebar'><p>x, y, z</p></div></div>"])
def test_sections_in_boxes_are_all_kept(depth, around):
    names = ["row", "col", "text", "box"][:depth]
    body, want = sections(lambda inner: "".join(f"<div class='{n}'>" for n in names) + inner + "</div>" * depth)
    assert main_text("<body>" + around.format(body) + "<div class='footer'>end</div></body>") == f"Title\n{want}"


def test_what_is_hidden_stays_out():
    for mark in ("hidden", "hidden=''", "aria-hidden=true", "style='color: red; display : none'", "style='visibility:hidden'", "HIDDEN"):
        assert main_text(f"<body><div>{INNER}</div><div {mark}><p>{PROSE}</p><p>{PROSE}</p></div></body>") == WHOLE


def test_menus_forms_and_asides_beside_the_article_stay_out():
    long = "".join(f"<p>{PROSE}</p>" for _ in range(3))
    for name in ("nav", "form", "aside", "header", "footer", "dialog", "menu"):
        assert main_text(f"<body><{name}>{long}</{name}><div>{INNER}</div><{name}>{long}</{name}></body>") == WHOLE
