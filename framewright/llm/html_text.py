"""Operator 10: main text of web pages by tree scoring.

A page becomes a tree of elements. Each paragraph passes points for its length and commas to its
container, half of them to the next ancestor, a quarter to the one after it and so on; the share of
link text discounts them. The best container is kept together with those siblings that score near
it or read like prose; where it lies in one of several boxes of one kind, their parent stands for all. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments take no part, by element and by class, id or role; a menu, form or the like that
holds most of the page's prose and its article is read after all. Hidden is what the attributes hidden, aria-hidden or
style say, not a name.

A block's white space becomes one space; blocks are joined by one line feed. Null and empty pages
give the empty string; open paragraphs, items, cells and heads end where browsers end them; plain text is one block. The text is
never cut, and the work grows with the page's length however deep its elements nest. Rows are
independent, so repeated rows and extra columns need no special treatment.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*+(?:\"[^\"]*\"|'[^']*')?+|[^>=])*+)(?:>|\Z)", re.S)
#: A name and, in one of three forms, a value; a quote opens a string behind an equals sign alone.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))?)?""")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_SKIP = frozenset("script style noscript template svg math iframe object embed canvas video audio head title footer button input select textarea map".split())
#: Left out as well, unless the page's article turns out to lie in one, as in a form around the page or a menu that never ends.
_SOFT = frozenset("nav header aside form dialog menu".split())
#: What an open head may hold; anything else ends it.
_HEAD = frozenset("head base link meta title noscript style script template".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_PARAGRAPH = frozenset("p pre blockquote li dd dt td th h1 h2 h3 h4 h5 h6 figcaption caption summary address".split())
#: An open element (second) ends where one of the first starts.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ENDED = frozenset("p li dt dd tr td th option".split())
_SCOPE = frozenset("ul ol dl table article section div body html".split())
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adv|sponsor\w*|promo\w*|banner|sidebar|side-?bar|rail|menu|nav\w*|breadcrumbs?|pagination|pager|header|masthead|footer|foot"
    r"|comments?|comment-?list|disqus|replies|respond|cookie\w*|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|share|sharing|social"
    r"|related|recommend\w*|widget|toolbar|skip|search|login|copyright|complementary|contentinfo|navigation|dialog)(?:$|[\s_-])",
    re.I,
)
_CONTENT = frozenset("html body article main".split())
#: Names that tell what a page has or lacks, not what an element is.
_STATED = re.compile(r"(?<![A-Za-z0-9])(?:no|not|non|without|with|has|have)[_-](?:(?:left|right|top|bottom|sticky|fixed|main|primary)[_-])?[^\s_-]+", re.I)
_READERS = re.compile(r"(?:^|[\s_-])(?:comments?|comment-?list|disqus|replies|respond)(?:$|[\s_-])", re.I)
_HEADS = frozenset("h1 main article".split())
#: So many boxes of one kind beside each other are parts of one text.
_ALIKE = 3
_TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
#: More characters than this outside links read like prose.
_PROSE = 80
#: End tags by name, searched in the page itself: lower() may change a text's length.
_ENDS = {name: re.compile(f"</{name}", re.I | re.A) for name in _RAW}


def main_text(html: str) -> str:
    """The main text of one page. Where a container was left out by its name that holds the article, the page is read again with it."""
    text, wrappers = _read(html, frozenset())
    return _read(html, wrappers)[0] if wrappers else text


def _wrappers(parents: list[int], named: list[int], labels: dict[int, str], amount: dict[int, int], prose: set[int], heads: list[tuple[int, str]], soft: set[int]) -> frozenset[int]:
    """Of the elements left out by name (``labels``), those that hold more than half of the text and, with what
    lies around them, the page's only heading, main or article, or its only prose. Those left out as elements (``soft``) must
    hold prose, and their text does not count against the others. 0 stands for the page in ``amount``
    and ``prose``, which count what belongs to each such element alone; ``named`` gives each node's innermost one.
    Nodes are numbered in page order, so the parts of a node are the numbers up to its last one."""
    inside = dict.fromkeys(labels, 0) | amount
    plain = {node: 0 if node in soft else n for node, n in inside.items()}
    reads = dict.fromkeys(labels, False) | dict.fromkeys(prose, True)
    for node in sorted(labels, reverse=True):  # children come after their parents
        up = named[parents[node]]
        inside[up] = inside.get(up, 0) + inside[node]
        plain[up] = plain.get(up, 0) + plain[node]
        reads[up] = reads.get(up, False) or reads[node]
    last = list(range(len(parents)))
    for node in range(len(parents) - 1, 0, -1):
        last[parents[node]] = max(last[parents[node]], last[node])
    single = sum(tag == "article" for _, tag in heads) == 1
    owners = sorted(named[node] for node, tag in heads if tag != "article" or single)
    headers = {named[node] for node, _ in heads}
    owning = set(owners)
    out = []
    outside, around = False, 0  # is a heading's owner, and what else, around the node at hand?
    bare = True
    for node in sorted(labels):
        share = inside if node in soft else plain
        if 2 * share[node] <= share.get(0, 0) or (node in soft and not reads[node]):
            continue
        outside |= around in owning
        bare &= around not in prose and around not in headers
        at = bisect_left(owners, node)
        headed = not outside and at < len(owners) and owners[at] <= last[node]
        if not (headed or (bare and not _READERS.search(labels[node]))):
            break
        out.append(node)
        around = node
    return frozenset(out)


def _read(html: str, spared: frozenset[int]) -> tuple[str, frozenset[int]]:
    """(main text, containers to spare); the names of ``spared`` elements do not count."""
    tags, parents, dropped = ["#root"], [-1], [False]
    # For each node the innermost element left out by name, 0 if none; what belongs to each alone.
    named, labels, amount, prose, heads = [0], {}, {}, set(), []
    soft: set[int] = set()
    hard = [False]
    classes = [""]
    stack = [0]
    # For each place of the stack: the innermost block, and the innermost open element of each name that a start tag may end.
    held, ends = [0], [{}]
    open_at: dict[str, list[int]] = {}
    blocks: list[tuple[int, str, int]] = []
    run: list[str] = []
    linked = 0
    links = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                blocks.append((stack[held[-1]], text, linked))
            run.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal links
        while len(stack) > upto:
            name = tags[stack.pop()]
            held.pop()
            ends.pop()
            open_at[name].pop()
            if name == "a":
                links -= 1

    def add(text: str) -> None:
        nonlocal linked
        if tags[stack[-1]] == "head" and text.strip():
            close(len(stack) - 1)
        if text and not spared and not links and not hard[stack[-1]]:
            own, size = named[stack[-1]], len(text.strip())
            amount[own] = amount.get(own, 0) + size
            if size > _PROSE:
                prose.add(own)
        if text and not dropped[stack[-1]]:
            text = unescape(text)
            run.append(text)
            if links:
                linked += len(text.strip())

    pos = 0
    while True:
        found = _TOKEN.search(html, pos)
        if found is None:
            add(html[pos:])
            break
        add(html[pos : found.start()])
        pos = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            if name in _BLOCK:
                flush()
            # An end tag counts where such an element is open and, for inline ones, no block stands in between.
            if (places := open_at.get(name)) and (name in _BLOCK or places[-1] > held[-1]):
                close(places[-1])
            continue
        if name not in _HEAD and (places := open_at.get("head")) and not open_at.get("svg"):
            flush()
            close(places[-1])
        if name == "br":
            add(" ")
            continue
        if name in _VOID:
            if name == "hr":
                flush()
            continue
        if name in _BLOCK:
            flush()
            if p := ends[-1].get("p"):
                close(p)
        if name in _CLOSES:
            if at := max((ends[-1].get(n, 0) for n in _CLOSES[name]), default=0):
                close(at)
        attributes = found[3]
        out = hard[stack[-1]] or name in _SKIP
        label = kind = ""
        if attributes and not out:
            values = {n.lower(): a or b or c for n, a, b, c in reversed(_ATTRIBUTE.findall(attributes))}  # the first of a name counts
            kind = values.get("class", "")
            label = _STATED.sub(" ", " ".join(values[n] for n in ("class", "id", "role") if n in values))
            label = label if label and _UNLIKELY.search(label) else ""
            unseen = values.get("hidden", "false").lower() != "false" or values.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(values.get("style", ""))
            out = name not in _CONTENT and bool(unseen)
        if not out and name in _SOFT:
            label = label or name
            soft.add(len(tags))
        drop = out or dropped[stack[-1]] or bool(label and name not in _CONTENT and len(tags) not in spared)
        if attributes.endswith("/") and name not in _BLOCK:
            continue
        node = len(tags)
        tags.append(name)
        parents.append(stack[-1])
        dropped.append(drop)
        hard.append(out)
        classes.append(kind)
        named.append(named[parents[node]])
        if label and not out and name not in _CONTENT:
            named[node] = node
            labels[node] = label
        if name in _HEADS and not label and not out:
            heads.append((node, name))
        open_at.setdefault(name, []).append(len(stack))
        held.append(len(stack) if name in _BLOCK else held[-1])
        ends.append({} if name in _SCOPE else ends[-1] | {name: len(stack)} if name in _ENDED else ends[-1])
        stack.append(node)
        if name == "a":
            links += 1
        if name in _RAW:
            end = _ENDS[name].search(html, pos)
            if end is None:
                break
            pos = end.start()
    flush()
    wrappers = _wrappers(parents, named, labels, amount, prose, heads, soft) if labels and not spared else frozenset()
    if not blocks:
        return "", wrappers

    # What a node passes to its container, and what lies in it, from the leaves up.
    score = [0.0] * len(tags)
    whole = [0.0] * len(tags)
    volume = [0] * len(tags)
    link_volume = [0] * len(tags)
    for at, text, in_links in blocks:
        volume[at] += len(text)
        link_volume[at] += in_links
        points = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        points *= 1 - min(1.0, in_links / len(text))
        score[parents[at] if tags[at] in _PARAGRAPH else at] += points
        whole[at] += points
    children: list[list[int]] = [[] for _ in tags]
    for node in range(len(tags) - 1, 0, -1):
        up = parents[node]
        children[up].append(node)
        score[up] += score[node] / 2
        whole[up] += whole[node]
        volume[up] += volume[node]
        link_volume[up] += link_volume[node]
    density = [link_volume[i] / volume[i] if volume[i] else 0.0 for i in range(len(tags))]
    final = [s * (1 - d) for s, d in zip(score, density, strict=True)]
    best = max(range(len(tags)), key=lambda i: (final[i], i))
    if final[best] <= 0:
        best = 0
    node = best  # a part of an article stands for all of it
    while node > 0 and tags[node] != "article":
        node = parents[node]
    best = max(node, 0) or best
    # Boxes of one kind are parts of one text, however deep in them the best one lies.
    alike: list[int] = []
    node = best
    while node > 0 and tags[best] != "article":
        up = parents[node]
        boxes = [c for c in children[up] if tags[c] == tags[node] and classes[c] == classes[node] and not dropped[c] and whole[c] > 0 and density[c] < 0.25]
        if tags[node] in _BLOCK and tags[node] not in _PARAGRAPH and len(boxes) >= _ALIKE and 3 * whole[node] <= 2 * sum(whole[c] for c in boxes):
            best, alike = (node, boxes) if tags[up] in ("#root", "html", "body") else (up, [])
        node = up
    kept = {best, *alike}
    if best:
        near = max(10.0, 0.2 * final[best])
        for i in children[parents[best]]:
            if i != best and not dropped[i] and volume[i]:
                prose = tags[i] == "p" and volume[i] > 80 and density[i] < 0.25
                if final[i] >= near or prose or (alike and tags[i] in _TITLES):
                    kept.add(i)
    inside = [False] * len(tags)
    for i in range(len(tags)):
        inside[i] = i in kept or (parents[i] >= 0 and inside[parents[i]])
    return "\n".join(text for at, text, _ in blocks if inside[at]), wrappers


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    picked = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in picked.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return picked.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
