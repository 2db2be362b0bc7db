"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Every block of text gives points, one and one more for each comma and
each hundred characters up to three, to its container, half of them to the container around that, a third
to the next, and so on upwards. A container's points are discounted by its link density, the share of its
text that is in links. The best container is kept, as are siblings that have a fair share of its points or
are paragraphs of running text, and the headings before it; an article around it is taken whole.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and readers' comments are left
out by their elements, roles and class or id words; lists and boxes that are mostly links are left out of what is kept.
Words that are about content as often as not (tools, related, search) lower an element's points only; it is left out if it is
not running text: for the most part blocks of a sentence's length outside of links. So are forms, which some sites put around a whole page,
and parts of an article with a name that only begins like a menu's or a notice's (notice-period).

Defined results: a null or empty page, or one without text, gives an empty string; markup may be broken off
anywhere; unclosed elements end where HTML ends them; beyond a depth of DEEPEST elements are siblings; white space (any sign of it, <br> too) inside a
block becomes one space; blocks are joined by two line ends; text outside <body> counts, <head> does not.
Repeated rows give repeated results; only page_id, url and html are read, and other columns do not come along.
"""

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tessella.llm import textops as T

#: Comments, then declarations, then tags; quotes count after an equals sign only, and nothing is tried twice.
TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+"[^"]*+"?|=\s*+'[^']*+'?|=)*+)>?""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*+=\s*+("[^"]*+"?|'[^']*+'?|[^\s>]++)""", re.I)
QUOTED = re.compile(r""""[^"]*"?|'[^']*'?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes xmp iframe noembed".split())
DROPPED = frozenset("script style textarea title noframes iframe noembed noscript template svg math canvas object audio video map head nav footer aside button select option input menu dialog fieldset label datalist".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption option optgroup legend".split())
CONTAINERS = frozenset("article main section div body html td blockquote center details root".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl table div section p".split())
#: An element of the left kind ends open ones of the right kind, up to the nearest of the last kind.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
}
BARRIERS = frozenset("article aside blockquote body button caption details dialog div dl fieldset figure footer form header html li main nav object ol section table td th ul".split())
#: Words of class, id and role values that mark what is no part of an article, and those that mark one.
UNLIKELY = frozenset("""ad ads advert adverts advertisement advertising adbox adsense banner billboard breadcrumb breadcrumbs byline captcha comment comments commentlist
    consent cookie cookies gdpr disclaimer disqus footer footnav header masthead topbar toolbar login signin signup menu menus submenu nav navbar navigation
    newsletter notice notices alert alerts notification outbrain taboola pager pagination paywall popup modal overlay promo promos promotion promoted
    replies reply sharebar shoutbox sidebar sidebars sidenav skyscraper sponsor sponsored sponsors subscribe subscription tagcloud
    widget widgets complementary contentinfo toc userform""".split())
DOUBTFUL = frozenset("feedback paging rail recommend recommended recommendations related remark respond rss search share sharing skip social supplemental tags teaser tools".split())
LIKELY = frozenset("article articlebody body content entry hentry main page post story text".split())
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar toolbar".split())
#: Words that say where or what an element is and not what it is about: beside a word of UNLIKELY they clear nothing.
NEUTRAL = frozenset("""area bar block bottom box col column container content desktop element field footer form frame group header heading holder inline inner item items label large left
    line link links list main message mini mobile outer page panel part post row section site slot small sticky sub text title top right unit view wide wrap wrapper zone""".split())
PROSE = 400  # characters of running text from which on a form is a page's frame
SENTENCE, RUNNING = 80, 0.5  # characters of a block of running text; its share of an element's text that clears it of doubt
DEEPEST = 512  # elements inside one another; deeper ones are taken as siblings, as browsers do
SPLIT = re.compile(r"(?:\b|_)(?:has|with|without|no)[-_][a-zA-Z0-9]+|[^a-zA-Z0-9]+|(?<=[a-z0-9])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "depth", "dropped", "likely", "points", "text", "linked", "first", "last", "kids", "links", "doubt", "running", "need")

    def __init__(self, tag: str, parent, first: int):
        self.tag, self.parent, self.first, self.last = tag, parent, first, first
        self.depth = parent.depth + 1 if parent else 0
        self.dropped = bool(parent and parent.dropped)
        self.likely, self.points, self.text, self.linked, self.links = 0, 0.0, 0, 0, 0
        self.doubt, self.running, self.need = False, 0, 0
        self.kids: list = []


def _judge(node: Node, raw: str) -> None:
    """What an element's name and attributes say of it."""
    tag = node.tag
    if tag in DROPPED:
        node.dropped = True
        return
    if tag == "header":
        # an article's own header has its title: only headings of it are read (see parse)
        node.dropped = not _inside(node, ("article", "main"))
    if tag == "form":  # around a whole page on some sites, else a few fields
        node.doubt, node.need = True, PROSE
    node.likely = 25 if tag in ("article", "main") else 5 if tag in ("div", "section", "td", "blockquote") else 0
    if not raw or tag in ("html", "body"):
        return
    words, unlikely = set(), set()
    for name, value in ATTRIBUTE.findall(raw):
        name, value = name.lower(), value.strip("\"' ")
        if name == "role":
            if value.lower() in ROLES:
                node.dropped = True
            elif value.lower() in ("main", "article"):
                node.likely = 25
        elif name == "itemprop":
            if value.lower() == "articlebody":
                node.likely = 25
            elif value.lower() == "comment":
                node.dropped = True
        elif name in ("class", "id"):
            for name_ in value.split():
                own = {w.lower() for w in SPLIT.split(name_) if w}
                words |= own
                if own & UNLIKELY:
                    unlikely.add(all(w in UNLIKELY or w in NEUTRAL or w.isdigit() for w in own))
        elif name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            node.dropped = True
    if "hidden" in raw.lower() and re.search(r"(?:\s|^)hidden(?=[\s/>=]|\Z)", QUOTED.sub('""', raw), re.I):
        node.dropped = True
    # inside an article, "notice-period" and the like may be what it is about: then running text decides
    about = unlikely == {False} and _inside(node, ("article", "main"))
    if unlikely and not about and tag not in ("article", "main") or words & {"comment", "comments", "reply", "replies"}:
        # "post-header" and the like name parts of an article; what lies in links or notices is still found by density
        node.dropped = True
    elif about and tag not in ("article", "main"):
        node.doubt = True
    elif words & DOUBTFUL and tag not in ("article", "main"):
        node.doubt, node.likely = True, -25
    elif words & LIKELY:
        node.likely = max(node.likely, 15)


def _inside(node: Node, tags: tuple) -> bool:
    x = node.parent
    while x is not None:
        if x.tag in tags:
            return True
        x = x.parent
    return False


def parse(page: str):
    """The tree's root and the blocks (element, text, characters in links) in page order."""
    root = Node("root", None, 0)
    node, blocks, held, linked, in_link = root, [], [], 0, 0

    def flush():
        nonlocal linked
        if held:
            text = " ".join(_html.unescape("".join(held)).split())
            held.clear()
            x = node
            header = False
            while x.tag not in BLOCKS and x.parent is not None:
                x = x.parent
            y = x
            while y is not None and not header:
                header = y.tag == "header"
                y = y.parent
            if text and not node.dropped and not (header and x.tag not in HEADINGS):
                blocks.append((x, text, min(linked, len(text))))
        linked = 0

    def close(until: Node):
        """End every open element down to and with `until`."""
        nonlocal node, in_link
        x = node
        while True:
            x.last = len(blocks)
            if x.tag == "a":
                in_link -= 1
            if x is until:
                break
            x = x.parent
        node = until.parent

    at, size = 0, len(page)
    search = TOKEN.search
    while at < size:
        m = search(page, at)
        if m is None:
            if not node.dropped:
                held.append(page[at:])
                linked += (size - at) if in_link else 0
            break
        if m.start() > at and not node.dropped:
            held.append(page[at : m.start()])
            linked += (m.start() - at) if in_link else 0
        at = m.end()
        name = m[2]
        if name is None:
            continue  # a comment or a declaration
        tag = name.lower()
        if m[1]:
            if tag == "p" and not _open(node, "p"):
                continue
            if tag == "br":
                held.append(" ")
                continue
            found = _open(node, tag)
            if found is not None:
                if tag in BLOCKS or found.dropped != (found.parent or root).dropped or any_block(node, found):
                    flush()
                close(found)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            held.append(" ")
            continue
        if tag in ENDS_P:
            p = _open(node, "p", BARRIERS)
            if p is not None:
                flush()
                close(p)
        if tag in IMPLIED:
            ends, scope = IMPLIED[tag]
            x, last = node, None
            while x is not None and x.tag not in scope:
                if x.tag in ends:
                    last = x
                x = x.parent
            if last is not None:
                flush()
                close(last)
        if tag in HEADINGS and node.tag in HEADINGS:
            flush()
            close(node)
        if tag == "body" or tag == "html":
            head = _open(node, "head")
            if head is not None:
                flush()
                close(head)
            if tag == "html" and node is not root or _open(node, "body"):
                continue
        if node.depth >= DEEPEST:
            flush()
            close(node)
        new = Node(tag, node, len(blocks))
        _judge(new, m[3])
        if tag in BLOCKS or new.dropped != node.dropped:
            flush()
            new.first = len(blocks)
        if m[3].endswith("/") and tag in ("svg", "math"):
            continue
        node.kids.append(new)
        node = new
        if tag == "a":
            in_link += 1
            for_links = node.parent
            while for_links is not None:
                for_links.links += 1
                for_links = for_links.parent
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size
    flush()
    close(root)
    return root, blocks


def _open(node: Node, tag: str, stop: frozenset = frozenset()):
    """The nearest open element of a tag, not looked for beyond a barrier."""
    x = node
    while x is not None:
        if x.tag == tag and x.parent is not None:
            return x
        if x.tag in stop:
            return None
        x = x.parent
    return None


def any_block(node: Node, until: Node) -> bool:
    """Whether a block element is open within `until`."""
    x = node
    while x is not until:
        if x.tag in BLOCKS:
            return True
        x = x.parent
    return False


def _density(node: Node) -> float:
    return node.linked / node.text if node.text else 0.0


def _above(node: Node):
    while node is not None:
        yield node
        node = node.parent


def _cleared(blocks: list) -> list[bool]:
    """For each block whether no doubtful element around it is other than running text."""
    doubtful = [[y for y in _above(x) if y.doubt] for x, _, _ in blocks]
    size: dict[int, int] = {}
    for (_, text, linked), around in zip(blocks, doubtful):
        for y in around:
            size[id(y)] = size.get(id(y), 0) + len(text)
            y.running += len(text) - linked if len(text) >= SENTENCE and linked < 0.25 * len(text) else 0
    return [all(y.running >= max(RUNNING * size[id(y)], y.need) for y in around) for around in doubtful]


def extract(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    root, blocks = parse(page)
    out_of_doubt = _cleared(blocks)
    seen: list[Node] = []
    for (x, text, linked), clear in zip(blocks, out_of_doubt):
        if not clear:
            continue
        points = 1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) / 100, 3.0)
        share, y = 1, x
        while y is not None:
            y.text += len(text)
            y.linked += linked
            if y.tag in CONTAINERS:
                if not y.points:
                    seen.append(y)
                y.points += points / share
                share += 1
            y = y.parent
    if not seen:
        return ""
    worth = {id(x): (x.points + (x.likely if x.text else 0)) * (1 - _density(x)) for x in seen}
    order = {id(x): k for k, x in enumerate(sorted(seen, key=lambda x: x.first))}
    best = max(seen, key=lambda x: (worth[id(x)], -order[id(x)]))
    y = best
    while y is not None:  # an article around the best container is taken whole
        if y.tag in ("article", "main") and y.likely >= 25:
            best = y
            if y.tag == "article":
                break
        y = y.parent
    kept = [best]
    if best.parent is not None:
        least = max(10.0, 0.2 * worth[id(best)])
        for s in best.parent.kids:
            if s is best or s.dropped or not s.text:
                continue
            plain = _density(s)
            if worth.get(id(s), 0.0) >= least or s.tag == "p" and (s.text > 80 and plain < 0.25 or plain == 0) or s.tag in HEADINGS and s.last <= best.first:
                kept.append(s)
    inside = sorted((x.first, x.last) for x in kept)
    # lists, tables and boxes that are mostly links go
    out, bad = [], {}
    for k, (x, text, _) in enumerate(blocks):
        if not out_of_doubt[k] or not any(a <= k < b for a, b in inside):
            continue
        y, drop, path = x, False, []
        while y is not None and y is not root:
            if id(y) in bad:
                drop = bad[id(y)]
                break
            path.append(y)
            if y in kept:
                break
            y = y.parent
        for y in reversed(path):
            drop = drop or (y not in kept and y.tag in LISTS and y.links > 1 and _density(y) > 0.5)
            bad[id(y)] = drop
        if not drop:
            out.append(text)
    return "\n\n".join(out)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages(page_id, url, html)."""
    schema = "page_id long, url string, text string, n_chars long"

    def run(batches):
        for batch in T.chunks(batches):
            text = [extract(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "url", "html text").mapInArrow(run, schema)
