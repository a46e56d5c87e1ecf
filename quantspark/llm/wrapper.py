"""Main text of web pages by wrapper induction over pages of one host.

Pages are dealt to groups of one host; a host with very many pages is split
over several groups.  A group is read as a stream of chunks of up to
``CHUNK_PAGES`` pages; its last two chunks are evened out, so no chunk is left
with a few pages.  In a chunk, each page's DOM tree is aligned with a
reference page of the same layout by simple tree matching (an order-preserving
matching of children that maximises matched nodes).  Text that stays constant
at an aligned place over most differing pages is template; what varies there,
or has no counterpart, is a slot.  A slot is content unless its place in the
page says otherwise: navigation, header, footer, sidebar, notice, advert,
form, comment section and the like, by element or by the words in its class,
id or role.  Where the page marks its article, only slots inside count.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_PAGES = 128
CHUNK_CHARS = 16 << 20
GROUP_PAGES = 256
GROUP_SHARE = 4096        # a host gets groups of its own above max(GROUP_PAGES, pages / GROUP_SHARE)
SAME_LAYOUT = 0.5         # matched share of nodes for one layout
CONSTANT = 0.6            # share of differing pages with the same text at a place
MIN_WITNESSES = 4         # differing pages needed to call a text constant
ALIGN_CELLS = 40_000      # above it, long child lists are aligned by equal runs instead of a full table

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript")
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup
option p pre search section summary table tbody td tfoot th thead tr ul br""".split())
CLOSES_P = BLOCK - frozenset(("br", "option", "optgroup", "html", "body"))
HIDDEN = frozenset("""head script style noscript template iframe object embed svg math canvas audio video nav footer aside
form button select textarea input label menu dialog title noembed noframes""".split())
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Elements whose end tag may be left out: closed by a sibling of these names.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "tbody", "tfoot", "thead"),
            "td": ("td", "th", "tr"), "th": ("td", "th", "tr"), "option": ("option", "optgroup"),
            "tbody": ("tbody", "tfoot"), "thead": ("tbody", "tfoot")}
SCOPE = frozenset("table td th div article section main aside nav header footer form body html ul ol dl".split())
# Words that mark a place outside the main text, as the head of a name in class, id or role
# (``acme-sidebar``, ``comment-list``, but not ``sidebar-price``).
HEADS = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar banner footer
sidebar sidenav aside widget widgets complementary contentinfo ad ads advert adverts advertisement advertising adsense
adslot sponsor sponsored promo cookie cookies consent gdpr popup modal overlay disclaimer newsletter subscribe signup
login paywall comment comments disqus pagination pager toolbar copyright""".split())
# Words that also name subjects of articles: they count only in names made of such words and words of layout.
AMBIGUOUS = frozenset("""rail bottom promotion notice notices notification alert subscription share sharing social reply
replies respond related recommended recommendations search skip legal tracking""".split())
LAYOUT = frozenset("""site page main global top left right primary secondary inner outer wrapper wrap container content
section block box bar area list item items link links button buttons icon icons panel group row col column text title
form post posts article articles entry story user reader your more us this to the of js is has no""".split())
ARTICLE_ROLES = frozenset(("main", "article"))

# A tag by the states of HTML's tokenizer: tag name, then attributes (name, and a double-quoted, single-quoted or
# unquoted value, in which quotes are ordinary characters).  A quote that never closes ends at the next ">".
_VALUE = r"""(?>"([^"]*+)"|'([^']*+)'|["'][^>]*+|([^\s>"'][^\s>]*+))"""
_ATTRIBUTE = rf"(=[^\s/>=]*+|[^\s/>=]++)(?>\s*+=\s*+{_VALUE}?+)?+"
_ATTR = re.compile(_ATTRIBUTE)
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</(?![A-Za-z]|\Z)[^>]*>?"
                    r"|<(/?)([A-Za-z][^\s/>]*+)((?>[\s/]++|ATTRIBUTE)*+)(?:>|\Z)|[^<]+|<".replace(
                        "ATTRIBUTE", _ATTRIBUTE.replace("(=[", "(?:=[", 1).replace("([^", "(?:[^")), re.DOTALL)
_NAME = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """An element: its children are elements and text pieces in page order."""
    __slots__ = ("tag", "outside", "article", "children", "size", "parent")

    def __init__(self, tag, outside, article, parent):
        self.tag, self.outside, self.article, self.parent = tag, outside, article, parent
        self.children, self.size = [], 1


def _names_outside(value: str) -> bool:
    """Whether one of the names in a class, id or role marks a place outside the main text: its last word besides
    layout words is a head, or all its words are heads, ambiguous words and layout words."""
    for name in value.split():
        words = [w for w in _NAME.findall(_CAMEL.sub("-", name).lower()) if w not in LAYOUT and not w.isdigit()]
        if words and (words[-1] in HEADS or all(w in HEADS or w in AMBIGUOUS for w in words)):
            return True
    return False


def _marks(tag: str, attrs: str) -> tuple[bool, bool]:
    """(outside the main text, marks the article) by element and by class, id, role, hidden and itemprop."""
    outside, article = tag in HIDDEN or tag == "header", tag in ("article", "main")
    if attrs and not attrs.isspace():
        for m in _ATTR.finditer(attrs):
            name = m.group(1).lower()
            named = unescape(m.group(2) or m.group(3) or m.group(4) or "")
            value = named.lower()
            if name in ("class", "id", "role"):
                words = _NAME.findall(value)
                hit = _names_outside(named)
                if name == "role" and value.strip() in ARTICLE_ROLES:
                    article = True
                elif hit and tag not in ("html", "body", "main", "article"):
                    outside = True
                elif hit and tag == "article" and any(w in ("comment", "comments", "reply", "replies", "ad", "ads",
                                                            "related", "promo", "sponsored") for w in words):
                    outside, article = True, False
            elif name == "itemprop" and value == "articlebody":
                article = True
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                    name == "style" and "display:none" in value.replace(" ", "")):
                outside = True
    return outside, article


def parse(page: str) -> Node:
    """The DOM tree of a page, with implied and missing end tags mended."""
    root = Node("#root", False, False, None)
    at, pos, n = root, 0, len(page)
    while pos < n:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m.group(2)
        if tag is None:
            text = m.group()
            if text[0] != "<" or text == "<":
                at.children.append(unescape(text))
            continue
        tag = tag.lower()
        if m.group(1):
            if tag == "br":
                at.children.append(" ")
                continue
            up = at
            while up is not root and up.tag != tag:
                if up.tag in SCOPE and tag not in SCOPE:
                    up = root                         # a stray end tag does not close a container
                    break
                up = up.parent
            if up is not root:
                at = up.parent
            elif tag == "p":
                at.children.append(Node("p", False, False, at))
            continue
        if tag in CLOSES_P or tag in SIBLINGS:
            up = at
            closing = SIBLINGS.get(tag, ())
            while up is not root and up.tag not in SCOPE:
                if up.tag == "p" and tag in CLOSES_P or up.tag in SIBLINGS and tag in SIBLINGS[up.tag]:
                    at = up.parent
                up = up.parent
            if up is not root and up.tag in closing:  # td and th bound their own scope
                at = up.parent
                if tag == "tr" and at.tag == "tr":
                    at = at.parent
        node = Node(tag, *_marks(tag, m.group(3)), at)
        at.children.append(node)
        if tag in RAW:
            end = re.compile(r"</" + tag + r"(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, pos)
            pos = end.end() if end else n
        elif tag not in VOID and not m.group(3).endswith("/"):
            at = node
        elif tag not in VOID and tag in ("svg", "path"):
            continue
        elif tag not in VOID:
            at = node                                 # a slash does not close an HTML element
    _measure(root)
    return root


def _measure(root: Node) -> None:
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        order.append(x)
        stack += [c for c in x.children if isinstance(c, Node)]
    for x in reversed(order):
        x.size = 1 + sum(c.size for c in x.children if isinstance(c, Node))


def _runs(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Order-preserving alignment of long child lists by their equal runs of element names."""
    from difflib import SequenceMatcher
    found = SequenceMatcher(None, [x.tag for x in a], [y.tag for y in b], autojunk=False).get_matching_blocks()
    return [(m.a + k, m.b + k) for m in found for k in range(m.size)]


def tree_match(a: Node, b: Node, pairs: list | None = None, depth: int = 0) -> int:
    """Simple tree matching: the largest number of matched nodes of two trees whose matched nodes agree in
    element name, keep the order of siblings and match their parents.  ``pairs`` collects them."""
    if a.tag != b.tag or a.outside != b.outside:
        return 0
    if pairs is not None:
        pairs.append((a, b))
    x = [c for c in a.children if isinstance(c, Node)]
    y = [c for c in b.children if isinstance(c, Node)]
    if not x or not y or depth > 200:
        return 1
    if len(x) * len(y) > ALIGN_CELLS:
        chosen = _runs(x, y)
        return 1 + sum(tree_match(x[i], y[j], pairs, depth + 1) for i, j in chosen)
    memo = {}
    score = np.zeros((len(x) + 1, len(y) + 1), dtype=np.int64).tolist()
    for i in range(1, len(x) + 1):
        row, above = score[i], score[i - 1]
        for j in range(1, len(y) + 1):
            p, q = x[i - 1], y[j - 1]
            w = 0
            if p.tag == q.tag:
                w = 1 if p.size == 1 or q.size == 1 else tree_match(p, q, None, depth + 1)
                if p.outside != q.outside:
                    w = 0
                memo[i, j] = w
            row[j] = max(above[j], row[j - 1], above[j - 1] + w)
    i, j = len(x), len(y)
    if pairs is not None:
        chosen = []
        while i and j:
            if score[i][j] == score[i - 1][j]:
                i -= 1
            elif score[i][j] == score[i][j - 1]:
                j -= 1
            else:
                chosen.append((i - 1, j - 1))
                i, j = i - 1, j - 1
        for i, j in reversed(chosen):
            tree_match(x[i], y[j], pairs, depth + 1)
    return 1 + score[len(x)][len(y)]


def blocks(root: Node) -> list[tuple[list[Node], str]]:
    """(path of elements, text) of every block in page order: text without a block border inside."""
    out, parts, owner = [], [], []

    def flush():
        text = " ".join("".join(parts).split())
        if text:
            out.append((owner[0], text))
        parts.clear()
        owner.clear()

    stack = [(root, iter(root.children), (root,))]
    while stack:
        node, children, path = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if node.tag in BLOCK:
                flush()
        elif isinstance(child, str):
            if not owner and not child.isspace():
                owner.append(path)
            parts.append(child)
        elif child.tag == "br":
            parts.append(" ")
        else:
            if child.tag in BLOCK:
                flush()
            if child.tag in RAW or child.tag in ("head", "template", "svg", "math", "select", "button"):
                continue
            if child.tag not in VOID:
                # an inline element outside the main text (a label, an inline advert) is a block of its own
                if child.outside and child.tag not in BLOCK:
                    flush()
                    stack.append((child, iter([*child.children, Node("br", False, False, child)]), (*path, child)))
                    continue
                stack.append((child, iter(child.children), (*path, child)))
    flush()
    return out


def _outside(path: tuple[Node, ...]) -> bool:
    """Whether a place is outside the main text.  A header inside the article still gives its headings."""
    article = False
    for x in path:
        if x.outside:
            if x.tag == "header" and article and path[-1].tag in HEADING or (
                    x.tag == "header" and article and any(y.tag in HEADING for y in path)):
                continue
            return True
        article = article or x.article
    return False


def _leaf(path: tuple[Node, ...]) -> Node:
    """The block-level element that holds the text."""
    return next((x for x in reversed(path) if x.tag in BLOCK or x.tag == "#root"), path[0])


def induce(trees: list[Node]) -> list[str]:
    """Main texts of pages of one host, in the order given."""
    found = [blocks(t) for t in trees]
    texts = [" ".join(t for p, t in b if not _outside(p)) for b in found]
    layouts: list[list[int]] = []
    pairs_of: dict[int, list] = {}
    for i, t in enumerate(trees):
        for members in layouts:
            ref = trees[members[0]]
            pairs: list = []
            if 2 * tree_match(ref, t, pairs) >= SAME_LAYOUT * (ref.size + t.size):
                members.append(i)
                pairs_of[i] = pairs
                break
        else:
            layouts.append([i])
            pairs_of[i] = []
    out = [""] * len(trees)
    for members in layouts:
        ref = trees[members[0]]
        place = {}                                    # a page's node -> the reference's node
        for i in members:
            place.update({id(y): id(x) for x, y in pairs_of[i]})
        # Every differing page is one witness: copies of a page say nothing about the template.
        witnesses = {texts[i]: i for i in reversed(members)}
        seen: Counter = Counter()
        for i in witnesses.values():
            own = {(id(_leaf(p)) if trees[i] is ref else place.get(id(_leaf(p))), t) for p, t in found[i]}
            seen.update(k for k in own if k[0] is not None)
        enough = max(MIN_WITNESSES, CONSTANT * len(witnesses))
        for i in members:
            slots = []
            for path, text in found[i]:
                leaf = id(_leaf(path))
                spot = leaf if trees[i] is ref else place.get(leaf)
                if not (spot is not None and seen[spot, text] >= enough) and not _outside(path):
                    slots.append((path, text))
            inside = [s for s in slots if any(x.article for x in s[0])]
            out[i] = " ".join(t for _, t in _main(slots, inside))
    return out


def _main(slots, inside):
    """Slots of the marked article if it holds most of the free text, else all but link lists."""
    size = sum(len(t) for _, t in slots)
    if inside and sum(len(t) for _, t in inside) >= 0.3 * size:
        return inside
    return [s for s in slots if not all(x.tag in ("a", "li", "ul", "ol") for x in s[0][-2:]) or
            not any(x.tag == "a" for x in s[0])]


def host_of(url):
    """Host part of a URL column, lower case; empty for null or relative URLs."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null and empty pages give an empty text.  Pages without a host are
    aligned with each other.  A page alone in its host is judged by its own
    markup.  Repeated rows give repeated results; ids may be null.
    """
    import pyarrow as pa

    kind = dict(pages.dtypes)
    slim = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
                        host_of(F.col(f"`{url_col}`")).alias("host"))
    total = slim.count()
    limit = max(GROUP_PAGES, -(-total // GROUP_SHARE))
    large = slim.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(
        "host", F.ceil(F.col("n") / limit).cast("int").alias("groups"))      # fewer than GROUP_SHARE hosts
    salt = F.pmod(F.xxhash64("page_id", F.length("html")), F.coalesce("groups", F.lit(1))).cast("int")
    dealt = slim.join(F.broadcast(large), "host", "left").withColumn("salt", salt).drop("groups")
    dealt = dealt.repartition("host", "salt").sortWithinPartitions("host", "salt", "page_id", F.xxhash64("html"))

    def run(batches):
        def done(chunk):
            texts = induce([parse(x) for _, _, x in chunk])
            return pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in chunk], id_type), pa.array([c[1] for c in chunk], pa.string()),
                 pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

        def ended():
            """The last chunks of a group: a short remainder is shared with the full chunk before it."""
            pages = before + held
            cut = len(pages) if not before else (len(pages) + 1) // 2 if 2 * len(held) < len(before) else len(before)
            return [done(c) for c in (pages[:cut], pages[cut:]) if c]

        id_type, before, held, chars, group = None, [], [], 0, None
        for batch in batches:
            id_type = batch.schema.field("page_id").type
            names = ("page_id", "url", "html", "host", "salt")
            for i, u, x, h, s in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                if group != (h, s):
                    yield from ended()
                    before, held, chars, group = [], [], 0, (h, s)
                elif len(held) >= CHUNK_PAGES or chars + len(x) > CHUNK_CHARS and held:
                    if before:
                        yield done(before)
                    before, held, chars = held, [], 0
                held.append((i, u, x))
                chars += len(x)
        yield from ended()

    return dealt.mapInArrow(run, f"page_id {kind[id_col]}, url string, text string, n_chars bigint")
