"""HTML extraction by wrapper induction over pages of one host.

Method
------
1. Every page becomes a tree of block elements (inline ones are part of their
   block's text); runs of equal siblings fold into one list slot.
2. A host's wrapper is the union of the different trees of its pages: each is
   aligned by simple tree matching, and what the wrapper lacks is put in at its
   place, so that every layout has its slots.  Elements whose path of labels
   fewer than ``least_pages`` of the host's pages have can hold no template and
   stay out.  Trees merge in two steps, in ``SHARES`` shares of a host and then
   the shares.  Every page is aligned with the wrapper, and its texts are
   counted by the slot they fall into.
3. A text is constant, template, if it fills a slot on ``least_pages`` or more
   pages and on at least ``share`` of those that have the slot: of the host's
   pages, or of its pages of one layout (equal labels on the top levels).
   All else in a slot varies: content.
4. Slots whose texts vary are judged by what all the host's pages have in them.
   The block with most varying text below the body is the host's content; a slot
   beside it is an advert or a teaser, whatever it is called, if it never holds a
   paragraph (``PARAGRAPH`` characters) and brings a page at most ``ASIDE`` of
   what the content does.  Headings, and what stands in ``article`` or ``main``,
   are not judged so.
5. A second alignment applies the wrapper: template texts and judged slots go,
   but a constant text between two varying blocks of one parent is part of the
   article (a heading that every article has).  What element names, roles and
   whole class names or ids that can mean nothing else (``NAMES``) declare as
   menu, header, footer, sidebar, notice, advert, form or comments goes too, as a
   hint for hosts without a wrapper, and outside an article blocks of two or more
   links and no other words.  Other class names drop nothing: there the slots
   decide.  Of an article's header the text that stands right in it, beside the
   heading, goes only where nothing was counted.  Slots decide inside and outside
   of ``article`` and ``main`` alike.  Pages of a host with equal texts in equal
   trees count once: copies of a page must not wipe it out.
6. Where a host has fewer than ``least_pages`` different pages, nothing tells
   content from template; only there ``article`` and ``main`` are a hint: they
   are read alone if they hold at least half of the page's text.

The wrapper of a host is one small row; pages meet it in a join on the host
that adaptive execution splits or broadcasts by measured size.  Counting takes
(host, slot, text digest) rows with partial aggregation; no host's pages ever
meet in one task.

Defined results: null and empty html give an empty text; a null url is a host of
its own; repeated rows and null ids each give their row; an unclosed page is
read to its end; elements nested deeper than ``DEEPEST`` are read in place, as
blocks of the last level; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import html as entities
import json
import pickle
import re
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm.shared import stored

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*)>?""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
SPACES = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody td
tfoot th thead tr ul""".split())
#: open elements that an opening tag ends
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tbody": {"thead", "tbody", "tr", "td", "th"}, "option": {"option"}}
WALL = frozenset("ul ol dl table article section div body html".split())
DROPPED = frozenset("nav aside footer form button select option input head script style audio video canvas dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: whole class names and ids that declare what is not the article
NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle ad-banner ad-container ad-slot ad-unit ad-wrapper
banner-ad sponsored sponsored-content sponsored-links cookie-notice cookie-banner cookie-bar cookie-consent cookie-popup cookie-message consent-banner
gdpr-banner popup modal newsletter-signup newsletter-form subscribe-form signup-form paywall nav navbar navigation main-nav site-nav main-navigation
site-navigation nav-menu main-menu breadcrumb breadcrumbs sidebar side-bar site-sidebar masthead site-header page-header footer site-footer page-footer
pagination pager share-buttons sharing-buttons social-share social-links social-buttons related-posts related-articles related-links comments
comment-list commentlist comments-area comment-form respond disqus disqus_thread toolbar skip-link skip-to-content""".split())
SHARES = 16                    # in which the trees of a host merge
DEEPEST = 150                  # levels of nesting that are kept apart
PARAGRAPH = 300                # a slot beside the content that holds a text as long is content as well
ASIDE = 0.2                    # most that a judged slot brings to a page, in parts of the content's characters


class Node:
    """A block element: what it is called, whether it is declared boilerplate, inline text runs between its children."""
    __slots__ = ("tag", "label", "dropped", "items", "links", "plain")

    def __init__(self, tag, label, dropped):
        self.tag, self.label, self.dropped = tag, label, dropped
        self.items: list = []           # Node or str
        self.links, self.plain = 0, False       # links, words outside of them


@lru_cache(maxsize=20_000)
def _declared(tag: str, attributes: str) -> tuple[str, bool]:
    """(label for matching, declared boilerplate) of an opening tag."""
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    dropped = (tag in DROPPED or found.get("role", "").lower() in ROLES or found.get("aria-hidden") == "true"
               or "display:none" in found.get("style", "").replace(" ", "").lower()
               or re.search(r"(?:^|\s)hidden(?:\s|=|$)", ATTRIBUTE.sub(" ", attributes)) is not None
               or tag not in ("html", "body", "article", "main") and not NAMES.isdisjoint(names))
    return f"{tag}.{SPACES.sub('.', found.get('class', '').strip().lower())}", dropped


def parse(page: str) -> Node:
    """Block tree of a page; tag soup is mended as browsers do for paragraphs, list items and table cells."""
    root = Node("#", "#", False)
    stack: list[tuple[str, Node]] = [("#", root)]
    node, at, n = root, 0, len(page)
    hidden = link = 0                                     # depth inside dropped inline elements, inside links

    def text(piece: str):
        if piece and not hidden:
            piece = entities.unescape(piece) if "&" in piece else piece
            node.items.append(piece)
            if not link and not node.plain:
                node.plain = any(map(str.isalnum, piece))

    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        if at == m.start():
            at += 1
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    for name, _ in stack[k:]:
                        hidden -= name.startswith("~")
                        link -= name == "a"
                    del stack[k:]
                    node = stack[-1][1]
                    break
                if stack[k][0] == "~" + tag:
                    hidden -= 1
                    for name, _ in stack[k + 1:]:
                        hidden -= name.startswith("~")
                        link -= name == "a"
                    del stack[k:]
                    node = stack[-1][1]
                    break
                if stack[k][0] in WALL and tag not in BLOCK:
                    break
            continue
        attributes = m[3]
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                text(" ")
            continue
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):        # an open paragraph, list item or cell ends here
                name = stack[k][0]
                if name == "p" or name in ENDS.get(tag, ()):
                    for gone, _ in stack[k:]:
                        hidden -= gone.startswith("~")
                        link -= gone == "a"
                    del stack[k:]
                    node = stack[-1][1]
                    if name == "p" or name == tag:
                        break
                elif name in WALL and tag not in ("tr", "td", "th", "tbody"):
                    break
            label, dropped = _declared(tag, attributes)
            if len(stack) > DEEPEST:                      # flattened: a break, no level of its own
                hidden += dropped
                node.items.append(Node("", "", False))
                stack.append(("~" + tag if dropped else tag, node))
                continue
            if not hidden:
                child = Node(tag, label, dropped)
                node.items.append(child)
                node = child
            stack.append((tag, node))
        else:
            dropped = _declared(tag, attributes)[1]
            hidden += dropped
            link += tag == "a" and not dropped
            node.links += tag == "a" and not (dropped or hidden)
            if not attributes.endswith("/"):
                stack.append(("~" + tag if dropped else tag, node))
            elif dropped:
                hidden -= 1
    return root


def runs(node: Node):
    """The node's items with neighbouring texts joined: (text or None, child or None), blank texts left out."""
    held: list[str] = []
    for x in node.items:
        if isinstance(x, str):
            held.append(x)
            continue
        if held:
            t = SPACES.sub(" ", "".join(held)).strip()
            held = []
            if t:
                yield t, None
        yield None, x
    if held:
        t = SPACES.sub(" ", "".join(held)).strip()
        if t:
            yield t, None


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Slot:
    """A tree node for matching: equal neighbouring children are folded into one."""
    __slots__ = ("label", "children", "texts", "homes", "number")

    def __init__(self, label):
        self.label, self.children, self.texts, self.homes, self.number = label, [], [], [], -1

    def absorb(self, other: Slot):
        self.texts += other.texts
        self.homes += other.homes           # the node of every text
        self.children += other.children
        if other.children:
            self.children = fold(self.children)


def fold(children: list[Slot]) -> list[Slot]:
    out: list[Slot] = []
    for c in children:
        if out and out[-1].label == c.label:
            out[-1].absorb(c)
        else:
            out.append(c)
    return out


def slots(node: Node) -> Slot:
    s, children = Slot(node.label), []
    for t, child in runs(node):
        if child is None:
            s.texts.append(t)
            s.homes.append(id(node))
        elif not child.dropped:
            children.append(slots(child))
    s.children = fold(children)
    return s


def skeleton(slot: Slot):
    return (slot.label, tuple(skeleton(c) for c in slot.children))


def numbered(tree, start: int = 0):
    """((label, number, children), next number) of a skeleton, numbers in page order."""
    label, children = tree
    number, start, out = start, start + 1, []
    for c in children:
        child, start = numbered(c, start)
        out.append(child)
    return (label, number, out), start


def union(a, b):
    """The skeleton of ``a`` with all that ``b`` has besides; their roots are equal."""
    x, y = a[1], b[1]
    if not y or x == y:
        return a
    if not x:
        return b
    weight = [[_common(c, d) if c[0] == d[0] else 0 for d in y] for c in x]
    best = _best(weight, len(x), len(y))
    i, j, out = len(x), len(y), []
    while i and j:
        if weight[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weight[i - 1][j - 1]:
            out.append(union(x[i - 1], y[j - 1]))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i][j - 1]:          # between two matches those of ``a`` come first
            j -= 1
            out.append(y[j])
        else:
            i -= 1
            out.append(x[i])
    out += [*reversed(x[:i]), *reversed(y[:j])]
    return (a[0], tuple(reversed(out)))


def _best(weight, n: int, m: int):
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        row, above = best[i + 1], best[i]
        for j in range(m):
            row[j + 1] = max(above[j + 1], row[j], above[j] + weight[i][j])
    return best


def _common(a, b) -> int:
    """Size of the match of two skeletons with equal labels."""
    if a == b:
        return weighed(a)
    if not a[1] or not b[1]:
        return 1
    return 1 + _best([[_common(c, d) if c[0] == d[0] else 0 for d in b[1]] for c in a[1]], len(a[1]), len(b[1]))[-1][-1]


def weighed(tree) -> int:
    return 1 + sum(weighed(c) for c in tree[1])


def layout(tree) -> int:
    """Key of a page's layout: the labels of its tree down to the first level with several."""
    names = [tree[0]]
    while len(tree[1]) == 1:
        tree = tree[1][0]
        names.append(tree[0])
    return digest(repr((names, [c[0] for c in tree[1]])))


def match(page: Slot, wrapper) -> int:
    """Simple tree matching: size of the largest order-keeping match of two trees with equal roots; numbers the page's slots."""
    if page.label != wrapper[0]:
        return 0
    a, b = page.children, wrapper[2]
    page.number = wrapper[1]
    if not a or not b:
        return 1
    weight = [[_size(x, y) if x.label == y[0] else 0 for y in b] for x in a]
    best = _best(weight, len(a), len(b))
    i, j = len(a), len(b)
    while i and j:
        if weight[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weight[i - 1][j - 1]:
            match(a[i - 1], b[j - 1])
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + best[-1][-1]


def _size(x: Slot, y) -> int:
    """Size of the match of two subtrees with equal labels."""
    a, b = x.children, y[2]
    if not a or not b:
        return 1
    above = [0] * (len(b) + 1)
    for c in a:
        row = [0]
        for j, d in enumerate(b):
            row.append(max(above[j + 1], row[j], above[j] + (_size(c, d) if c.label == d[0] else 0)))
        above = row
    return 1 + above[-1]


def placed(slot: Slot):
    """(slot number, text) of every text in a matched slot."""
    if slot.number >= 0:
        for t in slot.texts:
            yield slot.number, t
    for c in slot.children:
        yield from placed(c)


def constants(slot: Slot, template: frozenset):
    """(node, text) of every text that is template in its slot."""
    if slot.number >= 0:
        for t, home in zip(slot.texts, slot.homes):
            if (slot.number, digest(t)) in template:
                yield home, t
    for c in slot.children:
        yield from constants(c, template)


def judged(tree, stats: dict, least_pages: int) -> list[int]:
    """Numbers of the slots beside the content that hold no content; ``stats``: slot -> (pages, varying characters, longest)."""
    total: dict[int, int] = {}

    def add(t) -> int:
        total[t[1]] = stats.get(t[1], (0, 0, 0))[1] + sum(add(c) for c in t[2])
        return total[t[1]]

    everything = add(tree)
    name = lambda t: t[0].split(".")[0]
    content = tree
    while content[2]:
        best = max(content[2], key=lambda c: total[c[1]])
        if total[best[1]] < 0.6 * everything or not (name(content) in ("#", "html", "body") or len(content[2]) == 1 or name(best) in ("article", "main")):
            break
        content = best
    pages = stats.get(content[1], (0, 0, 0))[0]
    out: list[int] = []
    if not pages or content is tree:
        return out
    most = ASIDE * total[content[1]] / pages

    def walk(t):
        if t is content or name(t) in ("article", "main"):
            return
        seen, chars, longest = stats.get(t[1], (0, 0, 0))
        if seen >= least_pages and longest < PARAGRAPH and chars <= most * seen and not re.fullmatch("h[1-6]", name(t)):
            out.append(t[1])
        for c in t[2]:
            walk(c)

    walk(tree)
    return out


def slotted(slot: Slot, numbers: frozenset):
    """(node, text) of every text in the slots of ``numbers``."""
    if slot.number in numbers:
        yield from zip(slot.homes, slot.texts)
    for c in slot.children:
        yield from slotted(c, numbers)


def extract(page: str, wrapper=None, template=None, decided: bool = False, aside: frozenset = frozenset()) -> str:
    """Main text of a page: blocks joined by one newline; ``template`` has the constant (slot, digest) pairs of every layout and,
    as None, of all; ``decided`` where the host's slots were counted on enough pages; ``aside`` the judged slots."""
    root = parse(page)
    constant: set[tuple[int, str]] = set()
    beside: set[tuple[int, str]] = set()
    if wrapper is not None and (template or aside):
        tree = slots(root)
        match(tree, wrapper)
        constant = set(constants(tree, template.get(None, frozenset()) | template.get(layout(skeleton(tree)), frozenset())))
        beside = set(slotted(tree, aside))

    def regions(node: Node, out: list[Node]):
        for x in node.items:
            if isinstance(x, Node) and not x.dropped:
                if x.tag in ("article", "main"):
                    out.append(x)
                else:
                    regions(x, out)
        return out

    def read(node: Node, blocks: list[tuple], marked: bool = False, parent: int = 0):
        """Appends (text, is it constant, its block's parent)."""
        if node.dropped:
            return blocks
        marked = marked or node.tag in ("article", "main")
        header = node.tag == "header"
        if header and not marked:
            return blocks
        own = list(runs(node))
        linked = not (marked or node.plain) and node.links > 1
        for t, child in own:
            if child is not None:
                read(child, blocks, marked, id(node))
            elif not (linked or header and not decided or (id(node), t) in beside):
                blocks.append((t, (id(node), t) in constant, parent))
        return blocks

    def varying(blocks: list[tuple]) -> list[str]:
        """Texts without the constant ones, but for those between two varying blocks of one parent."""
        first: dict[int, int] = {}
        last: dict[int, int] = {}
        for i, (_, fixed, parent) in enumerate(blocks):
            if not fixed:
                first.setdefault(parent, i)
                last[parent] = i
        return [t for i, (t, fixed, parent) in enumerate(blocks) if not fixed or first.get(parent, i) < i < last.get(parent, i)]

    def narrowed(blocks: list[str], inner: list[str]):
        """The hint: ``inner`` if it holds at least half of the text of ``blocks``."""
        return inner if inner and 2 * sum(map(len, inner)) >= sum(map(len, blocks)) else blocks

    blocks = varying(read(root, []))
    if not decided:
        inner = []
        for x in regions(root, []):          # an article inside main is the narrower mark; several are read in page order
            own = varying(read(x, [], True))
            inner += narrowed(own, [t for y in regions(x, []) for t in varying(read(y, [], True))]) if x.tag == "main" else own
        blocks = narrowed(blocks, inner)
    return "\n".join(blocks)


# --------------------------------------------------------------------- Spark
def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def compact(slot: Slot):
    """What counting needs of a page: (label, digests and lengths of texts, children)."""
    return (slot.label, [(digest(t), len(t)) for t in slot.texts], [compact(c) for c in slot.children])


def restored(tree) -> Slot:
    s = Slot(tree[0])
    s.texts, s.children = tree[1], [restored(c) for c in tree[2]]
    return s


def bare(tree):
    return (tree[0], tuple(bare(c) for c in tree[2]))


def wrappers(pages: DataFrame, *, share: float = 0.5, least_pages: int = 3) -> DataFrame:
    """(host, tree, template, decided, aside): the wrapper of every host; ``pages`` has host, page_id and html.

    Only trees with text digests move between tasks, never the pages."""
    def shapes(batches):
        for b in batches:
            shape, tree, form, copy = [], [], [], []
            for page in b.column(1).to_pylist():
                c = compact(slots(parse(page or "")))
                shape.append(pickle.dumps(c, 5))
                tree.append(json.dumps(bare(c)))
                form.append(layout(bare(c)))
                copy.append(digest(repr(c)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shape, pa.binary()), pa.array(tree, pa.string()),
                                              pa.array(form, pa.int64()), pa.array(copy, pa.int64())],
                                             names=["host", "shape", "tree", "form", "copy"])

    shaped = stored(pages.select("host", "html").mapInArrow(shapes, "host string, shape binary, tree string, form long, copy long"), "shapes")

    trees = shaped.groupBy("host", "tree").agg(F.count("*").alias("n"))

    def walks(batches):
        for b in batches:
            host, path, n = [], [], []
            for h, t, k in zip(*(c.to_pylist() for c in b.columns)):
                for x in set(paths(json.loads(t))):
                    host.append(h)
                    path.append(str(x))
                    n.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(n, pa.int64())],
                                             names=["host", "path", "n"])

    often = (trees.mapInArrow(walks, "host string, path string, n long").groupBy("host", "path").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= least_pages))

    def merge(pruned):
        def run(batches):
            key, whole, keep = None, None, set()
            for b in batches:
                out = []
                for host, part, kind, value in zip(*(c.to_pylist() for c in b.columns)):
                    if key != (host, part):
                        if key is not None:
                            out.append((key[0], json.dumps(whole)))
                        key, whole, keep = (host, part), None, set()
                    if kind == 0:                            # paths come before trees
                        keep.add(int(value))
                        continue
                    tree = pruned_to(json.loads(value), keep) if pruned else tuples(json.loads(value))
                    whole = tree if whole is None else union(whole, tree)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in range(2)], names=["host", "tree"])
            if key is not None:
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (key[0], json.dumps(whole))], names=["host", "tree"])
        return run

    def merged(rows, pruned):
        return (rows.repartition("host", "part").sortWithinPartitions("host", "part", "kind", "value").select("host", "part", "kind", "value")
                .mapInArrow(merge(pruned), "host string, tree string"))

    parts = trees.select("host", F.pmod(F.xxhash64("tree"), F.lit(SHARES)).cast("int").alias("part"), F.lit(1).alias("kind"), F.col("tree").alias("value"))
    kept = (often.join(parts.select("host", "part").distinct(), "host").select("host", "part", F.lit(0).alias("kind"), F.col("path").alias("value")))
    shares = merged(parts.unionAll(kept), True)
    first = merged(shares.distinct().select("host", F.lit(0).alias("part"), F.lit(1).alias("kind"), F.col("tree").alias("value")), False)
    first = stored(first, "wrappers")

    def count(batches):
        for b in batches:
            host, form, slot, text, chars = [], [], [], [], []
            for h, f, shape, tree in zip(*(c.to_pylist() for c in b.columns)):
                own = restored(pickle.loads(shape))
                match(own, known(tree))
                here = {(number, d, k) for number, (d, k) in placed(own)} | {(number, None, 0) for number in matched(own)}
                for number, d, k in here | {(-1, None, 0)}:           # -1: the page itself; no text: it has the slot
                    host.append(h)
                    form.append(f)
                    slot.append(number)
                    text.append(d)
                    chars.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(form, pa.int64()), pa.array(slot, pa.int32()),
                                              pa.array(text, pa.int64()), pa.array(chars, pa.int64())], names=["host", "form", "slot", "text", "chars"])

    seen = (shaped.select("host", "form", "copy", "shape").dropDuplicates(["host", "form", "copy"])
            .join(first.withColumnRenamed("tree", "first_tree"), "host").select("host", "form", "shape", "first_tree")
            .mapInArrow(count, "host string, form long, slot int, text long, chars long").groupBy("host", "form", "slot", "text")
            .agg(F.count("*").alias("n"), F.max("chars").alias("chars")))
    seen = stored(seen, "slots")
    whole = seen.groupBy("host", "slot", "text").agg(F.sum("n").alias("n"), F.max("chars").alias("chars"))
    both = seen.select("host", "form", "slot", "text", "n").unionAll(whole.select("host", F.lit(None).cast("long"), "slot", "text", "n"))
    total = both.where("text is null").select("host", "form", "slot", F.col("n").alias("pages"))
    texts, t = both.where("text is not null and n >= " + str(int(least_pages))).alias("s"), total.alias("t")
    constant = (texts.join(t, (F.col("s.host") == F.col("t.host")) & (F.col("s.slot") == F.col("t.slot")) & F.col("s.form").eqNullSafe(F.col("t.form")))
                .where(F.col("n") >= share * F.col("pages"))
                .groupBy("s.host").agg(F.sort_array(F.collect_list(F.struct("s.form", "s.slot", "s.text"))).alias("template")))
    # at most 1 / share texts can be constant in a place of a layout, so the list is bounded by the sizes of a host's layouts
    decided = total.where("slot = -1 and form is null").select("host", (F.col("pages") >= least_pages).alias("decided"))
    # what varies in every slot, over all layouts
    pages_of = whole.where("text is null").select("host", "slot", F.col("n").alias("pages"))
    # texts of equal frequency are added up before they meet their slot's pages: a slot may hold any number of texts
    alike = (whole.where("text is not null").groupBy("host", "slot", "n")
             .agg(F.sum(F.col("n") * F.col("chars")).alias("chars"), F.max("chars").alias("longest")))
    varied = (alike.join(pages_of, ["host", "slot"]).where((F.col("n") < least_pages) | (F.col("n") < share * F.col("pages")))
              .groupBy("host", "slot").agg(F.sum("chars").alias("chars"), F.max("longest").alias("longest")))
    stats = (pages_of.join(varied, ["host", "slot"], "left").groupBy("host")
             .agg(F.collect_list(F.struct("slot", "pages", F.coalesce("chars", F.lit(0)).alias("chars"), F.coalesce("longest", F.lit(0)).alias("longest"))).alias("stats")))

    def judge(batches):                                      # one row per host, as long as its wrapper
        for b in batches:
            out = []
            for tree, stats in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                out.append(judged(known(tree), {x["slot"]: (x["pages"], x["chars"], x["longest"]) for x in stats if x["slot"] >= 0}, least_pages))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=["host", "aside"])

    aside = first.join(stats, "host").select("host", "tree", "stats").mapInArrow(judge, "host string, aside array<int>")
    return first.join(decided, "host").join(constant, "host", "left").join(aside, "host", "left")


def tuples(tree):
    return (tree[0], tuple(tuples(c) for c in tree[1]))


def paths(tree, above: str = ""):
    """A digest of the labels down to every element."""
    here = f"{above} {tree[0]}"
    yield digest(here)
    for c in tree[1]:
        yield from paths(c, here)


def pruned_to(tree, keep: set, above: str = ""):
    """The skeleton with the elements whose path is in ``keep``, and its root."""
    here = f"{above} {tree[0]}"
    return (tree[0], tuple(pruned_to(c, keep, here) for c in tree[1] if digest(f"{here} {c[0]}") in keep))


def matched(slot: Slot):
    """Numbers of the page's matched slots."""
    if slot.number >= 0:
        yield slot.number
    for c in slot.children:
        yield from matched(c)


@lru_cache(maxsize=2)
def by_layout(template: tuple) -> dict:
    """Layout (None: all) -> its constant (slot, digest) pairs."""
    out: dict = {}
    for form, slot, text in template:
        out.setdefault(form, set()).add((slot, text))
    return {form: frozenset(pairs) for form, pairs in out.items()}


@lru_cache(maxsize=200)
def known(tree: str):
    return numbered(tuples(json.loads(tree)))[0]


def html_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = 0.5,
              least_pages: int = 3) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars."""
    p = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                      F.col(html_col).cast("string").alias("html")).withColumn("host", host_of("url")))
    w = stored(wrappers(p.select("host", "page_id", "html"), share=share, least_pages=least_pages), "wrapper")     # its size is known when it is joined

    def squeeze(batches):
        import zstandard
        small = zstandard.ZstdCompressor(level=3)
        for b in batches:
            z = [small.compress((page or "").encode("utf-8", "surrogatepass")) for page in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(z, pa.binary()), b.column(3)],
                                             names=["page_id", "url", "z", "host"])

    def run(batches):
        import zstandard
        big = zstandard.ZstdDecompressor()
        for b in batches:
            texts = []
            for z, tree, template, decided, aside in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5, 6))):
                names = by_layout(tuple((x["form"], x["slot"], x["text"]) for x in template or ()))
                texts.append(extract(big.decompress(z).decode("utf-8", "surrogatepass"), known(tree) if tree else None, names, bool(decided),
                                     frozenset(aside or ())))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    squeezed = p.mapInArrow(squeeze, "page_id long, url string, z binary, host string")     # pages move compressed
    return (squeezed.join(w, "host", "left").select("page_id", "url", "z", "tree", "template", "decided", "aside")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
