"""Main text of web pages by wrapper induction over the pages of a host."""

import hashlib
import html
import json
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import per_worker, stored
from postlens.session import small_batches

# All pages of a scope are aligned. Those with one longest text count as one page, or as many as make this number where a scope has fewer such texts.
ARTICLES = 8
# A text is template if it stands in the same place in this share of the different articles, and in so many at least.
CONSTANT_SHARE = 0.75
CONSTANT_PAGES = 3
# The content slot of a host without an article element: the deepest place with this share of varying text.
SLOT_SHARE = 0.7
# Up to this size what is known of the scopes is sent to all tasks, beyond it is joined by a shuffle.
BROADCAST_BYTES = 16 << 20
# What an alignment and a worker keep at a time: cells of a table, bytes of the packed pages that others are aligned with.
KEPT_CELLS = 1 << 20
KEPT_BYTES = 1 << 20
# Rows of a table that are longer are worked out by numpy.
SHORT_ROW = 64

# Fixed values of the HTML language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPE = set("table ul ol dl div article section main body html td th aside nav header footer form select".split())
# Elements and roles that mark what is not the article, and words that mark a block if a class or its id is made of them alone.
CHROME = set(
    "nav aside footer header form script style noscript template iframe svg button select textarea head title menu "
    "dialog object canvas noembed noframes".split()
)
CHROME_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
CHROME_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe signup login social share sharing related recommended "
    "sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead footer "
    "comment comments commentlist reply replies respond disqus widget widgets toolbar skip".split()
)
MAIN = {"article", "main"}
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
# A word marks blocks only, no headings, links or other parts of a line.
WORDED = BLOCK - HEADINGS
# Blocks of an article, never the whole of it.
ONE_BLOCK = HEADINGS | set("p li ul ol dl dt dd td blockquote pre figure figcaption".split())

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
# Java's form: tag and class of the elements that make a layout.
LAYOUT_TAG = r"""(?i)<(?:article|aside|div|footer|form|header|main|nav|section|table)\b(?:[^>]*?\sclass\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+))?"""
# Names of the attributes that matter.
NAMED = re.compile("class|id|role", re.I)
# Java's form: where start tags begin, and texts, as group 1; scripts, styles and comments without it.
ITEM = r"(?is)<(?:script\b.*?(?:</script|\z)|style\b.*?(?:</style|\z)|!--.*?(?:-->|\z))|(<[a-z]|(?<=>)[^<]++(?=<))"
WORD_ENDS = re.compile(r"[-_0-9]+")


def only_chrome_words(name: str) -> bool:
    words = [w for w in WORD_ENDS.split(name) if w]
    return bool(words) and CHROME_WORDS.issuperset(words)


class Node:
    """An element: tag, the label that alignment compares, whether it is chrome, and that by a word only, texts and elements in order.

    inner holds the elements alone; shape and size are of these, see outline().
    """

    __slots__ = ("tag", "label", "chrome", "worded", "role", "parts", "inner", "shape", "size")

    def __init__(self, tag, attributes=""):
        self.tag = self.label = tag
        self.parts, self.inner, self.role = [], [], None
        self.chrome, self.worded = tag in CHROME, False
        if "=" in attributes and NAMED.search(attributes):
            self.name(attributes)

    def name(self, attributes):
        names = {}
        for name, *values in ATTRIBUTE.findall(attributes):
            names.setdefault(name.lower(), "".join(values).lower())
        if names.get("class"):
            self.label = f"{self.tag}.{names['class']}".replace("/", "|")
        self.role = names.get("role")
        self.chrome = self.chrome or self.role in CHROME_ROLES
        self.worded = not self.chrome and self.tag in WORDED and any(
            map(only_chrome_words, f"{names.get('class', '')} {names.get('id', '')}".split())
        )
        self.chrome = self.chrome or self.worded

    def add(self, node):
        self.parts.append(node)
        self.inner.append(node)

    def children(self):
        return self.inner

    def text(self):
        """The element's own text, without that of its elements."""
        return one_spaced(" ".join([p for p in self.parts if isinstance(p, str)]))


def one_spaced(text: str) -> str:
    """References decoded, white space turned into one space, ends trimmed."""
    return " ".join(html.unescape(text).split())


def parsed(page: str) -> Node:
    """The tree of a page; end tags that are missing or too many are mended."""
    root = Node("html")
    stack, place, size = [root], 0, len(page)
    while place < size:
        match = TAG.search(page, place)
        if match is None:
            stack[-1].parts.append(page[place:])
            break
        start, end = match.span()
        if start > place:
            stack[-1].parts.append(page[place:start])
        ends, tag, attributes = match.groups()
        place = end
        if tag is None:
            continue
        tag = tag.lower()
        if ends:
            close(stack, tag)
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCK:
            close(stack, "p", SCOPE)
        for other in CLOSED_BY.get(tag, ()):
            close(stack, other, {"table", "ul", "ol", "dl", "select"})
        node = Node(tag, attributes)
        stack[-1].add(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}", re.I).search(page, place)
            place = end.start() if end else size
        if tag not in VOID and not attributes.endswith("/>"):
            stack.append(node)
    return root


def close(stack, tag, within=()):
    """Take the innermost element of this tag and all inside it off the stack, unless one of within is in between."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag == tag:
            del stack[depth:]
            return
        if stack[depth].tag in within:
            return


def walk(root: Node, prune=None):
    """All elements in page order as (element, path); those that prune() names are left out with all inside."""
    stack = [(root, root.label)]
    while stack:
        node, path = stack.pop()
        if prune and prune(node):
            continue
        yield node, path
        stack += [(child, f"{path}/{child.label}") for child in reversed(node.inner)]


def mend(tops: list[tuple[list, str]], constant) -> None:
    """Take the mark off elements that a word makes chrome and that hold most of the varying text of tops."""
    nodes, sizes, total = [], {}, 0
    for parts, path in tops:
        total += sum(len(p.strip()) for p in parts if isinstance(p, str))
        for top in parts:
            if isinstance(top, Node):
                nodes += [(n, f"{path}/{p}") for n, p in walk(top, lambda n: n.chrome and not n.worded)]
    if not any(n.worded for n, _ in nodes):
        return
    for node, path in reversed(nodes):
        text = node.text()
        own = 0 if f"{path}\n{text}" in constant else len(text)
        total += own
        sizes[id(node)] = own + sum(sizes.get(id(child), 0) for child in node.children())
    for node, _ in nodes:
        if node.worded and 2 * sizes[id(node)] > total:
            node.chrome = node.worded = False


def elements(root: Node):
    """All elements in page order."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += reversed(node.inner)


def outline(root: Node, shapes: dict) -> None:
    """Set size and shape: elements have one shape if labels and nesting are the same throughout. shapes: gets the numbers of shapes."""
    for node in reversed(list(elements(root))):
        node.size = 1 + sum([n.size for n in node.inner])
        node.shape = shapes.setdefault((node.label, *[n.shape for n in node.inner]), len(shapes))


def aligned(one: Node, other: Node):
    """Simple tree matching: pairs of elements of the largest common part, order and ancestors kept."""
    shapes = {}
    outline(one, shapes)
    outline(other, shapes)
    return matched(one, other)


def matched(one: Node, other: Node):
    """The pairs of aligned(), for elements that are outlined."""
    # By shapes; elements of one shape match as a whole.
    weights = {}

    def alike(xs, ys):
        """How many first elements have the same shapes. They match one another in a largest common part."""
        n = 0
        for x, y in zip(xs, ys):
            if x.shape != y.shape:
                break
            n += 1
        return n

    def rows_of(xs, ys):
        """next(row, x): the row of the table after x was added."""
        kept = {}

        def gains(x):
            if x.shape not in kept:
                if len(kept) * len(ys) > KEPT_CELLS:
                    kept.clear()
                found = [0 if x.label != y.label else x.size if x.shape == y.shape else weights[x.shape, y.shape] for y in ys]
                kept[x.shape] = found if len(ys) <= SHORT_ROW else np.array(found)
            return kept[x.shape]

        def short(before, x):
            row = [0]
            for k, gain in enumerate(gains(x)):
                row.append(max(before[k + 1], row[k], before[k] + gain))
            return row

        def long(before, x):
            row = np.zeros_like(before)
            np.maximum.accumulate(np.maximum(before[1:], before[:-1] + gains(x)), out=row[1:])
            return row

        return ([0] * (len(ys) + 1), short) if len(ys) <= SHORT_ROW else (np.zeros(len(ys) + 1, dtype=np.int64), long)

    def weigh(a, b):
        todo = [(a, b)]
        while todo:
            a, b = todo[-1]
            xs, ys = a.inner, b.inner
            n = alike(xs, ys)
            total, xs, ys = 1 + sum([x.size for x in xs[:n]]), xs[n:], ys[n:]
            if xs and ys:
                firsts, seconds = {x.shape: x for x in xs}.values(), {y.shape: y for y in ys}.values()
                missing = [(x, y) for x in firsts for y in seconds if x.label == y.label and x.shape != y.shape and (x.shape, y.shape) not in weights]
                if missing:
                    todo += missing
                    continue
                row, after = rows_of(xs, ys)
                for x in xs:
                    row = after(row, x)
                total += int(row[-1])
            weights[a.shape, b.shape] = total
            todo.pop()

    def chosen(xs, ys):
        """Pairs of a table's best way. Of a large table only some rows are kept, those between are worked out again."""
        step = len(xs) if len(xs) * len(ys) <= KEPT_CELLS else math.isqrt(len(xs)) + 1
        row, after = rows_of(xs, ys)
        marks = [row]
        for i in range((len(xs) - 1) // step * step):
            row = after(row, xs[i])
            if (i + 1) % step == 0:
                marks.append(row)
        k, pairs = len(ys), []
        for block in reversed(range(0, len(xs), step)):
            rows, i = [marks[block // step]], min(step, len(xs) - block)
            for x in xs[block : block + i]:
                rows.append(after(rows[-1], x))
            while i and k:
                if rows[i][k] == rows[i - 1][k]:
                    i -= 1
                elif rows[i][k] == rows[i][k - 1]:
                    k -= 1
                else:
                    i, k = i - 1, k - 1
                    pairs.append((xs[block + i], ys[k]))
        return pairs

    pairs, stack = [], []
    if one.label == other.label:
        weigh(one, other)
        stack.append((one, other))
    while stack:
        a, b = stack.pop()
        pairs.append((a, b))
        xs, ys = a.inner, b.inner
        n = alike(xs, ys)
        stack += zip(xs[:n], ys[:n])
        if len(xs) > n < len(ys):
            stack += chosen(xs[n:], ys[n:])
    return pairs


def packed(page: str) -> bytes:
    """Labels, depths and hashed own texts (0: none) of a page's elements in page order: what alignment needs of the page."""
    labels, depths, texts, stack = [], [], [], [(parsed(page), 0)]
    while stack:
        node, depth = stack.pop()
        labels.append(node.label)
        depths.append(depth)
        texts.append(text_hash(node))
        stack += [(child, depth + 1) for child in reversed(node.children())]
    return zlib.compress(json.dumps([labels, depths, texts]).encode())


class Middle:
    """The packed() page that the other pages of a host are aligned with; its elements are numbered in page order."""

    def __init__(self, page: bytes):
        labels, depths, self.texts = json.loads(zlib.decompress(page))
        self.numbers, self.shapes, path = {}, {}, []
        for number, (label, depth) in enumerate(zip(labels, depths)):
            node = Node("")
            node.label = label
            del path[depth:]
            if path:
                path[-1].add(node)
            path.append(node)
            self.numbers[id(node)] = number
        self.root = path[0]
        outline(self.root, self.shapes)

    def same(self, tree: Node) -> list[int]:
        """Numbers of the elements that have the same own text on tree."""
        outline(tree, dict(self.shapes))
        places = [(self.numbers[id(a)], b) for a, b in matched(self.root, tree)]
        return sorted([k for k, b in places if self.texts[k] == text_hash(b)])


def wrapper_of(page: str, same, total) -> tuple[list[str], str]:
    """(template texts as path and text, path of the content slot) of a host by its middle page.

    same: on how many of the total of other pages each element, by number, has the same own text. Elements with the same on enough
    pages are template; the rest are slots, and the content slot is the deepest place that holds most of the slots' text outside links.
    """
    root = parsed(page)
    numbers = {id(node): k for k, node in enumerate(elements(root))}
    # Counts may be sums of fractions.
    least = max(CONSTANT_PAGES - 1, CONSTANT_SHARE * total) - 1e-9 * total
    fixed = {key for key, k in numbers.items() if same.get(k, 0) >= least}
    constant, sizes = [], Counter()
    for node, path in walk(root, lambda n: n.chrome and not n.worded):
        text = node.text()
        if text and id(node) in fixed:
            constant.append(f"{path}\n{text}")
    constant = sorted(set(constant))
    mend([(root.parts, root.label)], set(constant))
    for node, path in walk(root, lambda n: n.chrome):
        text = node.text()
        if text and id(node) not in fixed and node.tag != "a":
            parts = path.split("/")
            for depth in range(1, len(parts) + 1):
                sizes["/".join(parts[:depth])] += len(text)
    total = sizes["html"]
    holding = [path for path, size in sizes.items() if size >= SLOT_SHARE * total and path.split("/")[-1].split(".")[0] in BLOCK]
    slot = max(holding, key=lambda path: (path.count("/"), path)) if total else "html"
    # A slot that is one block would be one block of many pages' text: take what stands around it.
    while slot.split("/")[-1].split(".")[0] in ONE_BLOCK:
        slot = slot.rpartition("/")[0]
    return constant, slot


def induced(pages: list[str]) -> tuple[list[str], str]:
    """(template texts as path and text, path of the content slot) of some pages of one host.

    The page of the middle size is aligned with all others.
    """
    sizes = [sum(1 for _ in elements(parsed(page))) for page in pages]
    order = sorted(range(len(pages)), key=lambda k: sizes[k])
    first = order[len(pages) // 2]
    middle, same = Middle(packed(pages[first])), Counter()
    for k in order:
        if k != first:
            same.update(middle.same(parsed(pages[k])))
    return wrapper_of(pages[first], same, len(pages) - 1)


def containers(root: Node, slot: str, constant=frozenset()) -> list[tuple[list, str]]:
    """(parts, path of their parent) of the article, in page order: all outermost article and main elements, else the host's content slot.

    Elements in chrome count only where there are no others. Where several elements stand on the slot's path, what lies
    between them and headings right before the first belong to the article too. Without either it is the whole page.
    """

    def outermost(prune):
        found, inside = [], set()
        for node, path in walk(root, prune):
            if id(node) not in inside and (node.tag in MAIN or node.role == "main" and not node.chrome):
                found.append((node.parts, path))
                inside.update(id(n) for n, _ in walk(node))
        return [run for run in found if any(isinstance(p, Node) or p.strip() for p in run[0])]

    found = outermost(lambda n: n.chrome and n.tag not in MAIN) or outermost(None)
    mend(found or [(root.parts, root.label)], constant)
    if found or slot == root.label:
        return found or [(root.parts, root.label)]
    above = slot.rpartition("/")[0]
    for node, path in walk(root, lambda n: n.chrome):
        if path == above:
            places = [k for k, p in enumerate(node.parts) if isinstance(p, Node) and not p.chrome and f"{path}/{p.label}" == slot]
            if places:
                start = places[0]
                while start and (p := node.parts[start - 1]) and (p.tag in HEADINGS if isinstance(p, Node) else not p.strip()):
                    start -= 1
                found.append((node.parts[start : places[-1] + 1], path))
    return found or [(root.parts, root.label)]


def main_text(page: str | None, constant: set[str] = frozenset(), slot: str = "html") -> str:
    """Blocks of the article in page order, one line each; empty for null, empty and pages without text."""
    return text_of(parsed(page), constant, slot) if page else ""


def text_of(root: Node, constant: set[str], slot: str) -> str:
    """main_text() of a page's tree, whose marks it may change."""
    blocks, current = [], []

    def flush():
        text = one_spaced("".join(current))
        current.clear()
        if text:
            blocks.append(text)

    # Parts still to come, innermost last; None ends a block.
    runs = containers(root, slot, constant)
    stack = [(part, path) for parts, path in reversed(runs) for part in (None, *reversed(parts))]
    while stack:
        part, path = stack.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            current.append(part)
        elif part.tag == "br":
            current.append(" ")
        elif not part.chrome or part.tag == "header" and any(n.tag == "h1" for n, _ in walk(part)):
            own = f"{path}/{part.label}"
            if constant and f"{own}\n{part.text()}" in constant:
                stack += [(child, own) for child in reversed(part.children())]
                continue
            if part.tag in BLOCK:
                flush()
                stack.append((None, own))
            stack += [(inner, own) for inner in reversed(part.parts)]
    flush()
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty for null and for what has none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", 1), F.lit(""))


class Hashed:
    """A set of template texts that holds their hashes."""

    def __init__(self, hashes):
        self.hashes = frozenset(hashes)

    def __contains__(self, text):
        return hashed(text) in self.hashes

    def __len__(self):
        return len(self.hashes)


def hashed(text: str) -> int:
    """A 64-bit hash, never 0."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) or 1


def text_hash(node: Node) -> int:
    """The hash of an element's own text, 0 for none."""
    return hashed(text) if (text := node.text()) else 0


def place_hashes(page: str | None, slot: str) -> tuple[int | None, list[int]]:
    """(hash of the article's text, hashes of path and own text of all elements that could be template) of a page."""
    if not page:
        return None, []
    root = parsed(page)
    found = {hashed(f"{path}\n{text}") for node, path in walk(root, lambda n: n.chrome and not n.worded) if (text := node.text())}
    return hashed(text_of(root, frozenset(), slot)), sorted(found)


def layout_of(page: Column) -> Column:
    """A hash of the different block elements with their classes."""
    tags = F.transform(F.regexp_extract_all(page, F.lit(LAYOUT_TAG), F.lit(0)), F.lower)
    return F.xxhash64(F.array_sort(F.array_distinct(tags)))


def middles(pages: DataFrame) -> DataFrame:
    """scope, m_h, m_id, m_long, level: the page of the middle size of every scope of pages (scope, h, page_id, long, size), and as how many
    pages those with one longest text count. Scopes of fewer than CONSTANT_PAGES pages have none.

    Pages are counted by size and by longest text before the counts of a scope meet.
    """
    sizes = pages.groupBy("scope", "size").agg(F.count("*").alias("n"), F.min(F.struct("h", "page_id", "long")).alias("page"))
    scope = Window.partitionBy("scope")
    sizes = sizes.withColumns({"upto": F.sum("n").over(scope.orderBy("size")), "pages": F.sum("n").over(scope)})
    found = sizes.where(f"pages >= {CONSTANT_PAGES} and upto > pages div 2 and upto - n <= pages div 2")
    found = found.select("scope", F.col("page.h").alias("m_h"), F.col("page.page_id").alias("m_id"), F.col("page.long").alias("m_long"))
    texts = pages.groupBy("scope", "long").agg(F.count("*").alias("n")).groupBy("scope")
    texts = texts.agg(F.array(*(F.sum(F.least("n", F.lit(k))) for k in range(1, ARTICLES))).alias("sums"))
    level = F.size(F.filter("sums", lambda pages: pages < ARTICLES)) + 1
    return found.join(texts.select("scope", level.alias("level")), "scope")


def slots(rows: DataFrame) -> DataFrame:
    """scope, slot: from all different pages of every scope of rows (page_id, html, layout_scope, host_scope); copies count once.

    Every page is aligned with the page of the middle size of its layout and with that of its host. Pages with the same longest text
    count as one together, or as so many as make ARTICLES, so one article under many menus is no template. Numbers of the elements
    with the same text are sent, and their counts summed before. Scopes of fewer than CONSTANT_PAGES pages have none.
    """
    keys = ["layout_scope", "host_scope", "h"]
    pages = rows.where("html <> ''").withColumn("h", F.xxhash64("html"))
    texts = F.transform(F.filter("items", lambda i: ~i.startswith("<")), lambda i: F.struct(F.length(i), i))
    long, size = F.xxhash64(F.array_max(texts)), F.size(F.filter("items", lambda i: i.startswith("<")))
    narrow = pages.withColumn("items", F.regexp_extract_all("html", F.lit(ITEM), F.lit(1)))
    narrow = narrow.select(*keys, "page_id", long.alias("long"), size.alias("size")).groupBy(*keys)
    narrow = narrow.agg(F.min("page_id").alias("page_id"), F.first("long").alias("long"), F.first("size").alias("size"))
    narrow = stored(narrow, "page-sizes")

    scopes = F.explode(F.array("layout_scope", "host_scope")).alias("scope")
    each = narrow.select(scopes, "h", "page_id", "long", "size")
    chosen = small(stored(middles(each), "middle-pages"), F.lit(50))
    one = F.col("h").eqNullSafe(F.col("m_h")) & F.col("page_id").eqNullSafe(F.col("m_id"))
    htmls = pages.join(chosen.select("m_h", "m_id"), one, "left_semi").select(scopes.alias("s"), "page_id", "h", "html")
    htmls = htmls.join(chosen, (F.col("s") == F.col("scope")) & one).dropDuplicates(["scope"])

    @F.pandas_udf("binary")
    def pack(htmls: pd.Series) -> pd.Series:
        return pd.Series([packed(page) for page in htmls], dtype=object)

    middle = stored(htmls.select("scope", "m_h", "m_long", "level", "html", pack("html").alias("middle")), "middles")

    @F.pandas_udf("layout array<int>, host array<int>")
    def align(htmls: pd.Series, layouts: pd.Series, hosts: pd.Series) -> pd.DataFrame:
        found = []
        for page, *own in zip(htmls, layouts, hosts):
            tree = parsed(page)
            found.append([None if m is None else kept_middle(m).same(tree) for m in own])
        return pd.DataFrame(found, columns=["layout", "host"])

    # A host of one layout has that layout's middle page.
    sent = small(middle.select("scope", "middle"), F.length("middle") + 50)
    same = with_scopes(pages.select(*keys, "html"), sent, ["middle"]).where("host_middle is not null")
    other = F.when(~F.col("host_middle").eqNullSafe(F.col("middle")), F.col("host_middle"))
    same = same.select(*keys, align("html", "middle", other).alias("same")).groupBy(*keys)
    same = same.agg(F.first("same.layout").alias("layout"), F.first("same.host").alias("host")).join(narrow, keys)
    own = F.struct(F.col("layout_scope").alias("scope"), F.col("layout").alias("same"))
    all_ = F.struct(F.col("host_scope").alias("scope"), F.coalesce("host", "layout").alias("same"))
    same = same.select("h", "long", F.inline(F.array(own, all_))).where("same is not null")

    known = small(middle.select("scope", "m_h", "m_long", "level"), F.lit(50))
    again = each.groupBy("scope", "long").agg(F.count("*").alias("n")).where("n > 1")
    same = same.join(known, "scope").where("h <> m_h").join(small(stored(again, "repeated-texts"), F.lit(30)), ["scope", "long"], "left")
    n, less = F.coalesce("n", F.lit(1)), (F.col("long") == F.col("m_long")).cast("int")
    weight = (F.least(n, "level") - less) / (n - less)
    counts = same.select("scope", weight.alias("weight"), F.explode(F.concat(F.array(F.lit(-1)), "same")).alias("place"))
    counts = counts.groupBy("scope", "place").agg(F.sum("weight").alias("weight"))
    counts = counts.groupBy("scope").agg(F.collect_list("place").alias("places"), F.collect_list("weight").alias("weights"))

    @F.pandas_udf("string")
    def induce(htmls: pd.Series, places: pd.Series, weights: pd.Series) -> pd.Series:
        counts = (dict(zip(*lists)) for lists in zip(places, weights))
        return pd.Series([wrapper_of(page, count, count[-1])[1] for page, count in zip(htmls, counts)])

    found = counts.join(middle.select("scope", "html"), "scope")
    return found.select("scope", induce("html", "places", "weights").alias("slot"))


def kept_middle(page: bytes) -> Middle:
    """The middle page, unpacked; those met last are kept, in bounded memory."""
    kept = per_worker("middles", dict)
    if page not in kept:
        if sum(map(len, kept)) + len(page) > KEPT_BYTES:
            kept.clear()
        kept[page] = Middle(page)
    return kept[page]


def small(df: DataFrame, size: Column) -> DataFrame:
    """df, which is stored, to be sent to all tasks if it is small."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def with_scopes(rows: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """rows with the columns of table for their layout and, prefixed with host_, for their host."""
    own = table.select(F.col("scope").alias("layout_scope"), *columns)
    host = table.select(F.col("scope").alias("host_scope"), *(F.col(c).alias(f"host_{c}") for c in columns))
    return rows.join(own, "layout_scope", "left").join(host, "host_scope", "left")


def templates(rows: DataFrame, learnt: DataFrame) -> DataFrame:
    """scope, constant (hashes of template texts) from all pages of a layout and of a host.

    A text counts once for every different article that it stands with. Counts are summed before they are sent.
    """

    @F.pandas_udf("article bigint, places array<bigint>")
    def places(htmls: pd.Series, own: pd.Series) -> pd.DataFrame:
        found = [place_hashes(page, slot or "html") for page, slot in zip(htmls, own)]
        return pd.DataFrame(
            {"article": pd.array([f[0] for f in found], dtype="Int64"), "places": [f[1] for f in found]}
        )

    counted = with_scopes(rows.where("html <> ''"), learnt, ["slot"])
    counted = counted.select("layout_scope", "host_scope", places("html", F.coalesce("slot", "host_slot")).alias("p"))
    # Place 0 stands for the article itself.
    counted = counted.select("layout_scope", "host_scope", "p.article", F.explode(F.concat(F.array(F.lit(0)), "p.places")).alias("place"))
    found = counted.groupBy("layout_scope", "host_scope", "place", "article").agg(F.lit(1).alias("one"))
    scopes = F.explode(F.array("layout_scope", "host_scope")).alias("scope")
    found = found.select(scopes, "place", "article").distinct().groupBy("scope", "place").agg(F.count("*").alias("n"))
    found = stored(found.where(F.col("n") >= CONSTANT_PAGES), "place-counts")
    all_ = found.where("place = 0").select("scope", F.col("n").alias("articles"))
    constant = found.where("place <> 0").join(all_, "scope").where(F.col("n") >= CONSTANT_SHARE * F.col("articles"))
    return constant.groupBy("scope").agg(F.array_sort(F.collect_list("place")).alias("constant"))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every row of pages.

    Null and empty html give the empty text, a null url is a host of its own, and rows are all kept, repeated ones too;
    other columns are left out. A layout of a host with few pages takes the host's slot. Slots and templates are sent to all tasks
    if they are small, else joined, where adaptive planning splits a large host.
    """
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    rows = rows.withColumns({"host_scope": F.xxhash64("host"), "layout_scope": F.xxhash64("host", layout_of(F.col("html")))})
    learnt = stored(slots(rows), "slots")
    learnt = small(learnt, F.length("slot") + 50)
    constants = small(stored(templates(rows, learnt), "templates"), 8 * F.size("constant") + 50)
    joined = with_scopes(with_scopes(rows, learnt, ["slot"]), constants, ["constant"])

    @F.pandas_udf("string")
    def extract(htmls: pd.Series, constants: pd.Series, slots: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, Hashed(c), slot or "html") for page, c, slot in zip(htmls, constants, slots)])

    none = F.array().cast("array<bigint>")
    constant = F.concat(F.coalesce("constant", none), F.coalesce("host_constant", none))
    return joined.select("page_id", "url", extract("html", constant, F.coalesce("slot", "host_slot")).alias("text"))
