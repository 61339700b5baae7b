"""Main text of web pages by tag-path ratios.

Text nodes of a page are grouped by their path of tags from the root.  Each
path has a ratio of text to nodes and one of punctuation to text; both are
smoothed over the page, fused, and cut at a threshold: that selects blocks.
Every article element that holds a selected block comes whole; on other pages
come the selected blocks and what lies between and right beside them, in page
order.  Some tags and roles are boilerplate; names (classes and ids) lower the
scores of what stands under them, and those of comments and the like tell
boilerplate wherever the page has other text.

A page is read in one pass.  Elements are numbers in page order with the number
of their parent, so a block needs no list of its ancestors.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content that is not shown as text, up to the closing tag.
RAW = frozenset("script style noscript template iframe textarea title select annotation annotation-xml desc".split())
#: Elements that hold no article text.
NOISE = frozenset("head nav header footer aside button menu dialog label fieldset".split())
#: Elements that make a form one to fill in.
CONTROLS = frozenset("input select textarea button".split())
#: Elements of formulas and drawings.
FOREIGN = frozenset(
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics "
    "svg circle clippath defs ellipse g line lineargradient marker mask path pattern polygon polyline radialgradient rect stop "
    "symbol text textpath tspan use".split()
)
#: Elements whose text goes on in the line around them.
INLINE = FOREIGN | frozenset(
    "a abbr acronym b bdi bdo big br canvas cite code data del dfn em font i img ins kbd mark object param q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: A new element of these ends an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: An open element on the left ends where one of the right begins.
ENDS_ITEM = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
NOISE_NAME = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|side|aside|widget|ads?|advert\w*|banner|promo\w*|"
    r"sponsor\w*|cookies?|consent|notices?|gdpr|alert|popup|modal|overlay|newsletter|subscribe|signup|login|comments?|feedback|"
    r"commentlist|replies|reply|respond|disqus|discussion|related|recommend\w*|share|sharing|social|breadcrumbs?|pagination|pager|"
    r"tags|toolbar|search|form|copyright|skip|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Names of boilerplate that an article's own parts have as well.
AMBIGUOUS = re.compile(
    r"nav|navigation|menu|header|side|aside|notices?|alert|modal|overlay|replies|reply|discussion|related|recommend\w*|tags|"
    r"search|form|copyright|skip|hidden",
    re.IGNORECASE,
)
#: Names that tell boilerplate even as the id of a section.
OF_SECTIONS = re.compile(r"ads?|advert\w*|sidebar|newsletter|comments?|commentlist|disqus|respond", re.IGNORECASE)
#: Names of what readers say, which may be longer than what it is about.
OF_READERS = re.compile(r"comments?|feedback|commentlist|replies|reply|respond|disqus", re.IGNORECASE)
#: Names of links to other pages, for a class.
OF_OTHERS = re.compile(r"related|recommend\w*", re.IGNORECASE)
#: Words that go with a name of boilerplate and do not change what it says.
NEUTRAL = frozenset(
    "all area bar block bottom box buttons col column container frame group holder icons inner item items left links list outer panel "
    "placeholder primary reader readers right row secondary section site slot small title top unit user users visitor visitors wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: With one of these an ambiguous name is certain.
TEASERS = frozenset("posts articles stories".split())
#: What a name does: some word of it, a name of nothing else, and one that an article's own parts don't have.
HINT, NAMED, CERTAIN, SAID, BOILERPLATE = 1, 2, 3, 4, 5
LOWERED = {HINT: 0.5, NAMED: 0.1, CERTAIN: 0.02, SAID: 0.02}
#: Elements of a line that are open at once; browsers stop at a like depth.
MOST_OPEN = 512
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    """A block of text: its element, its path of tags (a number), its text, the characters of it in links, whether it
    is in boilerplate, and the innermost element around it with a name of boilerplate (0 if none)."""

    element: int
    path: int
    text: str
    links: int
    noise: bool
    named: int = 0


class Tree:
    """The elements of a page by number, in page order; 0 stands around all."""

    def __init__(self):
        self.parent, self.tag, self.kind = [0], [""], [0]
        self.path, self.noise, self.named, self.block = [0], [False], [0], [0]
        self.controls: set[int] = set()  # forms to fill in
        self._paths: dict[tuple[int, str], int] = {}
        self._last: list[int] = []

    def add(self, parent: int, tag: str, kind: int) -> int:
        number, inline = len(self.parent), tag in INLINE
        self.parent.append(parent)
        self.tag.append(tag)
        self.kind.append(kind)
        self.path.append(self.path[parent] if inline else self._paths.setdefault((self.path[parent], tag), len(self._paths) + 1))
        self.noise.append(self.noise[parent] or kind == BOILERPLATE)
        self.named.append(number if 0 < kind < BOILERPLATE else self.named[parent])
        self.block.append(self.block[parent] if inline else number)
        return number

    def sums(self, values: dict[int, float]) -> list[float]:
        """What each element holds, itself and all below it."""
        held = [0.0] * len(self.parent)
        for element, value in values.items():
            held[element] = value
        for element in range(len(held) - 1, 0, -1):
            held[self.parent[element]] += held[element]
        return held

    def holds(self, element: int, other: int) -> bool:
        """Whether ``other`` is ``element`` or stands in it."""
        if not self._last:
            self._last = list(range(len(self.parent)))
            for number in range(len(self.parent) - 1, 0, -1):
                self._last[self.parent[number]] = max(self._last[self.parent[number]], self._last[number])
        return element <= other <= self._last[element]

    def inherited(self, own) -> list[int]:
        """For each element the outermost one around it, itself included, for which ``own`` is true; 0 if none."""
        found = [0] * len(self.parent)
        for element in range(1, len(found)):
            found[element] = found[self.parent[element]] or (element if own(element) else 0)
        return found

    def around(self, element: int) -> Iterator[int]:
        while element:
            yield element
            element = self.parent[element]


def _name_kind(value: str, of_section: bool, of_class: bool = False) -> int:
    """What the words of a class or id tell; the id of a section is its topic unless it is one of a few."""
    kind = 0
    for token in value.split():
        words = [w for w in re.split(r"[_-]+", token) if w and not w.isdigit()]
        noisy = [w for w in words if NOISE_NAME.search(w)]
        if not noisy:
            continue
        if of_section:
            noisy = [w for w in noisy if OF_SECTIONS.fullmatch(w)]
            if not noisy:
                continue
        others = {w.lower() for w in words if w not in noisy}
        if not others <= NEUTRAL | TEASERS:
            kind = max(kind, 0 if of_section else HINT)
        else:
            open_to_parts = all(AMBIGUOUS.fullmatch(w) for w in noisy) and not others & TEASERS
            if any(OF_READERS.fullmatch(w) for w in noisy):
                kind = max(kind, SAID)
            elif open_to_parts and not (of_class and all(OF_OTHERS.fullmatch(w) for w in noisy)):
                kind = max(kind, NAMED)
            else:
                kind = max(kind, CERTAIN)
    return kind


def _kind(name: str, attributes: str) -> int:
    """``BOILERPLATE`` by tag, role or style, or what the names of an element tell."""
    if name in NOISE:
        return BOILERPLATE
    if not attributes or name in ("html", "body", "article", "main"):
        return 0
    kind = 0
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), html.unescape(value.strip("\"'"))
        if key in ("class", "id") and name not in HEADINGS and NOISE_NAME.search(value):
            kind = max(kind, _name_kind(value, key == "id" and name == "section", key == "class"))
        if key == "role" and value.lower() in NOISE_ROLE:
            return BOILERPLATE
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return BOILERPLATE
        if key == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return BOILERPLATE
    return kind


def blocks(page: str) -> tuple[list[Node], Tree]:
    """Blocks of text in page order, and the elements.  Markup that is not closed, or closed twice, is taken as browsers take it."""
    found: list[Node] = []
    tree = Tree()
    stack: list[tuple[str, int]] = []  # open elements: name and number
    opened: dict[str, int] = {}  # how often each name is open
    pending: list[str] = []
    state = {"links": 0, "inline": 0}

    def top() -> int:
        return stack[-1][1] if stack else 0

    def flush() -> None:
        text = SPACE.sub(" ", html.unescape("".join(pending))).strip()
        if text:
            at = top()
            found.append(Node(tree.block[at], tree.path[at], text, min(state["links"], len(text)), tree.noise[at], tree.named[at]))
        pending.clear()
        state["links"] = 0

    def push(name: str, attributes: str) -> None:
        if name in INLINE:
            if state["inline"] >= MOST_OPEN:
                return
            state["inline"] += 1
        if name in CONTROLS and opened.get("form"):
            tree.controls.add(next(n for tag, n in reversed(stack) if tag == "form"))
        stack.append((name, tree.add(top(), name, _kind(name, attributes))))
        opened[name] = opened.get(name, 0) + 1

    def pop_to(place: int) -> None:
        if any(e[0] not in INLINE for e in stack[place:]):
            flush()
        for name, _ in stack[place:]:
            opened[name] -= 1
            state["inline"] -= name in INLINE
        del stack[place:]

    def open_place(names, stop=("table", "ul", "ol", "dl", "div", "section", "article", "body", "button", "td", "th")) -> int | None:
        if not any(opened.get(name) for name in names):
            return None
        for place in range(len(stack) - 1, -1, -1):
            if stack[place][0] in names:
                return place
            if stack[place][0] in stop:
                return None
        return None

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            pending.append(page[at:])
            break
        match = TOKEN.match(page, tag)
        if match is None:
            pending.append(page[at : tag + 1])
            at = tag + 1
            continue
        if tag > at:
            text = page[at:tag]
            pending.append(text)
            if opened.get("a"):
                state["links"] += len(text.strip())
        at, name = match.end(), match["name"]
        if name is None:
            continue
        name = name.lower()
        if match["close"]:
            if name == "p" and open_place({"p"}) is None:
                flush()
                continue
            for place in range(len(stack) - 1, -1, -1) if opened.get(name) else ():
                if stack[place][0] == name:
                    pop_to(place)
                    break
                # a stray closing tag of the line does not end the block around it
                if name in INLINE and stack[place][0] not in INLINE:
                    break
            continue
        if name in CONTROLS and name not in NOISE and opened.get("form"):
            tree.controls.add(next(n for tag, n in reversed(stack) if tag == "form"))
        if name in RAW:
            # nothing in it is text; without an end it takes the rest
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if not match["attributes"].rstrip().endswith("/"):
                at = end.end() if end else size
            continue
        if name in INLINE:
            if name in ("br", "mtd", "text"):
                pending.append(" ")
            if name not in VOID and not (name in FOREIGN and match["attributes"].endswith("/")):
                push(name, match["attributes"])
            continue
        if name in ENDS_PARAGRAPH and (place := open_place({"p"})) is not None:
            pop_to(place)
        if name in ENDS_ITEM and (place := open_place(ENDS_ITEM[name], ("table", "ul", "ol", "dl", "body"))) is not None:
            pop_to(place)
        flush()
        if name not in VOID:
            push(name, match["attributes"])
    flush()
    return found, tree


def path_scores(nodes: list[Node]) -> np.ndarray:
    """Fused ratio of each block: text and punctuation of its path, smoothed over the page.

    Text ratio of a path: characters outside links by blocks.  Punctuation
    ratio: punctuation marks by blocks.  Both are smoothed with a Gaussian
    window over the blocks in page order and multiplied.
    """
    _, path = np.unique([n.path for n in nodes], return_inverse=True)
    marked = [len(PUNCTUATION.findall(n.text)) * (n.links * 2 < len(n.text)) for n in nodes]
    count, plain, points = (np.bincount(path, weights=w) for w in (None, [len(n.text) - n.links for n in nodes], marked))
    text, marks = (plain / count)[path], (points / count)[path]
    window = np.exp(-np.arange(-2, 3) ** 2 / 2.0)
    window /= window.sum()

    def smooth(x: np.ndarray) -> np.ndarray:
        return np.convolve(np.pad(x, 2, mode="edge"), window, mode="valid")

    return smooth(text) * (1.0 + smooth(marks))


def select(nodes: list[Node], scores: np.ndarray) -> list[Node]:
    """Blocks of the paths that reach the threshold."""
    # paths, not single blocks, are selected: short paragraphs go with long ones
    best: dict[int, float] = {}
    for node, score in zip(nodes, scores, strict=True):
        best[node.path] = max(best.get(node.path, 0.0), score)
    threshold = float(np.std(scores))
    return [n for n in nodes if best[n.path] >= threshold] or nodes


def _by_element(nodes: list[Node], value) -> dict[int, float]:
    out: dict[int, float] = {}
    for node in nodes:
        out[node.element] = out.get(node.element, 0.0) + value(node)
    return out


def _plain(node: Node) -> int:
    return len(node.text) - node.links


def _article(nodes: list[Node], tree: Tree) -> int:
    """The article or main element with most of the text, the innermost that has half of it; 0 if there is none."""
    held = tree.sums(_by_element(nodes, lambda n: LOWERED.get(tree.kind[n.named], 1.0) * len(n.text)))
    found = [e for e, tag in enumerate(tree.tag) if tag in ("article", "main") and held[e]]
    top = max(found, key=lambda e: (held[e], -e), default=0)
    return max((e for e in found if tree.holds(top, e) and held[e] * 2 >= held[top]), default=top)


def without_boilerplate(nodes: list[Node], tree: Tree) -> list[Node]:
    """Blocks without those of named elements and of forms that are not the page's own text.

    What readers say goes if the page has any other running text, and what has
    another certain name if the page has other selected text; the element that
    holds all of it stays, as does one that holds the article.  Other names
    lower scores: an element goes that falls short of the rest, unless it
    stands in the article or holds the article or half of the selected text.
    A form to fill in goes if it holds less than half of the selected text.
    """
    if not any(n.named for n in nodes) and not tree.controls:
        return nodes
    scores = path_scores(nodes)
    selected = select(nodes, scores)
    certain = tree.inherited(lambda e: tree.kind[e] in (CERTAIN, SAID))
    said = tree.inherited(lambda e: tree.kind[e] == SAID)
    own = [n for n in nodes if not certain[n.element] and _plain(n) * 2 > len(n.text)]
    chosen = [n for n in selected if not certain[n.element]]
    article = _article(chosen, tree) or _article(own, tree)
    if not own and not article:
        article = _article(selected, tree) or _article(nodes, tree)
    outer = set(tree.around(article))
    dropped: set[int] = set()
    if own:
        gone = [e for e in set(said) if e and e not in outer]
        gone += [e for e in set(certain) if chosen and e and e not in outer]
    else:
        held = tree.sums(_by_element(nodes, _plain))
        most = max(set(certain) - {0}, key=lambda e: (held[e], -e), default=0)
        gone = [e for e in set(certain) if e not in (0, most) and e not in outer]
    dropped.update(gone)
    total = sum(len(n.text) for n in selected)
    held = tree.sums(_by_element(selected, lambda n: len(n.text)))
    dropped.update(e for e in tree.controls if held[e] * 2 < total)
    rest = [s for n, s in zip(nodes, scores, strict=True) if not n.named]
    least = max(float(np.std(scores)), 0.3 * float(np.mean(rest if rest else scores)))
    best = [0.0] * len(tree.parent)
    for node, score in zip(nodes, scores, strict=True):
        best[node.element] = max(best[node.element], score)
    for element in range(len(best) - 1, 0, -1):
        best[tree.parent[element]] = max(best[tree.parent[element]], best[element])
    for element in {e for e in tree.named if e and tree.kind[e] in (HINT, NAMED)}:
        apart = element not in outer and not (article and tree.holds(article, element))
        if apart and held[element] * 2 <= total and LOWERED[tree.kind[element]] * best[element] < least:
            dropped.add(element)
    inside = tree.inherited(dropped.__contains__)
    return [n for n in nodes if not inside[n.element]] or nodes


def extract(page: str | None) -> str:
    """The article: blocks joined by line ends, empty if the page has none."""
    every, tree = blocks(page or "")
    nodes = [n for n in every if not n.noise]
    nodes = without_boilerplate(nodes, tree) if nodes else nodes
    if not nodes:
        return ""
    selected = select(nodes, path_scores(nodes))
    articles = tree.inherited(lambda e: tree.tag[e] == "article")
    mains = tree.inherited(lambda e: tree.tag[e] == "main")
    whole = {articles[n.element] for n in selected} - {0}
    if not whole:
        whole = {mains[n.element] for n in selected} - {0}
    if whole:
        # with articles come the selected blocks beside them in their main element, and headlines before them
        chosen = {id(n) for n in selected if mains[n.element]}
        taken = {id(n) for n in nodes if articles[n.element] in whole or mains[n.element] in whole or id(n) in chosen}
        first = next(at for at, n in enumerate(nodes) if id(n) in taken)
        taken |= _around(every, nodes, first, first, tree, (-1,))
    else:
        chosen = set(map(id, selected))
        inside = [at for at, n in enumerate(nodes) if id(n) in chosen]
        first, last = _widened(nodes, inside[0], inside[-1], tree)
        taken = {id(n) for n in nodes[first : last + 1]} | _around(every, nodes, first, last, tree)
    return "\n".join(n.text for n in nodes if id(n) in taken)


def _container(element: int, tree: Tree) -> int:
    """The innermost element around a block that is more than a part of a text; a cell that holds blocks is."""
    at = element
    while at and tree.tag[at] in PARTS and not (tree.tag[at] in ("td", "th") and at != element):
        at = tree.block[tree.parent[at]]
    return at


def _widened(nodes: list[Node], first: int, last: int, tree: Tree) -> tuple[int, int]:
    """A run of blocks with those that stand beside its ends in the same container, up to a block of links."""
    ends = []
    for at, step in ((first, -1), (last, 1)):
        container = _container(nodes[at].element, tree)
        while container and tree.tag[container] not in ("html", "body") and 0 <= at + step < len(nodes):
            node = nodes[at + step]
            if not tree.holds(container, node.element) or node.links * 2 >= len(node.text):
                break
            at += step
        ends.append(at)
    return ends[0], ends[1]


def _around(every: list[Node], nodes: list[Node], first: int, last: int, tree: Tree, ways: tuple[int, ...] = (-1, 1)) -> set[int]:
    """Headings and paragraphs right before and after a run of blocks that stand directly in an element around it.

    Boilerplate by tag and blocks of links end the search; outside the page's
    own elements nothing after the run is taken.
    """
    shared = {0} | set(tree.around(nodes[first].element)) & set(tree.around(nodes[last].element))
    left = set(map(id, nodes))
    place = {id(n): at for at, n in enumerate(every)}
    taken: set[int] = set()
    for step in ways:
        passed: list[int] = []
        at = place[id(nodes[first if step < 0 else last])] + step
        while 0 <= at < len(every):
            node = every[at]
            at += step
            if node.noise or id(node) in left and node.links * 2 >= len(node.text):
                break
            if id(node) not in left:
                continue
            passed.append(id(node))
            tag, around = tree.tag[node.element], tree.block[tree.parent[node.element]]
            own = around in shared and tree.tag[around] not in ("", "html", "body")
            if (tag == "p" or tag in HEADINGS) and (own or step < 0 and around in shared):
                taken.update(passed)
    return taken


#: Elements that are parts of a text rather than its container.
PARTS = frozenset("p li ul ol dl dt dd blockquote pre td th tr tbody table h1 h2 h3 h4 h5 h6 figure figcaption".split())


def extract_content(df: DataFrame, page: str, out: str = "text") -> DataFrame:
    """The other columns and the main text of every page.  A null or empty page has an empty text."""
    kept = [c for c in df.columns if c != out]
    passed = [c for c in kept if c != page]
    schema = T.StructType([*(df.schema[c] for c in passed), T.StructField(out, T.StringType(), False)])
    source = "_page" if page == out else page

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([extract(p.as_py()) for p in batch.column(source)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), texts], names=schema.names)

    rows = df.withColumnRenamed(page, source) if source != page else df
    return rows.select(*passed, source).mapInArrow(run, schema)
