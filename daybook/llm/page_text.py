"""Main text of HTML pages with a site style tree for every host.

A page's elements form a tree; an element's style is its tag and classes
(digits masked), its place the styles from the root. Same-host pages merge
into one style tree whose nodes are places. For every node Spark counts

* presentation: the sequences of child styles, each with its pages;
* content: the texts found directly at the node, each with its pages, and
  their shapes: the linked share and the magnitude of the length.

With m pages on the host, a node's presentation importance is the entropy, to
the base m, of its child sequences; a text on k pages has entropy log k to
the base m, and content importance is 1 less the mean of that, taken over texts
(``TEXTS``) and shapes (the rest). Both meet in a
composite importance from the leaves up (Yi, Liu and Li, KDD 2003): with l
children it is (1 - g^l) of the node's own plus g^l of its children's mean.
Branches all of whose nodes are below ``least`` go, inside articles and
outside; nodes on less than a tenth of a host's pages count as important, so
that a tree has at most ten times as many nodes as a page. Few pages say
little: before the comparison importance is drawn to ``PRIOR`` as if by one
more page, so what repeats on all pages of a host goes from three pages on,
and on two pages nothing does with the given ``least``.

An article or main element is a weight, not a verdict: it multiplies the odds
of importance by ``ODDS`` inside, and divides them outside on hosts whose
pages have one (by the power of their share). The same odds weigh a page's
characters, uncut ones against cut ones too.

Elements that announce by tag or role what they are (navigation, forms,
asides) start low: the odds of their importance are divided by ``ODDS``
squared, up to an article or main element in them that is not itself in an
article. They go unless the tree finds them important all the same; where it
does not know them they go. Hidden ones go whole. A class or id word is a low prior only: such a branch stays if, with
its odds divided by ``ODDS``, its share of the page's weighed characters is
``least`` or more; an article or main element in it is judged without it.

Blocks are what block-level elements hold directly; inline markup and line
breaks stay inside. Character references are decoded, white space becomes
one space.

Defined results: null and empty pages have an empty text; a null URL belongs
to the host ''; unclosed and stray tags are closed or passed over as browsers
do; a page that would lose all text by importance keeps what announces
nothing, and if nothing is left, what announces itself by words; repeated
rows each count as a page. Input columns named like a result column are
replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.url_filter import url_host

# Comments, declarations and odd end tags; tags with their attributes as HTML reads them (a quote counts only where a
# value starts); last, a tag that the page does not end, with all that follows it. Nothing is matched twice.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|</?>|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+|=)*+)>"
    r"|<(?=/?[a-zA-Z]).*+",
    re.S,
)
ATTRIBUTE = re.compile(r"(=?[^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)))?+")
DIGITS = re.compile(r"\d+")
NAME = re.compile(r"[a-z]+")

# HTML's element kinds, and the words by which pages announce what is not their article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe noembed noframes xmp svg annotation annotation-xml".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr "
    "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover mfenced annotation annotation-xml".split()
)
NOISE_TAGS = set(
    "head nav footer aside form button select option menu dialog object embed audio video canvas "
    "script style title textarea noscript template iframe noembed noframes svg".split()
)
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOISE_WORDS = set(
    "ad ads advert advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr "
    "notice popup modal overlay newsletter subscribe signup menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside widget related recommended share sharing social comment comments disqus reply replies respond "
    "footer masthead topbar toolbar login pagination pager".split()
)
MAIN_TAGS = {"article", "main"}
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
#: Open elements that a start tag ends (``p`` for those in CLOSES_P), and where the search for them stops.
ENDS = {
    "p": ({"p"}, {"button", "td", "th", "li", "div", "article", "section"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
GROUPS = {tag: i for i, tag in enumerate(ENDS)} | {"dd": 2, "th": 4}
_TOUCHED = {t for wanted, stop in ENDS.values() for t in wanted | stop}
RESULT = ("text", "n_chars")
#: What an article element multiplies the odds of importance by, and a class or id word divides them by.
ODDS = 9.0
#: Importance before any page is seen, which counts as much as one page.
PRIOR = 0.5
#: The part that the texts' entropy has in a content node; the rest is that of their shapes (linked share, length).
TEXTS = 0.8
#: How surely an element says that it is not the article.
WORD, KIND, HIDDEN = 1, 2, 3


class Branch:
    """What an element with a class or id word holds."""

    __slots__ = ("up", "at")

    def __init__(self, up: Branch | None, at: int):
        self.up, self.at = up, at


class Node:
    """An open element. ``home`` is the element that holds its block, ``solid`` counts block elements up to it.

    ``reach`` has, for each group of ``ENDS``, where on the stack the outermost
    element stands that a start tag would end, or -1.
    """

    __slots__ = ("tag", "place", "noise", "main", "cut", "branch", "children", "home", "solid", "linked", "reach")

    def __init__(self, tag: str, place: int, noise: int, main: bool, cut: bool, branch: Branch | None, up: Node | None, own: bool, at: int):
        self.tag, self.place, self.noise, self.main, self.cut, self.branch = tag, place, noise, main, cut, branch
        self.children: list[str] = []
        self.home = self if own else up.home
        self.solid = (up.solid if up else 0) + (tag not in INLINE)
        self.linked = tag == "a" or (up is not None and up.linked)
        self.reach = up.reach if up else (-1,) * len(ENDS)
        if tag in _TOUCHED:
            self.reach = tuple(
                -1 if tag in stop else at if tag in wanted and old < 0 else old
                for old, (wanted, stop) in zip(self.reach, ENDS.values(), strict=True)
            )


def _announced(tag: str, attributes: str, inside_main: bool) -> tuple[str, int]:
    """The element's style, and how surely it says that it is not the article."""
    classes, role, noise = "", "", KIND if tag in NOISE_TAGS or (tag == "header" and not inside_main) else 0
    if attributes and not attributes.isspace():
        given = set()
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
            if name in given:
                continue  # the first counts
            given.add(name)
            if name in ("class", "id"):
                if name == "class":
                    classes = DIGITS.sub("0", value)
                if tag not in ("body", "html") and not NOISE_WORDS.isdisjoint(NAME.findall(value)):
                    noise = max(noise, WORD)
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                noise = HIDDEN
            elif name == "role" and value in NOISE_ROLES:
                noise, role = max(noise, KIND), "@"
            elif name == "style" and "display:none" in value.replace(" ", ""):
                noise = HIDDEN
    return f"{tag}{role}.{classes}" if classes else tag + role, noise


def parse(
    page: str | None, cut: frozenset[int] = frozenset(), seen: list | None = None, kept: frozenset[int] = frozenset()
) -> list[tuple[str, bool, bool, Branch | None]]:
    """Blocks: text, inside an article, in a branch of ``cut``, branch by words.

    Elements that announce themselves by tag or role are left out unless their
    place is in ``kept``. ``seen`` gets (place, parent, what, feature, inside an
    article, announced) of every node: ``what`` is 0 for the sequence of its
    child styles, and for each text directly in it 1 for the text, 2 for its
    linked share, 3 for its length. Takes time in proportion to the page.
    """
    from xxhash import xxh3_64_intdigest as digest

    page = page or ""
    root = Node("", 0, 0, False, False, None, None, True, 0)
    stack, blocks, parts, at, branches = [root], [], [], 0, 0
    opened: dict[str, list[int]] = {}
    linked = 0

    def put(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if stack[-1].linked:
            linked += len(text)

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join(entities.unescape(raw).split())
            share, linked = 2 * linked // max(1, len(raw)), 0
            parts.clear()
            if text:
                holder = stack[-1].home
                if not holder.noise or (holder.noise == KIND and not holder.cut):
                    blocks.append((text, holder.main, holder.cut, holder.branch))
                if seen is not None:
                    for what, feature in ((1, digest(text.encode())), (2, share), (3, len(text).bit_length())):
                        seen.append((holder.place, -1, what, feature, holder.main, holder.noise == KIND))

    def close(count: int) -> None:
        for _ in range(count):
            node = stack[-1]
            if node.home is node:
                flush()
                if seen is not None:
                    styles = digest(" ".join(node.children).encode())
                    seen.append((node.place, stack[-2].place, 0, styles, node.main, node.noise == KIND))
            opened[node.tag].pop()
            stack.pop()

    def push(node: Node) -> None:
        opened.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def end(group: int) -> None:
        """Closes the outermost open element of the group that is not beyond one where the search stops."""
        if (outermost := stack[-1].reach[group]) > 0:
            close(len(stack) - outermost)

    def after(tag: str) -> int:
        """Where an element ends whose content is not markup."""
        finish = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
        return len(page) if finish is None else page.find(">", finish.start()) + 1 or len(page)

    while match := TOKEN.search(page, at):
        if match.start() > at:
            put(page[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            if tag == "br":
                put(" ")
            elif opened.get(tag):
                last = opened[tag][-1]
                # An inline end tag does not close the blocks around which it lies.
                if tag not in INLINE or stack[-1].solid == stack[last].solid:
                    close(len(stack) - last)
            continue
        if tag not in INLINE:
            flush()
        if tag in CLOSES_P:
            end(0)
        if tag in GROUPS and tag != "p":
            end(GROUPS[tag])
        parent = stack[-1]
        if tag == "br":
            put(" ")
            continue
        style, noise = _announced(tag, match[3], parent.main)
        # An inline element that announces itself holds a block of its own.
        own = tag not in INLINE or (noise > parent.noise and tag not in VOID)
        if not own:
            if tag in RAW:
                at = after(tag)
            elif tag not in VOID:
                push(Node(tag, parent.place, parent.noise, parent.main, parent.cut, parent.branch, parent, False, len(stack)))
            continue
        if tag in INLINE:
            flush()
        parent.home.children.append(style)
        if tag in VOID:
            continue
        place = digest(style.encode(), parent.place)
        inherited, branch, gone = parent.noise, parent.branch, parent.cut
        if tag in MAIN_TAGS and inherited != HIDDEN and not opened.get("article"):
            # An article is not taken for what is around it; one in an article may be a comment.
            inherited, branch, gone = 0, None, gone and not inherited
        if noise == WORD:
            branches += 1
            branch, noise = Branch(branch, branches), 0
        noise = max(inherited, noise)
        gone = gone or place in cut or (noise == KIND and place not in kept)
        node = Node(tag, place, noise, parent.main or tag in MAIN_TAGS, gone, branch, parent, True, len(stack))
        if tag in RAW:
            at = after(tag)
            continue
        if not match[3].rstrip().endswith("/") or tag in INLINE or tag in CLOSES_P:
            push(node)
    if at < len(page):
        put(page[at:])
    flush()
    close(len(stack) - 1)
    if seen is not None:
        seen.append((0, -1, 0, digest(" ".join(root.children).encode()), False, False))
    return blocks


def text_of(blocks: list[tuple[str, bool, bool, Branch | None]], least: float = 0.15) -> str:
    """The text of the blocks that are not cut, without branches by words that hold too little of the page."""
    branches: dict[int, Branch] = {}
    masses: dict[int, float] = {}
    total = 0.0
    for text, main, cut, branch in blocks:
        # A word inside an article takes its weight back.
        mass = len(text) * ODDS ** ((main and branch is None) - cut)
        total += mass
        if branch is not None:
            masses[branch.at] = masses.get(branch.at, 0.0) + mass
        while branch is not None and branch.at not in branches:
            branches[branch.at] = branch
            branch = branch.up
    for at in sorted(branches, reverse=True):  # a branch opens after the one that holds it
        if (up := branches[at].up) is not None:
            masses[up.at] = masses.get(up.at, 0.0) + masses[at]
    low = set()
    for at in sorted(branches):
        up, mass = branches[at].up, masses[at] / ODDS
        if mass < least * (mass + total - masses[at]) or (up is not None and up.at in low):
            low.add(at)
    plain = [b for b in blocks if b[3] is None or b[3].at not in low]
    for chosen in ([b for b in plain if not b[2]], plain, [b for b in blocks if not b[2]]):
        if chosen:
            return "\n".join(b[0] for b in chosen)
    return "\n".join(b[0] for b in blocks)


def _features(pages: DataFrame, html: str) -> DataFrame:
    """A row for each page and (place, parent, what, feature), once a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, page in zip(batch.column("_host").to_pylist(), batch.column("_html"), strict=True):
                seen: list = []
                parse(page.as_py(), seen=seen)
                rows += [(host, *x) for x in set(seen)]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            signed = lambda c: pa.array([v - (1 << 64) if v >> 63 and v > 0 else v for v in c], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), signed(columns[1]), signed(columns[2]), pa.array(columns[3], pa.int8()), signed(columns[4]), pa.array(columns[5], pa.bool_()), pa.array(columns[6], pa.bool_())],
                ["host", "place", "parent", "what", "feature", "main", "kind"],
            )

    narrow = pages.select("_host", F.col(html).alias("_html"))
    return narrow.mapInArrow(run, "host string, place bigint, parent bigint, what tinyint, feature bigint, main boolean, kind boolean")


def style_trees(features: DataFrame, hosts: DataFrame) -> DataFrame:
    """A row for each node of the tree of each of ``hosts`` (host, m), with what its importance needs.

    ``own`` is presentation importance, ``spread`` the entropy of content;
    ``rare`` the pages of children that are on few of the host's pages.
    """
    counted = features.groupBy("host", "place", "parent", "what", "feature", "main", "kind").agg(F.count("*").alias("n"))
    nodes = counted.groupBy("host", "place", "what").agg(
        F.max("parent").alias("parent"),
        F.max("main").alias("main"),
        F.max("kind").alias("kind"),
        F.sum("n").alias("_sum"),
        F.sum(F.col("n") * F.log("n")).alias("_nlogn"),
        F.avg(F.log("n")).alias("_logn"),
    )

    def only(what: int, c: Column) -> Column:
        return F.max(F.when(F.col("what") == what, c))

    nodes = nodes.groupBy("host", "place").agg(
        only(0, F.col("parent")).alias("parent"),
        F.max("main").alias("main"),
        F.max("kind").alias("kind"),
        only(0, F.col("_sum")).alias("n"),
        only(0, F.log("_sum") - F.col("_nlogn") / F.col("_sum")).alias("style"),
        (TEXTS * only(1, F.col("_logn")) + (1 - TEXTS) / 2 * (only(2, F.col("_logn")) + only(3, F.col("_logn")))).alias("text"),
    )
    nodes = nodes.where("n is not null").join(hosts, "host")
    common = nodes.where("n * 10 >= m")
    rare = nodes.where("n * 10 < m").groupBy("host", F.col("parent").alias("place")).agg(F.sum("n").alias("rare"))
    return common.join(rare, ["host", "place"], "left").select(
        "host", "place", "parent", "main", "kind", "n",
        F.least(F.lit(1.0), F.col("style") / F.log("m")).alias("own"),
        F.when(F.col("text").isNotNull(), F.least(F.lit(1.0), F.col("text") / F.log("m"))).alias("spread"),
        F.coalesce("rare", F.lit(0)).alias("rare"),
    )


def low_branches(nodes: list[dict], least: float, damping: float = 0.9) -> list[int]:
    """Places of one host where weighed composite importance is below ``least`` all the way down."""
    pages = max((n["n"] for n in nodes if not n["place"]), default=1)
    articles = max((n["n"] for n in nodes if n.get("main")), default=0) / pages
    below: dict[int, list[dict]] = {}
    for node in nodes:
        if node["place"]:
            below.setdefault(node["parent"], []).append(node)
    known: dict[int, float] = {}
    low: set[int] = set()
    stack = [(n, False) for n in below.get(0, [])]
    while stack:
        node, ready = stack.pop()
        children = below.get(node["place"], [])
        if not ready:
            stack.append((node, True))
            stack += [(c, False) for c in children]
            continue
        weights = [(c["n"], known[c["place"]]) for c in children]
        if node["rare"]:
            weights.append((node["rare"], 1.0))
        if node["spread"] is not None:
            weights.append((node["n"], 1.0 - node["spread"]))
        share = damping ** len(children) if weights else 0.0
        inner = sum(w * x for w, x in weights) / sum(w for w, _ in weights) if weights else 0.0
        known[node["place"]] = (1 - share) * node["own"] + share * inner
        odds = ODDS if node.get("main") else ODDS ** -min(1.0, articles)
        prior = PRIOR
        if node.get("kind"):  # what announces itself by tag or role starts low, seen or unseen
            odds, prior = odds / ODDS**2, PRIOR / ODDS**2
        value = known[node["place"]]
        weighed = odds * value / (odds * value + 1 - value)
        if (pages * weighed + prior) / (pages + 1) < least and not node["rare"] and all(c["place"] in low for c in children):
            low.add(node["place"])
    return sorted(low)


def _judged_places(trees: DataFrame, least: float) -> DataFrame:
    """For each host the low places, and the places that announce themselves and are not low."""

    def judge(key, table):
        nodes = table.to_pylist()
        low = low_branches(nodes, least)
        kept = sorted({n["place"] for n in nodes if n["kind"]} - set(low))
        kind = pa.list_(pa.int64())
        return pa.table({"_host": pa.array([key[0].as_py()], pa.string()), "_cut": pa.array([low], kind), "_kept": pa.array([kept], kind)})

    judged = trees.groupBy("host").applyInArrow(judge, "_host string, _cut array<bigint>, _kept array<bigint>")
    return judged.where(F.size("_cut") + F.size("_kept") > 0)


def main_texts(
    pages_table: DataFrame,
    url: str = "url",
    html: str = "html",
    least: float = 0.15,
    pages: int = 2,
    broadcast_limit: int = 16 << 20,
) -> DataFrame:
    """``pages_table`` without its HTML, with ``text`` and ``n_chars``.

    The hosts' low branches are broadcast if measured below
    ``broadcast_limit`` bytes, else joined by a shuffle on the host.
    """
    from daybook.session import checkpoint_dir

    checkpoint_dir(pages_table.sparkSession)
    others = [f for f in pages_table.schema if f.name not in (html, *RESULT)]
    named = pages_table.withColumn("_host", url_host(F.col(url)))
    hosts = named.groupBy(F.col("_host").alias("host")).agg(F.count("*").alias("m")).where(F.col("m") >= pages)
    cuts = _judged_places(style_trees(_features(named, html), hosts), least).checkpoint()
    size = F.octet_length("_host") + 8 * (F.size("_cut") + F.size("_kept")) + 64
    size = cuts.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    joined = named.join(F.broadcast(cuts) if 2 * size <= broadcast_limit else cuts, "_host", "left")
    joined = joined.select(*(F.col(f"`{f.name}`") for f in others), F.col(html).alias("_html"), "_cut", "_kept")

    def places(listed: list[int] | None) -> frozenset[int]:
        return frozenset(p % (1 << 64) for p in listed or ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            judged = zip(batch.column("_cut").to_pylist(), batch.column("_kept").to_pylist(), strict=True)
            for page, (cut, kept) in zip(batch.column("_html"), judged, strict=True):
                texts.append(text_of(parse(page.as_py(), places(cut), kept=places(kept)), least))
            names = [f.name for f in others]
            added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *added], [*names, *RESULT])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    return joined.mapInArrow(run, f"{schema}text string, n_chars bigint")
