"""Main text of web pages through wrappers inferred per host.

A *wrapper* is a union-free regular expression over a host's token streams:
nested sequences of elements and texts in which any group may be optional
(``?``) or repeated (``+``), and every text is either a constant of the
template or a slot.  It is inferred by alignment: the stream of one page is
the first wrapper, and each further page is aligned with it; a run of equal
neighbours becomes a repeated group, a group that only one side has becomes
optional, and texts that differ become slots.

Pages are folded into wrappers where they are read (one small wrapper per host
and partition); partial wrappers are then aligned with each other in rounds of
at most ``FAN`` per task, so a host with a third of all pages is spread as
evenly as any other.

*Extraction* aligns a page with its host's wrapper.  The main region is the
``article`` elements if there are any, else ``main``, else the body; inside it
the text is kept, block by block, but for elements that are boilerplate by tag,
role, class or id (menus, headers and footers of the page, sidebars, notices,
adverts, forms, scripts, styles, comments), and for texts that the wrapper
shows to be constants of the template.  Near copies of a page say nothing about
the template: a constant has to be on most of the host's pages that differ in
more than half of their main text.  All pages are counted: they are taken in the
order of their digests, and one differs if it is no copy of one that does before it
(``copies``).  Without a main region, blocks that are mostly links go too.

Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one newline.

Defined cases: null or empty html gives an empty text; a null or odd url
belongs to the host ``''``; what elements nested deeper than ``DEPTH`` hold is
taken as the last level's, but for articles, main regions, boilerplate and links,
which keep it; repeated rows give repeated results; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_module
import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.config import remove_dir
from cartwheel.llm.scratch import stage, stage_at

DEPTH, FAN, PERIOD = 150, 32, 4
#: A text is a constant of the template if it is on this share of a host's
#: pages that differ, of which there are at least ``MIN_PAGES``.
CONSTANT_SHARE, MIN_PAGES = 0.8, 5
#: Pages of a host count as copies, so as one, if more than this share of the
#: characters in either's main text is in both.
COPY_SHARE = 0.5
#: Pages that share a text are told apart in rounds, of so many of them at most.
FRONT = 256
#: Longer texts are held by a digest of theirs.
PLAIN_CHARS = 200
LINK_SHARE = 0.6
#: Wrappers of all hosts together, up to which they are sent to the pages;
#: beyond, pages are joined with them.
BROADCAST_BYTES = 32 << 20

#: Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "template"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br".split()
)
#: An opening tag ends an open element of these.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
    "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"},
}
P_SCOPE = {"article", "body", "button", "div", "li", "main", "section", "table", "td", "th", "blockquote", "aside"}
BOILERPLATE_TAGS = set(
    "head nav footer aside form script style noscript template iframe button select textarea svg menu dialog canvas "
    "object audio video map input title".split()
)
BOILERPLATE_WORDS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside ad ads adv advert advertisement adverts "
    "advertising banner promo promotion sponsor sponsored cookie cookies consent notice popup modal overlay share sharing social "
    "comment comments commentlist reply replies respond disqus discussion related recommended subscribe subscription "
    "newsletter login signin signup toolbar pagination pager skip widget masthead topbar hidden gdpr paywall".split()
)
PAGE_HEADER = {"header"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")


class Element:
    """A tag with its label (tag, class, id, role) and children (elements and
    texts)."""

    __slots__ = ("tag", "label", "children")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.children = tag, label, []


class _Deep(Element):
    """An open element below ``DEPTH``: its children go to the list of an
    element above, unless that would change what they count as."""

    __slots__ = ("kinds",)

    def __init__(self, tag: str, label: str, children: list, kinds: frozenset[str]):
        self.tag, self.label, self.children, self.kinds = tag, label, children, kinds


def _kind(element: Element) -> str | None:
    """What an element makes of the text in it."""
    if element.tag in ("article", "a"):
        return element.tag
    if element.tag == "main" or " role=main" in element.label:
        return "main"
    if _boilerplate(element, True):
        return "boilerplate"
    return "header" if element.tag in PAGE_HEADER else None


def _label(tag: str, attributes: str) -> str:
    if "=" not in attributes and "hidden" not in attributes:
        return tag
    found = []
    for name, value in _ATTRIBUTE.findall(attributes):
        value = re.sub(r"\d+", "0", value.strip("\"'")).lower()
        found.append(f"{name.lower()}={value}")
    return " ".join([tag, *sorted(found)])


def parse(page: str) -> Element:
    """The element tree of a page, ended tags implied where HTML does."""
    root = Element("#root", "#root")
    stack = [root]
    open_tags: Counter[str] = Counter()
    at, end = 0, len(page)

    def cut(i: int) -> None:
        for e in stack[i:]:
            open_tags[e.tag] -= 1
        # below DEPTH a block still ends where its tag does
        if any(isinstance(e, _Deep) and e.tag not in INLINE for e in stack[i:]):
            stack[i - 1].children.append(Element("#end", "#end"))
        del stack[i:]

    def close(names: set[str], scope: set[str]) -> None:
        if not any(open_tags[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                cut(i)
                return
            if stack[i].tag in scope:
                return

    def push(element: Element) -> None:
        open_tags[element.tag] += 1
        if len(stack) < DEPTH:
            stack[-1].children.append(element)
            stack.append(element)
            return
        above = stack[-1]
        kind = _kind(element)
        kinds = above.kinds if isinstance(above, _Deep) else frozenset()
        own = kind and kind not in kinds and "boilerplate" not in kinds
        if own:
            above.children.append(element)
        elif element.tag not in INLINE:
            above.children.append(Element("#end", "#end"))
        children = element.children if own else above.children
        stack.append(_Deep(element.tag, element.label, children, kinds | {kind} if own else kinds))

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        closing, name, rest = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not name:
            if m.group(0).startswith("<![CDATA["):
                stack[-1].children.append(m.group(0)[9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = name.lower()
        if closing:
            if open_tags[tag]:
                cut(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in ENDS:
            close(ENDS[tag], SCOPES[tag])
        elif tag not in INLINE and tag not in RAW:
            close({"p"}, P_SCOPE)
        element = Element(tag, _label(tag, rest))
        if tag in RAW and not rest.endswith("/"):
            stack[-1].children.append(element)
            stop = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
        elif tag in VOID:
            stack[-1].children.append(element)
        else:
            push(element)
    return root


# --- wrappers ---------------------------------------------------------------
# node: {"l": label, "n": pages, "i": [item]}   text: {"l": "#", "n", "v", "c"}
# item: {"s": [nodes], "o": optional, "r": repeated}
# the root also has "p": {digest of a page's main text: {digest of a text: characters}},
# or "k": [digest of a constant], once all pages of the host are counted


def _children(element: Element) -> list:
    """Elements and non-blank texts."""
    return [c for c in element.children if not isinstance(c, str) or c.strip()]


def _key(child) -> str:
    return "#" if isinstance(child, str) else child.label


def runs(keys: list[str]) -> list[tuple[int, int, int]]:
    """The sequence as (start, period, repeats): the repeat of up to
    ``PERIOD`` neighbours that covers most, else one by one."""
    out, i, n = [], 0, len(keys)
    while i < n:
        best = (1, 1)
        for k in range(1, min(PERIOD, (n - i) // 2) + 1):
            r = 1
            while keys[i + r * k : i + r * k + k] == keys[i : i + k]:
                r += 1
            if r > 1 and r * k > best[0] * best[1]:
                best = (k, r)
        out.append((i, *best))
        i += best[0] * best[1]
    return out


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode(errors="replace"), digest_size=8).hexdigest()


def _value(text: str) -> str:
    """What stands for a text in a wrapper: itself, or a digest if it is long."""
    text = " ".join(text.split())
    return text if len(text) <= PLAIN_CHARS else "\0" + hashlib.blake2b(text.encode(errors="replace"), digest_size=16).hexdigest()


def page_wrapper(element: Element | str) -> dict:
    """The wrapper of a single page's element."""
    if isinstance(element, str):
        text = " ".join(html_module.unescape(element).split())
        return {"l": "#", "n": 1, "v": _value(text), "c": len(text)}
    children = _children(element) if element.tag not in RAW else []
    keys = [_key(c) for c in children]
    items = []
    for start, period, repeats in runs(keys):
        nodes = [page_wrapper(c) for c in children[start : start + period]]
        for r in range(1, repeats):
            for j in range(period):
                _merge(nodes[j], page_wrapper(children[start + r * period + j]), 0)
        items.append({"s": nodes, "o": 0, "r": int(repeats > 1)})
    node = {"l": element.label, "n": 1, "i": items}
    return {**node, "p": _vote(element)} if element.tag == "#root" else node


def _item_key(item: dict) -> tuple:
    return tuple(node["l"] for node in item["s"])


def _merge(a: dict, b: dict, add: int = 1) -> None:
    """Align ``b`` with ``a`` and generalise ``a``."""
    a["n"] += b["n"] * add
    if a["l"] == "#":
        if a["v"] != b["v"]:
            a["v"] = None
        a["c"] += b["c"]
        return
    left, right = a["i"], b["i"]
    ka, kb = [_item_key(x) for x in left], [_item_key(x) for x in right]
    if ka == kb:
        pairs = [(i, i) for i in range(len(ka))]
    else:
        blocks = SequenceMatcher(None, ka, kb, autojunk=False).get_matching_blocks()
        pairs = [(x.a + d, x.b + d) for x in blocks for d in range(x.size)]
    out, i, j = [], 0, 0
    for x, y in [*pairs, (len(ka), len(kb))]:
        for item in left[i:x]:
            item["o"] = 1
            out.append(item)
        for item in right[j:y]:
            item["o"] = 1
            out.append(item)
        if x < len(ka):
            item, other = left[x], right[y]
            item["o"] |= other["o"]
            item["r"] |= other["r"]
            for p, q in zip(item["s"], other["s"]):
                _merge(p, q, add)
            out.append(item)
        i, j = x + 1, y + 1
    a["i"] = out


def _shared(a: dict[str, int], b: dict[str, int]) -> float:
    both = sum(n for x, n in a.items() if x in b)
    return both / max(sum(a.values()) + sum(b.values()) - both, 1)


def _different(votes: dict[str, dict]) -> list[dict]:
    """In the order of digests those that are no copies of earlier ones."""
    out: list[dict] = []
    for _, vote in sorted(votes.items()):
        if all(_shared(x, vote) <= COPY_SHARE for x in out):
            out.append(vote)
    return out


def _vote(root: Element) -> dict[str, dict]:
    """The page's vote: a digest of its main text, and the characters of each
    text in it."""
    texts = {}
    for text in main_texts(root):
        text = " ".join(text.split())
        texts[_digest(_value(text))] = len(text)
    return {_digest(" ".join(sorted(texts))): texts} if texts else {}


def merge(a: dict | None, b: dict) -> dict:
    """The wrapper of both; ``a`` is changed."""
    if a is None:
        return b
    _merge(a, b)
    if "p" in a:
        a["p"].update(b["p"])
    return a


def constants(wrapper: dict | None) -> set[str]:
    """Digests of the texts on enough of the pages that differ."""
    if wrapper and "k" in wrapper:
        return set(wrapper["k"])
    votes = _different(wrapper["p"]) if wrapper else []
    if len(votes) < MIN_PAGES:
        return set()
    seen = Counter(x for texts in votes for x in texts)
    return {x for x, n in seen.items() if n >= CONSTANT_SHARE * len(votes)}


# --- extraction -------------------------------------------------------------


def _boilerplate(element: Element, inside: bool) -> bool:
    tag = element.tag
    if tag in BOILERPLATE_TAGS or tag in PAGE_HEADER and not inside:
        return True
    if element.label == tag:
        return False
    for part in element.label.split(" ")[1:]:
        name, _, value = part.partition("=")
        if name == "role" and value in BOILERPLATE_ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name not in ("class", "id", "role", "hidden", "aria-hidden"):
            value = part  # another word of a class list
        if tag not in ("body", "html", "main", "article") and BOILERPLATE_WORDS.intersection(_WORD.findall(value)):
            return True
    return False


def _region(root: Element) -> set[str]:
    """The tag of the main region: article, main or neither."""
    seen, todo = set(), [root]
    while todo:
        e = todo.pop()
        if e.tag in ("article", "main") or " role=main" in e.label:
            seen.add("article" if e.tag == "article" else "main")
        todo += [c for c in e.children if not isinstance(c, str) and not _boilerplate(c, False)]
    return {"article"} if "article" in seen else seen


class _Blocks:
    """Text gathered into blocks, with the share of it in links."""

    def __init__(self, drop_links: bool):
        self.blocks: list[str] = []
        self.now: list[str] = []
        self.chars = self.linked = 0
        self.drop_links = drop_links

    def text(self, s: str, link: bool) -> None:
        self.now.append(s)
        n = len(s.strip())
        self.chars += n
        self.linked += n if link else 0

    def end(self) -> None:
        if self.now:
            block = " ".join("".join(self.now).split())
            if block and not (self.drop_links and self.linked >= LINK_SHARE * max(self.chars, 1)):
                self.blocks.append(block)
            self.now, self.chars, self.linked = [], 0, 0


def main_texts(root: Element) -> Iterator[str]:
    """The texts that extraction without a wrapper reads, one by one."""
    region = _region(root)
    todo = [(root, False)]
    while todo:
        element, inside = todo.pop()
        inside = inside or not region or element.tag in region or "main" in region and " role=main" in element.label
        for child in element.children:
            if isinstance(child, str):
                if inside and child.strip():
                    yield html_module.unescape(child)
            elif child.tag not in VOID and not _boilerplate(child, inside and bool(region)):
                todo.append((child, inside))


def extract(page: str, wrapper: dict | None) -> str:
    """The main text of a page, read through its host's wrapper."""
    root = parse(page)
    region = _region(root)
    template = constants(wrapper)
    out = _Blocks(drop_links=not region)

    def constant(node: dict | None, text: str) -> bool:
        if not template or node is None or node["v"] is None:
            return False
        value = _value(text)
        return node["v"] == value and _digest(value) in template

    def walk(element: Element, node: dict | None, inside: bool, link: bool) -> None:
        inside = inside or not region or element.tag in region or "main" in region and " role=main" in element.label
        children = _children(element)
        partners: list[dict | None] = [None] * len(children)
        if template and node is not None and "i" in node:
            keys = [_key(c) for c in children]
            groups = runs(keys)
            mine = [tuple(keys[s : s + k]) for s, k, _ in groups]
            theirs = [_item_key(x) for x in node["i"]]
            if mine == theirs:
                pairs = [(i, i) for i in range(len(mine))]
            else:
                blocks = SequenceMatcher(None, mine, theirs, autojunk=False).get_matching_blocks()
                pairs = [(x.a + d, x.b + d) for x in blocks for d in range(x.size)]
            for x, y in pairs:
                start, k, r = groups[x]
                for d in range(k * r):
                    partners[start + d] = node["i"][y]["s"][d % k]
        partner = dict(zip(map(id, children), partners))
        for child in element.children:
            if isinstance(child, str):
                if inside:
                    text = html_module.unescape(child)
                    if not (child.strip() and constant(partner[id(child)], text)):
                        out.text(text, link)
                continue
            if child.tag == "br" and inside:
                out.text(" ", link)
            if child.tag in VOID or _boilerplate(child, inside and bool(region)):
                if child.tag not in INLINE:
                    out.end()
                continue
            block = child.tag not in INLINE
            if block:
                out.end()
            walk(child, partner.get(id(child)), inside, link or child.tag == "a")
            if block:
                out.end()

    walk(root, wrapper, False, False)
    out.end()
    return "\n".join(out.blocks)


# --- Spark jobs -------------------------------------------------------------


def _host(url: str) -> str:
    """SQL for the host of a url column, lower case, without port."""
    return f"lower(coalesce(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1), ''))"


_FOUND = "host string, part long, wrapper string, vote string, texts array<string>"


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's wrapper of each host, and the vote of each page: its digest
    and its texts, each as digest and characters."""
    wrappers: dict[str, dict] = {}
    part = TaskContext.get().partitionId()

    def rows(hosts: list, found: list, votes: list, texts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.string()),
                pa.array([part] * len(hosts), pa.int64()),
                pa.array(found, pa.string()),
                pa.array(votes, pa.string()),
                pa.array(texts, pa.list_(pa.string())),
            ],
            names=["host", "part", "wrapper", "vote", "texts"],
        )

    for batch in batches:
        votes: dict[tuple[str, str], list[str]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if page:
                wrapper = page_wrapper(parse(page))
                for vote, texts in wrapper.pop("p").items():
                    votes[host, vote] = [f"{x}{n}" for x, n in texts.items()]
                wrappers[host] = merge(wrappers.get(host), wrapper)
        yield rows([h for h, _ in votes], [None] * len(votes), [v for _, v in votes], list(votes.values()))
    n = len(wrappers)
    yield rows(list(wrappers), [json.dumps(w) for w in wrappers.values()], [None] * n, [None] * n)


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    w = None
    for text in pdf.sort_values("part")["wrapper"]:
        w = merge(w, json.loads(text))
    return pd.DataFrame({"host": pdf["host"].iloc[:1], "part": pdf["to"].iloc[:1], "wrapper": [json.dumps(w)]})


def _chars(texts: str) -> str:
    """SQL for the characters of an array of texts (16 digits of digest, then
    the number)."""
    return f"aggregate({texts}, 0L, (n, x) -> n + cast(substr(x, 17) as long))"


def copies(votes: DataFrame) -> DataFrame:
    """``host, vote`` of the votes (``host, vote, texts``, each once) that are
    copies of an earlier vote of their host which is none: what ``_different``
    leaves out, for hosts of any size.

    A copy has more than half of its characters in texts that both have, so the
    two also share one of the texts that are left when the most frequent half of
    each is put away.  Votes that share such a text are a group.  In a round, the
    first few votes of each group are compared with the whole group, and those
    with no copy before them are decided, with all their copies.  A pair with an
    overlap of 3 * o <= a + b characters is none, so two votes that both have a
    third of their own text never are.
    """
    spark = votes.sparkSession
    each = votes.select("host", "vote", F.explode("texts").alias("t"))
    common = each.groupBy("host", "t").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = F.expr("transform(array_sort(collect_list(struct(df, t))), x -> x.t)").alias("held")
    near = each.join(common, ["host", "t"]).groupBy("host", "vote").agg(held)
    near = (
        votes.selectExpr("host", "vote", f"{_chars('texts')} as size")
        .join(near, ["host", "vote"])
        .withColumn("most", F.expr(_chars("held")))
        .where("2 * most > size")
    )
    near, near_path = stage_at(near, "votes")
    # the leading texts up to which more than half of the characters are left
    lead = (
        "aggregate(held, struct(most as left, 0 as n), (s, x) -> if(2 * s.left > size,"
        " struct(s.left - cast(substr(x, 17) as long) as left, s.n + 1 as n), s), s -> s.n)"
    )
    keys = near.select(
        "host", "vote", F.expr("3 * most > 2 * size").alias("heavy"), F.expr(f"explode(slice(held, 1, {lead}))").alias("t")
    )
    keys, keys_path = stage_at(keys, "groups")
    removed, at = None, 0
    while True:
        group = Window.partitionBy("host", "t")
        whole = keys.groupBy("host", "t").agg(F.count(F.lit(1)).alias("n"), F.max("heavy").alias("any"))
        live, live_path = stage_at(keys.join(whole.where("n > 1 and any").select("host", "t"), ["host", "t"]), "groups")
        remove_dir(spark, keys_path)
        keys, keys_path = live, live_path
        if keys.isEmpty():
            break
        front = keys.withColumn("i", F.row_number().over(group.orderBy("vote"))).where(F.col("i") <= min(4**at, FRONT))
        front, front_path = stage_at(front.drop("i"), "front")
        side = lambda name: near.select(
            "host", F.col("vote").alias(name), F.col("held").alias(f"{name}_held"), F.col("size").alias(f"{name}_size")
        )
        pairs = (
            front.select("host", "t", F.col("vote").alias("a"), F.col("heavy").alias("a_heavy"))
            .join(keys.select("host", "t", F.col("vote").alias("b"), "heavy"), ["host", "t"])
            .where("a < b and (a_heavy or heavy)")
            .select("host", "a", "b")
            .distinct()
            .join(side("a"), ["host", "a"])
            .join(side("b"), ["host", "b"])
            .withColumn("both", F.expr(_chars("array_intersect(a_held, b_held)")))
            .where(F.col("both") > COPY_SHARE * (F.col("a_size") + F.col("b_size") - F.col("both")))
        )
        pairs, pairs_path = stage_at(pairs.select("host", "a", "b"), "copies")
        count = lambda df, name: df.groupBy("host", "vote").agg(F.count(F.lit(1)).alias(name))
        first = count(front, "n").join(count(keys, "of"), ["host", "vote"]).where("n = of").select("host", "vote")
        first = first.join(pairs.select("host", F.col("b").alias("vote")), ["host", "vote"], "left_anti")
        first, first_path = stage_at(first, "different")
        gone = stage(
            pairs.join(first.withColumnRenamed("vote", "a"), ["host", "a"], "left_semi")
            .select("host", F.col("b").alias("vote"))
            .distinct(),
            "copied",
        )
        removed = gone if removed is None else removed.unionByName(gone)
        left, left_path = stage_at(keys.join(first.unionByName(gone), ["host", "vote"], "left_anti"), "groups")
        for path in (keys_path, front_path, pairs_path, first_path):
            remove_dir(spark, path)
        keys, keys_path, at = left, left_path, at + 1
    remove_dir(spark, keys_path)
    remove_dir(spark, near_path)
    return removed if removed is not None else votes.select("host", "vote").limit(0)


def host_constants(votes: DataFrame) -> DataFrame:
    """``host, k``: digests of the texts on enough of a host's pages that
    differ, of all pages' votes."""
    votes = stage(votes.dropDuplicates(["host", "vote"]), "votes")
    votes = votes.join(copies(votes), ["host", "vote"], "left_anti")
    pages = votes.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= MIN_PAGES)
    texts = votes.select("host", F.explode("texts").alias("t")).groupBy("host", "t").agg(F.count(F.lit(1)).alias("n"))
    return (
        texts.join(pages, "host")
        .where(F.col("n") >= CONSTANT_SHARE * F.col("pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.substring("t", 1, 16))).alias("k"))
    )


def infer(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` of ``pages(url, html)``; wrappers are JSON."""
    read = stage(pages.select(F.expr(_host("url")).alias("host"), "html").mapInArrow(_infer, _FOUND), "wrappers")
    found = read.where("wrapper is not null").select("host", "part", "wrapper")
    last = found.agg(F.max("part")).first()[0] or 0
    while last > 0:
        found = stage(
            found.withColumn("to", F.floor(F.col("part") / FAN))
            .groupBy("host", "to")
            .applyInPandas(_fold, "host string, part long, wrapper string"),
            "wrappers",
        )
        last //= FAN
    known = host_constants(read.where("vote is not null").select("host", "vote", "texts"))
    listed = "coalesce(to_json(k), '[]')"
    return stage(
        found.join(known, "host", "left").select(
            "host", F.expr(f"concat(left(wrapper, length(wrapper) - 1), ', \"k\": ', {listed}, '}}')").alias("wrapper")
        ),
        "wrappers",
    )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    wrappers = infer(pages)
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    rows = pages.select("page_id", "url", "html", F.expr(_host("url")).alias("host"))
    small = None
    if size <= BROADCAST_BYTES:
        small = pages.sparkSession.sparkContext.broadcast({r["host"]: r["wrapper"] for r in wrappers.collect()})
    else:
        rows = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "host", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict[str, dict | None] = {}
        for batch in batches:
            texts = []
            hosts = batch.column(3).to_pylist()
            found = [small.value.get(h) for h in hosts] if small else batch.column(4).to_pylist()
            for host, page, wrapper in zip(hosts, batch.column(2).to_pylist(), found):
                if host not in loaded:
                    if len(loaded) > 1000:
                        loaded.clear()
                    loaded[host] = json.loads(wrapper) if wrapper else None
                texts.append(extract(page, loaded[host]) if page else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
