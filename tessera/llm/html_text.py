"""Main text of web pages by wrapper induction.

Pages of one host are parsed to DOM trees and folded, two at a time, into one
wrapper tree.  Children are aligned by simple tree matching (the largest
number of node pairs with equal labels that keeps order and ancestry); runs of
like siblings count as one repeated slot.  A slot whose text is the same on
every page that has it belongs to the template; a slot whose text varies is
content.  The wrapper of a host is as large as the union of its page layouts,
not as its pages: every task folds its own pages, partial wrappers of a host
are folded by (host, bucket), and the last fold sees one partial a bucket.
Then each page meets its host's wrapper again; template slots and the parts
that menus, forms, adverts and the like mark as their own are left out, and
the remaining text is emitted block by block.

Defined cases: NULL html gives an empty text; a page without a host in its url
is folded with the others of that kind; a host whose pages all have the same
text, or of fewer than ``MIN_PAGES`` pages, has no template evidence, so only
the marks count; if the template would leave nothing, the marks alone decide;
repeated rows give one row each; other columns are ignored; an empty table
gives an empty result.
"""
from __future__ import annotations

import hashlib
import html as entities
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, one, text_of

#: a slot is template only if at least so many pages show it, all with one text
MIN_PAGES = 8
#: nodes below this depth belong to their ancestor's slot
MAX_DEPTH = 60
#: partial wrappers of a host are folded in so many groups first
BUCKETS = 64
#: and a host's pages meet its wrapper in so many parts
SALTS = 32

# fixed values: HTML element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title template".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - frozenset("body html dd dt li option optgroup td th tr tbody thead tfoot legend summary".split())
SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "thead": ("tbody", "tr"), "tbody": ("thead", "tr", "td", "th")}
FENCE = frozenset("table ul ol dl select div article section main aside nav body".split())
# fixed values: elements, roles and class or id words that never hold the article
OUTSIDE = frozenset("""head nav aside footer form script style noscript template svg math button select input textarea
    iframe object embed canvas audio video menu dialog datalist""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
    sidebar sidenav rail nav navbar navigation menu submenu breadcrumb breadcrumbs masthead topbar toolbar footer
    cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription
    signup login share sharing social related recommended recommendations comment comments commentlist reply replies
    respond disqus widget widgets pagination pager copyright skip teaser teasers""".split())

_TAG = re.compile(r"<(?:!--(?:.*?)(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)"
                  r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|[^>]*(?:>|\Z)))", re.S)
_ATTR = re.compile(r"(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")
_LABEL, _NUMBER = re.compile(r"[a-z0-9]+"), re.compile(r"\d{3,}")  # long numbers name single pages, not layouts


class Dom:
    """Elements in document order; ``kids`` holds element numbers and texts."""

    __slots__ = ("tag", "key", "mark", "main", "head", "kids")

    def __init__(self):
        self.tag, self.key, self.mark, self.main, self.kids = ["#root"], [""], [False], [False], [[]]
        self.head: set[int] = set()  # site headers, unless inside the article

    def add(self, parent: int, tag: str, attrs: str) -> int:
        key, mark, main = "", tag in OUTSIDE, tag in ("article", "main")
        names: list[str] = []
        if attrs and not attrs.isspace():
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id"):
                    words = [w.lower() for w in _TOKEN.findall(value)]
                    names += _LABEL.findall(_NUMBER.sub("", value.lower()))
                    mark = mark or (tag not in ("html", "body", "article", "main") and not WORDS.isdisjoint(words))
                    mark = mark or (tag == "article" and not WORDS.isdisjoint(words)
                                    and not {"comment", "comments", "reply", "ad", "teaser", "sponsored", "related"}.isdisjoint(words))
                elif name == "role":
                    mark, main = mark or value.lower() in ROLES, main or value.lower() == "main"
                elif name == "itemprop":
                    main = main or value.lower() == "articlebody"
                elif name == "hidden":
                    mark = True
            key = " ".join(names)
        n = len(self.tag)
        if tag == "header" or "header" in names:
            self.head.add(n)
        self.tag.append(tag)
        self.key.append(key)
        self.mark.append(mark)
        self.main.append(main and not mark)
        self.kids.append([])
        self.kids[parent].append(n)
        return n


def parse(source: str) -> Dom:
    """A tolerant parse: unclosed, stray and cut-off tags are all accepted."""
    dom, stack, at, end = Dom(), [0], 0, len(source)
    tag_of, kids = dom.tag, dom.kids
    find = _TAG.search
    while at < end:
        m = find(source, at)
        if m is None:
            kids[stack[-1]].append(entities.unescape(source[at:]))
            break
        if m.start() > at:
            text = source[at:m.start()]
            kids[stack[-1]].append(entities.unescape(text) if "&" in text else text)
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if tag_of[stack[i]] == name:
                    del stack[i:]
                    break
                if tag_of[stack[i]] in ("table", "td", "th", "article", "main") and name not in BLOCK:
                    break
            continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                t = tag_of[stack[i]]
                if t == "p":
                    del stack[i:]
                    break
                if t in FENCE or t in ("td", "th", "button"):
                    break
        elif name in SAME:
            for i in range(len(stack) - 1, 0, -1):
                t = tag_of[stack[i]]
                if t in SAME[name]:
                    del stack[i:]
                    break
                if t in FENCE:
                    break
        node = dom.add(stack[-1], name, m[3])
        if name in VOID or m[3].endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            kids[node].append(source[at:close.start() if close else end])
            at = close.end() if close else end
            continue
        stack.append(node)
    return dom


# ------------------------------------------------------------------- wrappers
# A wrapper node is [label, text hash or 0 once it varied, pages, children].

def _digest(parts: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big") | 1


def slots(dom: Dom) -> tuple[list, dict[int, list]]:
    """The page as a wrapper of one page, and the slot of every element."""
    order, depth, seen = [], [0] * len(dom.tag), [0]
    while seen:  # parents before children
        n = seen.pop()
        order.append(n)
        for k in dom.kids[n]:
            if not isinstance(k, str):
                depth[k] = depth[n] + 1
                seen.append(k)
    texts: list[list[str]] = [[] for _ in dom.tag]
    trees: list[list] = [None] * len(dom.tag)
    members: dict[int, list] = {}  # id of a slot -> elements
    owner: dict[int, list] = {}
    for n in reversed(order):
        own = texts[n]
        kids: list = []
        for k in dom.kids[n]:
            if isinstance(k, str):
                t = " ".join(k.split())
                if t:
                    own.append(t)
                    if kids and kids[-1][0] == "#text":
                        kids[-1][1] = _digest([str(kids[-1][1]), t])
                    else:
                        kids.append(["#text", _digest([t]), 1, []])
                continue
            own += texts[k]
            tree = trees[k]
            if kids and kids[-1][0] == tree[0]:  # a run of like siblings is one repeated slot
                run = kids[-1]
                run[1] = _digest([str(run[1]), str(tree[1])])
                _fold_children(run, tree, members)
                members[id(run)] += members.pop(id(tree))
            else:
                kids.append(tree)
            trees[k] = None
            texts[k] = None
        if depth[n] >= MAX_DEPTH:
            kids = []
        trees[n] = [f"{dom.tag[n]} {dom.key[n]}", _digest(own), 1, kids]
        members[id(trees[n])] = [n]
    root = trees[0]
    walk = [root]
    while walk:
        s = walk.pop()
        for n in members.get(id(s), ()):
            owner[n] = s
        walk += s[3]
    return root, owner


def _weight(a: list, b: list) -> int:
    """Simple tree matching: pairs in the largest matching of two trees."""
    if a[0] != b[0]:
        return 0
    x, y = a[3], b[3]
    if not x or not y:
        return 1
    if [s[0] for s in x] == [s[0] for s in y]:
        return 1 + sum(map(_weight, x, y))
    row = [0] * (len(y) + 1)
    for p in x:
        last, row = row, [0]
        for j, q in enumerate(y):
            row.append(max(row[-1], last[j + 1], last[j] + _weight(p, q)))
    return 1 + row[-1]


def align(x: list, y: list) -> list[tuple[int, int]]:
    """Matched positions of two child lists under simple tree matching."""
    if [s[0] for s in x] == [s[0] for s in y]:
        return [(i, i) for i in range(len(x))]
    w = [[_weight(p, q) for q in y] for p in x]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + w[i][j])
    pairs, i, j = [], 0, 0
    while i < len(x) and j < len(y):
        if w[i][j] and best[i][j] == best[i + 1][j + 1] + w[i][j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return pairs


def _fold_children(run: list, tree: list, members: dict[int, list]) -> None:
    """Children of one more sibling of a run join the run's slots."""
    mine, more = run[3], tree[3]
    out, i, j = [], 0, 0
    for p, q in [*align(mine, more), (len(mine), len(more))]:
        out += mine[i:p] + more[j:q]
        if p < len(mine):
            a, b = mine[p], more[q]
            a[1] = _digest([str(a[1]), str(b[1])])
            _fold_children(a, b, members)
            if id(b) in members:
                members.setdefault(id(a), []).extend(members.pop(id(b)))
            out.append(a)
        i, j = p + 1, q + 1
    run[3] = out


def merge(wrapper: list, other: list) -> list:
    """Fold another wrapper (or page) in; equal slots stay constant, others vary."""
    wrapper[2] += other[2]
    if wrapper[1] != other[1]:
        wrapper[1] = 0
    mine, more = wrapper[3], other[3]
    out, i, j = [], 0, 0
    for p, q in [*align(mine, more), (len(mine), len(more))]:
        out += mine[i:p] + more[j:q]
        if p < len(mine):
            out.append(merge(mine[p], more[q]))
        i, j = p + 1, q + 1
    wrapper[3] = out
    return wrapper


def template_slots(page: list, wrapper: list) -> set[int]:
    """Ids of the page's slots that the wrapper holds constant."""
    constant: set[int] = set()
    if wrapper[1]:  # every page of the host has the same text: nothing to tell apart
        return constant
    todo = [(page, wrapper)]
    while todo:
        a, b = todo.pop()
        for p, q in align(a[3], b[3]):
            s, w = a[3][p], b[3][q]
            if w[1] and w[2] >= MIN_PAGES:
                constant.add(id(s))
            else:
                todo.append((s, w))
    return constant


# ----------------------------------------------------------------- extraction

def _blocks(dom: Dom, top: list[int], skip: set[int]) -> list[str]:
    """Text blocks below the elements ``top``, in page order."""
    blocks, current = [], []

    def flush():
        t = " ".join("".join(current).split())
        if t:
            blocks.append(t)
        current.clear()

    todo: list = list(reversed(top))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            current.append(x)
        elif x is None:
            flush()
        elif x not in skip:
            tag = dom.tag[x]
            if tag == "br":
                current.append(" ")
                continue
            if tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(dom.kids[x]))
    flush()
    return blocks


def extract(dom: Dom, template: set[int]) -> str:
    """Text of the article: ``template`` elements and marked parts are left out."""
    skip = {n for n, m in enumerate(dom.mark) if m}
    skip |= {n for n, t in enumerate(dom.tag) if t in ("title", "xmp", "noembed", "noframes")}
    # main regions in page order; header elements count as site headers outside them
    regions, todo = [], [0]
    while todo:
        n = todo.pop()
        if n in skip or n in dom.head:
            continue
        if dom.main[n]:
            regions.append(n)
            continue
        todo += [k for k in reversed(dom.kids[n]) if not isinstance(k, str)]
    inner = []
    for n in regions:  # <main> around an <article>: the article is the region
        found, todo = [], [n]
        while dom.tag[n] != "article" and todo:
            k = todo.pop()
            if k in skip:
                continue
            if dom.tag[k] == "article":
                found.append(k)
            else:
                todo += [x for x in reversed(dom.kids[k]) if not isinstance(x, str)]
        inner += found or [n]
    if not inner:
        skip |= dom.head
    text = "\n".join(_blocks(dom, inner or [0], skip | template))
    return text or ("\n".join(_blocks(dom, inner or [0], skip)) if template else text)


def page_text(source: str | None, wrapper: list | None) -> str:
    if not source:
        return ""
    dom = parse(source)
    if wrapper is None or wrapper[2] < MIN_PAGES:
        return extract(dom, set())
    page, owner = slots(dom)
    constant = template_slots(page, wrapper)
    return extract(dom, {n for n, s in owner.items() if id(s) in constant} if constant else set())


def host_of(url: str = "url"):
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)


def induce(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from (host, html)."""
    def fold(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        found: dict[str, list] = {}
        for batch in batches:
            for host, source in zip(one(batch.column(0)).to_pylist(), one(batch.column(1)).to_pylist(), strict=True):
                if source:
                    page = slots(parse(source))[0]
                    found[host] = merge(found[host], page) if host in found else page
        bucket = TaskContext.get().partitionId() % BUCKETS
        hosts = list(found)
        for i in range(0, len(hosts), 2000):
            part = hosts[i:i + 2000]
            yield pa.RecordBatch.from_pydict(
                {"host": pa.array(part, pa.string()), "bucket": pa.array([bucket] * len(part), pa.int32()),
                 "wrapper": pa.array([json.dumps(found[h]) for h in part], pa.string())})

    def meet(pdf):
        import pandas as pd
        tree = None
        for w in pdf["wrapper"]:
            tree = json.loads(w) if tree is None else merge(tree, json.loads(w))
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(tree)]})

    parts = pages.mapInArrow(fold, "host string, bucket int, wrapper string")
    parts = parts.groupBy("host", "bucket").applyInPandas(meet, "host string, wrapper string")
    return parts.groupBy("host").applyInPandas(meet, "host string, wrapper string")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every page.

    The join by host is a shuffle join; pages of a host are salted, and each
    salt gets a copy of the wrapper, so a host with a third of all pages is
    spread over tasks.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        text_of(html_col).alias("html"), host_of(url_col).alias("host"))
    id_type = rows.schema["id"].dataType.simpleString()
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)))
    wrappers = induce(rows.select("host", "html")).withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    joined = salted.join(wrappers, ["host", "salt"], "left").select("id", "url", "html", "wrapper")

    def make():
        known: dict[str, list] = {}

        def wrapper_of(w):
            if w is None:
                return None
            if w not in known:
                if len(known) >= 64:
                    known.clear()
                known[w] = json.loads(w)
            return known[w]

        def fn(batch):
            texts = [page_text(h, wrapper_of(w)) for h, w in
                     zip(one(batch.column(2)).to_pylist(), one(batch.column(3)).to_pylist(), strict=True)]
            return {"id": one(batch.column(0)), "url": one(batch.column(1)), "text": texts, "n_chars": list(map(len, texts))}
        return fn

    out = map_batches(joined, f"id {id_type}, url string, text string, n_chars long", make)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
