"""Main text of HTML pages with wrappers inferred per host.

A page becomes a stream of tokens: opening and closing block tags (with their
class and id words) and texts.  A *wrapper* is a union-free regular expression
over such streams: tags, text slots, optional groups ``( )?`` and repeated
groups ``( )+``.  It starts as one page's stream with neighbouring equal
groups folded into repeats; every further page of the host is aligned with it.
Where tags differ, the unmatched group becomes optional; where a group occurs
several times in a row, it becomes repeated; where texts differ, the text
becomes a slot.  Blocks of pages are aligned first and the wrappers so found
with one another, per (host, salt) and then per host, so a host's size does
not matter.

The wrapper decides which part of a host's pages is main text: its ``article``
groups whose text varies from page to page (an article that is the same on
every page is template), else its ``main`` groups, else the smallest part that
holds nearly all of the varying text.  Outside articles, texts that are the
same on every page of the host are template and left out.  A page without any
of its host's parts is read by a wrapper of its own.  Elements go when they
are by tag or role a menu, header, footer, sidebar, form or dialog, when they
are hidden, or when they are containers (never headings or paragraphs) whose
whole class or id names such a part, an advert, a notice or reader comments.

Pages are read in time linear in their length and walked without recursion.
A wrapper tells elements apart down to ``DEPTH`` levels; what is nested deeper
counts for the element there (its text is extracted all the same).

Defined cases: a null or empty html gives an empty text; a page without a host
in its url shares the wrapper of the empty host; unclosed and stray tags,
comments and scripts that never end are allowed (a quoted value that never
ends makes quotes plain characters from there on); repeated rows give the same
text each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from html import unescape
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_join

MIN_PAGES = 3                    # pages that show a text to be template text
PART = 0.9                       # of the varying text that the main part holds
DEPTH = 60                       # levels of elements that a wrapper tells apart
FAN_IN = 16                      # wrappers of a host that one task merges

# fixed values: names from the HTML standard and usual class names
INLINE = frozenset("a abbr acronym audio b bdi bdo big br canvas cite code data del dfn em font i img ins kbd map mark object "
                   "picture q rb rp rt ruby s samp small span strike strong sub sup time tt u var video wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe noembed noframes textarea title".split())
FOREIGN = frozenset("math svg".split())
BREAKS_OUT = frozenset("article aside blockquote body div dl dt dd footer form h1 h2 h3 h4 h5 h6 head header li main nav ol p pre "
                       "section table ul".split())
SKIP = frozenset("aside button datalist dialog fieldset footer form input menu nav noscript select template".split())
CONTAINERS = frozenset("article center details div dl figure header iframe li main ol section table ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = frozenset("nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer foot masthead "
                  "banner ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted "
                  "notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription "
                  "signup login share sharing social related recommended recommendations widget widgets pagination "
                  "pager alert disclaimer".split())
COMMENTS = frozenset("comment comments commentlist disqus respond replies".split())
NEUTRAL = frozenset("area articles bar block bottom box buttons container content div form global group header inner item items "
                    "left left links list main page panel posts primary reader readers right row secondary section site slot "
                    "thread title top unit user users wrap wrapper".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
CLOSED_THROUGH = frozenset("p li dt dd tr td th option".split())

NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)")
UNQUOTED = re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element: its tag, signature, flag and kids (elements and texts), its
    path of signatures, and whether it holds an article or main part."""
    __slots__ = ("tag", "sig", "flag", "kids", "parent", "depth", "path", "holds")

    def __init__(self, tag, sig, flag, parent):
        self.tag, self.sig, self.flag, self.parent, self.kids, self.holds = tag, sig, flag, parent, [], False
        self.depth = parent.depth + 1 if parent else 0
        self.path = "" if parent is None else f"{parent.path}/{sig}" if self.depth <= DEPTH else parent.path


def _named(name: str, words: frozenset) -> bool:
    """Whether a whole class or id names one of ``words``: it has one of them
    and besides only such and neutral words."""
    parts = [w.lower() for w in NAME_PART.findall(name)]
    return not words.isdisjoint(parts) and all(w in words or w in NEUTRAL or w in WORDS or len(w) == 1 for w in parts)


def _marks(tag: str, attributes: str) -> tuple[str, str]:
    """A tag's signature and its flag: '' (text), 'skip', 'header', 'named' or
    'comment'."""
    flag = "skip" if tag in SKIP else "header" if tag == "header" else ""
    names = set()
    if attributes and not attributes.isspace():
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                for name in value.split():
                    words = [w.lower() for w in NAME_PART.findall(name)]
                    names.update(words)
                    if tag not in CONTAINERS:
                        continue
                    if _named(name, COMMENTS):
                        flag = "comment"
                    elif not flag and _named(name, WORDS):
                        flag = "named"
                    elif not flag and words and words[-1] == "header" and tag != "section":
                        flag = "header"
            elif key == "role" and value.lower() in ROLES:
                flag = flag or "skip"
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (
                    key == "style" and NOT_SHOWN.search(value)):
                flag = flag or "skip"
    return tag + "".join("." + w for w in sorted(names)), flag


def tokens(html: str):
    """Texts and tags of a page: ``(text, None, None, None)`` and ``(None, tag,
    closing, attributes)``.  Every character is read a bounded number of
    times."""
    at, end, last = 0, len(html), html.rfind(">")
    quotes = True
    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            yield html[at:], None, None, None
            return
        if lt > at:
            yield html[at:lt], None, None, None
        at = lt + 1
        if html.startswith("!--", at):
            stop = html.find("-->", at + 1)
            if stop < 0:
                return
            at = stop + 3
            continue
        name = NAME.match(html, at) if html[at:at + 1] not in ("!", "?") else None
        if at > last or (name is None and html[at:at + 1] not in ("!", "?")):
            yield "<", None, None, None
            continue
        if name is None:
            at = html.index(">", at) + 1
            continue
        stop = begin = name.end()
        while quotes:
            stop = UNQUOTED.match(html, stop).end()
            if stop < end and html[stop] == ">":
                break
            stop = html.find(html[stop], stop + 1) + 1 if stop < end else 0
            quotes = stop > 0
        if not quotes:
            stop = html.find(">", begin)
            if stop < 0:
                yield "<", None, None, None
                continue
        tag, closing, attributes = name[1].lower(), html[at] == "/", html[begin:stop]
        yield None, tag, closing, attributes
        at = stop + 1
        if tag in RAW and not closing and not attributes.endswith("/"):
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = html.find(">", close.end()) + 1 if close else 0
            if not at:
                return


def parse(html: str) -> Node:
    """The blocks of a page as a tree; text kids are strings, white space
    already one space and trimmed."""
    root = node = Node("", "", "", None)
    texts: list[str] = []
    open_tags: dict[str, int] = {}
    known: dict[tuple[str, str], tuple[str, str]] = {}
    foreign = None                                       # the open svg or math element

    def flush():
        text = " ".join(unescape("".join(texts)).split())
        texts.clear()
        if text:
            node.kids.append(text)

    def leave(up):
        nonlocal node
        while node is not up:
            open_tags[node.tag] -= 1
            node = node.parent

    for text, tag, closing, attributes in tokens(html):
        if tag is None:
            texts.append(text)
            continue
        if foreign:
            if closing and tag == foreign:
                foreign = None
                continue
            if tag not in BREAKS_OUT:
                continue
            foreign = None
        if tag in FOREIGN:
            foreign = None if closing or attributes.endswith("/") else tag
            continue
        if tag in INLINE:
            if tag == "br":
                texts.append(" ")
            continue
        if closing:
            flush()
            if open_tags.get(tag):
                up = node
                while up.tag != tag:
                    up = up.parent
                leave(up.parent)
            continue
        if tag in RAW:
            continue
        flush()
        if tag in ("html", "head", "body"):
            continue
        if node.tag == "p":                              # end tags that may be left out
            leave(node.parent)
        if tag in CLOSES:
            up = seek = node
            while seek.tag in CLOSED_THROUGH:
                if seek.tag in CLOSES[tag]:
                    up = seek.parent
                seek = seek.parent
            leave(up)
        if tag in VOID or attributes.endswith("/"):
            continue
        marks = known.get((tag, attributes))
        if marks is None:
            marks = known[tag, attributes] = _marks(tag, attributes)
        child = Node(tag, *marks, node)
        node.kids.append(child)
        node = child
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if tag in ("article", "main") and child.flag != "comment":
            up = child.parent
            while up is not None and not up.holds:
                up.holds, up = True, up.parent
    flush()
    return root


def dropped(node: Node, inside: bool) -> bool:
    """Whether an element is no main text; ``inside``: in an article."""
    flag = node.flag
    if not flag:
        return False
    if flag in ("skip", "comment"):
        return True
    if node.tag in ("article", "main"):
        return False
    return not (flag == "header" and inside) and not node.holds


def walk(node: Node):
    """Texts below a node in page order with the elements that hold them, less
    dropped elements."""
    stack = [(node, node.tag in ("article", "main"), iter(node.kids))]
    while stack:
        at, inside, kids = stack[-1]
        for kid in kids:
            if isinstance(kid, str):
                yield at, kid
            elif not dropped(kid, inside):
                stack.append((kid, inside or kid.tag in ("article", "main"), iter(kid.kids)))
                break
        else:
            stack.pop()


# ---------------------------------------------------------------- wrappers
# [signature, pages, text mark, varying characters, kids]; a kid is
# [wrapper, optional, repeated]; texts have the signature "#".

SLOT = -1


def _aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of equal groups in both orders: a group's n-th occurrence meets
    the n-th of the other side, and of these pairs the longest rising series
    stays.  It takes n log n steps at any size."""
    place: dict[tuple, int] = {}
    seen: dict[str, int] = {}
    for j, kid in enumerate(b):
        seen[kid[0][0]] = n = seen.get(kid[0][0], 0) + 1
        place[kid[0][0], n] = j
    pairs, ends, last, seen = [], [], [], {}
    for i, kid in enumerate(a):
        seen[kid[0][0]] = n = seen.get(kid[0][0], 0) + 1
        j = place.get((kid[0][0], n))
        if j is not None:
            at = bisect_left(ends, j)
            pairs.append((i, j, last[at - 1] if at else -1))
            ends[at:at + 1], last[at:at + 1] = [j], [len(pairs) - 1]
    out, at = [], last[-1] if last else -1
    while at >= 0:
        out.append(pairs[at][:2])
        at = pairs[at][2]
    return out[::-1]


def _merge_kids(a: list, b: list, repeat: bool = False, sure: bool = False) -> list:
    """Two sequences of groups as one: aligned groups merge, the others become
    optional."""
    if [k[0][0] for k in a] == [k[0][0] for k in b]:
        return [[_merge(x[0], y[0], repeat, sure), x[1] or y[1], x[2] or y[2]] for x, y in zip(a, b)]
    out, i, j = [], 0, 0
    for x, y in [*_aligned(a, b), (len(a), len(b))]:
        out += [[k[0], True, k[2]] for k in (*a[i:x], *b[j:y])]
        if x < len(a):
            out.append([_merge(a[x][0], b[y][0], repeat, sure), a[x][1] or b[y][1], a[x][2] or b[y][2]])
        i, j = x + 1, y + 1
    return _fold(out)


def _merge(a: list, b: list, repeat: bool = False, sure: bool = False) -> list:
    """Two wrappers with one signature as one; ``repeat``: neighbours on one
    page.  Texts that differ become a slot, but those of repeats that no page
    lacks (``sure``) get a common mark: they may be the same on every page."""
    mark = a[2] if a[2] == b[2] else SLOT
    if mark != a[2] and repeat and sure and SLOT not in (a[2], b[2]):
        mark = crc32(b"%d %d" % (a[2], b[2]))
    return [a[0], max(a[1], b[1]) if repeat else a[1] + b[1], mark, a[3] + b[3],
            _merge_kids(a[4], b[4], repeat, sure) if a[4] or b[4] else []]


def _fold(kids: list) -> list:
    """Neighbouring equal groups of one to three kids become repeats."""
    for width in (1, 2, 3):
        out: list = []
        i = 0
        while i < len(kids):
            last, group = out[-width:], kids[i:i + width]
            if len(last) == len(group) == width and all(x[0][0] == y[0][0] for x, y in zip(last, group)):
                out[-width:] = [[_merge(x[0], y[0], True, not (x[1] or y[1])), x[1] or y[1], True]
                                for x, y in zip(last, group)]
                i += width
            else:
                out.append(kids[i])
                i += 1
        kids = out
    return kids


def wrapper_of(root: Node) -> list:
    """The wrapper of one page, without dropped parts."""
    top: list = [root.sig, 1, 0, 0, []]
    made = {id(root): top}

    def group(node):
        chain = []
        while id(node) not in made:
            chain.append(node)
            node = node.parent
        w = made[id(node)]
        for node in reversed(chain):
            if node.depth <= DEPTH:
                inner = [node.sig, 1, 0, 0, []]
                w[4].append([inner, False, False])
                w = inner
            made[id(node)] = w
        return w

    for node, text in walk(root):
        group(node)[4].append([["#", 1, crc32(text.encode(errors="surrogatepass")), len(text), []], False, False])

    def folded(w):
        for kid in w[4]:
            folded(kid[0])
        w[4] = _fold(w[4])
        return w

    return folded(top)


def merge(wrappers: list[list]) -> list:
    out = wrappers[0]
    for w in wrappers[1:]:
        out = _merge(out, w)
    return out


def expression(wrapper: list, optional: bool = False, repeated: bool = False) -> str:
    """A wrapper as a regular expression over tokens, for reading."""
    if wrapper[0] == "#":
        body = "#" if wrapper[2] == SLOT else "text"
    else:
        inner = " ".join(expression(*k) for k in wrapper[4])
        body = f"<{wrapper[0]}> {inner} </>" if wrapper[0] else inner
    mark = ("*" if optional else "+") if repeated else ("?" if optional else "")
    return f"({body}){mark}" if mark else body


def rules(wrapper: list) -> tuple[list[str], list[str]]:
    """What extraction needs of a wrapper: the places of template texts (path
    and text mark) and the paths of the main parts."""

    def size(w, slots_only=True):
        """Characters of the varying (or all) texts."""
        if w[0] == "#":
            return w[3] if w[2] == SLOT or not slots_only else 0
        return sum(size(k[0], slots_only) for k in w[4])

    slots = size(wrapper) > 0                        # nothing varies in copies of one page: all counts

    def tagged(w, path, tag, out):
        """The topmost groups of a tag that hold varying text."""
        for kid, _, _ in w[4]:
            if kid[0].split(".")[0] == tag and size(kid, slots):
                out.append((f"{path}/{kid[0]}", kid))
            elif kid[0] != "#":
                tagged(kid, f"{path}/{kid[0]}", tag, out)
        return out

    parts = tagged(wrapper, "", "article", [])
    if parts:
        return [], sorted({p for p, _ in parts})
    parts = tagged(wrapper, "", "main", [])
    if not parts:
        total, path, at = size(wrapper, slots), "", wrapper
        while True:
            inner, i = max(((size(k[0], slots), i) for i, k in enumerate(at[4]) if k[0][0] != "#"), default=(0, 0))
            if not inner or inner < PART * total or at[4][i][2]:
                break
            at = at[4][i][0]
            path = f"{path}/{at[0]}"
        parts = [(path, at)]
    fixed: dict[str, int] = {}

    def template(w, path):
        for kid, _, _ in w[4]:
            if kid[0] != "#":
                template(kid, f"{path}/{kid[0]}")
            elif kid[2] != SLOT and kid[1] >= max(MIN_PAGES, wrapper[1]):
                fixed[f"{path}#{kid[2]}"] = kid[3]

    for path, w in parts:
        template(w, path)
    # near copies of one page differ in little: what they share is no template
    if sum(fixed.values()) > sum(size(w) for _, w in parts):
        fixed.clear()
    return sorted(fixed), sorted({p for p, _ in parts})


# -------------------------------------------------------------- extraction

def _parts(root: Node, paths) -> list[Node]:
    """The topmost elements with one of the paths, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.path in paths:
            out.append(node)
        else:
            stack += [k for k in reversed(node.kids) if not isinstance(k, str) and k.depth <= DEPTH and not dropped(k, False)]
    return out


def main_text(html: str, fixed=frozenset(), paths=()) -> str:
    """The main text of a page by its host's rules, blocks joined by newline."""
    root = parse(html)
    found = _parts(root, paths)
    if not found:
        fixed, paths = rules(wrapper_of(root))
        found = _parts(root, paths)
    texts = [(node, text) for part in found for node, text in walk(part)]
    return "\n".join(t for n, t in texts if not fixed or f"{n.path}#{crc32(t.encode(errors='surrogatepass'))}" not in fixed)


# ------------------------------------------------------------------- Spark

def host(url="url"):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def infer(pages: DataFrame) -> DataFrame:
    """``(host, fixed, parts)`` per host, a written table.  A host's wrappers
    merge in a tree: ``FAN_IN`` at a time until that many are left."""

    def first(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                by_host: dict[str, list] = {}
                for h, html in zip(part["host"].to_pylist(), part["html"].to_pylist()):
                    if html:
                        w = wrapper_of(parse(html))
                        by_host[h] = _merge(by_host[h], w) if h in by_host else w
                yield pa.record_batch([pa.array(list(by_host), pa.string()),
                                       pa.array([json.dumps(w) for w in by_host.values()], pa.string())],
                                      names=["host", "wrapper"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        w = merge([json.loads(x) for x in pdf["wrapper"].sort_values()])
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(w)]})

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        found = rules(merge([json.loads(x) for x in pdf["wrapper"].sort_values()]))
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "rules": [json.dumps(found)]})

    some = materialize(pages.select(host().alias("host"), "html").mapInArrow(first, "host string, wrapper string"), "html-wrappers")
    while True:
        per = some.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") > FAN_IN)
        per = materialize(per.withColumn("width", F.ceil(F.col("n") / FAN_IN)), "html-hosts")
        if per.isEmpty():
            break
        number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("width", F.lit(1)))
        dealt = small_join(some, per.drop("n"), ["host"], "left").withColumn("part", number)
        some = materialize(dealt.groupBy("host", "part").applyInPandas(join, "host string, wrapper string"), "html-wrappers")
    return materialize(some.groupBy("host").applyInPandas(finish, "host string, rules string"), "html-rules")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""

    def run(batches):
        known: dict[str | None, tuple] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                out = []
                for html, found in zip(part["html"].to_pylist(), part["rules"].to_pylist()):
                    marks = known.get(found)
                    if marks is None:
                        if len(known) > 1000:
                            known.clear()
                        marks = known[found] = tuple(frozenset(x) for x in json.loads(found or "[[], []]"))
                    out.append(main_text(html or "", *marks))
                yield pa.record_batch([part["page_id"], part["url"], pa.array(out, pa.string()),
                                       pa.array([len(t) for t in out], pa.int64())],
                                      names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host().alias("host"))
    rows = small_join(rows, infer(pages), ["host"], "left").select("page_id", "url", "html", "rules")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
