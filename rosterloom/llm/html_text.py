"""Main text of web pages by consensus of their hosts.

Each page scores its containers and votes for their generalised paths (tags with
classes, without numbers). The votes of a host are added up in Spark, and every
page of the host is extracted again from the winning path; a page without it uses
its own best container. A page damaged or cut short is thus read where the
others of its host have their text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.llm.common import cut, mapped, slices

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes xmp".split())
_END = {name: re.compile(rf"</{name}(?=[\s>/])", re.I) for name in RAW}
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Containers that may hold the main text.
HOLDER = frozenset("article main section div td body center table".split())
#: Elements that never belong to it.
NEVER = frozenset("script style noscript template iframe svg canvas head title object embed audio video map textarea".split())
OUTSIDE = frozenset("nav header footer aside form script style noscript template iframe svg canvas button select option textarea input object embed audio video map menu dialog head title label".split())
#: Names of parts that never belong to it: of a class or id as a whole, at its end, or at the start of two.
_BAD = frozenset(
    "ad ads advert adverts advertisement advertisements adbox adsense sponsor sponsored banner banners promo promos promotion comment comments commentlist replies reply disqus respond "
    "sidebar sidebars side widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer footers header headers masthead topbar cookie cookies consent gdpr notice notices "
    "alert alerts popup popups modal modals overlay overlays newsletter newsletters subscribe subscription signup login share sharing social related recommended pagination pager toolbar "
    "copyright legal disclaimer hidden skip search".split()
)
#: A name that starts so says something about the element, not what it is; an article's own header belongs to the article.
_ABOUT, _OWN, _HEADER = frozenset("has no not with without".split()), frozenset("post entry article story content".split()), frozenset(("header", "headers"))
_GOOD = re.compile(r"(?:^|[\s_-])(?:article|content|entry|post|story|main|text|body)(?:$|[\s_-])", re.I)
_DIGITS, _JOINT = re.compile(r"\d+"), re.compile(r"[-_:]+")


def _is_bad(value: str) -> bool:
    """Whether a class, id or role names a part that isn't main text."""
    for token in value.lower().split():
        parts = [p for p in _JOINT.split(_DIGITS.sub("", token)) if p]
        if not parts or parts[0] in _ABOUT or parts[0] in _OWN and parts[-1] in _HEADER:
            continue
        if parts[-1] in _BAD or len(parts) == 2 and parts[0] in _BAD:
            return True
    return False


#: Tags that an opening one ends if they are still open (no holder between).
_ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_STOPS = frozenset("ul ol dl table div article section main body td th".split())


class Node:
    __slots__ = ("tag", "path", "own", "bad", "parent", "words", "linked", "good")

    def __init__(self, tag: str, path: str, own: bool, good: bool, parent: Node | None):
        self.tag, self.path, self.own, self.good, self.parent = tag, path, own, good, parent
        #: it, or what it stands in, is no main text
        self.bad = own or bool(parent and parent.bad)
        self.words = self.linked = 0


def _node(tag: str, source: str, parent: Node | None) -> Node:
    label, bad, good = tag, tag in OUTSIDE, tag in ("article", "main")
    if " " in source or "\n" in source or "\t" in source:
        classes = ""
        for name, a, b, c in _ATTRIBUTE.findall(source):
            name, value = name.lower(), html.unescape(a or b or c)
            if name in ("class", "id", "role"):
                bad = bad or tag not in ("html", "body") and _is_bad(value)
                good = good or bool(_GOOD.search(value))
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                bad = bad or tag not in ("html", "body")
            if name == "class":
                classes = ".".join(sorted(re.sub(r"\d+", "", value).lower().split()))
        if classes:
            label = f"{tag}.{classes}"
    return Node(tag, f"{parent.path}/{label}" if parent else label, bad, good, parent)


def _walk(page: str) -> Iterator[tuple[Node, str | None]]:
    """(element, text) for each run of text and (element, None) for each border of a block."""
    top = Node("", "", False, False, None)
    stack, skip = [top], None
    at = 0
    while at < len(page):
        if skip is not None:
            # what a raw element holds is no markup: only its own end counts
            end = _END[skip].search(page, at)
            skip = None
            if not end:
                break
            at = end.start()
        m = _TOKEN.match(page, at)
        token, at = m.group(), m.end()
        if token[0] != "<" or token == "<":
            yield stack[-1], token
            continue
        tag = _TAG.match(token)
        if not tag or token[-1] != ">":
            continue
        name = tag[2].lower()
        if tag[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
            if name in BLOCK:
                yield stack[-1], None
            continue
        ends = _ENDS.get(name) or ({"p"} if name in BLOCK else None)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                    if name not in ("tr", "td", "th"):
                        break
                elif stack[i].tag in _STOPS and not (name == "tr" and stack[i].tag in ("td", "th")):
                    break
        if name == "br":
            yield stack[-1], " "
        elif name in BLOCK or name not in VOID:
            node = _node(name, token, stack[-1])
            if name in BLOCK:
                yield node, None
            if name in RAW:
                skip = name
            elif name not in VOID and not token.endswith("/>"):
                stack.append(node)


#: Of a page's words, those that must be left outside of an element for it to be taken as no main text.
LEAST_LEFT = 0.1


def walk(page: str) -> list[tuple[Node, str | None]]:
    """``_walk``, with references decoded run by run. A container or form that holds
    nearly all words of the page is its text, whatever it is called."""
    walked = [(node, None if text is None else html.unescape(text)) for node, text in _walk(page)]
    while True:
        total, outer = 0, {}
        for node, text in walked:
            if text is None:
                continue
            n, top, at = len(text.split()), None, node
            while at is not None:
                if at.own:
                    top = at
                at = at.parent
            if n and not (top and top.tag in NEVER):
                total += n
                if top and (top.tag in HOLDER or top.tag == "form"):
                    outer[id(top)] = (top, outer.get(id(top), (top, 0))[1] + n)
        most = max(outer.values(), key=lambda x: x[1], default=None)
        if not most or most[1] < (1 - LEAST_LEFT) * total or total == 0:
            return walked
        most[0].own = False
        for node, _ in walked:
            chain = []
            while node is not None:
                chain.append(node)
                node = node.parent
            for at in reversed(chain):
                at.bad = at.own or bool(at.parent and at.parent.bad)


def containers(page: str | list) -> list[tuple[str, float]]:
    """Paths that may hold the page's main text, with scores, best first. A holder
    (the page itself is one) counts the words of its paragraphs, all of them near and
    half of them through each holder between, less those in links."""
    found: dict[str, float] = {}
    live: dict[int, Node] = {}
    for node, text in walk(page) if isinstance(page, str) else page:
        if text is None or node.bad:
            continue
        n = len(text.split())
        if not n:
            continue
        share, link, at = 1.0, False, node
        while at is not None:
            link = link or at.tag == "a"
            if at.tag in HOLDER or at.parent is None:
                if id(at) not in live:
                    live[id(at)] = at
                    at.words = at.linked = 0
                at.words += n * share
                at.linked += n * share * link
                share *= 0.5
            at = at.parent
    for at in live.values():
        score = (at.words - 2 * at.linked) * (1.5 if at.good else 1.0)
        if score > 0:
            found[at.path] = found.get(at.path, 0.0) + score
    return sorted(found.items(), key=lambda x: (-x[1], x[0]))


def extract(page: str, path: str | None = None) -> str:
    """The text of all elements at ``path`` (or of the page's best container):
    blocks in page order, parted by an empty line."""
    walked = walk(page)
    inside = lambda n, path: n.path == path or n.path.startswith(path + "/")
    if path is None or not any(text and not node.bad and inside(node, path) and text.strip() for node, text in walked):
        best = containers(walked)
        if not best:
            return ""
        path = best[0][0]
    blocks, run = [], []

    def end() -> None:
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    for node, text in walked:
        if text is None:
            end()
        elif not node.bad and inside(node, path):
            run.append(text)
    end()
    return "\n\n".join(blocks)


HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
#: Hosts up to which the winning paths are broadcast; more are joined by shuffle.
MOST_BROADCAST = 100_000


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        sums: dict[tuple[str, str], float] = {}
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            best = containers(page or "")[:3]
            for path, score in best:
                # a page's votes add up to one at most, so that no long page outvotes the others
                sums[host, path] = sums.get((host, path), 0.0) + score / best[0][1] / len(best)
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.string()), pa.array([sums[k] for k in keys], pa.float64())], ["host", "path", "votes"])


def winners(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host of ``pages`` (host, html)."""
    votes = mapped(pages.select("host", "html"), _votes, "host string, path string, votes double")
    sums = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    first = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    return sums.withColumn("_n", first).where("_n = 1").select("host", "path")


def main_text(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html and any others) with ``text string`` in place of html
    and ``n_chars long``. A null or empty html has the empty text; pages without a
    host in their url vote together; repeated rows are pages of their own; columns
    of the two names are replaced, others pass through, whatever their names; an
    empty table gives an empty result."""
    rest = [f for f in pages.schema.fields if f.name not in ("html", "text", "n_chars")]
    # columns are numbered, so that no name can clash with those used here
    host = F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit(""))
    rows = pages.select(*(F.col(f.name).alias(f"c{i}") for i, f in enumerate(rest)), "html", host.alias("host"))
    best = cut(winners(rows))
    best = F.broadcast(best) if best.count() <= MOST_BROADCAST else best
    rows = rows.join(best, "host", "left").select(*(f"c{i}" for i in range(len(rest))), "html", "path")
    schema = T.StructType([*rest, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [extract(h or "", p) for h, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return mapped(rows, run, schema)
