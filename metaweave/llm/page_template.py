"""Main text of pages by deducing the template of their host from equivalence classes of tokens.

A token is a tag or a word together with its path of elements. Its occurrence vector says how
often it occurs in each page of a host. Tokens with equal vectors form an equivalence class; a class is
valid if its tokens occur in ``min_share`` of the pages (empty ones not counted) of a host of at least
``min_pages`` different pages and it has at least ``min_class`` of them. The valid classes of single
occurrences are the root of the template, in the order of the page that has most of them; the others (such as the
parts of list entries) are nested: between two root tokens of a page they have to repeat in one order.
What is left between template tokens are the slots.

Vectors are never collected: a token's vector is a 64-bit signature, the exclusive or of a hash
of (page, count) over its pages, so that classes come from grouping by signature. A first pass finds the tokens
that can have the support: one that has the share of a host's pages has it in the pages of some task, and
what tasks left out is bounded by what they say. The second pass counts these tokens exactly. One row a
token and task is shuffled, however many pages a host has.

Place tells menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles (by element, role,
and names of class and id) and the article or main element. Such an inline element takes out its own text only, and what holds the only
article is not judged. The template decides on what place leaves open: all blocks of a page without an article and, inside
articles, blocks of links and those that only an id marks. Such a block goes if all its words are template tokens in their place, and
is kept whole if it has a slot. Other blocks of an article stay, also if every page has them.

Defined results: a NULL page or one without text gives empty text. A NULL url is a host of its own. A host of few or of
equal pages has no template; its pages are cut by place alone. Unclosed elements end with their container.
Repeated rows are pages of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_narrow, saved, with_place

MIN_PAGES = 10
MIN_CLASS = 3
MIN_SHARE = 0.9  # of the pages of a host that have words
_FLUSH = 400_000
WEAK, STRONG = 1, 2  # signs of what is not main
DROP, KEEP, ASK = 0, 1, 2  # verdicts on blocks

#: Fixed values of HTML: elements that start a block, that have no content, whose content is no text.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript template iframe noframes xmp title".split())
#: Elements, roles and whole names of class or id that mark what is not the article.
NOT_MAIN_ELEMENTS = frozenset("nav header footer aside form head title button select option dialog menu canvas object".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
NOT_MAIN_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar tooltip widget".split())
#: Words that stand before or behind those in a compound name (site-footer, related-posts).
PLACE_WORDS = frozenset("site main top bottom left right primary secondary global sub side mobile desktop sticky".split())
HOLDER_WORDS = frozenset("area articles bar block body box btn button buttons container content entry form holder icons inner item items links list message meta panel posts section slot stories text thread title toggle unit wrap wrapper".split())
#: Names that mark reader comments, and ids that name no topic of an article.
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
OWN_IDS = frozenset("ad ads advert adverts advertisement comment comments commentlist disqus disqus_thread respond sidebar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S)
_RAW_END = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for x in RAW}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"\s(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PARTS = re.compile(r"[-_]+|(?<=[a-z0-9])(?=[A-Z])")
_SVG = re.compile(r"<(/?)svg(?=[\s/>])[^>]*>", re.I)
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)"


@lru_cache(maxsize=20_000)
def _name(tag: str) -> str:
    return _NAME.match(tag).group(1).lower()


def _not_main_name(name: str) -> bool:
    """Whether a name of class or id is made of a word of what is not main, with words of place before and of holders behind it at most."""
    parts = [x.lower() for x in _PARTS.split(name) if x and not x.isdigit()]
    first = next((i for i, x in enumerate(parts) if x not in PLACE_WORDS), len(parts))
    rest = first
    while rest < len(parts) and parts[rest] in NOT_MAIN_WORDS:
        rest += 1
    return rest > first and all(x in HOLDER_WORDS for x in parts[rest:])


@lru_cache(maxsize=20_000)
def _element(tag: str) -> tuple[str, str, int, bool]:
    """Name, signature (name, class, id), whether it is not main (WEAK: only an id that may name a topic says so), whether it is the main part, of an opening tag."""
    name = _NAME.match(tag).group(1).lower()
    said = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(tag)} if " " in tag or "\n" in tag or "\t" in tag else {}
    classes, ids = said.get("class", "").split(), said.get("id", "").split()
    role = said.get("role", "").lower()
    hidden = "hidden" in said or said.get("aria-hidden", "").lower() == "true" or "display:none" in said.get("style", "").replace(" ", "").lower()
    main = name == "main" or role == "main"
    if name == "article" or role == "article":  # blog software marks comments as articles too
        main = not any(w.lower().split("-")[0] in COMMENT_WORDS and _not_main_name(w) for w in classes + ids)
    out = 0
    if hidden or name in NOT_MAIN_ELEMENTS or role in NOT_MAIN_ROLES:
        out = STRONG
    elif name not in ("html", "body"):
        if any(_not_main_name(w) for w in classes) or any(w.lower() in OWN_IDS for w in ids):
            out = STRONG
        elif any(_not_main_name(w) for w in ids):
            out = WEAK
    return name, f"{name}.{said.get('class', '')}#{said.get('id', '')}", out, main


class Open(NamedTuple):
    """An open element."""

    name: str
    path: str
    chain: tuple  # of the elements around it and itself that are not main or the main part: number, name, out, main
    kind: str  # the nearest block element
    link: bool
    apart: bool  # an inline element that is not main
    around: Block | None  # the block that was open before it


class Block:
    """Text between two block boundaries: its path, the elements around it that mark or hold the main part, and its nearest block element."""

    __slots__ = ("path", "chain", "kind", "parts", "linked", "own")

    def __init__(self, path: str, chain: tuple, kind: str):
        self.path, self.chain, self.kind, self.parts, self.linked, self.own = path, chain, kind, [], True, None

    def text(self) -> str:
        if self.own is None:  # asked for once the page is read
            self.own = " ".join(unescape("".join(self.parts)).split())
        return self.own


def _behind_svg(html: str, at: int) -> int:
    """Where a drawing ends that begins before ``at``; -1 if it does not."""
    depth = 1
    for x in _SVG.finditer(html, at):
        if not x.group().endswith("/>"):
            depth += -1 if x.group(1) else 1
            if not depth:
                return x.end()
    return -1


def parse(html: str | None) -> tuple[list[Block], list[tuple[str, int]]]:
    """The blocks of a page in order, and its tags with their paths and the number of blocks begun before."""
    stack: list[Open] = []
    blocks: list[Block] = []
    tags: list[tuple[str, int]] = []
    now: Block | None = None  # the block that is open
    html, behind, drawings = html or "", 0, True
    while behind < len(html):
        if html[behind] != "<":
            end = html.find("<", behind)
            t = html[behind:end] if end >= 0 else html[behind:]
        else:
            t = _TOKEN.match(html, behind).group()
        behind += len(t)
        if t[0] != "<" or t == "<":
            if now is None and not t.isspace():
                now = Block(stack[-1].path, stack[-1].chain, stack[-1].kind) if stack else Block("", (), "")
                blocks.append(now)
            if now is not None:
                now.parts.append(t)
                if now.linked and not (stack and stack[-1].link) and not t.isspace():
                    now.linked = False
            continue
        if t[1] in "!?":
            continue
        name = _name(t)
        if t[1] == "/":
            at = len(stack) - 1
            while at >= 0 and stack[at].name != name:
                at -= 1
            if at >= 0:
                tags.append((stack[at].path + "/", len(blocks)))
                # behind an inline element that is not main, the block around it goes on
                now = next((x.around for x in stack[at:] if x.apart), now)
                del stack[at:]
            if name in BLOCKS:
                now = None
            continue
        if name == "br":
            if now is not None:
                now.parts.append(" ")
            continue
        if name in BLOCKS and name not in RAW:
            now = None
            for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph, an entry the entry before
                if stack[i].name == "p" or stack[i].name == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    del stack[i:]
                    break
                if stack[i].name in BLOCKS:
                    break
        _, sign, out, main = _element(t)
        path = f"{stack[-1].path}>{sign}" if stack else sign
        tags.append((path, len(blocks)))
        if name in RAW:
            if not t.endswith("/>"):  # its content is no text: go on behind its own end tag, whatever lies between
                end = _RAW_END[name].search(html, behind)
                behind = end.end() if end else len(html)
        elif name == "svg":
            if drawings and not t.endswith("/>"):
                end = _behind_svg(html, behind)
                behind, drawings = max(end, behind), end >= 0
        elif name not in VOID and not (t.endswith("/>") and name not in BLOCKS):
            chain = stack[-1].chain if stack else ()
            if out or main:
                chain = (*chain, (len(tags), name, out, main))
            kind = name if name in BLOCKS else stack[-1].kind if stack else ""
            apart = out > WEAK and name not in BLOCKS
            stack.append(Open(name, path, chain, kind, name == "a" or bool(stack) and stack[-1].link, apart, now))
            if apart:
                now = None
    return blocks, tags


def judge(blocks: list[Block]) -> list[int]:
    """For every block DROP, KEEP, or ASK (it goes if the template has all its words).

    If every main part lies in something that is not main, what holds the largest of them is not judged.
    """
    mains = {c: next((i for i, x in enumerate(c) if x[3]), len(c)) for c in {b.chain for b in blocks}}
    below = {c: any(x[2] > WEAK for x in c[at + 1 :]) for c, at in mains.items()}
    sizes: Counter = Counter()  # by main part, and what holds it that is not main
    for b in blocks:
        at = mains[b.chain]
        if at < len(b.chain) and not below[b.chain]:
            sizes[b.chain[at][0], tuple(x[0] for x in b.chain[: at + 1] if x[2])] += len(b.text())
    sizes = +sizes
    spared: tuple = ()
    if sizes and all(holders for _, holders in sizes):
        spared = max((n, -m, holders) for (m, holders), n in sizes.items())[2]
    places = {}
    for c, at in mains.items():
        outs = [(i, x) for i, x in enumerate(c) if x[2] and x[0] not in spared]
        strong = [(i, x) for i, x in outs if x[2] > WEAK or i <= at]
        if strong:  # of the header of an article, its headings stay
            places[c] = DROP if any(i <= at or x[1] != "header" for i, x in strong) else None
        else:
            places[c] = ASK if at == len(c) or outs else KEEP
    verdicts = []
    for b in blocks:
        v = places[b.chain]
        if v is None:
            v = KEEP if b.kind in HEADINGS else DROP
        verdicts.append(ASK if v == KEEP and b.linked else v)
    inside = [mains[b.chain] < len(b.chain) for b in blocks]
    if any(v != DROP and x for v, x in zip(verdicts, inside)):
        verdicts = [v if x else DROP for v, x in zip(verdicts, inside)]
    return verdicts


@lru_cache(maxsize=50_000)
def _path(kind: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\t{path}")


def page_tokens(blocks: list[Block], tags: list[tuple[str, int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """The tokens of a page in order (a tag inside a block follows the block's words), and where each block's words lie."""
    out: list[int] = []
    spans = []
    at = 0
    for i, b in enumerate(blocks):
        while at < len(tags) and tags[at][1] <= i:
            out.append(_path("t", tags[at][0]) - (1 << 63))
            at += 1
        first, seed = len(out), _path("w", b.path)
        out += [xxhash.xxh64_intdigest(w, seed) - (1 << 63) for w in b.text().split()]
        spans.append((first, len(out)))
    out += [_path("t", x) - (1 << 63) for x, _ in tags[at:]]
    return out, spans


class Template:
    """The root tokens of a host in order, and the nested classes, each in the order of its tokens."""

    def __init__(self, root, nested):
        self.rank = {t: i for i, t in enumerate(root)}
        self.nested = {t: (c, i) for c, x in enumerate(nested) for i, t in enumerate(x)}

    def places(self, found: list[int]) -> list[bool]:
        """Which tokens of a page are the template's, in its order and nesting."""
        marked = [False] * len(found)
        # the root tokens of the page: the longest run in the order of the template
        ends: list[int] = []  # the least rank that ends a run of each length
        last: list[int] = []  # and its place
        before: dict[int, int] = {}
        for i, t in enumerate(found):
            r = self.rank.get(t)
            if r is not None:
                k = bisect_left(ends, r)
                before[i] = last[k - 1] if k else -1
                ends[k : k + 1] = [r]
                last[k : k + 1] = [i]
        i = last[-1] if last else -1
        while i >= 0:
            marked[i] = True
            i = before[i]
        # the nested classes: in every slot of the root, their tokens repeat in one order
        slot: dict[int, list[tuple[int, int]]] = {}

        def close() -> None:
            for x in slot.values():
                order = [j for j, _ in x]
                n = next((k for k in range(1, len(order)) if order[k] <= order[k - 1]), len(order))
                if len(order) % n == 0 and order == order[:n] * (len(order) // n):
                    for _, i in x:
                        marked[i] = True
            slot.clear()

        if self.nested:
            for i, t in enumerate(found):
                if marked[i]:
                    close()
                elif (own := self.nested.get(t)) is not None:
                    slot.setdefault(own[0], []).append((own[1], i))
            close()
        return marked


def main_text(html: str | None, template: Template | None = None) -> str:
    """The blocks of the article, and those that place leaves open if they hold a slot of the template, each with single spaces, joined by two line feeds."""
    blocks, tags = parse(html)
    verdicts = judge(blocks)
    if template is not None and ASK in verdicts:
        found, spans = page_tokens(blocks, tags)
        marked = template.places(found)
        verdicts = [DROP if v == ASK and all(marked[a:z]) else v for v, (a, z) in zip(verdicts, spans)]
    return "\n\n".join(x for x in (b.text() for b, v in zip(blocks, verdicts) if v != DROP) if x)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def _least(pages: int, share: float) -> int:
    return math.ceil(pages * share - 1e-9)


def candidates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``host`` and the ``known`` tokens that may occur in ``min_share`` of its pages; the token 0 occurs in every page with words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}
        size = 0

        def rows() -> pd.DataFrame:
            out = []
            for host, found in held.items():
                least = _least(found[0], min_share)
                out += [(host, t, n, least - 1) for t, n in found.items() if n >= least]
            return pd.DataFrame(out, columns=["host", "token", "pages", "unseen"]).astype({"host": object})

        for b in batches:
            for host, html in zip(b["host"], b["html"]):
                blocks, tags = parse(html)
                tokens, spans = page_tokens(blocks, tags)
                if not any(a < z for a, z in spans):
                    continue
                if host not in held:
                    held[host] = Counter()
                found = held[host]
                size -= len(found)
                found.update({0, *tokens})
                size += len(found)
            if size > _FLUSH:
                yield rows()
                held, size = {}, 0
        yield rows()

    different = pages.groupBy("host").agg(F.count_distinct(F.xxhash64("html")).alias("different")).where(F.col("different") >= min_pages)
    different = saved(different, "page-hosts")
    parts = join_narrow(pages, different.select("host"), "host", "left_semi").mapInPandas(run, "host string, token long, pages long, unseen long")
    found = parts.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum("unseen").alias("unseen"))
    found = saved(found, "page-tokens")
    # a task that left a token out saw it in fewer pages than its share
    whole = found.where("token = 0").select("host", F.col("pages").alias("all"), F.col("unseen").alias("bound")).join(different, "host")
    least = F.ceil(F.col("all") * min_share - 1e-9)
    return (
        found.join(whole, "host").where(F.col("pages") + F.col("bound") - F.col("unseen") >= least)
        .groupBy("host").agg(F.collect_list("token").alias("known"))
    )


def occurrences(pages: DataFrame, known: DataFrame) -> DataFrame:
    """``host``, ``token``, ``pages`` (that have it), ``times`` (it occurs), ``signature`` and ``best`` (its first place on the page with most) of the known tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, dict[int, list[int]]] = {}
        wanted: dict[str, frozenset] = {}
        size = 0

        def rows() -> pd.DataFrame:
            out = [(h, t, x[0], x[1], x[2], *x[3]) for h, found in held.items() for t, x in found.items()]
            return pd.DataFrame(out, columns=["host", "token", "pages", "times", "signature", "singles", "page", "rank", "at"]).astype({"host": object})

        for b in batches:
            for host, key, html, known in zip(b["host"], b["page"], b["html"], b["known"]):
                blocks, tags = parse(html)
                tokens, spans = page_tokens(blocks, tags)
                if not any(a < z for a, z in spans):
                    continue
                if host not in wanted:
                    if size > _FLUSH:  # what a task says in parts is summed like what tasks say
                        yield rows()
                        held, wanted, size = {}, {}, 0
                    wanted[host], held[host] = frozenset(known.tolist()), {}
                    size += len(wanted[host])
                own, before = wanted[host], held[host]
                counts = Counter(t for t in tokens if t in own)
                first: dict[int, tuple[int, int]] = {0: (0, 0)}
                rank = 0  # single known tokens before, which no long slot between moves
                for i, t in enumerate(tokens):
                    if t in own:
                        first.setdefault(t, (rank, i))
                        rank += counts[t] == 1
                counts[0] = 1
                # 1 is always among the counts: the token 0
                mark = {n: xxhash.xxh64_intdigest(f"{key}\t{n}") - (1 << 63) for n in set(counts.values())}
                for t, n in counts.items():
                    x, place = before.get(t), (rank, mark[1], *first[t])
                    if x is None:
                        before[t] = [1, n, mark[n], place]
                    else:
                        x[0] += 1
                        x[1] += n
                        x[2] ^= mark[n]
                        x[3] = max(x[3], place)
        yield rows()

    parts = join_narrow(pages, known, "host", "inner", bound=2_000).mapInPandas(
        run, "host string, token long, pages long, times long, signature long, singles long, page long, rank long, at long"
    )
    return parts.groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.bit_xor("signature").alias("signature"),
        F.max(F.struct("singles", "page", "rank", "at")).alias("best"),
    )


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS, min_share: float = MIN_SHARE) -> DataFrame:
    """``host`` and the ``tokens`` of its valid classes: ``root`` (of single occurrences) and ``nested`` (a list for each other class), in order."""
    known = saved(candidates(pages, min_pages, min_share), "known-tokens")
    place = F.struct("best.rank", "best.at", "token")
    # the tokens of a class lie in most pages of the host, so a class is no larger than a page
    classes = occurrences(pages, known).groupBy("host", "signature", "pages", "times").agg(F.sort_array(F.collect_list(place)).alias("own"))
    classes = classes.withColumn("every", F.exists("own", lambda x: x["token"] == 0))
    valid = classes.groupBy("host").agg(
        F.max("pages").alias("all"), F.sort_array(F.collect_list(F.struct("pages", "times", "every", "own"))).alias("classes")
    )
    supported = F.filter(
        "classes", lambda x: (x["pages"] >= F.ceil(F.col("all") * min_share - 1e-9)) & (x["every"] | (F.size(x["own"]) >= min_class))
    )
    valid = valid.select("host", supported.alias("classes"))
    once = F.sort_array(F.flatten(F.transform(F.filter("classes", lambda x: x["times"] == x["pages"]), lambda x: x["own"])))
    out = valid.select(
        "host",
        F.transform(once, lambda x: x["token"]).alias("root"),
        F.transform(F.filter("classes", lambda x: x["times"] > x["pages"]), lambda x: F.transform(x["own"], lambda y: y["token"])).alias("nested"),
    )
    return out.select("host", F.concat("root", F.flatten("nested")).alias("tokens"), "root", "nested")


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``."""
    own = with_place(pages).select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"),
        host_of(F.col(url)).alias("host"), F.concat_ws("#", "file", "pos").alias("page"),
    )
    found = saved(templates(own.select("host", "page", "html"), min_pages, min_class, min_share), "templates")
    rows = join_narrow(own.drop("page"), found.select("host", "root", "nested"), "host", "left", bound=2_000)

    @F.pandas_udf("string")
    def cut(htmls: pd.Series, hosts: pd.Series, roots: pd.Series, nested: pd.Series) -> pd.Series:
        known: dict[str, Template | None] = {}
        out = []
        for page, host, r, n in zip(htmls, hosts, roots, nested):
            if host not in known:
                known[host] = Template(r.tolist(), [x.tolist() for x in n]) if r is not None else None
            out.append(main_text(page, known[host]))
        return pd.Series(out, dtype=object)

    text = rows.select("page_id", "url", cut("html", "host", "root", "nested").alias("text"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
