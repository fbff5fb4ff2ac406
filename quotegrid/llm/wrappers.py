"""Main text of web pages, by wrappers inferred from pages of one host.

A page becomes a stream of block tags and texts. The wrapper of a host is a regular expression without unions:
it starts as the stream of one page, in which repeated groups are folded, and is aligned with the next page after page;
where tags differ, the part that only one side has becomes optional, a group that repeats on one side becomes
repeated, and a text that differs becomes a slot (one that does not is part of the template). Slots are known by
the path of blocks around them. Texts come from a page's own article blocks, or else its main blocks, all of them. On a page without,
they come from the smallest block of the host that holds all varying slots, and from what stands outside it with more than links, without
menus, footers, notices, adverts, forms and comments by their tags and names. A slot with nothing but links
counts if it is a heading. A name is not believed where it holds most of a host's text.

A wrapper is inferred from all different pages of its host; copies count once. Tasks count a page's texts by the hash of path and
text, and sum up its paths; what a host's texts and paths amount to is grouped and joined. Streams that differ are aligned ``AT_ONCE`` at
a time, and the wrappers that come out likewise, until a host has one. Template texts
are only left out of blocks that no article or main tag names. Pages meet their wrapper in a join by host, which adaptive execution splits where one host is large.
A page that has template texts only is read by the rules for tags and names alone.

Defined results: null html is empty; null or odd urls are one host; repeated pages give repeated rows; a page
without text gives an empty text; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import isqrt
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.bitfilter import bit_filter
from quotegrid.llm.common import row_slices
from quotegrid.session import materialize

OFTEN = (3, 0.8)  # a template text stands on so many pages of its host, and on such a part of them
BELIEVED = 0.6  # a name that says boilerplate holds no larger part of a host's text
GROUP = 12  # items in a repeated group, at most
AT_ONCE = 64  # streams or wrappers that a task aligns, about
SLICE = 2 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|iframe|title|select|object)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*+>"
    r"""|<(/?)([a-z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)>"
    r"|<[a-z/!?][^<>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME_WORDS = re.compile(r"[a-z]+")

# Tags that do not start a new block, tags without content, tags that are never an article's text, and
# words of class and id names that say the same.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = set("aside button dialog footer form head menu nav".split())
BOILERPLATE_NAMES = set(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination"
    " pager popup promo promoted promotion recommended related replies respond share sharing sidebar signup social"
    " sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
BOILERPLATE_ROLES = set("alert banner complementary contentinfo dialog form menu navigation search".split())
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav"
    " ol p pre section table ul".split()
)
LEAVES = set("blockquote caption dd dt figcaption figure h1 h2 h3 h4 h5 h6 li ol p pre table tbody td th tr ul dl".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


@dataclass
class Block:
    """A run of text and the blocks around it: (signature, boilerplate by tag, boilerplate by name)."""

    path: tuple[tuple[str, bool, bool], ...]
    text: str
    linked: int  # characters inside links


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    stream: list[str] = field(default_factory=list)  # "<sig>", "</sig>", "#path"


def _signature(tag: str, attributes: str) -> tuple[str, bool, bool]:
    sig, by_tag, by_name = tag, tag in BOILERPLATE_TAGS, tag == "header"
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id"):
                words = _NAME_WORDS.findall(value)
                sig += ("." if name == "class" else "#") + "-".join(words[:4])
                by_name |= not BOILERPLATE_NAMES.isdisjoint(words)
            elif name == "role":
                by_tag |= value in BOILERPLATE_ROLES
                sig += "@main" if value == "main" else ""
            elif name == "itemprop":
                sig += "@main" if value == "articlebody" else ""
            elif name == "style":
                by_tag |= "display:none" in value.replace(" ", "")
            elif name == "aria-hidden":
                by_tag |= value == "true"
            else:
                by_tag = True
    return sig, by_tag, by_name


def read_page(html: str, stream: bool = False) -> Page:
    """Blocks of text with their paths; also the stream of block tags, for inference."""
    page, stack, text, at, linked, link = Page(), [], [], 0, 0, 0

    def close_block() -> None:
        nonlocal linked
        if text:
            whole = " ".join(entities.unescape("".join(text)).split())
            if whole:
                path = tuple(s for _, s in stack)
                page.blocks.append(Block(path, whole, min(linked, len(whole))))
                if stream:
                    page.stream.append("#" + "/".join(s[0] for s in path))
            text.clear()
        linked = 0

    def pop(n: int) -> None:
        close_block()
        while len(stack) > n:
            sig = stack.pop()[1][0]
            if stream:
                page.stream.append(f"</{sig}>")

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            text.append(html[at : m.start()])
            if link:
                linked += m.start() - at
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            if m[1]:
                close_block() if m[1].lower() != "svg" else None
            continue
        tag, closing = tag.lower(), bool(m[2] or m[5])
        if tag in INLINE:
            if tag == "a":
                link = not closing
            hidden = not closing and _signature(tag, m[4] or m[7] or "")
            if hidden and (hidden[1] or hidden[2]) and not tag == "a":  # an advert or hidden text inside a line
                close_block()
                stack.append((tag, hidden))
            elif closing and stack and stack[-1][0] == tag:
                close_block()
                stack.pop()
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                text.append("\n")
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            else:
                close_block()
            continue
        close_block()
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag in SIBLINGS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in SIBLINGS[tag]:
                    pop(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table"):
                    break
        sig = _signature(tag, m[4] or m[7] or "")
        stack.append((tag, sig))
        if stream:
            page.stream.append(f"<{sig[0]}>")
    if at < len(html):
        text.append(html[at:])
    pop(0)
    return page


# A wrapper is a list of (item, optional); an item is a token, or a tuple of items that repeats.


def _coded(items: list) -> str:
    """A character for each item, the same for equal ones."""
    codes: dict = {}
    return "".join([chr(codes.setdefault(x, len(codes))) for x in items])


_REPEATS = [re.compile(f"(.{{{size}}})\\1", re.S) for size in range(1, GROUP + 1)]


def fold(items: list) -> list:
    """Groups that follow themselves become one repeated group, the shortest groups first."""
    changed, coded = True, _coded(items)
    while changed:
        changed = False
        for size in range(1, GROUP + 1):
            if not _REPEATS[size - 1].search(coded):
                continue
            out, i = [], 0
            while i < len(items):
                group = tuple(items[i : i + size])
                n = 1
                while len(group) == size and tuple(items[i + n * size : i + (n + 1) * size]) == group:
                    n += 1
                if n > 1:
                    body = group[0] if size == 1 and isinstance(group[0], tuple) else group
                    if not (out and out[-1] == body):
                        out.append(body)
                    i += n * size
                    changed = True
                else:
                    out.append(items[i])
                    i += 1
            items, coded = out, _coded(out)
    return items


def absorb(items: list, groups: set[tuple]) -> list:
    """Single occurrences of groups that repeat elsewhere become the group."""
    present = set(items)
    for group in sorted(groups, key=lambda g: (-len(g), repr(g))):
        if group not in present and not present.issuperset(group):
            continue
        out, i = [], 0
        while i < len(items):
            if tuple(items[i : i + len(group)]) == group:
                if not (out and out[-1] == group):
                    out.append(group)
                i += len(group)
            elif items[i] == group and out and out[-1] == group:
                i += 1
            else:
                out.append(items[i])
                i += 1
        items, present = out, set(out)
    return items


def _absorbed(wrapper: list[tuple], groups: set[tuple]) -> list[tuple]:
    items = absorb([x for x, _ in wrapper], groups)
    if items == [x for x, _ in wrapper]:
        return wrapper
    flags = {x for x, o in wrapper if o}
    return [(x, x in flags) for x in items]


def _common(a: list, b: list) -> Iterator[tuple[int, int]]:
    """Places of a longest common subsequence, in order.

    For the items of b from one on to the end, a word of len(a) bits tells where the longest common subsequence with the end of a
    grows: the last item of a is the lowest bit, 0 stands for growth. Every isqrt(len(b))-th word is kept, the others are made again.
    """
    n, m = len(a), len(b)
    every = (1 << n) - 1
    at: dict = defaultdict(int)
    for i, x in enumerate(a):
        at[x] |= 1 << (n - 1 - i)
    step = isqrt(m) + 1

    def before(j: int, word: int) -> int:
        same = word & at.get(b[j], 0)
        return ((word + same) | (word - same)) & every

    kept = {m: every}
    word = every
    for j in range(m - 1, -1, -1):
        word = before(j, word)
        if j % step == 0:
            kept[j] = word
    i = j = 0
    words: list[int] = []
    while i < n and j < m:
        if len(words) < 2:
            end = min(j + step, m)
            words = [kept[end]]
            for k in range(end - 1, j, -1):
                words.append(before(k, words[-1]))
            words.append(kept[j])  # the word of j comes last, and is the first to go
        if a[i] == b[j]:
            yield i, j
            i, j = i + 1, j + 1
            words.pop()
        elif words[-1] >> (n - 1 - i) & 1:
            i += 1
        else:
            j += 1
            words.pop()


def merge(one: list[tuple], other: list[tuple]) -> list[tuple]:
    """The wrapper that fits what either fits: what only one side has becomes optional."""
    groups = {x for x, _ in one + other if isinstance(x, tuple)}
    one, other = _absorbed(one, groups), _absorbed(other, groups)
    out, i, j = [], 0, 0
    for p, q in (*_common([x for x, _ in one], [x for x, _ in other]), (len(one), len(other))):
        out += [(x, True) for x, _ in one[i:p] + other[j:q]]
        if p < len(one):
            out.append((one[p][0], one[p][1] or other[q][1]))
        i, j = p + 1, q + 1
    return out


def align(wrapper: list[tuple], page: list) -> list[tuple]:
    """The wrapper that fits both: what only one side has becomes optional."""
    return merge(wrapper, [(x, False) for x in page])


def expression(wrapper: list[tuple]) -> str:
    """The wrapper as a regular expression; ``#`` stands for a text slot."""

    def show(item) -> str:
        if isinstance(item, tuple):
            return "(" + "".join(map(show, item)) + ")+"
        return "#" if item.startswith("#") else item

    out, k = [], 0
    while k < len(wrapper):
        if wrapper[k][1]:
            part = []
            while k < len(wrapper) and wrapper[k][1]:
                part.append(show(wrapper[k][0]))
                k += 1
            out.append("(" + "".join(part) + ")?")
        else:
            out.append(show(wrapper[k][0]))
            k += 1
    return "".join(out)


TAGGED = "tag"  # of a block that a tag says is no article's text


def _facts(page: Page) -> Iterator[tuple[str, str, str, int, int, bool]]:
    """path, flags, text, pages (1 where path and text are new on the page), own characters and ``main`` of each block.

    Flags are the depths whose names say boilerplate, or ``TAGGED``; ``main`` means more than links, or a heading.
    """
    seen = set()
    for b in page.blocks:
        path = "/".join(s[0] for s in b.path)
        flags = TAGGED if any(s[1] for s in b.path) else ",".join(str(k + 1) for k, s in enumerate(b.path) if s[2])
        main = b.linked < len(b.text) or any(_tag(s[0]) in HEADINGS for s in b.path)
        yield path, flags, b.text, int((path, b.text) not in seen), len(b.text) - b.linked, main
        seen.add((path, b.text))


def infer(pages: list[str]) -> dict:
    """The wrapper of pages of one host: its expression, the article's block, template texts, names not believed.

    :func:`infer_wrappers` does the same for all hosts of a table.
    """
    read = [read_page(h, stream=True) for h in pages]
    wrapper: list[tuple] = []
    for k, page in enumerate(read):
        folded = fold(page.stream)
        wrapper = align(wrapper, folded) if k else [(x, False) for x in folded]
    facts = [f for page in read for f in _facts(page)]
    seen: Counter = Counter()
    for path, _, text, n, _, _ in facts:
        seen[path, text] += n
    # a text that does not vary in its slot belongs to the template
    often = {key for key, n in seen.items() if n >= OFTEN[0] and n >= OFTEN[1] * len(read)}
    named: Counter = Counter()
    total = 0
    slots: dict[str, bool] = {}
    for path, flags, text, _, own, main in facts:
        if (path, text) in often or flags == TAGGED:
            continue
        total += own
        slots[path] = slots.get(path, False) or main
        for depth in flags.split(",") if flags else ():
            named["/".join(path.split("/")[: int(depth)])] += own
    believed = {p for p, n in named.items() if n <= BELIEVED * total}
    parts = {p: p.split("/") for p in slots}
    plain = {p for p in slots if believed.isdisjoint("/".join(parts[p][: k + 1]) for k in range(len(parts[p])))}
    root = _container({p for p in plain if slots[p]})
    return {
        "expression": expression(wrapper),
        "root": root,
        "links": sorted(p for p in plain if not slots[p] and not _inside(p, root)),
        "template": sorted(map(list, often)),
        "trusted": sorted(set(named) - believed),
    }


def _tag(path: str) -> str:
    return re.split(r"[.#@]", path.rpartition("/")[2])[0]


def _is_article(path: str) -> bool:
    return _tag(path) in ("article", "main") or "@main" in path.rpartition("/")[2]


def _inside(path: str, root: str) -> bool:
    return not root or path == root or path.startswith(root + "/")


def _container(paths: set[str]) -> str:
    """The smallest block, no paragraph or list, around all paths; empty for the page."""
    if not paths:
        return ""
    first, last = min(paths).split("/"), [p.split("/") for p in paths]
    n = 0
    while all(len(p) > n and len(first) > n and p[n] == first[n] for p in last):
        n += 1
    while n and _tag(first[n - 1]) in LEAVES | INLINE:
        n -= 1
    return "/".join(first[:n])


def extract(html: str, wrapper: dict | None) -> str:
    """The main text: article blocks, or else what varies on the host, without boilerplate and template texts."""
    page = read_page(html)
    trusted = set(wrapper["trusted"]) if wrapper else set()
    found = []  # path, text, inside a main block, inside an article
    for b in page.blocks:
        path, plain, main, article = "", True, False, False
        for sig, by_tag, by_name in b.path:
            path = f"{path}/{sig}" if path else sig
            if _is_article(sig):
                main = True
                article = article or _tag(sig) == "article" or "@main" in sig
            if by_tag or by_name and path not in trusted and not (sig == "header" and main):
                plain = False
                break
        if plain:
            found.append((path, b.text, main, article))
    for kind in (3, 2):
        if own := [f[1] for f in found if f[kind]]:
            return " ".join(own)
    if wrapper:
        template, links = {(p, t) for p, t in wrapper["template"]}, set(wrapper["links"])
        if own := [f[1] for f in found if f[0] not in links and (f[0], f[1]) not in template]:
            return " ".join(own)
    return " ".join(f[1] for f in found)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def different_pages(pages: DataFrame) -> DataFrame:
    """``host``, ``k`` (hash of host and html) and ``html``, copies within a host once. Only pages that have copies are shuffled."""
    rows = pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.select("host", F.xxhash64("host", "html").alias("k"), "html")
    copied = materialize(rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k"), "copied-pages")
    hit = F.coalesce(bit_filter(copied, "k")(F.col("k")), F.lit(False))
    once = rows.where(hit).groupBy("host", "k").agg(F.min("html").alias("html"))
    return rows.where(~hit).unionByName(once)


def _text_hash(path: str, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{path}\n{text}".encode(), digest_size=8).digest(), "little", signed=True)


_FACTS = "host string, item string, flags string, t long, n long, own long, main boolean, k long"


def _page_facts(pages: DataFrame) -> DataFrame:
    """Added up over the pages of a host: for each path, flags and text (``t``) the pages, own characters, whether it is ``main``, a page.

    Rows without flags are the folded streams, with the pages that have them.
    """
    schema = pa.schema(
        [("host", pa.string()), ("item", pa.string()), ("flags", pa.string()), ("t", pa.int64()), ("n", pa.int64())]
        + [("own", pa.int64()), ("main", pa.bool_()), ("k", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "html", SLICE):
            found: dict[tuple, list] = {}
            folded: dict[tuple, tuple[str, int]] = {}
            for host, k, html in zip(*(c.to_pylist() for c in part.columns), strict=True):
                page = read_page(html, stream=True)
                stream = tuple(page.stream)
                if stream not in folded:
                    item = json.dumps(fold(page.stream), ensure_ascii=False)
                    folded[stream] = item, _text_hash("", item)
                item, t = folded[stream]
                facts = [((host, item, None, t), 1, 0, False)]
                facts += [((host, path, flags, _text_hash(path, text)), n, own, main) for path, flags, text, n, own, main in _facts(page)]
                for key, n, own, main in facts:
                    old = found.get(key)
                    if old is None:
                        found[key] = [n, own, main, k]
                    else:
                        old[:] = old[0] + n, old[1] + own, old[2] or main, min(old[3], k)
            rows = [(*key, *value) for key, value in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    added = pages.mapInArrow(run, _FACTS).groupBy("host", "item", "flags", "t")
    return added.agg(F.sum("n").alias("n"), F.sum("own").alias("own"), F.max("main").alias("main"), F.min("k").alias("k"))


def _items(x):
    """Items as they were before they became JSON."""
    return tuple(map(_items, x)) if isinstance(x, list) else x


def _align_round(streams: DataFrame, first: bool) -> DataFrame:
    """``host``, ``t`` and ``item``: of about ``AT_ONCE`` streams (in the first round) or wrappers, the wrapper that fits them."""
    parts = F.ceil(F.col("all") / AT_ONCE).cast("long")
    sizes = streams.groupBy("host").agg(F.count("*").alias("all"))
    dealt = streams.join(sizes, "host").select("host", "t", "item", F.pmod(F.xxhash64("t"), parts).alias("part"))

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        wrapper = None
        for _, item in sorted(zip(group.column("t").to_pylist(), group.column("item").to_pylist(), strict=True)):
            read = json.loads(item)
            new = [(_items(x), False) for x in read] if first else [(_items(x), o) for x, o in read]
            wrapper = new if wrapper is None else merge(wrapper, new)
        found = [key[0].as_py()], [key[1].as_py()], [json.dumps(wrapper, ensure_ascii=False)]
        return pa.table(list(found), names=["host", "t", "item"])

    return materialize(dealt.groupBy("host", "part").applyInArrow(run, "host string, t long, item string"), "aligned")


def _expressions(streams: DataFrame) -> DataFrame:
    """``host`` and the ``expression`` that fits all its folded streams."""
    now = _align_round(streams, True)
    while now.groupBy("host").count().agg(F.max("count")).first()[0] not in (None, 1):
        now = _align_round(now, False)
    shown = F.udf(lambda item: expression([(_items(x), o) for x, o in json.loads(item)]), "string")
    return now.select("host", shown("item").alias("expression"))


def _template_texts(pages: DataFrame, often: DataFrame) -> DataFrame:
    """``host`` and ``template``, the paths and texts of the hashes, read from one page for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "html", SLICE):
            rows = []
            for host, html in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
                rows += [(host, _text_hash(path, text), path, text) for path, _, text, n, _, _ in _facts(read_page(html)) if n]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["host", "t", "path", "text"])

    some = pages.where(bit_filter(often.select("k").distinct(), "k")(F.col("k")))
    read = some.mapInArrow(run, "host string, t long, path string, text string").join(often, ["host", "t"], "left_semi")
    return read.groupBy("host").agg(F.sort_array(F.collect_set(F.array("path", "text"))).alias("template"))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` (JSON, see :func:`infer`) of every host, from all its different pages."""
    pages = different_pages(pages)
    facts = materialize(_page_facts(pages), "page-facts")
    streams, blocks = facts.where("flags is null"), facts.where("flags is not null")
    hosts = streams.groupBy("host").agg(F.sum("n").alias("pages"))
    often = blocks.groupBy("host", "t").agg(F.sum("n").alias("n"), F.min("k").alias("k")).where(F.col("n") >= OFTEN[0])
    often = often.join(hosts, "host").where(F.col("n") >= F.lit(float(OFTEN[1])) * F.col("pages")).select("host", "t", "k")
    often = materialize(often, "template-hashes")
    slots = blocks.where(F.col("flags") != TAGGED).join(often, ["host", "t"], "left_anti")
    slots = slots.groupBy("host", F.col("item").alias("path"), "flags").agg(F.sum("own").alias("own"), F.max("main").alias("main"))
    slots = materialize(slots, "slots")

    parts = F.split("path", "/", -1)
    prefix = lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    named = slots.where("flags <> ''").withColumn("depth", F.explode(F.split("flags", ",").cast("array<int>")))
    named = named.groupBy("host", prefix(F.col("depth")).alias("name")).agg(F.sum("own").alias("n"))
    total = slots.groupBy("host").agg(F.sum("own").alias("total"))
    believed = F.col("n") <= F.lit(float(BELIEVED)) * F.col("total")
    named = materialize(named.join(total, "host").select("host", "name", believed.alias("believed")), "names")
    paths = slots.groupBy("host", "path").agg(F.max("main").alias("main"))
    above = paths.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), prefix)).alias("name"))
    plain = paths.join(above.join(named.where("believed"), ["host", "name"], "left_semi"), ["host", "path"], "left_anti")
    plain = materialize(plain, "plain-paths")

    # what all paths begin with is what the first and the last of them begin with
    ends = plain.where("main").groupBy("host").agg(F.min(parts).alias("lo"), F.max(parts).alias("hi"))
    container = F.udf(lambda lo, hi: _container({"/".join(lo), "/".join(hi)}), "string")
    roots = materialize(ends.select("host", container("lo", "hi").alias("root")), "roots")
    outside = (F.col("path") != F.col("root")) & ~F.col("path").startswith(F.concat("root", F.lit("/")))
    links = plain.where("not main").join(roots.where("root <> ''"), "host").where(outside)

    listed = lambda df, c, name: df.groupBy("host").agg(F.sort_array(F.collect_list(c)).alias(name))
    found = _expressions(streams).join(roots, "host", "left")
    found = found.join(listed(links, "path", "links"), "host", "left")
    found = found.join(_template_texts(pages, often), "host", "left")
    found = found.join(listed(named.where("not believed"), "name", "trusted"), "host", "left")
    empty = [F.coalesce(c, F.array()).alias(c) for c in ("links", "template", "trusted")]
    return found.select("host", F.to_json(F.struct("expression", F.coalesce("root", F.lit("")).alias("root"), *empty)).alias("wrapper"))


def main_texts(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    if wrappers is None:  # written first: the join is then free to broadcast them, or to split a large host
        wrappers = materialize(infer_wrappers(pages), "wrappers")
    used = "links array<string>, template array<array<string>>, trusted array<string>"  # the expression need not go to every page
    wrappers = wrappers.select("host", F.to_json(F.from_json("wrapper", used)).alias("wrapper"))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    met = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, dict | None] = {None: None}
        for part in row_slices(batches, "html", SLICE):
            texts = []
            for html, wrapper in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                if wrapper not in known:
                    if len(known) > 1000:
                        known = {None: None}
                    known[wrapper] = json.loads(wrapper)
                texts.append(extract(html, known[wrapper]))
            chars = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), chars], names=["page_id", "url", "text", "n_chars"]
            )

    return met.mapInArrow(run, "page_id long, url string, text string, n_chars long")
