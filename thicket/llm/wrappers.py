"""Main text of web pages by union-free wrappers inferred per host.

A wrapper is a union-free regular expression over the elements of a host's
pages.  An element holds parts, each for one kind of child (tag with classes or
id); a part is required, optional (?) or repeated (+, *), parts whose order
differs between repeats or pages form one repeated group, and a part may have a
text slot that is fixed or varies.  A few containers of one kind side by side
(columns, layout cells) are told apart by position as long as all pages have as
many.  Wrappers are inferred by aligning pages: like parts are matched and
their contents aligned in turn, what has no match becomes optional, what recurs
becomes repeated.  Alignment of two wrappers is the same operation, so wrappers
are made where the pages lie, brought together in two steps (host and salt,
then host) as streams, and no task holds more than the two that it aligns.

A page is read through the wrapper of its host alone: an element without a part
in it has no slot and gives no text.  ``plan`` marks the parts to read from what
the alignment saw on all pages of the host.  Main text is the element that
holds the bulk of the host's varying text outside links; inside it, parts that
are link lists on most pages are template, and so are, where no article is
marked, containers in which nothing varies; all else is kept, also paragraphs
that every page has, whatever their length.  HTML's own names of page furniture (nav, aside, form, ...) and class
names of adverts, notices and comments are a prior: a named part is read all the
same where it holds a good share of the region's text on enough pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thicket.llm.runtime import bounded_batches, lean, materialise

# Fixed values of this module: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
UNREAD = frozenset("head script style noscript template iframe object embed svg math canvas audio video textarea title select button datalist xmp noembed noframes".split())
FURNITURE = frozenset("nav footer aside form dialog menu search".split())
CONTAINERS = frozenset("# html body div section article main table tbody tr td center span header figure details".split())
POSITIONAL = frozenset("div section table tbody td ul ol".split())
LISTS = frozenset("div section ul ol dl table tbody tr td menu".split())
CLOSES_P = BLOCK - frozenset("body html tbody thead tfoot tr td th li dd dt option summary caption".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "thead": {"tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl select article section div body html main".split())
NAMED = frozenset("nav navbar navigation menu sidebar sidenav footer masthead breadcrumb breadcrumbs ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice alert popup modal newsletter subscribe signup login share sharing social related recommended comment comments disqus replies respond pagination pager toolbar complementary contentinfo dialog menubar search form".split())
#: Names that no evidence overrides: readers' comments and adverts can be long.
CERTAIN = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsored comment comments disqus replies respond cookie cookies consent gdpr".split())
HOLDERS = frozenset("list box bar area section wrapper wrap container block slot form link links menu item items unit panel overlay buttons header footer".split())

TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<!\[CDATA\[(?:.*?\]\]>|.*)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*+)[^>]*>|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
SPACES = re.compile(r"\s+")
#: Pages on which a part must be seen before what they have in common decides.
ENOUGH_PAGES = 3
#: Levels of nesting that a wrapper describes; deeper elements are read as part of the last one.
LEVELS = 128
#: Kinds of children that a part keeps apart; beyond it they are told apart by tag alone.
KINDS = 64
#: Siblings of one kind told apart by position.
PLACES = 6
#: Shares: of the text that a child must hold to be the region, of links in a link list, of the region's text that clears a named part.
BULK, LINKED, CLEARED = 0.6, 0.6, 0.3
#: A block's end inside an element of the last level.
BREAK = ["br!", []]


def kind_of(tag: str, attributes: str) -> str:
    """The element's kind: its tag, its role, and its classes (or id) without those that hold digits."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attributes)}
    names = [n for n in (found.get("class") or found.get("id") or "").split() if not any(c.isdigit() for c in n)]
    if found.get("role"):
        names.append("role=" + found["role"].split()[0])
    return ".".join([tag, *sorted(set(names))])


def named(kind: str) -> str:
    """Whether a kind's tag, role or classes name page furniture: '' for no, 'certain' for what no evidence overrides."""
    tag, *names = kind.split(".")
    if tag in FURNITURE:
        return "certain"
    found = ""
    for name in names:
        words = re.split(r"[-_]+", name.removeprefix("role="))
        word = words[-1] if words[-1] in NAMED and words[-1] not in HOLDERS else name if name in NAMED else words[0] if words[0] in NAMED and words[-1] in HOLDERS else ""
        found = "certain" if word in CERTAIN else found or word
    return found


def parse(page: str) -> list:
    """[kind, children] of a page; a child is such a list or a text.  Works without recursion at any depth."""
    root: list = ["#", []]
    stack, at = [("#", root)], 0

    def leave(i: int) -> None:
        if len(stack) > LEVELS and any(tag in BLOCK for tag, _ in stack[max(i, LEVELS) :]):
            stack[LEVELS - 1][1][1].append(BREAK)
        del stack[i:]

    def close(tags: set[str] | frozenset[str], scopes: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                leave(i)
                return
            if stack[i][0] in scopes:
                return

    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            stack[-1][1][1].append(page[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    leave(i)
                    break
                if stack[i][0] in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "body", "html", "div", "article", "main", "section"):
                    break
        elif m[2]:
            tag, attributes = m[2].lower(), m[3]
            if tag in CLOSES_P:
                close({"p"}, SCOPES | {"td", "th", "li", "button"})
            if tag in SIBLINGS:
                for name in SIBLINGS[tag]:
                    close({name}, SCOPES - {"section"})
            into = stack[-1][1]
            if len(stack) < LEVELS:
                node = [kind_of(tag, attributes) if attributes else tag, []]
                into[1].append(node)
            elif tag in UNREAD or tag in FURNITURE:
                node = [tag, []]  # below the last level: left out by its tag
            else:
                node = into
                if tag in BLOCK or tag == "br":
                    into[1].append(BREAK if tag in BLOCK else ["br", []])
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            elif tag not in VOID and not attributes.endswith("/"):
                stack.append((tag, node))
    if at < len(page):
        stack[-1][1][1].append(page[at:])
    return root


# A part is [least, most, pages, chars, slot, order, kids]: least and most are its occurrences
# in one parent (most 2: more than one); pages the aligned pages that have it; chars the
# characters of its own slot on all of them; slot None (no text), the digest of a fixed text
# of any length [d], or [] for varying text; order a list of lists of kinds, one of several
# being a repeated group; kids a list of parts by kind, several being told apart by position.
LEAST, MOST, PAGES, CHARS, SLOT, ORDER, KIDS = range(7)


def from_tree(node: list) -> list:
    """The wrapper of one page's element."""
    texts = []
    order: list[list[str]] = []
    seen: dict[str, list] = {}
    kinds = {c[0] for c in node[1] if not isinstance(c, str)}
    wide = len(kinds) > KINDS
    for child in node[1]:
        if isinstance(child, str):
            if child.strip():
                texts.append(SPACES.sub(" ", child.strip()))
            continue
        kind = child[0].split(".", 1)[0] if wide else child[0]
        if kind.split(".", 1)[0] in UNREAD or child is BREAK:
            continue
        _place(order, kind)
        seen.setdefault(kind, []).append(from_tree(child))
    kids = {}
    for kind, parts in seen.items():
        kids[kind] = parts if len(parts) <= PLACES and kind.split(".", 1)[0] in POSITIONAL else [_fold(parts)]
        if len(kids[kind]) == 1:
            kids[kind][0][MOST] = min(2, len(parts))
    joined = " ".join(texts)
    return [1, 1, 1, len(joined), [hashlib.blake2b(joined.encode("utf-8", "replace"), digest_size=8).hexdigest()] if texts else None, order, kids]


def _place(order: list[list[str]], kind: str) -> None:
    """Adds a child to a page's order; a kind that comes again after others makes all since then one repeated group."""
    for i in range(len(order) - 1, -1, -1):
        if kind in order[i]:
            if i < len(order) - 1:
                order[i:] = [[k for group in order[i:] for k in group]]
            return
    order.append([kind])


def _fold(parts: list[list]) -> list:
    """Parts of the same pages as one repeated part; pairwise, so that the work stays in proportion."""
    while len(parts) > 1:
        parts = [align(parts[i], parts[i + 1], True) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def align(a: list, b: list, same: bool = False) -> list:
    """A wrapper of this form that covers a and b; same: both are of the same pages."""
    slot = a[SLOT] if a[SLOT] == b[SLOT] else []
    kids = {}
    for kind in [*a[KIDS], *(k for k in b[KIDS] if k not in a[KIDS])]:
        x, y = a[KIDS].get(kind), b[KIDS].get(kind)
        if x is None or y is None:
            kids[kind] = [[0, *p[1:]] for p in x or y]
        elif len(x) == len(y):
            kids[kind] = [align(p, q, same) for p, q in zip(x, y)]
        else:
            many = max(len(x), len(y), 2)
            kids[kind] = [align(_fold(x), _fold(y), same)]
            kids[kind][0][MOST] = min(2, many)
    order = _merged(a[ORDER], b[ORDER])
    if len(kids) > KINDS:
        order, kids = _by_tag(order, kids)
    pages = max(a[PAGES], b[PAGES]) if same else a[PAGES] + b[PAGES]
    return [min(a[LEAST], b[LEAST]), max(a[MOST], b[MOST]), pages, a[CHARS] + b[CHARS], slot, order, kids]


def _merged(x: list[list[str]], y: list[list[str]]) -> list[list[str]]:
    """One order of the kinds of both; where they disagree, the kinds between become one repeated group."""
    if x == y:
        return x
    out = [list(group) for group in x]
    at = -1
    for group in y:
        found = [i for i, g in enumerate(out) if any(k in g for k in group)]
        if not found:
            at += 1
            out.insert(at, list(group))
            continue
        lo, hi = found[0], found[-1]
        if lo < at:
            hi = max(hi, at)
            lo, at = min(lo, at), lo
        if hi > lo:
            out[lo : hi + 1] = [[k for g in out[lo : hi + 1] for k in g]]
        out[lo] += [k for k in group if k not in out[lo]]
        at = lo
    return out


def _by_tag(order: list[list[str]], kids: dict[str, list]) -> tuple[list[list[str]], dict[str, list]]:
    """Kinds told apart by tag alone, where a host's pages have very many class names."""
    by: dict[str, list] = {}
    for kind, parts in kids.items():
        by.setdefault(kind.split(".", 1)[0], []).extend(parts)
    folded: list[list[str]] = []
    for group in order:
        for kind in group:
            _place(folded, kind.split(".", 1)[0])
    out = {tag: [_fold(parts)] if len(parts) > 1 else parts for tag, parts in by.items()}
    for tag, parts in by.items():
        if len(parts) > 1:
            out[tag][0][LEAST], out[tag][0][MOST] = 0, 2
    return folded, out


def host_of(url: str | None) -> str:
    m = re.match(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _mass(part: list, kind: str, found: dict[int, tuple[int, int]]) -> tuple[int, int]:
    """(characters outside links, inside links) of a part's varying text on all pages, and of all its parts."""
    tag = kind.split(".", 1)[0]
    own = 0 if part[PAGES] >= ENOUGH_PAGES and part[SLOT] else part[CHARS]
    text, link = own, 0
    for k, parts in part[KIDS].items():
        for p in parts:
            t, u = _mass(p, k, found)
            text, link = text + t, link + u
    if tag == "a":
        text, link = 0, text + link
    found[id(part)] = text, link
    return text, link


def _marked(kind: str) -> bool:
    """Whether a kind is what HTML calls the article."""
    return kind.split(".", 1)[0] in ("article", "main") or ".role=main" in kind


def _template(part: list, kind: str, whole: list, mass: dict, region: int, marked: bool) -> bool:
    """Whether a part is furniture of the host's pages rather than text.

    Beside the text of a region that is no marked article, a container that
    every page has once and in which nothing varies is.
    """
    tag = kind.split(".", 1)[0]
    text, link = mass[id(part)]
    sure = part[PAGES] >= ENOUGH_PAGES
    name = named(kind)
    if name == "certain" or name and not (sure and region and text >= CLEARED * region):
        return True
    if not marked and region and sure and tag in CONTAINERS and part[LEAST] and part[MOST] == 1 and part[PAGES] >= whole[PAGES] and not text + link:
        return True
    return tag in LISTS and sure and 2 * part[PAGES] >= whole[PAGES] and link > 0 and link >= LINKED * (text + link)


def plan(whole: list) -> list:
    """What to read of a host's pages: [state, kids] a part; state 1 inside the region, 0 on its path, 2 outside it.

    Template parts are null.
    """
    mass: dict[int, tuple[int, int]] = {}
    _mass(whole, "#", mass)
    path, at, kind = [(whole, "#")], whole, "#"
    while True:
        best, most, sum_ = None, 0.0, 0
        for k, parts in at[KIDS].items():
            tag = k.split(".", 1)[0]
            for p in parts:
                text = mass[id(p)][0]
                name = named(k)
                if name == "certain" or name and text < CLEARED * mass[id(at)][0]:
                    continue
                sum_ += text
                weight = text * (2 if _marked(k) else 0.5 if name else 1)
                if tag in CONTAINERS and (tag != "span") and weight > most:
                    best, most = (p, k), weight
        own = mass[id(at)][0] - sum(mass[id(p)][0] for parts in at[KIDS].values() for p in parts)
        if best is None or not sum_:
            break
        marked = _marked(best[1])
        if mass[id(best[0])][0] < (BULK / 2 if marked else BULK) * (sum_ + own):
            break
        path.append(best)
        at, kind = best
        if marked:
            break
    region = mass[id(at)][0]
    on_path = {id(p): i for i, (p, _) in enumerate(path)}

    def made(part: list, state: int) -> list:
        kids = {}
        for k, parts in part[KIDS].items():
            tag, out = k.split(".", 1)[0], []
            for p in parts:
                if id(p) in on_path:
                    out.append(made(p, 1 if p is at else 0))
                elif k.startswith("header") and state != 1 or _template(p, k, whole, mass, region, _marked(kind)):
                    out.append(None)
                elif state == 1:
                    out.append(made(p, 1))
                else:
                    # A headline beside the region's path belongs to the text.
                    out.append(made(p, 1 if state == 0 and tag == "h1" and not p[SLOT] and at is not whole else 2))
            kids[k] = out
        return [state, kids]

    return made(whole, 1 if at is whole else 0)


def extract(page: str, reading: list) -> str:
    """The main text of a page, read through the plan of its host's wrapper."""
    root = parse(page)
    text, seen = _read(root, reading, 1)
    return text if seen else _read(root, reading, 2)[0]  # a page without the region: what is outside it


def _read(root: list, reading: list, state: int) -> tuple[str, bool]:
    """(text of the parts in this state, whether there are any)."""
    blocks: list[str] = []
    inline: list[str] = []
    seen = False

    def flush() -> None:
        text = SPACES.sub(" ", entities.unescape("".join(inline)) if inline else "").strip()
        if text:
            blocks.append(text)
        inline.clear()

    def visit(node: list, part: list, inside: bool) -> None:
        nonlocal seen
        tag = node[0].split(".", 1)[0]
        read = part[0] == state or state == 2 and part[0] == 0
        if read and part[0] == state and (state == 2 or tag != "h1" or inside):
            seen = True
        block = tag in BLOCK
        if block:
            flush()
        place: dict[str, int] = {}
        for child in node[1]:
            if isinstance(child, str):
                if read:
                    inline.append(child)
                continue
            kind = child[0]
            if kind == "br":
                inline.append(" ")
                continue
            if child is BREAK:
                flush()
                continue
            parts = part[1].get(kind if kind in part[1] else kind.split(".", 1)[0])
            i = place[kind] = place.get(kind, -1) + 1
            mine = None if parts is None else parts[i] if i < len(parts) and len(parts) > 1 else parts[0] if len(parts) == 1 else None
            if mine is not None:
                visit(child, mine, read)
            elif kind.split(".", 1)[0] in BLOCK:
                flush()
        if block:
            flush()

    visit(root, reading, False)
    flush()
    return "\n".join(blocks), seen


@lean
def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w, ensure_ascii=False) for w in held.values()], pa.string())], ["host", "wrapper"])
        held.clear()
        return batch

    for batch in batches:
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            host, made = host_of(url), from_tree(parse(page or ""))
            held[host] = align(held[host], made) if host in held else made
        if len(held) > 2000:
            yield out()
    yield out()


@lean
def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _merge_with(batches, lambda w: w)


@lean
def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _merge_with(batches, plan)


def _merge_with(batches: Iterator[pa.RecordBatch], made) -> Iterator[pa.RecordBatch]:
    """Aligns the wrappers of each host, which follow each other, and yields (host, made(wrapper))."""
    current, wrapper = None, None
    for batch in batches:
        done = []
        for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if host != current:
                if wrapper is not None:
                    done.append((current, wrapper))
                current, wrapper = host, json.loads(text)
            else:
                wrapper = align(wrapper, json.loads(text))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in done]), pa.array([json.dumps(made(w), ensure_ascii=False) for _, w in done])], ["host", "wrapper"])
    if wrapper is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.string()), pa.array([json.dumps(made(wrapper), ensure_ascii=False)])], ["host", "wrapper"])


def infer_wrappers(pages: DataFrame, salts: int = 32, plans: bool = False) -> DataFrame:
    """(host, wrapper) of every host of pages(url, html), one row a host; plans: what to read by it instead."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    local = rows.mapInArrow(_infer, "host string, wrapper string").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    merged = local.repartition("host", "salt").sortWithinPartitions("host").select("host", "wrapper").mapInArrow(_merge, "host string, wrapper string")
    return materialise(merged.repartition("host").sortWithinPartitions("host").mapInArrow(_plan if plans else _merge, "host string, wrapper string"), "wrappers")


#: The plan of a host without pages.
NOTHING: list = [0, {}]


@lean
def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list] = {}
    for batch in batches:
        texts = []
        for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
            if wrapper not in known:
                if len(known) > 500:
                    known.clear()
                known[wrapper] = json.loads(wrapper) if wrapper else NOTHING
            texts.append(extract(page or "", known[wrapper]))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of pages(page_id, url, html).

    A page is read through its host's wrapper.  Character references are decoded, white space inside a block is one space,
    blocks are joined in page order by one line end.  Null and empty pages and
    pages without main text have an empty text; a null or hostless url is the
    host ''.  Repeated rows give repeated results, other columns are ignored,
    an empty table gives an empty result.  Pages may be of any length and nest
    to any depth; beyond LEVELS, elements are read as part of the one above.
    """
    wrappers = infer_wrappers(pages, plans=True).withColumnRenamed("host", "_host")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("_host", host)
    joined = rows.join(wrappers, "_host", "left").select("page_id", "url", "html", "wrapper")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
