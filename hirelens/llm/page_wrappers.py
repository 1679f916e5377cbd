"""Operator 2: main text of web pages by union-free wrappers of their hosts.

A wrapper is a union-free regular expression over tags and text: a sequence of tags, each with a sequence of its
own, constants, text slots, optional parts and repeated groups. Pages of a host are aligned one after another
with the wrapper so far. A text that differs becomes a slot, a tag that one side lacks becomes optional, a tag that
comes again makes a repeated group. Wrappers of parts of a host's pages are aligned in the same way, so no
task has to see all pages of a host. Beside it lie its slots: for each path of tags the letters in and outside links,
and a hash of the texts there as long as all pages agree. From both comes the part that holds the host's main
text, and each page is read along it.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, slices, texts_of, written

TEXT, GROUP = "#", "("
DEEPEST = 100  # what is nested deeper lies flat at this depth, but for tags that change the role of their text
HOSTS_HELD = 2000
DIFFERENT = 2  # with a single text there is nothing that could differ, so nothing is constant
MOST, HALF = 0.8, 0.5  # shares of a host's varying text that make a part the main one, without and with a telling name
LINKED = 0.8  # share of letters in links that makes a block a menu, on hosts whose pages name no main part
SALTS = 32
JOIN = "\x1f"

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>",
    re.S,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "title")
VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# What an opening tag ends, where it stands open.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOILERPLATE = set("nav footer aside form script style noscript template button select textarea iframe svg head title menu dialog".split())
UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|banner|sponsor(?:ed)?|promo|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|"
    r"footer|masthead|cookies?|notice|alert|popup|modal|comments?|replies|respond|disqus|related|share|social|subscribe|newsletter|"
    r"widget|toolbar|login|search|skip|contentinfo|complementary)(?:$|[\s_-]|\d)",
    re.I,
)
PARTS = set("html body div section center table tbody tr td".split())  # tags that may hold a host's main part
WANTED = re.compile(r"(?:^|[\s_-])(?:main|article|post-?content|entry-?content|story|article-?body|post-?body)(?:$|[\s_-])", re.I)


# --- pages as trees -------------------------------------------------------------------------


def parse(page: str) -> list:
    """The page as nested [symbol, children] and texts. Open tags that are never closed end with what holds them.

    Tags beyond ``DEEPEST`` get no node of their own unless they change the role of their text (a menu, say); blocks
    among them leave an empty node where they begin and end.
    """
    root: list = ["", []]
    opened = [("", root, "other", True)]  # name, the node that takes what comes, its role, whether the node is the tag's own
    at, end = 0, len(page)

    def add_text(raw: str) -> None:
        if raw:
            children = opened[-1][1][1]
            if children and isinstance(children[-1], str):
                children[-1] += raw
            else:
                children.append(raw)

    def close_from(k: int) -> None:
        broken = any(not own and name in BLOCKS for name, _, _, own in opened[k:])
        del opened[k:]
        if broken:
            opened[-1][1][1].append(["div", []])

    while at < end:
        m = MARKUP.search(page, at)
        if m is None:
            add_text(html.unescape(page[at:]))
            break
        add_text(html.unescape(page[at : m.start()]))
        at = m.end()
        if m["cdata"] is not None:
            add_text(m["cdata"])
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if m["end"] or m["end2"]:
            for k in range(len(opened) - 1, 0, -1):
                if opened[k][0] == name:
                    close_from(k)
                    break
            continue
        if name in RAW and not attrs.rstrip().endswith("/"):
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            opened[-1][1][1].append([name, []])
            continue
        ended = (("p",) if name in BLOCKS and name not in ENDS else ()) + ENDS.get(name, ())
        for k in range(len(opened) - 1, 0, -1):
            if opened[k][0] in ended:
                close_from(k)
                break
            if opened[k][0] in BLOCKS:
                break
        found = [next(x for x in g[1:] if x is not None) for g in (m.groups() for m in NAMED.finditer(attrs))] if attrs else []
        node = [" ".join([name, *(x.strip() for x in found)]), []]
        _, above, role, _ = opened[-1]
        if name in VOID or attrs.rstrip().endswith("/"):
            above[1].append(node)
            continue
        inside = role_of(node[0], role)
        if len(opened) < DEEPEST or inside != role:
            above[1].append(node)
            opened.append((name, node, inside, True))
        else:
            if name in BLOCKS:
                above[1].append(node)
            opened.append((name, above, role, False))
    return root[1]


# --- wrappers -------------------------------------------------------------------------------
# An item is [symbol, quantity, content]: quantity is 1 for optional plus 2 for repeated; content is the
# constant or None (a slot) of a text, the items of a tag or group.


def items_of(children: list) -> list:
    """The wrapper of one page's siblings."""
    out: list = []
    for child in children:
        if isinstance(child, str):
            words = " ".join(child.split())
            if not words:
                continue
            item = [TEXT, 0, words[:64] + str(len(words)) + (md5(words.encode("utf-8", "replace")).hexdigest() if len(words) > 64 else "")]
        else:
            item = [child[0], 0, items_of(child[1])]
        if out and out[-1][0] == item[0]:
            out[-1] = merge(out[-1], item)
            out[-1][1] |= 2
        else:
            out.append(item)
    return regroup(out)


def merge(a: list, b: list) -> list:
    """The wrapper that covers two items of one symbol."""
    if a[0] == TEXT:
        return [TEXT, a[1] | b[1], a[2] if a[2] == b[2] else None]
    return [a[0], a[1] | b[1], align(a[2], b[2])]


def _symbols(item: list) -> set[str]:
    return {x[0] for x in item[2]} if item[0] == GROUP else {item[0]}


def align(x: list, y: list) -> list:
    """Align two sequences: what both have is merged, what one lacks becomes optional."""
    if x == y:
        return x
    n, m = len(x), len(y)
    keys_x, keys_y = [_symbols(i) for i in x], [_symbols(i) for i in y]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            hit = best[i + 1][j + 1] + 1 if x[i][0] == y[j][0] and keys_x[i] & keys_y[j] else 0
            best[i][j] = max(hit, best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and x[i][0] == y[j][0] and keys_x[i] & keys_y[j] and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(merge(x[i], y[j]) if x[i][0] != GROUP else _group([x[i], y[j]]))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([x[i][0], x[i][1] | 1, x[i][2]])
            i += 1
        else:
            out.append([y[j][0], y[j][1] | 1, y[j][2]])
            j += 1
    return regroup(out)


def _group(items: list) -> list:
    """A repeated group of the items and of the members of those that are groups; each member is optional in it."""
    members: dict[str, list] = {}
    for item in items:
        for member in item[2] if item[0] == GROUP else [item]:
            known = members.get(member[0])
            members[member[0]] = merge(known, member) if known else member
    return [GROUP, 2 | min(i[1] & 1 for i in items), [[s, q | 1, c] for s, q, c in members.values()]]


def regroup(items: list) -> list:
    """Make one repeated group of every stretch in which a symbol comes again."""
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for k, item in enumerate(items):
        for s in _symbols(item):
            first.setdefault(s, k)
            last[s] = k
    if all(first[s] == last[s] for s in first):
        return items
    out, k = [], 0
    while k < len(items):
        stop, reach = k, k
        while stop <= reach:
            reach = max([reach, *(last[s] for s in _symbols(items[stop]))])
            stop += 1
        out.append(items[k] if stop == k + 1 else _group(items[k:stop]))
        k = stop
    return out


# --- slots ------------------------------------------------------------------------------------


def slots_of(tree: list) -> dict[str, list]:
    """By path of tags: letters outside and in links, and a hash of the path's texts on one page in their order."""
    texts: dict[str, list] = {}

    def walk(children: list, path: str, linked: bool) -> None:
        for child in children:
            if isinstance(child, str):
                words = " ".join(child.split())
                if words:
                    texts.setdefault(path, [linked, []])[1].append(words)
            else:
                walk(child[1], path + JOIN + child[0], linked or child[0].split(" ", 1)[0] == "a")

    walk(tree, "", False)
    out = {}
    for path, (linked, words) in texts.items():
        letters = sum(map(len, words))
        digest = md5("\n".join(words).encode("utf-8", "replace")).hexdigest()[:16]
        out[path] = [0 if linked else letters, letters if linked else 0, digest]
    return out


def meet_slots(known: dict[str, list], more: dict[str, list]) -> dict[str, list]:
    """The slots of all pages behind both: letters are summed, a hash stays where both agree or only one has the path."""
    for path, (plain, linked, digest) in more.items():
        mine = known.get(path)
        known[path] = [mine[0] + plain, mine[1] + linked, digest if mine[2] == digest else None] if mine else [plain, linked, digest]
    return known


def main_path(items: list, slots: dict[str, list]) -> str | None:
    """The path of the lowest part that holds most of a host's varying text outside links; None if that is no part of the page.

    A part is a tag that comes once on a page and has blocks inside. It needs ``MOST`` of the text of what holds it, or
    ``HALF`` if its name tells, and a varying h1 has to lie in it. Menus, footers and the like do not count.
    """
    at, best = "", None

    def letters(items: list, path: str, role: str, headings: bool = False) -> int:
        total = 0
        for item in items:
            for symbol, _, content in item[2] if item[0] == GROUP else [item]:
                if symbol == TEXT:
                    plain, _, digest = slots.get(path, (0, 0, ""))
                    total += plain if digest is None and (not headings or JOIN + "h1" in path) else 0
                elif (inside := role_of(symbol, role)) != "out":
                    total += letters(content, path + JOIN + symbol, inside, headings)
        return total

    while True:
        whole, headed = letters(items, at, "other"), letters(items, at, "other", True)
        for symbol, quantity, content in items:
            name = symbol.split(" ", 1)[0]
            if symbol in (TEXT, GROUP) or quantity & 2 or name not in PARTS or role_of(symbol, "other") == "out":
                continue
            blocks = {x[0].split(" ", 1)[0] for i in content for x in (i[2] if i[0] == GROUP else [i])} & BLOCKS
            inner = at + JOIN + symbol
            share = letters(content, inner, "other") / whole if whole else 0
            telling = WANTED.search(symbol.partition(" ")[2]) is not None
            if blocks and share >= (HALF if telling else MOST) and letters(content, inner, "other", True) == headed:
                at, items = inner, content
                best = at if name not in ("html", "body") else best
                break
        else:
            return best


# --- reading along a wrapper ----------------------------------------------------------------


def role_of(symbol: str, above: str) -> str:
    """main, other or out, of what stands in a tag, given that of what holds it."""
    name, _, named = symbol.partition(" ")
    if above == "out" or name in BOILERPLATE or (name == "header" and above != "main"):
        return "out"
    if named and UNWANTED.search(named) and not (name in ("article", "main", "body", "html") or WANTED.search(named)):
        return "out"
    if name in ("article", "main") or (named and WANTED.search(named)):
        return "main"
    return above


@lru_cache(maxsize=1024)
def _index(wrapper: str) -> dict:
    """Nested lookup by symbol: role of the text there, whether it is a constant to leave out, and the tags inside."""
    data = json.loads(wrapper)
    slots = data.get("slots", {})
    compared = len(data["pages"]) >= DIFFERENT
    stated = _names_main(data["items"], "other")
    chosen = main_path(data["items"], slots) if compared and not stated else None

    def linked(items: list, path: str) -> tuple[int, int]:
        plain, links, _ = slots.get(path, (0, 0, None))
        for item in items:
            for symbol, _, content in item[2] if item[0] == GROUP else [item]:
                if symbol != TEXT:
                    below = linked(content, path + JOIN + symbol)
                    plain, links = plain + below[0], links + below[1]
        return plain, links

    def build(items: list, role: str, path: str) -> dict:
        out: dict = {}
        for item in items:
            for symbol, _, content in item[2] if item[0] == GROUP else [item]:
                if symbol == TEXT:
                    out[TEXT] = (role, compared and path in slots and slots[path][2] is not None)
                    continue
                below = path + JOIN + symbol
                inside = role_of(symbol, role)
                if compared and not stated and inside != "out":
                    # The host's part decides, whatever other parts are called.
                    inside = "main" if below == chosen or role == "main" else "other" if chosen else inside
                    if inside == "other" and symbol.split(" ", 1)[0] in BLOCKS:
                        plain, links = linked(content, below)
                        inside = "out" if links and links >= LINKED * (plain + links) else inside
                out[symbol] = (inside, build(content, inside, below))
        return out

    return build(data["items"], "other", "")


def _names_main(items: list, role: str) -> bool:
    for item in items:
        for symbol, _, content in item[2] if item[0] == GROUP else [item]:
            if symbol != TEXT and (inside := role_of(symbol, role)) != "out":
                if symbol.split(" ", 1)[0] in ("article", "main") or _names_main(content, inside):
                    return True
    return False


def main_text(page: str, wrapper: str) -> str:
    """The text in the page's main slots, block by block; without such slots, in all slots that are not left out.

    Where a host's pages have article or main elements, these are the main part. Elsewhere it is the part that holds most
    of the text in which the host's pages differ, and names only tell menus, adverts and the like apart. Outside
    a main part, texts that are the same on all pages and blocks of links are left out. All that needs two pages
    with different texts, since copies of a page do not tell what is constant.
    """
    return read_tree(parse(page), _index(wrapper))


def read_tree(tree: list, index: dict) -> str:
    blocks: dict[str, list[str]] = {"main": [], "other": []}
    open_block: dict[str, list[str]] = {"main": [], "other": []}

    def close() -> None:
        for role, parts in open_block.items():
            words = " ".join("".join(parts).split())
            if words:
                blocks[role].append(words)
            parts.clear()

    def walk(children: list, known: dict, role: str) -> None:
        for child in children:
            if isinstance(child, str):
                here, constant = known.get(TEXT, (role, False))
                if here == "main" or (here == "other" and not constant):
                    open_block[here].append(child)
                continue
            name = child[0].split(" ", 1)[0]
            inside, below = known.get(child[0], (None, {}))
            if inside is None:
                inside = role_of(child[0], role)
            block = name in BLOCKS
            if block:
                close()
            elif name == "br":
                for parts in open_block.values():
                    parts.append(" ")
            if inside != "out":
                walk(child[1], below, inside)
            if block:
                close()

    walk(tree, index, "other")
    close()
    return "\n".join(blocks["main"] or blocks["other"])


# --- on Spark -------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _combine(kept: dict[str, list], host: str, items: list, pages: list[str], slots: dict[str, list]) -> None:
    """Hashes of different texts are kept up to ``DIFFERENT``, more do not count."""
    known = kept.get(host)
    if known:
        kept[host] = [align(known[0], items), sorted({*known[1], *pages})[:DIFFERENT], meet_slots(known[2], slots)]
    else:
        kept[host] = [items, pages, slots]


def _rows(kept: dict[str, list]) -> pa.RecordBatch:
    texts = [json.dumps({"items": i, "pages": n, "slots": s}, ensure_ascii=False, separators=(",", ":")) for i, n, s in kept.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(texts, pa.string())], ["host", "wrapper"])


def wrappers(pages: DataFrame, url: str = "url", column: str = "html") -> DataFrame:
    """(host, wrapper): the wrapper of each host as JSON, inferred from all its pages.

    Tasks infer wrappers of the pages they read, these are aligned within ``SALTS`` parts of a host, and then
    those of the parts. Pages without a host share the empty one; null pages have no part in it.
    """
    prepare(pages.sparkSession)

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {}
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tree = parse(page)
                _combine(kept, host, items_of(tree), [md5(read_tree(tree, {}).encode("utf-8", "replace")).hexdigest()], slots_of(tree))
                if len(kept) > HOSTS_HELD:
                    yield _rows(kept)
                    kept = {}
        if kept:
            yield _rows(kept)

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {}
        for batch in batches:
            for text in batch.column(batch.schema.get_field_index("wrapper")).to_pylist():
                data = json.loads(text)
                _combine(kept, key[0].as_py(), data["items"], data["pages"], data["slots"])
        yield _rows(kept)

    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(column).alias("html")).where(F.col("html").isNotNull())
    found = rows.mapInArrow(infer, "host string, wrapper string")
    parts = found.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    once = parts.groupBy("host", "salt").applyInArrow(meet, "host string, wrapper string")
    return once.groupBy("host").applyInArrow(meet, "host string, wrapper string")


def extract(pages: DataFrame, url: str = "url", column: str = "html", known: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``text`` (main text, empty if there is none) and ``n_chars`` (its code points) for ``column``.

    ``known`` gives wrappers made before; otherwise they are inferred from these pages. Null and empty pages have
    the empty text; repeated rows stay. Columns called text or n_chars are replaced.
    """
    if known is None:
        known = written(wrappers(pages, url, column), "wrappers")
    names = [c for c in pages.columns if c.lower() not in ("text", "n_chars", column.lower())]
    rows = pages.withColumn("__host", host_of(F.col(url)))
    made = known.select(F.col("host").alias("__host"), F.col("wrapper").alias("__wrapper"))
    both = rows.join(made, "__host", "left").select(*names, F.col(column).alias("__html"), "__wrapper")
    blank = json.dumps({"items": [], "pages": []})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__html"):
                texts = texts_of(part.column(len(names))).to_pylist()
                along = part.column(len(names) + 1).to_pylist()
                found = [main_text(t, w or blank) if t else "" for t, w in zip(texts, along)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(names))), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
                    [*names, "text", "n_chars"],
                )

    schema = both.select(*names).schema.add("text", "string").add("n_chars", "long")
    return both.mapInArrow(read, schema)
