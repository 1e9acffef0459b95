"""Main text of web pages by differencing each page with the nearest page of its host.

Pages of a host are put in order of URL path; a page's partner is the neighbour with the longer
common path prefix, copies of the page passed over. Text lines of both are aligned by longest common subsequence, and lines that
both share are deleted: that is the site's furniture. Markup overrides the differences where it
is plain: lines of an article (or main, or a block named as content) stay although the partner has
them too (sites repeat articles), and menus, headers, footers, sidebars, notices, adverts, forms
and reader comments go although they differ from page to page. Where an article holds less text
than the unmarked lines that differ, these stay as well.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import BATCH_BYTES, bounded_batches, cut, shuffle_partitions

_OPENS = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?])")
_STOPS = re.compile(r">|=\s*([\"'])")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)
_RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
_DROP = frozenset("nav footer aside form button select dialog menu head svg object canvas audio video".split())
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_CLOSES_P = _BLOCK - {"br"}
#: Words in class or id values that mark furniture.
_FURNITURE = re.compile(
    r"^(?:ads?|adverts?|advertisements?|advertising|adsbygoogle|sponsor(?:ed|s)?|promo(?:tion|s)?|banner|cookies?|consent|gdpr|notices?|notifications?|alerts?|"
    r"newsletter|subscribe|subscription|signup|login|popup|modal|overlay|sidebar|widgets?|menus?|navbar|nav|navigation|breadcrumbs?|footer|masthead|"
    r"comments?|disqus|replies|respond|shar(?:e|ing)|social|related|recommend(?:ed|ations)?|pagination|pager|toolbar|searchbox)$"
)


#: Words that go with them in the name of a whole block, as in comment-list; others, as in related-work, make it something else.
_STRUCTURE = re.compile(r"^(?:list|item|body|box|bar|block|area|section|wrapper|wrap|container|inner|outer|content|header|footer|title|links?|buttons?|icons?|posts?|articles?|stories|form|unit|slot|top|bottom|left|right|main|page|site|user|reader|thread|media|meta)$")
#: Names of an article that isn't the page's own.
_OTHER = re.compile(r"^(?:comments?|replies|reply|respond|teasers?|promo(?:tion|s)?|related|recommend(?:ed|ations)?|sponsor(?:ed|s)?|ads?|adverts?|advertisements?)$")
#: Names of the block that holds the text.
_CONTENT = re.compile(r"^(?:content|(?:main|article|post|entry|page|story|body)[-_]?(?:content|body|text)|articlebody)$")
_CONTAINERS = frozenset("div section aside ul ol dl table details blockquote figure fieldset".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _names(attributes: str) -> Iterator[tuple[str, str]]:
    for m in _NAMED.finditer(attributes):
        yield m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower()


def _whole_name(token: str, words: re.Pattern) -> bool:
    """Whether a class or id consists of such words (one at least) and words of structure."""
    parts = [w for w in re.split(r"[-_]+", token) if w]
    return any(map(words.match, parts)) and all(words.match(w) or _STRUCTURE.match(w) for w in parts)


def _furniture(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether an element is furniture. Within an article only containers are judged by their names, and by whole ones; a heading's id is an anchor."""
    if tag in _DROP or tag == "header" and not in_main:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, value in _names(attributes):
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return tag not in _MAIN
        if name == "role" and value.strip() in _ROLES and tag not in _MAIN:
            return True
        if name not in ("class", "id") or name == "id" and tag in _HEADINGS:
            continue
        for token in value.split():
            if tag in _MAIN:
                if _whole_name(token, _OTHER):
                    return True
            elif in_main:
                if tag in _CONTAINERS and _whole_name(token, _FURNITURE):
                    return True
            elif not _CONTENT.match(token):
                words = re.split(r"[-_]+", token)
                if any(map(_FURNITURE.match, (token, words[0], words[-1]))) or words[-1] == "header":
                    return True
    return False


def _content(tag: str, attributes: str) -> bool:
    """Whether an element is an article, or a container that is named as the page's text."""
    if tag in _MAIN:
        return True
    return tag in ("div", "section", "td") and any(name == "role" and value == "main" or name in ("class", "id") and any(map(_CONTENT.match, value.split())) for name, value in _names(attributes))


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the > of a tag stands whose name ends at `at`, quoted values passed over; -1 if nowhere.
    last: where each quote stands last; one that isn't closed is a letter like others."""
    while m := _STOPS.search(page, at):
        if m[1] is None:
            return m.start()
        at = m.end()
        if at <= last[m[1]]:
            at = page.index(m[1], at) + 1
    return -1


def blocks(page: str | None) -> list[tuple[str, int]]:
    """Text lines of a page, in order, each with 0 (furniture), 1 (unmarked) or 2 (article).

    A tag that never ends is text, with all that follows. Takes time in proportion to the page,
    whatever it holds: what fails to close is looked for once.
    """
    page = page or ""
    out: list[tuple[str, int]] = []
    line: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # tag, furniture in or above it (1: by an open menu or header, 2: for sure), article in or above it
    count: dict[str, int] = {}  # of the stack's tags
    last = {q: page.rfind(q) for q in "\"'"}
    dropped, in_main = 0, False

    def close() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            out.append((text, 0 if dropped else 2 if in_main else 1))
        line.clear()

    def pop(depth: int) -> None:
        for t, _, _ in stack[depth:]:
            count[t] -= 1
        del stack[depth:]

    at, end = 0, len(page)
    while at < end:
        m = _OPENS.search(page, at)
        if not m:
            line.append(page[at:])
            break
        line.append(page[at : m.start()])
        if not m[2]:
            stop = page.find("-->", m.end()) + 2 if m[0] == "<!--" else page.find(">", m.end())
            at = stop + 1 if stop >= m.end() else end
            continue
        stop = _tag_end(page, m.end(), last)
        if stop < 0:
            line.append(page[m.start() :])
            break
        tag, attributes, at = m[2].lower(), page[m.end() : stop], stop + 1
        if tag in _BLOCK:
            close()
        if m[1]:
            if count.get(tag):
                close()
                pop(max(d for d in range(len(stack)) if stack[d][0] == tag) if stack[-1][0] != tag else len(stack) - 1)
        elif tag in _RAW:
            found = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = found.end() if found else end
            continue
        elif tag not in _VOID and not attributes.rstrip().endswith("/"):
            closes = "li" if tag == "li" else "p" if tag in _CLOSES_P else ""
            if closes and count.get(closes):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == closes:
                        pop(depth)
                        break
                    if stack[depth][0] in _BLOCK:
                        break
                dropped, in_main = stack[-1][1:] if stack else (0, False)
            inside = in_main or _content(tag, attributes)
            own = 0
            if _furniture(tag, attributes, in_main):
                own = 1 if tag in ("nav", "header") and dropped < 2 else 2
            elif dropped and not (dropped == 1 and tag in _MAIN and stack and stack[-1][0] in ("nav", "header", "li", "ul", "a")):
                own = dropped  # an article opened in an unclosed menu or header isn't part of it
            if own != dropped or inside != in_main:
                close()
            stack.append((tag, own, inside))
            count[tag] = count.get(tag, 0) + 1
        dropped, in_main = stack[-1][1:] if stack else (0, False)
    close()
    return out


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in a of a longest common subsequence of a and b (Hunt and Szymanski's way)."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places: dict[str, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple[int, object]] = []
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    out = {*range(head), *range(len(a) - tail, len(a))}
    link = links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def main_text(lines: list[tuple[str, int]], partner: list[tuple[str, int]] | None) -> tuple[str, int]:
    """The page's text after differencing with its partner, and the number of lines deleted as shared."""
    shared = common_lines([x for x, _ in lines], [x for x, _ in partner]) if partner else set()
    own = sum(len(x) for x, kind in lines if kind == 2)
    differing = sum(len(x) for i, (x, kind) in enumerate(lines) if kind == 1 and i not in shared)
    marked = own >= max(1, differing)  # else the marked article is a small part of the page's own text
    kept = [x for i, (x, kind) in enumerate(lines) if kind == 2 or kind == 1 and not marked and i not in shared]
    return "\n".join(kept), len(shared)


def _prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _lines_hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = [hashlib.blake2b("\n".join(x for x, _ in blocks(page)).encode("utf-8", "replace"), digest_size=8).digest() for page in batch["html"]]
        yield batch[["host", "path", "h"]].assign(page_id=batch["page_id"].astype("Int64"), lines=[int.from_bytes(x, "little", signed=True) for x in made])[["host", "path", "page_id", "h", "lines"]]


def _key(row) -> tuple:
    """A page's place in the order, as Spark sorts host, path, page_id and h."""
    return row["host"].encode("utf-8", "replace"), row["path"].encode("utf-8", "replace"), -(1 << 63) - 1 if row["page_id"] is None else row["page_id"], row["h"]


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a range's pages: the first, the one that starts its host's second run, the one that ends its
    host's run before the last, the last (a run: pages of a host with equal lines; null: none)."""
    first = second = before = last = None
    for batch in batches:
        for row in batch.to_dict("records"):
            row["page_id"] = None if pd.isna(row["page_id"]) else int(row["page_id"])
            if first is None:
                first = row
            elif last["host"] != row["host"]:
                second, before = second or {}, None
            elif last["lines"] != row["lines"]:
                second, before = row if second is None else second, last
            last = row
    if first is not None:
        yield pd.DataFrame({"edges": [json.dumps([first, second, before, last])]})


def _contexts(ranges: list[list[dict]]) -> list[tuple]:
    """(range, side, host, path, page_id, h) of the pages outside a range that its first and last runs
    have to be paired with: the nearest of the host with other lines."""
    out = []
    for i, (first, _, _, last) in enumerate(ranges):
        for side, own, step, outer, inner in ((0, first, -1, 3, 2), (2, last, 1, 0, 1)):
            j = i + step
            while 0 <= j < len(ranges) and ranges[j][outer]["host"] == own["host"]:
                # a range is passed over if all of it is the same run; {}: there is another host behind that run
                got = ranges[j][outer] if ranges[j][outer]["lines"] != own["lines"] else ranges[j][inner]
                if got or ranges[j][0]["host"] != ranges[j][3]["host"]:
                    if got:
                        out.append((i, side, got["host"], got["path"], got["page_id"], got["h"]))
                    break
                j += step
    return out


def _difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walks the pages of each range in order. Pages of a host that follow each other with equal lines are copies and
    form a run (host, lines, pages); the partner is a page of the run before or after, which may be a page of another
    range (side 0 or 2) that is here as a partner only. Holds three runs' lines at a time, and id, url, path and kinds
    of lines of the copies."""

    def emit(before, now, after):
        host, lines, pages = now
        near = [(run[2][at], run[1]) for run, at in ((before, -1), (after, 0)) if run is not None and run[0] == host]
        done = {}
        for page_id, url, path, kinds in pages:
            partner, other = max(near, key=lambda x: _prefix(x[0][2], path)) if near else (None, None)
            key = (kinds, id(other))
            if key not in done:
                done[key] = main_text(list(zip(lines, kinds)), other and [(x, 0) for x in other])
            text, shared = done[key]
            yield page_id, url, text, len(text), shared, partner[0] if partner else None

    out, size, state = [], 0, [None, None, None]  # range, run before, run now

    def step(part, after, real: bool):
        """The rows of the run now, which `after` follows; then takes that as the run now."""
        nonlocal state
        at, before, now = state
        same = at == part
        if now is not None:
            yield from emit(before, now, after if same else None)
            before = (*now[:2], now[2][-1:])
        state = [part, (before if same else None) if real else after, after if real else None]

    def rows():
        for batch in batches:
            for part, side, page_id, url, host, path, page in zip(*(batch[c] for c in ("part", "side")), batch["page_id"].astype("Int64"), batch["url"], batch["host"], batch["path"], batch["html"]):
                found = blocks(page)
                lines, own = [x for x, _ in found], (page_id, url, path, bytes(kind for _, kind in found))
                at, _, now = state
                if side == 1 and at == part and now is not None and now[0] == host and now[1] == lines:
                    now[2].append(own)
                else:
                    yield from step(part, (host, lines, [own]), side == 1)
        yield from step(None, None, False)

    for row in rows():
        out.append(row)
        size += len(row[2])
        if size > BATCH_BYTES:
            yield _frame(out)
            out, size = [], 0
    yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "text", "n_chars", "lines_shared", "partner_id"]).astype({"page_id": "Int64", "partner_id": "Int64"})
    # plain objects, so that a null stays one
    return out.assign(url=pd.Series([r[1] if isinstance(r[1], str) else None for r in rows], dtype=object), text=pd.Series([r[2] for r in rows], dtype=object))


def extract(pages: DataFrame) -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars, lines_shared, partner_id.

    Lines are the text of block elements (br ends one), with character references decoded and
    white space collapsed, joined by line feeds. Null and empty html gives an empty text. Null and
    malformed urls form a host of their own; a host with one page has no partner, and nothing of
    it counts as shared. Null page_ids and repeated rows are extracted like others: a page with
    the same lines is no partner, the nearest one that differs is. Columns other than page_id, url
    and html are ignored.

    Pages are dealt by ranges of (host, path, page_id, hash of html), so a host of any size spreads
    over tasks. Where a range begins and ends is found on narrow rows first; the pages of other
    ranges that its first and last runs are paired with, two a range at most, are sent along. So
    the result doesn't depend on the ranges.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    address = F.regexp_replace(url, r"[?#].*$", "")
    text = F.col("html").cast("string")
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text.alias("html"),
        F.lower(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/]*)", 1)).alias("host"),
        F.regexp_extract(address, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*)?(.*)$", 1).alias("path"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
    )
    parts, order = shuffle_partitions(spark), ("host", "path", "page_id", "h")
    narrow = cut(pages.select("host", "path", "page_id", "h", "html").mapInPandas(_lines_hash, "host string, path string, page_id long, h long, lines long"))
    ranged = narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranges = sorted((json.loads(r["edges"]) for r in ranged.mapInPandas(_edges, "edges string").collect()), key=lambda x: _key(x[0]))
    starts = spark.sparkContext.broadcast([_key(x[0]) for x in ranges])

    @F.pandas_udf("int")
    def part(host: pd.Series, path: pd.Series, page_id: pd.Series, h: pd.Series) -> pd.Series:
        rows = zip(host, path, (None if pd.isna(x) else int(x) for x in page_id), h)
        return pd.Series([bisect_right(starts.value, _key(dict(zip(order, x)))) - 1 for x in rows], dtype="int32")

    contexts = F.broadcast(spark.createDataFrame(_contexts(ranges), "part int, side int, __host string, __path string, __page_id long, __h long"))
    own = pages.withColumn("part", part(*order)).withColumn("side", F.lit(1))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order]
    beside = pages.join(contexts, same[0] & same[1] & same[2] & same[3]).select(own.columns).dropDuplicates(["part", "side"])
    # numbers whose hashes deal each range to a partition of its own
    slots = spark.range(16 * parts + 64).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("at")).agg(F.min(F.col("id").cast("int")).alias("slot"))
    slot = {r["at"]: r["slot"] for r in slots.collect()}
    slot_of = F.get(F.array(*[F.lit(slot.get(i, i)) for i in range(parts)]), F.col("part"))
    dealt = own.union(beside).withColumn("slot", slot_of).repartition(parts, "slot").drop("slot").sortWithinPartitions("part", "side", *order)
    return dealt.mapInPandas(_difference, "page_id long, url string, text string, n_chars long, lines_shared long, partner_id long")


def op8_page_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every row of `pages`."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
