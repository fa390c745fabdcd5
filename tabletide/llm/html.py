"""Main text of web pages, by deducing each host's template.

Pages of one host are compared.  Tokens are words, and the tags that open blocks, told apart by their place in the tree.  They are grouped
in equivalence classes by their occurrence vectors: how often each occurs in each of the pages.  A class of tokens that stand once on
nearly all pages, always in one order, is the template's frame.  It cuts each page in slots, and the same word in another slot is
another token, with an occurrence vector of its own; so the frame grows inside its slots until no class is left that is valid there.
Classes with more occurrences are valid in one slot if their tokens follow each other in turn.  What the template leaves open in its
slots is extracted: a block goes if all its words stand where the template has them; so do blocks in elements that by their meaning
hold no article.
"""

from __future__ import annotations

import html
import re
import tempfile
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import importable
from .common import checkpoint

#: Pages of a host that are compared at a time, at least, if it has as many; beyond twice as many they are compared in further groups.
GROUP_PAGES = 96
#: Bytes of pages that a task holds; a group's pages beyond it wait in a file, and are parsed anew each time they are looked at.
GROUP_BYTES = 16 << 20
#: A host is hot, and dealt over several tasks, if it has over one in so many of all pages; so there are fewer hot hosts than this.
HOT_SHARE = 4096
#: Fewer pages than this tell nothing of a template.
LEAST_PAGES = 4
#: The share of a group's pages that a template's token is on, and how many tokens a class has at least.
SUPPORT = 0.8
LEAST_TOKENS = 2
#: Elements below this depth have their parents' place in the tree.
DEEPEST = 64

#: Elements whose text is never shown, or is not marked up.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math object audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no part of an article.
APART = frozenset("head nav footer aside form button select option datalist dialog menu fieldset label output map".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption button select option optgroup legend".split()
)
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored sponsors promo promotion promoted cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup paywall sidebar side related recommended recommendations comment comments commentlist respond disqus replies reply share sharing social breadcrumb breadcrumbs menu nav navbar navigation topbar toolbar footer masthead popup modal overlay login search searchbox widget widgets pagination pager skip outbrain taboola contentinfo complementary".split()
)
#: First words of names of what an element holds or lacks.
HOLDING = frozenset("has with without no".split())
_KEPT = frozenset(("html", "body", "main", "article"))
#: What a start tag closes.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _hides(name: str, attrs: str) -> bool:
    """Whether an element's attributes say that it is no part of an article."""
    if name in _KEPT and name != "article" or not attrs:
        return False
    bare = _ATTR.sub(" ", attrs).lower().split()
    if "hidden" in bare:
        return True
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        # `has-sidebar` says what an element holds, not what it is
        names = (_WORD.findall(x) for x in value.split()) if key in ("class", "id", "role") else ()
        if any(x and x[0] not in HOLDING and not MARKS.isdisjoint(x) for x in names):
            return True
        if key == "style" and _HIDDEN.search(value) or key == "aria-hidden" and value == "true" or key == "hidden":
            return True
    return False


class Page:
    """A page's blocks in order: (path, words, apart, in an article, words in links)."""

    __slots__ = ("blocks", "has_article")

    def __init__(self, source: str):
        self.blocks: list[tuple[str, list[str], bool, bool, int]] = []
        self.has_article = False
        stack: list[tuple[str, bool, bool, str]] = []  # name, apart, in an article, path
        apart, inside, path = False, False, ""
        buffer: list[str] = []
        links, linked = 0, 0
        open_: Counter = Counter()  # elements by name
        at, size = 0, len(source)

        def flush():
            nonlocal linked
            if buffer:
                words = html.unescape("".join(buffer)).split()
                buffer.clear()
                if words:
                    self.blocks.append((path, words, apart, inside, linked))
            linked = 0

        def text(a: int, b: int):
            nonlocal linked
            if b > a:
                part = source[a:b]
                buffer.append(part)
                if links:
                    linked += len(part.split())

        def pop_to(depth: int):
            nonlocal apart, inside, path, links
            for name, *_ in stack[depth:]:
                links -= name == "a"
                open_[name] -= 1
            del stack[depth:]
            _, apart, inside, path = stack[-1] if stack else ("", False, False, "")

        while at < size:
            m = _TAG.search(source, at)
            if m is None:
                text(at, size)
                break
            text(at, m.start())
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing = bool(m[1] or m[4])
            if name in BLOCK:
                flush()
            elif name == "br":
                buffer.append(" ")
            if closing:
                if not open_[name]:
                    continue
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        pop_to(depth)
                        break
                    if name not in BLOCK and stack[depth][0] in BLOCK:
                        break
                continue
            attrs = m[3] or m[6] or ""
            if name in RAW:
                if not attrs.rstrip().endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                    at = end.end() if end else size
                continue
            if name in VOID:
                continue
            if name in BLOCK and open_["p"]:  # a block closes an open paragraph
                depth = max(k for k, x in enumerate(stack) if x[0] == "p")
                if not any(x[0] in BLOCK and x[0] != "p" for x in stack[depth + 1 :]):
                    pop_to(depth)
            for other in (x for x in _CLOSES.get(name, ()) if open_[x]):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == other:
                        pop_to(depth)
                        break
                    if stack[depth][0] in ("ul", "ol", "dl", "table", "select"):
                        break
            hides = apart or name in APART or _hides(name, attrs) or name == "header" and not inside
            if name == "article" and not hides or name == "main" or 'articlebody' in attrs.lower():
                inside = True
                self.has_article |= not hides
            apart = hides
            if name in BLOCK:
                if len(stack) < DEEPEST:
                    path = f"{path}/{name}"
            elif name == "a":
                links += 1
            stack.append((name, apart, inside, path))
            open_[name] += 1
        flush()


#: The word that stands for a block's opening tag.
OPENING = ""


def _frequent(pages: Sequence[Page], order: Sequence[int], least: int) -> dict[str, dict[str, int]]:
    """By path, the words on `least` pages or more, each with a number.

    What misses more pages than it may is let go, and what comes up too late isn't begun: pages that share little leave nothing held.
    """
    may_miss = len(pages) - least
    found: dict[str, dict[str, int]] = {}
    for seen, i in enumerate(order):
        own: dict[str, set[str]] = defaultdict(set)
        for path, words, *_ in pages[i].blocks:
            own[path].update(words)
        for path, words in own.items():
            words.add(OPENING)
            held = found.setdefault(path, {}) if seen <= may_miss else found.get(path, {})
            for w in words if seen <= may_miss else held.keys() & words:
                held[w] = held.get(w, 0) + 1
        if seen >= may_miss and (seen - may_miss) % 8 == 0 or seen == len(pages) - 1:
            found = {p: h for p, held in found.items() if (h := {w: k for w, k in held.items() if seen + 1 - k <= may_miss})}
    names = ((p, w) for p in sorted(found) for w in sorted(found[p]))
    for number, (p, w) in enumerate(names):
        found[p][w] = number
    return found


def _rising(places: np.ndarray) -> np.ndarray:
    """Which tokens stand in one order on every page, from a row of places for each, -1 where it is missing.

    The rows come in the order of one page.  Page by page the longest run of places that rise is kept.
    """
    keep = np.arange(len(places))
    for column in places.T:
        own = column[keep]
        there = np.flatnonzero(own >= 0)
        if (np.diff(own[there]) > 0).all():
            continue
        tails: list[int] = []
        ends: list[int] = []  # index of the last token of the best run of each length
        back: dict[int, int] = {}
        for k in there.tolist():
            at = bisect_left(tails, own[k])
            back[k] = ends[at - 1] if at else -1
            tails[at : at + 1] = [own[k]]
            ends[at : at + 1] = [k]
        run, k = set(), ends[-1]
        while k >= 0:
            run.add(k)
            k = back[k]
        keep = keep[[k in run or own[k] < 0 for k in range(len(keep))]]
    return keep


class _Tokens:
    """Occurrences of the frequent tokens of some pages: the page, the token's number and the place of each."""

    def __init__(self, pages: Sequence[Page], numbers: dict[str, dict[str, int]]):
        self.sizes: list[int] = []
        page, token, place = [], [], []
        for i in range(len(pages)):
            at, t, x = 0, [], []
            for path, words, *_ in pages[i].blocks:
                if want := numbers.get(path):
                    own = [(want[w], k) for k, w in enumerate((OPENING, *words), at) if w in want]
                    t += [n for n, _ in own]
                    x += [k for _, k in own]
                at += 1 + len(words)
            self.sizes.append(at)
            page.append(np.full(len(t), i, np.int64))
            token.append(np.array(t, np.int64))
            place.append(np.array(x, np.int64))
        self.page, self.token, self.place = np.concatenate(page), np.concatenate(token), np.concatenate(place)
        self.first = np.concatenate(([0], np.cumsum([len(x) for x in page])))
        self.kinds = sum(map(len, numbers.values()))

    def neighbours(self, frame: np.ndarray) -> np.ndarray:
        """The frame with the tokens that stand next to one of its tokens wherever that is: those have its vector, and its place tells them apart."""
        span = max(self.sizes) + 2
        keys = self.page * span + self.place
        grown = True
        while grown and len(keys):
            grown = False
            for step in (-1, 1):
                there = frame >= 0
                place = np.arange(frame.shape[1])[None, :] * span + frame + step
                at = np.minimum(np.searchsorted(keys, place), len(keys) - 1)
                token = np.where(there & (keys[at] == place), self.token[at], -1)
                free = ~np.isin(place, (place - step)[there])
                one = np.where(there, token, token.max(1, initial=-1)[:, None])
                rows = np.flatnonzero((one.max(1) >= 0) & (one.min(1) == one.max(1)) & (free | ~there).all(1))
                if len(rows):
                    frame = np.insert(frame, rows + (step > 0), np.where(there[rows], frame[rows] + step, -1), axis=0)
                    grown = True
        return frame

    def slots(self, frame: np.ndarray) -> np.ndarray:
        """The slot of each occurrence: the number of the frame's last token before it, rows of places by page, from 1; -1 if it is in the frame."""
        out = np.empty(len(self.page), np.int64)
        for i in range(len(self.sizes)):
            there = np.flatnonzero(frame[:, i] >= 0)
            own = slice(self.first[i], self.first[i + 1])
            places = np.concatenate(([-1], frame[there, i]))
            at = np.searchsorted(places, self.place[own], "right") - 1
            out[own] = np.where(places[at] == self.place[own], -1, np.concatenate(([0], there + 1))[at])
        return out

    def vectors(self, slot: np.ndarray):
        """Tokens told apart by slot, ascending; how often each is on each page; and the occurrences in the order of token, page and place."""
        free = np.flatnonzero(slot >= 0)
        name = slot * self.kinds + self.token
        order = free[np.lexsort((self.place[free], self.page[free], name[free]))]
        names, index = np.unique(name[order], return_inverse=True)
        counts = np.zeros((len(names), len(self.sizes)), np.int32)
        np.add.at(counts, (index, self.page[order]), 1)
        return names, counts, order


def _classes(vectors: np.ndarray) -> list[np.ndarray]:
    """Rows with equal vectors, larger classes first."""
    if not len(vectors):
        return []
    _, index, size = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
    members = np.split(np.argsort(index.ravel(), kind="stable"), np.cumsum(size)[:-1])
    return sorted(members, key=lambda m: (-len(m), m[0]))


def template(pages: Sequence[Page], order: Sequence[int] | None = None) -> list[np.ndarray] | None:
    """For each page, which of its tokens belong to the template that the pages share; None of too few pages.

    A page's tokens are, block by block, the opening tag and the words.  Pages are counted in `order`, of which nothing depends but memory.
    """
    n = len(pages)
    if n < LEAST_PAGES:
        return None
    least = max(LEAST_PAGES - 1, int(SUPPORT * n))
    tokens = _Tokens(pages, _frequent(pages, order or range(n), least))
    frame = np.zeros((0, n), np.int64)
    grown = True
    while grown:
        names, counts, by_name = tokens.vectors(tokens.slots(frame))
        there = counts > 0
        once = (counts.max(1, initial=0) == 1) & (there.sum(1) >= least)
        first = np.cumsum(counts.sum(1)) - counts.sum(1)
        known = {x.tobytes() for x in frame >= 0}
        slot_of, grown, added = names // max(1, tokens.kinds), False, []
        for slot in np.unique(slot_of[once]).tolist():
            rows = np.flatnonzero(once & (slot_of == slot))
            for members in _classes(there[rows]):
                # a class of its own has several tokens; a single one may join a class that the frame has
                if len(members) < LEAST_TOKENS and there[rows[members[0]]].tobytes() not in known:
                    continue
                own = rows[members]
                places = np.full((len(own), n), -1, np.int64)
                for k, r in enumerate(own.tolist()):
                    at = by_name[first[r] : first[r] + counts[r].sum()]
                    places[k, tokens.page[at]] = tokens.place[at]
                places = places[np.argsort(places[:, np.flatnonzero(there[own[0]])[0]], kind="stable")]
                places = places[_rising(places)]
                if len(places) >= LEAST_TOKENS or places.size and (places[0] >= 0).tobytes() in known:
                    added.append((slot, places))
                    grown = True
                    break
        for slot, places in reversed(added):
            frame = np.insert(frame, slot, places, axis=0)
        if grown:
            frame = tokens.neighbours(frame)
    flags = [np.zeros(k, bool) for k in tokens.sizes]
    for i in range(n):
        flags[i][frame[frame[:, i] >= 0, i]] = True
    # classes that come again inside a slot
    names, counts, by_name = tokens.vectors(tokens.slots(frame))
    again = np.flatnonzero((counts.max(1, initial=0) > 1) & ((counts > 0).sum(1) >= least))
    first = np.cumsum(counts.sum(1)) - counts.sum(1)
    slot_of = names[again] // max(1, tokens.kinds)
    for members in _classes(np.concatenate((slot_of[:, None], counts[again]), axis=1)):
        runs = [by_name[first[r] : first[r] + counts[r].sum()] for r in again[members].tolist()]
        runs.sort(key=lambda x: tokens.place[x[0]])
        lead = tokens.place[runs[0]]
        same = np.diff(tokens.page[runs[0]]) == 0
        turns = [x for x in runs if (lead <= tokens.place[x]).all() and (tokens.place[x][:-1] < lead[1:])[same].all()]
        if len(turns) >= LEAST_TOKENS:
            for x in turns:
                for i, at in zip(tokens.page[x].tolist(), tokens.place[x].tolist()):
                    flags[i][at] = True
    return flags


def _texts(pages: Sequence[Page], order: Sequence[int] | None = None) -> Iterator[str]:
    shared = template(pages, order)
    for i, page in enumerate(pages):
        blocks, free, at = [], [], 0
        for _, words, apart, inside, linked in page.blocks:
            # where the page marks an article, nothing outside it is main text; elsewhere blocks that are links mostly are not either
            if not apart and (inside if page.has_article else linked * 2 <= len(words)):
                blocks.append(words)
                if shared is None or not shared[i][at + 1 : at + 1 + len(words)].all():
                    free.append(words)
            at += 1 + len(words)
        yield "\n".join(map(" ".join, free or blocks))


def main_texts(sources: list[str | None]) -> list[str]:
    """The main text of each of some pages of one host."""
    return list(_texts([Page(x or "") for x in sources]))


class Sources(Sequence):
    """Pages that are parsed each time they are looked at, from rows [page_id, url, text or file, size, repetitions]."""

    def __init__(self, rows: list[list]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> Page:
        source = self.rows[i][2]
        if not isinstance(source, str):
            source.seek(0)
            source = source.read().decode("utf-8", "surrogatepass")
        return Page(source)

    def texts(self) -> Iterator[tuple[int | None, str | None, str]]:
        """Of each row and each repetition."""
        shortest = sorted(range(len(self)), key=lambda i: self.rows[i][3])
        pages = [self[i] for i in range(len(self))] if all(isinstance(r[2], str) for r in self.rows) else self
        for (page_id, url, _, _, n), text in zip(self.rows, _texts(pages, shortest)):
            for _ in range(n):
                yield page_id, url, text


def _filed(source: str):
    """A nameless file of the text, in this machine's own folder, that goes when it is no longer referred to."""
    file = tempfile.TemporaryFile()
    file.write(source.encode("utf-8", "surrogatepass"))
    return file


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (host, bucket, page_id, url, html), those of a host and bucket together and repeated ones one after another."""
    now, before, held, size = None, None, [], 0

    def table(done):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _SCHEMA)], schema=_SCHEMA)

    def out(rows):
        done, n = [], 0
        for page_id, url, text in Sources(rows).texts():
            done.append((page_id, url, text, len(text)))
            n += len(text)
            if n > GROUP_BYTES:
                yield table(done)
                done, n = [], 0
        if done:
            yield table(done)

    def last():
        # what is left is not cut so that a few pages stand alone
        half = len(held) // 2 if len(held) > GROUP_PAGES else len(held)
        for rows in (held[:half], held[half:]):
            if rows:
                yield from out(rows)

    for batch in batches:
        for host, bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (host, bucket) != now:
                yield from last()
                now, before, held, size = (host, bucket), None, [], 0
            if row == before:
                held[-1][4] += 1
                continue
            before, source = row, row[2] or ""
            if len(held) >= 2 * GROUP_PAGES:
                yield from out(held[:GROUP_PAGES])
                held = held[GROUP_PAGES:]
                size = sum(r[3] for r in held if isinstance(r[2], str))
            fits = size + len(source) <= GROUP_BYTES
            size += len(source) * fits
            held.append([row[0], row[1], source if fits else _filed(source), len(source), 1])
    yield from last()


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of `pages`, from the whole html.

    text has the page's blocks outside menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments and the
    host's template, in order, joined by newlines; in a block character references are decoded and each run of white space is one
    space.  n_chars counts its characters.  A null html, or one without such blocks, has the empty text.  If nothing on a page differs
    from the template, its blocks are kept, as on hosts with too few pages to compare.  Pages with a null url count as one host's.
    Repeated rows are answered each; other columns are ignored; an empty table gives an empty result.

    Pages of one host are compared with 47 others at least, if it has as many: pages of a hot host are dealt out by a hash in buckets of
    GROUP_PAGES to twice as many on average, other hosts' pages stay together; a task cuts what it gets of a host in groups by their
    number, never by their length.  Repeated rows count once there.  Tasks hold about two groups of pages at a time, of long pages
    GROUP_BYTES.
    """
    importable(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(pages[url_col].cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(host.alias("host"), pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    rows = rows.withColumn("key", F.xxhash64("page_id", "url", "html"))
    counts = checkpoint(rows.select("host", "key").distinct().groupBy("host").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.where((F.col("count") * HOT_SHARE > total) & (F.col("count") >= 2 * GROUP_PAGES)).select("host", F.floor(F.col("count") / GROUP_PAGES).alias("buckets"))
    bucket = F.coalesce(F.pmod(F.xxhash64("key", F.lit("bucket")), "buckets"), F.lit(0))
    rows = rows.join(F.broadcast(hot), "host", "left").withColumn("bucket", bucket)
    rows = rows.repartition("host", "bucket").sortWithinPartitions("host", "bucket", "key").select("host", "bucket", "page_id", "url", "html")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
