"""HTML extraction: markup names the article and what surely isn't, a suffix array per host judges the rest.

A page becomes blocks of text, each of one kind: article, surrounding (menus, footers, adverts and the like, by
element, class or role) or open. Surrounding blocks go. Open blocks, and blocks at an article's edges, go if long
substrings that many distinct pages of the host have cover them whole.

Pages are read twice: for the hash of every block's beginning, which is counted by host, and for their text. Only
blocks that begin like blocks of enough other pages are candidates, and only their tokens, as hashes, are brought
together. A host's candidates (or those of some of its pages) form one stream, whose sorted suffixes show the long
substrings and on how many pages they are; the counts of a host's parts are added up.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import _STEP, _mix, stored, word_hashes

#: Tokens of the shortest blocks that are judged; those below `Evidence.long` only as a whole.
SHORT = 4
#: Pages of a host whose suffixes are sorted together; larger hosts are dealt into parts by a hash.
GROUP_PAGES = 256

ARTICLE, OPEN, AROUND = 0, 1, 2
#: Surroundings by a class word, and forms in articles, while a page is read: what is in them can still win.
_BY_WORD, _IN_FORM = 3, 4

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[/A-Za-z][^>]*(?:>|\Z)""",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")

# Element names and the words of classes, ids and roles that say what an element is.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_AROUND_TAGS = set("nav footer aside script style noscript template head svg button select menu dialog".split())
_MAIN_WORDS = {"main", "articlebody"}
_AROUND_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar aside menu nav navbar "
    "navigation breadcrumb breadcrumbs footer comment comments reply replies respond disqus cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share "
    "sharing social related recommended widget toolbar pagination pager contentinfo complementary".split()
)
_CONTENT_WORDS = set("article articlebody content entry hentry main page post site story".split())
#: First words of classes that only say how a page is laid out, as in with-sidebar.
_MODIFIERS = set("with without has have no not is hide show".split())
_TEXT_TAGS = set("p h1 h2 h3 h4 h5 h6 section blockquote".split())
_HEADER_WORDS = {"header", "masthead", "banner", "topbar"}


def _kind(name: str, attributes: str, around: int) -> int:
    """Kind of an element's text from its name, its attributes and the kind around it.

    Classes, ids and roles are read one by one. An article or main element wins over a word of its own or around
    it, not over both; then, as with words for and against, the kind is open.
    """
    if around == AROUND or name in _AROUND_TAGS:
        return AROUND
    against = for_ = main = False
    if "=" in attributes and name not in ("html", "body"):
        for m in _NAMES.finditer(attributes):
            for label in (m[1] or m[2] or m[3] or "").lower().split():
                parts = [w for w in re.split(r"[^a-z0-9]+", label) if w]
                if len(parts) > 1 and parts[0] in _MODIFIERS:
                    continue
                words = set(parts)
                if words & _AROUND_WORDS or (around != ARTICLE and words & _HEADER_WORDS):
                    against = True
                elif words:
                    main |= bool(words & _MAIN_WORDS)
                    for_ |= words <= _CONTENT_WORDS or bool(words & _MAIN_WORDS)
    if name in ("article", "main"):
        return OPEN if against and around == _BY_WORD else ARTICLE
    if against:  # with a class for content, the suffix array judges
        return OPEN if for_ and around != _BY_WORD else _BY_WORD
    if name == "header" and around != ARTICLE:
        return _BY_WORD
    if name == "form" and around == ARTICLE:
        return _IN_FORM
    if around == _IN_FORM and name in _TEXT_TAGS:
        return OPEN
    return ARTICLE if main else around


def page_blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in order, references decoded and white space reduced to single spaces."""
    page = page or ""
    blocks: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    kind, at = OPEN, 0

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            blocks.append((min(kind, AROUND), text))

    while at < len(page):
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            held.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name not in _INLINE:
            if name == "br":
                held.append(" ")
                continue
            flush()
        if m[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    inner = stack[depth][1] if depth else OPEN
                    if name in _INLINE and kind != inner:
                        flush()
                    del stack[depth:]
                    kind = stack[-1][1] if stack else OPEN
                    break
        elif name in _RAW:
            end = re.compile(rf"</{name}[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif name not in _VOID and not m[3].endswith("/"):
            new = _kind(name, m[3], kind)
            if new != kind:
                flush()
            if name in ("p", "li", "td", "tr", "dt", "dd", "option") and stack and stack[-1][0] == name:
                stack.pop()
            stack.append((name, new))
            kind = new
    flush()
    return blocks


@dataclass(frozen=True)
class Evidence:
    """On how many of a host's pages a run of `long` tokens has to be: this many, and this share of all.

    `open_` holds for open blocks; `article_` for blocks at an article's edges, and for open blocks below `long`
    tokens, which are judged as a whole. An article never loses more than the share `most` of its tokens.
    """

    long: int = 16
    open_pages: int = 3
    open_share: float = 0.01
    article_pages: int = 10
    article_share: float = 0.1
    most: float = 0.5

    def needed(self, pages: Column) -> tuple[Column, Column]:
        """For open blocks; for articles and short blocks."""

        def least(n: int, share: float) -> Column:
            return F.greatest(F.lit(n).cast("long"), F.ceil(F.lit(share) * pages))

        return least(self.open_pages, self.open_share), least(self.article_pages, self.article_share)


def run_pages(tokens: np.ndarray, pages: np.ndarray, long: int, blocks: np.ndarray | None = None) -> np.ndarray:
    """On how many distinct pages the run of `long` tokens that starts at each token is; 0 if it leaves its block.

    Suffixes are ranked by their first 1, 2, 4, ... tokens, each round from the ranks of the one before; those
    of equal rank at `long` tokens begin alike. A suffix that leaves its block (its page, without `blocks`) is cut
    there. Pages are in a row, and so are blocks.
    """
    n = tokens.size
    out = np.zeros(n, np.int64)
    if n < long:
        return out
    blocks = pages if blocks is None else blocks
    left = np.searchsorted(blocks, blocks, side="right") - np.arange(n)  # tokens until the block ends
    _, rank = np.unique(tokens, return_inverse=True)
    depth = 1
    while depth < long:
        step = min(depth, long - depth)
        inside = left > step
        second = np.where(inside, rank[np.minimum(np.arange(n) + step, n - 1)] + 1, 0)
        _, rank = np.unique(rank * np.int64(n + 2) + second, return_inverse=True)
        depth += step
    whole = np.flatnonzero(left >= long)
    if not whole.size:
        return out
    order = whole[np.lexsort((pages[whole], rank[whole]))]
    other = np.append(True, rank[order][1:] != rank[order][:-1])
    starts = np.flatnonzero(other)
    distinct = np.add.reduceat((other | np.append(True, pages[order][1:] != pages[order][:-1])).astype(np.int64), starts)
    out[order] = np.repeat(distinct, np.diff(np.append(starts, order.size)))
    return out


def _cover(starts: np.ndarray, sizes: np.ndarray | int, n: int) -> np.ndarray:
    """Which of `n` places lie in one of the runs."""
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, np.minimum(starts + sizes, n), -1)
    return covered[:n].cumsum() > 0


def run_hashes(tokens: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A hash of the run of `size` tokens (their 64-bit hashes) at each start."""
    h = np.full(starts.size, size, np.uint64)
    for j in range(size):
        h = _mix(h * _STEP + tokens[starts + j])
    return h.view(np.int64)


def begin_hashes(tokens: np.ndarray, sizes: np.ndarray, long: int) -> np.ndarray:
    """Hash of the first `long` tokens of each block, or of all of a shorter one; blocks are in a row.

    Runs cover a block whole only if one covers its begin.
    """
    starts, out = np.cumsum(sizes) - sizes, np.zeros(sizes.size, np.int64)
    for size in range(1, long + 1):
        at = np.flatnonzero(sizes >= long if size == long else sizes == size)
        if at.size:
            out[at] = run_hashes(tokens, starts[at], size)
    return out


class HostStream:
    """Blocks (page, tokens) of a host's pages, or of a part of them, in a row."""

    def __init__(self, pages: list, tokens: list[np.ndarray], long: int):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.tokens = np.concatenate([np.empty(0, np.uint64), *(np.asarray(t, np.int64).view(np.uint64) for t in tokens)])
        self.block = np.repeat(np.arange(self.sizes.size), self.sizes)
        self.pages = np.repeat(pd.factorize(pd.Series(pages, dtype=object))[0], self.sizes)
        inside = self.block[: max(0, self.tokens.size - long + 1)] == self.block[long - 1 :]
        self.long, self.starts = long, np.flatnonzero(inside)
        self.hashes = run_hashes(self.tokens, self.starts, long)

    def runs(self) -> pd.DataFrame:
        """Distinct runs: hash `h` and the pages `n` they are on here."""
        n = run_pages(self.tokens, self.pages, self.long, self.block)[self.starts]
        h, first = np.unique(self.hashes, return_index=True)
        return pd.DataFrame({"h": h, "n": n[first]})

    def covered(self, known: np.ndarray) -> np.ndarray:
        """Which blocks the runs with these hashes cover whole."""
        hit = self.starts[np.isin(self.hashes, known)]
        bare = ~_cover(hit, self.long, self.tokens.size)
        return np.bincount(self.block[bare], minlength=self.sizes.size) == 0


def kept_text(blocks: list[tuple[int, str]], strong: set[int], some: set[int], most: float) -> str:
    """Main text of a page whose blocks at the places `strong` and `some` are covered by evidence of that strength.

    Surrounding blocks go, open ones with some evidence, and those of an article with strong evidence that stand at
    its edges, if that leaves enough of it. A page of which nothing would be left keeps its open blocks.
    """
    article = [k for k, (kind, _) in enumerate(blocks) if kind == ARTICLE]
    gone: set[int] = set()
    for line in (article, article[::-1]):
        for k in line:
            if k not in strong:
                break
            gone.add(k)
    size = {k: len(blocks[k][1].split()) for k in article} if gone else {}
    if sum(size[k] for k in gone) > most * sum(size.values()):
        gone = set()
    gone |= {k for k, (kind, _) in enumerate(blocks) if kind == OPEN and (k in some or k in strong)}
    kept = [text for k, (kind, text) in enumerate(blocks) if kind != AROUND and k not in gone]
    return " ".join(kept or [text for kind, text in blocks if kind != AROUND])


def _host() -> Column:
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


_KEY = ["k1", "k2"]


def block_evidence(rows: DataFrame, evidence: Evidence = Evidence(), group: int = GROUP_PAGES) -> DataFrame:
    """(k1, k2, place, strong) of blocks that are covered whole, for rows (k1, k2, host, html) of pages.

    k1 and k2 are hashes of a page's host and html: equal pages have equal blocks and one decision, but each row
    counts as a page.
    """
    long = evidence.long

    def begins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [page_blocks(page) for page in batch["html"]]
            lengths = [len(page) for page in found]
            kinds = np.array([kind for page in found for kind, _ in page], np.int32)
            texts = [text for page in found for _, text in page]
            sizes = np.array([text.count(" ") + 1 for text in texts], np.int64)  # white space is single spaces
            h = begin_hashes(word_hashes("\n".join(texts)), sizes, long)
            out = batch[[*_KEY, "host"]].iloc[np.repeat(np.arange(len(batch)), lengths)]
            places = np.concatenate([np.empty(0, np.int32), *(np.arange(n, dtype=np.int32) for n in lengths)])
            out = out.assign(place=places, kind=kinds, size=sizes, h=h)
            # Short blocks of articles aren't judged, and say nothing about others.
            out = out[sizes >= np.where(kinds == ARTICLE, long, SHORT)]
            yield pd.concat([batch[[*_KEY, "host"]].assign(place=-1, kind=ARTICLE, size=0, h=0), out])

    blocks = rows.select(*_KEY, "host", "html").mapInPandas(
        begins, "k1 long, k2 long, host string, place int, kind int, size int, h long"
    )
    blocks = stored(blocks, "blocks")
    n_pages = F.count("*").alias("n_pages")
    sizes = blocks.where("place < 0").groupBy("host").agg(n_pages)
    few, many = evidence.needed(F.col("n_pages"))
    # A page counts once for each distinct begin.
    once = blocks.where("place >= 0").select("host", "h", (F.col("size") < long).alias("short"), *_KEY, "place")
    seen = once.groupBy("host", "h", "short", *_KEY).agg(F.count("*").alias("times"), F.countDistinct("place").alias("places"))
    # Equal pages are one group, so its rows are times over places, each a page.
    counted = seen.groupBy("host", "h", "short").agg(F.sum(F.expr("times div places")).alias("n"))
    begun = counted.join(sizes, "host").where(F.col("n") >= F.when(F.col("short"), many).otherwise(few))
    begun = stored(begun.select("host", "h", "short", "n_pages"), "begins")
    judged = blocks.where(f"place >= 0 and kind <> {AROUND}")
    short = judged.where(f"kind = {OPEN} and size < {long}").join(begun.where("short"), ["host", "h"], "left_semi")
    short = short.select(*_KEY, "place", F.lit(True).alias("strong")).distinct()

    # Surrounding blocks are candidates too: they are evidence for open ones.
    wanted = blocks.where(f"place >= 0 and size >= {long}").join(begun.where("not short"), ["host", "h"])
    wanted = wanted.groupBy(*_KEY).agg(F.max("n_pages").alias("n_pages"), F.collect_set("place").alias("places"))
    wanted = stored(wanted, "candidates")  # places of one page

    def tokens_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                found = page_blocks(row.html)
                for place in sorted(row.places):
                    kind, text = found[place]
                    hashes = word_hashes(text).view(np.int64)
                    out.append((row.k1, row.k2, row.host, row.n_pages, row.page, place, kind, hashes))
            yield pd.DataFrame(out, columns="k1 k2 host n_pages page place kind tokens".split())

    pages = rows.join(wanted, _KEY).withColumn("page", F.monotonically_increasing_id())
    streams = pages.mapInPandas(
        tokens_of,
        "k1 long, k2 long, host string, n_pages long, page long, place int, kind int, tokens array<long>",
    )
    parts = F.ceil(F.col("n_pages") / group).cast("int")
    streams = stored(streams.withColumn("part", F.pmod(F.col("page"), parts).cast("int")), "streams")

    def stream(part: pd.DataFrame) -> tuple[pd.DataFrame, HostStream]:
        part = part.sort_values(["page", "place"], kind="stable")
        return part, HostStream(part["page"].tolist(), part["tokens"].tolist(), long)

    def report(part: pd.DataFrame) -> pd.DataFrame:
        part, own = stream(part)
        first = part.iloc[0]
        return own.runs().assign(host=first["host"], part=first["part"], n_pages=first["n_pages"])

    def judge(part: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(known):
            return pd.DataFrame({"k1": [], "k2": [], "place": [], "strong": []}).astype(
                {"k1": "int64", "k2": "int64", "place": "int32", "strong": bool}
            )
        part, own = stream(part)
        some = own.covered(known["h"].to_numpy(np.int64))
        strong = own.covered(known["h"].to_numpy(np.int64)[known["strong"].to_numpy(bool)])
        out = part[[*_KEY, "place"]].assign(strong=strong)
        return out[some & (part["kind"].to_numpy() != AROUND)]

    reported = stored(
        streams.groupBy("host", "part").applyInPandas(report, "host string, part int, n_pages long, h long, n long"),
        "runs",
    )
    total = reported.groupBy("host", "h").agg(F.sum("n").alias("n"), F.max("n_pages").alias("n_pages"))
    total = total.where(F.col("n") >= few).select("host", "h", (F.col("n") >= many).alias("strong"))
    known = reported.select("host", "part", "h").join(total, ["host", "h"])
    covered = streams.groupBy("host", "part").cogroup(known.groupBy("host", "part"))
    covered = covered.applyInPandas(judge, "k1 long, k2 long, place int, strong boolean")
    return covered.unionByName(short).groupBy(*_KEY, "place").agg(F.max("strong").alias("strong"))


def main_texts(pages: DataFrame, evidence: Evidence = Evidence(), group: int = GROUP_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages.

    Null and empty pages have the empty text. Pages without url form a host of their own. Repeated rows are pages
    of their own. Tokens are compared without regard to the case of A to Z. Empty pages tables give no rows; other
    columns are ignored. Texts are shuffled only where the list of blocks to remove is too long to broadcast.
    """
    rows = pages.select("page_id", "url", "html", _host().alias("host"))
    keys = [F.xxhash64("host", "html").alias("k1"), F.xxhash64(F.lit(1), "html", "host").alias("k2")]
    rows = rows.select("page_id", "url", "html", "host", *keys)
    covered = block_evidence(rows, evidence, group).groupBy(*_KEY)
    covered = covered.agg(
        F.collect_list(F.when(F.col("strong"), F.col("place"))).alias("strong"),
        F.collect_list(F.when(~F.col("strong"), F.col("place"))).alias("some"),
    )
    covered = stored(covered, "covered")  # places of one page in a row

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["page_id", "url"]].astype(object)
            marks = zip(batch["html"], batch["strong"], batch["some"])
            out["text"] = [
                kept_text(page_blocks(page), *(set() if x is None else set(x) for x in sets), evidence.most)
                for page, *sets in marks
            ]
            yield out

    texts = rows.join(covered, _KEY, "left").select("page_id", "url", "html", "strong", "some")
    texts = texts.mapInPandas(read, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
