"""Main text of web pages by consensus host paths.

A page is read as a sequence of text blocks, each with the tag-class path of the container it is in. A
path is generalised: html and body are left out, classes are sorted, digits become ``#``. Every page
scores its containers and votes for the path that holds its main text. Spark counts the votes for each
host and keeps the paths with at least ``SHARE`` of the host's pages, five at most by that rule.
Pages are then extracted again with the paths that won. A winning path counts on a page where it holds the
share of the page's score that a vote asks for, the deepest first; an article or main element of the page's
own vote inside it goes before it, and so does any own vote around it or inside a winning whole page. Failing that, and
with no article or main, a winning path counts that scores what it usually does on the host (a quarter of
the usual at least), however much text stands beside it. Otherwise the page's own vote is used.

The path of a vote is the article or main element with most text, or else the deepest container with most of
the page's text. It climbs to containers around it while the text they add is not mostly links (headings, leads,
further columns and sections), but not where article and main elements hold most of the page's text by
themselves. All article and main elements of similar score are kept with it.

Blocks under menus, headers, footers, sidebars, notices, adverts, forms and reader comments (by tag,
role, or a whole class or id token of a container: one word, or such words with words of place, so that
left-sidebar and user-comments go, has-sidebar and comments-on-x stay) never count, nor do scripts, styles and
markup. A container that a word condemns stays if it holds the page's main element.
Words that also name sections of a text (related, discussion) count only where half the container's
text is in links; so do all words inside article, but for tokens of adverts and comments. An article element
is dropped only as a reader's comment. Header elements and words count outside article and main.

Boxes whose names say nothing are told by their host: a container outside article elements, with at most a quarter
(``NAMED``) of the text of the page's vote, goes with its text where that very text stands under that path on at least ``REPEATED``
different pages of the host and on ``SHARE`` of them. Equal pages count once, so copies of a page say nothing.
Nothing else is dropped: no heading, paragraph or inline element by its words, and no hidden text.

A page's paths are numbered, each with its parent, and sums go from child to parent in one pass, so the time
grows with the page and not with its nesting.

Defined results: a null or empty page, or one without text, has the empty text; pages without a host
vote together; repeated rows vote each; unclosed tags end with their container and a cut-off
tag at the end is dropped; references without a meaning stay as they are; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import written

SHARE = 0.2
#: A container holds the main text when it has this share of the page's; article and main at less.
MAIN, NAMED = 0.75, 0.25
#: Different pages of a host that a box's text must stand on before it counts as the host's.
REPEATED = 5
#: Text beside a path belongs to it when less than this share of it is in links.
BESIDE = 0.3

_SKIPPED = "script|style|title|textarea|noscript|template|iframe|svg|select|button|object"
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    | <(?P<raw>{_SKIPPED})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    | <[!?][^>]*(?:>|\Z)
    | <(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)(?:>|\Z)""",
    re.X | re.S | re.I)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|([^\s=/"'>]+)""")

_CONTAINERS = frozenset("div article section main td body center form aside nav header footer fieldset".split())
_BLOCKS = _CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre figure figcaption "
    "address details summary hgroup menu dialog hr html search".split())
_VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
#: What an opening tag ends besides itself, up to the next container.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
           "tr": {"tr", "td", "th"}}
_BOILER_TAGS = frozenset("nav aside footer form menu dialog search".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Elements that may be boilerplate by a class or id token.
_WORDED = _CONTAINERS - {"article", "main", "body"} | frozenset("ul ol dl table".split())
_COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
#: Adverts and reader comments: they count inside an article too.
_FOREIGN_WORDS = _COMMENT_WORDS | frozenset(
    "ad ads adbox adslot adsense adunit advert adverts advertisement advertisements adsbygoogle sponsored".split())
_BOILER_WORDS = _FOREIGN_WORDS | frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager footer copyright sidebar side aside "
    "widget banner sponsor sponsors promo promotion notice cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe signup login search form".split())
#: Words that sections of a text have as well.
_DOUBTFUL_WORDS = frozenset("share sharing social related recommended discussion respond replies".split())
_HEAD_WORDS = frozenset("header masthead topbar".split())
#: Parts that a token may have besides the word: ad-box, site-footer, comments-area.
_BOX_PARTS = frozenset(
    "box bar list block wrapper wrap container area slot unit panel links buttons inner site main top bottom primary "
    "secondary global thread".split())
#: Further parts that say where a box stands or whose it is: left-sidebar, user-comments, related-posts.
_PLACE_PARTS = frozenset(
    "left right section user users reader readers visitor post posts article articles stories page blog privacy policy".split())
#: Words that name a column or the head of a text when they stand with a place: left-side, post-header.
_PLACELESS = _HEAD_WORDS | {"side"}
#: A container in doubt is boilerplate when this share of its text is in links.
LINKED = 0.5
_KEPT, _DOUBT, _LIKELY, _BOILER = range(4)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        name = (m[1] or m[5]).lower()
        out.setdefault(name, entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _tokens(text: str, words: frozenset[str]) -> bool:
    """Whether a whole token of ``text`` says one of ``words``, alone or with parts that say nothing else."""
    for token in text.lower().split():
        parts = {x for x in re.split(r"[-_]+", token.rstrip("0123456789")) if x}
        if parts & words and parts <= words | _BOX_PARTS:
            return True
        if parts & words - _PLACELESS and parts <= words - _PLACELESS | _BOX_PARTS | _PLACE_PARTS:
            return True
    return False


def _verdict(tag: str, attrs: dict[str, str], in_article: bool, in_main: bool) -> int:
    """Whether an element is kept, boilerplate, boilerplate unless it holds the main element, or boilerplate
    if its text is mostly links."""
    if tag in _BOILER_TAGS or attrs.get("role", "").lower() in _BOILER_ROLES:
        return _BOILER
    inside = in_article or in_main
    if tag == "header" and not inside:
        return _BOILER
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    if tag == "article" and _tokens(names, _COMMENT_WORDS):
        return _BOILER
    if tag not in _WORDED or names == " ":
        return _KEPT
    if _tokens(names, _FOREIGN_WORDS) or not in_article and _tokens(names, _BOILER_WORDS) or not inside and _tokens(names, _HEAD_WORDS):
        return _LIKELY
    return _DOUBT if _tokens(names, _BOILER_WORDS | _DOUBTFUL_WORDS) else _KEPT


def _step(tag: str, attrs: dict[str, str]) -> str:
    classes = sorted(set(attrs.get("class", "").replace(">", " ").split()))
    return re.sub(r"\d+", "#", ".".join([tag, *classes]))


class Paths:
    """The container paths of a page, numbered so that a parent comes before its children; 0 is the whole page."""

    def __init__(self) -> None:
        self.parent, self.step, self.depth, self.named = [0], [""], [-1], [False]
        self._below: dict[tuple[int, str], int] = {}

    def __len__(self) -> int:
        return len(self.parent)

    def child(self, at: int, step: str) -> int:
        got = self._below.get((at, step))
        if got is None:
            got = self._below[at, step] = len(self.parent)
            self.parent.append(at)
            self.step.append(step)
            self.depth.append(self.depth[at] + 1)
            self.named.append(step.partition(".")[0] in ("article", "main"))
        return got

    def text(self, at: int) -> str:
        steps = []
        while at:
            steps.append(self.step[at])
            at = self.parent[at]
        return ">".join(reversed(steps))

    def find(self, text: str) -> int | None:
        at: int | None = 0
        for step in text.split(">") if text else ():
            at = self._below.get((at, step))
            if at is None:
                return None
        return at

    def within(self, tops: list[int]) -> list[bool]:
        """Of each path, whether it is one of ``tops`` or inside one."""
        out = [False] * len(self)
        for at in tops:
            out[at] = True
        for at in range(1, len(self)):
            out[at] = out[at] or out[self.parent[at]]
        return out

    def around(self, at: int) -> set[int]:
        """``at`` and every path that it is inside of."""
        out = {at}
        while at:
            at = self.parent[at]
            out.add(at)
        return out


def parsed(html: str) -> tuple[Paths, list[tuple[int, str, int]]]:
    """The paths of a page and (path, text, code points inside links) of every block outside boilerplate, in page order."""
    paths = Paths()
    blocks: list[tuple[int, str, int]] = []
    doubts: list[int] = []                          # container in doubt that each block is in, or 0
    above, size, linked = [0], [0], [0]             # of each container in doubt: the one it is in, code points, those in links
    likely, holds = [False], [True]                 # condemned by a word; holds the main element
    stack: list[tuple] = [("", 0, False, False, False, 0)]    # tag, path, boilerplate, in article, in main, doubt
    open_: Counter[str] = Counter()
    buffer: list[str] = []
    links = link_depth = 0

    def flush() -> None:
        nonlocal links
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                doubt = stack[-1][5]
                blocks.append((stack[-1][1], text, links))
                doubts.append(doubt)
                size[doubt] += len(text)
                linked[doubt] += min(links, len(text))
            buffer.clear()
        links = 0

    def say(text: str) -> None:
        nonlocal links
        if text and not stack[-1][2]:
            buffer.append(text)
            links += len(text) if link_depth else 0

    def pop() -> None:
        open_[stack.pop()[0]] -= 1

    at = 0
    for m in _TOKEN.finditer(html):
        say(html[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if at == len(html) and not m[0].endswith(">"):
            break                                   # cut off inside the tag
        if tag == "br":
            say("\n")
        if tag == "a":
            link_depth = 0 if m["end"] else 1
        if m["end"]:
            if open_[tag]:
                if tag in _BLOCKS:
                    flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag in _BLOCKS:
                flush()
            continue
        if tag in _VOID and tag != "hr":
            continue
        attrs = _attributes(m["attrs"]) if m["attrs"] else {}
        if tag not in _BLOCKS:
            # an inline element matters only where it hides what is in it
            if attrs and _verdict(tag, attrs, *stack[-1][3:5]) == _BOILER:
                stack.append((tag, stack[-1][1], True, *stack[-1][3:]))
                open_[tag] += 1
            continue
        flush()
        if stack[-1][0] == "p":
            pop()
        ends = _CLOSES.get(tag, ())
        if any(open_[x] for x in ends):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    while len(stack) > i:
                        pop()
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table") or stack[i][0] in _CONTAINERS:
                    break
        if tag == "hr":
            continue
        _, path, boiler, in_article, in_main, doubt = stack[-1]
        if tag in _CONTAINERS and tag != "body":
            path = paths.child(path, _step(tag, attrs))
        verdict = _verdict(tag, attrs, in_article, in_main)
        if verdict in (_DOUBT, _LIKELY) and not boiler:
            above.append(doubt)
            size.append(0)
            linked.append(0)
            likely.append(verdict == _LIKELY)
            holds.append(False)
            doubt = len(above) - 1
        if tag == "main" and not boiler:
            around = doubt
            while not holds[around]:
                holds[around] = True
                around = above[around]
        stack.append((tag, path, boiler or verdict == _BOILER, in_article or tag == "article", in_main or tag == "main", doubt))
        open_[tag] += 1
    else:
        say(html[at:])
    flush()
    for i in range(len(above) - 1, 0, -1):
        size[above[i]] += size[i]
        linked[above[i]] += linked[i]
    out = [False]
    for i in range(1, len(above)):
        mine = not holds[i] if likely[i] else size[i] > 0 and linked[i] >= LINKED * size[i]
        out.append(out[above[i]] or mine)
    return paths, [b for b, i in zip(blocks, doubts) if not out[i]]


def page_blocks(html: str) -> list[tuple[str, str, int]]:
    """(path, text, code points inside links) of every block outside boilerplate, in page order."""
    paths, blocks = parsed(html)
    return [(paths.text(at), text, links) for at, text, links in blocks]


class Sums(NamedTuple):
    """The paths of a page and of each: its score, which is the text below it with text in links counted against it; the
    text below it; score and text of the blocks in it but in no container below."""
    paths: Paths
    scores: list[int]
    sizes: list[int]
    own: list[tuple[int, int]]


def container_sums(paths: Paths, blocks: list[tuple[int, str, int]]) -> Sums:
    scores, sizes = [0] * len(paths), [0] * len(paths)
    for at, text, links in blocks:
        scores[at] += len(text) - 2 * links
        sizes[at] += len(text)
    own = list(zip(scores, sizes))
    for at in range(len(paths) - 1, 0, -1):
        scores[paths.parent[at]] += scores[at]
        sizes[paths.parent[at]] += sizes[at]
    return Sums(paths, scores, sizes, own)


def _holds(at: int, sums: Sums) -> bool:
    return sums.sizes[at] > 0 and sums.scores[at] >= (NAMED if sums.paths.named[at] else MAIN) * sums.scores[0]


def _bits(score: int) -> int:
    """The score's size in powers of two: whole numbers, so that their sum on a host has one value."""
    return max(score, 0).bit_length()


def _alike(at: int, sums: Sums) -> list[int]:
    """``at`` and the article and main elements outside it that score like the best one in it."""
    paths, scores = sums.paths, sums.scores
    named = [p for p in range(len(paths)) if paths.named[p] and scores[p] > 0]
    inside, around = paths.within([at]), paths.around(at)
    best = max((scores[p] for p in named if inside[p]), default=None)
    if best is None:
        return [at]
    near = [p for p in named if scores[p] >= NAMED * best and not inside[p] and p not in around]
    covered = paths.within(near)
    return [at, *(p for p in near if not covered[paths.parent[p]])]


def _climbed(at: int, sums: Sums) -> int:
    """The widest container around ``at`` that is reached by adding text that is not mostly links."""
    def plain(score: float, size: int) -> bool:
        return size > 0 and score > (1 - 2 * BESIDE) * size

    up = at
    while up:
        up = sums.paths.parent[up]
        added = sums.sizes[up] - sums.sizes[at]
        if not added:
            continue
        if not plain(sums.scores[up] - sums.scores[at], added) and not plain(*sums.own[up]):
            break
        at = up
    return at


def best_path(sums: Sums) -> int | None:
    """The path that holds the main text: the best article or main element, or else the deepest
    container with most of the page's text, and what belongs to it around."""
    paths, scores = sums.paths, sums.scores
    if not sums.sizes[0]:
        return None
    most = [p for p in range(len(paths)) if _holds(p, sums)]
    named = [p for p in most if paths.named[p]]
    if named:
        best = max(named, key=lambda p: (scores[p], -paths.depth[p], -p))
        if sum(scores[p] for p in _alike(best, sums)) >= MAIN * scores[0]:
            return best
    else:
        best = max(most, key=lambda p: (paths.depth[p], scores[p], -p)) if most else 0
    return _climbed(best, sums)


def chosen_path(sums: Sums, winners: list[str], usual: dict[str, float]) -> int | None:
    """The path that a page is extracted by; ``usual`` has the mean ``_bits`` of the votes for a winner."""
    own, scores, paths = best_path(sums), sums.scores, sums.paths
    if own is None:
        return None
    found = {w: paths.find(w) for w in winners}
    known = {at: usual.get(w) for w, at in found.items() if at is not None and sums.sizes[at]}
    held = [w for w in known if _holds(w, sums)]
    if held:
        won = max(held, key=lambda w: (paths.depth[w], scores[w], -w))
        return own if own in paths.around(won) or won in paths.around(own) and (paths.named[own] or not won) else won
    if paths.named[own]:
        return own
    as_usual = [w for w, bits in known.items() if bits is not None and scores[w] >= 2 ** (bits - 2)]
    return max(as_usual, key=lambda w: (scores[w], -w)) if as_usual else own


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def small_boxes(sums: Sums, blocks: list[tuple[int, str, int]]) -> dict[int, tuple[int, int]]:
    """Digests of path and text of each container that may be the host's: outside article elements, not around the page's vote, and with
    at most ``NAMED`` of its text. Of containers around the same text the outermost counts."""
    paths, sizes, vote = sums.paths, sums.sizes, best_path(sums)
    if vote is None:
        return {}
    article = paths.within([p for p in range(1, len(paths)) if paths.step[p].partition(".")[0] == "article"]) if any(paths.named) else None
    around, most = paths.around(vote), NAMED * sizes[vote]
    small = [0 < sizes[p] <= most and p not in around and not (article and article[p]) for p in range(len(paths))]
    if not any(small):
        return {}
    names, texts = [0] * len(paths), [0] * len(paths)
    for p in range(1, len(paths)):
        names[p] = _digest(f"{names[paths.parent[p]]}>{paths.step[p]}")
    for at, text, _ in blocks:
        if small[at]:
            texts[at] += _digest(text)
    for p in range(len(paths) - 1, 0, -1):
        texts[paths.parent[p]] += texts[p]
    whole = 1 << 64
    return {p: (names[p], (texts[p] + whole // 2) % whole - whole // 2) for p in range(1, len(paths))
            if small[p] and not (small[paths.parent[p]] and sizes[paths.parent[p]] == sizes[p])}


def main_text(html: str, winners: list[str], usual: dict[str, float] | None = None,
              repeated: frozenset[tuple[int, int]] = frozenset()) -> str:
    """``repeated``: digests of path and text of the boxes that the host repeats."""
    paths, blocks = parsed(html)
    sums = container_sums(paths, blocks)
    if repeated:
        gone = paths.within([p for p, box in small_boxes(sums, blocks).items() if box in repeated])
        blocks = [b for b in blocks if not gone[b[0]]]
        sums = container_sums(paths, blocks)
    path = chosen_path(sums, winners, usual or {})
    if path is None:
        return ""
    inside = paths.within(_alike(path, sums))
    return "\n\n".join(text for at, text, _ in blocks if inside[at])


# ------------------------------------------------------------------ frames

def with_host(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return pages.withColumn("__host", F.lower(host))


def page_votes(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row for each row of ``pages`` (__host, html), as a table: host, page (a digest of the html), path and bits of its vote (null
    without text), and ``boxes``, the digests of the containers that may be the host's."""
    schema = "host string, page long, path string, bits long, boxes array<struct<path:bigint,text:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = pa.list_(pa.struct([("path", pa.int64()), ("text", pa.int64())]))
        for b in batches:
            names, bits, boxes = [], [], []
            for t in b.column("html"):
                paths, blocks = parsed(t.as_py() or "")
                sums = container_sums(paths, blocks)
                vote = best_path(sums)
                names.append(None if vote is None else paths.text(vote))
                bits.append(None if vote is None else _bits(sums.scores[vote]))
                boxes.append([{"path": p, "text": x} for p, x in small_boxes(sums, blocks).values()])
            yield pa.RecordBatch.from_pydict({"host": b.column("__host"), "page": b.column("__page"), "path": pa.array(names, pa.string()),
                                              "bits": pa.array(bits, pa.int64()), "boxes": pa.array(boxes, box)})

    return written(spark, pages.select("__host", F.xxhash64("html").alias("__page"), "html").mapInArrow(run, schema), "votes")


def host_paths(spark: SparkSession, pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(__host, __paths, __boxes): the winning paths of each host of ``pages`` (__host, html), each with the mean ``_bits`` of its
    votes, and the boxes that the host repeats. Both lists are bounded by the share: 1 / share paths, and 1 / share times the boxes
    of a page. It is a table of its own: a join with it reads two plain exchanges, and a host with a third of all pages can be split."""
    votes = page_votes(spark, pages)
    sums = votes.where("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("bits").alias("bits"))
    whole = sums.groupBy("host").agg(F.sum("n").alias("pages"))
    won = sums.join(whole, "host").where(F.col("n") >= share * F.col("pages"))
    path = F.struct("path", (F.col("bits") / F.col("n")).alias("usual"))
    paths = won.groupBy(F.col("host").alias("__host")).agg(F.sort_array(F.collect_list(path)).alias("__paths"))
    different = votes.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    held = votes.select("host", "page", F.explode("boxes").alias("box")).distinct().groupBy("host", "box").agg(F.count("*").alias("n"))
    often = held.where(F.col("n") >= REPEATED).join(different, "host").where(F.col("n") >= share * F.col("pages"))
    boxes = often.groupBy(F.col("host").alias("__host")).agg(F.sort_array(F.collect_list("box")).alias("__boxes"))
    return written(spark, paths.join(boxes, "__host", "full"), "host-paths")


def extracted(spark: SparkSession, pages: DataFrame, share: float = SHARE) -> DataFrame:
    """One row for each row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    rows = with_host(pages.select("page_id", "url", "html"))
    both = rows.join(host_paths(spark, rows, share), "__host", "left").select("page_id", "url", "html", "__paths", "__boxes")
    schema = both.select("page_id", "url", F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, p, x in zip(b.column("html"), b.column("__paths"), b.column("__boxes")):
                usual = {w["path"]: w["usual"] for w in p.as_py() or ()}
                repeated = frozenset((w["path"], w["text"]) for w in x.as_py() or ())
                texts.append(main_text(t.as_py() or "", list(usual), usual, repeated))
            yield pa.RecordBatch.from_pydict({"page_id": b.column("page_id"), "url": b.column("url"), "text": pa.array(texts, pa.string())})

    return both.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))


def op8_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
