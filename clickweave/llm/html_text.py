"""Main text of web pages by the consensus of each host.

Each page is cut into text blocks, each with the path of the containers it stands in: their tags and
classes, numbers in them generalised, so that pages made by the same template have the same paths.
A container scores by the text in it less that of links, text further down counting less; the best
path of a page is its vote. Votes are counted per host in Spark, and the text of a page are the blocks
below its host's winning path, or below its own best path where it lacks that one.

What stands below the winner and is not the article is found by votes as well: a path whose blocks are
mostly the same on different pages of the host is cut. Names that often mark menus, notices, adverts
and comments say little against that: their text scores a quarter, and they are cut only where the
consensus has not put the article into them.

Pages are parsed once: the blocks are written to the shared folder and read again with the winners.
"""

from __future__ import annotations

import functools
import hashlib
import html
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import map_rows
from clickweave.llm.url_filter import address
from clickweave.session import work_folder

# Winners and cut paths of up to so many hosts and characters are sent to all tasks; more are joined by
# shuffles.
MAX_HOSTS, MAX_CHARS = 200_000, 20_000_000

# Containers further in have a hash for all their steps from this depth on.
DEEPEST = 60

# How much the text of a container counts whose name is one of MARKS.
MARKED = 0.25
# Blocks of a path that a host must have for the path to be cut, and the blocks for each different one.
REPEATED, COPIES = 5, 2

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
SKIPPED = frozenset("head form button select option dialog object canvas audio video".split())
ASIDE = frozenset("nav aside footer menu".split())
CONTAINERS = frozenset("html body main article section div td th blockquote figure details".split())
BLOCKS = CONTAINERS | SKIPPED | ASIDE | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr caption pre hr address header "
    "hgroup fieldset figcaption summary center legend".split())
# A start of one of the first ends an open one of the second within the same container or list.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th")}
LISTS = frozenset("ul ol dl table".split())
# Words of a class, id or role that often mark what is not the article.
MARKS = frozenset(
    "nav navbar navigation menu sidebar aside footer banner cookie cookies notice consent ad ads "
    "adv advert adverts advertisement promo sponsor sponsored comment comments disqus share sharing "
    "social related recommended newsletter subscribe signup login breadcrumb breadcrumbs pagination "
    "pager popup modal overlay widget toolbar complementary contentinfo search".split())
HEADER_MARKS = frozenset("header masthead topbar".split())

TAG = regex.compile(
    r"""<(?:!--(?s:.*?)(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)"""
    r"""((?:[^<>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z))""")
ATTRIBUTE = regex.compile(
    r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
    regex.I)
HIDDEN = regex.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", regex.I)


class Block(NamedTuple):
    path: str
    text: str
    linked: int
    marked: str | None  # the path of the innermost container around it with a mark


class _Open(NamedTuple):
    tag: str
    path: str
    depth: int
    skipped: bool
    linked: bool
    main: bool
    marked: str | None


@functools.lru_cache(maxsize=1 << 14)
def _element(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """The step of an element in a path, whether it is left out, marked, and marked outside an article."""
    found = {name.lower(): (value or "").strip("\"'")
             for name, value in ATTRIBUTE.findall(attributes)} if attributes else {}
    classes = regex.sub(r"\d+", "#", found.get("class", "")).lower().split()
    words = set(regex.split(r"[^a-z]+", " ".join(
        [*classes, found.get("id", ""), found.get("role", "")]).lower()))
    hidden = ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
              or HIDDEN.search(found.get("style", "")) is not None)
    outside = tag == "header" or bool(words & HEADER_MARKS)
    marked = bool(words & MARKS) and tag not in ("html", "body", "main", "article")
    return (".".join([tag, *sorted(classes)]), hidden or tag in SKIPPED, marked or tag in ASIDE,
            outside)


def _deeper(path: str, step: str, depth: int) -> str:
    if depth < DEEPEST:
        return f"{path}>{step}" if path else step
    head, _, last = path.rpartition(">")
    digest = hashlib.blake2b(f"{last}>{step}".encode(), digest_size=8).hexdigest()
    return f"{head}>~{digest}" if depth > DEEPEST else f"{path}>~{digest}"


def blocks(source: str, everything: bool = False) -> list[Block]:
    """The text blocks of a page in order; `everything` has those of forms and the like as well."""
    found: list[Block] = []
    stack = [_Open("", "", 0, False, False, False, None)]
    words: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(words).split())
        if text:
            found.append(Block(stack[-1].path, text, linked, stack[-1].marked))
        words.clear()
        linked = 0

    def close(tags: tuple[str, ...], until: frozenset[str]) -> None:
        """Ends the innermost open element of these, unless one of `until` is further in."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                if any(s.tag in BLOCKS for s in stack[i:]):
                    flush()
                del stack[i:]
                return
            if stack[i].tag in until:
                return

    def read(text: str) -> None:
        nonlocal linked
        top = stack[-1]
        if text and (everything or not top.skipped):
            text = html.unescape(text)
            words.append(text)
            if top.linked:
                linked += len(text)

    at = 0
    while True:
        match = TAG.search(source, at)
        read(source[at:match.start() if match else len(source)])
        if match is None:
            break
        at = match.end()
        end, tag, attributes = match.group(1, 2, 3) if match[2] else match.group(4, 5, 6)
        if tag is None:
            continue  # a comment or declaration
        tag = tag.lower()
        if end:
            if tag in BLOCKS:
                flush()
            close((tag,), frozenset() if tag in CONTAINERS | SKIPPED | ASIDE else CONTAINERS)
            continue
        if tag in RAW:
            # Nothing within is markup; what is not ended goes on to the end of the page.
            done = regex.compile(rf"</{tag}\b[^>]*(?:>|\Z)", regex.I).search(source, at)
            at = done.end() if done else len(source)
            continue
        if tag in BLOCKS:
            close(("p",), CONTAINERS)
            if tag in ENDS:
                close(ENDS[tag], LISTS)
            flush()
        if tag in VOID:
            words.append(" ")
            continue
        if attributes.endswith("/") and tag not in BLOCKS:
            continue
        top = stack[-1]
        step, skipped, named, outside = _element(tag, attributes.strip())
        marked = named or (outside and not top.main)
        path, depth = top.path, top.depth
        if marked or tag in CONTAINERS:
            path, depth = _deeper(path, step, depth), depth + 1
        stack.append(_Open(tag, path, depth, top.skipped or skipped, top.linked or tag == "a",
                           top.main or tag in ("article", "main"), path if marked else top.marked))
    flush()
    return found


def best_path(page: list[Block]) -> str:
    """The path of the container that scores best; the shortest of equals. Empty without text."""
    score: dict[str, float] = {}
    for block in page:
        worth, path = float(len(block.text) - 2 * block.linked), block.path
        if block.marked is not None and worth > 0:
            worth *= MARKED
        for _ in range(3):
            step = path.rpartition(">")[2].partition(".")[0]
            score[path] = score.get(path, 0) + worth * (2.5 if step in ("article", "main") else 1)
            if not path:
                break
            path, worth = path.rpartition(">")[0], worth / 2
    return min(score, key=lambda p: (-score[p], len(p), p), default="")


_BLOCKS = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("marked", pa.string())]))


def _outcome(batch: pa.RecordBatch) -> list[pa.Array]:
    hosts, votes, rows = [], [], []
    for url, source in zip(batch.column("url"), batch.column("html"), strict=True):
        page = blocks(source.as_py() or "")
        hosts.append(address(url.as_py())[0])
        votes.append(best_path(page) if page else None)
        rows.append([{"path": b.path, "text": b.text, "marked": b.marked} for b in page])
    return [pa.array(hosts, pa.string()), pa.array(votes, pa.string()), pa.array(rows, _BLOCKS)]


def _within(path: Column, top: Column) -> Column:
    """Whether a path is strictly below another."""
    return (F.length(path) > 0) & ((top == "") | path.startswith(F.concat(top, F.lit(">"))))


def _winners(cut: DataFrame) -> DataFrame:
    """host, winner and `repeated`, the paths below the winner whose blocks are mostly the same."""
    votes = cut.where("vote IS NOT NULL").groupBy("host", "vote").agg(F.count("*").alias("n"))
    winners = votes.groupBy("host").agg(F.max_by("vote", F.struct(
        "n", -F.length("vote"), "vote")).alias("winner"))
    # Of each different text of a path one row for each task, however many pages have it.
    texts = cut.select("host", F.explode("blocks").alias("b")).select(
        "host", "b.path", F.xxhash64("b.text").alias("text"))
    paths = (texts.groupBy("host", "path", "text").agg(F.count("*").alias("n"))
             .groupBy("host", "path").agg(F.sum("n").alias("n"), F.count("*").alias("different"))
             .where((F.col("n") >= REPEATED) & (F.col("n") > COPIES * F.col("different"))))
    repeated = (paths.join(winners, "host").where(_within(F.col("path"), F.col("winner")))
                .groupBy("host").agg(F.collect_set("path").alias("repeated")))
    none = F.array().cast("array<string>")
    return winners.join(repeated, "host", "left").withColumn("repeated", F.coalesce("repeated", none))


def extract(pages: DataFrame, keep: list[str] | None = None,
            max_hosts: int = MAX_HOSTS) -> DataFrame:
    """Every row of `pages` (url, html) with its main `text`: blocks joined by two line feeds.

    In a block character references are decoded and white space becomes one space. A null or empty
    html has an empty text; a page with null url, or one without a host, votes with all such pages.
    Of paths with equally many votes the shortest wins. Nothing repeated is cut on the winning path
    itself: copies of an article stay. An input column named like an added one (text, and the working
    names host, vote, blocks) is replaced or left out; `keep` names the input columns to return. No
    rows give no rows.
    """
    path = work_folder(pages.sparkSession, "html")
    cut = map_rows(pages, {"url": pages["url"], "html": pages["html"]},
                   "host STRING, vote STRING, "
                   "blocks ARRAY<STRUCT<path: STRING, text: STRING, marked: STRING>>", _outcome, keep)
    cut.write.option("compression", "zstd").parquet(path)
    cut = pages.sparkSession.read.schema(cut.schema).parquet(path)
    winners = _winners(cut)
    hosts, chars = winners.agg(F.count("*"), F.sum(F.length("winner") + F.length(
        F.array_join("repeated", ">")))).first()
    if hosts <= max_hosts and (chars or 0) <= MAX_CHARS:
        winners = F.broadcast(winners)
    joined = cut.join(winners, "host", "left")
    winner, vote = F.col("winner"), F.col("vote")

    def below(top: Column) -> Column:
        return F.filter("blocks", lambda b: (b["path"] == top) | _within(b["path"], top))

    def once(b: Column) -> Column:
        return ~F.coalesce(F.array_contains("repeated", b["path"]), F.lit(False))

    # Names count only below the winner; in a page without it, wherever they are.
    article = F.filter(below(winner), lambda b: once(b) & ~F.coalesce(
        _within(b["marked"], winner), F.lit(False)))
    other = F.filter(below(vote), lambda b: once(b) & b["marked"].isNull())
    chosen = F.when(F.size(below(winner)) > 0, article).otherwise(other)
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), "\n\n")
    names = [c for c in cut.columns if c not in ("host", "vote", "blocks") and c.lower() != "text"]
    return joined.select(*names, F.coalesce(text, F.lit("")).alias("text"))


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`."""
    found = extract(pages.select("page_id", "url", "html"), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
