"""Main text of web pages by consensus of a host's pages on where it lies.

1. Each page's containers are scored: characters of their text outside links, half of it for the
   container around. Paths are generalised: tags with classes, digits as ``#``. Noise (menus, forms,
   adverts, notices, comments and so on, by tag or class) scores nothing.
2. The best path of each page is its vote; Spark counts votes by host, and the path with most votes
   wins. One row for each host remains, written once, so Spark sends it to all tasks while it is
   small and joins by host, hot hosts split, when it is not.
3. Pages are cut again with their host's path; a page without it is cut with its own best one.

Blocks are runs of text between block-level tags: character references decoded, white space as one
space, trimmed, joined in page order by a line end.

Cases: a null html is empty and gives an empty text, and so does a page without text outside noise.
A null or broken url belongs to the host "". Broken markup is read as far as it goes: what is never
closed ends with the page. Repeated rows vote each. Columns beside page_id, url and html are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.shared import materialise

# Fixed by the HTML standard.
CONTAINERS = frozenset("body div section article main header footer nav aside form fieldset table tbody thead tfoot tr td th ul ol dl figure details dialog center".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote address figcaption caption summary legend hr option".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select button head".split())
ENDED_BY_SAME = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("form",)}
EMPTY = frozenset("br hr img input meta link area base col embed source track wbr".split())

NOISE_TAGS = frozenset("nav footer aside form dialog".split())
NOISE_CLASSES = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation
    menu breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices alert popup modal
    overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations
    comment comments disqus reply replies respond responses widget widgets toolbar pagination pager paywall skip tags""".split()
)
TAG = re.compile(
    r"""<(?:!--(?P<comment>)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>|[!?/][^>]*>|(?P<broken>/?[a-zA-Z][^>]*>))"""
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Open:
    """An element that is not closed yet."""

    __slots__ = ("name", "noise", "path", "story")

    def __init__(self, name: str, path: str, noise: bool, story: bool):
        self.name, self.path, self.noise, self.story = name, path, noise, story


def opened(name: str, attrs: str, outer: Open) -> Open:
    found = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attrs)} if attrs.strip(" /") else {}
    classes = found.get("class", "").lower().split()
    story = outer.story or name in ("article", "main")
    marks = {t for c in [*classes, found.get("id", "").lower(), found.get("role", "").lower()] for t in re.split("[^a-z]+", c)}
    if not story:
        marks |= {"banner"} if name == "header" or "header" in marks else set()
    noise = outer.noise or name in NOISE_TAGS or not NOISE_CLASSES.isdisjoint(marks)
    noise = noise or "hidden" in found or found.get("aria-hidden") == "true" or bool(HIDDEN.search(found.get("style", "")))
    label = ".".join([name, *sorted(re.sub("[0-9]+", "#", c) for c in classes)])
    return Open(name, f"{outer.path}>{label}" if name in CONTAINERS else outer.path, noise, story)


def blocks(page: str) -> list[tuple[str, str, int]]:
    """The page's blocks outside noise in order: container path, text, characters inside links."""
    out: list[tuple[str, str, int]] = []
    stack = [Open("", "", False, False)]
    buffer: list[str] = []
    linked, link = 0, False

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].noise:
            buffer.append(text)
            linked += len(text) if link else 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(references.unescape("".join(buffer)).split())
            if text:
                out.append((stack[-1].path, text, min(linked, len(text))))
            buffer.clear()
            linked = 0

    at, end = 0, len(page)
    while at < end:
        tag = TAG.search(page, at)
        if not tag:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        if tag["comment"] is not None:
            close = page.find("-->", at)
            at = end if close < 0 else close + 3
            continue
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if tag["close"]:
            if name == "a":
                link = False
            elif name in CONTAINERS or name in TEXT_BLOCKS:
                flush()
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
                if depth:
                    del stack[depth:]
            continue
        if name in RAW and not tag["attrs"].endswith("/"):
            close = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            if name == "head" and not close:  # a head that is never closed ends where the body begins
                body = re.compile("<body", re.I).search(page, tag.end())
                at = body.start() if body else end
        elif name == "a":
            link = True
        elif name == "br":
            add(" ")
        elif name in CONTAINERS or name in TEXT_BLOCKS:
            flush()
            if len(stack) > 1 and stack[-1].name in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                stack.pop()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ENDED_BY_SAME.get(name, ()):
                    break
                if stack[i].name == name and name in ENDED_BY_SAME:
                    del stack[i:]
                    break
            if name not in EMPTY:
                stack.append(opened(name, tag["attrs"], stack[-1]))
    flush()
    return out


def story_of(path: str) -> str:
    """The path up to its innermost article, else to its innermost main element, else whole."""
    parts = path.split(">")
    for tag in ("article", "main"):
        for i in range(len(parts) - 1, 0, -1):
            if parts[i].split(".")[0] == tag:
                return ">".join(parts[: i + 1])
    return path


def best_path(found: list[tuple[str, str, int]]) -> tuple[str | None, float]:
    """The page's container with the highest score, and that score."""
    score: dict[str, float] = defaultdict(float)
    for path, text, linked in found:
        worth, root = len(text) - linked, story_of(path)
        score[root] += worth
        if ">" in root[1:]:
            score[root.rpartition(">")[0]] += worth / 2
    return max(score.items(), key=lambda x: (x[1], x[0]), default=(None, 0.0))


def inside(path: str, root: str) -> bool:
    return path == root or path.startswith(root + ">")


def votes(pages: DataFrame) -> DataFrame:
    """host, path: the container path with most votes of each host."""

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [best_path(blocks(page or "")) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([p for p, _ in best], pa.string()), pa.array([s for _, s in best], pa.float64())], names=["host", "path", "score"])

    polled = pages.select("host", "html").mapInArrow(voted, "host string, path string, score double").where("path is not null")
    counted = polled.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum(F.col("score").cast("decimal(30,1)")).alias("score"))
    return counted.groupBy("host").agg(F.max(F.struct("votes", "score", "path"))["path"].alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of ``pages``."""
    host = F.coalesce(F.lower(F.expr("try_parse_url(url, 'HOST')")), F.lit(""))
    read = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).withColumn("host", host)
    winners = materialise(votes(read), "host-paths").withColumnRenamed("host", "of_host")
    ready = read.join(winners, F.col("host") == F.col("of_host"), "left").select("page_id", "url", "html", "path")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, root in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True):
                found = blocks(page or "")
                if root is None or not any(inside(p, root) for p, _, _ in found):
                    root = best_path(found)[0] or ""
                texts.append("\n".join(text for p, text, _ in found if inside(p, root)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = dict(ready.dtypes)["page_id"]
    return ready.mapInArrow(cut, f"page_id {kind}, url string, text string, n_chars long")
