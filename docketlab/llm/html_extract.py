"""Main text of web pages by the maximum-scoring subsequence of a page's tokens.

Words score positive: each by how likely words in its surroundings are content, given the elements, class and id names
around it. Tags score negative, most of all those that open a marked stretch such as a menu or an advert. A linear scan
over the page's blocks finds the contiguous region of the largest score; its text, without the words that are likelier
not content, is the page's. The weights are learnt from pages that mark their content themselves (by an article or main
element) and start from what HTML's elements are for. These two elements only label the learner's pages: they are no
features, so all pages are scored alike.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .labelled import by_hash

#: Labelled pages that the weights are learnt from at most.
LABELLED_PAGES = 2_000
#: A name that fewer of them have is not learnt.
MIN_PAGES = 3
#: How much a weight is held to where it starts.
HELD = 0.5
#: Score of a tag, its bounds, and the share of it that counts inside a stretch of other matter, which costs more to open.
TAG, LEAST_TAG, MOST_TAG, INSIDE, OPENING = -0.2, -0.05, -0.3, 0.25, -0.5

# Element names of HTML by kind, and words in class, id and role attributes that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead title tr ul".split()
)
RAW = "script style noscript template textarea svg iframe object select title"
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion nav navbar navigation navigate menu submenu breadcrumb breadcrumbs sidebar side aside footer header masthead topbar toolbar "
    "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login signin search form share sharing social related recommended recommendations teaser teasers widget pagination pager "
    "comment comments commentlist reply replies respond disqus discussion copyright legal disclaimer skip hidden".split()
)
#: Words that say nothing beside one of MARKS: "post-comments" and "cookie-box" are marked, "search-results-analysis" is not.
BESIDE = frozenset(
    "area bar block bottom box btn button buttons card container content cta float global group icon inner item items left line link links list main mobile module outer page panel post posts primary region right row secondary section site slot sticky strip text title to top unit "
    "us wrap wrapper".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
LANDMARKS = frozenset(("article", "main"))
#: Log odds that what an element holds is content, where they are not even.
ELEMENTS = dict(
    a=-1, aside=-4, audio=-5, button=-4, canvas=-5, dialog=-5, fieldset=-3, footer=-5, form=-4, head=-6, header=-4, label=-3, legend=-3, map=-5, menu=-4, nav=-5, video=-5,
)
MARKED, HIDDEN, ROLE, BASE = -4.0, -6.0, -5.0, 1.5
NAMED = frozenset("aside div dl fieldset footer form header iframe ins li nav ol p section span table td ul".split()) | LANDMARKS

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW.split()) + r")(?=[\s/>])[^>]*+(?<!/)>.*?(?:</(?P=raw)\s*+>|\Z)|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+|[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    """A stretch of text between block boundaries, and the tags since the one before.

    ``runs`` are (text, words, names around it, within a landmark); ``tags`` have the names around them as well;
    ``opened`` are the names that tags brought.
    """

    runs: list[tuple[str, int, tuple, bool]] = field(default_factory=list)
    tags: list[tuple[str, tuple]] = field(default_factory=list)
    opened: list[tuple] = field(default_factory=list)


def is_mark(name: str) -> bool:
    """Whether a class or id names other matter than content; "has-sidebar" and "related-work" do not."""
    parts = [p.lower() for p in PART.findall(name)]
    return any(p in MARKS for p in parts) and all(p in MARKS or p in BESIDE for p in parts)


def names_of(name: str, rest: str, sectioned: bool) -> tuple:
    """What an open tag says about what it holds: its element, its class and id names, and whether it is hidden or has a role."""
    out = [f"<{name}>"] if name in ELEMENTS and not (name == "header" and sectioned) else []
    for key, value in ATTRIBUTE.findall(rest) if rest and name not in ("html", "body") else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" and not value or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            out.append("!hidden")
        elif key == "role" and value.lower() in ROLES:
            out.append("!role")
        elif key in ("class", "id") and name in NAMED:
            out += [("!" if is_mark(v) else "") + ("#" if key == "id" else ".") + v for v in value.split() if not (sectioned and is_mark(v) and {"header", "masthead"} & set(PART.findall(v.lower())))]
    return tuple(out)


def blocks_of(page: str) -> tuple[list[Block], bool]:
    """The page's blocks in order, and whether it has a landmark."""
    out, now = [], Block()
    stack: list[tuple[str, tuple]] = []  # name, names around what it holds
    around, landmark, sections, found = (), 0, 0, False
    place = ["body"]  # the blocks that are open

    def cut():
        nonlocal now
        if now.runs or now.tags:
            out.append(now)
            now = Block()

    def pop(upto: int):
        nonlocal around, landmark, sections
        while len(stack) > upto:
            name, before = stack.pop()
            around = before
            landmark -= name in LANDMARKS
            sections -= name in LANDMARKS or name == "section"
            if name in BLOCKS:
                place.pop()

    def text(s: str):
        if s:
            s = html.unescape(s)
            now.runs.append((s, len(s.split()), (f"in {place[-1]}", *around), landmark > 0))

    at = 0
    for m in TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name in BLOCKS:
            cut()
        elif name in ("br", "td", "th"):
            now.runs.append((" ", 0, (f"in {place[-1]}", *around), landmark > 0))
        now.tags.append((name, around))
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop(k)
                    break
            continue
        if name in BLOCKS:  # a block ends an open paragraph, and an item the item before
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or name == stack[k][0] == "li":
                    pop(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if name in VOID or m["rest"].endswith("/") and name not in BLOCKS:
            continue
        more = names_of(name, m["rest"], sections > 0)
        stack.append((name, around))
        if more:
            around = tuple(sorted({*around, *more}))
            now.opened.append(more)
        landmark += name in LANDMARKS
        sections += name in LANDMARKS or name == "section"
        found |= name in LANDMARKS
        if name in BLOCKS:
            place.append("div" if name in LANDMARKS or name == "section" else name)
    text(page[at:])
    cut()
    return out, found


def prior(name: str) -> float:
    """The weight that a name starts from."""
    if name[0] == "!":
        return HIDDEN if name == "!hidden" else ROLE if name == "!role" else MARKED
    return float(ELEMENTS.get(name[1:-1], 0)) if name[0] == "<" else 0.0


@dataclass
class Weights:
    """``names``: log odds that are not where they start; ``tags``: scores of tags."""

    names: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)
    base: float = BASE
    known: dict[tuple, float] = field(default_factory=dict)

    def content(self, around: tuple) -> float:
        """How likely words among these names are content."""
        p = self.known.get(around)
        if p is None:
            odds = self.base + sum(self.names.get(x, 0.0) + prior(x) for x in around)
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
            if len(self.known) < 100_000:
                self.known[around] = p
        return p

    def score(self, block: Block) -> float:
        words = sum(n * p for _, n, around, _ in block.runs if n and (p := self.content(around)) >= 0.5)
        tags = sum(self.tags.get(t, TAG) * (1 if self.content(around) >= 0.5 else INSIDE) for t, around in block.tags)
        return words + tags + sum(OPENING for x in block.opened if self.opens(x))

    def opens(self, names: tuple) -> bool:
        """Whether what a tag says makes its words no content."""
        return self.base + sum(self.names.get(x, 0.0) + prior(x) for x in names) < 0


def learn(runs: dict[tuple[tuple, bool], int], tags: dict[tuple[str, bool], int], steps: int = 400) -> Weights:
    """Weights from counts of runs of text by (names around, in the content) and of tags by (name, in the content).

    Of the names, logistic weights, held to their start; a kind of run counts by the logarithm of its number, so that
    what a whole site has on each page does not drown the rest. A tag is the dearer the oftener it is outside.
    """
    names = {x: k for k, x in enumerate(sorted({x for around, _ in runs for x in around}))}
    each = list(runs.items())
    where = np.array([i for i, ((around, _), _) in enumerate(each) for _ in around], dtype=np.int64)
    which = np.array([names[x] for (around, _), _ in each for x in around], dtype=np.int64)
    y = np.array([float(inside) for (_, inside), _ in each])
    weight = np.log2(1 + np.array([n for _, n in each], dtype=float))
    start = BASE + np.bincount(where, weights=[prior(x) for (around, _), _ in each for x in around], minlength=len(each)) if len(each) else np.zeros(0)
    w, seen = np.zeros(len(names)), np.full(len(names), 1e-6)
    for _ in range(steps if len(each) else 0):
        p = 1 / (1 + np.exp(-np.clip(start + np.bincount(where, weights=w[which], minlength=len(each)), -50, 50)))
        slope = np.bincount(which, weights=((y - p) * weight)[where], minlength=len(names)) - HELD * w
        seen += slope * slope
        w += 0.5 * slope / np.sqrt(seen)
    out = Weights({x: float(w[k]) for x, k in names.items() if abs(w[k]) > 1e-3})
    total = {inside: sum(n for (_, i), n in tags.items() if i == inside) for inside in (True, False)}
    for name in {name for name, _ in tags}:
        odds = math.log((tags.get((name, True), 0) + 1) / (total[True] + 2)) - math.log((tags.get((name, False), 0) + 1) / (total[False] + 2))
        out.tags[name] = min(LEAST_TAG, max(MOST_TAG, TAG + 0.1 * odds))
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """[from, to) of the contiguous scores of the largest sum, in one scan; of equal ones the first, at its longest."""
    best, at, start, total = 0.0, (0, 0), 0, 0.0
    for k, s in enumerate(scores):
        if total < 0:
            start, total = k, 0.0
        total += s
        if total > best + 1e-12 or total >= best - 1e-12 and total > 0 and at[0] == start:
            best, at = max(best, total), (start, k + 1)
    return at


def extract_text(page: str, weights: Weights) -> str:
    blocks, _ = blocks_of(page)
    lo, hi = best_region([weights.score(b) for b in blocks])
    lines = (" ".join("".join(s for s, _, around, _ in b.runs if weights.content(around) >= 0.5).split()) for b in blocks[lo:hi])
    return "\n".join(x for x in lines if x)


def fit(pages: DataFrame, html_col: str = "html", limit: int = LABELLED_PAGES, id_col: str = "page_id") -> Weights:
    """Count names and tags in and out of the content of at most ``limit`` labelled pages, on the executors.

    Only the hashes of the labelled pages' ids and texts are sorted; pages of one id and text count once.
    """
    labelled = pages.select(F.xxhash64(F.col(id_col), F.col(html_col)).alias("key"), F.col(html_col).alias("html")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    keys = labelled.select("key").distinct()
    sample = labelled.join(F.broadcast(by_hash(keys, F.col("key"), keys.count(), limit)), "key").dropDuplicates(["key"]).select("html")
    start = Weights()

    def run(batches):
        for b in batches:
            seen: Counter = Counter()
            for page in b.column(0).to_pylist():
                here: set = set()
                for x in blocks_of(page)[0]:
                    inside = None
                    for _, n, around, landmark in x.runs:
                        inside = landmark if start.content(around) >= 0.5 or not landmark else None  # no label for menus in an article
                        if n and inside is not None:
                            seen["run", "\n".join(around), inside] += 1
                            here |= {name for name in around}
                    for t, _ in x.tags if inside is not None else ():
                        seen["tag", t if t in KNOWN else "other", inside] += 1
                for name in here:
                    seen["page", name, True] += 1
            columns = [pa.array([k[i] for k in seen], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(seen.values()), pa.int64())], ["kind", "name", "inside", "n"])

    rows = sample.mapInArrow(run, "kind string, name string, inside boolean, n long").groupBy("kind", "name", "inside").agg(F.sum("n").alias("n")).collect()
    often = {r["name"] for r in rows if r["kind"] == "page" and r["n"] >= MIN_PAGES}
    runs: Counter = Counter()
    for r in rows:
        if r["kind"] == "run":
            runs[tuple(x for x in r["name"].split("\n") if x in often), r["inside"]] += r["n"]
    return learn(runs, {(r["name"], r["inside"]): r["n"] for r in rows if r["kind"] == "tag"})


KNOWN = BLOCKS | VOID | frozenset(ELEMENTS) | frozenset("abbr b cite code del em font i ins mark q s small span strong sub sup time u td th".split())


def extract(pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` for every row of ``pages``; the weights are learnt from the table itself if none are given.

    Blocks of the region are joined by newlines, their white space is single spaces, character references are decoded.
    Null and empty pages, and pages without any text in a content region, give an empty text. Repeated rows and null ids
    stay as they are; broken markup is read as far as it goes; an empty table gives an empty result; other columns are
    ignored.
    """
    held = pages.sparkSession.sparkContext.broadcast(weights or fit(pages, html_col, id_col=id_col))

    def run(batches):
        for b in batches:
            texts = [extract_text(x or "", held.value) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
