"""Main text of web pages: a chain of labels over the leaf blocks of the element tree.

A page is read once from left to right; a leaf block is a run of text without a block-level
tag inside. Each block gets features of its ancestors (tags, words of class, id and role)
and of its text, and a linear-chain conditional random field, decoded by Viterbi, marks the
blocks of the article.

The field learns from labelled pages: pages whose markup names the article, as they are and
in other layouts around the same text, where the label is known by construction.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm import crf

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/])(?:[^>\"'/]++|/(?!>)|\"[^\"]*+\"|'[^']*+')*+/>"
    r"|<(script|style|noscript|template|svg|textarea|iframe|select)(?=[\s/>]).*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
TRUTH = re.compile(r"data-truth\s*=\s*\"([01])\"")
WORD = re.compile(r"[a-z]+")

# Fixed word lists.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q s samp small span strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
GROUPS = (
    ("article main", "article content main post entry story text body"),
    ("nav menu", "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar tabs"),
    ("header", "header masthead top banner logo"),
    ("footer", "footer bottom copyright legal imprint"),
    ("aside", "sidebar aside side widget related recommended recommend more teaser trending"),
    ("", "ad ads adv advert advertisement sponsor sponsored promo promotion"),
    ("dialog", "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall"),
    ("form button fieldset label input", "form search login share social follow"),
    ("", "comment comments disqus reply replies respond discussion feedback"),
    ("ul ol li dl", "list"),
    ("a", ""),
    ("h1 h2 h3 h4 h5 h6", "title headline"),
    ("p blockquote pre", ""),
    ("table tr td th", ""),
    ("figure figcaption", "caption"),
    ("head title", ""),
)
HEAD = 1 << (len(GROUPS) - 1)
LABEL = 1 << len(GROUPS)
BY_TAG = {tag: 1 << k for k, (tags, _) in enumerate(GROUPS) for tag in tags.split()}
BY_WORD = {word: 1 << k for k, (_, words) in enumerate(GROUPS) for word in words.split()}
LINK = BY_TAG["a"]


@dataclass
class Block:
    text: str
    flags: int  # of all ancestors, by place in GROUPS
    linked: int  # characters inside links


def own_flags(tag: str, attributes: str) -> int:
    flags = BY_TAG.get(tag, 0)
    if attributes and "=" in attributes:
        for value in NAMED.findall(attributes):
            for word in WORD.findall(value.lower()):
                flags |= BY_WORD.get(word, 0)
    return flags


class OpenTags:
    """Open elements with their flags; knows where those of a name lie, so that no tag searches the stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.outer: list[int] = []  # places of elements that are not inline

    def push(self, tag: str, flags: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.outer.append(len(self.stack))
        self.stack.append((tag, flags))

    def pop(self) -> tuple[str, int]:
        tag, flags = self.stack.pop()
        self.places[tag].pop()
        if tag not in INLINE:
            self.outer.pop()
        return tag, flags

    def top(self) -> str | None:
        return self.stack[-1][0] if self.stack else None

    def flags(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def close(self, tag: str) -> None:
        """The innermost element of this name with all inside it; an inline tag closes nothing beyond its block."""
        if not self.places.get(tag):
            return
        place = self.places[tag][-1]
        if tag in INLINE and self.outer and self.outer[-1] > place:
            return
        while len(self.stack) > place:
            self.pop()

    def make_room(self, tag: str) -> None:
        """Closes what an element that is not inline ends by starting."""
        repeats = tag in CLOSES_ITSELF
        while self.stack:
            last = self.top()
            if last in INLINE:
                if not self.places.get("p") and not (repeats and self.places.get(tag)):
                    return
            elif last != "p" and not (repeats and last == tag):
                return
            self.pop()

    def drop(self, *tags: str) -> None:
        """Takes elements of these names out and leaves what is open inside them."""
        lowest = min((self.places[t][0] for t in tags if self.places.get(t)), default=len(self.stack))
        kept = []
        while len(self.stack) > lowest:
            tag, flags = self.pop()
            if tag not in tags:
                kept.append((tag, flags))
        for tag, flags in reversed(kept):
            self.push(tag, flags)


def leaf_blocks(page: str) -> list[Block]:
    """Blocks in page order: whitespace-normalised, with character references decoded, none empty.

    Unclosed and crossing tags are closed by what follows, a tag cut off at the end is
    dropped, script, style and the like are skipped with their contents, so is the head. The
    head ends at the first tag or text that cannot stand in it.
    """
    opened = OpenTags()
    blocks: list[Block] = []
    parts: list[str] = []
    flags, linked, at = 0, 0, 0
    block_flags = 0

    def close_block() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            parts.clear()
            text = " ".join((references.unescape(text) if "&" in text else text).split())
            if text and not block_flags & HEAD:
                blocks.append(Block(text, block_flags, min(linked, len(text))))
        linked = 0

    def leave_head() -> None:
        nonlocal flags
        if opened.top() == "head":
            opened.pop()
            flags = opened.flags()

    def add(text: str) -> None:
        nonlocal linked, block_flags
        if not text:
            return
        if text.isspace():
            if parts:
                parts.append(text)
            return
        if flags & HEAD:
            leave_head()
        if not parts or block_flags & LINK:
            block_flags = flags  # the block stands where its first text outside a link does
        parts.append(text)
        if flags & LINK:
            linked += len(text)

    for token in TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        closing, tag, attributes = token.group(2, 3, 4) if token.group(3) else token.group(5, 6, 7)
        if not tag:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if not inline:
            close_block()
        if closing:
            opened.close(tag)
            flags = opened.flags()
            continue
        if flags & HEAD and tag not in IN_HEAD:
            leave_head()
        if tag in VOID or attributes.endswith("/"):
            continue
        if not inline:
            opened.make_room(tag)
        if tag == "body":
            opened.drop("head", "title")
        flags = opened.flags() | own_flags(tag, attributes)
        if "data-truth" in attributes and (mark := TRUTH.search(attributes)):
            flags = flags | LABEL if mark.group(1) == "1" else flags & ~LABEL
        opened.push(tag, flags)
    add(page[at:])
    close_block()
    return blocks


def block_features(blocks: list[Block]) -> np.ndarray:
    """One row per block; the mark of the training label is not among them."""
    count, rows = len(blocks), []
    for place, block in enumerate(blocks):
        text, n = block.text, len(block.text)
        words = text.count(" ") + 1
        stops = text.count(".") + text.count(",") + text.count(";")
        rows.append(
            [
                *[float(block.flags >> k & 1) for k in range(len(GROUPS) - 1)],
                min(words, 100) / 100,
                float(words < 5),
                float(words > 25),
                block.linked / n,
                min(1.0, 5 * stops / words),
                float(text[-1] in ".!?:;\"'”»"),
                min(n / words, 15.0) / 15,
                float("©" in text or "|" in text or "·" in text or "»" in text),
                place / count,
                float(place == 0),
                float(place == count - 1),
            ]
        )
    own = np.array(rows)
    before = np.vstack([np.zeros((1, own.shape[1])), own[:-1]])
    after = np.vstack([own[1:], np.zeros((1, own.shape[1]))])
    near = [len(GROUPS) - 1, len(GROUPS), len(GROUPS) + 2]  # length, shortness and links of the neighbours
    return np.hstack([own, before[:, near], after[:, near]])


def main_text(page: str | None, model: crf.Chain) -> str:
    blocks = leaf_blocks(page or "")
    if not blocks:
        return ""
    marked = model.decode(block_features(blocks))
    return " ".join(b.text for b, m in zip(blocks, marked) if m)


def truthful(page: str) -> str | None:
    """The page with its article marked for training; None if its markup names none."""
    for tag in ("article", "main"):
        if re.search(rf"<{tag}\b", page, re.IGNORECASE):
            return re.sub(rf"<{tag}\b", f'<{tag} data-truth="1"', page, flags=re.IGNORECASE)
    return None


def layouts(paragraphs: list[str], rng: random.Random) -> list[str]:
    """The same article in other layouts, with everything around it that is no article."""
    words = " ".join(paragraphs).split() or ["text"]
    some = lambda low, high: " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))
    links = lambda n: "".join(f'<li><a href="/{k}">{some(1, 3)}</a></li>' for k in range(n))
    said = lambda: f"{some(6, 40).capitalize()}."
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    half = len(paragraphs) // 2
    first, second = ("".join(f"<p>{p}</p>" for p in part) for part in (paragraphs[:half], paragraphs[half:]))
    comments = "".join(f"<div class='comment'><b>{some(1, 2)}</b><p>{said()}</p></div>" for _ in range(rng.randint(1, 4)))
    title = f"<h1>{some(3, 9)}</h1>"
    return [
        f"<body><header class='site-header'><a href='/'>{some(1, 3)}</a><p>{some(2, 9)}</p></header><nav><ul>{links(6)}</ul></nav>"
        f'<main data-truth="1">{title}{body}</main><aside><h3>{some(1, 4)}</h3><ul>{links(4)}</ul><p>{said()}</p></aside><footer><p>&copy; {some(2, 20)}</p></footer></body>',
        f"<body><div id='menu'>{links(5)}</div><div class='cookie-notice'><p>{said()}</p><button>{some(1, 2)}</button></div>"
        f'<div class="post-content" data-truth="1">{title}{body}</div><section class="comments"><h2>{some(1, 3)}</h2>{comments}</section>'
        f"<form action='/s'><label>{some(1, 3)}</label><p>{said()}</p></form><div id='footer'>{said()}</div></body>",
        f"<body><div class='header'><p>{some(2, 8)}</p></div><div class='ad'>{said()}</div><section data-truth=\"1\">{title}{first}"
        f'<div class="advert" data-truth="0"><p>{said()}</p></div>{second}</section><div class="sidebar"><p>{said()}</p><ul>{links(3)}</ul></div>'
        f"<div class='related'><h3>{some(1, 3)}</h3><p>{said()}</p></div><footer>{some(5, 30)}</footer></body>",
        f"<body><nav>{links(4)}</nav><div class='wrap'><article data-truth=\"1\">{title}{body}<div class=\"comments\" data-truth=\"0\">{comments}</div>"
        f'<aside data-truth="0"><p>{said()}</p></aside><form data-truth="0"><p>{some(3, 12)}</p></form></article></div>'
        f"<div class='newsletter'><p>{said()}</p></div><footer><ul>{links(3)}</ul><p>{some(3, 14)}</p></footer></body>",
        f'<body><table><tr><td>{links(4)}</td><td data-truth="1">{title}{body}</td></tr></table><div class="notice">{said()}</div><p>&copy; {some(2, 6)} | {some(1, 3)}</p></body>',
    ]


def training_pages(page_id: int | None, page: str, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of a page whose article is known, and of its other layouts."""
    marked = truthful(page)
    if marked is None:
        return []
    blocks = leaf_blocks(marked)
    paragraphs = [references.escape(b.text[:2_000]) for b in blocks if b.flags & LABEL][:20]
    out = []
    for text in [marked, *layouts(paragraphs, random.Random(page_id or 0))]:
        found = leaf_blocks(text)[:length] if text is not marked else blocks[:length]
        if found:
            out.append((block_features(found), np.array([int(bool(b.flags & LABEL)) for b in found])))
    return out


def fitted_blocks(pages: DataFrame, sample: int = 150, length: int = 60) -> crf.Chain:
    """The block model, fitted on at most ``sample`` pages that name their article, ``length`` blocks of each layout.

    Copies of a page count once. If no page names its article, no block is marked.
    """
    place = F.xxhash64("html")
    # As truthful() tests it.
    places = pages.filter(F.rlike("html", F.lit(r"(?i)<(article|main)\b"))).select(place.alias("place")).distinct().orderBy("place").limit(sample)
    drawn = pages.select("page_id", "html").filter(place.isin([r["place"] for r in places.collect()]))
    chosen = drawn.groupBy("html").agg(F.min("page_id").alias("page_id")).select("page_id", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for number, page in zip(batch.column(0).to_pylist(), batch.column(1)) for s in training_pages(number, page.as_py(), length)]
            x = pa.array([f.astype("<f4").tobytes() for f, _ in found], pa.binary())
            yield pa.record_batch([x, pa.array([y.astype("i1").tobytes() for _, y in found], pa.binary())], ["x", "y"])

    rows = sorted((bytes(r["x"]), bytes(r["y"])) for r in chosen.mapInArrow(run, "x binary, y binary").collect())
    width = block_features([Block("a", 0, 0)]).shape[1]
    sequences = [(np.frombuffer(x, "<f4").reshape(-1, width).astype(float), np.frombuffer(y, "i1").astype(int)) for x, y in rows]
    return crf.fit(sequences) if sequences else crf.Chain(np.zeros(width), -1.0, np.zeros((2, 2)))


def extracted(pages: DataFrame, model: crf.Chain) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages``.

    NULL or empty html and pages without an article give an empty text. Repeated rows stay;
    other columns are not read; an empty table gives no rows.
    """
    source = pages.select("page_id", "url", "html")
    kinds = dict(source.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), model) for page in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
