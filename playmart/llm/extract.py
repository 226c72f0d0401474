"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks, each with its tag path, words and a few sizes. A bidirectional
LSTM in numpy reads the whole sequence and labels every block main text or not. It is trained here,
on the driver, on a bounded sample (`SAMPLE` pages of the table, whose semantic elements give the
labels, and `MADE` pages made from rules, which vary where and how boilerplate is marked).
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

SAMPLE, MADE = 250, 350      # pages that the labeller is trained on
PATHS, WORDS, SIZES = 256, 24, 6
HIDDEN, EPOCHS, BATCH, RATE, WINDOW = 16, 22, 32, 0.012, 96
SEED = 7
GROUP = 1 << 13              # blocks that are labelled in one go

# fixed values: element names and the words that mark parts of pages
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "iframe label legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td textarea tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg math title head iframe object".split())
RAW = frozenset("script style noscript template svg math title iframe textarea object".split())
CODE = frozenset("script style".split())   # without an end they go on to the end of the page
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
             "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template "
                    "title".split())  # all others end an open head
ENDS_P = BLOCKS - {"button", "label", "option", "select", "body", "html"}
NOT_TEXT_TAGS = frozenset("nav footer aside form button select menu dialog label".split())
NOT_TEXT_WORDS = (
    "ad ads advert advertisement banner promo sponsor sponsored menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice "
    "alert popup modal newsletter subscribe signup login search share social related recommended "
    "comment comments reply replies widget toolbar pagination copyright legal form").split()
TEXT_WORDS = "article content post entry main story".split()

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
UNENDED = re.compile(r"<!--")
MARKS = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Path:
    """The elements around a block and the words that mark them. A path holds the one it goes on
    from and the sums over both that the labeller reads, so a deep one is no larger than others."""

    __slots__ = ("up", "marks", "spots", "size", "held", "named")

    def __init__(self, up: Path | None, marks: tuple[str, ...]):
        self.up, self.marks = up, marks
        self.spots, self.size, self.held, self.named = (
            (up.spots, up.size, up.held, up.named) if up else (0, 0, False, False))
        for t in marks:
            self.spots |= 1 << spot(t)
        self.size += len(marks)
        self.held = self.held or not HOLDS.isdisjoint(marks)
        self.named = self.named or not BOILER.isdisjoint(marks)

    def names(self) -> tuple[str, ...]:
        parts, at = [], self
        while at:
            parts.append(at.marks)
            at = at.up
        return tuple(t for marks in reversed(parts) for t in marks)


HOLDS = frozenset({"article", "main", ".article", ".main"})
BOILER = NOT_TEXT_TAGS | {"." + x for x in NOT_TEXT_WORDS}


@dataclass
class Block:
    at: Path
    text: str
    linked: int = 0

    @property
    def path(self) -> tuple[str, ...]:
        return self.at.names()


class Open:
    """The open elements of a page, with the places of each name and of those that no end of a
    paragraph or list item looks beyond; so no tag has to walk through all of them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, Path]] = []
        self.places: dict[str, list[int]] = {}
        self.walls: list[int] = []
        self.silent = 0

    def push(self, tag: str, marks: tuple[str, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS and tag != "p":
            self.walls.append(len(self.stack))
        self.silent += tag in SILENT
        self.stack.append((tag, Path(self.path(), marks)))

    def pop(self) -> str:
        tag, _ = self.stack.pop()
        self.places[tag].pop()
        if tag in BLOCKS and tag != "p":
            self.walls.pop()
        self.silent -= tag in SILENT
        return tag

    def path(self) -> Path | None:
        return self.stack[-1][1] if self.stack else None

    def last(self, tag: str) -> int:
        """The place of the last open element of a name; -1 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else -1


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order: runs of text between block elements, with character
    references decoded and white space made single. Scripts, styles and titles have none.

    An element that is read as a whole up to its end tag but has none is passed over with its start
    tag alone (a title with the text up to the next tag), so nothing behind it is lost; only a
    script or style goes on to the end of the page. Time and memory follow the length of the page,
    however deep its elements are.
    """
    out: list[Block] = []
    open_ = Open()
    top = Path(None, ())
    parts: list[str] = []
    endless: set[str] = set()   # names without an end tag in the rest of the page
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(open_.path() or top, text, linked))
            parts.clear()
            linked = 0

    def pop(to: int) -> None:
        if any(t in BLOCKS for t, _ in open_.stack[to:]):
            flush()
        while len(open_.stack) > to:
            open_.pop()

    def in_head() -> bool:
        return bool(open_.stack) and open_.stack[-1][0] == "head"

    # behind the last tag end nothing but text can come, up to a comment that never ends
    at, end = 0, page.rfind(">") + 1
    tail = page[end:]
    opened = UNENDED.search(tail)
    tail = tail[:opened.start()] if opened else tail
    while at < end:
        found = TOKEN.search(page, at, end)
        text = page[at:found.start() if found else end]
        if text.strip() and in_head():
            pop(len(open_.stack) - 1)
        if text and not open_.silent:
            text = entities.unescape(text)
            parts.append(text)
            if open_.last("a") >= 0:
                linked += len(text)
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if tag in BLOCKS:
                flush()
            if open_.last(tag) >= 0:
                pop(open_.last(tag))
            continue
        if tag == "br":
            parts.append(" ")
        if tag not in IN_HEAD and open_.last("head") >= 0:
            pop(open_.last("head"))
        if tag in BLOCKS:
            flush()
        closes = {"p"} if tag in ENDS_P else set()
        closes |= CLOSED_BY.get(tag, set())
        near = max((open_.last(name) for name in closes), default=-1)
        if near >= max(open_.walls[-1] if open_.walls else 0, 0):
            pop(near)
        attributes = found[3] if found[2] else found[6]
        if tag in VOID or attributes.rstrip().endswith("/") and tag in ("svg", "math"):
            continue
        if tag in RAW:
            stop = None if tag in endless else re.compile(
                rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at, end)
            if not stop and tag not in CODE:
                endless.add(tag)
                if tag == "title":
                    following = page.find("<", at, end)
                    at = following if following >= 0 else end
                if tag in SILENT:
                    continue
            if tag not in SILENT:
                parts.append(entities.unescape(page[at:stop.start() if stop else len(page)]))
                open_.push(tag, (tag,))
                flush()
                open_.pop()
            at = stop.end() if stop else end
            tail = tail if stop else ""
            continue
        names = [p.lower() for m in MARKS.findall(attributes) for p in NAME_PARTS.findall(m)]
        open_.push(tag, (tag, *("." + n for n in names)))
    if tail.strip() and in_head():
        pop(len(open_.stack) - 1)
    if tail and not open_.silent:
        parts.append(entities.unescape(tail))
    flush()
    return out


def spot(token: str) -> int:
    return zlib.crc32(token.encode()) % PATHS


def sizes(b: Block, words: int) -> list[float]:
    n = len(b.text)
    return [np.log1p(n) / 8, np.log1p(words) / 6, b.linked / n,
            sum(map(b.text.count, ".,;!?")) / max(words, 1), b.at.size / 8, 1.0]


def text_vector(b: Block) -> np.ndarray:
    """Hashed words as a share of the block, then its sizes."""
    words = b.text.lower().encode("utf-8", "replace").split()
    seen = np.bincount([zlib.crc32(w) % WORDS for w in words], minlength=WORDS)
    return np.concatenate((seen / max(len(words), 1), sizes(b, len(words)))).astype(np.float32)


def path_vector(path: Path) -> np.ndarray:
    bits = np.frombuffer(path.spots.to_bytes(PATHS // 8, "little"), np.uint8)
    return np.unpackbits(bits, bitorder="little").astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights of a bidirectional LSTM: per direction the input, the recurrent weights and the bias
    of the four gates, then the output."""

    w: dict[str, np.ndarray]
    paths: dict[int, np.ndarray] = field(default_factory=dict)

    def gates(self, page: list[Block]) -> np.ndarray:
        """What each block feeds to the gates of both directions; a path's share is kept."""
        texts = np.stack([text_vector(b) for b in page]) @ self.both[PATHS:]
        for b in page:
            if b.at.spots not in self.paths:
                self.paths[b.at.spots] = path_vector(b.at) @ self.both[:PATHS]
        found = np.stack([self.paths[b.at.spots] for b in page])
        if len(self.paths) > 50_000:
            self.paths.clear()
        return texts + found

    @property
    def both(self) -> np.ndarray:
        return self.w["both"]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Whether each block of each page is main text; every sequence is read as a whole."""
        out: list[np.ndarray | None] = [None] * len(pages)
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            longest, to = 0, at
            while to < len(order):  # pages of like length, GROUP padded blocks at most
                longest = max(1, len(pages[order[to]]))
                if to > at and longest * (to - at + 1) > GROUP:
                    break
                to += 1
            group = order[at:to]
            at = to
            lengths = np.array([len(pages[k]) for k in group])
            if lengths.max() == 0:
                for k in group:
                    out[k] = np.zeros(0, bool)
                continue
            x = np.zeros((lengths.max(), len(group), 8 * HIDDEN), np.float32)
            for j, k in enumerate(group):
                if pages[k]:
                    x[:lengths[j], j] = self.gates(pages[k])
            mask = np.arange(len(x))[:, None] < lengths
            half = 4 * HIDDEN
            f = run(x[:, :, :half], self.w["fu"], self.w["fb"], mask, False)[0]
            b = run(x[::-1, :, half:], self.w["bu"], self.w["bb"], mask[::-1], False)[0][::-1]
            score = np.concatenate((f, b), 2) @ self.w["o"] + self.w["ob"]
            for j, k in enumerate(group):
                out[k] = score[:lengths[j], j] > 0
        return out


def run(x: np.ndarray, u: np.ndarray, bias: np.ndarray, mask: np.ndarray, keep: bool = True):
    """One direction over padded sequences (time, page, gates); a padded step changes nothing. Only
    training has to `keep` what each step saw."""
    n, h = x.shape[1], HIDDEN
    hid, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
    out, saved = np.zeros((len(x), n, h), np.float32), []
    for t in range(len(x)):
        z = x[t] + hid @ u + bias
        s = sigmoid(z[:, :3 * h])
        i, f, o, g = s[:, :h], s[:, h:2 * h], s[:, 2 * h:], np.tanh(z[:, 3 * h:])
        new = f * cell + i * g
        squashed = np.tanh(new)
        m = mask[t][:, None]
        if keep:
            saved.append((i, f, o, g, cell, squashed, hid, m))
        hid, cell = np.where(m, o * squashed, hid), np.where(m, new, cell)
        out[t] = hid
    return out, saved


def back(grad: np.ndarray, saved: list, u: np.ndarray):
    """Gradients of the gates' inputs and of the recurrent weights, back through time."""
    h = HIDDEN
    dz_all = np.zeros((*grad.shape[:2], 4 * h), np.float32)
    du = np.zeros_like(u)
    dh = dc = np.zeros(grad.shape[1:], np.float32)
    for t in range(len(grad) - 1, -1, -1):
        i, f, o, g, cell, squashed, hid, m = saved[t]
        whole = dh + grad[t]
        step = np.where(m, whole, 0)
        do = step * squashed
        dnew = np.where(m, dc, 0) + step * o * (1 - squashed ** 2)
        dz = np.concatenate((dnew * g * i * (1 - i), dnew * cell * f * (1 - f),
                             do * o * (1 - o), dnew * i * (1 - g ** 2)), 1)
        dz_all[t] = dz
        du += hid.T @ dz
        dh = dz @ u.T + np.where(m, 0, whole)
        dc = np.where(m, dnew * f, dc)
    return dz_all, du


def teach(pages: list[tuple[list[Block], list[bool]]]) -> Labeller:
    """Trains on labelled block sequences by Adam; long pages are taught in runs of `WINDOW`
    blocks. The seed is fixed, so equal samples give equal weights."""
    rng = np.random.default_rng(SEED)
    dim, h = PATHS + WORDS + SIZES, HIDDEN
    w = {"both": rng.normal(0, 0.15, (dim, 8 * h)), "o": rng.normal(0, 0.3, 2 * h),
         "fu": rng.normal(0, 0.2, (h, 4 * h)), "bu": rng.normal(0, 0.2, (h, 4 * h)),
         "fb": np.zeros(4 * h), "bb": np.zeros(4 * h), "ob": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    for k in ("fb", "bb"):
        w[k][h:2 * h] = 1  # remember at first
    runs = []
    for page, labels in pages:
        x = np.stack([np.concatenate((path_vector(b.at), text_vector(b))) for b in page])
        runs += [(x[k:k + WINDOW], np.array(labels[k:k + WINDOW], np.float32))
                 for k in range(0, len(page), WINDOW)]
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = sorted(range(len(runs)), key=lambda k: len(runs[k][0]) + rng.random() * 8)
        starts = list(range(0, len(order), BATCH))
        rng.shuffle(starts)
        for s in starts:
            part = [runs[k] for k in order[s:s + BATCH]]
            lengths = np.array([len(x) for x, _ in part])
            x = np.zeros((lengths.max(), len(part), dim), np.float32)
            y = np.zeros(x.shape[:2], np.float32)
            for j, (a, b) in enumerate(part):
                x[:len(a), j], y[:len(a), j] = a, b
            mask = np.arange(len(x))[:, None] < lengths
            z = x @ w["both"]
            f, fs = run(z[:, :, :4 * h], w["fu"], w["fb"], mask)
            b, bs = run(z[::-1, :, 4 * h:], w["bu"], w["bb"], mask[::-1])
            both = np.concatenate((f, b[::-1]), 2)
            d = np.where(mask, sigmoid(both @ w["o"] + w["ob"]) - y, 0) / mask.sum()
            db = d[:, :, None] * w["o"]
            fz, fu = back(db[:, :, :h], fs, w["fu"])
            bz, bu = back(db[::-1, :, h:], bs, w["bu"])
            dz = np.concatenate((fz, bz[::-1]), 2)
            grads = {
                "both": x.reshape(-1, dim).T @ dz.reshape(-1, 8 * h), "fu": fu, "bu": bu,
                "fb": fz.sum((0, 1)), "bb": bz.sum((0, 1)),
                "o": np.tensordot(both, d, ((0, 1), (0, 1))), "ob": d.sum(keepdims=True)[0],
            }
            step += 1
            size = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
            rate = RATE * (1 - 0.8 * epoch / EPOCHS)
            for k, g in grads.items():
                g = g * min(1.0, 2.0 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                         / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return Labeller(w)


def marked(page: list[Block]) -> list[bool] | None:
    """Labels that a page's own semantic elements give: main text lies in an article or main
    element and in nothing that is named as boilerplate. None for a page without such an element."""
    labels = [b.at.held and not b.at.named for b in page]
    return labels if any(labels) else None


def made(count: int) -> list[tuple[list[Block], list[bool]]]:
    """Training pages from rules: an article in one of several containers, and around, before,
    after or inside it boilerplate that is named by an element, a class or only by its looks."""
    rng = np.random.default_rng(SEED + 1)
    letters = list("abcdefghijklmnoprstuvéäñ")
    pick = lambda xs: xs[rng.integers(len(xs))]

    known = ["".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(4000)]

    def words(n: int) -> str:
        return " ".join(known[k] for k in rng.integers(0, len(known), n))

    def boiler(base: tuple[str, ...], named: bool) -> list[Block]:
        inner = pick([("ul", "li", "a"), ("p",), (), ("div",), ("h3",), ("p", "a")])
        if named:
            outer = pick([(t,) for t in sorted(NOT_TEXT_TAGS)]
                         + [(pick(["div", "section", "ul"]), "." + x) for x in NOT_TEXT_WORDS] * 2)
            if outer[0] in ("form", "label"):
                inner = pick([("p",), ("label",), ("button",), ()])
        else:
            outer, inner = ("div",), ("ul", "li", "a")
        out = []
        for _ in range(rng.integers(1, 7)):
            text = words(rng.integers(1, 30 if named else 4))
            path = tuple(t for t in base + outer + inner if t != "a")
            out.append(Block(Path(None, path), text, len(text) if "a" in inner else 0))
        return out

    pages = []
    for _ in range(count):
        plain = rng.random() < 0.12
        base = ("html", "body") + pick([(), (), ("div",), ("div", ".wrapper"), ("div", ".page")])
        hold = ("div",) if plain else pick(
            [("article",)] * 3 + [("main",), ("main", "article"), ("div", "." + pick(TEXT_WORDS))])
        page, labels = [], []

        def add(parts: list[Block], label: bool) -> None:
            page.extend(parts)
            labels.extend([label] * len(parts))

        for _ in range(rng.integers(0, 4)):
            add(boiler(base, not plain), False)
        kinds = [("h1",)] + [pick([("p",)] * 6 + [("h2",), ("ul", "li"), ("blockquote", "p"),
                                                 ("p", "b"), ("pre",), ("section", "p")])
                             for _ in range(rng.integers(1, 14))]
        for kind in kinds:
            n = rng.integers(2, 10) if kind[0][0] == "h" else rng.integers(
                8 if plain else 1, 120)
            text = words(n) + pick([".", "."])
            linked = int(len(text) * rng.random() * 0.3) if rng.random() < 0.15 else 0
            add([Block(Path(None, base + hold + kind), text, linked)], True)
            if not plain and rng.random() < 0.08:
                add(boiler(base + hold, True), False)
        for _ in range(rng.integers(0, 4)):
            add(boiler(base + (hold if not plain and rng.random() < 0.2 else ()), not plain),
                False)
        pages.append((page, labels))
    return pages


def train(pages: DataFrame, key: str = "page_id", html: str = "html",
          sample: int = SAMPLE) -> Labeller:
    """Trains the labeller on the `sample` pages with the smallest hashes of their key, as far as
    their elements label them, and on the made pages. Works without any page."""
    order = F.xxhash64(pages[f"`{key}`"], pages[f"`{html}`"])
    some = pages.where(pages[f"`{html}`"].isNotNull()).select(
        order.alias("_order"), pages[f"`{html}`"].alias("_html"))
    n = some.count()
    share = min(1.0, 1.5 * sample / max(n, 1) + 50 / max(n, 1))
    if share < 1:  # so that few rows reach the last task of the sort
        some = some.where(F.col("_order") <= int(-(1 << 63) + share * ((1 << 64) - 1)))
    taught = []
    for row in some.orderBy("_order").limit(sample).toLocalIterator():
        page = blocks(row["_html"])
        labels = marked(page) if page else None
        if labels:
            taught.append((page, labels))
    return teach(taught + made(MADE))


def extract(pages: DataFrame, model: Labeller, html: str = "html") -> DataFrame:
    """`pages` with `main_text`: the blocks labelled main text, in page order, one line each.

    A null or empty page has an empty text; all rows and other columns stay (a column of that name
    is replaced). Whole pages are read; a page is one sequence, so memory follows the longest page.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # weights of fixed size

    @pandas_udf("string")
    def main_text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labeller = shared.value
        for series in parts:
            out = []
            for at in range(0, len(series), 256):
                found = [blocks(p or "") for p in series.iloc[at:at + 256]]
                out += ["\n".join(b.text for b, keep in zip(page, kept) if keep)
                        for page, kept in zip(found, labeller.label(found))]
            yield pd.Series(out, dtype="object")

    return pages.withColumn("main_text", main_text(pages[f"`{html}`"]))
