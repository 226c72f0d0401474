"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown on a bounded sample of labelled rows (`SAMPLE`, the only bound; the sample is
the rows with the smallest hashes of their id). They are then flattened into numpy node arrays and
every document is scored by them inside Arrow batches, without a shuffle. Chosen features are
monotonic: more symbols, repeated lines or repeated word windows never make a document better.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from playmart.llm.batches import let_go

SAMPLE = 20_000          # labelled rows that the trees are grown on
TREES, DEPTH, RATE, BINS, LEAST = 80, 3, 0.15, 48, 5
SMOOTH = 1.0             # added to the weight of a leaf
MIN_WORDS, MAX_REPEAT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# feature -> direction in which quality may go as it grows (0: either)
FEATURES = {
    "words_log": 0, "word_length": 0, "symbols_per_word": -1, "dup_lines": -1, "repeat_words": -1,
    "distinct_words": 0, "upper": 0, "digits": 0, "punctuation": 0, "marks": 0, "line_words": 0,
    "longest_word": 0, "short_words": 0,
}
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!?~^=_@+\\{}[]"
STOPS = ".,;:'\"-()"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    size = len(codes)
    pairs = ids[:-2] * size + ids[1:-1]
    if size >= 1 << 20:  # three codes would not fit one integer
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, count = np.unique(pairs * size + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[at] > 1)
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[starts + k] = True
    return int(hit.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts and the features of one whole text; a null text has no words."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()  # bytes split at exactly the six blanks
    n, chars = len(words), len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dups = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    every, all_lines = max(n, 1), max(len(lines), 1)
    per_char = 1 / max(chars, 1)
    lengths = list(map(len, words)) or [0]
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    seen = np.bincount(raw, minlength=128)
    return [n, chars, symbols, dups, repeats], [
        float(np.log1p(n)), chars / every, symbols / every, dups / all_lines, repeats / every,
        len(set(words)) / every, float(seen[65:91].sum()) * per_char,
        float(seen[48:58].sum()) * per_char,
        sum(map(text.count, STOPS)) * per_char, sum(map(text.count, MARKS)) / every,
        n / all_lines, float(max(lengths)), sum(x <= 3 for x in lengths) / every,
    ]


@dataclass
class Trees:
    """All nodes of all trees in flat arrays; a leaf is its own child on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds that the rows are good, for all trees at once."""
        rows = np.arange(len(x))[:, None]
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        for _ in range(self.depth):
            low = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)


def grow(x: np.ndarray, good: np.ndarray, directions: list[int]) -> Trees | None:
    """Boosts trees on the logistic loss with second-order leaf values.

    A split on a feature with a direction is taken only if its children's values go that way, and
    the middle of both then bounds everything below them. None where only one class is given.
    """
    if len(good) < 2 or good.min() == good.max():
        return None
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    rate = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    score = np.full(len(good), base)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + SMOOTH), low, high))

    def gain(g: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        return -(g * w + (h + SMOOTH) * w * w / 2)

    def build(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        me = len(nodes)
        g, h = grad[rows], hess[rows]
        value = leaf(g.sum(), h.sum(), low, high)
        nodes.append([0, 0.0, me, me, value * RATE])
        if depth == DEPTH or len(rows) < 2 * LEAST:
            score[rows] += value * RATE
            return me
        best = (1e-6, None)
        whole = gain(g.sum(), h.sum(), value)
        for f, edge in enumerate(edges):
            if not len(edge):
                continue
            b = bins[rows, f]
            gl = np.bincount(b, g, len(edge) + 1).cumsum()[:-1]
            hl = np.bincount(b, h, len(edge) + 1).cumsum()[:-1]
            nl = np.bincount(b, minlength=len(edge) + 1).cumsum()[:-1]
            gr, hr = g.sum() - gl, h.sum() - hl
            wl = np.clip(-gl / (hl + SMOOTH), low, high)
            wr = np.clip(-gr / (hr + SMOOTH), low, high)
            ok = (nl >= LEAST) & (len(rows) - nl >= LEAST) & ((wr - wl) * directions[f] >= 0)
            won = np.where(ok, gain(gl, hl, wl) + gain(gr, hr, wr) - whole, -1)
            k = int(won.argmax())
            if won[k] > best[0]:
                best = (won[k], (f, k, (wl[k] + wr[k]) / 2))
        if best[1] is None:
            score[rows] += value * RATE
            return me
        f, k, mid = best[1]
        side = bins[rows, f] <= k
        d = directions[f]
        bounds = {0: (low, high, low, high), 1: (low, mid, mid, high), -1: (mid, high, low, mid)}[d]
        left = build(rows[side], depth + 1, *bounds[:2])
        right = build(rows[~side], depth + 1, *bounds[2:])
        nodes[me] = [f, float(edges[f][k]), left, right, 0.0]
        return me

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - good, p * (1 - p)
        roots.append(build(np.arange(len(good)), 0, -np.inf, np.inf))
    flat = np.array(nodes)
    return Trees(np.array(roots), *(flat[:, k].astype(t) for k, t in enumerate(
        (np.int32, float, np.int32, np.int32, float))), base, DEPTH)


def matrix(features: list[list[float]]) -> np.ndarray:
    return np.array(features, float).reshape(len(features), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Grows the trees on at most `sample` labelled documents.

    A hash bound that keeps about that many ids is found first, so what reaches one task does not
    grow with the labels. Where ids repeat, more rows than that may meet; the first `sample` of them
    by hash, id, quality and statistics teach. Rows without an id, text or quality teach nothing.
    None if there are no labels of both kinds.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(
        F.col("doc_id").alias("_id"), F.col("quality").alias("_quality"))
    n = known.count()
    if n == 0:
        return None
    share = min(1.0, 1.2 * sample / n)
    order = F.xxhash64("_id")
    bound = int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1
    ids = known.where(order <= F.lit(bound)).orderBy(order, "_id", "_quality").limit(sample)

    @pandas_udf("array<double>")
    def features(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        for texts in parts:
            yield pd.Series([statistics(t)[1] for t in texts])

    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).join(ids, "_id")
    measured = rows.select("_id", "_quality", features("_text").alias("_x"))
    taught = measured.orderBy(order, "_id", "_quality", "_x").limit(sample).toPandas()
    taught = taught.assign(_key=taught["_x"].map(tuple)).sort_values(["_id", "_quality", "_key"])
    return grow(matrix(taught["_x"].tolist()), taught["_quality"].to_numpy(float),
                list(FEATURES.values()))


def judge(docs: DataFrame, model: Trees | None, text: str = "text",
          least: float = 0.0, name: str = "quality") -> DataFrame:
    """`docs` with column `name`: a struct of the five base counts, `base_failed`, `score` (log odds)
    and `kept`. It replaces a column of that name; all other columns and all rows stay.

    `kept` is false if the base rule fails (under 50 words, or over half of the words repeated),
    else whether the score is over `least`. Without a model every document that passes is kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some hundred nodes
    kinds = ", ".join(f"{c} bigint" for c in COUNTS)

    @pandas_udf(f"{kinds}, base_failed boolean, score double, kept boolean")
    def rules(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        let_go()
        for texts in parts:
            found = [statistics(t) for t in texts]
            out = pd.DataFrame(np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS)),
                               columns=list(COUNTS))
            failed = (out.n_words < MIN_WORDS) | (
                100 * out.n_repeat_words > MAX_REPEAT * out.n_words)
            trees = shared.value
            score = trees.score(matrix([x for _, x in found])) if trees else np.ones(len(out))
            yield out.assign(base_failed=failed, score=score, kept=~failed & (score > least))

    return docs.withColumn(name, rules.asNondeterministic()(docs[f"`{text}`"]))
