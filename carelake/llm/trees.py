"""Quality of a text by histogram gradient-boosted trees over statistics of the document.

Statistics are shares and averages of words, lines and characters of the whole text (`FEATURES`). Trees are grown level
by level on features cut at quantiles into at most `BINS` bins: histograms of the gradients of all nodes of a level are
one weighted count, and the best cut of a node follows from running sums over its bins. The trained trees are arrays
(feature, cut, child, value) that all rows of a batch walk down together.

Learned from labelled rows that are not held out: at most about `EXAMPLES` of each label, taken by hash, with a share
that follows from a count of all of them; only the statistics of these rows, not their texts, reach the driver. Rows
without a label or with an id that is null are not learned from; a document with several labels counts with each. With
one label value or none to learn from, every score is that value, or 0.5. Null and empty texts have statistics 0 and are
scored by them. Repeated rows are scored alike. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import arrow, held_out, sampled
from carelake.llm.kernels import U64, mix, occurrence, pieces, raw, shingles, words

EXAMPLES = 8_000
BINS = 64
TREES = 120
DEPTH = 4
RATE = 0.15
LEAST_WEIGHT = 3.0
RIDGE = 1.0

FEATURES = [
    "log_words", "word_bytes", "capital", "digit", "mark", "symbol", "shout", "bar", "beyond_ascii", "space",
    "all_capital_words", "mark_words", "end_words", "distinct_words", "top_word", "repeat_run", "repeat_three",
    "log_lines", "line_words", "repeat_lines", "short_words", "capital_starts", "byte_entropy",
]

_CLASS = np.zeros((256, 8), bool)
_CLASS[65:91, 0] = True
_CLASS[48:58, 1] = True
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()], 2] = True
_CLASS[[ord(c) for c in "#*$%&<>@^~=+_\\/{}[]"], 3] = True
_CLASS[ord("!"), 4] = True
_CLASS[ord("|"), 5] = True
_CLASS[128:, 6] = True
_CLASS[[9, 10, 11, 12, 13, 32], 7] = True


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return (total[at[1:]] - total[at[:-1]]).astype(np.float64)


def statistics(texts: pa.Array) -> np.ndarray:
    """(texts x FEATURES) of a column; columns in the order of FEATURES."""
    data, at = raw(texts)
    w = words(texts)
    n = len(at) - 1
    size = np.maximum(np.diff(at), 1).astype(np.float64)
    count = np.maximum(w.counts, 1).astype(np.float64)
    out = {"log_words": np.log1p(w.counts)}
    for k, name in enumerate(("capital", "digit", "mark", "symbol", "shout", "bar", "beyond_ascii", "space")):
        out[name] = _sums(_CLASS[data, k], at) / size
    length = w.ends - w.starts
    out["word_bytes"] = _sums(length, w.of) / count
    out["short_words"] = _sums(length <= 3, w.of) / count
    first, last = data[w.starts], data[w.ends - 1]
    out["capital_starts"] = _sums(_CLASS[first, 0], w.of) / count
    out["mark_words"] = _sums(_CLASS[last, 2], w.of) / count
    out["end_words"] = _sums((last == 46) | (last == 63), w.of) / count
    capitals = np.concatenate(([0], np.cumsum(_CLASS[data, 0], dtype=np.int64)))
    lower = np.concatenate(([0], np.cumsum((data >= 97) & (data <= 122), dtype=np.int64)))
    shouted = (capitals[w.ends] - capitals[w.starts] > 0) & (lower[w.ends] == lower[w.starts])
    out["all_capital_words"] = _sums(shouted, w.of) / count
    doc = w.doc
    nth = occurrence(w.hashes, doc)
    out["distinct_words"] = _sums(nth == 0, w.of) / count
    top = np.zeros(n)
    np.maximum.at(top, doc, nth + 1)
    out["top_word"] = top / count
    run = np.zeros(len(w.hashes), bool)
    run[1:] = (w.hashes[1:] == w.hashes[:-1]) & (doc[1:] == doc[:-1])
    out["repeat_run"] = _sums(run, w.of) / count
    three, three_at = shingles(w, 3)
    again = occurrence(three, np.repeat(np.arange(n), np.diff(three_at))) > 0
    out["repeat_three"] = _sums(again, three_at) / count
    out |= _lines(data, at, w, doc)
    out["byte_entropy"] = _entropy(data, at, size)
    return np.stack([out[f] for f in FEATURES], axis=1)


def _lines(data, at, w, doc) -> dict[str, np.ndarray]:
    """Lines with a word: their number, words in each, and the share that is equal to another line."""
    n = len(at) - 1
    if not len(w.hashes):
        zero = np.zeros(n)
        return {"log_lines": zero, "line_words": zero, "repeat_lines": zero}
    feeds = np.concatenate(([0], np.cumsum(data == 10)))
    line = feeds[w.starts]
    fresh = np.ones(len(line), bool)
    fresh[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(fresh)
    place = np.arange(len(line)) - np.repeat(begin, np.diff(np.append(begin, len(line))))
    value = np.add.reduceat(mix(w.hashes + place.astype(U64)), begin)
    owner = doc[begin]
    lines = np.bincount(owner, minlength=n).astype(np.float64)
    again = np.bincount(owner, weights=occurrence(value, owner) > 0, minlength=n)
    return {"log_lines": np.log1p(lines), "line_words": w.counts / np.maximum(lines, 1),
            "repeat_lines": again / np.maximum(lines, 1)}


def _entropy(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at) - 1)
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        if b > a:
            p = np.bincount(data[a:b], minlength=256) / size[i]
            p = p[p > 0]
            out[i] = -(p * np.log2(p)).sum()
    return out


@dataclass
class Forest:
    """Trees one after another in flat arrays; a leaf leads to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                goes = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(goes, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Forest:
    """Logistic loss; splits by the second-order gain."""
    mean = np.average(y, weights=weight) if len(y) else 0.5
    start = float(np.log(np.clip(mean, 1e-9, 1 - 1e-9) / np.clip(1 - mean, 1e-9, 1 - 1e-9)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    if len(y) and 0 < mean < 1:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
        margin = np.full(len(y), start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            roots.append(len(nodes))
            margin += _grow(nodes, binned, cuts, weight * (p - y), weight * p * (1 - p))
    table = np.array(nodes).reshape(-1, 5)
    return Forest(table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64),
                  table[:, 4], np.array(roots, np.int64), start)


def _grow(nodes: list[list[float]], binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray,
          h: np.ndarray) -> np.ndarray:
    """Appends one tree to `nodes`; returns what it adds to each row."""
    n, n_features = binned.shape

    def leaf(total_g: float, total_h: float) -> int:
        at = len(nodes)
        nodes.append([0, np.inf, at, at, -RATE * total_g / (total_h + RIDGE)])
        return at

    node = np.full(n, leaf(g.sum(), h.sum()))
    level = [int(node[0])]
    for _ in range(DEPTH):
        slot = {at: k for k, at in enumerate(level)}
        place = np.array([slot.get(int(a), -1) for a in range(min(level), len(nodes))])[np.maximum(node - min(level), 0)]
        place = np.where(node >= min(level), place, -1)
        rows = np.flatnonzero(place >= 0)
        if not len(rows):
            break
        key = (place[rows, None] * n_features + np.arange(n_features)) * BINS + binned[rows]
        shape = (len(level), n_features, BINS)
        sums = [np.bincount(key.ravel(), np.repeat(v[rows], n_features), int(np.prod(shape))).reshape(shape)
                for v in (g, h)]
        left_g, left_h = (np.cumsum(s, axis=2) for s in sums)
        all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
        gain = (left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE)
                - all_g**2 / (all_h + RIDGE))
        gain[(left_h < LEAST_WEIGHT) | (all_h - left_h < LEAST_WEIGHT)] = 0
        following = []
        for k, at in enumerate(level):
            f, b = divmod(int(gain[k].argmax()), BINS)
            if gain[k, f, b] <= 1e-9 or b >= len(cuts[f]):
                continue
            lg, lh = left_g[k, f, b], left_h[k, f, b]
            a, c = leaf(lg, lh), leaf(all_g[k, f, 0] - lg, all_h[k, f, 0] - lh)
            nodes[at][:4] = [f, cuts[f][b], a, c]
            own = rows[place[rows] == k]
            node[own] = np.where(binned[own, f] <= b, a, c)
            following += [a, c]
        level = following
        if not level:
            break
    return np.array([v[4] for v in nodes])[node]


def measured(rows: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` and `stats`, the statistics of `text`."""
    kinds = dict(rows.dtypes)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in pieces(batch, "text", 4 << 20):
                x = statistics(run.column("text"))
                offsets = pa.array(np.arange(run.num_rows + 1, dtype=np.int32) * len(FEATURES))
                stats = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(run.column(k) for k in keep), stats], names=[*keep, "stats"])

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "stats array<double>"])
    return arrow(rows.select(*keep, "text"), measure, schema)


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Forest:
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    some = sampled(known, "quality", F.col("doc_id"), examples)
    # The sample has about `examples` rows of each label, whatever the input; the texts stay where they are.
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    got = measured(rows, ["doc_id", "quality"]).orderBy("doc_id", "quality", "stats").collect()
    x = np.array([r.stats for r in got]).reshape(-1, len(FEATURES))
    y = np.array([r.quality for r in got], np.float64)
    # The rarer label is not outvoted: its rows weigh up to four times as much.
    share = np.array([max((y == v).mean(), 0.125) if len(y) else 1 for v in (0, 1)])
    return fit(x, y, 0.5 / share[y.astype(int)])


def scored(docs: DataFrame, forest: Forest) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = sent.value
        for batch in batches:
            for run in pieces(batch, "text", 4 << 20):
                s = forest.score(statistics(run.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id"), run.column("held_out"), pa.array(s),
                     pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return arrow(rows, score, f"doc_id {kind}, held_out boolean, score double, predicted int")
