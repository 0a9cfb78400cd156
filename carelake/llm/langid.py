"""Language of a text by a blended-spectrum string kernel, Nystroem landmarks and one-versus-rest kernel ridge regression.

The kernel of two texts is the number of character n-grams (all of 2 to 4 characters, lower case, each counted once)
that they share, over the root of the product of their numbers. N-grams are hashed to `WIDTH` places, so a text is a
row of zeros and ones. Training, on a bounded sample: `LANDMARKS` texts span the feature space
K_mm^(-1/2), and a ridge regression per language separates it from the rest on about `EXAMPLES` texts. Scoring is a
product of matrices, texts x places times places x landmarks times landmarks x languages; the last two are multiplied
once, before, which changes no result. Bounds of the sample hold for all languages together, in equal parts.

Learned from rows with text and language that are not held out. The sample takes each language's rows by their hash, with a
share that follows from a count of all rows; whole texts are used, those above `LONGEST` characters are not candidates
for the sample. Every text is scored whole. Null texts and texts without a letter are `und`; so is everything if nothing
could be learned. Repeated rows are scored alike. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import arrow, held_out, sampled
from carelake.llm.kernels import LETTER, pieces

GRAMS = (2, 3, 4)
WIDTH = 1 << 17
LANDMARKS = 160
EXAMPLES = 1_200
LONGEST = 20_000
RIDGE = 1e-2
SHARPNESS = 6.0
ROWS_AT_ONCE = 32
UNKNOWN = "und"


def places(text: str) -> np.ndarray:
    """Places of the text's n-grams, with repeats."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    out = []
    for n in GRAMS:
        if len(codes) >= n:
            value = np.full(len(codes) - n + 1, n, np.uint64)
            for k in range(n):
                value = value * np.uint64(0x9E3779B97F4A7C15) + codes[k: len(codes) - n + 1 + k]
            value ^= value >> np.uint64(31)
            out.append((value * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 17))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def distinct_places(text: str) -> np.ndarray:
    flags = np.zeros(WIDTH, bool)
    flags[places(text)] = True
    return np.flatnonzero(flags)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # places x languages
    offsets: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """One value per text and language; near 1 for the language, near -1 else."""
        ones = np.ones((WIDTH, 1), np.float32)
        both = np.concatenate((self.weights, ones), axis=1)
        rows = np.zeros((ROWS_AT_ONCE, WIDTH), np.float32)
        out = []
        for start in range(0, len(texts), ROWS_AT_ONCE):
            own = [places(t) for t in texts[start: start + ROWS_AT_ONCE]]
            for i, at in enumerate(own):
                rows[i, at] = 1
            sums = rows @ both
            for i, at in enumerate(own):
                rows[i, at] = 0
            out.append((sums[:, :-1] / np.sqrt(np.maximum(sums[:, -1:], 1)) + self.offsets)[: len(own)])
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))


def fit(texts: list[str], languages: list[str]) -> Model | None:
    """Model of the sample; the order of the rows does not matter to it beyond which ones become landmarks."""
    names = sorted(set(languages))
    if not names:
        return None
    label = np.array([names.index(x) for x in languages])
    each = max(1, LANDMARKS // len(names))
    marks = np.concatenate([np.flatnonzero(label == i)[:each] for i in range(len(names))])
    found = [distinct_places(t) for t in texts]
    spanned = np.zeros((len(marks), WIDTH), np.float32)
    for row, i in enumerate(marks):
        spanned[row, found[i]] = 1 / np.sqrt(max(len(found[i]), 1))
    values, vectors = np.linalg.eigh((spanned @ spanned.T).astype(np.float64))
    good = values > 1e-6
    onto = spanned.T @ (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
    x = np.stack([onto[at].sum(0) / np.sqrt(max(len(at), 1)) for at in found]).astype(np.float64)
    y = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Every language counts the same, however many of its rows are in the sample.
    weight = 1 / np.bincount(label)[label]
    mean_x, mean_y = np.average(x, axis=0, weights=weight), np.average(y, axis=0, weights=weight)
    xc, yc = x - mean_x, y - mean_y
    gram = (xc * weight[:, None]).T @ xc
    ridge = RIDGE * max(np.trace(gram) / max(len(gram), 1), 1e-12)
    beta = np.linalg.solve(gram + ridge * np.eye(len(gram)), (xc * weight[:, None]).T @ yc)
    return Model(names, onto @ beta.astype(np.float32), (mean_y - mean_x @ beta).astype(np.float32))


def learn(docs: DataFrame, examples: int = EXAMPLES) -> Model | None:
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
        & (F.length("text") <= LONGEST) & F.rlike("text", F.lit(r"\p{L}")))
    n_languages = rows.agg(F.countDistinct("lang")).first()[0]
    chosen = sampled(rows.select("doc_id", "lang"), "lang", F.col("doc_id"), max(1, examples // max(n_languages, 1)))
    # About `examples` ids, whatever the input; the texts stay where they are.
    some = rows.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    got = some.orderBy("lang", F.xxhash64("doc_id", "text"), "doc_id").collect()
    return fit([r.text for r in got], [r.lang for r in got])


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred` and `score` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for run in pieces(batch, "text", 4 << 20):
                texts = run.column("text").to_pylist()
                names, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
                known = [i for i, t in enumerate(texts) if model is not None and t and LETTER.search(t)]
                if known:
                    s = model.scores([texts[i] for i in known]).astype(np.float64) * SHARPNESS
                    p = np.exp(s - s.max(1, keepdims=True))
                    p /= p.sum(1, keepdims=True)
                    for i, row in zip(known, p, strict=True):
                        names[i], sure[i] = model.languages[int(row.argmax())], row.max()
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id"), run.column("held_out"), pa.array(names, pa.string()), pa.array(sure)],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return arrow(rows, score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
