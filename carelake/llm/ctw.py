"""Log-probability of texts by context-tree weighting over bytes.

A text becomes its words, ASCII letters in lower case, with one space between and a line feed at the end (the end token;
it also stands for what comes before a text). Each next byte is decomposed into its eight bits from the highest down. For
every node of this decomposition (a prefix of the bits of a byte) there is a tree of contexts, the last 0 to `DEPTH` bytes.
A tree node estimates the next bit by Krichevsky-Trofimov from the bits counted there, and its weighted probability is half that
estimate, half the product of its children's; so all depths are mixed, with weights that follow from the corpus.
A text is scored by the tree as learned: a bit's probability is the mix of the estimates along the path of its context,
each with its posterior weight. Contexts that were never seen estimate one half. The code length of a byte is -log2
of the product of its bits; over all bytes these are probabilities of texts, which sum to one.

Only distinct runs of DEPTH + 1 bytes and distinct words are shuffled, per batch of about `BATCH_BYTES` of text: once to be
counted, once to bring what they are worth back to the batch, where the texts meet it. Nothing of the corpus
passes the driver but two totals and the first two levels of the tree. All other joins sort and merge whatever Spark makes
of their sizes: runs and nodes take little space in Parquet, but eight decisions of each run many times that in a hash table.

Learned from texts that are not held out; a row with a null id is not held out. Null and empty texts consist of the end
token. Repeated rows count, and are scored, as often as they stand there. With nothing to learn from, bits have
probability one half and the base score is 0. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, arrow, ship
from carelake.llm.kernels import pieces

DEPTH = 4
SENT = 2  # levels whose parents go to all executors: 255 and 65,280 nodes at most
BATCH_BYTES = 32 << 20
PIECE_BYTES = 1 << 20
END = b"\n"
HALF = math.log(0.5)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text without the end; `split` and `lower` of bytes know ASCII only."""
    return (text or b"").lower().split()


def runs(bodies: list[bytes], depth: int) -> Iterator[np.ndarray]:
    """The last depth + 1 bytes at every byte of the bodies, one after another, the newest in the lowest place."""
    if not bodies:
        return
    data = np.frombuffer(END * depth + (END * (depth - 1)).join(bodies), np.uint8)
    sizes = np.array([len(b) for b in bodies])
    valid = np.ones(len(data), bool)
    valid[:depth] = False
    begins = depth + np.cumsum(sizes + depth - 1) - (sizes + depth - 1)
    for gap in range(1, depth):
        valid[begins[1:] - gap] = False
    for start in range(depth, len(data), PIECE_BYTES):
        end = min(start + PIECE_BYTES, len(data))
        key = np.zeros(end - start, np.int64)
        for back in range(depth, -1, -1):
            key = (key << 8) | data[start - back: end - back]
        yield key[valid[start:end]]


class Batch:
    """What a batch of texts has of runs and words, and how many of them are learned from."""

    def __init__(self) -> None:
        self.size = 0
        self.words = {True: Counter(), False: Counter()}
        self.found: dict[bool, list] = {True: [], False: []}

    def add(self, bodies: list[bytes], known: list[bool], depth: int) -> None:
        for learned in (True, False):
            own = [b for b, k in zip(bodies, known, strict=True) if k is learned]
            for body in own:
                self.words[learned].update(body.split())
            self.words[learned][END] += len(own)
            self.found[learned] += [np.unique(key, return_counts=True) for key in runs(own, depth)]
            if len(self.found[learned]) > 32:
                self.found[learned] = [self._merged(learned)]
        self.size += sum(map(len, bodies))

    def _merged(self, learned: bool) -> tuple[np.ndarray, np.ndarray]:
        parts = self.found[learned]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    def counts(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[list[bytes], list[int]]]:
        """Runs and words with the times they are learned from, 0 for those that are only scored."""
        keys, n = self._merged(True)
        more = np.setdiff1d(self._merged(False)[0], keys, assume_unique=True)
        learned, scored = self.words[True], self.words[False]
        words = {**dict.fromkeys(scored, 0), **learned}
        return (np.concatenate((keys, more)), np.concatenate((n, np.zeros(len(more), np.int64)))), (
            list(words), list(words.values()))


def prepared(docs: DataFrame, scratch: Scratch, depth: int) -> DataFrame:
    """Texts in compressed pieces with the batch they are in, and per batch its distinct runs and words.

    Of `bodies`, `run` and `word` one is set. A piece has the ids of its texts, whether they are held out, and their sizes.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, batch, ids = TaskContext.get().partitionId() << 32, Batch(), None

        def made(rows: int, **columns) -> pa.RecordBatch:
            fields = {"batch": pa.int64(), "ids": pa.list_(ids), "held": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int32()),
                      "bodies": pa.binary(), "run": pa.int64(), "word": pa.binary(), "n": pa.int64()}
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, number)) if f == "batch" else columns[f] if f in columns else pa.nulls(rows, t)
                 for f, t in fields.items()], names=list(fields))

        def summary() -> Iterator[pa.RecordBatch]:
            (keys, n), (words, m) = batch.counts()
            yield made(len(keys), run=pa.array(keys), n=pa.array(n))
            yield made(len(words), word=pa.array(words, pa.binary()), n=pa.array(m, pa.int64()))

        for got in batches:
            ids = got.schema.field("doc_id").type
            for piece in pieces(got, "text", PIECE_BYTES):
                bodies = [b" ".join(tokens(t)) + END for t in piece.column("text").to_pylist()]
                held = piece.column("held_out").to_pylist()
                batch.add(bodies, [not h for h in held], depth)
                yield made(1, ids=pa.ListArray.from_arrays([0, len(piece)], piece.column("doc_id")),
                           held=pa.array([held]), sizes=pa.array([[len(b) for b in bodies]], pa.list_(pa.int32())),
                           bodies=pa.array([pa.Codec("zstd").compress(b"".join(bodies), asbytes=True)]))
                if batch.size >= BATCH_BYTES:
                    yield from summary()
                    number, batch = number + 1, Batch()
        if batch.size:
            yield from summary()

    schema = f"batch long, ids array<{kind}>, held array<boolean>, sizes array<int>, bodies binary, run long, word binary, n long"
    return scratch.keep(arrow(rows, prepare, schema), "prepared")


def cut(bodies: bytes, sizes: np.ndarray) -> list[bytes]:
    """The texts of a piece."""
    whole = pa.Codec("zstd").decompress(bodies, int(sizes.sum()), asbytes=True)
    ends = np.cumsum(sizes).tolist()
    return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def log_gamma(z: Column) -> Column:
    """Of z from one half on: Stirling's series seven steps further."""
    x = z + 7
    steps = z * (z + 1) * (z + 2) * (z + 3) * (z + 4) * (z + 5) * (z + 6)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def estimate(zeros: Column, ones: Column) -> Column:
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    seen = log_gamma(zeros + F.lit(0.5)) + log_gamma(ones + F.lit(0.5)) - log_gamma(zeros + ones + F.lit(1.0))
    return F.when(zeros + ones == 0, 0.0).otherwise(seen - math.log(math.pi))


def log_sum(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def _bits(run: Column) -> Column:
    """The eight decisions of a run's newest byte: decomposition node and bit."""
    byte = run.bitwiseAND(255)
    return F.array(*[F.struct(
        F.shiftright(byte, 8 - k).bitwiseOR(1 << k).cast("int").alias("node"),
        F.shiftright(byte, 7 - k).bitwiseAND(1).alias("bit")) for k in range(8)])


def _decisions(found: DataFrame) -> DataFrame:
    return found.select("run", "n", F.shiftright("run", 8).alias("context"), F.inline(_bits(F.col("run"))))


def tree(found: DataFrame, scratch: Scratch, depth: int) -> list[DataFrame]:
    """Nodes by depth, from none up: `context`, `node`, `zeros`, `ones`, `weighted` (log of the weighted probability) and
    `stay`, the weight of the node's own estimate. Contexts that are only scored are nodes without counts."""
    level = scratch.keep(_decisions(found).groupBy("context", "node").agg(
        F.sum(F.col("n") * (1 - F.col("bit"))).alias("zeros"), F.sum(F.col("n") * F.col("bit")).alias("ones")).select(
        "*", estimate(F.col("zeros"), F.col("ones")).alias("weighted"), F.lit(1.0).alias("stay")), f"level-{depth}")
    levels = [level]
    for d in range(depth - 1, -1, -1):
        kids = level.groupBy(F.col("context").bitwiseAND((1 << 8 * d) - 1).alias("context"), "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("deeper"))
        here = kids.withColumn("here", estimate(F.col("zeros"), F.col("ones")))
        both = here.withColumn("weighted", HALF + log_sum(F.col("here"), F.col("deeper")))
        level = scratch.keep(both.select("context", "node", "zeros", "ones", "weighted", F.exp(
            HALF + F.col("here") - F.col("weighted")).alias("stay")), f"level-{d}")
        levels.insert(0, level)
    return levels


def mixed(levels: list[DataFrame]) -> DataFrame:
    """`one`, the probability of a one at every node of the last level: estimates along its path by their weights."""
    above = None
    for d, level in enumerate(levels):
        kt = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        own = level.select("context", "node", (F.col("stay") * kt).alias("here"), (1 - F.col("stay")).alias("on"))
        if above is None:
            above = own.select("context", "node", F.col("here").alias("one"), F.col("on").alias("rest"))
            continue
        parents = above.withColumnRenamed("context", "parent")
        parents = F.broadcast(parents) if d <= SENT else parents.hint("merge")
        own = own.withColumn("parent", F.col("context").bitwiseAND((1 << 8 * (d - 1)) - 1))
        above = own.join(parents, ["parent", "node"]).select(
            "context", "node", (F.col("one") + F.col("rest") * F.col("here")).alias("one"),
            (F.col("rest") * F.col("on")).alias("rest"))
    return above


def worth(found: DataFrame, scratch: Scratch, depth: int) -> DataFrame:
    """log10 of the probability of each run's newest byte after the bytes before it."""
    chance = mixed(tree(found, scratch, depth)).select("context", "node", "one")
    bits = _decisions(found).join(chance.hint("merge"), ["context", "node"])
    return bits.groupBy("run").agg(
        F.sum(F.log10(F.when(F.col("bit") == 1, F.col("one")).otherwise(1 - F.col("one")))).alias("value"))


class Table:
    """Values of long keys: one probe of a hash table, a binary search for what lies elsewhere."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(len(keys) * 4, 2).bit_length())
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.uint32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys), dtype=np.uint32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(keys)].astype(np.int64)
        other = np.flatnonzero(self.keys[at] != keys)
        at[other] = np.searchsorted(self.keys, keys[other])
        return self.values[at]


def scored(docs: DataFrame, scratch: Scratch, depth: int = DEPTH) -> DataFrame:
    """`doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`, `bits_per_byte` of every row.

    `score` is log10 of the model's probability of the text, `base_score` that of a model of single words.
    """
    rows = prepared(docs, scratch, depth)
    one_word = Window.partitionBy("word")
    words = scratch.keep(rows.where("word is not null").select(
        "batch", "word", "n", F.sum("n").over(one_word).alias("total"),
        F.row_number().over(one_word.orderBy("batch")).alias("nth")), "words")
    found = scratch.keep(rows.where("run is not null").groupBy("run").agg(F.sum("n").alias("n")), "runs")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.expr("nth = 1 and total > 0")).alias("distinct")).first()
    base, n_train = math.log10(total.n + 0.5 * (total.distinct + 1)), total.n
    none = F.lit(None)
    back = rows.where("run is not null").select("batch", "run").join(
        worth(found, scratch, depth).hint("merge"), "run").select(
        F.col("batch").alias("of"), "run", none.cast("binary").alias("word"), "value").unionAll(
        words.where("total > 0").select("batch", none.cast("long"), "word", F.col("total").cast("double")))
    kind = dict(docs.dtypes)["doc_id"]

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        of_runs = known.filter(known.column("run").is_valid())
        table = Table(of_runs.column("run").to_numpy(), of_runs.column("value").to_numpy())
        of_words = known.filter(known.column("word").is_valid())
        seen = dict(zip(of_words.column("word").to_pylist(), of_words.column("value").to_pylist(), strict=True))
        ids = texts.schema.field("ids").type.value_type
        out = []
        for piece in texts.to_batches(max_chunksize=1):
            sizes = np.asarray(piece.column("sizes").flatten())
            bodies = cut(piece.column("bodies")[0].as_py(), sizes)
            lists = [[*b.split(), END] for b in bodies]
            n = np.array([len(x) for x in lists])
            flat = (w for x in lists for w in x)
            c = np.fromiter(map(seen.get, flat, repeat(0.0)), np.float64, int(n.sum()))
            first = np.cumsum(n) - n
            values = np.concatenate([table(key) for key in runs(bodies, depth)])
            logs = np.add.reduceat(values, np.cumsum(sizes) - sizes)
            out.append(pa.RecordBatch.from_arrays([
                piece.column("ids").flatten().cast(ids), piece.column("held").flatten(), pa.array(n, pa.int64()),
                pa.array(np.add.reduceat((c > 0).astype(np.int64), first)),
                pa.array(np.full(len(n), n_train, np.int64)),
                pa.array(np.add.reduceat(np.log10(c + 0.5), first) - n * base), pa.array(logs),
                pa.array(-logs * math.log2(10) / sizes)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]))
        return pa.Table.from_batches(out)

    ship(docs.sparkSession)
    texts = rows.where("bodies is not null").select("batch", "ids", "held", "sizes", "bodies")
    return texts.groupBy("batch").cogroup(back.groupBy("of")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
               "score double, bits_per_byte double")
