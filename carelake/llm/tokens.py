"""Token ids in patched frame-of-reference blocks, written as binary segments and read back.

A segment is one record of a Parquet table (so that Spark's own commit protocol protects the files); its `data` is

    magic 4 bytes, number of documents, ids and blocks (3 x uint32)
    document table: ids per document (uint32 each)
    block index: start byte of every block in the body (uint32 each)
    body: blocks of 128 ids

and a block is `minimum uint32, width uint8, exceptions uint8`, the ids less the minimum packed in `width` bits each,
then the exceptions as `place uint8, high bits uint32`. The width is the least one that holds a given share of the
block (`PACKED_SHARE`); what is larger leaves its low bits in its place and its high bits in the exception list.

Documents are in ascending id order over the whole table, or in that of a column the caller names: the range partition `part` and the segment number `seg` order
the records. Null and empty texts are one end id. Null ids come first; rows with equal ids are ordered by text.
Repeated rows are written each. An empty table gives an empty result. Other columns are neither read nor written.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, arrow
from carelake.llm.kernels import pieces, raw

MAGIC = b"PFB1"
BLOCK = 128
PACKED_SHARE = 0.95

#: Ids after which a segment is closed; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 18

END_ID = 0

#: Distinct text pieces whose ids a worker remembers (about 200 bytes each), beside those of the batch at hand; the half
#: that was learned first goes, but for what was met again.
REMEMBERED = 800_000

#: Bytes of text that are cut and looked up at a time.
BATCH_BYTES = 4 << 20

SEGMENT = "part int, seg int, n_ids long, doc_ids array<bigint>, data binary"
DECODED = "part int, seg int, doc_id bigint, at long, n_tokens long, ids_crc32 long"


# --- ids of a text -----------------------------------------------------------------------------------------------

class Encoder:
    """Ids of whole texts by the tokenizers library.

    A byte-level pre-tokenizer never joins a visible character with one before a single space or line feed in front of
    the next visible one, nor a line feed with a visible character, nor an ASCII letter with a sign behind it. The texts
    of a batch are cut there at once, and each distinct piece of the batch is looked up, or encoded, once. A new piece
    that is a word, maybe after a space and before signs, is cut as the pre-tokenizer cuts it: its signs are few, and its
    word is encoded with the other new words as one text. Other new pieces of a batch are encoded together, parted by the
    end-of-text mark. Texts with a mark go to the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.mark, self.mark_id = next(iter(special.items()), (None, None))
        self.specials = tuple(special)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ") or token == "Ċ"]] = True
        self.cuts_words = {"Ġ", "Ċ"} <= vocabulary.keys() and self._cuts_words()

    def _cuts_words(self) -> bool:
        """Whether the pre-tokenizer cuts gap, word and signs apart, and the text is not changed before."""
        cut = self.tokenizer.pre_tokenizer and [
            self.tokenizer.pre_tokenizer.pre_tokenize_str(text) for text in (f"a\nAz Za{SIGNS} é{SIGNS}", f"{SIGNS}\na")]
        return bool(cut) and self.tokenizer.normalizer is None and [[at for _, at in parts] for parts in cut] == [
            [(0, 1), (1, 2), (2, 4), (4, 7), (7, 7 + len(SIGNS)), (7 + len(SIGNS), 9 + len(SIGNS)), (9 + len(SIGNS), 9 + 2 * len(SIGNS))],
            [(0, len(SIGNS)), (len(SIGNS), len(SIGNS) + 1), (len(SIGNS) + 1, len(SIGNS) + 2)]]

    def _direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian uint32 ids of each text, without the end id."""
        data, at = raw(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
        ends = at.tolist()
        whole = self._whole(data, ends)
        if whole:
            rest = [i for i in range(len(texts)) if i not in whole]
            out = [whole.get(i, b"") for i in range(len(texts))]
            for i, ids in zip(rest, self([_text(data, ends, i) for i in rest]) if rest else [], strict=True):
                out[i] = ids
            return out
        cells = _cells(data, at, self.cuts_words)
        if len(cells) < 2:
            return [b""] * len(texts)
        coded = pa.LargeStringArray.from_buffers(
            len(cells) - 1, pa.py_buffer(cells), pa.py_buffer(data)).dictionary_encode()
        distinct = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        _, offsets, ids = pa.array(distinct, pa.large_binary()).take(coded.indices).buffers()
        starts = np.frombuffer(offsets, np.int64)[np.searchsorted(cells, at)].tolist()
        made = memoryview(ids) if ids else memoryview(b"")
        return [made[lo:hi].tobytes() for lo, hi in zip(starts[:-1], starts[1:], strict=True)]

    def _whole(self, data: np.ndarray, ends: list[int]) -> dict[int, bytes]:
        """Ids of the texts with a mark, by place; without a mark in the vocabulary, of all texts."""
        if self.mark is not None:
            held = data.tobytes()
            if not any(m.encode() in held for m in self.specials):
                return {}
        texts = [_text(data, ends, i) for i in range(len(ends) - 1)]
        return {i: self._direct(text) for i, text in enumerate(texts)
                if self.mark is None or any(m in text for m in self.specials)}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, pieces))
        if None in found:
            self._learn({p for p, ids in zip(pieces, found, strict=True) if ids is None and not self._kept(p)})
            known = self.known
            found = [known[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]
        return found

    def _kept(self, piece: str) -> bool:
        """Whether the ids of a piece are known, or were known before."""
        if piece not in self.known and piece in self.older:
            self.known[piece] = self.older[piece]
        return piece in self.known

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of new pieces."""
        known = self.known
        words: set[str] = set()
        signed: list[tuple[str, str, str]] = []
        others: list[str] = []
        for piece in pieces if self.cuts_words else ():
            word = piece.rstrip(SIGNS)
            letters = word[1:] if word[:1] == " " else word
            if not letters.isalpha() or not (letters.isascii() or max(letters) < LETTERS_END):
                others.append(piece)
                continue
            if word == piece or not self._kept(word):
                words.add(word)
            if word != piece:
                signed.append((piece, word, piece[len(word):]))
        self._encode_words(list(words))
        self._encode_others(others if self.cuts_words else list(pieces))
        for signs in {signs for _, _, signs in signed}.difference(known):
            known[signs] = self._direct(signs)
        for piece, word, signs in signed:
            known[piece] = known[word] + known[signs]

    def _encode_words(self, words: list[str]) -> None:
        """Words of letters, with or without a space before; in a text the id with the space, or of the line feed, opens each."""
        runs = [words[start: start + 512] for start in range(0, len(words), 512)]
        made = self.tokenizer.encode_batch_fast(
            ["".join([w if w[0] == " " else "\n" + w for w in run]) for run in runs], add_special_tokens=False)
        for run, encoded in zip(runs, made, strict=True):
            ids = np.array(encoded.ids, "<u4")
            data, cuts = ids.tobytes(), [*np.flatnonzero(self.opens[ids]).tolist(), len(ids)]
            for word, lo, hi in zip(run, cuts[:-1], cuts[1:], strict=True):
                self.known[word] = data[4 * lo + (0 if word[0] == " " else 4): 4 * hi]

    def _encode_others(self, pieces: list[str]) -> None:
        runs = [pieces[start: start + 512] for start in range(0, len(pieces), 512)]
        joined = self.tokenizer.encode_batch_fast([self.mark.join(run) for run in runs], add_special_tokens=False)
        for run, encoded in zip(runs, joined, strict=True):
            ids = np.array(encoded.ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark_id)
            data, lo = ids.tobytes(), 0
            for piece, hi in zip(run, [*cuts.tolist(), len(ids)], strict=True):
                self.known[piece] = data[4 * lo: 4 * hi]
                lo = hi + 1


def _text(data: np.ndarray, ends: list[int], i: int) -> str:
    return data[ends[i]: ends[i + 1]].tobytes().decode()


def _cells(data: np.ndarray, at: np.ndarray, cuts_words: bool) -> np.ndarray:
    """Where the pieces of the texts start in their bytes, and the end of the last one."""
    kind = KINDS[data]
    _mark_wide_gaps(data, kind)
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    gaps = np.flatnonzero((kind == SPACE) | (kind == LINE_FEED))
    # A gap at the end of a text, or beside another gap, belongs to what is before and after it.
    gaps = gaps[~(edge[gaps] | edge[gaps + 1])]
    gaps = gaps[(kind[gaps - 1] < SPACE) & (kind[gaps + 1] < SPACE)]
    edge[gaps] = True
    if cuts_words:
        edge[gaps[kind[gaps] == LINE_FEED] + 1] = True
        signs = np.flatnonzero(kind[1:] == SIGN) + 1
        edge[signs[kind[signs - 1] == LETTER]] = True
    return np.flatnonzero(edge).astype(np.int64)


def _mark_wide_gaps(data: np.ndarray, kind: np.ndarray) -> None:
    """All bytes of a gap character beyond ASCII become OTHER_GAP."""
    leads = np.flatnonzero(kind == WIDE_LEAD)
    kind[leads] = OTHER
    leads = leads[leads + 1 < len(data)]
    two = leads[data[leads] == 0xC2]
    two = two[np.isin(data[two + 1], [c[1] for c in WIDE_GAPS if len(c) == 2])]
    three = leads[(data[leads] != 0xC2) & (leads + 2 < len(data))]
    code = (data[three].astype(np.int32) << 16) | (data[three + 1].astype(np.int32) << 8) | data[three + 2]
    three = three[np.isin(code, [int.from_bytes(c) for c in WIDE_GAPS if len(c) == 3])]
    for places, size in ((two, 2), (three, 3)):
        for i in range(size):
            kind[places + i] = OTHER_GAP


#: Signs of ASCII but the apostrophe, which may begin a suffix of the word.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

#: Latin, Greek and Cyrillic letters are below; they are letters in every version of Unicode that a library may follow.
LETTERS_END = "\u0530"

#: Kinds of bytes; those of gap characters are the largest.
OTHER, LETTER, SIGN, WIDE_LEAD, SPACE, LINE_FEED, OTHER_GAP = range(7)

#: Gap characters beyond ASCII, and the kind of every byte; WIDE_LEAD is that of the first bytes of such characters.
WIDE_GAPS = [c.encode() for c in map(chr, range(0x80, 0x3001)) if c.isspace()]
KINDS = np.zeros(256, np.uint8)
KINDS[[b for b in range(128) if chr(b).isspace()]] = OTHER_GAP
KINDS[[ord(" "), ord("\n")]] = SPACE, LINE_FEED
KINDS[[b for b in range(128) if chr(b).isalpha()]] = LETTER
KINDS[list(SIGNS.encode())] = SIGN
KINDS[[c[0] for c in WIDE_GAPS]] = WIDE_LEAD

_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file; a task has one core, so the library starts no threads beside it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- blocks --------------------------------------------------------------------------------------------------------

def pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A segment of the documents' ids, one after another."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    full = np.zeros(n_blocks * BLOCK, np.uint32)
    full[:n] = ids
    rows = full.reshape(n_blocks, BLOCK)
    if n % BLOCK:
        rows[-1, n % BLOCK:] = rows[-1, : n % BLOCK].min()
    least = rows.min(1)
    rest = rows - least[:, None]
    place = min(BLOCK - 1, int(np.ceil(BLOCK * PACKED_SHARE)) - 1)
    width = _bits(np.partition(rest, place, axis=1)[:, place])
    odd_row, odd_at = np.nonzero(rest > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))[:, None])
    high = rest[odd_row, odd_at] >> width[odd_row].astype(np.uint32)
    odd = np.bincount(odd_row, minlength=n_blocks)
    size = 6 + BLOCK // 8 * width + 5 * odd
    starts = np.concatenate(([0], np.cumsum(size)))
    body = np.zeros(int(starts[-1]), np.uint8)
    head = np.zeros((n_blocks, 6), np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4], head[:, 5] = width, odd
    body[(starts[:-1, None] + np.arange(6)).ravel()] = head.ravel()
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        unit = "<u2" if w <= 16 else "<u4"
        planes = np.unpackbits(rest[at].astype(unit).view(np.uint8), bitorder="little")
        planes = planes.reshape(len(at), BLOCK, -1)[:, :, :w].reshape(len(at), -1)
        body[(starts[at, None] + 6 + np.arange(BLOCK // 8 * w)).ravel()] = np.packbits(
            planes, axis=1, bitorder="little").ravel()
    if len(odd_row):
        nth = np.arange(len(odd_row)) - np.repeat(np.concatenate(([0], np.cumsum(odd)[:-1])), odd)
        base = starts[odd_row] + 6 + BLOCK // 8 * width[odd_row] + 5 * nth
        entry = np.empty((len(odd_row), 5), np.uint8)
        entry[:, 0] = odd_at
        entry[:, 1:] = high.astype("<u4").view(np.uint8).reshape(-1, 4)
        body[(base[:, None] + np.arange(5)).ravel()] = entry.ravel()
    numbers = np.array([len(counts), n, n_blocks], "<u4").tobytes()
    return b"".join((MAGIC, numbers, np.asarray(counts, "<u4").tobytes(), starts[:-1].astype("<u4").tobytes(),
                     body.tobytes()))


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; 0 for 0."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def unpack(data: bytes, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the blocks from `first` up to `last`, ids per document of the segment)."""
    if data[:4] != MAGIC:
        raise ValueError("not a token segment")
    n_docs, n, n_blocks = np.frombuffer(data, "<u4", 3, 4).tolist()
    counts = np.frombuffer(data, "<u4", n_docs, 16)
    index = np.frombuffer(data, "<u4", n_blocks, 16 + 4 * n_docs).astype(np.int64)
    body = np.frombuffer(data, np.uint8, offset=16 + 4 * (n_docs + n_blocks))
    last = n_blocks if last is None else min(last, n_blocks)
    starts = index[first:last]
    least = body[starts[:, None] + np.arange(4)].copy().view("<u4").ravel()
    width, odd = body[starts + 4].astype(np.int64), body[starts + 5].astype(np.int64)
    out = np.zeros((last - first, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        packed = body[starts[at, None] + 6 + np.arange(BLOCK // 8 * w)]
        unit = 16 if w <= 16 else 32
        planes = np.zeros((len(at), BLOCK, unit), np.uint8)
        planes[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(at), BLOCK, w)
        out[at] = np.packbits(planes.reshape(len(at), -1), axis=1, bitorder="little").view(f"<u{unit // 8}")
    if odd.any():
        row = np.repeat(np.arange(last - first), odd)
        nth = np.arange(len(row)) - np.repeat(np.concatenate(([0], np.cumsum(odd)[:-1])), odd)
        base = starts[row] + 6 + BLOCK // 8 * width[row] + 5 * nth
        high = body[base[:, None] + 1 + np.arange(4)].copy().view("<u4").ravel()
        out[row, body[base]] |= high << width[row].astype(np.uint32)
    out += least[:, None]
    return out.ravel()[: min(n, last * BLOCK) - first * BLOCK], counts


# --- tables --------------------------------------------------------------------------------------------------------

def write(docs: DataFrame, scratch: Scratch, tokenizer: str, name: str = "segments", order: str | None = None) -> DataFrame:
    """Encode `text`, append the end id, and write segments in the order of the column `order`, without one in ascending
    `doc_id` order; returns the table read back."""
    from tokenizers import Tokenizer  # noqa: F401  the library is needed on every executor; fail here if it is not there

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        part, seg = TaskContext.get().partitionId(), 0
        end = np.array([END_ID], "<u4").tobytes()
        names: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def segment() -> pa.RecordBatch:
            nonlocal seg, size
            data = np.frombuffer(b"".join(held), "<u4")
            counts = np.array([len(x) // 4 for x in held])
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([len(data)], pa.int64()),
                pa.array([names], pa.list_(pa.int64())), pa.array([pack(data, counts)], pa.binary()),
            ], names=["part", "seg", "n_ids", "doc_ids", "data"])
            seg, size = seg + 1, 0
            names.clear()
            held.clear()
            return row

        for batch in batches:
            for run in pieces(batch, "text", BATCH_BYTES):
                for doc_id, ids in zip(run.column("doc_id").to_pylist(), ids_of(run.column("text")), strict=True):
                    names.append(doc_id)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= SEGMENT_IDS:
                        yield segment()
        if held:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([order] if order else []))
    by = [F.col(order)] if order else [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    return scratch.keep(arrow(ordered, encode, SEGMENT), name)


def read(segments: DataFrame) -> DataFrame:
    """Per document, decoded from its segment: place in the segment, number of ids, checksum of the ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids, counts = unpack(row.column("data")[0].as_py())
                raw = ids.astype("<u4").tobytes()
                ends = np.cumsum(counts.astype(np.int64))
                starts = ends - counts
                sums = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, row.column("part")[0].as_py(), np.int32)),
                    pa.array(np.full(n, row.column("seg")[0].as_py(), np.int32)),
                    row.column("doc_ids").flatten(), pa.array(starts), pa.array(counts.astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ], names=["part", "seg", "doc_id", "at", "n_tokens", "ids_crc32"])

    return arrow(segments, decode, DECODED)


def starts(segments: DataFrame) -> DataFrame:
    """Ids before each segment: a running sum inside each part, and one over the parts' totals."""
    rows = segments.select("part", "seg", "n_ids")
    totals = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = totals.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("part", "seg", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside")).join(
        ahead, "part").select("part", "seg", (F.col("inside") + F.col("ahead")).alias("first_id"))


def digest(docs: DataFrame, scratch: Scratch, tokenizer: str, order: str | None = None) -> DataFrame:
    segments = write(docs, scratch, tokenizer, order=order)
    return read(segments).join(starts(segments), ["part", "seg"]).select(
        "doc_id", (F.col("first_id") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
