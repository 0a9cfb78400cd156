"""Context-tree weighting against a plain recursion over the whole tree."""

import math
import random
import zlib
from collections import Counter

import pytest

from carelake.llm import ctw
from carelake.llm.common import Scratch

from .conftest import prose


def bodies_of(rows):
    return [(i, b" ".join((t or "").encode().lower().split()) + b"\n", zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False)
            for i, t in rows]


def decisions(body, depth):
    padded = b"\n" * depth + body
    for at, byte in enumerate(body):
        context = padded[at: at + depth]
        for k in range(8):
            yield context, (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1


def plain_model(bodies, depth):
    """counts[(node, context of any length)] = [zeros, ones]; weighted by recursion."""
    counts = {}
    for body in bodies:
        for context, node, bit in decisions(body, depth):
            for d in range(depth + 1):
                counts.setdefault((node, context[depth - d:]), [0, 0])[bit] += 1
    children = {}
    for node, context in counts:
        if context:
            children.setdefault((node, context[1:]), []).append((node, context))
    weighted = {}

    def here(key):
        a, b = counts.get(key, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) if a + b else 0.0

    for key in sorted(counts, key=lambda k: -len(k[1])):
        if len(key[1]) == depth:
            weighted[key] = here(key)
        else:
            x, y = here(key), sum(weighted[c] for c in children[key])
            top = max(x, y)
            weighted[key] = math.log(0.5) + top + math.log(math.exp(x - top) + math.exp(y - top))

    def one(node, context, d=0):
        key = (node, context[depth - d:])
        a, b = counts.get(key, (0, 0))
        kt = (b + 0.5) / (a + b + 1)
        if d == depth:
            return kt
        stay = math.exp(math.log(0.5) + here(key) - weighted[key]) if key in weighted else 0.5
        return stay * kt + (1 - stay) * one(node, context, d + 1)

    return one


def expected(rows, depth):
    docs = bodies_of(rows)
    train = [b for _, b, held in docs if not held]
    one = plain_model(train, depth)
    counts = Counter(w for b in train for w in [*b.split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, body, held in docs:
        words = [*body.split(), b"\n"]
        p = [one(node, context) if bit else 1 - one(node, context) for context, node, bit in decisions(body, depth)]
        out.append((i, held, len(words), sum(counts[w] > 0 for w in words), n,
                    sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), sum(map(math.log10, p)), len(body)))
    return out


def same(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, round(r[6], 3))
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)
        assert g[7] == pytest.approx(-w[6] * math.log2(10) / w[7], rel=1e-9)


@pytest.mark.parametrize("depth", [1, 3, 4])
def test_scores_match_plain_recursion(spark, depth, monkeypatch):
    monkeypatch.setattr(ctw, "BATCH_BYTES", 900)
    monkeypatch.setattr(ctw, "PIECE_BYTES", 300)
    r = random.Random(depth)
    rows = [(i, prose(r.randrange(3), r.randint(0, 40), 30)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, " \t\n"), (None, "No id THIS time"), (53, "é漢字  \x1cx\xa0y ÀB"), (53, rows[3][1]),
             (54, rows[3][1]), (55, "a" * 700), (56, "\0\0 \x7f")]
    df = spark.createDataFrame([(*x, 1, 2, "z") for x in rows], "doc_id long, text string, n long, word int, batch string").repartition(3)
    got = ctw.scored(df, Scratch(spark, "ctw"), depth).collect()
    same(got, expected(rows, depth))


def test_nothing_to_learn_from(spark, empty):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    df = spark.createDataFrame([(i, "Some words") for i in held], "doc_id long, text string")
    got = ctw.scored(df, Scratch(spark, "ctw")).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(True, 3, 0, 0, 0.0)] * 3
    assert all(r.bits_per_byte == pytest.approx(8) for r in got)
    assert ctw.scored(empty, Scratch(spark, "none")).count() == 0


def test_probabilities_of_all_next_bytes_sum_to_one():
    one = plain_model([b"abracadabra abc\n", b"bad cab\n"], 2)
    for context in (b"ab", b"zz", b"\n\n"):
        total = 0.0
        for byte in range(256):
            p = 1.0
            for k in range(8):
                q = one((1 << k) | (byte >> (8 - k)), context)
                p *= q if (byte >> (7 - k)) & 1 else 1 - q
            total += p
        assert total == pytest.approx(1)


def test_held_out_texts_of_the_small_table(spark, small, odd):
    got = [r for r in ctw.scored(small("documents"), Scratch(spark, "ctw")).collect() if r.held_out]
    bits = [-r.score * math.log2(10) for r in got]
    assert sum(bits) / sum(b / r.bits_per_byte for b, r in zip(bits, got, strict=True)) < 2.6
    rows = ctw.scored(odd, Scratch(spark, "odd")).collect()
    assert len(rows) == odd.count() and all(r.score < 0 for r in rows)


def test_only_the_first_levels_pass_the_driver(spark):
    """Spark takes runs, nodes and what they are worth for small by their size in Parquet; none of them is replicated."""
    rows = [(i, prose(i, 200)) for i in range(30)]
    got = ctw.scored(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "joins"))
    before = got._jdf.queryExecution().executedPlan().toString()
    same(got.collect(), expected(rows, ctw.DEPTH))
    after = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    for text in (before, after):
        assert text.count("BroadcastHashJoin") == ctw.SENT and text.count("SortMergeJoin") == ctw.DEPTH - ctw.SENT + 2
