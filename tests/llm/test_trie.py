"""The conversation trie against its SQL, and the search for where a sequence leaves it against plain comparison."""

import random

import pytest
from pyspark.sql import functions as F

from carelake.llm import trie
from carelake.llm.common import Scratch

from .test_sql import same

SCHEMA = "conv_id long, turn long, role string, text string, names string, n long, p long, depth long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


def tangled(seed, convs=120, longest=9):
    """Few different turns, so that many prefixes are shared; ends in the middle of others; whole copies."""
    r = random.Random(seed)
    rows, done = [], []
    for c in r.sample(range(400), convs):
        if done and r.random() < 0.3:
            turns = list(r.choice(done))[: r.randint(0, longest)]
        else:
            turns = [(r.choice(["user", "bot"]), r.choice(["a b", "a  b\tc", "", "é d"])) for _ in range(r.randint(1, longest))]
        done.append(turns)
        rows += [(c, i, role, text) for i, (role, text) in enumerate(turns)]
    r.shuffle(rows)
    return rows


def check(spark, rows):
    df = table(spark, rows)
    got = trie.trie(df, Scratch(spark, "trie"))
    same(got, trie.SQL, conversations=df.select("conv_id", "turn", "role", "text").toArrow())
    return got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_prefixes(spark, seed):
    check(spark, tangled(seed))


def test_odd_turns(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", ""), (1, None, None, "first"), (2, 5, "user", "a"), (2, 5, "bot", "a"),
            (2, 5, "bot", "a"), (None, 0, "user", "lost"), (-7, 1, "user", "minus"), (-3, 1, "user", "minus"), (0, 0, "user", "head"),
            (0, 1, "bot", "two"), (9223372036854775807, 0, "user", "far"), (60, 0, "u", "w " * 30_000), (61, 0, "u", "w " * 30_000)]
    rows += [(100 + i, 0, "user", "only") for i in range(20)]  # some lose their only turn and get none
    rows += [(800, i, "user", f"turn {i}") for i in range(300)] + [(801 + k, i, "user", f"turn {i}") for k in range(9) for i in range(50 * k)]
    got = check(spark, rows).collect()
    root = next(r for r in got if r.depth == 0)
    assert root.conv_id == -7 and root.parent_conv_id is None and root.ends_sha256 != trie.NO_ENDS


def test_no_conversation(spark):
    assert trie.trie(table(spark, []), Scratch(spark, "trie")).count() == 0
    assert trie.trie(table(spark, [(None, 0, "user", "x")]), Scratch(spark, "trie")).count() == 0


def test_only_turnless_conversations(spark):
    gone = [c for c in range(101, 120) if c in {r.conv_id for r in spark.range(101, 120).where(
        F.crc32(F.col("id").cast("string")) % 4 > 0).withColumnRenamed("id", "conv_id").collect()}]
    got = check(spark, [(c, 0, "user", "x") for c in gone]).collect()
    assert len(got) == 1 and got[0].n_convs == len(gone) and got[0].n_leaves == 1


def test_one_hash_along_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_AT_ONCE", 7)
    check(spark, [(c, i, "user", "same") for c in range(0, 4000, 20) for i in range(2)])


@pytest.mark.parametrize("a", range(0, 40, 7))
def test_two_fattest(spark, a):
    rows = spark.range(a + 1, 90).select(F.col("id").cast("int").alias("b"), trie.fattest(F.lit(a), F.col("id").cast("int")).alias("f")).collect()
    twos = lambda x: x & -x
    assert all(r.f == max(range(a + 1, r.b + 1), key=twos) for r in rows)


def test_sequences_leave_where_they_differ(spark):
    conversations = trie.rebuilt(table(spark, tangled(11, 200, 40))).cache()
    sequences = trie.distinct(conversations).cache()
    old, new = sequences.where("conv_id % 3 = 0"), sequences.where("conv_id % 3 > 0")
    nodes = trie.built(old, Scratch(spark, "trie"))
    left = {r.conv_id: r.leaves for r in trie.exits(nodes, new, 8).collect()}
    known = {r.conv_id: [(x.p, x.q) for x in r.names] for r in old.collect()}
    for r in new.collect():
        own = [(x.p, x.q) for x in r.names]
        assert left[r.conv_id] == max(sum(a == b for a, b in zip(own, k, strict=False)) for k in known.values())
