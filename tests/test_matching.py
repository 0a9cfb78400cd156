import itertools
import random

import pytest
from pyspark.sql import functions as F

from carelake.operators import matching
from carelake.operators.components import connected_components as components_of

def agreement_patterns():
    """Every way two records can agree: names exact, nearly or not; the other fields equal or not."""
    for f, l, d, p, i in itertools.product([2, 1, 0], [2, 1, 0], [1, 0], [1, 0], [1, 0]):
        agreed = set()
        agreed |= {"birth_date"} if d else set()
        agreed |= {"phone6"} if p else set()
        agreed |= {"id4"} if i else set()
        score = 0.25 * d + 0.20 * p + 0.15 * i
        for level, name in zip((f, l), ("first", "last")):
            agreed |= {name, f"~{name}"} if level == 2 else {f"~{name}"} if level == 1 else set()
            score += {2: 0.20, 1: 0.15, 0: 0.0}[level]
        yield agreed, round(score, 2)


def test_rules_cover_exactly_the_scores_above_the_thresholds():
    def hit(rules, agreed):
        return any(set(rule) <= agreed for rule in rules)

    for agreed, score in agreement_patterns():
        assert hit(matching.MERGE_RULES, agreed) == (score >= matching.MERGE_SCORE), (agreed, score)
        both = matching.REVIEW_RULES + matching.MERGE_RULES
        assert hit(both, agreed) == (score >= matching.REVIEW_SCORE), (agreed, score)


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(2)
    rows = []
    for i in range(220):
        first = rng.choice(["ANNA", "ANITA", "ANITHA", "RAVI", "Wu", "முருகன்", "முருகா", "கண்ணன்", " ", None])
        last = rng.choice(["KRISHNAMURTHY", "KRISHNAN", "KRISNAN", "RAO", "ROY", "Yao", "", "செல்வி"])
        rows.append((i, first, rng.choice(["1990", "1991", None]), rng.choice(["111111", "222222", " ", None]),
                     rng.choice(["aaaa", "bbbb", "cccc", ""]), last))
    raw = spark.createDataFrame(rows, "record_id long, f string, birth_date string, phone string, id_hash string, l string")
    return matching.match_fields(raw, "record_id", "f", "l", "birth_date", "phone", "id_hash")


def near(a, b):
    forms = lambda n: {n} | ({n[:k] + n[k + 1:] for k in range(len(n))} if len(n) >= 4 else set())
    return bool(forms(a) & forms(b))


def pair_score(a, b):
    same = lambda f: a[f] is not None and a[f] == b[f]
    s = 0.25 * same("birth_date") + 0.20 * same("phone6") + 0.15 * same("id4")
    for name in ("first", "last"):
        known = a[name] is not None and b[name] is not None
        s += 0.20 if same(name) else 0.15 if known and near(a[name], b[name]) else 0
    return round(s, 2)


def components(ids, pairs):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def test_patterns_are_all_ways_to_agree_that_reach_review():
    for agreed, score in agreement_patterns():
        reached = [s for pattern, s in matching.PATTERNS if set(pattern) <= agreed]
        assert max(reached, default=0) == (score if score >= matching.REVIEW_SCORE else 0), (agreed, score)


#: Blocks in pairs, all grouped, and some of both.
SIZES = [1000, 1, 30]


@pytest.mark.parametrize("small", SIZES)
def test_clusters_equal_all_pairs(people, small):
    rows = people.collect()
    merge = [(a["record_id"], b["record_id"]) for a, b in itertools.combinations(rows, 2) if pair_score(a, b) >= 0.85]
    want = components([r["record_id"] for r in rows], merge)
    got = {r["record_id"]: r["global_patient_id"] for r in matching.assign_global_ids(people, small=small).collect()}
    assert got == {i: f"UPMI-{m:08d}" for i, m in want.items()}


@pytest.mark.parametrize("small", SIZES)
def test_every_record_is_beside_its_best_match(people, small):
    rows = people.collect()
    want = {}
    for a, b in itertools.permutations(rows, 2):
        score = pair_score(a, b)
        if score >= 0.70:
            want[a["record_id"]] = min(want.get(a["record_id"], (-score, b["record_id"])), (-score, b["record_id"]))
    got = {r["record_id"]: (-r["score"], r["match_id"]) for r in matching.match_links(people, small).collect()}
    assert got == want and want
    tiers = {r["tier"] for r in matching.match_links(people, small).collect()}
    assert tiers == {"MERGE", "REVIEW"}


def ties(people):
    """All REVIEW pairs between different clusters, with the highest score."""
    rows = people.collect()
    merge = [(a["record_id"], b["record_id"]) for a, b in itertools.combinations(rows, 2) if pair_score(a, b) >= 0.85]
    cluster = {i: f"UPMI-{m:08d}" for i, m in components([r["record_id"] for r in rows], merge).items()}
    want = {}
    for a, b in itertools.combinations(rows, 2):
        x, y = sorted((cluster[a["record_id"]], cluster[b["record_id"]]))
        if x != y and 0.70 <= pair_score(a, b) < 0.85:
            want[x, y] = max(want.get((x, y), 0), pair_score(a, b))
    return want


@pytest.mark.parametrize("small", SIZES)
def test_review_queue_has_every_tie_between_clusters(people, small):
    got = matching.review_queue(people, small=small, wide=1000).collect()
    assert {(r.left_id, r.right_id): r.score for r in got} == ties(people) and len(got) == len(ties(people)) > 0


def test_wide_ties_are_listed_by_member(people):
    got = matching.review_queue(people, small=1, wide=2).collect()
    covered = {(r.left_id, r.right_id) for r in got if r.tie_id is None}
    groups = {}
    for r in got:
        if r.tie_id is not None:
            groups.setdefault(r.tie_id, set()).update((r.left_id, r.right_id))
    assert groups
    for members in groups.values():
        covered |= set(itertools.combinations(sorted(members), 2))
    assert covered == set(ties(people))


def test_a_crowd_in_review_stays_in_proportion(spark):
    """Two thousand records that agree on all but the last name: one tie, not two million pairs."""
    n = 2000
    rows = spark.range(n).select(
        F.col("id").alias("record_id"), F.lit("BABY").alias("f"), F.concat(F.lit("X"), F.sha2(F.col("id").cast("string"), 256)).alias("l"),
        F.lit("1900").alias("b"), F.lit("9000000000").alias("p"), F.lit("0000").alias("h"))
    got = matching.review_queue(matching.match_fields(rows, "record_id", "f", "l", "b", "p", "h")).collect()
    assert len(got) == n - 1 and {r.left_id for r in got} == {"UPMI-00000000"} and len({r.tie_id for r in got}) == 1


@pytest.mark.parametrize("a, b, agree", [
    ("KRISHNAMURTHY", "KRISHNAN", False), ("RAO", "ROY", False), ("RAO", "RAO", True), ("KUMAR", "KUMR", True), ("WU", "WUI", False),
    ("முருகன்", "கண்ணன்", False), ("ANITA", "ANITHA", True), ("ABCX", "XABC", True)])
def test_near_names(spark, a, b, agree):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(F.arrays_overlap(matching.near_forms(F.col("a")), matching.near_forms(F.col("b")))).first()[0] == agree


def test_blank_fields_agree_with_nothing(spark):
    rows = [(1, "முருகன்", "ராஜன்", "1990", " ", "zzzz"), (2, "கண்ணன்", "செல்வி", "1990", "", "zzzz"),
            (3, " ", "", "1990", "9000012345", "zzzz"), (4, "", " ", "1990", "9000012345", "zzzz")]
    df = spark.createDataFrame(rows, "r long, f string, l string, b string, p string, h string")
    fields = matching.match_fields(df, "r", "f", "l", "b", "p", "h")
    assert matching.match_links(fields).count() == 0
    assert matching.assign_global_ids(fields).select("global_patient_id").distinct().count() == 4


def test_group_of_copies_gives_one_link_each(spark):
    n = 2000
    rows = spark.range(n).select(
        F.col("id").alias("record_id"), F.lit("ANNA").alias("f"), F.lit("RAO").alias("l"), F.lit("1990").alias("b"),
        F.lit("9000054321").alias("p"), F.lit("aaaa").alias("h"))
    fields = matching.match_fields(rows, "record_id", "f", "l", "b", "p", "h")
    assert matching.match_links(fields).count() == n
    assert matching.assign_global_ids(fields).select("global_patient_id").distinct().count() == 1


def test_long_chain_ends_in_few_rounds(spark, monkeypatch):
    """A thousand records in a row: the rounds grow with the logarithm, not with the links."""
    rounds = []
    monkeypatch.setattr(matching, "settled", lambda df, keep=matching.settled: rounds.append(1) or keep(df))
    edges = spark.createDataFrame([(i, i + 1) for i in range(999)], "a long, b long")
    out = components_of(edges, lambda df, _: matching.settled(df))
    assert out.count() == 1000 and out.select("component").distinct().count() == 1 and len(rounds) <= 2 * 16 + 2


def test_long_ids_are_not_cut(spark):
    df = spark.createDataFrame([(5,), (123456789012,)], "n long")
    assert [r[0] for r in df.select(matching.global_id(F.col("n"))).collect()] == ["UPMI-00000005", "UPMI-123456789012"]


def test_duplicate_rate(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "record_id long, global_patient_id string")
    assert tuple(matching.duplicate_rate(df).first()) == (4, 3, 25.0)
