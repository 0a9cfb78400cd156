"""Patient matching: weighted agreement on five fields, tiers, one global id per cluster, and what is left to review.

Weights: first and last name 0.20 each (0.15 when they only nearly agree), birth date 0.25, last six phone digits 0.20,
identifier-hash suffix 0.15. Two names nearly agree if they become equal when at most one letter is taken out of each;
names of fewer than four letters have to be equal. A blank or missing field agrees with nothing.

A score of 0.70 or more is only possible for records that share two of birth date, phone and identifier, their block. In
a block of up to `SMALL_BLOCK` records, pairs are scored one by one. Larger blocks are never paired: every way to agree that reaches
0.70 (`PATTERNS`) is an equality key, under which a name that may nearly agree takes part in all its forms with one letter
less. Two records share such a form exactly if the names nearly agree, so all members of a group match each other with at
least the score of its pattern, and a group is a star around its smallest member.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.components import connected_components
from carelake.operators.joins import join_summary, settled

WEIGHTS = {"first": 0.20, "last": 0.20, "birth_date": 0.25, "phone6": 0.20, "id4": 0.15}
NEAR_NAME_WEIGHT = 0.15
NEAR_FROM_LETTERS = 4
MERGE_SCORE = 0.85
REVIEW_SCORE = 0.70

# All minimal field sets whose weights reach the threshold; `~` marks a name that may nearly agree.
MERGE_RULES = [
    ["birth_date", "phone6", "first", "last"],
    ["birth_date", "phone6", "id4", "~first", "~last"],
]
REVIEW_RULES = [
    ["birth_date", "phone6", "id4", "~first"],
    ["birth_date", "phone6", "id4", "~last"],
    ["birth_date", "phone6", "~first", "~last"],
    ["birth_date", "id4", "~first", "~last"],
    ["phone6", "id4", "first", "~last"],
    ["phone6", "id4", "~first", "last"],
]
#: All ways to agree with a score to report, and that score.
PATTERNS = [([*strong, *(n for n in (first, last) if n)], round(
    sum(WEIGHTS[f] for f in strong) + sum(NEAR_NAME_WEIGHT if n[0] == "~" else WEIGHTS[n] for n in (first, last) if n), 2))
    for strong in (["birth_date", "phone6", "id4"], ["birth_date", "phone6"], ["birth_date", "id4"], ["phone6", "id4"])
    for first in ("first", "~first", "") for last in ("last", "~last", "")]
PATTERNS = [(pattern, score) for pattern, score in PATTERNS if score >= REVIEW_SCORE]
#: Records of a block that are compared with each other; larger blocks are grouped instead.
SMALL_BLOCK = 64
#: Clusters of a group that are listed in pairs; wider groups are listed by member.
WIDE_TIE = 64
FIELDS = ["first", "last", "birth_date", "phone6", "id4"]
STRONG = [["birth_date", "phone6"], ["birth_date", "id4"], ["phone6", "id4"]]


def _filled(col: Column) -> Column:
    """Text without outer blanks; NULL when nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def near_forms(name: Column) -> Column:
    """The name and its forms with one letter less, any script."""
    n = F.length(name)
    less = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(
        F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, n)))
    return F.when(n >= NEAR_FROM_LETTERS, F.array_union(F.array(name), less)).otherwise(F.array(name))


def match_fields(df: DataFrame, record_id: str, first: str, last: str, birth_date: str, phone: str,
                 id_hash: str) -> DataFrame:
    """Comparison fields of every record."""
    return df.select(
        F.col(record_id).alias("record_id"),
        _filled(F.upper(F.col(first))).alias("first"), _filled(F.upper(F.col(last))).alias("last"),
        F.col(birth_date).alias("birth_date"),
        F.right(_filled(F.col(phone)), F.lit(6)).alias("phone6"),
        F.right(_filled(F.col(id_hash)), F.lit(4)).alias("id4"),
    )


def _blocks(fields: DataFrame) -> DataFrame:
    """Every record with each block it shares with others: `record_id`, `_key`, `_n` (records of the block)."""
    keys = [F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.xxhash64(F.lit(i), F.col(x), F.col(y)))
            for i, (x, y) in enumerate(STRONG)]
    members = fields.select("record_id", *FIELDS, F.explode(F.array_compact(F.array(*keys))).alias("_key"))
    sizes = members.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return settled(join_summary(members, sizes, ["_key"], "inner"))


def _pairs(blocks: DataFrame, small: int) -> DataFrame:
    """Matches inside small blocks: `a` < `b`, `score`, name similarities."""
    row = F.struct("record_id", *FIELDS)
    rows = blocks.where(F.col("_n") <= small)
    x = rows.select("_key", row.alias("x"))
    y = rows.select("_key", row.alias("y"))
    both = x.join(y, "_key").where("x.record_id < y.record_id").withColumn("score", _score("x", "y"))
    return both.where(F.col("score") >= REVIEW_SCORE).select(
        F.col("x.record_id").alias("a"), F.col("y.record_id").alias("b"), "score",
        _similarity(F.col("x.first"), F.col("y.first")).alias("first_similarity"),
        _similarity(F.col("x.last"), F.col("y.last")).alias("last_similarity")).dropDuplicates(["a", "b"])


def _crowd(fields: DataFrame, blocks: DataFrame, small: int) -> DataFrame | None:
    """Records of blocks that are too large for pairs; none, and no grouping to plan, without such blocks."""
    if blocks.where(F.col("_n") > small).isEmpty():
        return None
    return fields.join(blocks.where(F.col("_n") > small).select("record_id").distinct(), "record_id", "left_semi")


def _with_forms(keys: Column, forms: Column) -> Column:
    return F.flatten(F.transform(keys, lambda key: F.transform(forms, lambda form: F.concat(key, F.array(form)))))


_KEYS = "array<struct<_key:bigint,score:double>>"


def _members(fields: DataFrame, patterns: Sequence[tuple[Sequence[str], float]]) -> DataFrame:
    """`record_id`, `_key` and `score` for every pattern and form a record has the fields for."""
    keys = F.array().cast(_KEYS)
    for number, (pattern, score) in enumerate(patterns):
        fixed = [f for f in pattern if not f.startswith("~")]
        made = F.array(F.array(F.lit(str(number)), *[F.col(f).cast("string") for f in fixed]))
        for f in pattern:
            if f.startswith("~"):
                made = _with_forms(made, near_forms(F.col(f[1:])))
        known = F.lit(True)
        for f in pattern:
            known = known & F.col(f.removeprefix("~")).isNotNull()
        hashed = F.arrays_zip(F.transform(made, lambda k: F.xxhash64(k)).alias("_key"),
                              F.array_repeat(F.lit(score), F.size(made)).alias("score")).cast(_KEYS)
        keys = F.concat(keys, F.when(known, hashed).otherwise(F.array().cast(_KEYS)))
    return fields.select("record_id", F.inline(keys)).distinct()


def _near(a: str, b: str, field: str) -> Column:
    x, y = F.col(f"{a}.{field}"), F.col(f"{b}.{field}")
    return F.coalesce(F.arrays_overlap(near_forms(x), near_forms(y)), F.lit(False))


def _score(a: str, b: str) -> Column:
    def same(f: str) -> Column:
        return F.coalesce(F.col(f"{a}.{f}") == F.col(f"{b}.{f}"), F.lit(False))

    total = F.lit(0.0)
    for f in ("birth_date", "phone6", "id4"):
        total = total + F.when(same(f), WEIGHTS[f]).otherwise(0.0)
    for f in ("first", "last"):
        total = total + F.when(same(f), WEIGHTS[f]).when(_near(a, b, f), NEAR_NAME_WEIGHT).otherwise(0.0)
    return F.round(total, 2)


def _similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.round(1 - F.try_divide(F.levenshtein(a, b), longest), 4)


def match_links(fields: DataFrame, small: int = SMALL_BLOCK) -> DataFrame:
    """Every record that matches another one, beside its best match: `record_id`, `match_id`, `score`, name similarities,
    tier MERGE / REVIEW.

    The best match has the highest score, among equal ones the smallest id. One row per record; `review_queue` has
    every tie.
    """
    blocks = _blocks(fields)
    pairs = _pairs(blocks, small)
    ends = F.array(F.struct(F.col("a").alias("record_id"), F.col("b").alias("match_id")),
                   F.struct(F.col("b").alias("record_id"), F.col("a").alias("match_id")))
    near = pairs.select(F.inline(ends), "score", "first_similarity", "last_similarity")
    crowd = _crowd(fields, blocks, small)
    links = near if crowd is None else near.unionByName(_best_of_groups(crowd))
    rest = F.struct("match_id", "score", "first_similarity", "last_similarity")
    best = links.groupBy("record_id").agg(F.min_by(rest, F.struct(-F.col("score"), "match_id")).alias("m"))
    return best.select("record_id", "m.*", tier(F.col("m.score")).alias("tier"))


def _best_of_groups(crowd: DataFrame) -> DataFrame:
    """The best match of every record of a crowd, from the groups it is in."""
    members = _members(crowd, PATTERNS)
    lowest = members.groupBy("_key").agg(F.min("record_id").alias("a"), F.max("record_id").alias("z")).where("a <> z")
    found = join_summary(members, lowest, ["_key"], "inner")
    second = found.where("record_id <> a").groupBy("_key").agg(F.min("record_id").alias("b"))
    other = F.when(F.col("record_id") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    # All members of a record's best group have its score, so the smallest of them is the best match.
    best = join_summary(found, second, ["_key"], "inner").select("record_id", other.alias("match_id"), "score").groupBy("record_id").agg(
        F.min_by("match_id", F.struct(-F.col("score"), "match_id")).alias("match_id"))
    row = F.struct("record_id", *FIELDS)
    return best.join(crowd.select("record_id", row.alias("x")), "record_id").join(
        crowd.select(F.col("record_id").alias("match_id"), row.alias("y")), "match_id").select(
        "record_id", "match_id", _score("x", "y").alias("score"),
        _similarity(F.col("x.first"), F.col("y.first")).alias("first_similarity"),
        _similarity(F.col("x.last"), F.col("y.last")).alias("last_similarity"))


def tier(score: Column) -> Column:
    return F.when(score >= MERGE_SCORE, "MERGE").when(score >= REVIEW_SCORE, "REVIEW").otherwise("SEPARATE")


def assign_global_ids(fields: DataFrame, prefix: str = "UPMI-", small: int = SMALL_BLOCK) -> DataFrame:
    """`(record_id, global_patient_id)`: records connected by MERGE matches share one id, that of the smallest of them.

    Clusters are the components of the merge pairs of small blocks and of stars around the smallest record of every group
    of a merge rule. A record that lacks a field of a rule stands alone for that rule.
    """
    blocks = _blocks(fields)
    return _assigned(fields, blocks, _pairs(blocks, small), prefix, small)


def _assigned(fields: DataFrame, blocks: DataFrame, pairs: DataFrame, prefix: str, small: int) -> DataFrame:
    merged = pairs.where(F.col("score") >= MERGE_SCORE).select("a", "b")
    crowd = _crowd(fields, blocks, small)
    if crowd is not None:
        members = _members(crowd, [(rule, MERGE_SCORE) for rule in MERGE_RULES])
        anchors = members.groupBy("_key").agg(F.min("record_id").alias("a"), F.max("record_id").alias("z")).where("a <> z")
        merged = merged.unionByName(join_summary(members, anchors, ["_key"], "inner").select("a", F.col("record_id").alias("b")))
    clusters = connected_components(merged, lambda df, _: settled(df))
    found = fields.select("record_id").join(clusters.withColumnRenamed("node", "record_id"), "record_id", "left")
    return found.select("record_id", global_id(F.coalesce("component", "record_id"), prefix).alias("global_patient_id"))


def review_queue(fields: DataFrame, prefix: str = "UPMI-", small: int = SMALL_BLOCK, wide: int = WIDE_TIE) -> DataFrame:
    """All ties left to review, between clusters: `left_id`, `right_id`, `score` (the highest), `tie_id`.

    One row per pair of clusters that a REVIEW match connects. A group of more than `wide` clusters that all match each other
    is not listed in pairs but by member: its rows share a `tie_id`, and each has the group's smallest cluster on the left;
    their score is the least that the group's agreement gives. No tie is lost, and rows stay in proportion to records.
    """
    blocks = _blocks(fields)
    pairs = settled(_pairs(blocks, small))
    assigned = settled(_assigned(fields, blocks, pairs, prefix, small))
    one = assigned.select(F.col("record_id").alias("a"), F.col("global_patient_id").alias("x"))
    two = assigned.select(F.col("record_id").alias("b"), F.col("global_patient_id").alias("y"))
    near = pairs.where(F.col("score") < MERGE_SCORE).join(one, "a").join(two, "b").where("x <> y").select(
        F.least("x", "y").alias("left_id"), F.greatest("x", "y").alias("right_id"), "score")
    crowd = _crowd(fields, blocks, small)
    if crowd is None:
        return near.groupBy("left_id", "right_id").agg(F.max("score").alias("score")).withColumn("tie_id", F.lit(None).cast("string"))
    # Groups of a crowd as sets of clusters; of groups with the same set, the one with the highest score is kept.
    members = _members(crowd, PATTERNS).join(assigned, "record_id").select(
        "_key", "score", F.col("global_patient_id").alias("id")).distinct()
    sets = members.groupBy("_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.max("score").alias("score"),
        F.bit_xor(F.xxhash64("id")).alias("p"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("q")).where("n > 1")
    kept = sets.groupBy("n", "least", "p", "q").agg(F.max_by("_key", F.struct("score", "_key")).alias("_key"))
    groups = settled(join_summary(members, kept, ["_key"], "inner"))
    few = groups.where(F.col("n") <= wide)
    listed = few.select("_key", "score", F.col("id").alias("left_id")).join(
        few.select("_key", F.col("id").alias("right_id")), "_key").where("left_id < right_id").select("left_id", "right_id", "score")
    by_pair = near.unionByName(listed).groupBy("left_id", "right_id").agg(F.max("score").alias("score"))
    by_member = groups.where((F.col("n") > wide) & (F.col("id") != F.col("least"))).select(
        F.col("least").alias("left_id"), F.col("id").alias("right_id"), "score", F.col("_key").cast("string").alias("tie_id"))
    return by_pair.withColumn("tie_id", F.lit(None).cast("string")).unionByName(by_member)


def global_id(label: Column, prefix: str = "UPMI-") -> Column:
    """Global id text: the prefix and at least eight digits; longer numbers are not cut."""
    digits = label.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) < 8, F.lpad(digits, 8, "0")).otherwise(digits))


def duplicate_rate(assigned: DataFrame) -> DataFrame:
    """Records, distinct patients and the share of surplus records in percent."""
    per_id = assigned.groupBy("global_patient_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("patients"),
        F.round(F.try_divide(F.sum(F.col("n") - 1), F.sum("n")) * 100, 4).alias("duplicate_rate_pct"))
