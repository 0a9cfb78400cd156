"""Check digits as folds over the digits of a number, so that an order number is no card and no identifier.

Blanks and hyphens between digits do not count; text with anything else, or without a digit, is never valid.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Multiplication in the symmetries of a pentagon, row by row: turns 0 to 4, turned mirrors 5 to 9.
DIHEDRAL = [
    (j + k) % 5 if j < 5 and k < 5 else (j + k - 5) % 5 + 5 if j < 5 else (j - 5 - k) % 5 + 5 if k < 5 else (j - k) % 5
    for j in range(10) for k in range(10)]


def _powers(step: list[int]) -> list[int]:
    rows = [list(range(10))]
    for _ in range(7):
        rows.append([step[x] for x in rows[-1]])
    return [x for row in rows for x in row]


# Fixed value: the permutation of Verhoeff's scheme; its powers are applied by place, from the right.
PERMUTATION = _powers([1, 5, 7, 6, 2, 8, 3, 0, 9, 4])


def _digits(number: Column) -> Column:
    """Digits from the right, with their place; NULL for what is no number."""
    plain = F.regexp_replace(number, "[ -]", "")
    places = F.transform(F.split(F.reverse(plain), ""), lambda x, i: F.struct(x.cast("int").alias("digit"), i.alias("place")))
    return F.when(plain.rlike("^[0-9]+$"), places)


def luhn_valid(number: Column) -> Column:
    """Payment cards: every second digit from the right doubled, digit sums, a multiple of ten."""
    def worth(d):
        twice = d["digit"] * 2
        return F.when(d["place"] % 2 == 0, d["digit"]).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    total = F.aggregate(_digits(number), F.lit(0), lambda acc, d: acc + worth(d))
    return F.coalesce(total % 10 == 0, F.lit(False))


def verhoeff_valid(number: Column) -> Column:
    """Twelve-digit identifiers: the product of all permuted digits is the unit."""
    table, turned = F.lit(DIHEDRAL), F.lit(PERMUTATION)
    product = F.aggregate(_digits(number), F.lit(0), lambda acc, d: F.get(
        table, acc * 10 + F.get(turned, (d["place"] % 8) * 10 + d["digit"])))
    return F.coalesce(product == 0, F.lit(False))


_PLACES_SQL = "list_reverse(string_split(regexp_replace({n}, '[ -]', '', 'g'), ''))"
LUHN_SQL = (
    "(regexp_matches({n}, '^[0-9 -]*[0-9][0-9 -]*$') AND list_sum(list_transform(" + _PLACES_SQL + ", lambda x, i: "
    "CASE WHEN i % 2 = 1 THEN CAST(x AS INTEGER) WHEN CAST(x AS INTEGER) > 4 THEN 2 * CAST(x AS INTEGER) - 9 ELSE 2 * CAST(x AS INTEGER) END)) % 10 = 0)")
VERHOEFF_SQL = (
    "(regexp_matches({n}, '^[0-9 -]*[0-9][0-9 -]*$') AND list_reduce(list_prepend(0, list_transform(" + _PLACES_SQL + ", lambda x, i: "
    f"{PERMUTATION}[((i - 1) % 8) * 10 + CAST(x AS INTEGER) + 1])), lambda a, x: {DIHEDRAL}[a * 10 + x + 1]) = 0)")
