"""Numeric scoring expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from slatework.functions.coerce import null_of

# Expected plate appearances of batting slots 1 to 9, else 4.15.
SLOT_PA = {1: 4.85, 2: 4.70, 3: 4.60, 4: 4.50, 5: 4.35, 6: 4.20, 7: 4.05, 8: 3.95, 9: 3.85}
SLOT_PA_DEFAULT = 4.15


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; null stays null (``greatest``/``least`` alone skip nulls)."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(value.isNotNull(), out)


def logistic(value: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-clip(value, -20, 20)))


def poisson_zero(rate: Column) -> Column:
    """Chance of no event when ``rate`` are expected, rate kept in 0.02..6."""
    return F.exp(-clip(rate, 0.02, 6.0))


def shrink_to_half(prob: Column, factor: float = 0.58) -> Column:
    return 0.5 + (F.coalesce(prob, F.lit(0.5)) - 0.5) * factor


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9.0 / 5.0 + 32.0


def mph(knots: Column) -> Column:
    return knots * 1.15078


def wind_sectors(degrees: Column) -> tuple[Column, Column, Column]:
    """(out, in, cross) as 1.0/0.0; all 0.0 without a direction."""
    deg = F.pmod(degrees, F.lit(360.0))
    out = (deg >= 315) | (deg <= 45)
    inward = deg.between(135, 225)

    def one(condition: Column) -> Column:
        return F.when(condition, 1.0).otherwise(0.0)

    return one(out), one(inward), one(deg.isNotNull() & ~out & ~inward)


def band(value: Column, edges: list[float], labels: list[str], include_lowest: bool = True) -> Column:
    """Label of the right-closed interval holding the value; null outside."""
    low = value >= edges[0] if include_lowest else value > edges[0]
    out = F.when(~low, null_of("string"))
    for edge, label in zip(edges[1:], labels):
        out = out.when(value <= edge, label)
    return out


def case_table(cases: list[tuple[Column, float]], default: float) -> Column:
    """First matching case wins."""
    first, *rest = cases
    out = F.when(first[0], F.lit(float(first[1])))
    for condition, result in rest:
        out = out.when(condition, F.lit(float(result)))
    return out.otherwise(F.lit(float(default)))


def expected_pa(slot: Column) -> Column:
    return case_table([(slot == s, pa) for s, pa in SLOT_PA.items()], SLOT_PA_DEFAULT)


def multiply_where(value: Column, steps: list[tuple[Column, float]]) -> Column:
    """Apply every factor whose condition holds, one after the other."""
    for condition, factor in steps:
        # A product keeps the expression flat: each step names the value once.
        value = value * F.when(condition, F.lit(float(factor))).otherwise(1.0)
    return value


def indicator(condition: Column) -> Column:
    """1.0 where true, else (false or unknown) 0.0."""
    return F.when(condition, 1.0).otherwise(0.0)


def total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def weighted_sum(columns: list[str], weights: dict[str, float]) -> Column:
    """Sum of weight x value over the columns that exist, null counting as 0."""
    terms = [
        F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * weight
        for name, weight in weights.items()
        if name in columns
    ]
    return total([F.lit(0.0), *terms])


def compare(column: str, op: str, limit: float) -> Column:
    value = F.col(column)
    return {"<=": value <= limit, "<": value < limit, "=": value == limit, ">=": value >= limit}[op]


def points(
    weights: dict[str, float] | None = None,
    shifted: list[tuple] = (),
    steps: list[tuple[str, str, float, float]] = (),
) -> Column:
    """Points of a row by three tables.

    ``weights``: column to weight. ``shifted``: (column, centre, unit, low,
    high, weight); the distance from the centre in units, kept between the
    bounds. ``steps``: (column, comparison, limit, points), given where it holds.
    """
    terms = [F.col(name) * weight for name, weight in (weights or {}).items()]
    for name, centre, unit, low, high, weight in shifted:
        terms.append(clip((F.col(name) - centre) / unit, low, high) * weight)
    terms += [indicator(compare(*step[:3])) * step[3] for step in steps]
    return total(terms) if terms else F.lit(0.0)


def tie_noise(*parts: Column) -> Column:
    """Repeatable noise below 0.001 to order equal scores."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
    return F.pmod(F.xxhash64(key), F.lit(1000)).cast("double") / 1000000.0


def pick_label(prob: Column, yes: str, no: str) -> Column:
    return F.when(prob >= 0.5, yes).otherwise(no)


def workload_cap(
    bf30: Column, bf15: Column, bf7: Column, quality: list[tuple[Column, float]]
) -> Column:
    """Batters a starter is expected to face.

    Recent workload decides (longest window first); without any, bands of a
    weighted quality score do.
    """

    def bounded(value: Column) -> Column:
        return F.least(F.greatest(F.bround(value), F.lit(18.0)), F.lit(30.0))

    score = total(
        [F.lit(0.0)] + [F.coalesce(c.cast("double"), F.lit(0.0)) * w for c, w in quality]
    )
    return (
        F.when(bf30 > 0, bounded(bf30))
        .when(bf15 > 0, bounded(bf15 + 2))
        .when(bf7 > 0, bounded(bf7 + 6))
        .when(score >= 7.5, 27)
        .when(score >= 5.5, 25)
        .when(score >= 3.5, 23)
        .when(score >= 1.5, 21)
        .otherwise(19)
        .cast("bigint")
    )
