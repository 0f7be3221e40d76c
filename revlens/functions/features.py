"""Row-level feature expressions.

Every function returns a built-in ``Column`` expression, so the features stay
inside whole-stage codegen and Catalyst can prune or push them like any other
projection. Null behaviour follows the original analysis exactly (see the
notes on each function); ``tests/test_features.py`` pins it down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens import schemas


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def review_timestamp(ts_ms: str | Column = "timestamp") -> Column:
    """Epoch milliseconds -> timestamp at whole seconds (fraction truncated).

    Same value as parsing ``from_unixtime(ms / 1000)`` back, without the
    round trip through formatted text.
    """
    return F.timestamp_seconds((_col(ts_ms) / 1000).cast("long"))


def bin_label(value: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bins: first label whose upper edge the value is below.

    A NULL value compares as unknown at every edge and so falls through to the
    last label, as in the original analysis.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    v = _col(value)
    expr = F.when(v < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        expr = expr.when(v < edge, label)
    return expr.otherwise(labels[-1])


def bin_rank(label: str | Column, labels: Sequence[str]) -> Column:
    """1-based position of a label in its bin order (unknown labels last)."""
    lab = _col(label)
    expr = F.when(lab == labels[0], 1)
    for i, name in enumerate(labels[1:-1], start=2):
        expr = expr.when(lab == name, i)
    return expr.otherwise(len(labels))


def text_length_bin(length: str | Column = "review_text_length") -> Column:
    return bin_label(length, schemas.LENGTH_BIN_EDGES, schemas.LENGTH_BIN_LABELS)


def popularity_bin(rating_number: str | Column = "rating_number") -> Column:
    return bin_label(rating_number, schemas.POPULARITY_BIN_EDGES, schemas.POPULARITY_BIN_LABELS)


def received_helpful_vote(votes: str | Column = "helpful_vote") -> Column:
    """1 when votes > 0; 0 otherwise, NULL included."""
    return F.when(_col(votes) > 0, 1).otherwise(0)


def log_helpful_vote(votes: str | Column = "helpful_vote") -> Column:
    """ln(1 + votes); NULL stays NULL."""
    return F.log1p(_col(votes))


def helpful_vote_capped(votes: str | Column = "helpful_vote",
                        cap: int = schemas.HELPFUL_VOTE_CAP) -> Column:
    """``least(votes, cap)``. ``least`` skips NULL, so a NULL vote becomes the cap."""
    return F.least(_col(votes), F.lit(cap))


def flag_encoded(flag: str | Column = "verified_purchase") -> Column:
    """true -> 1, false or NULL -> 0."""
    return F.when(_col(flag), 1).otherwise(0)


def age_days(date: str | Column = "review_date",
             reference_date: str = schemas.REFERENCE_DATE) -> Column:
    """Days from the review date to the fixed reference date (may be <= 0)."""
    return F.datediff(F.lit(reference_date).cast("date"), _col(date))


def votes_per_year(votes: str | Column = "helpful_vote",
                   age: str | Column = "review_age_days") -> Column:
    """votes / (age / 365.25) for a positive age; 0 for age <= 0 or NULL age.

    A NULL vote with a positive age stays NULL.
    """
    a = _col(age)
    return (F.when(a > 0, _col(votes) / (a / F.lit(schemas.DAYS_PER_YEAR)))
            .otherwise(F.lit(0.0)))


def _dec(x: str | Column, scale: int) -> Column:
    return _col(x).cast(f"decimal({10 + scale},{scale})")


def stddev_from_sums(n: str | Column, s1: str | Column, s2: str | Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares.

    ``sqrt((n*s2 - s1^2) / (n*(n-1)))`` with the numerator in exact DECIMAL
    arithmetic; NULL for fewer than two values.
    """
    n = _col(n)
    num = n.cast("decimal(20,0)") * _col(s2) - _col(s1) * _col(s1)
    den = n.cast("double") * (n - 1).cast("double")
    return F.when(n > 1, F.sqrt(num.cast("double") / den))


def exact_stddev(x: str | Column, scale: int = 0) -> Column:
    """Sample standard deviation (aggregate) from exact moment sums.

    Count, sum and sum of squares are DECIMAL sums, so the result does not
    depend on partitioning or summation order (Spark's streaming ``stddev``
    merges partial states in task order and can differ in the last bit from
    run to run) and a constant column gives exactly 0. Values are taken to
    ``scale`` decimals: 0 for integer lengths, 3 for star ratings.
    """
    xd = _dec(x, scale)
    return stddev_from_sums(F.count(_col(x)), F.sum(xd), F.sum(xd * xd))


def moment_sums(x: str | Column, scale: int, prefix: str) -> list[Column]:
    """The three partial aggregates behind ``exact_stddev`` (count, sum, sum of squares)."""
    xd = _dec(x, scale)
    return [F.count(_col(x)).alias(f"{prefix}_n"), F.sum(xd).alias(f"{prefix}_s1"),
            F.sum(xd * xd).alias(f"{prefix}_s2")]


def ratio_percent(numerator: str | Column, denominator: str | Column, scale: int) -> Column:
    """round(numerator / denominator * 100, scale); NULL when the denominator is 0."""
    return F.round(F.try_divide(_col(numerator).cast("double"), _col(denominator)) * 100.0, scale)


def flag_count(condition: Column) -> Column:
    """Number of rows where a boolean holds (NULL counts as false)."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def null_count(c: str | Column) -> Column:
    return F.sum(_col(c).isNull().cast("long"))
