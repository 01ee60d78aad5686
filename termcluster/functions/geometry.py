"""Column expressions for 2-D integer points and their centres.

Centres are few (``kernels``) and live on the driver between k-means
steps, so they enter the plan as one literal array value: nothing is
broadcast or joined per step, and the plan of a step does not grow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termcluster.functions.dictionary import literal_strings


def squared_distance(x: Column, y: Column, cx, cy) -> Column:
    """(x - cx)^2 + (y - cy)^2 in double precision.

    The reference calls this the Euclidean distance but takes no square
    root; we keep the squared form. Operands are cast to double before
    the subtraction so integer overflow cannot occur; for coordinates
    below 2^26 the result is exact."""
    dx = x.cast("double") - _lit_or_col(cx).cast("double")
    dy = y.cast("double") - _lit_or_col(cy).cast("double")
    return dx * dx + dy * dy


def centre_array_sql(centres: Sequence[tuple[int, int]]) -> str:
    """SQL text of the centres as one ``array<struct<x: double, y: double>>``
    literal (exact for integer coordinates below 2^53)."""
    if not centres:
        raise ValueError("no centres")
    return "array(" + ", ".join(
        f"named_struct('x', {int(cx)}D, 'y', {int(cy)}D)" for cx, cy in centres) + ")"


def centre_distances_sql(centres: Sequence[tuple[int, int]], x: str = "x", y: str = "y") -> str:
    """SQL of the array of squared distances from ``(x, y)`` to every
    centre, in centre order (``transform`` over one centre array).

    ``pow(d, 2)`` is exact here: ``d`` is a difference of integers and
    Java's ``Math.pow`` returns the exact value when both arguments are
    integers and the result is representable (below 2^53). Evaluated
    inside the lambda it is about twice as fast as ``d * d``, which
    evaluates ``d`` twice."""
    return (f"transform({centre_array_sql(centres)}, c -> "
            f"pow(double(`{x}`) - c.x, 2) + pow(double(`{y}`) - c.y, 2))")


def nearest_index_sql(distances: str) -> str:
    """SQL of the 0-based position of the smallest distance in the array
    column ``distances``; ties go to the first (lowest) index, since
    ``array_position`` returns the first element equal to the minimum.
    The minimum is one of the elements, so the equality is exact."""
    # Never null for a non-empty list; the coalesce only declares that, so
    # joins on the index do not make Catalyst add an isnotnull pre-filter
    # that would compute the distances twice.
    return f"coalesce(int(array_position(`{distances}`, array_min(`{distances}`))) - 1, -1)"


def with_nearest_centre(df: DataFrame, centres: Sequence[tuple[int, int]], x: str = "x",
                        y: str = "y", out: str = "cluster") -> DataFrame:
    """``df`` plus ``out``, the index of the centre closest to ``(x, y)`` by
    squared distance (lowest index on ties).

    The centres are one array value, so the expressions have the same
    small size for any number of centres and their code does not change
    when the centres move (a k-means loop compiles nothing per step). An
    unrolled per-centre expression is recompiled every step and outgrows
    the JVM method limit at a few dozen centres. The distances are their
    own column, computed once per row, and hold plain doubles (no struct
    per centre)."""
    tmp = "_centre_distances"
    return (df.withColumn(tmp, F.expr(centre_distances_sql(centres, x, y)))
            .withColumn(out, F.expr(nearest_index_sql(tmp)))
            .drop(tmp))


def term_index(tag: Column, terms: Sequence[str]) -> Column:
    """0-based index of ``tag`` in a short list; -1 when absent, null when the
    tag is null."""
    arr = F.array(*[F.lit(t) for t in terms])
    return (F.array_position(arr, tag) - 1).cast("int")


def text_order_code(tag: Column, terms: Sequence[str]) -> Column:
    """An integer ordered as the tag's text: odd for listed terms, even for
    the gaps between them (unlisted tags of one gap share a code); null when
    the tag is null. One comparison per term: for short lists."""
    below = sum((F.when(tag > F.lit(t), 1).otherwise(0) for t in terms), F.lit(0))
    return F.when(tag.isNotNull(), below * 2 + F.when(tag.isin(*terms), 1).otherwise(0)).cast("int")


def text_order_index(code: str, terms: Sequence[str]) -> Column:
    """The index in ``terms`` of a ``text_order_code``; null for unlisted tags."""
    by_text = sorted(range(len(terms)), key=lambda i: terms[i].encode())
    return F.when(F.col(code) % 2 == 1, F.get(F.array(*[F.lit(i) for i in by_text]), F.expr(f"int(`{code}` div 2)")))


def term_label(x: str, spread: int, terms: Sequence[str]) -> Column:
    """The term whose stratum holds column ``x``: ``terms[x div spread]``.

    An index outside the list fails the job, with ANSI on or off."""
    arr = literal_strings(terms)
    place = F.expr(f"int(`{x}` div {int(spread)}) + 1")
    outside = F.raise_error(F.concat(F.lit("no term for x = "), F.col(x).cast("string"))).cast("string")
    return F.when(place.between(1, len(terms)), F.get(arr, place - 1)).otherwise(outside)


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)
