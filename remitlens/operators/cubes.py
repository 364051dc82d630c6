"""Totals and distinct counts over many grouping sets at once."""

from __future__ import annotations

from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_sets(dims: list[str]) -> list[tuple[str, ...]]:
    """The grouping sets of a cube."""
    return [*chain.from_iterable(combinations(dims, n) for n in range(len(dims) + 1))]


def grouped(rows: DataFrame, dims: list[str], key: str, sums: dict[str, Column], sets: list[tuple[str, ...]] | None = None) -> DataFrame:
    """``rows_n``, ``distinct_n`` (distinct values of ``key``) and the ``sums`` by each grouping set (all by default).

    ``grouping_id`` has a bit for each dimension that is summed over, the first one's highest; such columns are null.

    Rows fold once, by key and dimensions; then all that a key has is a short array, bounded by the combinations of the
    dimensions' values, and each grouping set takes its distinct entries. So no raw row is repeated for the sets, and a
    key that holds most rows folds before the shuffle. Rows without a key count as rows and not as distinct.
    """
    sets = all_sets(dims) if sets is None else sets
    finest = rows.groupBy(key, *dims).agg(F.count(F.lit(1)).alias("rows_n"), *[v.alias(n) for n, v in sums.items()])
    named = finest.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(*dims, "rows_n", *sums)).alias("cells"))
    # Without a key nothing is distinct, so nothing needs to be gathered.
    unnamed = finest.where(F.col(key).isNull()).select(F.array(F.struct(*dims, "rows_n", *sums)).alias("cells"), F.lit(False).alias("named"))
    held = named.select("cells", F.lit(True).alias("named")).unionAll(unnamed)

    def of_set(wanted: tuple[str, ...]) -> Column:
        number = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in wanted)
        types = {d: finest.schema[d].dataType for d in dims}

        def place(cell: Column) -> Column:
            return F.struct(*[(cell[d] if d in wanted else F.lit(None).cast(types[d])).alias(d) for d in dims])

        places = F.transform("cells", place)
        # The first cell of a place stands for the key.
        first = lambda cell, i: (F.array_position(places, place(cell)) == i + 1).cast("long")
        return F.transform(
            "cells",
            lambda cell, i: F.struct(
                F.lit(number).alias("grouping_id"), *[place(cell)[d].alias(d) for d in dims], cell["rows_n"].alias("rows_n"),
                F.when(F.col("named"), first(cell, i)).otherwise(0).alias("distinct_n"), *[cell[n].alias(n) for n in sums],
            ),
        )

    cells = held.select(F.inline(F.concat(*[of_set(s) for s in sets])))
    return cells.groupBy("grouping_id", *dims).agg(
        F.sum("rows_n").alias("rows_n"), F.sum("distinct_n").alias("distinct_n"), *[F.sum(n).alias(n) for n in sums]
    )
