"""Array helpers that keep per-document work inside one row (no shuffle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_starts(arr: Column, key: Callable[[Column], Column]) -> Column:
    """1-based indexes at which a new key begins in an array sorted by that key."""
    return F.filter(
        F.sequence(F.lit(1), F.size(arr)),
        lambda i: (i == 1) | (key(F.element_at(arr, i)) != key(F.element_at(arr, F.greatest(i - 1, F.lit(1))))),
    )


def first_per_key(arr: Column, key: Callable[[Column], Column]) -> Column:
    """Keep the first element of every key, in array order; n log n, not n squared."""
    tagged = F.sort_array(F.transform(arr, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))))
    return let(
        tagged,
        lambda a: F.when(
            F.size(a) > 0,
            F.transform(
                F.sort_array(
                    F.transform(
                        run_starts(a, lambda e: e["k"]),
                        lambda s: F.struct(F.element_at(a, s)["i"].alias("i"), F.element_at(a, s)["x"].alias("x")),
                    )
                ),
                lambda e: e["x"],
            ),
        ).otherwise(F.transform(a, lambda e: e["x"])),
    )


BLOCK = 16


def prefix_sums(lengths: Column, levels: int = 2) -> Column:
    """Exclusive running sums of an int array.

    A sum is the start of its block plus the few elements before it; the block
    starts are found the same way. A text of n words costs about n * BLOCK / 2
    steps, and not n squared.
    """

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda acc, x: acc + x)

    def block_of(i: Column) -> Column:
        return F.shiftright(i, BLOCK.bit_length() - 1)

    def with_blocks(ls: Column) -> Column:
        if levels == 0:
            return F.transform(ls, lambda _x, i: total(F.slice(ls, F.lit(1), i)))
        blocks = F.transform(F.sequence(F.lit(0), block_of(F.size(ls) - 1)), lambda b: total(F.slice(ls, b * BLOCK + 1, F.lit(BLOCK))))
        return let(
            prefix_sums(blocks, levels - 1),
            lambda starts: F.transform(
                ls, lambda _x, i: F.get(starts, block_of(i)) + total(F.slice(ls, block_of(i) * BLOCK + 1, i % BLOCK))
            ),
        )

    return let(lengths, lambda ls: F.when(F.size(ls) > 0, with_blocks(ls)).otherwise(ls))
