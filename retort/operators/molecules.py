"""Molecules given as matrices: typed bonds and connected fragments, in array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The kind of a bond by its number in a matrix; the first is none.
BOND_TYPES = ("", "single", "double", "triple", "aromatic", "solid wedge", "dashed wedge")
_BOND = "struct<bond_type:string,i:int,j:int>"


def bond_number(scores: Column) -> Column:
    """The number of a bond from the scores of each: the first of the largest; 0 for none."""
    return F.when(F.size(scores) > 0, F.array_position(scores, F.array_max(scores)).cast("int") - 1).otherwise(0)


def atoms(symbols: Column, coords: Column) -> Column:
    """Array of symbol, x and y, to three digits; what either list has more of is left out."""
    both = F.slice(F.arrays_zip(symbols.alias("s"), coords.alias("c")), 1, F.least(F.size(symbols), F.size(coords)))
    return F.transform(both, lambda a: F.struct(a["s"].alias("atom_symbol"), F.round(F.get(a["c"], F.lit(0)), 3).alias("x"), F.round(F.get(a["c"], F.lit(1)), 3).alias("y")))


def bonds(n: Column, edges: Column) -> Column:
    """Array of bond_type, i and j (i < j) from the upper triangle of a matrix of bond numbers, for n atoms, in row order.

    Numbers that name no bond, and cells that a matrix lacks, are no bonds; no matrix or fewer than two atoms give none.
    """
    kinds = F.array(*[F.lit(b) for b in BOND_TYPES])
    known = lambda x: F.coalesce(x.between(1, len(BOND_TYPES) - 1), F.lit(False))

    def row(cells: Column, i: Column) -> Column:
        beyond = F.slice(F.slice(F.coalesce(cells, F.array().cast("array<int>")), 1, n), i + 2, n)
        placed = F.transform(beyond, lambda x, k: F.struct(x.alias("x"), (i + 1 + k).cast("int").alias("j")))
        return F.transform(F.filter(placed, lambda b: known(b["x"])), lambda b: F.struct(F.get(kinds, b["x"]).alias("bond_type"), i.alias("i"), b["j"].alias("j")))

    rows = F.slice(F.coalesce(edges, F.array().cast("array<array<int>>")), 1, F.greatest(n - 1, F.lit(0)))
    return F.when(n > 1, F.flatten(F.transform(rows, row))).otherwise(F.array().cast(f"array<{_BOND}>"))


def fragments(n: Column, bonds_: Column) -> Column:
    """For each of n atoms the least atom that bonds lead to from it: atoms of one fragment share it.

    One pass over the bonds: each joins the fragments of its two ends, by giving the larger number the smaller one.
    """
    alone = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def join(labels: Column, b: Column) -> Column:
        x, y = F.get(labels, b["i"]), F.get(labels, b["j"])
        return F.transform(labels, lambda v: F.when(v == F.greatest(x, y), F.least(x, y)).otherwise(v))

    return F.aggregate(F.coalesce(bonds_, F.array().cast(f"array<{_BOND}>")), alone, join)
