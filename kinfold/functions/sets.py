"""Set and vector similarities in native columns, all guarded against empty sides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def jaccard_of_sets(a: Column, b: Column) -> Column:
    """As jaccard(), of arrays without repeats: the union's size follows from the intersection's."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def overlaps(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def share(a: Column, b: Column) -> Column:
    """How much of the distinct elements of a is in b; 0 if either is empty."""
    n = F.size(F.array_distinct(a))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / n).otherwise(F.lit(0.0))


def levenshtein_norm(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(0.0))


def both_equal(a: Column, b: Column) -> Column:
    """1 if both are there and equal, whatever the case."""
    return F.coalesce((a != "") & (F.lower(a) == F.lower(b)), F.lit(False)).cast("double")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def id_list(value: Column) -> Column:
    """A comma-joined list as an array without blanks."""
    return F.filter(F.split(F.coalesce(value, F.lit("")), ","), lambda x: x != "")
