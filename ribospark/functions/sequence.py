"""Sequence expressions. Counts are of non-overlapping occurrences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_of(s: Column, part: str) -> Column:
    """Non-overlapping occurrences of part in s."""
    return ((F.length(s) - F.length(F.replace(s, F.lit(part), F.lit("")))) / len(part)).cast("long")


def revcomp(s: Column) -> Column:
    """Reverse complement as DNA; U counts as T, case is kept, other letters stay."""
    return F.reverse(F.translate(s, "ACGTUNacgtun", "TGCAANtgcaan"))


def to_rna(s: Column) -> Column:
    return F.translate(F.upper(F.trim(s)), "T", "U")


def to_dna(s: Column) -> Column:
    return F.translate(F.upper(F.trim(s)), "U", "T")


def length1(s: Column) -> Column:
    """Length, at least 1: the divisor of shares."""
    return F.greatest(F.length(s), F.lit(1))


def gc_fraction(s: Column) -> Column:
    u = F.upper(s)
    return (count_of(u, "G") + count_of(u, "C")) / length1(s)


def kmers(s: Column, k: int) -> Column:
    """Distinct k-mers; none where s is shorter."""
    at = F.sequence(F.lit(1), F.greatest(F.length(s) - (k - 1), F.lit(1)))
    return F.when(F.length(s) >= k, F.array_distinct(F.transform(at, lambda i: F.substring(s, i, F.lit(k))))).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def low_complexity(s: Column) -> Column:
    """Empty, at most two distinct letters, or one letter with at least 0.8 of all."""
    d = to_dna(s)
    letters = F.array_remove(F.split(d, ""), "")
    most = F.array_max(F.transform(F.array_distinct(letters), lambda c: F.length(d) - F.length(F.replace(d, c, F.lit("")))))
    return (F.length(d) == 0) | (F.size(F.array_distinct(letters)) <= 2) | F.coalesce(most / F.length(d) >= 0.8, F.lit(False))


def end_stability(s: Column) -> Column:
    """First four bases: G or C 3, A or U 1, others 2."""
    four = F.substring(F.upper(s), 1, 4)
    gc = count_of(four, "G") + count_of(four, "C")
    au = count_of(four, "A") + count_of(four, "U") + count_of(four, "T")
    return 3 * gc + au + 2 * (F.length(four) - gc - au)


def windows(s: Column, width: int, step: int) -> Column:
    """Starts (0-based) of windows, the last one anchored at the end; one window if s is not longer."""
    n = F.length(s)
    grid = F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)), F.lit(step))
    tail = F.when((n > width) & ((n - width) % step != 0), F.array(n - width)).otherwise(F.array().cast("array<int>"))
    return F.concat(grid, tail)


def mono_shuffle(s: Column, seed: int = 42) -> Column:
    """Letters in an order given by a hash of their place and seed: the same for every run."""
    marked = F.transform(F.array_remove(F.split(s, ""), ""), lambda c, i: F.struct(F.xxhash64(s, i, F.lit(seed)).alias("k"), c.alias("c")))
    return F.array_join(F.transform(F.array_sort(marked), lambda x: x["c"]), "")
