"""Column expressions shared by the operators. All are built-in Spark functions."""

from pyspark.sql import functions as F


def record(**fields):
    """A struct with named fields."""
    return F.struct(*[column.alias(name) for name, column in fields.items()])


def div_trunc(a, b):
    """Integer division that truncates toward zero."""
    return F.call_function("div", a, b)


def nearest(value, centroids):
    """The centroid closest to `value`; the smaller centroid wins a tie."""
    candidates = F.array(*[F.lit(c).cast("bigint") for c in sorted(set(centroids))])
    by_distance = F.transform(
        candidates, lambda c: F.struct(F.abs(value - c).alias("d"), c.alias("c"))
    )
    return F.array_min(by_distance)["c"]


def spread(slices, *columns):
    """Slice 0 … slices-1 of a row, decided by the given columns."""
    return F.pmod(F.xxhash64(*columns), slices).cast("int")


def spread_fixed(slices, column):
    """Like `spread`, by plain arithmetic, so that other SQL engines give the same slice."""
    # fixed values: a prime modulus and a generator of its multiplicative group
    modulus, multiplier = 2147483647, 48271
    mixed = F.pmod(F.pmod(column, F.lit(modulus)) * F.lit(multiplier), F.lit(modulus))
    return F.pmod(mixed, slices).cast("int")


def weighted_list_text(column):
    """array<struct<id,n>> as text `id:n,id:n`."""
    return F.concat_ws(
        ",",
        F.transform(column, lambda e: F.concat_ws(":", e["id"].cast("string"), e["n"].cast("string"))),
    )
