"""Box algebra on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORNERS = ("x1", "y1", "x2", "y2")


def corners(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    """Pixel corners x1, y1, x2, y2 of a normalised centre box."""
    return [(x - w / 2) * width, (y - h / 2) * height, (x + w / 2) * width, (y + h / 2) * height]


def area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(F.lit(0.0), x2 - x1) * F.greatest(F.lit(0.0), y2 - y1)


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two corner boxes; 0 where the union is empty."""
    inter = area(F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3]))
    union = area(*a) + area(*b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def size_class(box: list[Column], width: Column, height: Column) -> Column:
    """small, medium or large by the share of the image; medium where the image has no size."""
    share = area(*box) / (width * height)
    return F.when((width <= 0) | (height <= 0), "medium").when(share < 0.05, "small").when(share <= 0.20, "medium").otherwise("large")


def bool_text(value: Column) -> Column:
    """true/1/yes and false/0/no, in any case; anything else is an error."""
    v = F.lower(F.trim(value.cast("string")))
    return F.when(v.isin("true", "1", "yes"), True).when(v.isin("false", "0", "no"), False).otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(v, F.lit("null")))).cast("boolean"))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes."""
    return F.bit_count(a.bitwiseXOR(b))


def hex_hash(text: Column) -> Column:
    """A 16-digit hexadecimal hash as a signed long."""
    return F.conv(text, 16, -10).cast("long")


def median_bits(vector: Column) -> Column:
    """Signature of a vector of up to 64 numbers: one bit for each value above the median."""
    sorted_values = F.array_sort(F.transform(vector, lambda v: v.cast("double")))
    n = F.size(vector)
    median = F.get(F.transform(F.array(sorted_values), lambda s: (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2), F.lit(0))
    bits = lambda m: F.aggregate(vector, F.lit(0).cast("long"), lambda acc, v: F.shiftleft(acc, 1).bitwiseOR(F.when(v.cast("double") > m, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))))
    # the sort runs once for a vector, not once for each of its numbers
    return F.get(F.transform(F.array(median), bits), F.lit(0))
