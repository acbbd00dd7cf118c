"""Label lines: tokens, numbers, boxes and polygons, error codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.schemas import CLASS_ALIASES, TOLERANCE
from labelloom.session import broadcast_if_small

# white space as text splitting in Python sees it; the grammar of a float there, ASCII digits only
SPACES = "[\\s\\x1c-\\x1f\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
# (plain decimals, the most of them, are tried first)
NUMBER = "^(?:\\d++(?:\\.\\d*+)?+$|[+-]?((\\d+(_\\d+)*\\.?(\\d+(_\\d+)*)?|\\.\\d+(_\\d+)*)([eE][+-]?\\d+(_\\d+)*)?|(?i:inf|infinity|nan))$)"
LINE_BREAKS = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"

MESSAGES = {
    "not_a_number": "holds a value that is not a number",
    "class_not_integer": "class id is not an integer",
    "bad_coordinates": "coordinates missing or not finite",
    "out_of_range": "coordinates outside [0, 1]",
    "bad_shape": "needs a box or a polygon of three points or more",
    "no_size": "width and height must be positive",
    "outside": "box lies outside the image",
}


def canonical_class(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """The class a raw name stands for, or null."""
    key = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))
    pairs = [F.lit(x) for kv in (aliases or CLASS_ALIASES).items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def class_map(spark: SparkSession, names: dict[str, list[str]], targets: list[str], aliases: dict[str, str] | None = None) -> DataFrame:
    """(source, old_id, class_id) of the known names of each source's class list."""
    rows = [(s, float(i), n) for s, listed in names.items() for i, n in enumerate(listed)]
    df = spark.createDataFrame(rows, "source string, old_id double, name string")
    target = F.array_position(F.array(*[F.lit(t) for t in targets]), canonical_class(F.col("name"), aliases))
    return df.select("source", "old_id", (target - 1).cast("int").alias("class_id")).filter("class_id >= 0")


def split_lines(text: Column) -> Column:
    """The lines of a label file; a break at the end starts no further line."""
    return F.split(F.regexp_replace(text, f"({LINE_BREAKS})$", ""), LINE_BREAKS)


def close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(1e-9) * F.greatest(F.abs(a), F.abs(b))


def finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != float("inf"))


def computed(df: DataFrame, kept: list[str], values: dict[str, Column]) -> DataFrame:
    """``kept`` and ``values``. A generator gives them, into which no filter or projection of later steps is merged: those
    would work out the whole chain again for each of its uses."""
    return df.select(*kept, F.inline(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))))


def parse_labels(lines: DataFrame, classes: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``lines`` with class_id, x, y, w, h, source_type, error_code, out_of_scope.

    A valid line has a class and a box; a wrong one an error_code; a blank line and one of a class outside
    ``classes`` neither. Parsing is plain column expressions over each line; ``classes`` (the sources' class
    lists) is broadcast if it is small.
    """
    kept = lines.columns
    number = lambda t: F.when(t.rlike(NUMBER), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))
    # white space at the ends makes empty tokens, a line of nothing else a single one
    tokens = F.filter(F.split(F.coalesce("line", F.lit("")), SPACES), lambda t: t != "")
    df = computed(lines, kept, {"__v": F.transform(tokens, number)})
    df = computed(df, [*kept, "__v"], {"__raw": F.get("__v", F.lit(0)), "__n": F.greatest(F.size("__v") - 1, F.lit(0))})
    box, poly = F.col("__n") == 4, (F.col("__n") >= 6) & (F.col("__n") % 2 == 0)
    xs, ys = F.filter("__v", lambda v, i: (i > 0) & (i % 2 == 1)), F.filter("__v", lambda v, i: (i > 0) & (i % 2 == 0))
    clip = lambda v: F.least(F.lit(1.0), F.greatest(F.lit(0.0), v))
    at = lambda i: clip(F.get("__v", F.lit(i + 1)))
    beyond = lambda wrong: F.exists(F.transform("__v", lambda v, i: (i > 0) & wrong(v)), lambda x: x)
    whole = finite(F.col("__raw")) & (F.col("__raw") == F.floor("__raw").cast("double"))
    values = {
        "__int": F.coalesce(whole, F.lit(False)),
        "__bad": F.exists("__v", lambda v: v.isNull()),
        "__infinite": beyond(lambda v: ~finite(v)),
        "__beyond": beyond(lambda v: (v < -tolerance) | (v > 1 + tolerance)),
        "__empty": F.size("__v") == 0,
        # for a box its centre and size, for a polygon its least and greatest coordinates
        **{f"__{k}": F.when(box, at(i)).when(poly, clip(f(c))) for i, (k, f, c) in enumerate((("p", F.array_min, xs), ("q", F.array_min, ys), ("r", F.array_max, xs), ("u", F.array_max, ys)))},
    }
    df = computed(df, [*kept, "__raw", "__n"], values)
    known = broadcast_if_small(classes.select(F.col("source").alias("__s"), F.col("old_id").alias("__o"), F.col("class_id").alias("__c")))
    df = df.join(known, F.col("source").eqNullSafe(F.col("__s")) & (F.when(F.col("__int"), F.col("__raw")) == F.col("__o")), "left")
    for c, d, low, high in (("__x", "__w", "__p", "__r"), ("__y", "__h", "__q", "__u")):
        df = df.withColumn(c, F.when(box, F.col(low)).when(poly, (F.col(low) + F.col(high)) / 2)).withColumn(d, F.when(box, F.col(high)).when(poly, F.col(high) - F.col(low)))
    for a, s in (("x", "w"), ("y", "h")):
        df = df.withColumn(f"__{a}0", F.greatest(F.lit(0.0), F.col(f"__{a}") - F.col(f"__{s}") / 2))
        df = df.withColumn(f"__{a}1", F.least(F.lit(1.0), F.col(f"__{a}") + F.col(f"__{s}") / 2))
    error = (
        F.when(F.col("__empty"), None)
        .when(F.col("__bad"), "not_a_number")
        .when(~F.col("__int"), "class_not_integer")
        .when(F.col("__c").isNull(), None)
        .when((F.col("__n") == 0) | F.col("__infinite"), "bad_coordinates")
        .when(F.col("__beyond"), "out_of_range")
        .when(~box & ~poly, "bad_shape")
        .when((F.col("__w") <= 0) | (F.col("__h") <= 0), "no_size")
        .when((F.col("__x1") <= F.col("__x0")) | (F.col("__y1") <= F.col("__y0")), "outside")
    )
    df = df.withColumn("error_code", error)
    good = F.col("error_code").isNull() & F.col("__c").isNotNull() & ~F.col("__bad")
    x, y = (F.col("__x0") + F.col("__x1")) / 2, (F.col("__y0") + F.col("__y1")) / 2
    w, h = F.col("__x1") - F.col("__x0"), F.col("__y1") - F.col("__y0")
    same = close(x, F.col("__x")) & close(y, F.col("__y")) & close(w, F.col("__w")) & close(h, F.col("__h"))
    kind = F.concat(F.when(box, "bbox").otherwise("polygon_to_bbox"), F.when(same, "").otherwise("_clipped"))
    return df.select(
        *kept,
        F.when(good, F.col("__c")).alias("class_id"),
        *[F.when(good, v).alias(k) for k, v in (("x", x), ("y", y), ("w", w), ("h", h), ("source_type", kind))],
        "error_code",
        (F.col("__int") & F.col("__c").isNull()).alias("out_of_scope"),
    )


def error_message(place: Column, line_no: Column, code: Column) -> Column:
    """``place:line: reason``."""
    pairs = [F.lit(x) for kv in MESSAGES.items() for x in kv]
    return F.format_string("%s:%d: %s", place, line_no, F.try_element_at(F.create_map(*pairs), code))


def micro(v: Column) -> Column:
    """A value in millionths, half up: the key under which boxes are equal."""
    return F.floor(v * F.lit(1e6) + F.lit(0.5)).cast("long")


def dedup_boxes(parsed: DataFrame, keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Valid boxes once per file: the position of the first line, the values of the last."""
    cell = [F.col("class_id"), *[micro(F.col(c)).alias(f"__{c}") for c in ("x", "y", "w", "h")]]
    boxes = parsed.filter("class_id IS NOT NULL")
    # combined before a shuffle; lines that are dealt by file already need none
    last = F.max(F.struct("line_no", "x", "y", "w", "h", "source_type")).alias("__last")
    out = boxes.groupBy(*keys, *cell).agg(F.min("line_no").alias("position"), last)
    return out.select(*keys, "position", "class_id", *[F.col(f"__last.{c}").alias(c) for c in ("x", "y", "w", "h", "source_type")])


def label_text(class_id: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    """A clean label line: class and box to six decimals."""
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id, x, y, w, h)

