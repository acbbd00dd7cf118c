"""Sharding by a Hilbert curve over document metadata. DataFrame and SQL functions only.

Three metadata dimensions (source, language, size) are quantised to four bits each: texts (source, language) by
sixteenths of the rows in the order of their values, numbers (size) by powers of two, so neighbouring codes are
neighbouring values. Their cell on a three-dimensional Hilbert curve orders the rows, and the ordered rows are cut into
runs of equal length: a shard covers a compact box of metadata values. ``write_shards`` writes them with the least and
greatest value of each dimension, and ``read_shards`` skips the shards that a filter rules out on any dimension.

The global position of a row comes from counts, not from one sorted partition: rows of a curve cell are
dealt over ``subs`` hash sub-cells, a window ranks the rows inside each sub-cell, and running sums over the
sub-cells of a cell and over the (at most 4,096) cells give the offsets. A cell that holds a third of all
rows is spread over its sub-cells.

Cases: null text counts as empty (size 1, crc 0); null source, language or id is a value of its own; equal
rows get different slots; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelloom.operators.ranks import dealt_ranges, running_sums
from labelloom.session import table, written

BITS, LAW = 4, "rows"

# Fixed values of the three-dimensional curve: inverse Gray code, entry point and direction of each of the
# eight sub-cubes in curve order.
GRAY_INVERSE = (0, 1, 3, 2, 7, 6, 4, 5)
ENTRY = (0, 0, 0, 3, 3, 6, 6, 5)
DIRECTION = (0, 1, 1, 2, 2, 1, 1, 0)


def hilbert_index(x: Column, y: Column, z: Column, bits: int = BITS) -> Column:
    """Place of the cell (x, y, z), each of ``bits`` bits, on the Hilbert curve."""
    levels = F.array(*[(F.shiftright(z, i).bitwiseAND(1) * 4 + F.shiftright(y, i).bitwiseAND(1) * 2 + F.shiftright(x, i).bitwiseAND(1)).cast("int") for i in range(bits - 1, -1, -1)])

    def step(s: Column, level: Column) -> Column:
        # w: curve order of the sub-cube; then the entry point and direction inside it
        g = _turn_right(s["e"].bitwiseXOR(level), s["d"] + 1)
        return F.struct(_lookup(GRAY_INVERSE, g).alias("w"), s["h"].alias("h"), s["e"].alias("e"), s["d"].alias("d"))

    def enter(s: Column) -> Column:
        return F.struct(
            s["w"].alias("w"),
            (s["h"] * 8 + s["w"]).alias("h"),
            s["e"].bitwiseXOR(_turn_right(_lookup(ENTRY, s["w"]), F.lit(2) - s["d"])).cast("int").alias("e"),
            ((s["d"] + _lookup(DIRECTION, s["w"]) + 1) % 3).cast("int").alias("d"),
        )

    zero = F.struct(F.lit(0).alias("w"), F.lit(0).alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(levels, zero, lambda s, level: F.get(F.transform(F.array(step(s, level)), enter), F.lit(0)))["h"]


def _lookup(values: tuple[int, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def _turn_right(x: Column, by: Column) -> Column:
    one = F.shiftright(x, 1) + (x % 2) * 4
    two = F.shiftright(x, 2) + (x % 4) * 2
    return F.when(by == 1, one).when(by == 2, two).otherwise(x).cast("int")


def hilbert_shards(docs: DataFrame, dims: dict[str, Column], shards: int = 16, subs: int = 256, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows of ``docs`` with ``cell``, ``position``, ``shard`` and ``slot``.

    dims: three columns of integers from 0 to 15. keep: columns of ``docs`` to return; they order the rows
    inside a sub-cell. Shard sizes differ by at most one row; slots count from 0 in curve order.
    """
    names = list(dims)
    rows = docs.select(*keep, *[dims[n].cast("int").alias(f"__q{i}") for i, n in enumerate(names)])
    rows = rows.select(*keep, hilbert_index(F.col("__q0"), F.col("__q1"), F.col("__q2")).alias("cell"))
    rows = rows.withColumn("__sub", F.pmod(F.xxhash64(*keep), F.lit(subs)).cast("int"))
    sizes = rows.groupBy("cell", "__sub").agg(F.count(F.lit(1)).alias("__n"))
    inner = sizes.withColumn("__before", F.sum("__n").over(W.partitionBy("cell").orderBy("__sub")) - F.col("__n"))
    cells = sizes.groupBy("cell").agg(F.sum("__n").alias("__cn"))
    # at most 8 ** BITS rows: one task may order them
    running = W.orderBy("cell")
    cells = cells.select("cell", (F.sum("__cn").over(running) - F.col("__cn")).alias("__start"))
    total = F.broadcast(sizes.agg(F.sum("__n").alias("__total")))
    offsets = inner.join(cells, "cell").crossJoin(total).select("cell", "__sub", (F.col("__before") + F.col("__start")).alias("__offset"), "__total")
    ranked = rows.withColumn("__rank", F.row_number().over(W.partitionBy("cell", "__sub").orderBy(*keep)) - 1)
    out = ranked.join(offsets, ["cell", "__sub"]).withColumn("position", F.col("__rank") + F.col("__offset"))
    shard = F.expr(f"CAST((position * {shards}) DIV __total AS INT)")
    out = out.withColumn("shard", shard)
    first = F.expr(f"(shard * __total + {shards - 1}) DIV {shards}")
    return out.select(*keep, "cell", "position", "shard", (F.col("position") - first).cast("long").alias("slot"))


def quantile_cuts(docs: DataFrame, col: str, codes: int = 16) -> list:
    """At most ``codes`` - 1 values of ``col`` that cut the rows into parts as equal as whole values allow."""
    counts = written(docs.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    placed = running_sums(dealt_ranges(counts, "value"), (), ("value",), {"before": F.col("n")})
    total = counts.agg(F.sum("n").alias("total"))
    # the middle of a value's rows decides
    code = F.expr(f"CAST(({codes} * (2 * before + n)) DIV (2 * total) AS INT)")
    parts = placed.crossJoin(F.broadcast(total)).groupBy(code.alias("code")).agg(F.min("value").alias("first"))
    # a row for each code
    return [r["first"] for r in parts.orderBy("code").collect()][1:]


def code_of(value: Column, cuts: list) -> Column:
    """How many of the ``cuts`` a value has reached; null has reached none."""
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value)), F.lit(0)) if cuts else F.lit(0)


def document_dims(docs: DataFrame) -> dict[str, Column]:
    """Source and language by sixteenths of the rows, text size by power of two."""
    return {
        "source": code_of(F.col("source"), quantile_cuts(docs, "source")),
        "lang": code_of(F.col("lang"), quantile_cuts(docs, "lang")),
        "size": F.least(F.lit(15), F.floor(F.log2(F.col("size").cast("double")))),
    }


def write_shards(sharded: DataFrame, path: str, dims: tuple[str, ...] = ("source", "lang", "size")) -> None:
    """Write rows with ``shard``, ``slot`` and the columns ``dims``: a folder for each shard under ``path``/rows, and
    per shard the number of rows and the least and greatest value of each dimension under ``path``/ranges."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(f"{path}/rows")
    back = sharded.sparkSession.read.schema(sharded.schema).parquet(f"{path}/rows")
    ends = [f(c).alias(f"{name}_{c}") for c in dims for name, f in (("least", F.min), ("most", F.max))]
    nulls = [F.bool_or(F.col(c).isNull()).alias(f"null_{c}") for c in dims]
    back.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends, *nulls).coalesce(1).write.parquet(f"{path}/ranges")


def shards_left(spark: SparkSession, path: str, **wanted: tuple) -> list[int]:
    """The shards whose ranges meet what is ``wanted``: by dimension, a least and a greatest value."""
    ranges = spark.read.parquet(f"{path}/ranges")
    for c, (low, high) in wanted.items():
        ranges = ranges.filter((F.col(f"least_{c}") <= F.lit(high)) & (F.col(f"most_{c}") >= F.lit(low)))
    # a number for each shard
    return sorted(r["shard"] for r in ranges.select("shard").collect())


def read_shards(spark: SparkSession, path: str, **wanted: tuple) -> DataFrame:
    """The rows whose dimensions lie between the two values ``wanted`` of each (inclusive). Shards that can't hold any
    are other partitions, which the scan doesn't open."""
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("shard").isin(shards_left(spark, path, **wanted)))
    for c, (low, high) in wanted.items():
        rows = rows.filter(F.col(c).between(low, high))
    return rows


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = hilbert_shards(docs, document_dims(docs), keep=("doc_id", "text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("cell").alias("curve_cell"))


QUERIES = {"op9_hilbert_shards": op9_hilbert_shards}
ORACLE: dict[str, str] = {}
