"""Running values over long documents: within cells first, then over what the cells hand on.

A window over a document puts the whole document into one task.  Here a document is cut into cells by place; rows are
scanned within a cell, each cell hands on one row, those rows are scanned per document, and every
cell adds what comes before it.  So a document of any share of all rows is spread over tasks, and the
window over the document sees a row per cell.  Inputs are written once, since both scans read them.  Keys are not null.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.functions.durable import durable

# Characters, or tokens of one sentence, that a cell covers.
CELL_BITS = 16
TOKEN_CELL_BITS = 14


def in_cells(df: DataFrame, at: str, bits: int) -> DataFrame:
    cell = F.coalesce(F.shiftright(F.col(at), bits).cast("bigint"), F.lit(-1).cast("bigint"))
    return durable(df.withColumn("_cell", cell), "cells")


def _until(keys, order, last=W.currentRow):
    return W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, last)


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def numbered(df: DataFrame, name: str, keys=("doc_id",), at: str = "start", order=("start", "end"),
             bits: int = CELL_BITS, total: str | None = None) -> DataFrame:
    """Add ``name``: rows counted from 1 through each of ``keys``, and ``total``, how many there are.

    ``at`` is the first column of ``order``.
    """
    cells, keys = in_cells(df, at, bits), list(keys)
    key = [*keys, "_cell"]
    sizes = cells.groupBy(*key).agg(F.count("*").alias("_n"))
    sizes = sizes.withColumn("_ahead", _zero(F.sum("_n").over(_until(keys, ["_cell"], -1))))
    if total is not None:
        sizes = sizes.withColumn(total, F.sum("_n").over(W.partitionBy(*keys)))
    local = cells.withColumn(name, F.row_number().over(W.partitionBy(*key).orderBy(*order)))
    extra = [total] if total is not None else []
    return local.join(sizes.drop("_n"), key).withColumn(name, (F.col(name) + F.col("_ahead")).cast("bigint")).select(
        *[c for c in df.columns if c != name], name, *extra)


def in_parts(df: DataFrame, keys: list[str], order: list[str], items: int) -> DataFrame:
    """Add ``part``, from 0: the rows of each of ``keys`` in ``order``, ``items`` of them to a part.

    Rows with a null in a key are left out.  Most keys have no more than ``items`` rows and so one part: those rows are written
    once and counted, and need no order here.  Rows of larger keys are sorted by ranges of key and order, so a key of any
    share of all rows spreads over tasks.  A row's rank is its place within the key's stretch of its task, and what earlier
    tasks hold of the key.  So a list that is put together by key and part has a bounded length, and the parts one after the
    other are the whole list.
    """
    for name in keys:
        df = df.where(F.col(name).isNotNull())
    held = durable(df, "parts")
    large = durable(held.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > items).select(*keys), "large-keys")
    single = F.lit(0).cast("bigint").alias("part")
    if large.isEmpty():
        return held.select(*df.columns, single)
    few = held.join(large, keys, "left_anti").select(*df.columns, single)
    return few.unionByName(_ranked_parts(held.join(large, keys, "left_semi").select(*df.columns), keys, order, items))


def _ranked_parts(df: DataFrame, keys: list[str], order: list[str], items: int) -> DataFrame:
    whole = [*keys, *order]
    placed = df.repartitionByRange(*whole).sortWithinPartitions(*whole).withColumn("_slot", F.monotonically_increasing_id())
    # The counts and the rows must come from one and the same sort.
    placed = durable(placed.withColumn("_task", F.shiftright("_slot", 33)), "ranked")
    key = [*keys, "_task"]
    sizes = placed.groupBy(*key).agg(F.count("*").alias("_n"), F.min("_slot").alias("_first"))
    sizes = sizes.withColumn("_ahead", _zero(F.sum("_n").over(_until(keys, ["_task"], -1))))
    rank = F.col("_ahead") + F.col("_slot") - F.col("_first")
    return placed.join(sizes.drop("_n"), key).withColumn("part", F.floor(rank / F.lit(items)).cast("bigint")).select(
        *df.columns, "part")


def counted_on(df: DataFrame, column: str, name: str, keys=("doc_id",), at: str = "start", order=("start", "end"),
               bits: int = CELL_BITS) -> DataFrame:
    """Add ``name``: ``column``, and where it is null the last number before plus the rows since, from 1 on."""
    cells, keys = in_cells(df, at, bits), list(keys)
    key = [*keys, "_cell"]
    # Rows of a cell that follow the same number, or none, are a stretch.
    seen = cells.withColumn("_seen", F.count(column).over(_until(key, order)))
    gap = F.col(column).isNull()
    stretches = seen.groupBy(*key, "_seen").agg(F.max(column).alias("_value"), F.count_if(gap).alias("_gaps"))
    ends = stretches.groupBy(*key).agg(F.max("_seen").alias("_last"), F.max_by("_value", "_seen").alias("_value"),
                                       F.max_by("_gaps", "_seen").alias("_gaps"))
    # Cells without a number lengthen the stretch of the last one that has some.
    ends = ends.withColumn("_group", F.sum((F.col("_last") > 0).cast("int")).over(_until(keys, ["_cell"])))
    ends = ends.withColumn("_value", F.last("_value", ignorenulls=True).over(_until(keys, ["_cell"])))
    ends = ends.withColumn("_gaps", F.sum("_gaps").over(_until([*keys, "_group"], ["_cell"])))
    turn = W.partitionBy(*keys).orderBy("_cell")
    before = (_zero(F.lag("_value").over(turn)) + _zero(F.lag("_gaps").over(turn))).alias("_before")
    inside = F.sum(gap.cast("int")).over(_until([*key, "_seen"], order))
    own = F.last(column, ignorenulls=True).over(_until(key, order))
    local = seen.withColumn("_inside", inside).withColumn("_own", own)
    return (local.join(ends.select(*key, before), key)
            .withColumn(name, (F.coalesce("_own", "_before") + F.col("_inside")).cast("bigint"))
            .select(*[c for c in df.columns if c != name], name))


def runs(df: DataFrame, column: str, keys, at: str, bits: int = TOKEN_CELL_BITS) -> DataFrame:
    """Add ``_run``, the number of the run of equal values of ``column`` a row is in, and ``_last``, the largest ``at`` of its key."""
    cells, keys = in_cells(df, at, bits), list(keys)
    wide = durable(cells.where("_cell <> 0").select(*keys).distinct(), "wide-keys")
    if wide.isEmpty():
        return _runs_of_one_cell(cells, column, keys, at).select(*df.columns, "_run", "_last")
    few = _runs_of_one_cell(cells.join(wide, keys, "left_anti"), column, keys, at)
    many = _runs_of_cells(cells.join(wide, keys, "left_semi").select(*df.columns, "_cell"), column, keys, at)
    return few.select(*df.columns, "_run", "_last").unionByName(many.select(*df.columns, "_run", "_last"))


def _changed(column: str, at: str, order) -> Column:
    # The first row has nobody before it here.
    return F.lag(at).over(order).isNotNull() & ~F.col(column).eqNullSafe(F.lag(column).over(order))


def _runs_of_one_cell(df: DataFrame, column: str, keys: list[str], at: str) -> DataFrame:
    """The same for keys that lie in the first cell: one shuffle and one sort do."""
    for name in keys:
        df = df.where(F.col(name).isNotNull())
    new = df.withColumn("_new", _changed(column, at, W.partitionBy(*keys).orderBy(at)).cast("int"))
    return new.withColumn("_run", F.sum("_new").over(_until(keys, [at]))).withColumn(
        "_last", F.max(at).over(W.partitionBy(*keys)))


def _runs_of_cells(cells: DataFrame, column: str, keys: list[str], at: str) -> DataFrame:
    key = [*keys, "_cell"]
    local = cells.withColumn("_new", _changed(column, at, W.partitionBy(*key).orderBy(at)).cast("int")).withColumn("_own", F.sum("_new").over(_until(key, [at])))
    ends = cells.groupBy(*key).agg(F.min(F.struct(at, column)).alias("_a"), F.max(F.struct(at, column)).alias("_z"))
    turn = W.partitionBy(*keys).orderBy("_cell")
    fresh = F.lag("_z").over(turn).isNull() | ~F.col(f"_a.{column}").eqNullSafe(F.lag(f"_z.{column}").over(turn))
    changes = local.groupBy(*key).agg(F.sum("_new").alias("_changes"))
    ends = ends.join(changes, key).withColumn("_fresh", fresh.cast("int"))
    ends = ends.withColumn("_ahead", F.sum("_fresh").over(_until(keys, ["_cell"])) + _zero(F.sum("_changes").over(_until(keys, ["_cell"], -1))))
    ends = ends.withColumn("_last", F.max(f"_z.{at}").over(W.partitionBy(*keys)))
    return local.join(ends.select(*key, "_ahead", "_last"), key).withColumn("_run", F.col("_ahead") + F.col("_own"))
