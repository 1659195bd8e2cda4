"""Joins and orderings of spans.

Range joins match on the document and on a cell of the text, so a long document
is shared out over many tasks and a span meets only spans near to it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.scans import numbered

# Cells of 2**8 characters for joins, of 2**12 for pieces of text.
CELL_BITS = 8
TEXT_CELL_BITS = 12


def _cell(position: str | Column, bits: int) -> Column:
    return F.shiftright(position, bits)


def _cells(start: str, last: Column, bits: int) -> Column:
    return F.explode(F.sequence(_cell(start, bits), _cell(F.greatest(F.col(start), last), bits)))


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(F.col("doc_id"), *[
        F.col(c).alias(prefix + c) for c in df.columns if c != "doc_id"])


def overlap_join(a: DataFrame, b: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """Pairs with ``a.start < b.end AND a.end > b.start``, as ``doc_id, a_*, b_*``."""
    left = _renamed(a, "a_").withColumn("_cell", _cells("a_start", F.col("a_end") - 1, bits))
    right = _renamed(b, "b_").withColumn("_cell", _cells("b_start", F.col("b_end") - 1, bits))
    # Two spans may share several cells; they meet in the first of them only.
    first = F.col("_cell") == _cell(F.greatest("a_start", "b_start"), bits)
    overlap = (F.col("a_start") < F.col("b_end")) & (F.col("a_end") > F.col("b_start"))
    return left.join(right, ["doc_id", "_cell"]).where(first & overlap).drop("_cell")


def contained_join(a: DataFrame, b: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """Pairs with ``a.start >= b.start AND a.end <= b.end``, as ``doc_id, a_*, b_*``.

    An inverted ``a`` is held by whatever meets the stretch between its ends, so it is spread
    over that; any other ``a`` meets ``b`` in the cell of its start.
    """
    low = F.least("a_start", F.col("a_end"))
    left = _renamed(a, "a_")
    inverted = F.col("a_end") < F.col("a_start")
    left = left.withColumn("_cell", F.explode(F.sequence(
        F.when(inverted, _cell(F.col("a_end"), bits)).otherwise(_cell("a_start", bits)), _cell("a_start", bits))))
    right = _renamed(b, "b_").withColumn("_cell", _cells("b_start", F.col("b_end"), bits))
    # They meet in the first common cell only.
    begin = F.when(inverted, low).otherwise(F.col("a_start"))
    first = F.col("_cell") == _cell(F.greatest(begin, "b_start"), bits)
    inside = (F.col("a_start") >= F.col("b_start")) & (F.col("a_end") <= F.col("b_end"))
    return left.join(right, ["doc_id", "_cell"]).where(first & inside).drop("_cell")


def crossing_spans(spans: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """Pairs that overlap without nesting: ``doc_id, a_start, a_end, b_start, b_end``."""
    slim = spans.select("doc_id", "start", "end")
    left = _renamed(slim, "a_").withColumn("_cell", _cells("a_start", F.col("a_end") - 1, bits))
    right = _renamed(slim, "b_").withColumn("_cell", _cell("b_start", bits))
    crossing = ((F.col("a_start") < F.col("b_start")) & (F.col("b_start") < F.col("a_end"))
                & (F.col("a_end") < F.col("b_end")))
    return left.join(right, ["doc_id", "_cell"]).where(crossing).drop("_cell")


def require_no_crossing(spans: DataFrame) -> None:
    """Raise on the first pair of crossing spans."""
    offender = crossing_spans(spans).head(1)
    if offender:
        raise ValueError(f"crossing annotations: {offender[0].asDict()}")


def covered_text(spans: DataFrame, docs: DataFrame, bits: int = TEXT_CELL_BITS) -> DataFrame:
    """Add ``text``, the characters a span covers.

    Documents are cut into pieces and a span meets only the pieces it lies in:
    no row carries a whole document, and finding the characters does not get
    slower towards the end of a long one.  Ends behind the text are cut.
    """
    size = 1 << bits
    pieces = docs.select("doc_id", F.posexplode(
        F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))).alias("no", "piece"))
    pieces = pieces.select("doc_id", F.col("no").cast("bigint").alias("_cell"), "piece")
    first, last = _cell("start", bits), _cell(F.greatest(F.col("start"), F.col("end") - 1), bits)

    def piece_of(span_start: Column, span_end: Column) -> Column:
        at = F.greatest(span_start - F.col("_cell") * size, F.lit(0))
        upto = F.least(span_end - F.col("_cell") * size, F.lit(size))
        return F.substring(F.col("piece"), (at + 1).cast("int"),
                           F.greatest(upto - at, F.lit(0)).cast("int"))

    here = piece_of(F.col("start"), F.col("end"))
    short = (spans.where(first == last).withColumn("_cell", first)
             .join(pieces, ["doc_id", "_cell"], "left")
             .withColumn("text", F.coalesce(here, F.lit(""))).drop("_cell", "piece"))
    # The few spans across a border are put together from their pieces.
    across = spans.where(first != last)
    texts = (across.select("doc_id", "start", "end").distinct()
             .withColumn("_cell", F.explode(F.sequence(first, last)))
             .join(pieces, ["doc_id", "_cell"], "left")
             .groupBy("doc_id", "start", "end")
             .agg(F.array_join(F.array_sort(F.collect_list(
                 F.struct("_cell", F.coalesce(here, F.lit("")).alias("text"))))["text"], "").alias("text")))
    long = across.join(texts, ["doc_id", "start", "end"])
    return short.unionByName(long.select(*short.columns))


def ordered_spans(spans: DataFrame) -> DataFrame:
    """Add ``idx`` (from 0), ``n`` and ``mid`` (``n / 2`` rounded down) per document."""
    return (numbered(spans, "idx", total="n").withColumn("idx", F.col("idx") - 1)
            .withColumn("mid", F.floor(F.col("n") / 2)))


def merge_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two sets; equal spans are kept once."""
    return a.unionByName(b).dropDuplicates([
        c for c, kind in a.dtypes if not kind.startswith("map")])


def rebase_spans(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """Shift spans that count from the start of their parent to document offsets."""
    origin = parent.select(*key, F.col("start").alias("_origin"))
    return (child.join(origin, key)
            .withColumn("start", F.col("start") + F.col("_origin"))
            .withColumn("end", F.col("end") + F.col("_origin")).drop("_origin"))
