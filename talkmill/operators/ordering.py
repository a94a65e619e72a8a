"""Parts of an order with about equally many rows each, so that numbering and running sums need no task that sees all rows.

One pass over the order column, with a sketch that tasks merge, gives the quantiles between parts (as doubles: values
nearer to each other than a double tells share a part). A part is then a plain
expression of a row: whatever reads the rows again, in another plan or after a lost executor, deals them out alike. A
value that holds several quantiles is spread over the parts between them by a hash of the row, which settles the order of
its rows as well; so a value that a third of all rows share is no single task either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts, whatever the number of rows, and how many times finer the sketch is than a part.
PARTS, FINER = 512, 20
#: Columns of split(): the part, and what orders rows of one value.
PART, TIE = "__part", "__tie"


def quantiles(rows: DataFrame, order: str, parts: int = PARTS) -> list:
    """The parts - 1 values between parts, in order; a frequent value repeats. Empty without any value."""
    known = rows.where(~F.isnan(order)) if isinstance(rows.schema[order].dataType, T.FractionalType) and not isinstance(rows.schema[order].dataType, T.DecimalType) else rows
    return known.agg(quantiles_of(order, parts).alias("q")).first()["q"] or []


def _runs(values: list) -> tuple[list, list[int]]:
    """Different values of a sorted list, and for each how often it is there."""
    out: list = []
    counts: list[int] = []
    for v in values:
        if out and out[-1] == v:
            counts[-1] += 1
        else:
            out.append(v)
            counts.append(1)
    return out, counts


def _constant(values: list, kind: T.DataType) -> Column:
    """Numbers as one array, from one text that Spark folds: quicker to plan than a literal for each."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(T.ArrayType(kind))


def quantiles_of(order: str, parts: int = PARTS) -> Column:
    """The aggregate behind quantiles()."""
    return F.percentile_approx(order, _constant([i / parts for i in range(1, parts)], T.DoubleType()), F.lit(parts * FINER))


def how_many_below(order: Column, values: list, kind: T.DataType) -> Column:
    """How many of the sorted, different values a row's is above: found in two steps, each over the square root of their number."""
    width = max(1, round(len(values) ** 0.5))
    lasts = [values[min(i + width, len(values)) - 1] for i in range(0, len(values), width)]

    def below(xs: Column) -> Column:
        return F.size(F.filter(xs, lambda v: v < order))

    group = F.least(below(_constant(lasts, kind)), F.lit(len(lasts) - 1))
    return group * width + below(F.slice(_constant(values, kind), group * width + 1, width))


def next_of(order: Column, values: list, kind: T.DataType) -> Column:
    """The least of some values that a row's doesn't exceed; null above all of them."""
    values, _ = _runs(sorted(values))
    return F.get(_constant(values, kind), how_many_below(order, values, kind)) if values else F.lit(None).cast(kind)


def part_of(order: Column, tie: Column, kind: T.DataType, between: list, parts: int = PARTS, at: Column | None = None) -> Column:
    """A row's part from the quantiles: it rises with (order, tie), nulls first. Nulls have parts below 0. at: how many different quantiles lie below, if known."""
    share = F.shiftright(tie, 32)  # 31 bits

    def spread(n: Column) -> Column:
        return F.shiftright(share * n, 31).cast("int")

    nulls = spread(F.lit(parts).cast("long")) - parts
    values, counts = _runs(between)
    if not values:
        return F.when(order.isNull(), nulls).otherwise(0)
    at = how_many_below(order, values, kind) if at is None else at
    starts = [sum(counts[:i]) for i in range(len(counts) + 1)]
    same = F.coalesce(F.get(_constant(values, kind), at) == order, F.lit(False))
    start, more = (F.get(_constant(xs, T.IntegerType()), at) for xs in (starts, [*counts, 0]))
    found = start + F.when(same, spread((more + 1).cast("long"))).otherwise(0)
    return F.coalesce(F.when(order.isNull(), nulls).otherwise(found), F.lit(0))  # never null: so that joins add no filter on it


def tie_of(*names: str) -> Column:
    """63 bits of a row's hash."""
    return F.shiftrightunsigned(F.xxhash64(*names), 1)


def split(rows: DataFrame, order: str, *ties: str, parts: int = PARTS) -> DataFrame:
    """rows with PART and TIE. ties: columns whose hash orders rows of one value of a numeric order column; all plain ones if not given."""
    names = ties or [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    between, kind = quantiles(rows, order, parts), rows.schema[order].dataType
    rows = rows.withColumn(TIE, tie_of(*names))
    if not between:
        return rows.withColumn(PART, part_of(F.col(order), F.col(TIE), kind, between, parts))
    rows = rows.withColumn("__at", how_many_below(F.col(order), _runs(between)[0], kind))  # a column of its own, so that it is computed once
    return rows.withColumn(PART, part_of(F.col(order), F.col(TIE), kind, between, parts, F.col("__at"))).drop("__at")
