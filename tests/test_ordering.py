"""Parts of an order: even on skewed orders, rising, and without overflow."""

import math
import random

import pytest
from pyspark.sql import functions as F

from talkmill.operators import batching, metrics, ordering

BIG = 2**63 - 1


def orders():
    rng = random.Random(2)
    return {
        "an outlier": [*range(4000), 4 * 10**16],
        "extremes": [-BIG - 1, BIG, *range(2000), *(BIG - 4096 * i for i in range(2000)), *(-BIG + 4096 * i for i in range(1000))],
        "a frequent value": [7] * 2000 + [rng.randrange(1000) for _ in range(2000)],
        "one value": [5] * 3000,
        "nulls": [None] * 1500 + list(range(3000)),
        "powers": [1 << rng.randrange(62) for _ in range(3000)],
        "few": [3, 1, 2],
        "only nulls": [None] * 50,
        "none": [],
    }


def frame(spark, values, kind="long"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, o {kind}").repartition(3)


@pytest.mark.parametrize("name", orders())
def test_parts_are_even_and_rise(spark, name):
    parts = 16
    values = orders()[name]
    rows = ordering.split(frame(spark, values), "o", "id", parts=parts).collect()
    assert len(rows) == len(values)
    ranked = sorted(rows, key=lambda r: (r.o is not None, r.o or 0, r[ordering.TIE]))
    own = [r[ordering.PART] for r in ranked]
    assert own == sorted(own)
    sizes = [own.count(p) for p in set(own)]
    if len(values) > 1000:
        assert max(sizes) <= 2 * len(values) / parts and len(sizes) >= parts - 1


def test_parts_of_doubles(spark):
    values = [0.5, math.nan, -math.inf, math.inf, None, *(x / 7 for x in range(500))]
    rows = ordering.split(frame(spark, values, "double"), "o", "id", parts=8)
    ranked = [r[ordering.PART] for r in rows.orderBy("o", ordering.TIE).collect()]
    assert ranked == sorted(ranked)


def test_parts_do_not_depend_on_the_partitioning(spark):
    rows = frame(spark, orders()["a frequent value"])
    split = ordering.split(rows, "o", "id").persist()
    again = split.select("id", "o").repartition(7).withColumn(ordering.TIE, ordering.tie_of("id"))
    between = ordering.quantiles(rows, "o")
    again = again.withColumn("p", ordering.part_of(F.col("o"), F.col(ordering.TIE), rows.schema["o"].dataType, between))
    assert split.join(again, "id").where(F.col(ordering.PART) != F.col("p")).count() == 0


@pytest.mark.parametrize("name", ["an outlier", "extremes", "a frequent value"])
def test_numbering_over_parts(spark, name):
    values = orders()[name]
    rows = frame(spark, values).withColumn("bucket", F.when(F.col("id") % 3 > 0, F.lit("most"))).withColumn("size", F.when(F.col("id") % 5 > 0, F.col("id")))
    got = {r.id: r.batch_id for r in batching.fixed_batches(rows, 8, "o", "bucket", "id").collect()}
    tied = {r.id: r[ordering.TIE] for r in rows.withColumn(ordering.TIE, ordering.tie_of("id")).collect()}
    for bucket in (0, 1):
        own = sorted((v, tied[i], i) for i, v in enumerate(values) if (i % 3 > 0) == bucket)
        assert [got[i] for _, _, i in own] == [k // 8 for k in range(len(own))]
    totals = {r.id: (r.files, r.bytes) for r in metrics.running_totals(rows, "o", "size", "id").collect()}
    total = 0
    for k, (_, _, i) in enumerate(sorted((v, tied[i], i) for i, v in enumerate(values))):
        total += i if i % 5 else 0
        assert totals[i] == (k + 1, total)


def test_waits_of_far_times(spark):
    """Marks whose sequence numbers span all of a bigint, one program with nearly all of them."""
    rng, rows, blocked = random.Random(4), [], {"p": 0.0, "q": 0.0}
    seqs = sorted({rng.randrange(-BIG, BIG) for _ in range(3000)})
    last = {}
    for i, seq in enumerate(seqs):
        program, name = ("q" if i % 50 == 0 else "p"), rng.choice(["start_blocking", "stop_blocking"])
        rows.append((program, name, seq, float(i)))
        if name == "stop_blocking" and last.get(program, ("",))[0] == "start_blocking":
            blocked[program] += i - last[program][1]
        last[program] = (name, float(i))
    got = {r.program: r for r in metrics.blocking(spark.createDataFrame(rows, "program string, name string, seq long, ts double").repartition(4)).collect()}
    for program, want in blocked.items():
        assert got[program].blocked == want
        assert got[program].open_start == (last[program][1] if last[program][0] == "start_blocking" else None)
