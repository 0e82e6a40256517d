from __future__ import annotations

import math
import random
import struct

from pyspark.sql import functions as F

from replat.functions.ordering import first_of_largest, ordered_bits
from replat.operators import cases


def bits(x):
    if math.isnan(x):
        return (2047 << 52) + 1
    size = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -size if x < 0 else size


def values():
    rng = random.Random(2)
    some = [0.0, -0.0, 1.0, -1.0, math.inf, -math.inf, math.nan, 5e-324, 2.0**-1022, 1.7976931348623157e308, 1.7e12]
    some += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(400)]
    for e in range(-1074, 1024, 7):
        some += [2.0**e, math.nextafter(2.0**e, 0), math.nextafter(2.0**e, math.inf), -(2.0**e)]
    return some


def test_bits_are_those_of_the_double(spark):
    some = values()
    out = spark.createDataFrame([(i, x) for i, x in enumerate(some)], "i long, x double").repartition(3)
    got = dict(map(tuple, out.select("i", ordered_bits(F.col("x"))).collect()))
    assert [got[i] for i in range(len(some))] == [bits(x) for x in some]
    assert spark.createDataFrame([(None,)], "x double").select(ordered_bits(F.col("x")).alias("b")).first()["b"] is None


def test_the_first_of_the_largest_has_the_largest_number(spark):
    some = [x for x in values() if not math.isnan(x)] * 2
    rows = [(i, (1 << 40) + i, x) for i, x in enumerate(some)]
    rows += [(len(rows), 0, 2.0), (len(rows) + 1, (1 << 62) - 1, 2.0)]
    out = spark.createDataFrame(rows, "i long, seq long, x double").select("i", first_of_largest(F.col("x"), F.col("seq")).alias("n"))
    assert dict(out.dtypes)["n"] == "decimal(38,0)"
    got = dict(map(tuple, out.collect()))
    assert sorted(range(len(rows)), key=lambda i: (-rows[i][2], rows[i][1])) == sorted(got, key=lambda i: -got[i])


def test_picks_are_hashed(spark):
    shape = (
        "seq long, main_ain string, modulename string, workclass_name string, rebuild_progress_num double, apply_date double, "
        "project_name string, disaster_type string, new_dwelling_units int, description string"
    )
    rollup = cases.case_rollup(cases.case_facts(spark.createDataFrame([], shape)))
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
