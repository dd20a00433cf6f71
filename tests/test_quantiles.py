import math
import random

import pytest

from wattspark.operators.quantiles import exact_quantiles

WANTED = {"least": 0.0, "p10": 0.1, "median": 0.5, "p95": 0.95, "most": 1.0}


@pytest.mark.parametrize("kind", ["even", "ties", "wide", "close", "whole"])
def test_quantiles_equal_sorting(spark, kind):
    rnd = random.Random(kind)
    draw = {
        "even": lambda: rnd.uniform(-5, 5),
        "ties": lambda: float(rnd.randint(0, 3)),
        "wide": lambda: rnd.choice((-1, 1)) * 10 ** rnd.uniform(-300, 308),
        "close": lambda: 1e9 + rnd.randint(0, 40) * 2**-20,
        "whole": lambda: rnd.randint(-(2**62), 2**62),
    }[kind]
    rows = [(k, draw()) for k in ("a", "b", None) for _ in range(rnd.randint(1, 300))] + [("one", draw())]
    if kind != "whole":
        odd = [("a", None), ("a", math.nan), ("b", math.inf), ("none", None)]
    else:
        odd = [("a", None), ("none", None)]
    schema = f"k string, v {'long' if kind == 'whole' else 'double'}, _g string"
    df = spark.createDataFrame([(k, v, "clash") for k, v in rows + odd], schema).repartition(3)
    got = {r.k: tuple(r)[1:] for r in exact_quantiles(df, ["k"], "v", WANTED).collect()}
    want = {}
    for key in {k for k, _ in rows}:
        values = sorted(v for k, v in rows if k == key)
        want[key] = tuple(values[max(1, math.ceil(p * len(values) - 1e-9)) - 1] for p in WANTED.values())
    assert got == want


def test_no_rows_have_no_quantiles(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(df, ["k"], "v", WANTED).count() == 0
