import random

import pytest

from dialogue_engine.operators import runs

LOG = "run_id string, seq long, step long, loss double"
ENTRIES = {
    "usual": [(10, 2.5), (20, 1.42319), (None, None), (30, 1.9), (None, 1.00005)],
    "flat": [(1, 0.5), (2, 0.5)],
    "single": [(None, 3.0)],
    "zero": [(None, -1.0), (None, 0.0)],
    "none": [(1, None)],
}


def log(spark, entries=ENTRIES):
    rows = [(r, i, s, v) for r, items in entries.items() for i, (s, v) in enumerate(items)]
    return spark.createDataFrame(rows, LOG).repartition(3)


def series(items):
    out = []
    for seq, (step, loss) in enumerate(items):
        if loss is not None:
            out.append((seq, step if step is not None else len(out), round(loss, 4)))
    return out


def test_series(spark):
    rng = random.Random(2)
    many = {**ENTRIES, "hot": [(rng.choice([None, i]), rng.choice([None, rng.random()])) for i in range(500)]}
    got = {tuple(r) for r in runs.loss_series(log(spark, many)).collect()}
    assert got == {(r, *p) for r, items in many.items() for p in series(items)}


def test_scaled(spark):
    got = {(r.run_id, r.seq): (r.x, r.y) for r in runs.loss_scaled(log(spark)).collect()}
    expected = {}
    for r, items in ENTRIES.items():
        points = series(items)
        values = [v for _, _, v in points]
        for i, (seq, _, v) in enumerate(points):
            low, high = min(values), max(values) or 1
            expected[r, seq] = (i / max(len(points) - 1, 1), (v - low) / (high - low or 1))
    assert got == expected


def test_summary(spark):
    got = {r.run_id: (r.final_loss, r.min_loss) for r in runs.loss_summary(log(spark)).collect()}
    assert got == {"usual": (1.0001 if round(1.00005, 4) == 1.0001 else 1.0, round(1.00005, 4)),
                   "flat": (0.5, 0.5), "single": (3.0, 3.0), "zero": (0.0, -1.0)}


def test_trainable_share(spark):
    rows = [("m", 24_313_856, True), ("m", 3_212_750_224, False), ("f", 5, False), ("z", 0, True)]
    df = spark.createDataFrame(rows, "model_name string, size long, trainable boolean")
    got = {r.model_name: tuple(r)[1:] for r in runs.trainable_share(df).collect()}
    assert got == {"m": (24_313_856, 3_237_064_080, 0.75), "f": (0, 5, 0.0), "z": (0, 0, 0.0)}


@pytest.mark.parametrize(
    "seconds, trainable, cost",
    [(4028.0, 24_313_856, 97.94), (None, 5, None), (10.0, 0, None), (10.0, None, None)],
)
def test_cost(spark, seconds, trainable, cost):
    df = spark.createDataFrame([("r", seconds, trainable)], "run_id string, duration_seconds double, trainable_params long")
    assert runs.cost_proxy(df).first().cost_proxy == cost
