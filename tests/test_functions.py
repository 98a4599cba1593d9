"""Column functions on small inputs."""

import pytest
from pyspark.sql import functions as F

from lodestone.functions import boosted


@pytest.mark.parametrize("factor", [1.15, 1.2])
def test_boost(spark, factor):
    words = ["open", "Read", "write", "read"]
    texts = [None, "", "nothing", "open open", "OPEN, read", "open read write", "open read write " * 50]
    df = spark.createDataFrame([(t, c) for t in texts for c in (0.5, 0.9)], "t string, c double")
    for r in df.select("t", "c", boosted(F.col("c"), F.col("t"), words, factor).alias("b")).collect():
        want = r.c
        for w in {"open", "read", "write"}:
            want *= factor if w in (r.t or "").lower() else 1
        assert r.b == pytest.approx(min(1.0, want))


def test_windows_around_long_numbers_are_those_of_the_plain_pattern(spark):
    import random

    from lodestone.plans.code import found, number_windows

    rng = random.Random(1)
    parts = [lambda: "a" * rng.randrange(150), lambda: "\U0001f600" * rng.randrange(150), lambda: str(rng.randrange(10 ** rng.randrange(1, 9))), lambda: "\n", lambda: "\r", lambda: " the "]
    texts = [("".join(rng.choice(parts)() for _ in range(rng.randrange(60))),) for _ in range(300)]
    df = spark.createDataFrame([*texts, (None,)], "t string")
    rows = df.select(number_windows(F.col("t")).alias("a"), found("t", ".{0,55}[0-9]{4,}.{0,55}").alias("b")).collect()
    assert all(r.a == r.b for r in rows) and sum(len(r.a or []) for r in rows) > 300
