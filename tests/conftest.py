import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from lodestat.session import local_session

    return local_session("tests", 8)


@pytest.fixture(scope="session")
def tiny_docs(spark):
    rows = [
        ("g/space/1", "The moon, the moon and the STARS"),
        ("g/space/2", "moon rocket: moon base"),
        ("g/food/3", "bread and butter; bread and jam"),
        ("g/food/4", "jam on bread"),
        ("g/food/5", "butter the bread, butter the pan"),
        ("g/none/6", "12345 ... 678"),
    ]
    return spark.createDataFrame(rows, "doc_id string, text string")


@pytest.fixture(scope="session")
def tiny_cube(spark):
    rows = [(d, t, w, (d * 7 + t * 3 + w * 5) % 4) for d in range(3) for t in range(3) for w in range(4)]
    return spark.createDataFrame(rows, "doc int, topic int, word int, cnt long")


@pytest.fixture(scope="session")
def vectors(spark):
    """Three noisy groups of 6-dimensional vectors."""
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.normal(0, 4, (3, 6))
    rows = []
    for i in range(120):
        g = i % 3
        rows.append((i, g, [float(x) for x in centres[g] + rng.normal(0, 1, 6)], float(rng.normal() + g)))
    df = spark.createDataFrame(rows, "id bigint, label int, v array<double>, y double").repartition(4, "id").cache()
    return df, np.array([r[2] for r in rows]), np.array([r[1] for r in rows]), np.array([r[3] for r in rows])
