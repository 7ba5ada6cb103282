"""Random areas and points for brute-force comparisons."""

import math
import random

from tidegrid.functions.geometry import RING_TYPE


def star(rng, cx, cy, radius, corners):
    """A ring around (cx, cy) that does not cross itself."""
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    ring = []
    for a in turns:
        r = radius * rng.uniform(0.3, 1)
        ring.append({"x": cx + r * math.cos(a), "y": cy + r * math.sin(a)})
    return [*ring, ring[0]]


def random_areas(spark, seed, n, sizes, box):
    """``n`` areas with centres in ``box``, the sizes taken in turn."""
    rng = random.Random(seed)
    x0, y0, x1, y1 = box
    rows = [
        (i, star(rng, rng.uniform(x0, x1), rng.uniform(y0, y1), sizes[i % len(sizes)], rng.choice([3, 5, 9, 30])))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, f"area_id long, ring {RING_TYPE}")


def random_points(spark, seed, n, box):
    rng = random.Random(seed)
    x0, y0, x1, y1 = box
    rows = [(i, rng.uniform(x0, x1), rng.uniform(y0, y1)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, lon double, lat double")
