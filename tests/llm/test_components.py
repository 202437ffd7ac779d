import random

import numpy as np

from tripmart.llm.components import connected_components
from tripmart.llm.embedding_dedup import roots


def test_chains_stars_and_cliques(spark):
    r = random.Random(2)
    links = [(k, k + 1) for k in range(100, 140)] + [(5, k) for k in range(200, 400)]
    links += [(a, b) for a in range(500, 520) for b in range(500, 520)] + [(7, 7)]
    links += [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(250)] + [(139, 100)]
    frame = spark.createDataFrame(links, "src long, dst long").repartition(5)
    got = {x.node: x.component for x in connected_components(frame).collect()}
    root = roots(1500, np.array([a for a, _ in links]), np.array([b for _, b in links]))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: int(root[n]) for n in linked}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []
