"""How many pairs at the bound and a little above it the lattice cells find."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import lattice


@pytest.mark.parametrize("cosine, least", [(0.9301, 0.99), (0.94, 0.99), (0.95, 0.99)])
def test_recall_of_pairs_by_cosine(spark, cosine, least):
    rng = np.random.default_rng(int(cosine * 1e4))
    a, other = rng.normal(size=(2, 500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    other -= (other * a).sum(axis=1)[:, None] * a
    other /= np.linalg.norm(other, axis=1)[:, None]
    b = cosine * a + np.sqrt(1 - cosine**2) * other
    rows = [(2 * i + j, v.tolist(), i) for i in range(500) for j, v in ((0, a[i]), (1, b[i]))]  # a label for each pair: one link in each
    out = lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert out.agg(F.avg("n_links")).first()[0] >= least
