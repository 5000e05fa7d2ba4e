import math
import zlib

import numpy as np

from tests.conftest import SF01
from trendlake.llm import quality
from trendlake.llm.common import table


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 and (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_scores_are_the_density_ratio(spark):
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES)
    x = rng.normal(size=(400, d)) * np.arange(1, d + 1)
    y = (rng.random(400) < 0.3).astype(int)
    x[y == 1] += 1.5
    stats = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "doc bigint, x array<double>")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id bigint, quality int")
    model = quality.fit(stats, labels, "quality")
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    covs = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum((y == k).mean() * c for k, c in enumerate(covs))
    margin = 0
    for k, sign in ((0, -1), (1, 1)):
        c = (1 - quality.TO_POOLED) * covs[k] + quality.TO_POOLED * pooled
        c = (1 - quality.TO_DIAGONAL) * c + quality.TO_DIAGONAL * np.diag(np.diag(c)) + quality.RIDGE * np.eye(d)
        u = z - z[y == k].mean(axis=0)
        far = np.einsum("ij,jk,ik->i", u, np.linalg.inv(c), u)
        margin = margin + sign * (math.log((y == k).mean()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * far)
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-margin)), atol=1e-9)


def test_odd_rows_and_missing_labels(spark, make_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 7), (None, 0)], "doc_id bigint, quality int")
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "\n"), (5, "long text " * 50_000)]
    got = quality.classify(make_docs(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.classify(make_docs(rows), none).collect()} == {0.5}
    assert quality.classify(make_docs([]), labels).count() == 0
