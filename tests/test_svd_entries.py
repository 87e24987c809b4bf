"""The entries of a block stay in its file: they are neither cached nor sent to a product."""
import numpy as np

from sextant.operators import sparse_svd


def test_products_are_sent_weights_only(spark, monkeypatch):
    seen, first = [], sparse_svd._first
    monkeypatch.setattr(sparse_svd, "_first", lambda dealt, *a: (seen.append(dealt.table.columns), first(dealt, *a))[1])
    a = np.random.default_rng(3).integers(0, 3, (30, 12)).astype(float)
    df = spark.createDataFrame([(i, f"c{j:02d}", float(a[i, j])) for i, j in zip(*(x.tolist() for x in np.nonzero(a)))],
                               "row long, column string, value double")
    _, _, values = sparse_svd.truncated_svd(df, 3, iterations=6)
    assert np.allclose(values, np.linalg.svd(a)[1][:3], rtol=1e-3)
    assert len(seen) == 1 and not {"rows", "lens", "names", "cols", "vals"} & set(seen[0])
