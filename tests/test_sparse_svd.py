import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sextant.functions.hashing import normal, normals
from sextant.operators import encode, sparse_svd

ENTRIES = "row long, column string, value double"


def dense(entries, n, names):
    a = np.zeros((n, len(names)))
    for r, c, v in entries:
        if None not in (r, c, v):
            a[r, names.index(c)] += v
    return a


def test_truncated_svd_equals_numpy(spark):
    """Scores, loadings, singular values and signs within 1e-6 of a dense SVD; one column is in every row."""
    rng = np.random.default_rng(4)
    n, names = 120, [f"c{j:02d}" for j in range(60)]
    low = (rng.normal(size=(n, 6)) * [9, 7, 5, 3.5, 2.5, 2]) @ rng.normal(size=(6, 60)) + 0.05 * rng.normal(size=(n, 60))
    low[:, 30:] *= rng.random(n)[:, None] < 0.5        # half of the rows hold half of the columns
    entries = [(int(i), names[j], float(low[i, j])) for i, j in zip(*np.nonzero(low))]
    entries += [(0, "c01", 0.25), (None, "c01", 1.0), (3, None, 1.0), (4, "c02", None)]     # added up; left out
    a = dense(entries, n, names)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    df = spark.createDataFrame(entries, ENTRIES).repartition(7)
    scores, loadings, values = sparse_svd.truncated_svd(df, 3, iterations=3, salt=4)
    assert np.allclose(values, s[:3], rtol=1e-9)
    v, got = np.zeros((60, 3)), np.zeros((n, 3))
    for r in loadings.collect():
        v[names.index(r["column"])] = r["v"]
    for r in scores.collect():
        got[r["row"]] = r["v"]
    for j in range(3):
        sign = np.sign(vt[j][np.abs(vt[j]).argmax()])
        assert np.allclose(v[:, j], sign * vt[j], atol=1e-6)
        assert np.allclose(got[:, j], sign * u[:, j] * s[j], atol=1e-6 * s[0])


def test_truncated_svd_of_low_rank_empty_and_zero_tables(spark):
    one = spark.createDataFrame([(i, f"c{j}", float((i + 1) * (j + 1))) for i in range(5) for j in range(4)], ENTRIES)
    scores, loadings, values = sparse_svd.truncated_svd(one, 3, iterations=1)
    want = np.linalg.norm(np.arange(1, 6)) * np.linalg.norm(np.arange(1, 5))
    assert values == [pytest.approx(want)] and {len(r["v"]) for r in scores.collect()} == {1}
    for rows in ([], [(1, "c", 0.0)]):
        scores, loadings, values = sparse_svd.truncated_svd(spark.createDataFrame(rows, ENTRIES), 2)
        assert values == [] and scores.count() == len(rows) == loadings.count()


def test_triangle_of_blocks_equals_one_factor(spark):
    rows = np.random.default_rng(2).normal(size=(200, 4))
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "v array<double>")
    for parts in (1, 9):
        r = sparse_svd.triangle(df.repartition(parts), 4, fan=3)
        assert np.allclose(r.T @ r, rows.T @ rows)
    assert sparse_svd.triangle(df.where("false"), 4).shape == (0, 4)


def test_text_svd_over_every_term(spark):
    """Without a vocabulary limit: the same dimensions as the bounded form that keeps all terms."""
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["red", "ring", "bolt", "nut", "blue", "green", "steel", "brass"], k=8)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts + ["", None, "a b"])), "id int, text string")
    want = {r["id"]: list(r)[1:] for r in encode.text_svd(df, "id", "text", 3, 1000).collect()}
    got = {r["id"]: list(r)[1:] for r in encode.text_svd(df, "id", "text", 3, None).collect()}
    assert set(got) == set(want) and len(got) == 43
    assert all(np.allclose(got[i], want[i], atol=1e-8) for i in got)
    assert got[40] == got[41] == got[42] == [0.0, 0.0, 0.0]


def test_normals_in_a_task_equal_the_column(spark):
    keys = ["red", "Ärger", "", "x:1"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(*[normal("k", seed=f"42:{j}").alias(f"_{j}") for j in range(3)])
    assert np.allclose(normals(keys, ["42:0", "42:1", "42:2"]), [list(r) for r in df.collect()], rtol=1e-13)


def test_products_move_one_line_a_block_and_shared_column(spark, monkeypatch):
    """Not one per entry: 3 blocks, 400 rows of 30 shared columns and one of their own."""
    rows, sent, apply = [], [], sparse_svd._Dealt.apply
    for i in range(400):
        rows += [(i, f"c{j:02d}", 1.0 + ((i * 7 + j * 3) % 11)) for j in range(30)] + [(i, f"own{i}", 1.0)]
    monkeypatch.setattr(sparse_svd._Dealt, "apply", lambda self, state, *rest: sent.append(state.count()) or apply(self, state, *rest))
    df = spark.createDataFrame(rows, ENTRIES).repartition(3, "row")
    scores, loadings, values = sparse_svd.block_svd(sparse_svd.pack(df, 10 ** 9), 3, iterations=2)
    blocks = df.select(F.spark_partition_id()).distinct().count()
    assert loadings.count() == 430 and scores.count() == 400
    # the names of all columns; then rows, or rows and shared columns, of the left and right sides
    assert sent == [400 + 30 * blocks, 400, 400 + 30 * blocks, 400, 400 + 30 * blocks, 400]
    names = [f"c{j:02d}" for j in range(30)] + [f"own{i}" for i in range(400)]
    assert np.allclose(values, np.linalg.svd(dense(rows, 400, names), compute_uv=False)[:3], rtol=1e-6)


def test_blocks_are_cut_and_an_id_that_comes_twice_is_one_row(spark):
    df = spark.createDataFrame([(i % 50, f"c{i % 13}", float(i)) for i in range(600)], ENTRIES).repartition(2, "row")
    one, many = (sparse_svd.pack(df, n) for n in (10 ** 9, 20))
    assert one.chunks.select("block").distinct().count() < many.chunks.select("block").distinct().count() or many.rows.count() == 50
    a, b = (sparse_svd.block_svd(x, 2)[2] for x in (one, many))
    assert np.allclose(a, b, rtol=1e-9)
    texts = spark.createDataFrame([(1, "red ring"), (1, "red bolt"), (2, "blue bolt nut"), (3, "nut ring")], "id int, text string")
    merged = spark.createDataFrame([(1, "red ring red bolt"), (2, "blue bolt nut"), (3, "nut ring")], "id int, text string")
    blocks = [sorted((r["term"], r["_cf"], r["_df"]) for r in counts) for counts in (encode_counts(texts), encode_counts(merged))]
    assert blocks[0] == blocks[1]


def encode_counts(df):
    seen, vocabulary = [], encode._vocabulary

    def spy(counts, *rest):
        seen.extend(counts.collect())
        return vocabulary(counts, *rest)
    encode._vocabulary = spy
    try:
        encode.text_svd(df, "id", "text", 2, None).count()
    finally:
        encode._vocabulary = vocabulary
    return seen
