"""Near duplicates of vectors against all cosines, on tables with every kind of odd row."""

import numpy as np
import pytest

from boxloom.llm import embeddings

ODD = "vec_id long, embedding array<float>, label int, node string, packed string, Cell int"


def brute(rows, threshold=0.9):
    """rows: (id, vector or None). The contract's columns by comparing all pairs; rows in the given order."""
    n = len(rows)
    units, good = [None] * n, []
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x = np.array(v, np.float64)
            x = x / np.abs(x).max()
            units[i] = x / np.sqrt((x * x).sum())
            good.append(i)
    near = {i: [] for i in range(n)}
    for i in good:
        near[i] = [j for j in good if j != i and len(units[j]) == len(units[i]) and units[i] @ units[j] >= threshold]
    root = list(range(n))
    for i in good:  # flood
        if root[i] == i:
            todo = [i]
            while todo:
                x = todo.pop()
                for j in near[x]:
                    if root[j] != i:
                        root[j] = i
                        todo.append(j)
            root[i] = i
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root[i]] = min(low.get(root[i], k), k)
    return [(k, len(near[i]), low.get(root[i]), k is not None and k == low[root[i]]) for i, (k, _) in enumerate(rows)]


def found(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def turned(rng, v, cosine):
    w = rng.normal(size=v.shape)
    w -= (w @ v) / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine * cosine) * w / np.linalg.norm(w)


def planted(rng, n, dim, hot):
    """Random vectors, chains and pairs about the threshold, a dense group of ``hot`` near copies, exact copies."""
    base = rng.normal(size=(n, dim))
    out = [*base]
    for i in range(0, n // 4):
        out.append(turned(rng, base[i], rng.choice([0.86, 0.89, 0.91, 0.93, 0.97, 0.999])))
    link = base[0]
    for _ in range(12):
        link = turned(rng, link, 0.92)
        out.append(link)
    out += [turned(rng, base[1], rng.uniform(0.95, 0.9999)) * rng.uniform(0.1, 9) for _ in range(hot)]
    out += [base[2]] * 40
    return np.array(out, np.float32)


@pytest.mark.parametrize("block_rows", [8, 1024])
def test_all_links(spark, block_rows):
    rng = np.random.default_rng(5)
    x = planted(rng, 400, 32, 150)
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(len(x)), x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert found(embeddings.near_duplicates(df, margin=0.3, block_rows=block_rows)) == sorted(brute(rows), key=str)


def test_recall_of_the_margin(spark):
    """With the production margin at least 99 % of links barely above the threshold are found, and none below it."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(3000, 64))
    pairs = np.array([turned(rng, v, 0.901) for v in base])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(np.concatenate([base, pairs]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    links = sum(r["n_links"] for r in embeddings.near_duplicates(df).collect())
    assert 0.99 * 6000 <= links <= 6000


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert found(embeddings.near_duplicates(df)) == sorted(brute(rows), key=str)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, -0.0], [1.0, 0.0, 0.0],
               [-1.0, 0.0], [1e30, 1e29], [1e-30, 1e-31], [0.6, 0.8], [0.0, 1.0], [5.0]]
    rows = [(i, v, None, "n", "p", 3) for i, v in enumerate(vectors)]
    rows += [(6, [0.0, -1.0], None, None, None, None), (None, [1.0, 0.01], 1, None, None, None), (None, [-7.0], 1, None, None, None), rows[13], rows[13], (None, None, 1, None, None, None)]
    df = spark.createDataFrame(rows, ODD)
    got = embeddings.near_duplicates(df, margin=2.0)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    plain = brute([(r[0], r[1]) for r in rows])
    # a repeated id joins no components: the rows with id 6 stay apart, each in the component it reaches
    assert found(got) == sorted(plain, key=str)


def test_empty_and_extra_columns(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], ODD)).collect() == []
    alone = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert found(embeddings.near_duplicates(alone)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_crowded_cell_is_not_compared_with_itself(spark):
    """A tight group gets its counts from the core: no rows are dealt to blocks for it."""
    rng = np.random.default_rng(7)
    hot = np.array([turned(rng, np.ones(64), 0.995) for _ in range(2000)])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(hot)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embeddings.near_duplicates(df).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(1999, 0)}
    packed = embeddings._pack(df.selectExpr("vec_id", "embedding AS vector"), "<f8")
    reps = packed.selectExpr("node", "packed", "1L AS copies")
    cells = embeddings._Cells(embeddings._centroids(reps, 2000, 0.9, "<f8"), 0.9, embeddings.MARGIN, "<f8")
    census = embeddings._census(reps, cells)
    assert sum(r["n0"] for r in census.values()) == 2000 and sum(r["n1"] + r["n2"] for r in census.values()) == 0
