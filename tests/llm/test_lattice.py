import itertools

import duckdb
import numpy as np
import pytest

from odd_rows import CLASHING
from sieveframe.llm import lattice


def by_hand(rows, least=0.93):
    """Every pair of rows (id, vector, label) with equal labels."""
    able = [label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    near = {i: {i} for i in range(len(rows))}
    for i, j in itertools.combinations([i for i, a in enumerate(able) if a], 2):
        if rows[i][2] == rows[j][2]:
            width = max(len(rows[i][1]), len(rows[j][1]))
            a, b = (np.pad(np.array(rows[k][1], float), (0, width - len(rows[k][1]))) for k in (i, j))
            if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least:
                near[i].add(j)
                near[j].add(i)
    seen, out = {}, []
    for i in near:
        if i not in seen:
            group, todo = set(), [i]
            while todo:
                at = todo.pop()
                if at not in group:
                    group.add(at)
                    todo.extend(near[at])
            seen.update(dict.fromkeys(group, group))
        ids = [rows[k][0] for k in seen[i] if rows[k][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]) - 1, component, component is not None and rows[i][0] == component))
    return out


def key(row):
    return tuple((x is None, 0 if x is None else x) for x in row)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def clustered(rng, groups, size, spread, width=64):
    centers = rng.normal(size=(groups, width))
    return np.concatenate([c + spread * rng.normal(size=(size, width)) for c in centers])


@pytest.mark.parametrize("cell", [2048, 7])
def test_against_all_pairs(spark, cell):
    """Copies, chains and dense groups; squares of one part and of many."""
    rng = np.random.default_rng(5)
    vectors = np.concatenate([clustered(rng, 12, 25, 0.12), rng.normal(size=(150, 64)), clustered(rng, 4, 10, 0.3)])
    vectors = np.concatenate([vectors, vectors[:40], vectors[40:60] * 3]).astype(np.float32)
    labels = rng.integers(0, 3, len(vectors))
    labels[:120] = 1
    rows = [(int(i) * 3, [float(x) for x in v], int(label)) for i, v, label in zip(rng.permutation(len(vectors)), vectors, labels, strict=True)]
    got = sorted(map(tuple, lattice.near_duplicates(frame(spark, rows).repartition(4), cell=cell).collect()))
    want = sorted(by_hand(rows))
    assert sum(n for _, n, *_ in want) > 1000
    found = sum(n for _, n, *_ in got) / sum(n for _, n, *_ in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True)), "a link that is none, or one counted twice"
    assert found > 0.998
    # without near-threshold pairs nothing is missed
    tight = [r for r in rows if r[2] == 1][:120]
    assert sorted(map(tuple, lattice.near_duplicates(frame(spark, tight), cell=cell).collect())) == sorted(by_hand(tight))


def test_pairs_at_the_threshold_are_found(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    for cosine, least in ((0.931, 0.99), (0.929, None)):
        both = np.stack([a, cosine * a + np.sqrt(1 - cosine**2) * b], 1).reshape(-1, 64)
        table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(both)], "vec_id long, embedding array<double>, label int")
        linked = lattice.near_duplicates(table).filter("n_links > 0").count() / len(both)
        assert linked == 0 if least is None else linked >= least


def test_odd_rows(spark):
    rng = np.random.default_rng(7)
    v = [float(x) for x in rng.normal(size=12)]
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, [2 * x for x in v], 0), (4, v, 1), (5, v, None), (None, v, 0), (6, None, 0), (7, [0.0] * 12, 0),
        (8, [float("nan"), *v[1:]], 0), (9, [float("inf"), *v[1:]], 0), (10, [None, *v[1:]], 0), (11, [], 0), (12, v + [0.0, 0.0], 0),
        (13, v[:1], 0), (14, [-x for x in v], 0), (None, [1.0, -1.0], 2), (None, [1.0, -1.0], 2), (15, [1e-30] * 3, 3), (16, [1e30] * 3, 3), (17, [-0.0, 1.0], 4), (18, [0.0, 1.0], 4),
    ]
    table = frame(spark, rows)
    extra = table.selectExpr("*", *(f"-7 AS {name}" for name in sorted({*CLASHING, "node", "keys", "a", "b", "n", "h", "g", "links", "least", "key"} - {"label"})))
    got = sorted(map(tuple, lattice.near_duplicates(extra).collect()), key=key)
    assert got == sorted(by_hand(rows), key=key)
    for none in (table.limit(0), table.filter("vec_id = 6")):
        found = lattice.near_duplicates(none)
        assert found.columns == ["vec_id", "n_links", "component_id", "kept"] and found.count() == none.count()


def test_points_of_the_lattice():
    rng = np.random.default_rng(8)
    roots = lattice.shortest()
    assert len(np.unique(roots, axis=0)) == 240 and np.allclose((roots**2).sum(1), 2)
    x = rng.uniform(-3, 3, (2000, 8))
    point = lattice.nearest(x)
    doubled = np.rint(2 * point).astype(int)
    assert np.allclose(doubled, 2 * point) and ((doubled % 2 == doubled[:, :1] % 2).all(1)).all() and (point.sum(1) % 2 == 0).all()
    away = ((x - point) ** 2).sum(1)
    assert away.max() <= 1 + 1e-9  # the covering radius
    assert all((((x - point - root) ** 2).sum(1) >= away - 1e-9).all() for root in roots)


def test_sql_agrees(spark):
    rng = np.random.default_rng(9)
    vectors = clustered(rng, 5, 12, 0.1)
    table = spark.createDataFrame([(i, v.tolist(), i % 2 if i % 7 else None) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    got = lattice.near_duplicates(table)
    con = duckdb.connect()
    con.register("embeddings", table.toPandas())
    want = con.sql(f"select {', '.join(got.columns)} from ({lattice.oracle_sql()})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(r[1] for r in want)
