import math

import numpy as np
import pytest

from towertrace.llm import neighbours
from towertrace.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=20, every=20):
    """{(query id, its vector): [(id, score)]} by all products."""
    live = sorted({(i, tuple(v)) for i, v in rows if i is not None and v
                   and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = {}
    for q, a in live:
        if q % every:
            continue
        close = []
        for i, b in live:
            if (i, b) != (q, a) and len(a) == len(b):
                s = 0.0
                for x, y in zip(a, b):
                    s += float(np.float64(x) * np.float64(y))
                close.append((i, s))
        out.setdefault(q, []).extend(sorted(close, key=lambda x: (-x[1], x[0]))[:k])
    return out


def ours(frame, **more):
    got = {}
    for r in sorted(neighbours.nearest_neighbours(frame, **more).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return got


def f32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_everything_verified_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    rows += [(200 + i, [1.0, 2, 0, 0, 0, -1]) for i in range(60)]          # a group of copies, queries among them
    rows += [(300, [0.0] * 6), (320, None), (340, []), (360, [1.0, None, 0, 0, 0, 0]), (380, [float("nan")] * 6),
             (400, [float("inf"), 0, 0, 0, 0, 0]), (None, [1.0] * 6), (20, rows[20][1]), (20, rows[20][1])]
    rows += [(500 + i, rng.normal(size=3).tolist()) for i in range(21)]      # another length
    rows += [(1000, [9.0, -9.0])]                                            # no candidate at all
    rows = f32(rows)
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA + ", node string").repartition(3)
    expected = {q: v for q, v in plain(rows).items() if v}
    assert ours(frame, verify=1.0, block=50) == expected


def test_id_with_two_vectors(spark):
    rows = f32([(20, [1.0, 0]), (20, [0.9, 0.1]), (1, [1.0, 1]), (2, [0.0, 1])])
    got = neighbours.nearest_neighbours(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in got) == sorted(
        (q, i, s) for q, v in plain(rows).items() for i, s in v)
    assert sum(r["vec_id"] == 20 for r in got) == 2


def test_few_rows_and_empty_tables(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == {}
    assert ours(spark.createDataFrame([(20, [1.0], 0)], SCHEMA)) == {}
    assert ours(spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0)], SCHEMA)) == {}
    assert ours(spark.createDataFrame([(0, [1.0], 0), (2, [2.0], 0)], SCHEMA)) == {0: [(2, 2.0)]}


@pytest.mark.parametrize("scaled", [False, True])
def test_recall(spark, scaled):
    """Uniform directions (the hardest case) of one or of many lengths."""
    rng = np.random.default_rng(2)
    v = rng.normal(size=(6000, 32))
    v /= np.linalg.norm(v, axis=1)[:, None] / (rng.uniform(0.2, 3, 6000)[:, None] if scaled else 1)
    v = v.astype(np.float32).astype(float)
    frame = spark.createDataFrame([(i, x, 0) for i, x in enumerate(v.tolist())], SCHEMA)
    got = ours(frame, block=1500)
    assert len(got) == 300 and all(len(x) == 20 for x in got.values())
    found = 0
    for q, near in got.items():
        scores = v @ v[q]
        scores[q] = -np.inf
        found += len({i for i, _ in near} & set(np.argsort(-scores)[:20].tolist()))
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True)
        assert all(abs(s - scores[i]) < 1e-12 for i, s in near)
    assert found / (20 * len(got)) >= 0.95


def test_query_recall_on_the_table(spark):
    rows = QUERIES["op11_neighbours"](spark, "/root/testdata/sf0.01").collect()
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").toPandas()
    v, ids = np.stack(table["embedding"].to_list()).astype(float), table["vec_id"].to_numpy()
    hits = total = 0
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q in ids[ids % 20 == 0]:
        scores = v @ v[ids == q][0]
        scores[ids == q] = -np.inf
        want = set(ids[np.argsort(-scores)[:20]].tolist())
        hits, total = hits + len(want & set(got[q])), total + 20
    assert hits / total >= 0.95


@pytest.mark.parametrize("functions", [32, 300])
def test_collisions_are_those_of_the_window(functions):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 8))
    block = neighbours.Block(v, float(np.linalg.norm(v, axis=1).max()), functions, 0.7, 0.1, 1.1)
    found = block.colliding(v[5], 5)
    assert 5 in found and 40 <= len(found) < 400
    centre = block.directions[:, :-1] @ (v[5] * block.longest / np.linalg.norm(v[5]))
    rest = np.sqrt(np.maximum(block.longest ** 2 - (v ** 2).sum(axis=1), 0))
    projected = np.column_stack([v, rest]) @ block.directions.T
    radius = block.radius * block.widen ** 2 * (1 + 1e-12)
    inside = (np.abs(projected - centre) <= radius).sum(axis=1)
    assert set(np.flatnonzero(inside >= block.threshold)) == set(found)
