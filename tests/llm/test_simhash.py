import random

import pytest
from brute import components, simhash_fingerprint

from towertrace.llm import simhash
from towertrace.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA)


def texts(n=120, seed=5):
    rnd = random.Random(seed)
    words = [f"w{i}é" for i in range(60)]
    out = []
    for k in range(n):
        if out and rnd.random() < 0.6:
            base = rnd.choice(out).split(" ")
            for _ in range(rnd.randint(0, 3)):
                base[rnd.randrange(len(base))] = rnd.choice(words)
            out.append(" ".join(base))
        else:
            out.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 90))))
    return out


def test_fingerprints_equal_the_plain_ones():
    for t in [*texts(), None, "", " \n\t", "A b", "É É É É", "x " * 3000, "a\x1fb c\x0bd e f"]:
        assert simhash.fingerprint(t) % (1 << 64) == simhash_fingerprint(t), t


def expected(rows):
    f = [simhash_fingerprint(t) for _, t in rows]
    return components([i for i, _ in rows], lambda a, b: bin(f[a] ^ f[b]).count("1") <= 3)


@pytest.mark.parametrize("block", [4096, 8])
def test_groups_equal_all_pairs(spark, block, monkeypatch):
    rows = list(enumerate([*texts(), None, "", "  ", "Hello", "hello", "hello\t"]))
    random.Random(1).shuffle(rows)
    links = simhash.links
    monkeypatch.setattr(simhash, "links", lambda n, k: links(n, k, block))
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(frame(spark, rows)).collect()}
    assert got == expected(rows)


def test_dense_cell_is_connected_through_its_parts(spark):
    rnd = random.Random(3)
    base = rnd.getrandbits(63)
    bits = sorted({base ^ sum(1 << rnd.randrange(60) for _ in range(rnd.randint(0, 3))) for _ in range(300)})
    nodes = spark.createDataFrame(list(enumerate(bits)), "node bigint, fingerprint bigint")
    want = components(list(range(len(bits))), lambda a, b: bin(bits[a] ^ bits[b]).count("1") <= 3)
    for block in (4096, 32):
        got = {r.node: r.component for r in connected_components(simhash.links(nodes, 3, block)).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_edge_cases(spark):
    empty = simhash.simhash_groups(frame(spark, []))
    assert empty.count() == 0 and simhash.keep_one(frame(spark, [])).count() == 0
    df = frame(spark, [(7, "a b c d"), (7, "a b c d"), (None, "a b c d"), (9, None), (8, "")])
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.simhash_groups(df).collect())
    assert got == [(-1, None), (7, 7), (7, 7), (8, 8), (9, 8)]
    clash = df.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "fingerprint")
    kept = simhash.keep_one(clash)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 7, 7, 8]


def test_star_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_an_id_with_two_texts_is_two_rows(spark):
    one, two = (" ".join(f"{k}{i}" for i in range(40)) for k in "xy")
    df = frame(spark, [(1, one), (5, one), (5, two), (8, two)])
    kept = sorted((r.doc_id, r.text[0]) for r in simhash.keep_one(df).collect())
    assert kept == [(1, "x"), (5, "y")]
