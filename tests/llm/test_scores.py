import os
import random
import zlib

import numpy as np
import pytest

from towertrace.llm import quality as Q
from towertrace.llm import toxicity as T
from towertrace.llm.gru import Network, Words
from towertrace.llm.labelled import held_out, training_rows
from towertrace.llm.queries import op9_toxicity, op10_quality

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_gradients_equal_differences():
    net = Network(size=4, states=3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = Words(["aa", "bcd", "é", "toxic", "x"])
    index = np.array([[0, 1, 2, 3], [4, 1, -1, -1], [3, 3, 3, -1]])
    target, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = 1 / (1 + np.exp(-net.logits(net.projected(words), index).astype(float)))
        return -(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() / weight.sum()

    g = net.gradients(words, index, target, weight)
    rnd = np.random.default_rng(0)
    for name, value in net.p.items():
        rows = {"word": words.word, "char": words.char}.get(name)
        for _ in range(6):
            at = tuple(rnd.integers(0, n) for n in value.shape)
            if rows is not None:
                at = (int(rnd.choice(rows)), at[1])
            keep, eps = value[at], 1e-4
            value[at] = keep + eps
            up = loss()
            value[at] = keep - eps
            down = loss()
            value[at] = keep
            assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-3, name


@pytest.mark.parametrize("n", [0, 1, T.WINDOW - 1, T.WINDOW, T.WINDOW + 1, 3 * T.WINDOW + 5])
def test_windows_overlap_and_cover(n):
    w = T.windows(np.arange(n))
    assert set(w[w >= 0].tolist()) == set(range(n))
    starts = T.window_starts(n)
    assert all(b - a < T.WINDOW for a, b in zip(starts, starts[1:]))


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    bad = [stem + end for stem in ("zorku", "vaxi") for end in ("ta", "no", "sk", "mel", "ur", "pi")]
    rows = []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 150))]
        toxic, good = rnd.random() < 0.35, rnd.random() < 0.8
        if toxic:
            for _ in range(2 + len(text) // 25):
                text.insert(rnd.randint(0, len(text)), rnd.choice(bad))
        text = " ".join(text) if good else rnd.choice([" | ".join(text), " ".join(w + "###" for w in text), " ".join(text).upper()])
        rows.append((i, text, int(good), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("scores")
    rows = corpus()
    extra = [(1000, None), (1001, ""), (1002, " \n"), (1003, "123 ### !!"), (None, "abc def"), (1004, "word " * 30000)]
    spark.createDataFrame([(i, t, None, "s", None) for i, t, _, _ in rows] + [(i, t, None, None, None) for i, t in extra], DOCS
                          ).write.parquet(str(top / "documents.parquet"))
    spark.createDataFrame([(i, q, x) for i, _, q, x in rows] + [(5000, 1, 1), (None, 1, 1), (1, None, None)],
                          "doc_id bigint, quality int, toxic int").write.parquet(str(top / "labels.parquet"))
    return str(top), rows


@pytest.mark.parametrize("query,label,least,threshold", [(op9_toxicity, 3, 0.9, 0.7), (op10_quality, 2, 0.95, 0.5)])
def test_held_out_accuracy_and_contract(spark, tables, query, label, least, threshold):
    top, rows = tables
    got = query(spark, top).collect()
    assert len(got) == len(rows) + 6
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    by = {r.doc_id: r for r in got}
    out = [(by[row[0]], row[label]) for row in rows if by[row[0]].held_out]
    assert sum(r.predicted == y for r, y in out) / len(out) >= least


def test_training_rows_are_bounded_and_of_the_training_folds(spark, tables):
    top, rows = tables
    docs, labels = spark.read.parquet(f"{top}/documents.parquet"), spark.read.parquet(f"{top}/labels.parquet")
    texts = training_rows(docs, labels, "toxic", 1, 10)
    assert len(texts) == 10 and texts == training_rows(docs.repartition(7), labels, "toxic", 1, 10)
    seen = {t for i, t, _, x in rows if x and zlib.crc32(str(i).encode()) % 3 != 1}
    assert set(texts) <= seen
    assert not [r for r in docs.select(held_out(docs["doc_id"]).alias("h")).collect() if r.h is None]


def test_nothing_to_learn_from(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert T.fit(docs, none) is None and Q.fit(docs, none) is None
    kept = T.drop_toxic(docs.withColumnRenamed("lang", "score"), None)
    assert kept.count() == docs.count() and "score" in kept.columns
    empty = docs.where("false")
    assert T.scored(empty, None).count() == 0 and Q.scored(empty, None).count() == 0


def test_prior_estimate():
    rnd = np.random.default_rng(2)
    good = rnd.normal(0, 1, (1500, 6)).astype(np.float32)
    mixed = np.concatenate([rnd.normal(0, 1, (1400, 6)), rnd.normal(4, 1, (600, 6))]).astype(np.float32)
    assert abs(Q.estimate_prior(good, rnd.permutation(mixed)) - 0.7) < 0.06


def plain_score(model, text):
    """The score word by word and window by window."""
    p, h = model.network.p, model.network.states
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    words = T.words_of((text or "").lower())
    best = None
    step, last = T.STRIDE, max(0, len(words) - T.WINDOW)
    for start in sorted({*range(0, last, step), last}) if words else ():
        inputs = []
        for w in words[start:start + T.WINDOW]:
            one = Words([w])
            inputs.append(p["word"][one.word[0]] + np.mean([p["char"][c] for c in one.char], axis=0))
        both = []
        for way, order in (("f", range(len(inputs))), ("b", range(len(inputs) - 1, -1, -1))):
            state, states = np.zeros(h), {}
            for t in order:
                x = inputs[t] @ p[f"in_{way}"] + p[f"b_{way}"]
                zr = sigmoid(x[:2 * h] + state @ p[f"gate_{way}"])
                new = np.tanh(x[2 * h:] + (zr[h:] * state) @ p[f"new_{way}"])
                state = (1 - zr[:h]) * state + zr[:h] * new
                states[t] = state
            both.append([states[t] for t in range(len(inputs))])
        both = [np.concatenate(x) for x in zip(*both)]
        weight = np.exp([b @ p["attend"] for b in both])
        pooled = sum(w * b for w, b in zip(weight / weight.sum(), both))
        logit = pooled @ p["out"] + p["bias"][0]
        best = logit if best is None else max(best, logit)
    return sigmoid(model.slope * (model.none if best is None else best) + model.offset)


def test_scores_equal_a_plain_network():
    rnd = random.Random(6)
    model = T.Model(Network(size=5, states=4, seed=3), 1.7, -0.2, -2.5)
    some = ["".join(rnd.choice("abcdéfg") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    texts = [None, "", "1 2", "Word", "a  b\nC!", *(" ".join(rnd.choices(some, k=n)) for n in (3, 47, 48, 49, 79, 80, 81, 200))]
    assert np.allclose(model.scores(texts), [plain_score(model, t) for t in texts], atol=2e-5)
    assert np.allclose(model.scores(texts[::-1])[::-1], model.scores(texts), atol=1e-6)


def test_scoring_holds_one_word_table_and_no_pandas():
    import subprocess
    import sys

    table = T.WordTable(Network(size=5, states=4, seed=3), most=40)
    held = table.gates
    words = [f"w{i}" for i in range(90)]
    for at in range(0, 90, 9):  # 9, 18, ... 45 words, then emptied
        rows = table.rows([words[at : at + 9], words[at : at + 3]])
        assert rows[1].tolist() == rows[0][:3].tolist()
        assert np.array_equal(table.gates[rows[0]], table.network.projected(Words(words[at : at + 9])))
        assert at > 27 or table.gates is held
    more = table.rows([words])[0]
    assert np.array_equal(table.gates[more], table.network.projected(Words(words)))
    code = "import sys, towertrace.llm.toxicity; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0


def test_scores_do_not_depend_on_the_batch(spark, monkeypatch):
    model = T.Model(Network(size=5, states=4, seed=3), 1.7, -0.2, -2.5)
    rows = [(i, None if i % 50 == 7 else " ".join(["word", "other", f"x{i}"] * (i % 40)), "l", "s", None) for i in range(300)]
    rows.append((300, "word other " * 200_000, "l", "s", None))
    monkeypatch.setattr(T, "MOST_AT_ONCE", 1 << 12)
    got = {r.doc_id: r.score for r in T.scored(spark.createDataFrame(rows, DOCS).coalesce(1), model, "score").collect()}
    assert len(got) == 301
    assert np.allclose([got[i] for i, *_ in rows[:300]], model.scores([t for _, t, *_ in rows[:300]]), atol=1e-5)
    assert abs(got[300] - model.scores([rows[300][1]])[0]) < 1e-5
