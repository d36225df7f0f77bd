import random
import re
import zlib

import numpy as np
import pytest

from towertrace.llm import spelling


def plain(rows, min_chars=6, min_count=5, ratio=5, every=199):
    """The operator word by word, near words by comparing all pairs."""
    n = {}
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{w}".encode())
                if h % every == 0:
                    w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] = n.get(w, 0) + 1
    n = {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w in n:
        close = [v for v in n if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = [n[w], len(close), form, n.get(form)]
    for w in out:
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def ours(frame, **more):
    rows = spelling.spelling_variants(frame, **more).collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}


def documents(seed, docs=300):
    rnd = random.Random(seed)
    base = ["abcdef", "letters", "straße", "aaaaaa", "aaaaaaa", "mississippi", "ÀÉÿ×÷àé", "pneumonia" * 3, "x" * 70, "yz" * 40]
    words = list(base)
    for _ in range(5):
        for w in list(words[-60:]):
            i = rnd.randrange(len(w))
            c = rnd.choice("abcé÷z")
            words += [w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]]
    weights = [1 / (1 + k) for k in range(len(words))]
    rows = []
    for d in range(docs):
        text = rnd.choice([" ", "\n", "1", "_"]).join(
            w.title() if rnd.random() < 0.1 else w for w in rnd.choices(words, weights, k=rnd.randrange(60)))
        rows.append((d, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = documents(seed) + [(None, "letters letters"), (7, None), (8, ""), (9, "1 2 ,"), (10, "abcdef " * 400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = plain(rows, every=19)
    assert ours(frame, every=19) == expected
    assert any(v[2] for v in expected.values()) and any(v[4] != (v[2] or w) for w, v in expected.items())


def test_many_passes_and_clashing_columns(spark):
    rows = documents(3, 120)
    frame = spark.createDataFrame([(*r, "n", 1, "w") for r in rows], "doc_id long, text string, word string, n int, form string")
    expected = plain(rows)
    assert ours(frame, most_bytes=4096) == expected
    shards = spelling.layout({6: 5000, 7: 10, 64: 3}, 4096)
    assert len(shards) > 3
    held = [(s, p) for one in shards for s, (_, parts) in one.items() for p in parts]
    assert len(held) == len(set(held))


def test_empty_tables(spark):
    assert ours(spark.createDataFrame([], "doc_id long, text string")) == {}
    assert ours(spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")) == {}


def test_long_text_in_pieces():
    text = " ".join(["Wörter", "AND", "x" * 50] * 200)
    whole = [w for part in spelling.runs(text) for w in part]
    assert [w for part in spelling.runs(text, piece=37) for w in part] == whole
    assert whole[:2] == ["wörter", "and"]


def test_edit_hashes():
    words = ["aabbcc", "letter", "ÿÿÿÿÿÿ"]
    matrix = spelling.codes(words)
    for row, place, letter, hashes in spelling.replacements(matrix):
        for r, p, c, h in list(zip(row, place, letter, hashes))[::7]:
            w = words[r][:p] + chr(c) + words[r][p + 1:]
            assert spelling.word_hashes(spelling.codes([w]))[0] == h and chr(c) > words[r][p]
    seen = set()
    for row, place, hashes in spelling.deletions(matrix):
        for r, p, h in zip(row, place, hashes):
            w = words[r][:p] + words[r][p + 1:]
            assert spelling.word_hashes(spelling.codes([w]))[0] == h
            seen.add((r, w))
    assert seen == {(r, w[:i] + w[i + 1:]) for r, w in enumerate(words) for i in range(6)}


def test_filter_lets_few_others_through():
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=8)) for _ in range(5000)]
    (shards,) = spelling.layout({8: len(words)}, 1 << 20)
    _, block, value = spelling.placed(spelling.word_hashes(spelling.codes(words)), shards[8])
    bits = np.zeros(1 << 17, np.uint64)
    for k in range(spelling.PROBES):
        np.bitwise_or.at(bits, *spelling._bit(block, value, k))
    assert len(spelling.positives(bits, block, value)) == len(words)
    others = spelling.codes(["".join(rnd.choices("stuvwxyz", k=8)) for _ in range(20000)])
    _, block, value = spelling.placed(spelling.word_hashes(others), shards[8])
    assert len(spelling.positives(bits, block, value)) < 40
