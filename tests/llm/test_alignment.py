import hashlib
import random

import numpy as np
import pytest

import public_tokenizers
from towertrace.llm import alignment
from towertrace.llm.alignment import Csr

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(A, B)


def spans(ids, bytes_of):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(bytes_of[i])))
        at += len(bytes_of[i])
    return out


def encoded(t, text):
    """Ids of a whole text, with no cutting."""
    if not text:
        return None
    a = t.a.encode(" " + text, add_special_tokens=False).ids
    b = t.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(t.a_bytes[i] for i in a) != whole or b"".join(t.b_bytes[i] for i in b) != whole:
        return None
    return a, b


def plain(t, texts):
    """The digest columns token by token."""
    docs, counts = [], {}
    for text in texts:
        got = encoded(t, text)
        if got is None:
            docs.append(None)
            continue
        a, b = got
        sa, sb = spans(a, t.a_bytes), spans(b, t.b_bytes)
        links = [(i, j) for i, (s, e) in enumerate(sa) for j, (u, v) in enumerate(sb) if max(s, u) < min(e, v)]
        for p in {(a[i], b[j]) for i, j in links}:
            counts[p] = counts.get(p, 0) + 1
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, first = [], 0
        for end in ends:
            groups.append(([a[i] for i, (s, e) in enumerate(sa) if first < e <= end],
                           [b[j] for j, (s, e) in enumerate(sb) if first < e <= end]))
            first = end
        docs.append((a, b, links, groups))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(n, best.get(x, 0))
    rows = []
    for d in docs:
        if d is None:
            rows.append((0,) * 7 + ("",))
            continue
        a, b, links, groups = d
        ns = [counts[a[i], b[j]] for i, j in links]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(len(x) * len(y) for x, y in groups),
                     sum(n == best[a[i]] for n, (i, _) in zip(ns, links)), sum(ns), hashlib.sha256(text.encode()).hexdigest()))
    return rows


def texts(seed, n=60):
    rnd = random.Random(seed)
    bits = ["the", "Straße", "naïve", "don't", "'s", "word", "x\ny", "\t", "  ", "   a", "12 345", "日本語", "🙂", "é", "é",
            "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "(see", "end).", "-", "--", " ", "ſ", "ẞ", "\x00", "ÿ", "×",
            "https://a.b/c?d=e", "ааб", "ñ", "\r\n", " ", "A.B", "!", "a  b", ".,;"]
    out = [None, "", " ", "  x", "x ", "▁", "a ▁b", "\n", "Hello", "same text here", "same text here", "<|endoftext|>"]
    for _ in range(n):
        out.append("".join(rnd.choice(bits) + rnd.choice(["", " ", " ", " ", "  "]) for _ in range(rnd.randrange(30))))
    return out


@pytest.mark.parametrize("most_pairs", [2_000_000, 100])
def test_against_plain_version(spark, tokenizers, most_pairs):
    rows = texts(1)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(rows)] + [(3, "Hello", 2, "y"), (None, "the word", 3, "z")],
                                  "doc_id long, text string, n_best int, a string").repartition(3)
    got = alignment.aligned(frame, A, B, most_pairs).collect()
    want = plain(tokenizers, [*rows, "Hello", "the word"])
    ids = [*range(len(rows)), 3, None]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r["doc_id"], *(r[c] for c in COLUMNS)) for r in got], key=key) == sorted(
        [(i, *w) for i, w in zip(ids, want)], key=key)
    assert sum(w[0] > 0 for w in want) > 40


def test_segments_encode_like_whole_texts(tokenizers):
    for text in texts(2, 300):
        whole = encoded(tokenizers, text)
        if whole is None:
            continue
        for size in (5, 1 << 20):
            a, b = [], []
            for part in alignment.pieces(text, size):
                for x, y in zip(*tokenizers.encode(alignment.SAFE.split(part))):
                    a += x
                    b += y
            assert (a, b) == tuple(whole), text


def test_joined_words_encode_like_whole_texts(tokenizers):
    """The joined way of the memo, on segments of every kind."""
    fresh = list(dict.fromkeys(x for text in texts(3, 200) if text for x in alignment.SAFE.split(text)))
    words = [x for x in fresh if alignment.WORDS.fullmatch(x)]
    assert 30 < len(words) < len(fresh)
    good, ids_a, count_a, ids_b, count_b = alignment.Segments(tokenizers)._encode_words(words)
    a, b = tokenizers.encode(words)
    assert list(good) == list(range(len(words)))
    assert ids_a.tolist() == sum(a, []) and count_a.tolist() == list(map(len, a))
    assert ids_b.tolist() == sum(b, []) and count_b.tolist() == list(map(len, b))


def test_real_texts_cut_like_whole(spark, tokenizers):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).toPandas()["text"]
    for text in rows:
        text = text[:4000]
        whole = encoded(tokenizers, text)
        a, b = (sum(x, []) for x in tokenizers.encode(alignment.SAFE.split(text)))
        assert (a, b) == tuple(whole)


def test_empty_table_and_long_text(spark, tokenizers, monkeypatch):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
    words = ["alpha", "beta,", "Gamma", "delta."]
    text = " ".join(random.Random(1).choices(words, k=300_000))  # more than a piece
    row = alignment.aligned(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).first()
    a, b = encoded(tokenizers, text)
    assert (row["n_a"], row["n_b"]) == (len(a), len(b))
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"] == row["count_sum"]


def test_memo_is_emptied(tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "MOST_SEGMENTS", 20)
    held = alignment.Segments(tokenizers)
    for k in range(6):
        words = [f"word{k}{i}" for i in range(15)]
        held.learn(words)
        assert len(held.number) <= 35 and all(w in held.number for w in words)


def test_products_are_matrix_products():
    rng = np.random.default_rng(1)
    for step in (1, 7, 1 << 18):
        x, y = rng.integers(0, 3, (9, 14)), rng.integers(0, 3, (14, 6))
        sparse = []
        for m in (x, y):
            r, c = np.nonzero(m)
            sparse.append(Csr(np.concatenate(([0], np.cumsum((m != 0).sum(axis=1)))), c, m.shape[1], m[r, c]))
        dense = np.zeros((9, 6), int)
        for r, c, v in sparse[0].products(sparse[1], step):
            dense[r, c] += v
        assert (dense == x @ y).all()
        back = sparse[0].transposed().transposed()
        assert (back.starts == sparse[0].starts).all() and (back.columns == sparse[0].columns).all()


def test_shared_links_and_alignment_table(spark, tokenizers):
    text = "unbelievable Straßenbahn 日本語 don't"
    a, b = encoded(tokenizers, text)
    one = alignment.Alignment(tokenizers, np.array(a), np.array(b))
    pairs = {(int(i), int(j)) for rows, columns in one.shared_links() for i, j in zip(rows, columns)}
    ga, gb = one.group_a.starts.tolist(), one.group_b.starts.tolist()
    assert pairs == {(i, j) for g in range(len(ga) - 1) for i in range(ga[g], ga[g + 1]) for j in range(gb[g], gb[g + 1])}
    assert len(pairs) == int(one.shared_sizes().sum())
    row = alignment.alignments(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), A, B).orderBy("doc_id").collect()
    assert row[0]["a"] == a and row[0]["b"] == b and row[1]["a"] == []
    sa, sb = spans(a, tokenizers.a_bytes), spans(b, tokenizers.b_bytes)
    assert [(x["a"], x["b"], x["bytes"]) for x in row[0]["links"]] == [
        (i, j, min(e, v) - max(s, u)) for i, (s, e) in enumerate(sa) for j, (u, v) in enumerate(sb) if max(s, u) < min(e, v)]
