import hashlib
import random

import numpy as np
import pytest

from towertrace.llm import suffix as S

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA)


def brute(texts, length):
    """Removed runs and kept bytes of each text."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            w = d[i:i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans, i = [], 0
        while i < len(d):
            if gone[i]:
                j = i
                while j < len(d) and gone[j]:
                    j += 1
                spans.append((i, j))
                i = j
            else:
                i += 1
        out.append((spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def test_suffix_array_equals_sorting():
    rnd = random.Random(1)
    for _ in range(200):
        a = [rnd.randint(1, 3) for _ in range(rnd.randint(1, 70))]
        assert S.suffix_array(np.array(a)).tolist() == sorted(range(len(a)), key=lambda i: a[i:])


def texts(seed, length):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rnd.randint(length // 6, length))) for _ in range(6)]
    out = []
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            parts.append(rnd.choice([p, p[a:], p[:a], " ".join(word() for _ in range(20)), word() * 40]))
        out.append(rnd.choice(["", " "]).join(parts))
    return out + ["ab" * 300, "x" * (length - 1), "x" * length, "y" * (length + 1), None, "", "", out[0], out[1]]


@pytest.mark.parametrize("most,few", [(2000, 10**6), (1, 0)])
def test_removed_runs_equal_brute_force(spark, most, few):
    length, gram = 40, 12
    ts = texts(most, length)
    got = {r.doc_id: r for r in S.remove_repeats(frame(spark, list(enumerate(ts))), length, gram, most, few).collect()}
    assert len(got) == len(ts)
    for i, (spans, kept) in enumerate(brute(ts, length)):
        assert [tuple(x) for x in got[i].spans] == spans, (i, ts[i])
        assert bytes(got[i].kept) == kept


def test_digests_at_production_length(spark):
    ts = texts(7, 200)
    got = {r.doc_id: r for r in S.with_digests(S.remove_repeats(frame(spark, list(enumerate(ts))))).collect()}
    for i, (spans, kept) in enumerate(brute(ts, 200)):
        n = len((ts[i] or "").encode())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (n, n - len(kept), len(spans))
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "q" * 10 + "abc" * 100), (1, "q" * 10 + "abc" * 100), (None, "z"), (None, None)]
    out = S.with_digests(S.remove_repeats(frame(spark, rows))).collect()
    assert sorted(r.n_removed for r in out) == [0, 0, 310, 310]
    assert S.remove_repeats(frame(spark, [])).count() == 0
