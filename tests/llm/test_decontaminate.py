import random
import re
from itertools import combinations

from towertrace.llm import decontaminate as D

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ITEMS = "item_id bigint, text string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], DOCS)


def items(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(rows, bench, window=20, similarity=0.8, min_tokens=5):
    """Every alignment, every window that holds a seed match."""
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in D.MASKS]
    longest = max(map(len, D.MASKS))
    out = {}
    for d, text in rows:
        w = words(text)
        for item, t in ((i, words(x)) for i, x in bench):
            if len(t) < min_tokens:
                continue
            for offs in masks if len(t) >= longest else [list(range(len(t)))]:
                span = offs[-1] + 1
                for p in range(len(t) - span + 1):
                    for q in range(len(w) - span + 1):
                        if any(w[q + o] != t[p + o] for o in offs):
                            continue
                        n = min(window, len(t))
                        for s in range(max(0, p + span - n), min(p, len(t) - n) + 1):
                            same = sum(0 <= s + k + q - p < len(w) and t[s + k] == w[s + k + q - p] for k in range(n))
                            if same / n >= similarity:
                                out[d, item] = max(out.get((d, item), 0), same / n)
    return out


def test_substituted_passages_equal_brute_force(spark):
    rnd = random.Random(2)
    vocab = [f"wörd{i}" for i in range(40)]
    bench = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([3, 5, 8, 9, 15, 30, 50])))) for i in range(25)]
    bench += [(50, bench[4][1]), (51, None), (52, "")]
    rows = []
    for d in range(120):
        w = rnd.choices(vocab, k=rnd.randint(0, 80))
        if d % 2:
            part = words(rnd.choice(bench)[1])
            for _ in range(rnd.randint(0, max(1, len(part) // 4))):
                if part:
                    part[rnd.randrange(len(part))] = "other"
            at = rnd.randint(0, len(w))
            w[at:at] = part
        rows.append((d, "  «" + rnd.choice([" ", ", ", "\n"]).join(w).upper() + "» "))
    want = brute(rows, bench)
    assert want
    for limit in (1_000_000, 50):  # one pass, several passes
        found = D.find_overlaps(docs(spark, rows), items(spark, bench), broadcast_rows=limit)
        got = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_drop_keeps_clean_documents_and_columns(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, f"x y {item} z"), (2, "nothing here"), (None, item), (4, None), (5, ""), (1, f"x y {item} z")]
    df = docs(spark, rows).withColumnRenamed("lang", "item_id").withColumnRenamed("source", "seed")
    kept = D.drop_contaminated(df, items(spark, [(1, item), (1, item), (None, item)]))
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 4, 5]
    first = D.find_overlaps(df.where("doc_id = 1"), items(spark, [(1, item)])).first()
    assert (first.similarity, first.first_token) == (1.0, 2)


def test_empty_tables(spark):
    none = items(spark, [])
    some = docs(spark, [(1, "a b c d e f g h i j")])
    assert D.find_overlaps(some, none).count() == 0
    assert D.drop_contaminated(some, none).count() == 1
    assert D.find_overlaps(docs(spark, []), items(spark, [(1, "a b c d e f g h i j")])).count() == 0


def test_item_without_an_id_is_found(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    df = docs(spark, [(1, f"x {item} y"), (2, "nothing here")])
    found = D.find_overlaps(df, items(spark, [(None, item), (7, item)])).collect()
    assert sorted((r.doc_id, r.item_id or 0, r.similarity) for r in found) == [(1, 0, 1.0), (1, 7, 1.0)]
    assert [r.doc_id for r in D.drop_contaminated(df, items(spark, [(None, item)])).collect()] == [2]


def test_one_substitution_in_short_items_and_two_in_ten(spark):
    rows, bench = [], []
    for n in (5, 6, 7, 8, 10, 11, 15):
        text = [f"i{n}w{k}" for k in range(n)]
        bench.append((n, " ".join(text)))
        for gone in combinations(range(n), n * 2 // 10):
            part = [("other" if k in gone else w) for k, w in enumerate(text)]
            rows.append((len(rows), " ".join(["a", *part, "b"]), n))
    found = D.find_overlaps(docs(spark, [r[:2] for r in rows]), items(spark, bench), short_gaps=True).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(d, n) for d, _, n in rows}


def test_passages_across_pieces_equal_brute_force(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(12)]
    bench = [(i, " ".join(rnd.choices(vocab, k=n))) for i, n in enumerate((5, 8, 9, 12, 20, 33))]
    rows = [(d, " ".join(rnd.choices(vocab, k=d % 50) + words(rnd.choice(bench)[1]) + rnd.choices(vocab, k=d % 7)))
            for d in range(60)]
    want = brute(rows, bench)
    assert want
    whole = {(r.doc_id, r.item_id): r for r in D.find_overlaps(docs(spark, rows), items(spark, bench), piece=1000).collect()}
    assert {k: r.similarity for k, r in whole.items()} == want
    for piece in (1, 7):
        assert {(r.doc_id, r.item_id): r for r in D.find_overlaps(docs(spark, rows), items(spark, bench), piece=piece).collect()} == whole


def test_long_document_with_many_passages(spark):
    """Its 80,000 tokens are not carried with each of its some 2,000 hits."""
    bench = [(i, " ".join(f"i{i}t{k}" for k in range(30))) for i in range(20)]
    parts = []
    for _, item in bench:
        parts += [f"u{len(parts)}x{k}" for k in range(4000)] + [item]
    found = D.find_overlaps(docs(spark, [(1, " ".join(parts))]), items(spark, bench)).collect()
    assert sorted((r.item_id, r.similarity, r.first_token) for r in found) == [
        (i, 1.0, 4000 * (i + 1) + 30 * i) for i in range(20)]


def test_one_text_under_many_ids_and_two_texts_under_one(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(25)) for c in "ab")
    bench = [(i, one) for i in range(40)] + [(None, one), (7, two), (99, two)]
    df = docs(spark, [(1, f"x {one} y"), (2, f"{two} x x {one}"), (3, f"{two} z")])
    for limit in (1_000_000, 20):
        found = D.find_overlaps(df, items(spark, bench), broadcast_rows=limit)
        got = sorted((r.doc_id, -1 if r.item_id is None else r.item_id, r.first_token) for r in found.collect())
        ids = [-1, *range(40)]
        assert got == sorted([(1, i, 1) for i in ids] + [(2, i, 0 if i == 7 else 27) for i in ids] + [(2, 99, 0)]
                             + [(3, 7, 0), (3, 99, 0)])


def test_ids_found_are_broadcast_up_to_a_row_count(spark):
    """By their count, not by the size of the file: the documents' texts are
    not shuffled and sorted for a few ids."""
    item = "one two three four five six seven eight nine ten eleven twelve"
    df = docs(spark, [(d, f"{d} {item}" if d % 3 else f"nothing {d}") for d in range(30)] + [(None, "none")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, join in ((1_000_000, "BroadcastHashJoin"), (19, "SortMergeJoin")):
            kept = D.drop_contaminated(df, items(spark, [(1, item)]), broadcast_rows=limit)
            plan = kept._jdf.queryExecution().sparkPlan().toString()
            assert join in plan, plan
            assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, *range(0, 30, 3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
