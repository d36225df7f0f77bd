import hashlib
import re

from towertrace.llm import exact

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    return {(i, t): (min(g)[1], len(g), hashlib.sha256(k.encode()).hexdigest())
            for k, g in groups.items() for i, t in rows if re.sub(r"[\x20\x09-\x0D]", "", t or "") == k}


ROWS = [(1, "a b"), (2, "ab"), (3, "a\tb "), (4, " a\x0bb"), (5, None), (6, ""), (7, " \n"), (8, "a\xa0b"), (9, "AB"),
        (10, "é" * 70000), (11, "é " * 70000)]


def test_decisions_equal_brute_force(spark):
    got = exact.decisions(frame(spark, ROWS)).selectExpr(
        "doc_id", "keep_id", "group_size", "kept", "lower(hex(digest)) h").collect()
    want = brute(ROWS)
    assert {r.doc_id: (r.keep_id, r.group_size, r.h) for r in got} == {i: v for (i, _), v in want.items()}
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_index_grows_batch_by_batch(spark):
    index = exact.DigestIndex.fresh(spark, buckets=4)
    first = index.add(frame(spark, ROWS[:4])).collect()
    assert {r.keep_id for r in first} == {3}
    second = {r.doc_id: r for r in index.add(frame(spark, [(20, "ab"), (21, "new"), (22, "n ew")])).collect()}
    assert (second[20].keep_id, second[20].kept, second[20].group_size) == (3, False, 5)
    assert (second[21].keep_id, second[22].kept) == (22, True)
    assert index.rows().count() == 2
    plan = index.unseen(index.rows().groupBy("digest").count())._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "SortMergeJoin" in plan


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    rows = [*ROWS, (3, "a\tb "), (3, "other"), (None, "null id"), (None, "null id")]
    df = frame(spark, rows).withColumnRenamed("lang", "digest").withColumnRenamed("source", "kept")
    kept = exact.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.select("doc_id", "text").collect()) == sorted(
        [(3, "a\tb "), (3, "other"), (0, "null id"), (7, " \n"), (8, "a\xa0b"), (9, "AB"), (11, "é " * 70000)])


def test_empty_table(spark):
    assert exact.decisions(frame(spark, [])).count() == 0
    assert exact.drop_copies(frame(spark, [])).count() == 0


def test_first_batch_is_decided_by_the_index(spark, monkeypatch):
    asked = []
    unseen = exact.DigestIndex.unseen
    monkeypatch.setattr(exact.DigestIndex, "unseen", lambda self, b: asked.append((self.exists(), unseen(self, b))) or asked[-1][1])
    rows = exact.decisions(frame(spark, ROWS)).collect()
    assert len(rows) == len(ROWS) and [x for x, _ in asked] == [True]
    assert "LeftAnti" in asked[0][1]._jdf.queryExecution().toString()


def test_batch_added_again(spark):
    """A job that was lost after the append decides the same when it runs again."""
    index = exact.DigestIndex.fresh(spark, buckets=4)
    index.add(frame(spark, [(100, "abc"), (101, "old")]), batch_id="one").collect()
    batch = [(1, "a b"), (2, "ab"), (3, "old"), (4, "x"), (5, "abc")]
    first = sorted(map(tuple, index.add(frame(spark, batch), batch_id="two").collect()))
    size = index.rows().count()
    assert sorted(map(tuple, index.add(frame(spark, batch), batch_id="two").collect())) == first
    assert index.rows().count() == size
    assert [r[0] for r in first if r[-1]] == [1, 4]
    # under another name the same rows are copies
    assert not any(r.kept for r in index.add(frame(spark, batch), batch_id="three").collect())


def test_query_leaves_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    rows = exact.decisions(frame(spark, ROWS))
    assert {t.name for t in spark.catalog.listTables()} == before
    assert rows.count() == len(ROWS)


def test_choice_among_repeated_rows_and_columns_of_ours(spark):
    rows = [(1, "same", k, h) for k, h in [(5, "b"), (3, "z"), (3, "a"), (9, "c")]] + [(2, "other", 1, "x"), (3, "sa me", 0, "y")]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string, n int, __h string").repartition(parts)
        kept = exact.drop_copies(df)
        assert kept.columns == ["doc_id", "text", "n", "__h"]
        assert sorted(map(tuple, kept.collect())) == [(2, "other", 1, "x"), (3, "sa me", 0, "y")]
    df = spark.createDataFrame(rows[:5], "doc_id long, text string, n int, __h string").repartition(3)
    assert sorted(map(tuple, exact.drop_copies(df).collect())) == [(1, "same", 3, "a"), (2, "other", 1, "x")]
