"""Exact dedup with a persistent digest index.

The index is a table bucketed and sorted by digest.  A batch of documents is
reduced to one row per digest (partial aggregation first, so a digest shared
by a third of all rows is a few rows per task when it is shuffled), and the
digests the index does not hold yet are found by a sort-merge anti join whose
index side needs no shuffle.  Those rows are appended.  All expressions are
built-in SQL functions.

Defined results
---------------
* A null text counts as empty; all empty texts form one group.
* Ties in length are broken by the smallest id, a null id coming last.
* Rows that repeat both id and text each get a decision row; `drop_copies`
  keeps the one whose columns are smallest, written as JSON.
* A batch that is added again under its name (a job that was lost after the
  append) gets the same decisions, and nothing is appended.
* An empty batch appends nothing and gives an empty result.
* Further columns, whatever their names, are not read; `drop_copies` returns
  them unchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut

#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


class DigestIndex:
    """A digest table `(digest, keep_id, n_chars, group_rows, batch)`.

    `table` names a catalog table; the first `add` creates it, empty.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = 32):
        self.spark, self.table, self.buckets = spark, table, buckets

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int = 32) -> "DigestIndex":
        return cls(spark, f"digest_index_{uuid.uuid4().hex}", buckets)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _append(self, groups: DataFrame) -> None:
        (groups.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of `batch`, one per digest, whose digest the index lacks."""
        held = self.rows().select("digest").hint("merge")
        return batch.hint("merge").join(held, "digest", "left_anti")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batch_id: str | None = None) -> DataFrame:
        """Deduplicate a batch against the index and itself; append what is new.
        `batch_id` names the batch, so that it may be added again.

        Returns one row per input row: `doc_id, text_hash, digest, n_chars,
        keep_id, group_size, kept`.  `keep_id` is the row that stays: the
        indexed one if the digest was known before this batch, else the
        batch row with the longest original text, then the smallest id.
        `group_size` counts the group's rows in the batch that brought the
        digest, plus this batch's rows when it was known before.
        `text_hash` tells rows with one id and different texts apart.
        """
        whole = F.coalesce(F.col(text), F.lit(""))
        rows = cut(docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(whole).alias("text_hash"),
            F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"),
            F.char_length(whole).alias("n_chars")), "digests")
        # One row per (digest, length) first: hash aggregation with a partial
        # step, whatever the size of a group.
        per_length = rows.groupBy("digest", "n_chars").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        # ~id falls as id grows and cannot overflow; a null id ranks lowest.
        best = F.max(F.struct("n_chars", F.bitwise_not("keep_id").alias("rank")))
        batch = (per_length.groupBy("digest")
                 .agg(best.alias("best"), F.sum("n").alias("group_rows"))
                 .select("digest", F.bitwise_not("best.rank").alias("keep_id"),
                         F.col("best.n_chars").alias("n_chars"), "group_rows"))
        own = batch_id or uuid.uuid4().hex
        columns = ["digest", "keep_id", "n_chars", "group_rows", "batch"]
        batch = cut(batch.withColumn("batch", F.lit(own)).select(*columns), "digests-batch")
        if not self.exists():
            self._append(batch.where(F.lit(False)))
        self._append(cut(self.unseen(batch).select(*columns), "digests-new"))
        # The index decides; rows of this batch add to a group that another
        # batch brought.
        mine = F.col("batch") == own
        groups = cut(batch.select("digest", F.col("group_rows").alias("more")).join(self.rows(), "digest")
                     .select("digest", "keep_id", "n_chars", mine.alias("is_new"),
                             (F.col("group_rows") + F.when(mine, 0).otherwise(F.col("more"))).alias("group_rows")),
                     "digests-groups")
        # Plain files on both sides: adaptive execution can split the copies
        # of a hot digest over several tasks.
        groups = groups.withColumnRenamed("n_chars", "keep_chars")
        stays = (F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
                 & (F.col("n_chars") == F.col("keep_chars")))
        return rows.join(groups, "digest", "left").select(
            "doc_id", "text_hash", "digest", "n_chars", "keep_id",
            F.col("group_rows").alias("group_size"), stays.alias("kept"))


def decisions(docs: DataFrame, index: DigestIndex | None = None, batch_id: str | None = None) -> DataFrame:
    """Decision rows of one batch against `index`.  Without one a new, empty
    index is made and dropped again: the decisions are written out by then."""
    if index is not None:
        return index.add(docs, batch_id=batch_id)
    index = DigestIndex.fresh(docs.sparkSession)
    out = index.add(docs)
    index.drop()
    return out


def drop_copies(docs: DataFrame, index: DigestIndex | None = None, batch_id: str | None = None) -> DataFrame:
    """The rows of `docs` that stay, with their columns unchanged."""
    kept = cut(decisions(docs, index, batch_id).where("kept").groupBy("doc_id", "text_hash")
               .agg(F.count(F.lit(1)).alias("n")), "kept-rows")
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))

    def rows_of(some):
        return docs.join(some, docs["doc_id"].eqNullSafe(some["doc_id"]) & (text_hash == some["text_hash"]), "left_semi")

    if not kept.where("n > 1").limit(1).count():
        return rows_of(kept)
    # an id and text given more than once: one of their rows, by its columns
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = (rows_of(kept.where("n > 1")).groupBy("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
           .agg(F.min_by(whole, F.to_json(whole)).alias("row")))
    return rows_of(kept.where("n = 1")).union(one.select(*(F.col(f"row.`{c}`") for c in docs.columns)))
