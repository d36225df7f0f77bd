"""Labelled rows for the learned scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(doc_id) -> "F.Column":
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id) -> "F.Column":
    """True for the rows whose labels no model may see."""
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


#: Bytes of text that one fitting sample may hold on the driver.
MOST_BYTES = 1 << 27


def _texts(docs: DataFrame, chosen: DataFrame, most: int, salt: int) -> list[str]:
    """Texts of up to `most` rows, different in id or text, that have a chosen
    id, in the order of the salted hash of the id; a text that does not fit
    into what is left of MOST_BYTES is passed over.

    Sizes are looked at first, so no text beyond the bound is collected.
    """
    whole = F.coalesce("text", F.lit(""))
    rows = (docs.select(F.col("doc_id").alias("id"), whole.alias("text"), F.xxhash64(whole).alias("text_hash"))
            .join(F.broadcast(chosen), F.col("id") == F.col("doc_id")).drop("doc_id"))
    sizes = (rows.groupBy("id", "text_hash").agg(F.max(F.octet_length("text")).alias("n"))
             .orderBy(F.xxhash64("id", F.lit(salt)), "id", "text_hash").limit(most).collect())
    left, wanted = MOST_BYTES, []
    for r in sizes:
        if r.n <= left:
            left -= r.n
            wanted.append((r.id, r.text_hash))
    if not wanted:
        return []
    kind = docs.schema["doc_id"].dataType.simpleString()
    keys = docs.sparkSession.createDataFrame(wanted, f"id {kind}, text_hash bigint")
    found = (rows.join(F.broadcast(keys), ["id", "text_hash"]).groupBy("id", "text_hash")
             .agg(F.min("text").alias("text")).collect())
    return [r.text for r in sorted(found, key=lambda r: (r.id, r.text))]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, value: int, most: int) -> list[str]:
    """Texts of up to `most` labelled rows of the training folds with
    `label = value`, the same ones on every run: those with the smallest hash
    of the id.  `most` is the documented bound of the sample.

    The ids are chosen first, in the small label table; only their texts
    travel.  Rows without a label or an id are no training rows.
    """
    doc = labels["doc_id"]
    chosen = (labels.where((F.col(label) == value) & doc.isNotNull() & ~held_out(doc))
              .select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return _texts(docs, chosen, most, 0)


def corpus_sample(docs: DataFrame, most: int, salt: int = 0) -> list[str]:
    """Up to `most` texts of the whole corpus, the rows with the smallest
    salted hash of the id; labels play no part."""
    chosen = (docs.where("doc_id IS NOT NULL").select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id", F.lit(salt)), "doc_id").limit(most))
    return _texts(docs, chosen, most, salt)
