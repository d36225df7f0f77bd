"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased and cut into runs of letters and digits.  A mask such
as 1101011 hashes the tokens under its ones and ignores the others, so a
substituted token under a zero does not hide a match.  The hashes of all
benchmark positions are joined with those of all document positions; around
each hit the two token sequences are laid over each other, and the hit counts
when some window of `window` tokens (the whole item if it is shorter) that
holds the seed agrees in at least `similarity` of its tokens.

The join reads the documents once, without a shuffle: pieces of the token
array are exploded and hashed inside one generated loop and probe the hash
table of the benchmark side.  That side holds each different text once and is
broadcast only while it has at most `broadcast_rows` rows of about 64 bytes; a
larger benchmark is searched in as many passes of that size, one after the
other, each written before the next.  Hits leave the scan verified and reduced
to one row per (document, text) in each task; item ids are joined to these.

A task holds one document's tokens and the hits of one piece at a time: a row
of a hit carries its piece, then the tokens a window around it can reach, and
never the document.  The loop over positions hands on a hit once, whatever the
number of benchmark positions with its seed; these are joined row by row.

Items shorter than the longest mask are hashed whole or, with `short_gaps`, by
seeds that leave out one position each, which finds one substituted token;
those under `min_tokens` tokens say nothing about a document and are not
searched.

Defined results
---------------
* Null and empty texts on either side match nothing.
* Items are joined by their tokens, so an item with a null item_id is searched
  like any other and reports a null item_id.
* A repeated item reports once per item_id; a repeated document row once per
  doc_id; rows with a null id are searched as one document, and stay in
  `drop_contaminated`.
* No benchmark rows or no documents: an empty result, all documents stay.
* Other columns, whatever their names, are not read and stay unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut

#: 1: the token counts; 0: any token.
MASKS = ("1101011", "110010111", "111011", "111100101")


SEPARATORS = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits.  Text after the last token
    leaves one empty string at the end, which equals no token."""
    whole = F.lower(F.coalesce(text, F.lit("")))
    return F.split(F.regexp_replace(whole, "^" + SEPARATORS, ""), SEPARATORS)


def _seed(array: Column, at: Column, offsets: list[int], mask: int) -> Column:
    return F.xxhash64(F.lit(mask), *(F.get(array, at + o) for o in offsets))


def _masks(items: DataFrame, min_tokens: int, short_gaps: bool) -> list[tuple[int, list[int], int]]:
    """(number, offsets, exact item length or 0) of the masks in use: the
    spaced ones, and for each length below the longest mask a full one or
    those that leave out one position (the first or the last: one mask)."""
    out = [(k, [i for i, c in enumerate(m) if c == "1"], 0) for k, m in enumerate(MASKS)]
    longest = max(map(len, MASKS))
    short = items.where((F.size("t") >= min_tokens) & (F.size("t") < longest)).select(F.size("t").alias("n"))
    lengths = sorted(r.n for r in short.distinct().collect())  # at most `longest` values
    if not short_gaps:
        return out + [(len(MASKS) + n, list(range(n)), n) for n in lengths]
    gaps = [([i for i in range(n) if i != gap], n) for n in lengths for gap in range(1, n)]
    return out + [(len(MASKS) + k, offsets, n) for k, (offsets, n) in enumerate(gaps)]


#: Bytes of tokens that count as a row of `broadcast_rows`.
ROW_BYTES = 64


def _pieces(docs: DataFrame, window: int, reach: int, piece: int) -> DataFrame:
    """`(doc_id, w, start, lead, n)`: each document's tokens, `piece` positions
    at a time, `n` of them from `w[lead]` on, with what windows and seeds there
    reach into on both sides.  `w[0]` is the document's token `start`."""
    def cut_out(at: Column) -> Column:
        start = F.greatest(F.lit(0), at - (window - 1))
        return F.struct(F.slice("w", start + 1, at - start + piece + reach).alias("w"), start.alias("start"),
                        (at - start).alias("lead"), F.least(F.lit(piece), F.size("w") - at).alias("n"))

    words = docs.select("doc_id", tokens(F.col("text")).alias("w"))
    # (`outer`, here and below, only keeps Spark from tokenising twice to test
    # for emptiness.)
    starts = F.sequence(F.lit(0), F.size("w") - 1, F.lit(piece))
    return words.select("doc_id", F.explode_outer(F.transform(starts, cut_out)).alias("p")).select("doc_id", "p.*")


def _found(docs: DataFrame, items: DataFrame, window: int, similarity: float, min_tokens: int,
           broadcast_rows: int, short_gaps: bool, piece: int) -> tuple[DataFrame, DataFrame]:
    """`(doc_id, item, similarity, first_token)` of the texts found, and their
    `(item, item_id)`; `items` holds different `(item_id, t)`."""
    longest = max(map(len, MASKS))
    texts = cut(items.select("t").distinct().withColumn("item", F.monotonically_increasing_id()), "bench-texts")
    names = items.join(texts, "t").select("item", "item_id")
    masks = _masks(texts, min_tokens, short_gaps)
    at = F.col("at")
    seeds = []
    for number, offsets, exact in masks:
        here = texts.where(F.size("t") == exact) if exact else texts.where(F.size("t") >= longest)
        span = offsets[-1] + 1
        seeds.append(here.select("item", "t", F.explode(F.sequence(F.lit(0), F.size("t") - span)).alias("at"))
                     .select("item", at.alias("item_at"), F.lit(span).alias("span"),
                             _seed(F.col("t"), at, offsets, number).alias("seed")))
    union = seeds[0]
    for more in seeds[1:]:
        union = union.union(more)
    union = cut(union, "bench-seeds")
    held_bytes = texts.agg(F.sum(F.octet_length(F.concat_ws("", "t")) + 16 * F.size("t")).alias("n")).first().n or 0
    passes = max(1, -(-union.count() // broadcast_rows), -(-held_bytes // (ROW_BYTES * broadcast_rows)))

    # Token positions; a seed that reaches past the end hashes nulls and
    # cannot equal one of an item, whose tokens are all there.
    places = F.sequence(F.col("lead"), F.col("lead") + F.col("n") - 1)
    positions = (_pieces(docs, window, max(window, longest) - 1, piece)
                 .select("doc_id", "w", "start", F.explode_outer(places).alias("at")))
    hashed = positions.select("doc_id", "w", "start", "at", F.explode(F.array(
        *(_seed(F.col("w"), at, offsets, number) for number, offsets, _ in masks))).alias("seed"))

    found = None
    for k in range(passes):
        part = union.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k) if passes > 1 else union
        held = texts.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k) if passes > 1 else texts
        hits = hashed.join(F.broadcast(part.select("seed").distinct()), "seed", "left_semi")
        # A lambda is not compiled into the loops on its two sides: the first
        # one stops after each piece, the next takes up one hit after the other.
        near = hits.select("doc_id", "seed", (F.col("start") + at).alias("doc_at"), F.transform(
            F.sequence(F.lit(1 - window), F.lit(window - 1)),
            lambda i: F.when(at + i >= 0, F.get("w", at + i))).alias("near"))
        share, first = _verified(window)
        best = (near.join(F.broadcast(part), "seed")
                .join(F.broadcast(held.select(F.col("item").alias("text"), "t")),
                      (F.col("item") == F.col("text")) & (share >= similarity))
                .select("doc_id", "item", share.alias("share"), first.alias("first"))
                .groupBy("doc_id", "item").agg(F.max("share").alias("similarity"), F.min("first").alias("first_token")))
        if passes > 1:  # one after the other, so that only one pass is held
            best = cut(best, "bench-found")
        found = best if found is None else found.union(best)
    return found, names


def _items(benchmark: DataFrame, min_tokens: int) -> DataFrame:
    return cut(benchmark.select("item_id", F.array_remove(tokens(F.col("text")), "").alias("t"))
               .where(F.size("t") >= min_tokens).distinct(), "bench-items")


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 20, similarity: float = 0.8,
                  min_tokens: int = 5, broadcast_rows: int = 1_000_000, short_gaps: bool = False,
                  piece: int = 128) -> DataFrame:
    """`(doc_id, item_id, similarity, first_token)`: the benchmark items found
    in each document, the best share of agreeing tokens of a window, and the
    first document token of the earliest such window."""
    found, names = _found(docs, _items(benchmark, min_tokens), window, similarity, min_tokens,
                          broadcast_rows, short_gaps, piece)
    names = cut(names, "bench-names")
    few = names.count() <= broadcast_rows
    # Texts of one item_id may differ.
    return (found.join(F.broadcast(names) if few else names, "item").groupBy("doc_id", "item_id")
            .agg(F.max("similarity").alias("similarity"), F.min("first_token").alias("first_token")))


def _verified(window: int) -> tuple[Column, Column]:
    """Best share of agreeing tokens of a window around the seed, and the
    document position of the first window with that share.  `near` holds the
    document's tokens from `window - 1` before the seed on."""
    n = F.least(F.lit(window), F.size("t"))
    first = F.greatest(F.lit(0), F.col("item_at") + F.col("span") - n)
    last = F.least(F.col("item_at"), F.size("t") - n)
    agree = F.transform(F.sequence(first, last + n - 1), lambda i: (
        (F.get(F.col("t"), i) == F.get(F.col("near"), i - F.col("item_at") + (window - 1)))
        .eqNullSafe(F.lit(True)).cast("int")))
    sums = F.transform(F.sequence(F.lit(1), last - first + 1), lambda s: F.aggregate(
        F.slice(agree, s, n), F.lit(0), lambda a, b: a + b))
    share = F.array_max(sums) / n
    return share, first + F.array_position(sums, F.array_max(sums)).cast("int") - 1 + F.col("doc_at") - F.col("item_at")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 20, similarity: float = 0.8,
                      min_tokens: int = 5, broadcast_rows: int = 1_000_000, short_gaps: bool = False,
                      piece: int = 128) -> DataFrame:
    """The documents in which no benchmark item is found, columns unchanged.
    The ids found are broadcast up to `broadcast_rows` rows."""
    found, _ = _found(docs, _items(benchmark, min_tokens), window, similarity, min_tokens,
                      broadcast_rows, short_gaps, piece)
    gone = cut(found.select("doc_id").distinct(), "contaminated")
    few = gone.count() <= broadcast_rows
    return docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == gone["doc_id"], "left_anti")
