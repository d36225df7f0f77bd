"""Suffix-array dedup of byte strings by difference covers.

Every byte covered by a `length`-byte string that starts twice anywhere is
removed.  Three steps:

1. Candidates.  Each window of `length` bytes picks one `gram`-byte substring,
   its anchor: the one of least hash, the rightmost of equal ones.  The choice
   depends on the window's bytes alone, so equal windows pick equal anchors;
   windows whose anchor hash occurs once are not repeated.  Neighbouring
   windows mostly share an anchor (a unit), so this is one small row for about
   fifty bytes of text.
2. Units of one anchor with equal bytes are decided: all their windows are
   repeated.  One of each kind and the single ones are dealt by anchor hash.
3. Each task builds the suffix array of its units by the difference-cover
   algorithm: sort the sampled triples, name them, recurse on the names where
   they tie, sort the other suffixes by a byte and a sampled rank, merge, then
   compare the `length`-byte prefixes of neighbours.

No task needs units of two anchors together, so Spark deals them out, and a
suffix array covers blocks of bounded size: at most 2 ** 18 bytes and one more
anchor's units, 1.7 MB, for which the arrays take about 300 MB.  An anchor with more than
`most_units` different units (a passage that a third of all documents frame
differently) is not held in one task: its windows are grouped by their bytes
with a partial count before the shuffle.

Texts are named by a 64-bit hash; equal texts are one text with repeats.

Defined results
---------------
* A null text counts as empty; texts under `length` bytes lose nothing unless
  they hold a repeat, which they cannot.
* Repeated rows are documents of their own: equal texts of at least `length`
  bytes are removed whole.
* An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, drop_cut

LENGTH, GRAM = 200, 64
BASE = 0x9E3779B97F4A7C15
TOP = (1 << 64) - 1


class _Powers:
    """Powers of BASE and of its inverse modulo 2 ** 64, as far as asked."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int):
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BASE, -k, 1 << 64))])
        return self.up, self.down


POWERS = _Powers()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def units(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Units of the texts: arrays `(text, first, last, anchor, kind)`: windows
    `first` to `last` of a text share an anchor of hash `anchor`; `kind`
    hashes the unit's bytes and where the anchor lies in them."""
    none = [np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64)]
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    n, width = len(data), length - gram + 1
    if n < length:
        return none
    up, down = POWERS.get(n + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)))
    grams = _mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    m = len(grams)
    # Least hash of each window of `width` grams: the least of a block's tail
    # and the next block's head.  The low byte holds the place in the block,
    # later places first.
    blocks = -(-m // width)
    low = np.uint64(0xFF)
    key = np.full(blocks * width, np.uint64(TOP))
    key[:m] = (grams & ~low) | (np.uint64(width - 1) - (np.arange(m, dtype=np.uint64) % np.uint64(width)))
    rows = key.reshape(blocks, width)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(m - width + 1)
    a, b = tail[: len(starts)], head[width - 1 : width - 1 + len(starts)]
    later = (b | low) <= (a | low)
    block = np.where(later, (starts + width - 1) // width, starts // width) * width
    anchor = block + (width - 1) - (np.where(later, b, a) & low).astype(np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(starts)]
    inside = np.flatnonzero(starts + length <= ends[owner])
    if not len(inside):
        return none
    anchor, owner = anchor[inside], owner[inside]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
    first = inside[new]
    last = inside[np.concatenate((np.flatnonzero(new)[1:], [len(inside)])) - 1]
    anchor, owner = anchor[new], owner[new]
    stop = last + length
    kind = _mixed((sums[stop] - sums[first]) * down[first] + (stop - first).astype(np.uint64) * np.uint64(BASE)
                  + (anchor - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    base = (ends - sizes)[owner]
    return owner, first - base, last - base, grams[anchor], kind


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of positive integers, by the
    difference cover modulo 3.  Names must fit in 21 bits."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    s = np.concatenate((s.astype(np.int64), np.zeros(3, np.int64)))
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((ones, twos))
    triples = s[sample] << 42 | s[sample + 1] << 21 | s[sample + 2]
    _, names = np.unique(triples, return_inverse=True)
    rank = np.zeros(n + 3, np.int64)
    if names.max() + 1 < len(sample):
        order = suffix_array(names + 1)
        rank[sample[order]] = np.arange(1, len(sample) + 1)
    else:
        rank[sample] = names + 1
    by_rank = np.empty(len(sample), np.int64)
    by_rank[rank[sample] - 1] = sample
    by_rank = by_rank[by_rank < n]
    zeros = np.arange(0, n, 3)
    pair = lambda i: s[i] << 21 | rank[i + 1]
    three = lambda i: s[i] << 42 | s[i + 1] << 21 | rank[i + 2]
    zeros = zeros[np.argsort(pair(zeros), kind="stable")]
    is_one = by_rank % 3 == 1
    before = np.searchsorted(pair(by_rank[is_one]), pair(zeros)) + np.searchsorted(three(by_rank[~is_one]), three(zeros))
    out = np.empty(n, np.int64)
    at_zero = before + np.arange(len(zeros))
    out[at_zero] = zeros
    taken = np.zeros(n, bool)
    taken[at_zero] = True
    out[~taken] = by_rank
    return out


def repeated_windows(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its windows also start elsewhere in them."""
    joined = b"\x00".join(contexts) + b"\x00"
    raw = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(c) for c in contexts])
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = raw.astype(np.int64) + 2
    text[begins + sizes] = 1
    valid = np.zeros(len(raw), bool)
    for a, n in zip(begins.tolist(), sizes.tolist()):
        valid[a : a + n - length + 1] = True
    order = suffix_array(text)
    order = order[valid[order]]
    flags = np.zeros(len(raw), bool)
    if len(order) > 1:
        left, right = order[:-1], order[1:]
        words = np.ndarray((len(raw) - 7,), "<u8", raw.tobytes(), strides=(1,))
        for step in [*range(0, length - 7, 8), length - 8]:
            same = words[left + step] == words[right + step]
            left, right = left[same], right[same]
        flags[left] = flags[right] = True
    return [flags[a : a + n - length + 1] for a, n in zip(begins.tolist(), sizes.tolist())]


def _spans(hits: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the bytes covered by windows that start at `hits`."""
    breaks = np.flatnonzero(np.diff(hits) > length) + 1
    return hits[np.concatenate(([0], breaks))], hits[np.concatenate((breaks, [len(hits)])) - 1] + length


def _find_units(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size, start = [], 0, at
                while at < batch.num_rows and (not texts or size < 1 << 19):
                    texts.append(batch.column(1)[at].as_py() or b"")
                    size += len(texts[-1])
                    at += 1
                owner, first, last, anchor, kind = units(texts, length, gram)
                names = batch.column(0).slice(start, at - start).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[owner]), pa.array(first.astype(np.int32)), pa.array((last - first).astype(np.int16)),
                     pa.array(anchor.view(np.int64)), pa.array(kind.view(np.int64))],
                    names=["name", "first", "more", "anchor", "kind"])

    whole = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select(F.xxhash64(whole).alias("name"), whole.cast("binary").alias("data"))
            .mapInArrow(run, "name bigint, first int, more smallint, anchor bigint, kind bigint"))


def _solved(contexts: DataFrame, length: int) -> DataFrame:
    """`(anchor, name, first, bytes)` dealt by anchor -> spans `(name, start, end)`."""

    def solve(names, firsts, data):
        out = ([], [], [])
        for name, first, flags in zip(names, firsts, repeated_windows(data, length)):
            hits = np.flatnonzero(flags)
            if len(hits):
                for a, b in zip(*_spans(hits + first, length)):
                    for column, value in zip(out, (name, int(a), int(b))):
                        column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int32()))],
                                          names=["name", "start", "end"])

    def run(batches):
        names, firsts, data, size, last = [], [], [], 0, None
        for batch in batches:
            for anchor, name, first, piece in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if anchor != last and size >= 1 << 18:
                    yield solve(names, firsts, data)
                    names, firsts, data, size = [], [], [], 0
                last = anchor
                names.append(name)
                firsts.append(first)
                data.append(piece)
                size += len(piece) + 1
        if data:
            yield solve(names, firsts, data)

    return (contexts.repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "name bigint, start int, end int"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_units: int = 4096,
                   broadcast_rows: int = 1_000_000) -> DataFrame:
    """`(name, spans)`: the covered runs `(start, end)` of each text that has
    any, in order; `name` is the xxhash64 of the text."""
    found = cut(_find_units(docs, length, gram), "suffix-units")
    shared = cut(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "suffix-anchors")
    near = cut(found.join(shared, "anchor"), "suffix-near")
    drop_cut(found)
    # One row per (anchor, kind): how often, and one unit that stands for it.
    kinds = cut(near.groupBy("anchor", "kind").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("name", "first", "more")).alias("one")), "suffix-kinds")
    many = cut(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "suffix-open")
    # Units of a kind that occurs twice are covered whole.
    twice = kinds.where("times > 1").select("anchor", "kind")
    decided = near.join(twice, ["anchor", "kind"]).select(
        "name", F.col("first").alias("start"), (F.col("first") + F.col("more") + length).alias("end"))
    decided = cut(decided.distinct(), "suffix-decided")
    drop_cut(near)
    # One unit of each kind, of anchors with several kinds, goes on.
    going = cut(kinds.join(many, "anchor").select("anchor", "kinds", "one.*"), "suffix-going")
    wanted = cut(going.select("name").distinct(), "suffix-names")
    few = wanted.count() <= broadcast_rows
    whole = F.coalesce(F.col("text"), F.lit(""))
    texts = (docs.select(F.xxhash64(whole).alias("name"), whole.cast("binary").alias("data"))
             .join(F.broadcast(wanted) if few else wanted, "name", "left_semi")
             .groupBy("name").agg(F.first("data").alias("data")))
    pieces = (going.groupBy("name").agg(F.collect_list(F.struct("anchor", "kinds", "first", "more")).alias("units"))
              .join(texts, "name").select("name", "data", F.explode("units").alias("u"))
              .select("u.anchor", "u.kinds", "name", "u.first",
                      F.expr(f"substring(data, u.first + 1, u.more + {length})").alias("bytes")))
    pieces = cut(pieces, "suffix-pieces")
    solved = _solved(pieces.where(F.col("kinds") <= most_units).select("anchor", "name", "first", "bytes"), length)
    windows = pieces.where(F.col("kinds") > most_units).select(
        "name", "first", "bytes", F.posexplode(F.expr(f"sequence(0, length(bytes) - {length})")).alias("k", "offset")).select(
        "name", (F.col("first") + F.col("offset")).alias("start"), F.expr(f"unhex(sha2(substring(bytes, offset + 1, {length}), 256))").alias("window"))
    twin = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    hot = windows.join(twin, "window", "left_semi").select("name", "start", (F.col("start") + length).alias("end"))
    spans = cut(decided.union(solved).union(hot), "suffix-spans")
    drop_cut(pieces)

    def merge(batches):
        for batch in batches:
            out = []
            for runs in batch.column(1).to_pylist():
                merged: list[list[int]] = []
                for r in runs:
                    if merged and r["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["end"])
                    else:
                        merged.append([r["start"], r["end"]])
                out.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, batch.column(1).type)], names=["name", "spans"])

    return (spans.groupBy("name").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
            .mapInArrow(merge, "name bigint, spans array<struct<start:int,end:int>>"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_units: int = 4096,
                   broadcast_rows: int = 1_000_000) -> DataFrame:
    """`doc_id, n_bytes, spans, kept`: the removed runs of each document and
    its remaining bytes."""
    spans = cut(repeated_spans(docs, length, gram, most_units, broadcast_rows), "suffix-result")
    names = spans.select("name")
    few = spans.count() <= broadcast_rows
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(whole).alias("name"), whole.cast("binary").alias("data"))
    held = F.broadcast(names) if few else names
    clean = rows.join(held, "name", "left_anti").select(
        "doc_id", F.length("data").cast("bigint").alias("n_bytes"),
        F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("spans"), F.col("data").alias("kept"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for data, runs in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    edges = [0] + [x for r in runs for x in (r["start"], r["end"])] + [len(data)]
                    out.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in part.column(1).to_pylist()], pa.int64()), part.column(2),
                     pa.array(out, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    dirty = rows.join(held, "name", "left_semi").join(spans, "name").select("doc_id", "data", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:int,end:int>>, kept binary")
    return clean.union(dirty)


def with_digests(removed: DataFrame) -> DataFrame:
    total = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return removed.select("doc_id", "n_bytes", total.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
