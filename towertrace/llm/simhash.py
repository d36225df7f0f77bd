"""SimHash near-dedup by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits and mapped to the
vector of its segments' bit counts.  Flipping one bit moves one coordinate by
one, so the Manhattan distance of two vectors is at most the bit distance of
the fingerprints.  The vector is kept in unary code (count 0, 1, 2 as 00, 01,
11), where the Manhattan distance is again a count of differing bits.

Grid range join: the coordinates are dealt into 2k groups.  Two vectors
within distance k differ in at most k of them, so they agree in k groups and
fall into the same cell of the grid over these coordinates; every choice of k
groups is one grid.  Within a cell the Manhattan distance rejects first, then
the bit distance decides.

Skew: equal fingerprints are one node, whatever their number.  A cell of more
than `block` rows is split into parts, and every pair of parts is a task
group of at most about `block` rows, so no cell is held whole.  A cell
reports a spanning forest of its links, not all of them: the components are
the same, and the output is linear in the cell.

Defined results
---------------
* A null or empty text, or one of white space only, has fingerprint zero and
  is linked like any other.
* Repeated rows share fingerprint and component.
* A row without an id gets a fingerprint, a null component and links nothing.
* An id with different texts is several rows: each is linked, and goes or
  stays, by its own fingerprint.
* An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import cut

SEED = 42
SEGMENTS = 32
LOW_BITS = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())],
                      np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ BITS_OF for k in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


#: Bits of each byte value, lowest first.
BITS_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, **more: Column) -> DataFrame:
    """`(doc_id, fingerprint)`, the fingerprint as a signed 64-bit integer,
    and `more` bigint columns of the rows."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], pa.int64()),
                 *batch.columns[2:]], names=["doc_id", "fingerprint", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = list(more)
    columns = docs.select("doc_id", "text", *(c.alias(k) for k, c in more.items()))
    return columns.mapInArrow(run, ", ".join([f"doc_id {kind}", "fingerprint bigint", *(f"{k} bigint" for k in names)]))


def embedding(bits: Column) -> Column:
    """Unary-coded bit counts of the two-bit segments."""
    low, other = bits.bitwiseAND(F.lit(LOW_BITS)), F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(LOW_BITS))
    return low.bitwiseOR(other).bitwiseOR(F.shiftleft(low.bitwiseAND(other), 1))


def grid_masks(max_bits: int) -> list[int]:
    """For each choice of `max_bits` of the 2 * max_bits coordinate groups,
    the bits of the embedding that make up the cell."""
    groups = np.array_split(np.arange(SEGMENTS), max(2, 2 * max_bits))
    masks = []
    for chosen in combinations(groups, max(1, max_bits)):
        mask = sum(3 << int(2 * s) for g in chosen for s in g)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _links(cell: np.ndarray, bits: np.ndarray, code: np.ndarray, max_bits: int):
    """Index pairs of a spanning forest of the links in each run of equal `cell`."""
    edges = np.flatnonzero(np.diff(cell)) + 1
    starts = np.concatenate(([0], edges))
    sizes = np.diff(np.concatenate((starts, [len(cell)])))
    left, right = [], []
    # Small cells, all at once: compare each row with the one d further on.
    small = np.repeat(sizes <= 16, sizes)
    rank_left = np.repeat(starts + sizes, sizes) - np.arange(len(cell))
    for d in range(1, 16):
        i = np.flatnonzero(small & (rank_left > d))
        if not len(i):
            break
        i = i[np.bitwise_count(code[i] ^ code[i + d]) <= max_bits]
        i = i[np.bitwise_count(bits[i] ^ bits[i + d]) <= max_bits]
        left.append(i)
        right.append(i + d)
    for start, size in zip(starts[sizes > 16].tolist(), sizes[sizes > 16].tolist()):
        rest = np.arange(start, start + size)
        while len(rest):
            todo, rest = [rest[0]], rest[1:]
            while todo and len(rest):
                at = todo.pop()
                near = np.bitwise_count(code[rest] ^ code[at]) <= max_bits
                near[near] = np.bitwise_count(bits[rest[near]] ^ bits[at]) <= max_bits
                found, rest = rest[near], rest[~near]
                if len(found):
                    left.append(np.full(len(found), at))
                    right.append(found)
                    todo.extend(found.tolist())
    if not left:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate(left), np.concatenate(right)


def links(nodes: DataFrame, max_bits: int = 3, block: int = 4096) -> DataFrame:
    """Edges `(a, b)` between nodes `(node, fingerprint)` of distinct
    fingerprints, enough to connect all that link at `max_bits` bits."""
    code = embedding(F.col("fingerprint"))
    cells = F.array(*(F.xxhash64(F.lit(g), code.bitwiseAND(F.lit(mask))) for g, mask in enumerate(grid_masks(max_bits))))
    rows = cut(nodes.select("node", "fingerprint", F.explode(cells).alias("cell")), "simhash-cells")
    sizes = cut(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-sizes")
    parts = F.ceil(F.col("n") / F.lit(block // 2)).cast("int")
    part = F.pmod(F.xxhash64("fingerprint", F.lit("part")), F.col("parts")).cast("int")
    pairs = F.when(F.col("n") <= block, F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                    lambda q: F.least(q, F.col("part")) * F.col("parts") + F.greatest(q, F.col("part"))))
    dealt = (rows.join(sizes, "cell").withColumn("parts", parts).withColumn("part", part)
             .select(F.explode(pairs).alias("pair"), "cell", "node", "fingerprint")
             .select(F.xxhash64("cell", "pair").alias("group"), "node", "fingerprint"))

    def run(batches):
        held = None

        def solve(group, node, bits):
            low = bits & np.uint64(LOW_BITS)
            high = (bits >> np.uint64(1)) & np.uint64(LOW_BITS)
            i, j = _links(group, bits, (low | high) | ((low & high) << np.uint64(1)), max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.maximum(node[i], node[j])), pa.array(np.minimum(node[i], node[j]))], names=["a", "b"])

        for batch in batches:
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            now[2] = now[2].view(np.uint64)
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            whole = int(np.searchsorted(now[0], now[0][-1]))  # the last group may go on
            if whole:
                yield solve(*(x[:whole] for x in now))
            held = [x[whole:] for x in now]
        if held is not None:
            yield solve(*held)

    found = dealt.repartition("group").sortWithinPartitions("group").mapInArrow(run, "a bigint, b bigint")
    return found.distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """`(doc_id, fingerprint, component_id)`, one row per document; documents
    within `max_bits` bits are linked, and a component is named by the
    smallest doc_id in it."""
    prints = cut(fingerprints(docs, shingle), "simhash-prints")
    return _named(prints, max_bits).select("doc_id", "fingerprint", "component_id")


def _named(prints: DataFrame, max_bits: int) -> DataFrame:
    """`prints` with `component_id`.  The fingerprint itself is the node; a
    component gets its smallest doc_id at the end."""
    nodes = cut(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    edges = links(nodes.where("least IS NOT NULL").select(F.col("fingerprint").alias("node"), "fingerprint"), max_bits)
    groups = connected_components(edges)
    members = cut(nodes.join(groups, nodes["fingerprint"] == groups["node"], "left")
                  .select("fingerprint", F.coalesce("component", "fingerprint").alias("component"), "least"), "simhash-members")
    names = cut(members.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-names")
    named = cut(members.join(names, "component").select("fingerprint", "component_id"), "simhash-named")
    return (prints.join(named, "fingerprint")
            .select(*prints.columns, F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The document with the smallest id of each component, columns unchanged;
    rows without an id stay.  Rows go by id and fingerprint; the text's hash
    stands for the latter, so that it is not computed twice."""
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    prints = cut(fingerprints(docs, shingle, text_hash=text_hash), "simhash-prints")
    gone = cut(_named(prints, max_bits).where("doc_id <> component_id").select("doc_id", "text_hash").distinct(),
               "simhash-gone")
    return docs.join(gone, (docs["doc_id"] == gone["doc_id"]) & (text_hash == gone["text_hash"]), "left_anti")
