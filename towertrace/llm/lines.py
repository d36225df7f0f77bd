"""Near-duplicate lines by a segment-partition edit join.

A line is a trimmed, non-empty piece of a text between line feeds (with at
least `min_chars` characters, 1 unless asked).  Exact copies go at any length.
Two different lines are linked when their edit distance is at most k, where k
follows the shorter line's length: `edits` gives the lengths from which one,
two, ... edits are allowed, (10, 20) unless asked; a number k stands for k
edits from k + 1 characters.

Join: a line is cut into k + 1 segments of even length.  A line within k
edits holds one of them unchanged, at a place that the other edits allow, so
each line looks up the substrings that can be a segment of a line of its own
length or up to k shorter (multi-match-aware selection: 12 substrings for
k = 2).  k is that of the shorter line's length, on either side; below k + 1
characters segments would be empty, so no k reaches there.  A key hashes the shorter line's length, the segment's number and the
substring; index and probe rows meet in a sort-merge join that Spark splits
where a key is hot.  A first pass of semi joins finds the lines that share a
key with another line at all.  Pairs leave the join only if the counts of
sixteen letters differ by at most 2k in sum, which an edit changes by at most two.

Verification: the banded bit-parallel edit distance.  The 2k + 1 rows of the
band are bits of one integer; each character of the longer line updates the
vertical differences with a few bit operations.

Decision: the first occurrence of a line, by doc_id and line number, is its
place.  A line goes when it repeats an earlier one or is linked to a line
whose place is earlier.  Exact copies are one class throughout, so a line
that thousands of documents share is one row of the join.

All of it is DataFrame and SQL functions.

Defined results
---------------
* Null and empty texts have no lines.
* Repeated rows (same id and text) have the same places and the same lines go.
* A null id comes after all others.
* An empty table gives an empty result; other columns are not read and
  `drop_lines` returns them unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, free_name

TRIMMED = " \t\x0b\x0c\r"
#: Counted by the filter; any letters would do, frequent ones tell most.
LETTERS = ("eanrtiso", "dlhucmg ")


#: Lengths from which one and two edits are allowed: one in ten characters.
EDITS = (10, 20)
Edits = int | tuple[int, ...]


def lengths(edits: Edits) -> tuple[int, ...]:
    """The lengths from which 1, 2, ... edits are allowed."""
    out = (edits + 1,) * edits if isinstance(edits, int) else tuple(edits)
    if any(length <= k for k, length in enumerate(out, 1)) or list(out) != sorted(out):
        raise ValueError("k edits need lines of more than k characters, and no fewer than k - 1 edits")
    return out


def allowed(length: Column, edits: Edits) -> Column:
    """Edits that a pair is allowed whose shorter line has `length` characters."""
    k = F.lit(0)
    for number, start in enumerate(lengths(edits), 1):
        k = F.when(length >= start, number).otherwise(k)
    return k


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """`doc_id, line_no, line, n` of the lines that are looked at."""
    pieces = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    return (docs.select("doc_id", F.posexplode_outer(pieces).alias("line_no", "piece"))
            .select("doc_id", "line_no", F.btrim("piece", F.lit(TRIMMED)).alias("line"))
            .withColumn("n", F.char_length("line")).where(F.col("n") >= min_chars))


def _moves(k: int) -> set[tuple[int, int, int]]:
    """`(shorter, number, move)`: where segment `number` of a line that is
    `shorter` characters shorter can lie, for k edits."""
    parts = k + 1
    return {(shorter, number, move) for shorter in range(k + 1) for number in range(1, parts + 1)
            for move in range(max(1 - number, shorter - (parts - number)), min(number - 1, shorter + (parts - number)) + 1)}


def _all_moves(edits: Edits) -> dict[tuple[int, int, int], int]:
    """The moves, those within lines of equal length first, each with the
    least k that has it (more edits have all moves of fewer)."""
    least = {}
    for k in range(len(lengths(edits)), 0, -1):
        least |= dict.fromkeys(_moves(k), k)
    return dict(sorted(least.items()))


def with_keys(rows: DataFrame, edits: Edits) -> DataFrame:
    """`rows (line, n, ...)` with `own`, the keys of the line's segments, and
    `probes`, those of its substrings that may be a segment of a line 0 or
    more characters shorter, in the order of `_all_moves`; null where the
    allowed edits have no such segment.

    A substring is cut by bytes, four a character, so no cut walks the line.
    Where segments begin is computed in steps of their own, which keeps the
    method that Spark generates for the keys below the size the JVM compiles.
    """
    most = len(lengths(edits))
    n, shorter = F.col("n"), range(most + 1)
    out = rows.select("*", F.encode("line", "UTF-32").alias("_units"), *((n - s).alias(f"_n{s}") for s in shorter),
                      *((allowed(n - s, edits) + 1).alias(f"_parts{s}") for s in shorter))
    out = out.select("*", *((F.col(f"_n{s}") % F.col(f"_parts{s}")).alias(f"_rest{s}") for s in shorter))
    out = out.select("*", *(((F.col(f"_n{s}") - F.col(f"_rest{s}")) / F.col(f"_parts{s}")).cast("int").alias(f"_base{s}") for s in shorter))
    # 1-based starts of the segments, the longer ones last; number parts + 1 ends the line
    out = out.select("*", *(
        (F.col(f"_base{s}") * j + F.greatest(F.lit(0), F.col(f"_rest{s}") - F.col(f"_parts{s}") + j) + 1).alias(f"_start{s}_{j + 1}")
        for s in shorter for j in range(most + 2)))

    def key(s, number, move, k):
        start, end = F.col(f"_start{s}_{number}"), F.col(f"_start{s}_{number + 1}")
        piece = F.substring("_units", (start + move) * 4 - 3, (end - start) * 4)
        return F.when(F.col(f"_parts{s}") > k, F.xxhash64(F.col(f"_n{s}"), F.lit(number), piece))

    return out.select(*rows.columns, F.array(*(key(0, j, 0, max(1, j - 1)) for j in range(1, most + 2))).alias("own"),
                      F.array(*(key(*move, k) for move, k in _all_moves(edits).items())).alias("probes"))


def letter_counts(line: Column, length: Column, letters: str) -> Column:
    """Counts of eight letters, eight bits each."""
    out = F.lit(0).cast("bigint")
    for k, letter in enumerate(letters):
        n = (length - F.char_length(F.replace(line, F.lit(letter), F.lit("")))).cast("bigint")
        out = out.bitwiseOR(F.shiftleft(n.bitwiseAND(F.lit(255)), 8 * k))
    return out


def count_distance(a: str, b: str) -> str:
    """SQL for the sum of the differences of two packed counts (mod 256)."""
    d = [f"abs((shiftright({a}, {8 * k}) & 255) - (shiftright({b}, {8 * k}) & 255))" for k in range(8)]
    return " + ".join(f"least({x}, 256 - {x})" for x in d)


def edit_distance(shorter: Column, longer: Column, edits: int) -> Column:
    """Edit distance of two strings whose lengths differ by at most `edits`;
    exact up to `edits`, above that some larger number.

    Column j of the band has the rows j - edits to j + edits.  Bit b of `up`
    and `down` says that row j + 1 - edits + b is one more or one less than
    the row above it; `low` is the value in row j + edits.
    """
    width = 2 * edits + 1
    full = F.lit((1 << width) - 1).cast("bigint")
    flip = lambda x: F.bitwise_not(x).bitwiseAND(full)

    def bound(value, then):
        """`then(value)`, the value computed once."""
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def column(chars, state, j, c):
        same = F.lit(0).cast("bigint")
        for b in range(width):
            at = j + (b - edits)
            hit = F.when((at >= 0) & (F.get(chars, at) == c), F.lit(1 << b)).otherwise(F.lit(0))
            same = same.bitwiseOR(hit.cast("bigint"))
        up, down = state["up"], state["down"]
        return bound(same, lambda x: bound(
            ((x.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(x).bitwiseOR(down).bitwiseAND(full),
            lambda d: moved(state, d)))

    def moved(state, d):
        up, down = state["up"], state["down"]
        low = (state["low"] + F.when(d.bitwiseAND(F.lit(1 << (width - 1))) == 0, 1).otherwise(0)).cast("int")
        right, half = down.bitwiseOR(flip(d.bitwiseOR(up))), F.shiftright(d, 1)
        return bound(right, lambda x: F.struct(
            d.bitwiseAND(up).bitwiseOR(flip(half.bitwiseOR(x))).alias("up"), half.bitwiseAND(x).alias("down"), low.alias("low")))

    start = F.struct(F.lit(((1 << width) - 1) & ~((1 << edits) - 1)).cast("bigint").alias("up"),
                     F.lit(0).cast("bigint").alias("down"), F.lit(edits).alias("low"))
    items = F.transform(F.split(longer, ""), lambda c, j: F.struct(j.alias("j"), c.alias("c")))
    end = bound(F.split(shorter, ""), lambda chars: F.aggregate(
        items, start, lambda s, item: column(chars, s, item["j"], item["c"])))
    # Go up from the last row of the band to the end of the shorter string.
    row = F.char_length(shorter) - F.char_length(longer) + edits
    masks = F.array(*(F.lit(((1 << (width - 1)) - 1) & ~((1 << r) - 1)).cast("bigint") for r in range(width)))
    below = F.get(masks, F.greatest(F.lit(0), F.least(row, F.lit(width - 1))))
    return bound(end, lambda e: (
        e["low"] - F.bit_count(e["up"].bitwiseAND(below)) + F.bit_count(e["down"].bitwiseAND(below))).cast("int"))


def _exploded(lines: DataFrame, edits: Edits) -> tuple[DataFrame, DataFrame]:
    """Index rows `(key, a)` and probe rows `(key, even, b)` of lines with
    their arrays `own` and `probes`; other columns go along on either side.
    `even`: the key is that of a line of equal length."""
    even = sum(shorter == 0 for shorter, _, _ in _all_moves(edits))
    rest = [c for c in lines.columns if c not in ("own", "probes", "line_id", "place")]
    index = lines.select(F.explode("own").alias("key"), F.col("line_id").alias("a"), *(F.col(c).alias(f"a_{c}") for c in rest)).where("key IS NOT NULL")
    probes = lines.select("line_id", *rest, F.posexplode("probes").alias("at", "key")).where("key IS NOT NULL").select(
        "key", (F.col("at") < even).alias("even"), F.col("line_id").alias("b"),
        *(F.col(c).alias(f"b_{c}") for c in rest))
    return index, probes


def classes(docs: DataFrame, edits: Edits, min_chars: int) -> DataFrame:
    """One row per different line: `line_id`, its place and its keys."""
    rows = with_keys(line_rows(docs, min_chars), edits).select(
        F.xxhash64("line").alias("line_id"), F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "line_no").alias("place"),
        "own", "probes")
    return rows.groupBy("line_id").agg(F.min("place").alias("place"), F.first("own").alias("own"), F.first("probes").alias("probes"))


def sharing(lines: DataFrame) -> DataFrame:
    """Ids of the lines that share a key with a different line: semi joins,
    which stop at the first partner however many a hot key has."""
    # as structs: Spark then sees that both joins read the same exchanges
    def side(keys, name):
        return (lines.select("line_id", F.explode(F.arrays_zip(F.col(keys).alias("key"))).alias("p")).where("p.key IS NOT NULL")
                .select(F.col("p.key").alias("key"), F.col("line_id").alias(name)))

    index, probes = side("own", "a"), side("probes", "b")
    other = F.col("a") != F.col("b")
    hit = index.hint("merge").join(probes, (index["key"] == probes["key"]) & other, "left_semi").select(F.col("a").alias("line_id"))
    hit_by = probes.hint("merge").join(index, (index["key"] == probes["key"]) & other, "left_semi").select(F.col("b").alias("line_id"))
    return hit.union(hit_by).distinct()


def edit_join(texts: DataFrame, edits: Edits) -> DataFrame:
    """`texts (line_id, line)`, distinct -> `(a, b, distance)`, each pair of
    lines within the allowed edits once, `a` not longer than `b`."""
    line, n = F.col("line"), F.col("n")
    keyed = cut(with_keys(texts.select("line_id", "line", F.char_length("line").alias("n")), edits).select(
        "line_id", letter_counts(line, n, LETTERS[0]).alias("counts"), letter_counts(line, n, LETTERS[1]).alias("more"),
        allowed(n, edits).alias("k"), "own", "probes"), "line-keys")
    index, probes = _exploded(keyed, edits)
    meet = F.expr(f"a <> b AND (NOT even OR a < b) AND {count_distance('a_counts', 'b_counts')} <= 2 * a_k "
                  f"AND {count_distance('a_counts', 'b_counts')} + {count_distance('a_more', 'b_more')} <= 2 * a_k")
    pairs = cut(index.hint("merge").join(probes, "key").where(meet).select("a", "b").distinct(), "line-pairs")
    side = lambda name, to: texts.select(F.col("line_id").alias(name), F.col("line").alias(to))
    distance = edit_distance(F.col("shorter"), F.col("longer"), len(lengths(edits)))
    return (pairs.join(side("a", "shorter"), "a").join(side("b", "longer"), "b")
            .select("a", "b", "shorter", distance.alias("distance")).where(F.col("distance") <= allowed(F.char_length("shorter"), edits))
            .select("a", "b", "distance"))


def link_lines(docs: DataFrame, edits: Edits = EDITS, min_chars: int = 1, broadcast_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """`lines (line_id, place)`, one row per different line, and `links
    (a, b, distance)`, each linked pair once.

    Lines that share no key with another line are left out before texts
    travel; the ids of the others are broadcast up to `broadcast_rows` rows
    and shuffled beyond that.
    """
    lines = cut(classes(docs, edits, min_chars), "line-classes")
    wanted = cut(sharing(lines), "lines-wanted")
    few = wanted.count() <= broadcast_rows
    texts = (line_rows(docs, min_chars).select(F.xxhash64("line").alias("line_id"), "line")
             .join(F.broadcast(wanted) if few else wanted, "line_id", "left_semi"))
    texts = cut(texts.groupBy("line_id").agg(F.first("line").alias("line")), "line-texts")
    return lines.select("line_id", "place"), cut(edit_join(texts, edits), "line-links")


def decisions(docs: DataFrame, edits: Edits = EDITS, min_chars: int = 1) -> DataFrame:
    """`doc_id, n_lines, dropped_lines, n_links` per document: lines looked at,
    numbers of the lines that go, links of its lines to different lines."""
    lines, links = link_lines(docs, edits, min_chars)
    place = lambda name, to: lines.select(F.col("line_id").alias(name), F.col("place").alias(to))
    both = (links.join(place("a", "pa"), "a").join(place("b", "pb"), "b")
            .select(F.expr("inline(array(struct(a AS line_id, pb < pa AS later), struct(b AS line_id, pa < pb AS later)))")))
    linked = both.groupBy("line_id").agg(F.count(F.lit(1)).alias("links"), F.max("later").alias("later"))
    known = cut(lines.join(linked, "line_id", "left"), "line-verdicts")
    here = line_rows(docs, min_chars).select("doc_id", "line_no", F.xxhash64("line").alias("line_id"))
    first = F.col("place.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("place.line_no") == F.col("line_no"))
    judged = here.join(known, "line_id").select(
        "doc_id", "line_no", F.coalesce("links", F.lit(0)).alias("links"),
        (~first | F.coalesce("later", F.lit(False))).alias("goes"))
    per = judged.groupBy("doc_id").agg(
        F.countDistinct("line_no").alias("n_lines"),
        F.sort_array(F.collect_set(F.when(F.col("goes"), F.col("line_no")))).alias("dropped_lines"),
        F.sum("links").alias("n_links"))
    ids = docs.select("doc_id").distinct()
    return ids.join(per, ids["doc_id"].eqNullSafe(per["doc_id"]), "left").select(
        ids["doc_id"], F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("dropped_lines", F.array().cast("array<int>")).alias("dropped_lines"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def drop_lines(docs: DataFrame, edits: Edits = EDITS, min_chars: int = 1) -> DataFrame:
    """`docs` with the lines that go taken out of `text`."""
    own, lines = free_name(docs, "__id"), free_name(docs, "__lines")
    gone = cut(decisions(docs, edits, min_chars).where(F.size("dropped_lines") > 0)
               .select(F.col("doc_id").alias(own), F.col("dropped_lines").alias(lines)), "lines-dropped")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(lines, i)), "\n")
    return (docs.join(gone, F.col("doc_id").eqNullSafe(F.col(own)), "left")
            .withColumn("text", F.when(F.col(lines).isNull(), F.col("text")).otherwise(kept)).select(docs.columns))
