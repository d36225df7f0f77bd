"""Spelling variants grouped by Bloom-guided neighbourhoods.

Words are counted over whole texts; two words are near when one inserted,
deleted or replaced letter turns one into the other.  A word's *form* is its
most frequent near word, if that is frequent enough, and its *root* is where
the forms lead.

How near words are found.  No pair of words is compared blindly: every word
generates its edits, and an edit is only followed up when a Bloom filter over
the vocabulary says that it may be a word.

* The filter is sharded by word length.  A shard is an array of 512-bit
  blocks; a key sets twelve bits of one block.  It is built by the tasks from
  the written vocabulary, or-ed together by an aggregate, and broadcast.
* An edit's hash is had from the word's in constant time: the hash is the sum
  of one value per (position, letter), so a replacement exchanges one term
  and a deletion joins a prefix sum with a shifted suffix sum.
* Deletions stand for insertions seen from the longer word, and replacements
  are generated towards the larger letter only, so each pair comes up once.
* Only the positives are spelled out and shuffled to a join with the
  vocabulary, which removes the false ones.

Size.  One broadcast holds at most `most_bytes` of filter: shards are packed
into passes, and a length whose shard is larger is cut by hash into several.
A pass is only probed with the edits that fall into it, so nothing is lost
and the work per edit does not depend on the number of passes.  Words are
counted inside the tasks first, so a word that fills a third of the corpus
reaches the shuffle once per task (or per half million different words).

Defined results
---------------
* A null or empty text has no words.  A row without an id counts its words,
  but none of them is changed by the rule on `<doc_id>:<word>`.
* Repeated rows and ids count as often as they stand there.
* Ties in n go to the smaller word in code-point order.
* An empty table, or one without frequent words, gives an empty result.
* Very long texts are read in pieces cut between words.
* Other columns are not read.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, drop_cut

#: Letters after A-Z are lower-cased, as code points.
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint32)
RUN = re.compile("[a-zÀ-ÿ]+")
NO_LETTER = re.compile("[^a-zÀ-ÿ]")
PIECE = 1 << 20
HELD_WORDS = 500_000

BITS = 512
PROBES = 12
#: Bits of filter per word; long words have many edits, each costly to spell out.
BITS_PER_WORD, BITS_PER_LONG_WORD, LONG = 24, 64, 64
CHUNK = 1 << 19


# --- words -----------------------------------------------------------------

def runs(text: str, piece: int = PIECE):
    """Lists of the letter runs of a text, A-Z lower-cased, piece by piece."""
    text = text.encode("utf-8").lower().decode("utf-8")  # bytes: only A-Z change
    at = 0
    while at < len(text):
        stop = NO_LETTER.search(text, at + piece)
        end = stop.start() if stop else len(text)
        yield RUN.findall(text, at, end)
        at = end + 1


def planted(word: str, h: int, every: int) -> str:
    """The word, without the letter at h % length if `every` divides h."""
    if h % every:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1:]


def word_counts(docs: DataFrame, min_chars: int = 6, every: int = 199) -> DataFrame:
    """`(word, n)`: occurrences of every word of at least `min_chars` letters
    over all documents, after the rule on `<doc_id>:<word>`."""

    def flush(counts):
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        from collections import Counter

        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seed = None if doc_id is None else crc32(f"{doc_id}:".encode())
                for found in runs(text.as_py() or ""):
                    for word, n in Counter(found).items():
                        if len(word) < min_chars:
                            continue
                        if seed is not None:
                            word = planted(word, crc32(word.encode(), seed), every)
                            if len(word) < min_chars:
                                continue
                        total[word] += n
                if len(total) > HELD_WORDS:
                    yield flush(total)
                    total = Counter()
        if total:
            yield flush(total)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, min_chars: int = 6, min_count: int = 5, every: int = 199) -> DataFrame:
    """`(word, n, chars)`, written: the words with at least `min_count` occurrences."""
    counts = word_counts(docs, min_chars, every).where(F.col("n") >= min_count)
    return cut(counts.select("word", "n", F.char_length("word").alias("chars")), "spelling-words")


# --- hashes of words and of their edits ---------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (xor-shifts and odd multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def term(position: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """What a letter adds to the hash of a word that has it at a position."""
    return _mixed(position.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + letter.astype(np.uint64) + np.uint64(1))


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def word_hashes(matrix: np.ndarray) -> np.ndarray:
    return term(np.arange(matrix.shape[1])[None, :], matrix).sum(axis=1, dtype=np.uint64)


def replacements(matrix: np.ndarray):
    """Blocks of (row, position, letter, hash): each letter replaced by every
    larger one, at most about `CHUNK` at a time."""
    n, length = matrix.shape
    step = max(1, CHUNK // len(LETTERS))
    for rows in range(0, n, max(1, step // length)):
        part = matrix[rows:rows + max(1, step // length)]
        whole = word_hashes(part)
        for a in range(0, length, step):
            place = np.arange(a, min(a + step, length))
            old = part[:, place]
            rest = whole[:, None] - term(place[None, :], old)
            new = term(place[:, None], LETTERS[None, :])
            r, p, c = np.nonzero(LETTERS[None, None, :] > old[:, :, None])
            yield r + rows, p + a, LETTERS[c], rest[r, p] + new[p, c]


def deletions(matrix: np.ndarray):
    """Blocks of (row, position, hash): each letter left out, of a run of
    equal letters the first."""
    n, length = matrix.shape
    step = max(1, CHUNK // length)
    places = np.arange(length)[None, :]
    for rows in range(0, n, step):
        part = matrix[rows:rows + step]
        own = term(places, part)
        before = np.cumsum(own, axis=1, dtype=np.uint64) - own
        moved = term(np.maximum(places - 1, 0), part)
        after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        keep = np.ones(part.shape, bool)
        keep[:, 1:] = part[:, 1:] != part[:, :-1]
        r, p = np.nonzero(keep)
        yield r + rows, p, (before + after)[r, p]


# --- filters -------------------------------------------------------------------

def layout(sizes: dict[int, int], most_bytes: int) -> list[dict[int, tuple[int, dict[int, tuple[int, int]]]]]:
    """Passes of shards, from the number of words of each length shard: per
    pass {length shard: (parts, {part: (first block, blocks)})}."""
    passes, used = [{}], 0
    most = max(1, most_bytes // (BITS // 8))
    for shard, words in sorted(sizes.items()):
        bits = BITS_PER_LONG_WORD if shard >= LONG else BITS_PER_WORD
        blocks = max(16, -(-words * bits // BITS))
        parts = -(-blocks // most)
        for part in range(parts):
            size = -(-blocks // parts)
            if used and used + size > most:
                passes.append({})
                used = 0
            passes[-1].setdefault(shard, (parts, {}))[1][part] = (used, size)
            used += size
    return passes


def placed(hashes: np.ndarray, shard: tuple[int, dict[int, tuple[int, int]]]):
    """(which keys fall into this pass, their block, the value their bits come from)."""
    parts, held = shard
    mixed = _mixed(hashes)
    part = (mixed >> np.uint64(40)) % np.uint64(parts)
    first, blocks = np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    for k, (at, size) in held.items():
        first[k], blocks[k] = at, size
    here = np.flatnonzero(blocks[part.astype(np.int64)])
    part, mixed = part[here].astype(np.int64), mixed[here]
    block = first[part] + ((mixed & np.uint64(0xFFFFFFFF)) % blocks[part].astype(np.uint64)).astype(np.int64)
    return here, block, _mixed(mixed + np.uint64(0x9E3779B97F4A7C15))


def _bit(block: np.ndarray, value: np.ndarray, k: int):
    """(64-bit word, mask) of a key's k-th bit: nine bits of the value, or of
    its mix from the eighth on, say where in the block."""
    bit = ((value if k < 7 else _mixed(value)) >> np.uint64(9 * (k % 7))) & np.uint64(BITS - 1)
    return block * (BITS // 64) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


def positives(words: np.ndarray, block: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Indices of the keys whose bits are all set."""
    at = np.arange(len(block))
    for k in range(PROBES):
        word, mask = _bit(block[at], value[at], k)
        at = at[(words[word] & mask) != 0]
        if not len(at):
            break
    return at


def _shard(length: int) -> int:
    return min(length, LONG)


def _by_length(words: list[str]):
    """(length, the words of that length) of a batch."""
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    return groups.items()


def build_filter(words: DataFrame, shards: dict) -> np.ndarray:
    """The filter of one pass as 64-bit words: tasks set bits, an aggregate
    ors them; at most the pass's bytes reach the driver."""
    size = sum(blocks for _, held in shards.values() for _, blocks in held.values()) * (BITS // 64)

    def run(batches):
        own = np.zeros(size, np.uint64)
        for batch in batches:
            for length, some in _by_length(batch.column(0).to_pylist()):
                _, block, value = placed(word_hashes(codes(some)), shards[_shard(length)])
                for k in range(PROBES):
                    np.bitwise_or.at(own, *_bit(block, value, k))
        at = np.flatnonzero(own)
        for a in range(0, len(at), 1 << 18):
            i = at[a:a + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(own[i].view(np.int64))], names=["i", "bits"])

    lengths = [s for s in shards if s < LONG]
    rows = words.where(F.col("chars").isin(lengths) | (F.lit(LONG in shards) & (F.col("chars") >= LONG)))
    found = (rows.select("word").mapInArrow(run, "i bigint, bits bigint")
             .groupBy("i").agg(F.expr("bit_or(bits)").alias("bits")).toArrow())
    out = np.zeros(size, np.uint64)
    out[found.column("i").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def edits(words: list[str], shards: dict, filter_words: np.ndarray):
    """(row, edit) of the edits of `words` that the filter lets through."""
    for length, some in _by_length(words):
        matrix = codes(some)
        if _shard(length) in shards:
            for row, place, letter, hashes in replacements(matrix):
                here, block, value = placed(hashes, shards[_shard(length)])
                for i in here[positives(filter_words, block, value)].tolist():
                    w, p = some[row[i]], place[i]
                    yield w, w[:p] + chr(letter[i]) + w[p + 1:]
        if _shard(length - 1) in shards:
            for row, place, hashes in deletions(matrix):
                here, block, value = placed(hashes, shards[_shard(length - 1)])
                for i in here[positives(filter_words, block, value)].tolist():
                    w, p = some[row[i]], place[i]
                    yield w, w[:p] + w[p + 1:]


def near_pairs(words: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """`(word, n, near, near_n)`, every ordered pair of near words.

    `words (word, n, chars)` must be written: each pass reads it again."""
    sc = words.sparkSession.sparkContext
    shard = F.least(F.col("chars"), F.lit(LONG))
    sizes = dict(words.groupBy(shard.alias("shard")).count().collect())  # at most LONG + 1 rows
    found = None
    for shards in layout(sizes, most_bytes):
        if not shards:
            continue
        held = sc.broadcast(build_filter(words, shards))

        def run(batches, shards=shards, held=held):
            for batch in batches:
                counts = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                out: tuple[list, list] = ([], [])
                for pair in edits(list(counts), shards, held.value):
                    out[0].append(pair[0])
                    out[1].append(pair[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.string()), pa.array([counts[w] for w in out[0]], pa.int64()),
                     pa.array(out[1], pa.string())], names=["word", "n", "near"])

        here = [s for s in shards] + [s + 1 for s in shards]
        rows = words.where(shard.isin(here)).select("word", "n")
        some = rows.mapInArrow(run, "word string, n bigint, near string")
        found = some if found is None else found.union(some)
    if found is None:
        return words.sparkSession.createDataFrame([], "word string, n bigint, near string, near_n bigint")
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    once = cut(found.join(other, "near").select("word", "n", "near", "near_n"), "spelling-pairs")
    return once.union(once.select("near", "near_n", "word", "n"))


# --- forms and roots -------------------------------------------------------------

def forms(pairs: DataFrame, ratio: int = 5) -> DataFrame:
    """`(word, n_near, form, form_n)`: the most frequent near word, smallest
    first, where its n is at least `ratio` times the word's."""
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    per = pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = F.col("best.m") * -1 >= ratio * F.col("n")
    return per.select("word", "n_near", F.when(enough, F.col("best.w")).alias("form"),
                      F.when(enough, -F.col("best.m")).alias("form_n"))


def roots(linked: DataFrame) -> DataFrame:
    """`(word, root)` for the words that have a form, by pointer jumping: n
    grows with every step, so there are no circles, and the number of rounds
    is the logarithm of the longest chain."""
    now = cut(linked.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        nxt = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut(now.join(nxt, "root", "left")
                    .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                    "spelling-roots")
        drop_cut(now)
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        now = moved


def spelling_variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, every: int = 199,
                      most_bytes: int = 32 << 20) -> DataFrame:
    """`(word, n, n_near, form, form_n, root)`, one row per frequent word."""
    words = vocabulary(docs, min_chars, min_count, every)
    named = cut(forms(near_pairs(words, most_bytes), ratio), "spelling-forms")
    end = roots(named.where("form IS NOT NULL"))
    return (words.join(named, "word", "left").join(end, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n",
                    F.coalesce("root", "word").alias("root")))


#: DuckDB twin for the parameters 6, 5, 5 and 199: CRC-32 byte by byte from a
#: table made by its rule, near words by joins on the words less one letter.
ORACLE_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM documents),
per AS (SELECT doc_id, w, count(*) AS n FROM runs GROUP BY doc_id, w),
hashed AS (
  SELECT w, n, xor(list_reduce([4294967295] || list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
                               lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM (SELECT w, n, hex(encode(doc_id || ':' || w)) AS x FROM per), tab),
said AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word, n
  FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM said WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) u(i)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, n, near, near_n,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM pairs),
forms AS (
  SELECT word, n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM best WHERE r = 1),
chain AS (
  SELECT word, word AS root FROM words
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL),
ends AS (
  SELECT c.word, c.root FROM chain c LEFT JOIN forms f ON c.root = f.word WHERE f.form IS NULL)
SELECT w.word, w.n, coalesce(f.n_near, 0) AS n_near, f.form, f.form_n, e.root
FROM words w LEFT JOIN forms f ON w.word = f.word JOIN ends e ON w.word = e.word
"""
