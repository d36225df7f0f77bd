"""Byte-level BPE encoding and decoding with segment trees.

A pre-token is a list of symbols; each adjacent pair has a rank (its place in
the merge list) or none.  A segment tree over the pair ranks holds the
smallest rank of every range, the left child winning ties, so the root names
the leftmost pair of lowest rank.  One merge changes three pair ranks, each a
logarithmic point update; the loop ends when the root is infinite.  A
pre-token of n bytes takes O(n log n), also when it is a text of 100,000
letters without a space.  Short pre-tokens are merged many at a time: their
trees are the rows of one numpy matrix and take their steps together.

Spark deals the documents out; a task encodes Arrow batches with a bounded
memo of pre-tokens.

Defined results
---------------
* A null or empty text has no ids and decodes to the empty text.
* The strings of added special tokens in a text become their ids.
* Repeated rows are encoded each; other columns are not read.
* An empty table gives an empty result.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-token pattern of the byte-level vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Code points that became letters or numbers after the character tables of
#: the vocabulary's library; to it they are neither (fixed values).
LATER_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]

#: Bytes of UTF-8 that no code point from U+0540 on begins with.
BELOW_LATER = bytes(range(0xD5))

NONE = 1 << 30
#: Pre-tokens of up to so many bytes are merged in matrices of trees.
SHORT = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file:
    a printable Latin-1 byte is its own letter, the others follow from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, spare = [""] * 256, 256
    for b in own:
        letters[b] = chr(b)
    for b in range(256):
        if not letters[b]:
            letters[b] = chr(spare)
            spare += 1
    return letters


class PairTree:
    """Segment tree over pair ranks; the root gives the leftmost minimum."""

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size = size
        self.low = [NONE] * size + ranks + [NONE] * (size - len(ranks))
        for i in range(size - 1, 0, -1):
            left, right = self.low[2 * i], self.low[2 * i + 1]
            self.low[i] = left if left <= right else right

    def leftmost_lowest(self) -> int:
        """Position of the leftmost pair of lowest rank, -1 if none is left."""
        low, i = self.low, 1
        if low[1] == NONE:
            return -1
        while i < self.size:
            i *= 2
            if low[i] > low[i + 1]:
                i += 1
        return i - self.size

    def put(self, position: int, rank: int) -> None:
        low = self.low
        i = position + self.size
        low[i] = rank
        i //= 2
        while i:
            left, right = low[2 * i], low[2 * i + 1]
            now = left if left <= right else right
            if low[i] == now:
                return
            low[i] = now
            i //= 2


class Vocabulary:
    """The vocabulary file, read by a task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.byte_ids = [vocab[c] for c in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        pairs = sorted((a << 17 | b, rank, new) for (a, b), (rank, new) in self.merges.items())
        self.pair_keys, self.pair_ranks, _ = (np.array(x, np.int64) for x in zip(*pairs))
        self.made = np.zeros(len(pairs), np.int64)
        self.made[self.pair_ranks] = [new for _, _, new in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        merges, none = self.merges, (NONE, -1)
        tree = PairTree([merges.get((ids[i], ids[i + 1]), none)[0] for i in range(n - 1)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (i := tree.leftmost_lowest()) >= 0:
            j = after[i]
            ids[i] = merges[ids[i], ids[j]][1]
            ids[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                tree.put(j, NONE)
            if k < n:
                before[k] = i
                tree.put(i, merges.get((ids[i], ids[k]), none)[0])
            else:
                tree.put(i, NONE)
            if (h := before[i]) >= 0:
                tree.put(h, merges.get((ids[h], ids[i]), none)[0])
        return [t for t in ids if t >= 0]


    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 17 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def encode_short(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Packed ids of pre-tokens of 2 to size + 1 bytes: row r of `low` is
        the segment tree of piece r, leaf p at column size + p."""
        n = len(pieces)
        ids = np.full((n, size + 2), -1, np.int64)
        lengths = np.array([len(p) for p in pieces])
        inside = np.arange(size + 2) < lengths[:, None]
        ids[inside] = np.array(self.byte_ids)[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.broadcast_to(np.arange(1, size + 3), (n, size + 2)).copy()
        before = after - 2
        low = np.full((n, 2 * size), NONE, np.int64)
        paired = inside[:, 1 : size + 1]
        low[:, size:][paired] = self._rank(ids[:, :size][paired], ids[:, 1 : size + 1][paired])
        for i in range(size - 1, 0, -1):
            low[:, i] = np.minimum(low[:, 2 * i], low[:, 2 * i + 1])

        def put(rows, leaf, rank):
            i = leaf + size
            low[rows, i] = rank
            while (i := i >> 1)[:1].any():
                low[rows, i] = np.minimum(low[rows, 2 * i], low[rows, 2 * i + 1])

        rows = np.flatnonzero(low[:, 1] < NONE)
        while len(rows):
            i = np.ones(len(rows), np.int64)
            while i[0] < size:
                i = 2 * i
                i += low[rows, i] > low[rows, i + 1]
            at = i - size
            gone = after[rows, at]
            new = self.made[low[rows, 1]]
            ids[rows, at], ids[rows, gone] = new, -1
            follows = after[rows, gone]
            after[rows, at] = follows
            before[rows, np.minimum(follows, size + 1)] = at
            inner = gone < size
            put(rows[inner], gone[inner], NONE)
            right = ids[rows, np.minimum(follows, size + 1)]
            has = (right >= 0) & (follows < lengths[rows])
            put(rows, at, np.where(has, self._rank(new, np.maximum(right, 0)), NONE))
            prior = before[rows, at]
            left = prior >= 0
            if left.any():
                put(rows[left], prior[left], self._rank(ids[rows[left], prior[left]], new[left]))
            rows = rows[low[rows, 1] < NONE]
        left = ids >= 0
        packed = ids[left].astype("<u4").tobytes()
        ends = np.concatenate(([0], 4 * np.cumsum(left.sum(1)))).tolist()
        return [packed[a:b] for a, b in zip(ends, ends[1:])]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many pre-tokens."""
        out = [b""] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            n = len(piece)
            if n == 1:
                out[k] = self.byte_ids[piece[0]].to_bytes(4, "little")
            elif n > SHORT:
                out[k] = np.array(self.encode_piece(piece), "<u4").tobytes()
            elif n:
                by_size.setdefault(1 << max(0, n - 2).bit_length(), []).append(k)
        for size, where in by_size.items():
            for at in range(0, len(where), 8192):
                block = where[at : at + 8192]
                for k, packed in zip(block, self.encode_short([pieces[k] for k in block], size)):
                    out[k] = packed
        return out


class Codec:
    """Encoder of one task with a memo, emptied beyond `most` pre-tokens or
    about `most_bytes`."""

    def __init__(self, path: str, most: int = 250_000, most_bytes: int = 64 << 20):
        import re

        import regex

        self.vocabulary = Vocabulary(path)
        later = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in LATER_LETTERS)
        self.find = regex.compile(PATTERN).findall
        self.has_later = re.compile(f"[{later}]").search
        letters, numbers = (rf"[\p{{{p}}}--[{later}]]" for p in "LN")
        self.find_late = regex.compile(
            PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{later}])")
            .replace(r"?\p{L}", f"?{letters}").replace(r"?\p{N}", f"?{numbers}"), regex.V1).findall
        self.special = {s: int(i).to_bytes(4, "little") for s, i in self.vocabulary.special.items()}
        self.split = regex.compile("(" + "|".join(
            map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.memo: dict[str, bytes] = {}
        self.most, self.most_bytes, self.held = most, most_bytes, 0

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and text.encode("utf-8").translate(None, BELOW_LATER) and self.has_later(text):
            return self.find_late(text)
        return self.find(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text."""
        parts: list[list] = []
        for text in texts:
            if not text:
                parts.append([])
            elif any(s in text for s in self.special):
                parts.append([x if x in self.special else self.pieces(x) for x in self.split(text)])
            else:
                parts.append([self.pieces(text)])
        if len(self.memo) > self.most or self.held > self.most_bytes:
            self.memo.clear()
            self.held = 0
        memo = self.memo
        fresh = set().union(*(p for part in parts for p in part if isinstance(p, list))).difference(memo)
        fresh = list(fresh)
        raw = [p.encode("utf-8") for p in fresh]
        self.held += 6 * sum(map(len, raw)) + 150 * len(raw)
        memo.update(zip(fresh, self.vocabulary.encode_pieces(raw)))
        return [b"".join(self.special[p] if isinstance(p, str) else b"".join(map(memo.__getitem__, p)) for p in part)
                for part in parts]


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    held = {i: bytes(byte_of[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    held |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [held.get(i, b"") for i in range(max(held) + 1)]


def decode(packed: bytes | None, bytes_of: list[bytes]) -> str:
    """Text of packed ids."""
    ids = np.frombuffer(packed or b"", "<u4").tolist()
    return b"".join(map(bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


def _slices(batch: pa.RecordBatch, column: int, rows: int = 256, size: int = 4 << 20):
    """Parts of a batch of at most `rows` rows and about `size` bytes."""
    at = 0
    step = max(1, min(rows, int(rows * size / max(size, batch.column(column).nbytes * rows / max(1, batch.num_rows)))))
    while at < batch.num_rows:
        yield batch.slice(at, step)
        at += step


def bpe_encode(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `key`, `n_tokens` and `ids`, the ids packed as
    little-endian unsigned 32-bit integers (the layout of a token shard).

    `vocabulary_path` is opened by the tasks: the file is installed on every
    node or lies on a mounted path.
    """

    def run(batches):
        codec = Codec(vocabulary_path)
        for batch in batches:
            for part in _slices(batch, 1):
                ids = codec.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=[key, "n_tokens", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, ids binary")


def bpe_decode(encoded: DataFrame, vocabulary_path: str, key: str = "doc_id") -> DataFrame:
    """Adds `decoded`, the text of the packed `ids`; bytes that are not UTF-8
    become U+FFFD, and special tokens are written out."""

    def run(batches):
        bytes_of = token_bytes(vocabulary_path)
        for batch in batches:
            for part in _slices(batch, 2):
                texts = [decode(x, bytes_of) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[key, "n_tokens", "ids", "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "n_tokens", "ids").mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids binary, decoded string")


def bpe_round_trip(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`bpe_encode` and `bpe_decode` in one pass: a task holds one codec, and
    the ids do not travel between two of them."""

    def run(batches):
        codec, bytes_of = Codec(vocabulary_path), token_bytes(vocabulary_path)
        for batch in batches:
            for part in _slices(batch, 1):
                ids = codec.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([decode(x, bytes_of) for x in ids], pa.string())],
                    names=[key, "n_tokens", "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, ids binary, decoded string")


def with_digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", "n_tokens", F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
