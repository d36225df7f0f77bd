"""Cross-tokenizer alignment with token-byte incidence matrices.

A text is encoded by two tokenizers, A (byte-level BPE) and B (sentencepiece),
over the same bytes.  Each encoding is a sparse 0/1 matrix, tokens by bytes,
in compressed rows (`Csr`, built by hand).  Gustavson's row products give

* A times B transposed: the overlap links, with the number of shared bytes;
* group incidence, groups by tokens: a group ends where tokens of both end,
  and A's group incidence transposed times B's gives the links of tokens that
  share a group.

The rows of a product are made block by block, so memory is bounded by the
result and not by the bytes.

Segments.  Both tokenizers cut a text at a space between a visible character
and a letter (A's pre-token pattern does, and no piece of B has a space
behind another character, which is checked when the model is loaded).  The
matrices are therefore block diagonal over such segments, and a segment is
encoded and multiplied once per task and held in a bounded memo; a document
is the sum of its segments.

Corpus counts.  The first pass encodes the texts and writes, per document, its
sums and its linked (A id, B id) pairs with their numbers.  From these files
the documents of each pair are counted, added up inside the tasks first, and
in a last pass looked up in a broadcast table of at most `most_pairs` pairs;
beyond it, the pairs are dealt by hash into as many tables as it takes and the
files are read once per table, adding up, so that no pair is ever left out.

Defined results
---------------
* A text that is null or empty, or that A or B do not give back byte for byte
  (B replaces U+2581), has no tokens: zeros, and an empty digest.
* Special tokens' strings inside texts are plain text.
* Every row is a document, also with a repeated or no id.
* An empty table gives an empty result; other columns are not read.
* Very long texts are read in pieces of segments.  One segment (a text with
  no space before a letter, at worst) is encoded whole.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .bpe import PATTERN, _slices, token_bytes
from .shared import cut

#: Where both tokenizers always cut: the space belongs to what follows.
SAFE = re.compile(r"(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ.,;:!?'\")(-]) (?=[A-Za-zÀ-ÖØ-öø-ÿ])")
SPACE = "▁"
PIECE = 1 << 20
#: A pair of ids is one unsigned 32-bit number.
B_BITS = 16
MOST_SEGMENTS, MOST_BYTES = 400_000, 160 << 20
CHUNK_BYTES = 1 << 18
#: Segments that begin and end like those in the middle of a text, and hold only
#: characters that every version of the character tables puts into the same
#: class.  Many of them joined are encoded like each alone, and tiktoken, given
#: A's vocabulary, encodes them like A's own library, and faster.
WORDS = re.compile(r"""[A-Za-zÀ-ÖØ-öø-ÿ](?:[\t\n\r -~À-ÖØ-öø-ÿ]*[0-9A-Za-zÀ-ÖØ-öø-ÿ.,;:!?'\")(-])?""")


class Csr:
    """A sparse matrix in compressed rows; `values` are counts, or ones."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, width: int, values: np.ndarray | None = None):
        self.starts, self.columns, self.width, self.values = starts, columns, width, values

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of_intervals(cls, ends: np.ndarray) -> Csr:
        """Row i holds the columns from the end of row i - 1 up to `ends[i]`:
        tokens by bytes, or groups by tokens."""
        starts = np.concatenate(([0], ends)).astype(np.int64)
        return cls(starts, np.arange(starts[-1]), int(starts[-1]))

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(self.height), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Csr(starts, rows[order], self.height, None if self.values is None else self.values[order])

    def products(self, other: Csr, step: int = 1 << 18):
        """Gustavson: a row of the product is the sum of the rows of `other`
        that the row of this matrix names.  Yields (rows, columns, values) of
        runs of rows with about `step` terms."""
        sizes = np.diff(other.starts)
        terms = np.concatenate(([0], np.cumsum(sizes[self.columns])))[self.starts]  # before each row
        at = 0
        while at < self.height:
            stop = max(at + 1, int(np.searchsorted(terms, terms[at] + step, "right")) - 1)
            named = self.columns[self.starts[at]:self.starts[stop]]
            owner = np.repeat(np.arange(at, stop), np.diff(self.starts[at:stop + 1]))
            count = sizes[named]
            first = np.cumsum(count) - count
            place = np.arange(int(count.sum())) - np.repeat(first - other.starts[named], count)
            key = np.repeat(owner, count) * other.width + other.columns[place]
            weight = np.ones(len(key), np.int64)
            if self.values is not None:
                weight *= np.repeat(self.values[self.starts[at]:self.starts[stop]], count)
            if other.values is not None:
                weight *= other.values[place]
            if np.any(key[1:] < key[:-1]):
                order = np.argsort(key, kind="stable")
                key, weight = key[order], weight[order]
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
            if len(new):
                yield key[new] // other.width, key[new] % other.width, np.add.reduceat(weight, new)
            at = stop

    def product(self, other: Csr) -> Csr:
        parts = list(self.products(other)) or [(np.empty(0, np.int64),) * 3]
        rows, columns, values = (np.concatenate(x) for x in zip(*parts))
        starts = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=self.height))))
        return Csr(starts, columns, other.width, values)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.starts))


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.a_bytes = token_bytes(a_path)
        import tiktoken

        special = set(self.a.get_added_tokens_decoder())
        ranks = {b: i for i, b in enumerate(self.a_bytes) if i not in special}
        self.plain = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("the second vocabulary has pieces over several words")
        if max(len(pieces), len(self.a_bytes)) > 1 << B_BITS:
            raise ValueError("a vocabulary has more than 65,536 entries")
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode("utf-8")
                        for i, p in enumerate(pieces)]
        self.a_size = np.array(list(map(len, self.a_bytes)))
        self.b_size = np.array(list(map(len, self.b_bytes)))

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = self.a.encode_batch_fast([" " + s for s in segments], add_special_tokens=False)
        return [e.ids for e in a], self.b.encode(segments, num_threads=1)

    def faithful(self, segment: str, a: list[int], b: list[int]) -> bool:
        whole = b" " + segment.encode("utf-8")
        return (b"".join(map(self.a_bytes.__getitem__, a)) == whole
                and b"".join(map(self.b_bytes.__getitem__, b)) == whole)


class Alignment:
    """The matrices of two encodings `a`, `b` (ids) of the same bytes."""

    def __init__(self, tokenizers: Tokenizers, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        a_ends, b_ends = np.cumsum(tokenizers.a_size[a]), np.cumsum(tokenizers.b_size[b])
        self.ends = a_ends
        at = np.searchsorted(b_ends, a_ends)
        shared = np.flatnonzero(b_ends[np.minimum(at, max(0, len(b) - 1))] == a_ends) if len(b) else np.empty(0, int)
        self.group_a = Csr.of_intervals(shared + 1)
        self.group_b = Csr.of_intervals(at[shared] + 1)
        self.tokens_a, self.tokens_b = Csr.of_intervals(a_ends), Csr.of_intervals(b_ends)

    def links(self):
        """(A token, B token, shared bytes) of all overlaps."""
        got = self.tokens_a.product(self.tokens_b.transposed())
        return got.rows(), got.columns, got.values

    def shared_links(self):
        """Blocks of (A token, B token) that share a group."""
        for rows, columns, _ in self.group_a.transposed().products(self.group_b):
            yield rows, columns

    def shared_sizes(self) -> np.ndarray:
        """The entries in each row of that product: its symbolic phase, as
        every token is in one group."""
        return np.diff(self.group_b.starts)[self.group_a.transposed().columns]

    def spelled(self, tables: list[str]) -> tuple[np.ndarray, list[str]]:
        """The groups spelled out, `a1,a2|b1;`, as the strings of their tokens
        in order, and the place behind each group.  `tables` are the strings
        of A ids before `,` and before `|`, then of B ids before `,` and `;`."""
        n_a = len(tables) // 2 - (1 << B_BITS)
        a_ends, b_ends = self.group_a.starts, self.group_b.starts
        text = np.empty(len(self.a) + len(self.b), np.int64)
        sizes_a, sizes_b = np.diff(a_ends), np.diff(b_ends)
        text[np.arange(len(self.a)) + np.repeat(b_ends[:-1], sizes_a)] = self.a
        text[np.arange(len(self.b)) + np.repeat(a_ends[1:], sizes_b)] = self.b + 2 * n_a
        text[a_ends[1:] + b_ends[:-1] - 1] += n_a
        text[a_ends[1:] + b_ends[1:] - 1] += 1 << B_BITS
        return a_ends[1:] + b_ends[1:], list(map(tables.__getitem__, text.tolist()))


def spelling(tokenizers: Tokenizers) -> list[str]:
    """The strings that `Alignment.spelled` takes."""
    return [f"{i}{end}" for n, ends in ((len(tokenizers.a_bytes), ",|"), (1 << B_BITS, ",;")) for end in ends for i in range(n)]


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists one behind the other, and their lengths."""
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64), np.array(list(map(len, lists)), np.int64)


class Segments:
    """Memo of segments by number: their sums, their links (pairs of ids as
    keys, one behind the other) and their groups' text."""

    SUMS = ("bad", "n_a", "n_b", "n_groups", "n_links", "n_shared")
    LINKS = SUMS.index("n_links")

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.tables = spelling(tokenizers)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.sums = np.zeros((1024, len(self.SUMS)), np.int64)
        self.first = np.zeros(1025, np.int64)
        self.keys = np.empty(4096, np.int64)
        self.texts: list[str] = []
        self.held = 0

    def learn(self, segments, room: int = 1) -> None:
        """Encode and multiply the segments that are not held yet.  A memo
        over `room` times its bounds is emptied first."""
        if len(self.number) > room * MOST_SEGMENTS or self.held > room * MOST_BYTES:
            self.clear()
        fresh = [s for s in dict.fromkeys(segments) if s not in self.number]
        words = [s for s in fresh if WORDS.fullmatch(s)]
        if len(words) < len(fresh):
            held = set(words)
            self._add_all([s for s in fresh if s not in held], self._encode)
        self._add_all(words, self._encode_words)

    def _add_all(self, fresh: list[str], encode) -> None:
        at = 0
        while at < len(fresh):
            stop, size = at, 0
            while stop < len(fresh) and (stop == at or size < CHUNK_BYTES):
                size += len(fresh[stop])
                stop += 1
            self._add(fresh[at:stop], *encode(fresh[at:stop]))
            self.held += 12 * size + 200 * (stop - at)
            at = stop

    def links(self, numbers: list[int]) -> np.ndarray:
        """The keys of all links of some segments."""
        at = np.array(numbers)
        first, count = self.first[at], self.sums[at, self.LINKS]
        last = np.cumsum(count)
        return self.keys[np.arange(last[-1]) + np.repeat(first - last + count, count)]

    def _encode(self, fresh: list[str]):
        """(which are given back byte for byte, ids of A and of B of these one
        behind the other, their numbers of tokens)."""
        a, b = self.tokenizers.encode(fresh)
        good = [i for i in range(len(fresh)) if self.tokenizers.faithful(fresh[i], a[i], b[i])]
        ids_a, count_a = flat([a[i] for i in good])
        ids_b, count_b = flat([b[i] for i in good])
        return good, ids_a, count_a, ids_b, count_b

    def _encode_words(self, fresh: list[str]):
        """The same for segments that are `WORDS`: A takes them joined."""
        t = self.tokenizers
        joined = " " + " ".join(fresh)
        raw = joined.encode()
        ids_a = t.plain.encode_to_numpy(joined).astype(np.int64)
        ids_b, count_b = flat(t.b.encode(fresh, num_threads=1))
        ends = np.cumsum(np.array(list(map(len, map(str.encode, fresh))), np.int64) + 1)
        bytes_a = np.cumsum(t.a_size[ids_a])
        upto = np.searchsorted(bytes_a, ends)
        if not (np.array_equal(bytes_a[upto], ends) and count_b.all()
                and np.array_equal(np.cumsum(t.b_size[ids_b])[np.cumsum(count_b) - 1], ends)
                and b"".join(map(t.a_bytes.__getitem__, ids_a.tolist())) == raw
                and b"".join(map(t.b_bytes.__getitem__, ids_b.tolist())) == raw):
            return self._encode(fresh)  # some text is not given back
        return range(len(fresh)), ids_a, np.diff(upto + 1, prepend=0), ids_b, count_b

    def _add(self, fresh: list[str], good, ids_a, count_a, ids_b, count_b) -> None:
        whole = Alignment(self.tokenizers, ids_a, ids_b)
        rows, columns, _ = whole.links()
        keys = (whole.a[rows] << B_BITS) | whole.b[columns]
        end_a = np.cumsum(count_a)                                   # A tokens up to each segment's end
        link_end = np.searchsorted(rows, end_a)
        group_end = np.searchsorted(whole.group_a.starts[1:], end_a, "right")
        per = [count_a, count_b, np.diff(group_end, prepend=0), np.diff(link_end, prepend=0)]

        shared = np.concatenate(([0], np.cumsum(whole.shared_sizes())))
        per.append(np.diff(shared[end_a], prepend=0))
        start, stop = len(self.number), len(self.number) + len(fresh)
        sums = np.zeros((len(fresh), len(self.SUMS)), np.int64)
        sums[:, 0] = 1
        good = np.array(good, np.int64)
        sums[good, 0] = 0
        for k, x in enumerate(per):
            sums[good, 1 + k] = x
        used = int(self.first[start])
        while stop > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            self.first = np.concatenate([self.first, np.zeros(len(self.first) - 1, np.int64)])
        while used + len(keys) > len(self.keys):
            self.keys = np.concatenate([self.keys, np.empty_like(self.keys)])
        self.sums[start:stop] = sums
        self.first[start + 1:stop + 1] = used + np.cumsum(sums[:, self.LINKS])
        self.keys[used:used + len(keys)] = keys
        self.number.update(zip(fresh, range(start, stop)))
        texts = [""] * len(fresh)
        ends, strings = whole.spelled(self.tables)
        at = 0
        for i, end in zip(good.tolist(), np.concatenate(([0], ends))[group_end].tolist()):
            texts[i] = "".join(strings[at:end])
            at = end
        self.texts += texts


def pieces(text: str, size: int = PIECE):
    """Parts of a text, cut where both tokenizers cut."""
    at = 0
    while len(text) - at > size:
        found = SAFE.search(text, at + size)
        if found is None:
            break
        yield text[at:found.start()]
        at = found.end()
    yield text[at:]


def _documents(batches, segments: Segments):
    """For each row of slices of the batches: (slice, iterator over (row, list
    of number lists)).  The texts of a slice are learnt together, those of
    more than one piece piece by piece."""
    for batch in batches:
        for part in _slices(batch, 1):
            texts = part.column(1).to_pylist()
            short = [SAFE.split(t) if t and len(t) <= PIECE else None for t in texts]

            def numbers(some, room):
                segments.learn(some, room)
                return list(map(segments.number.__getitem__, some))

            def rows():
                segments.learn(itertools.chain.from_iterable(x for x in short if x))
                for text, one in zip(texts, short):
                    if one is None:
                        yield (numbers(SAFE.split(p), 2) for p in pieces(text)) if text else iter(())
                        continue
                    try:
                        yield iter([list(map(segments.number.__getitem__, one))])
                    except KeyError:  # the memo was emptied for a long text
                        yield iter([numbers(one, 2)])

            yield part, rows()


SUMS = list(Segments.SUMS[1:])


def encoded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document `doc_id`, its sums, `groups_sha256`, and its linked pairs:
    `pairs`, the different ones in order, and `times`, the links of each, both
    packed as unsigned 32-bit integers."""

    def run(batches):
        segments = Segments(Tokenizers(a_path, b_path))
        for part, rows in _documents(batches, segments):
            sums, digests, pairs, times = [], [], [], []
            for row in rows:
                total, digest, waiting = np.zeros(len(Segments.SUMS), np.int64), hashlib.sha256(), ""
                keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
                for numbers in row:
                    total += segments.sums[numbers].sum(axis=0)
                    text = waiting + "".join(map(segments.texts.__getitem__, numbers))
                    waiting = text[-1:]  # a `;` if more follows
                    digest.update(text[:-1].encode())
                    more = np.unique(segments.links(numbers), return_counts=True)
                    if len(keys):
                        keys, at = np.unique(np.concatenate([keys, more[0]]), return_inverse=True)
                        counts = np.bincount(at, np.concatenate([counts, more[1]])).astype(np.int64)
                    else:
                        keys, counts = more
                whole = not total[0] and total[1]
                sums.append(total[1:] if whole else np.zeros(len(SUMS), np.int64))
                digests.append(digest.hexdigest() if whole else "")
                pairs.append(keys.astype("<u4").tobytes() if whole else b"")
                times.append(counts.astype("<u4").tobytes() if whole else b"")
            sums = np.array(sums).reshape(-1, len(SUMS))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(np.ascontiguousarray(sums[:, k])) for k in range(len(SUMS))),
                 pa.array(digests, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                names=["doc_id", *SUMS, "groups_sha256", "pairs", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{n} bigint" for n in SUMS)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {longs}, groups_sha256 string, pairs binary, times binary")


def pair_counts(documents: DataFrame) -> DataFrame:
    """`(a, b, n)`: the documents of `encoded` that hold a link of the ids a and b."""

    def run(batches):
        waiting, size = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            for at in range(0, len(keys), 1 << 17):
                k = keys[at:at + (1 << 17)].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((k >> B_BITS).astype(np.int32)), pa.array((k & ((1 << B_BITS) - 1)).astype(np.int32)),
                     pa.array(n[at:at + (1 << 17)])], names=["a", "b", "n"])

        for batch in batches:
            for pairs in batch.column(0).to_pylist():
                waiting.append(np.frombuffer(pairs, "<u4"))
                size += len(waiting[-1])
                if size > 1 << 22:
                    yield from flush()
                    waiting, size = [], 0
        if size:
            yield from flush()

    counts = documents.select("pairs").mapInArrow(run, "a int, b int, n bigint")
    return counts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def aligned(docs: DataFrame, a_path: str, b_path: str, most_pairs: int = 2_000_000) -> DataFrame:
    """Per document `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_shared`
    (links of tokens in one group), `n_best`, `count_sum` and `groups_sha256`.

    Both paths are opened by the tasks: the files are installed on every node
    or lie on a mounted path."""
    sc = docs.sparkSession.sparkContext
    documents = cut(encoded(docs, a_path, b_path), "alignment-documents")
    counts = cut(pair_counts(documents), "alignment-pairs")
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    ranked = cut(counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")),
                 "alignment-ranked")
    tables = max(1, -(-ranked.count() // most_pairs))
    sums = [f"{n} bigint" for n in [*SUMS, "n_best", "count_sum"]]
    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, groups_sha256 string, {', '.join(sums)}, pairs binary, times binary"
    names = ["doc_id", "groups_sha256", *SUMS, "n_best", "count_sum", "pairs", "times"]
    frame = documents.selectExpr("doc_id", "groups_sha256", *SUMS, "0L AS n_best", "0L AS count_sum", "pairs", "times")
    for table in range(tables):
        rows = ranked.where(F.pmod(F.xxhash64("a", "b"), F.lit(tables)) == table).toArrow()
        keys = (rows.column("a").to_numpy().astype(np.int64) << B_BITS) | rows.column("b").to_numpy()
        order = np.argsort(keys)
        held = sc.broadcast((keys[order], rows.column("n").to_numpy()[order],
                             rows.column("best").to_numpy()[order].astype(bool)))
        last = table == tables - 1

        def run(batches, held=held, last=last):
            known, n, best = held.value
            for batch in batches:
                found = np.column_stack([batch.column(k).to_numpy() for k in ("n_best", "count_sum")])
                for i, (pairs, times) in enumerate(zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist())):
                    key, count = np.frombuffer(pairs, "<u4").astype(np.int64), np.frombuffer(times, "<u4").astype(np.int64)
                    if len(key) and len(known):
                        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                        count = np.where(known[at] == key, count, 0)
                        found[i] += (count @ best[at], count @ n[at])
                columns = dict(zip(names, batch.columns)) | {
                    k: pa.array(np.ascontiguousarray(found[:, i])) for i, k in enumerate(("n_best", "count_sum"))}
                kept = names[:-2] if last else names
                yield pa.RecordBatch.from_arrays([columns[k] for k in kept], names=kept)

        if last:
            return frame.mapInArrow(run, ddl.removesuffix(", pairs binary, times binary"))
        frame = cut(frame.mapInArrow(run, ddl), "alignment-sums")


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The alignments themselves: per document `doc_id`, the ids `a`, `b`, the
    overlap `links` (A position, B position, shared bytes) and for each group
    the number of tokens up to its end, `groups` (of A, of B)."""

    def run(batches):
        tokenizers = Tokenizers(a_path, b_path)
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                a, b = [], []
                for part in pieces(text) if text else ():
                    for x, y in zip(*tokenizers.encode(SAFE.split(part))):
                        a += x
                        b += y
                if not tokenizers.faithful(text, a, b):
                    a, b = [], []
                one = Alignment(tokenizers, np.array(a, np.int64), np.array(b, np.int64))
                links = [dict(zip(("a", "b", "bytes"), x)) for x in zip(*(x.tolist() for x in one.links()))]
                groups = [dict(zip(("a", "b"), x)) for x in zip(one.group_a.starts[1:].tolist(), one.group_b.starts[1:].tolist())]
                yield pa.RecordBatch.from_pylist(
                    [{"doc_id": batch.column(0)[i].as_py(), "a": a, "b": b, "links": links, "groups": groups}], schema)

    kind = docs.schema["doc_id"].dataType
    ddl = (f"doc_id {kind.simpleString()}, a array<int>, b array<int>, links array<struct<a:int, b:int, bytes:int>>, "
           "groups array<struct<a:int, b:int>>")
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return docs.select("doc_id", "text").mapInArrow(run, ddl)
