import hashlib
import random
import struct

import pytest

from towertrace.llm import bpe
from towertrace.llm.queries import op4_bpe, vocabulary_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def samples():
    rnd = random.Random(9)
    letters = "ab cdeéñ  \n\t'sll t1234!?—你🙂\x1f\x85\xa0²½ǅﬁ" + "".join(chr(a) for a, _ in bpe.LATER_LETTERS)
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    return out + ["<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "<|endoftext|", "x" * 70, "ab" * 40, "\r\n \n", "q" * 5000]


def test_codec_equals_the_library(library):
    codec, bytes_of = bpe.Codec(vocabulary_path(), most=50), bpe.token_bytes(vocabulary_path())
    for text in samples():
        ids = library.encode(text, add_special_tokens=False).ids
        packed = codec.encode([text])[0]
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids, text
        assert bpe.decode(packed, bytes_of) == library.decode(ids, skip_special_tokens=False)


def test_tree_steps_equal_matrix_steps():
    v = bpe.Vocabulary(vocabulary_path())
    rnd = random.Random(4)
    pieces = [bytes(rnd.choice(b"abcdefgh etaoin\xc3\xa9") for _ in range(rnd.randint(1, 64))) for _ in range(400)]
    assert [list(struct.unpack(f"<{len(p) // 4}I", p)) for p in v.encode_pieces(pieces)] == [v.encode_piece(p) for p in pieces]


def test_root_names_the_leftmost_lowest_rank():
    rnd = random.Random(1)
    ranks = [rnd.randint(0, 9) for _ in range(21)]
    tree = bpe.PairTree(ranks)
    while min(ranks) < bpe.NONE:
        i = tree.leftmost_lowest()
        assert i == ranks.index(min(ranks))
        ranks[i] = rnd.choice([bpe.NONE, 11])if ranks[i] < 10 else bpe.NONE
        tree.put(i, ranks[i])
    assert tree.leftmost_lowest() == -1


def test_query_digests(spark, library, tmp_path):
    texts = [*samples(), None, "", "again", "again"]
    spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op4_bpe(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA).withColumnRenamed("lang", "ids").withColumnRenamed("source", "n_tokens")
    assert bpe.bpe_decode(bpe.bpe_encode(df, vocabulary_path()), vocabulary_path()).count() == 0


def test_one_pass_equals_two(spark):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate([*samples(), None, ""])], "doc_id long, text string, n_tokens long")
    path = vocabulary_path()
    two = bpe.bpe_decode(bpe.bpe_encode(df, path), path)
    one = bpe.bpe_round_trip(df, path)
    assert one.columns == two.columns
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert bpe.bpe_round_trip(df.limit(0), path).count() == 0


def test_memo_is_bounded_in_bytes():
    codec = bpe.Codec(vocabulary_path(), most_bytes=20_000)
    for k in range(8):
        codec.encode([" ".join(f"w{k}{i}" for i in range(60))])
        assert codec.held < 20_000 + 60 * 200
