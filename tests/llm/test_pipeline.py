import hashlib
import random
import struct

import corpus_pipeline as P
from brute import components, simhash_fingerprint

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fixture(spark, top):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    item = text(30)
    rows, toxic = [], set()
    for i in range(260):
        t = text(rnd.randint(20, 80))
        if i % 4 == 0:
            t += " zorkuta vaximel zorkuno zorkusk vaxiur"
            toxic.add(i)
        rows.append((i, t))
    clean = [i for i, _ in rows if i not in toxic]
    rows += [(1000, rows[clean[0]][1].replace(" ", "  ")), (1001, rows[clean[1]][1]), (1002, f"{text(10)} {item} {text(10)}")]
    long = text(400).split(" ")
    rows += [(1100, " ".join(long)), (1101, " ".join([*long[:200], "other", *long[201:]])), (1102, None), (1103, "")]
    spark.createDataFrame([(i, t, "x", "s", None) for i, t in rows], DOCS).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(260)], "doc_id bigint, quality int, toxic int"
                          ).write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{top}/benchmark.parquet")
    return dict(rows), toxic


def test_stages_equal_brute_force(spark, tmp_path):
    import re

    from tokenizers import Tokenizer

    from towertrace.llm.queries import vocabulary_path

    top = str(tmp_path)
    texts, toxic = fixture(spark, top)
    docs, kept = spark.read.parquet(f"{top}/documents.parquet"), []
    for name, stage in P.STAGES:
        out = stage(spark, docs, top)
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    after_toxic = kept[0]
    wrong = (after_toxic & toxic) | (set(texts) - after_toxic - toxic)
    assert len(wrong) <= 0.05 * len(texts)
    groups = {}
    for i in sorted(after_toxic):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", texts[i] or ""), []).append(i)
    after_exact = {min(g, key=lambda i: (-len(texts[i] or ""), i)) for g in groups.values()}
    assert kept[1] == after_exact
    ids = sorted(after_exact)
    prints = [simhash_fingerprint(texts[i]) for i in ids]
    comp = components(ids, lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 3)
    assert kept[2] == {i for i in ids if comp[i] == i}
    assert kept[3] == kept[2] - {1002} and kept[4] == kept[3]
    library = Tokenizer.from_file(vocabulary_path())
    for r in docs.collect():
        got = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(got)}I", *got)).hexdigest()
    assert {r.doc_id for r in P.run(spark, top).collect()} == kept[4]


def test_empty_documents(spark, tmp_path):
    top = str(tmp_path)
    fixture(spark, top)
    empty = spark.read.parquet(f"{top}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        assert stage(spark, empty, top).count() == 0
