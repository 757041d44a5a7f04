import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from innlake.llm import bpe, queries
from innlake.llm.pieces import Splitter

tiktoken = pytest.importorskip("tiktoken")

TEXTS = [None, "", " ", "\n\n  \n", "Hello world's   it'll  don't", "ÄÖ été ñandú", "日本語のテキスト 😀👩‍👩‍👧 x", "a" * 3000, "  leading", "trailing  ", "x y z\u0085q",
         "1234567 ½ ² ٣٤", "<|endoftext|> and <|im_start|>", "tabs\t\tand\r\nlines", "\x1c\x1d_\x00", "ﬁ ǅ ͤ̀ ‍", "don’t", "word " * 4000]


@pytest.fixture(scope="module")
def files():
    return queries.byte_bpe()


@pytest.fixture(scope="module")
def reference(files):
    return tiktoken.Encoding("own", pat_str=files[1], mergeable_ranks=files[0], special_tokens={})


def test_ids_and_round_trip(spark, files, reference):
    docs = spark.createDataFrame([(k, t, "x", 3) for k, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x", 3)], "doc_id long, text string, ids string, decoded int")
    rows = bpe.decode(bpe.encode(docs, *files), files[0]).collect()
    assert len(rows) == len(TEXTS) + 1
    for row in rows:
        assert list(row.ids) == reference.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()


def test_expression_gives_the_same_ids(spark, files, reference):
    words = ["a", "hello", " unbelievable", "été", "zzzzzz", " 😀", "'s", "xqjkw"]
    ranks = bpe.RankMap.of(spark, files[0])
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", bpe.word_ids(F.col("w"), ranks).alias("ids")).collect()
    assert all(list(r.ids) == reference.encode_ordinary(r.w) for r in rows)


def test_every_letter_before_a_suffix(files, reference):
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    splitter, table = Splitter(files[1]), bpe.MergeTable(files[0])
    for low in range(0, len(letters), 100_000):
        text = "".join(f"{x}'s 1{x} {x}" for x in letters[low : low + 100_000])
        words, index, rows = splitter.distinct([text])
        assert bpe.spread(*table.fold(words), index, rows)[0].tolist() == reference.encode_ordinary(text)


def test_long_pieces(files, reference):
    table = bpe.MergeTable(files[0])
    chance = random.Random(1)
    words = ["".join(chance.choices("etaoin", k=k)).encode() for k in (2, 255, 256, 257, 1000, 5000)] + [b"", b"ab", "日本語".encode() * 300]
    ids, bounds = table.fold(words)
    for k, word in enumerate(words):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == reference.encode_ordinary(word.decode())
    long = "".join(chr(0x4E00 + k * 7919 % 20000) for k in range(350_000)).encode()
    start = time.time()
    ids, _ = table.fold([long])
    assert time.time() - start < 20 and ids.tolist() == reference.encode_ordinary(long.decode())


def test_empty_table(spark, files):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), *files).count() == 0


def test_query(spark, sf_dir, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    for row in queries.op7_byte_bpe(spark, sf_dir).collect():
        ids = reference.encode_ordinary(docs[row.doc_id])
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), digest(" ".join(map(str, ids)).encode()), digest(docs[row.doc_id].encode()))
