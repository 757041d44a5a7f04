import hashlib
import json
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from innlake.llm import queries, word_bpe
from innlake.llm.arrowtext import text_buffers

tokenizers = pytest.importorskip("tokenizers")

TEXTS = [None, "", " ", " \n\t", "Hello WORLD's it'll don't I'LL", "ÄÖ été ñandú", "日本語のテキスト 😀👩‍👩‍👧 x", "a" * 3000, "  leading", "trailing  ", "x y z\u0085q",
         "1234567 ½ ² ٣٤", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|><|endoftext|>", "tabs\t\tand\r\nlines", "\x1c\x1d_\x00", "ﬁ ǅ ͤ̀ ‍ é", "ΑΣ Σ. ΣΑΣ",
         "don’t", "word " * 4000, "\U0001DF00's \U0002EBF0's \U000105C0's", "İstanbul ẞ ß"]


@pytest.fixture(scope="module")
def content():
    return queries.tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(content):
    return tokenizers.Tokenizer.from_str(content)


def test_equal_to_the_library(spark, content, library):
    docs = spark.createDataFrame([(k, t, "x", 3) for k, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x", 3)], "doc_id long, text string, ids string, decoded int")
    rows = word_bpe.decode(word_bpe.encode(docs, content), content).collect()
    assert len(rows) == len(TEXTS) + 1
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert list(row.ids) == ids, row.text
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_every_letter_beside_a_suffix(content, library):
    encoder = word_bpe.Encoder(content)
    letters = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(letters), 5000):
        text = " ".join(f"{x}'s1{x}" for x in letters[low : low + 5000])
        ids, _ = encoder.encode(*text_buffers(pa.array([text])))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_forest_and_single_tree_agree_with_plain_merging(content):
    merges = word_bpe.Merges(content)
    chance = random.Random(3)
    words = ["".join(chance.choices("abcehinorstu", k=chance.randint(2, 64))) for _ in range(300)] + ["aa", "aaa" * 7, "the", "inininin"]

    def plain(ids):
        while True:
            ranks = [merges.by_pair.get(a << 32 | b, (1 << 40, 0)) for a, b in zip(ids, ids[1:])]
            if not ranks or min(ranks)[0] == 1 << 40:
                return ids
            at = ranks.index(min(ranks))
            ids = [*ids[:at], ranks[at][1], *ids[at + 2 :]]

    ids, bounds = word_bpe.merged(words, merges)
    for k, word in enumerate(words):
        want = plain(merges.symbols(word))
        assert ids[bounds[k] : bounds[k + 1]].tolist() == want == word_bpe.merged_long(merges.symbols(word), merges)


def test_long_piece_takes_near_linear_time(content, library):
    long = "".join(chr(0x4E00 + k * 7919 % 20000) for k in range(350_000))
    start = time.time()
    ids, _ = word_bpe.Encoder(content).encode(*text_buffers(pa.array([long])))
    assert time.time() - start < 30
    assert ids.tolist() == library.encode(long, add_special_tokens=False).ids


def test_memo_starts_anew(content, monkeypatch, library):
    monkeypatch.setattr(word_bpe, "MOST_KNOWN", 3)
    encoder = word_bpe.Encoder(content)
    for text in ("one two three four", "five six one", "two seven", ""):
        ids, bounds = encoder.encode(*text_buffers(pa.array([text, text])))
        assert ids[bounds[1] :].tolist() == ids[: bounds[1]].tolist() == library.encode(text, add_special_tokens=False).ids


def test_vocabulary_without_a_letter(library, content):
    parsed = json.loads(content)
    parsed["model"]["vocab"] = {k: v for k, v in parsed["model"]["vocab"].items() if k not in ("z", "z</w>")}
    parsed["model"]["merges"] = [m for m in parsed["model"]["merges"] if all(x in parsed["model"]["vocab"] for x in (*m, "".join(m)))]
    small = json.dumps(parsed)
    own = tokenizers.Tokenizer.from_str(small)
    for text in ("zebra fuzz z zz buzzing",):
        ids, _ = word_bpe.Encoder(small).encode(*text_buffers(pa.array([text])))
        assert ids.tolist() == own.encode(text, add_special_tokens=False).ids


def test_empty_table_and_null_ids(spark, content):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert word_bpe.decode(word_bpe.encode(empty, content), content, pack=True).count() == 0
    rows = word_bpe.decode(spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>"), content).collect()
    assert [r.decoded for r in rows] == ["", "", '! "']


def test_query(spark, sf_dir, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op12_word_bpe(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        want = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), *want)
