import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from innlake.llm import queries, wavelet
from innlake.llm.arrowtext import text_buffers
from innlake.llm.wavelet import Encoder, WaveletMatrix, ids_with_sums, read_ids, read_shard, write_ids, write_shard
from innlake.llm.workspace import shared_folder

PATTERN = queries.byte_bpe()[1]
tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def content():
    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def reference(content):
    return tokenizers.Tokenizer.from_str(content)


@pytest.mark.parametrize("size,top", [(0, 1), (1, 1), (512, 2), (513, 50257), (5000, 300)])
def test_rank_select_access(size, top):
    ids = np.random.default_rng(size).integers(0, top, size)
    m = WaveletMatrix.of(ids)
    assert m.all().tolist() == ids.tolist()
    at = np.arange(0, size, 7)
    assert m.access(at).tolist() == ids[at].tolist()
    for value in {0, 1, top - 1, *ids[:5].tolist(), 10**6}:
        assert m.occurrences(value).tolist() == np.flatnonzero(ids == value).tolist()
        assert m.count(value) == (ids == value).sum()
        assert m.count(value, size // 3, size // 2) == (ids[size // 3 : size // 2] == value).sum()


def test_shard_bytes_round_trip():
    docs, sizes, m = read_shard(write_shard([5, None, 7], np.array([2, 1, 0]), np.array([9, 0, 50256])))
    assert docs == [5, None, 7] and sizes.tolist() == [2, 1, 0] and m.all().tolist() == [9, 0, 50256]
    with pytest.raises(ValueError):
        read_shard(b"something else")


def brute(rows, reference):
    encoded = sorted(((d, reference.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc, ids in encoded:
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [1 << 21, 10])
def test_files_against_the_library(spark, content, reference, shard_ids):
    rows = [(k * 3 % 40, t) for k, t in enumerate(["Hello world", None, "", "a\n\n b", "été 😀", "<|endoftext|>", "x" * 5000, "same", "same"] * 4)]
    rows = [(k, t) for k, (_, t) in enumerate(rows)][::-1] + [(None, "no id")]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, bucket string")
    got = ids_with_sums(docs, content, PATTERN, shard_ids=shard_ids).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == brute(rows, reference)


LETTERS = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u2003", "\u0085", "\x1c", "\u200b", "a", "bc", "'s", "'ll", "12", "é", "日本", "😀",
           ".", "!!", "\U0001DF00", "\U0002EBF0", "\U000105C0"]


def test_units_are_encoded_as_in_their_text(content, reference):
    chance, encoder = random.Random(5), Encoder(content, PATTERN)
    for _ in range(5):
        texts = ["".join(chance.choices(LETTERS, k=chance.randint(0, 12))) for _ in range(2000)]
        ids, bounds = encoder.encode(*text_buffers(pa.array(texts)))
        for k, text in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_letter_before_a_suffix(content, reference):
    encoder = Encoder(content, PATTERN)
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(letters), 50_000):
        text = "".join(f"{x}'s 1{x} {x}" for x in letters[low : low + 50_000])
        ids, _ = encoder.encode(*text_buffers(pa.array([text])))
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids


def test_added_tokens_do_not_cross_texts(content, reference):
    texts = ["a <|endof", "text|> b", "<|endoftext|>", "<|endoftext", "|><|endoftext|>"]
    ids, bounds = Encoder(content, PATTERN).encode(*text_buffers(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def test_memo_starts_anew(content, monkeypatch, reference):
    monkeypatch.setattr(wavelet, "MOST_KNOWN", 2)
    encoder = Encoder(content, PATTERN)
    for text in ("one two three", "two four five", "", "one"):
        assert encoder.encode(*text_buffers(pa.array([text])))[0].tolist() == reference.encode(text, add_special_tokens=False).ids


def test_a_piece_is_encoded_once_in_several_units(content, reference):
    encoder, asked = Encoder(content, PATTERN, r" ?[A-Za-z]+|[^\sA-Za-z]+|\s+"), []
    encoder.tokenizer = SimpleNamespace(model=SimpleNamespace(tokenize=lambda piece: asked.append(piece) or reference.model.tokenize(piece)))
    for text in ("x word, é", "x word. word", "x word! é? word,"):
        assert encoder.encode(*text_buffers(pa.array([text])))[0].tolist() == reference.encode(text, add_special_tokens=False).ids
    assert len(asked) == len(set(asked)) == 7


@pytest.mark.parametrize("end_id, kind", [(0, "<u2"), ((1 << 16) - 1, "<u2"), (1 << 16, "<u4")])
def test_ids_travel_as_narrow_as_they_may(spark, content, reference, end_id, kind):
    assert wavelet.id_type(content, end_id) == kind
    folder = shared_folder(spark)
    write_ids(spark.createDataFrame([(2, "b c"), (1, "a 😀")], "doc_id long, text string"), content, PATTERN, folder, end_id)
    rows = read_ids(spark, folder).orderBy("start").collect()
    assert [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in rows] == [[*reference.encode(t).ids, end_id] for t in ("a 😀", "b c")]


def test_repeated_ids_and_reading_back(spark, content, reference):
    folder = shared_folder(spark)
    docs = spark.createDataFrame([(1, "b c"), (1, "b c"), (1, "a")], "doc_id long, text string")
    write_ids(docs, content, PATTERN, folder)
    rows = read_ids(spark, folder).orderBy("start").collect()
    texts = [reference.decode(np.frombuffer(bytes(r.ids), "<u4")[:-1].tolist()) for r in rows]
    assert sorted(texts) == ["a", "b c", "b c"] and rows[-1].start + rows[-1].n_ids == 8


def test_empty_table(spark, content):
    assert ids_with_sums(spark.createDataFrame([], "doc_id long, text string"), content, PATTERN).count() == 0


def test_query(spark, sf_dir, reference):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op9_wavelet_ids(spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == brute(rows, reference)
