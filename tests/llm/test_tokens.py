"""Token files and byte-level BPE against the libraries on whole texts."""

import base64
import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm.byte_bpe import BytePairs, decode_column, encode_column, op8_byte_bpe, round_trip_digests
from tallyloom.llm.token_binary import NULL_ID, op1_token_binary, open_part, read_tokens, write_tokens
from tallyloom.llm.tokens import Encoder

from .conftest import TEXTS

ALPHABET = " \n\t'abcSTéß1²_-., ́ \x1c\x85中😀\r"


def mixed(n: int) -> list[str]:
    rng = random.Random(7)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)] + [t or "" for t in TEXTS]


def lines(n: int) -> list[str]:
    """Texts of words, marks and every run of line ends and spaces."""
    rng = random.Random(8)
    parts = ["word", "Word", "it's", "x.", "y,", "12", "é", " ", "  ", "\n", "\n\n", "\n\n\n", " \n", "\n ", "\t", "\r\n", "'s", " zurich", "$"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")])
def test_encoder_equals_the_library(name, kind):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    own, texts = Encoder(P.path(name), limit=50), mixed(3000) + lines(4000)
    assert own.kind == kind
    for k in range(0, len(texts), 100):
        part = texts[k : k + 100]
        want = [e.ids for e in t.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(part)] == want


def test_a_file_that_splits_in_another_way_gets_whole_texts(tmp_path):
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        other = json.load(file)
    other["pre_tokenizer"]["use_regex"] = False
    (tmp_path / "other.json").write_text(json.dumps(other))
    t = Tokenizer.from_file(str(tmp_path / "other.json"))
    own, texts = Encoder(str(tmp_path / "other.json")), ["the cat sat on the mat", "of the\nin the"]
    assert own.kind is None
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [e.ids for e in t.encode_batch(texts)]
    for k in range(0, len(texts), 100):
        part = texts[k : k + 100]
        assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(part)] == [e.ids for e in t.encode_batch(part, add_special_tokens=False)]


@pytest.mark.parametrize(("name", "parts"), [("word_bpe_49k.json", "a|word|.|,|(|)"), ("byte_bpe_50k.json", " Word| word| WORD|.|,| (|word|)")])
def test_parts_of_plain_pieces_are_merged_once(name, parts):
    own, seen = Encoder(P.path(name)), []
    merge = own.plain_parts
    own.plain_parts = lambda x: seen.extend(x) or merge(x)
    own.encode(["a Word word WORD word. word, (word)", "a word. Word"])
    assert sorted(seen) == sorted(parts.split("|"))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_plain_pieces_equal_the_library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    rng, parts = random.Random(9), [*map(chr, range(0x21, 0x100)), "'s", "'T", "'re", "'Ll", "Straße", "ÀÉ", "12", "...", "!'", "Ā", "Σ", "e\u0301", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", "", " ", "\n"]) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    own = Encoder(P.path(name), limit=500)
    for k in range(0, len(texts), 200):
        part = texts[k : k + 200]
        assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(part)] == [e.ids for e in t.encode_batch(part, add_special_tokens=False)]


def test_added_tokens_that_stand_for_themselves_get_whole_texts(tmp_path):
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        other = json.load(file)
    other["added_tokens"].append(other["added_tokens"][0] | {"id": 60_000, "content": "cat sat", "special": False})
    (tmp_path / "other.json").write_text(json.dumps(other))
    t, text = Tokenizer.from_file(str(tmp_path / "other.json")), "the cat sat on the mat"
    assert np.frombuffer(Encoder(str(tmp_path / "other.json")).encode([text])[0], "<u4").tolist() == t.encode(text).ids


@pytest.fixture(scope="module")
def bpe():
    return BytePairs(P.path("byte_bpe_multi_50k.tiktoken"), limit=1000)


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_pairs_equal_tiktoken(bpe, tik):
    rng = random.Random(3)
    alike = ["".join(rng.choice("abe rstnäthing") for _ in range(rng.randint(1, 200))) for _ in range(500)]
    for t in [*mixed(3000), *alike]:
        ids = bpe.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(t), repr(t)
        assert bpe.decode(ids) == t.encode()


def test_unbroken_bytes_take_linear_time(bpe, tik):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == tik.encode_ordinary(text)


def test_op8_on_documents(spark, sf, tik):
    got = {r.doc_id: r for r in op8_byte_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = np.array(tik.encode_ordinary(d.text or ""), "<u4")
        want = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())
        assert tuple(got[d.doc_id])[1:] == want


def test_columns_and_edge_cases(docs, none, tik):
    coded = encode_column(docs, "byte_bpe_multi_50k.tiktoken")
    back = decode_column(coded, "byte_bpe_multi_50k.tiktoken")
    want = sorted((r.doc_id if r.doc_id is not None else -1, (r.text or "").encode()) for r in docs.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.bytes)) for r in back.collect()) == want
    assert round_trip_digests(docs, "byte_bpe_multi_50k.tiktoken").count() == docs.count()
    assert round_trip_digests(none, "byte_bpe_multi_50k.tiktoken").collect() == []


def expected_rows(rows, end):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    out, start = [], 0
    for r in sorted(rows, key=lambda r: (NULL_ID if r.doc_id is None else r.doc_id, r.hash)):
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, end]
        out.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


key = lambda r: (r[1], r[2])


def test_op1_on_documents(spark, sf):
    got = sorted((tuple(r) for r in op1_token_binary(spark, sf).collect()), key=key)
    assert got == expected_rows(spark.read.parquet(f"{sf}/documents.parquet").withColumn("hash", F.xxhash64("text")).collect(), 2)


@pytest.mark.parametrize("width", [2, 4])
def test_token_files_of_odd_rows(docs, none, tmp_path, width):
    folder = str(tmp_path / "t")
    bases = write_tokens(docs, folder, "word_bpe_49k.json", 2, width=width, docs_per_part=4)
    got = sorted((tuple(r) for r in read_tokens(docs.sparkSession, folder).collect()), key=key)
    want = expected_rows(docs.withColumn("hash", F.xxhash64("text")).collect(), 2)
    assert [g[1:] for g in got] == [w[1:] for w in want] and [g[0] for g in got] == [w[0] for w in want]
    parts = bases.orderBy("part").collect()
    assert len(parts) > 1 and parts[1].first_token == parts[0].tokens
    ids, offsets = open_part(folder, f"{parts[0].part}.bin", f"<u{width}"), open_part(folder, f"{parts[0].part}.off", "<u8")
    assert isinstance(ids, np.memmap) and max(p.docs for p in parts) <= 4 and offsets[-1] == len(ids) and ids[-1] == 2
    empty = str(tmp_path / "e")
    write_tokens(none, empty, "word_bpe_49k.json", 2)
    assert read_tokens(docs.sparkSession, empty).collect() == []


def test_parts_close_by_bytes_and_rows_without_id_split(spark, tmp_path):
    rows = [(None, f"no id {i}") for i in range(300)] + [(1, "word " * 2000) for _ in range(5)] + [(2, "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = str(tmp_path / "t")
    parts = write_tokens(odd, folder, "word_bpe_49k.json", 2, docs_per_part=64, bytes_per_part=10_000).collect()
    assert max(p.docs for p in parts) <= 64 and sum(p.docs for p in parts) == len(rows) and any(p.part & 0xFFFFFF for p in parts)
    got = sorted((tuple(r) for r in read_tokens(spark, folder).collect()), key=key)
    assert got == expected_rows(odd.withColumn("hash", F.xxhash64("text")).collect(), 2)


def test_ids_that_16_bits_do_not_hold_raise(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(PySparkException):
        write_tokens(docs, str(tmp_path / "t"), "word_bpe_49k.json", 70_000, width=2)


def test_an_id_named_like_an_output(spark, tik):
    docs = spark.createDataFrame([(1, "a b")], "ids long, text string")
    got = encode_column(docs, "byte_bpe_multi_50k.tiktoken", id_col="ids").first()
    assert (got["ids_input"], got["ids"]) == (1, tik.encode_ordinary("a b"))
