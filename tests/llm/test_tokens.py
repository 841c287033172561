"""Token files, packing and byte-level BPE against whole-text encoders."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from cauce.llm import bpe, packing, token_files  # noqa: E402
from cauce.llm.common import shared_folder  # noqa: E402

SCHEMA = "doc_id long, text string, part int, `row` string, start string"
TEXTS = [
    "It's a test,  isn't it?\nNew line\n\n two",
    None,
    "",
    "   ",
    "é.\n×, ü÷a Über straße naïve",
    "x" * 5000,
    "日本語 テスト　全角 🙂🙂 ab1c2 12345",
    "<|endoftext|> is text",
    "\t tabs\r\n and \x0b feeds   end ",
]


def many_texts():
    rng = random.Random(5)
    signs = ["a", "Be", "é", " ", " ", "\n", ",", "'s", "7", "日", " ", "!", "×", "word", "🙂"]
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return TEXTS + made


def table(spark, texts):
    rows = [(i, t, 1, "r", "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def reference(name):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path(name))
    model.encode_special_tokens = True
    return lambda text: model.encode(text or "", add_special_tokens=False).ids


def test_token_files_round_trip(spark):
    texts = many_texts()
    folder = shared_folder(spark, "files")
    docs = table(spark, texts)
    index = token_files.write_token_files(docs, folder, P.path("byte_bpe_50k.json"), partitions=3, length=64)
    rows = token_files.read_token_files(index, folder).orderBy("doc_id").collect()
    encode, start = reference("byte_bpe_50k.json"), 0
    for row, text in zip(rows, texts, strict=True):
        ids = np.array([*encode(text), 2], "<u4")
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)
    some = token_files.TokenFile(folder, rows[0].part)
    ids, mask = some.sequence(0)
    assert len(ids) == 64 and mask.dtype == bool
    padded = [token_files.TokenFile(folder, p) for p in {r.part for r in rows}]
    assert sum(b["mask"].flatten().sum().as_py() for f in padded for b in f.batches) == start


def test_token_files_of_nothing_and_of_repeated_ids(spark):
    folder = shared_folder(spark, "files")
    index = token_files.write_token_files(table(spark, []), folder, P.path("byte_bpe_50k.json"))
    assert token_files.read_token_files(index, folder).count() == 0
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    index = token_files.write_token_files(docs, folder + "-2", P.path("byte_bpe_50k.json"))
    rows = token_files.read_token_files(index, folder + "-2").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1] and [r.start for r in rows] == [0, 2, 4]


def test_packing_places_every_id_once(spark):
    texts = many_texts() + ["some words that are packed " * 900] * 3
    rows = packing.pack(table(spark, texts), P.path("word_bpe_49k.json"), room=256).collect()
    encode = reference("word_bpe_49k.json")
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids, at = np.array([*encode(text), 1], "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            part = ids[at : at + r.length]
            assert r.start == at and r.doc_tokens == len(ids)
            assert bytes(r.ids) == part.tobytes() and r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert sorted(filled) == list(range(len(filled)))
    short = [n for n in filled.values() if n != 256]
    assert len(short) == len(set(short)) and all(n & (n - 1) == 0 for n in short)


def test_packing_of_nothing(spark):
    assert packing.pack(table(spark, []), P.path("word_bpe_49k.json")).count() == 0


def test_column_generation_reaches_the_bound():
    lengths, demand = np.array([7, 5, 3]), np.array([40.0, 60.0, 20.0])
    patterns, amounts = packing.generate(lengths, demand, 10)
    assert np.allclose(patterns.T @ amounts, demand) and (patterns @ lengths <= 10).all()
    # 20 sequences of 7 + 3, 20 of a 7 alone, 30 of two 5s.
    assert abs(amounts.sum() - 70) < 1e-6


@pytest.mark.parametrize("histogram", [{}, {1: 5}, {1: 1, 31: 2}, {64: 10, 32: 1, 5: 300}, {64: 2}])
def test_plans_cover_all_pieces(histogram):
    plan = packing.make_plan(histogram, 64)
    filled = {}
    for length, n in histogram.items():
        for rank in range(n):
            parts = list(plan.places(length, rank))
            assert sum(p[1] for p in parts) == length
            for _, size, sequence, offset in parts:
                filled.setdefault(sequence, []).append((offset, size))
    for sequence, parts in filled.items():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end == 64 or end & (end - 1) == 0


def codec():
    return bpe.codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def test_bpe_equals_tiktoken():
    import tiktoken

    own = codec()
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(2)
    texts = many_texts() + ["ab" * 700, "a" * 1001, "".join(rng.choice("abcdef") for _ in range(900))]
    ids, rows = own.encode(pa.array(texts))
    decoded = own.decode(ids, rows)
    for i, text in enumerate(texts):
        assert ids[rows[i] : rows[i + 1]].tolist() == other.encode_ordinary(text or "")
        assert decoded[i] == (text or "").encode()


def test_both_ways_of_merging_agree():
    rng = random.Random(4)
    words = [bytes(rng.choice(b"aabbcdehinorst") for _ in range(rng.randint(2, 80))) for _ in range(200)]
    own = codec()
    assert own._merge(words, bpe.ENCODE) == own._merge(words, bpe.ENCODE_LONG)


def test_bpe_query_handles_nulls_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, "ab", 3)], "doc_id long, text string, ids int")
    rows = bpe.encode_decode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert sorted((r.n_tokens, bytes(r.decoded)) for r in rows)[:2] == [(0, b""), (0, b"")]
    empty = docs.limit(0)
    assert bpe.encode_decode(empty, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0
