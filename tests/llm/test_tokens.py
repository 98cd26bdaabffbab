import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm.encoding import Encoder
from riskloom.llm.packing import Packer, pack_documents, pack_examples, power_lengths
from riskloom.llm.token_files import PerfectHash, Shard, lookup, read_token_files, shard_bytes, token_files, write_token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n\n", "  a  b\n\n c\t d \n", "it's  I'll \n'tis 'S", "á ́b é", "x" * 100 + " y", "foo bar baz", "a\x1cb", "日本 語,",
    "İstanbul ΣΑΣ", "12abc34 5,6.7###", "<|endoftext|> x<|endoftext|>", "''s 's", "wörd,\nNext", "…“q”", "a\r\nb", "\t\n x", "ﬁ ﬀ", "éé ñ",
]


def ids_of(path, text, end):
    tokenizer = Tokenizer.from_file(path)
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


@pytest.mark.parametrize("specials", [True, False])
@pytest.mark.parametrize("path, blanks", [(WORDS, False), (BYTES, True)])
def test_encoder_equals_the_library(path, blanks, specials, spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += [a + b for a in ODD for b in ODD]
    texts += ["<|startoftext|>a", "x <|endoftext|>", "<|endoftext", "a<|endoftext|>b <|endoftext|>\n", "word<|EndOfText|>"]
    encoder = Encoder(path, blanks, specials)
    tokenizer = Tokenizer.from_file(path)
    if not specials:
        tokenizer.encode_special_tokens = True
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want


def pairs():
    return [(5, "five five"), (None, "nobody"), (3, None), (3, "b"), (3, "a"), (9, ""), *((20 + i, t) for i, t in enumerate(ODD)), (7, "word " * 3000)]


def test_token_files_against_brute_force(spark, docs_of):
    df = docs_of(pairs())
    folder, manifest = token_files(df, WORDS, 2, False)
    got = [(r.key, r.start, r.n_tokens, r.ids_crc32) for r in read_token_files(spark, folder, manifest).collect()]
    want, start = [], 0
    for key, text in sorted(pairs(), key=lambda p: (p[0] is not None, p[0] or 0, p[1] or "")):
        ids = ids_of(WORDS, text, 2)
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    keys = spark.createDataFrame([(3,), (5,), (6,), (10**12,), (None,)], "doc_id long")
    found = sorted((r.key, r.ids) for r in lookup(spark, folder, manifest, keys).collect())
    assert found == sorted((k, ids_of(WORDS, t, 2).tolist()) for k, t in pairs() if k in (3, 5))


def test_small_shards_give_the_same_documents(spark, docs_of, tmp_path):
    df = docs_of(pairs())
    one = write_token_files(df, f"{tmp_path}/a", WORDS, 2, False)
    many = write_token_files(df, f"{tmp_path}/b", WORDS, 2, False, shard_size=50)
    assert many.count() > one.count()
    rows = lambda f, m: sorted((r.start, r.n_tokens, r.ids_crc32) for r in read_token_files(spark, f, m).collect())
    assert rows(f"{tmp_path}/a", one) == rows(f"{tmp_path}/b", many)


def test_empty_table_has_no_shards(spark, docs_of):
    folder, manifest = token_files(docs_of([]), WORDS, 2, False)
    assert manifest.count() == 0 and read_token_files(spark, folder, manifest).count() == 0


@pytest.mark.parametrize("count", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_turns_strangers_away(count):
    rng = np.random.default_rng(count)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, count))
    slots = PerfectHash.build(keys).slots(keys)
    assert np.array_equal(np.sort(slots), np.arange(len(keys)))
    shard = Shard(shard_bytes(keys.tolist(), [b"\1\0\0\0"] * len(keys), False)) if len(keys) else None
    if shard is not None:
        assert np.array_equal(shard.find(keys), np.arange(len(keys)))
        others = np.setdiff1d(rng.integers(-(1 << 62), 1 << 62, 1000), keys)
        assert (shard.find(others) == -1).all()


def check_pieces(rows, docs, length=1024):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= length
        padding += length - at if at & (at - 1) else 0
    for key, ids in docs.items():
        at = 0
        for r in sorted(by[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert set(by) == set(docs)
    return padding


def test_packed_documents_against_the_library(spark, docs_of):
    some = [(i, t) for i, t in enumerate([t for _, t in pairs()] * 3)]
    rows = pack_documents(docs_of(some), BYTES, 0).collect()
    assert check_pieces(rows, {i: ids_of(BYTES, t, 0) for i, t in some}) == 0


def test_segment_and_loss_limits_of_documents(spark, docs_of):
    some = [(i, "a b c " * (i % 40)) for i in range(100)]
    rows = pack_documents(docs_of(some).coalesce(1), BYTES, 0, length=256, segments=3, loss_tokens=200).collect()
    check_pieces(rows, {i: ids_of(BYTES, t, 0) for i, t in some}, 256)
    assert pack_documents(docs_of([]), BYTES, 0).count() == 0


def test_examples_are_placed_whole_under_all_limits(spark):
    rng = np.random.default_rng(4)
    data = [(int(i % 90), int(t), int(s), int(l), "x") for i, (t, s, l) in enumerate(zip(rng.integers(0, 900, 700), rng.integers(1, 9, 700), rng.integers(0, 500, 700)))]
    data += [(None, None, 1, None, "x"), (1, 1024, 16, 600, "x")]
    df = spark.createDataFrame(data, "key long, tokens long, segments long, loss long, position string")
    limits = (1024, 16, 600)
    rows = pack_examples(df, "key", ["tokens", "segments", "loss"], limits).collect()
    assert sorted(str((r.key, r.demand_0, r.demand_1, r.demand_2)) for r in rows) == sorted(str((k, t or 0, s, l or 0)) for k, t, s, l, _ in data)
    totals = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        for d in range(3):
            totals[r.sequence_id][d] += r[f"demand_{d}"]
    assert all(t <= m for total in totals.values() for t, m in zip(total, limits))
    # Not far from the least number of sequences that any packing needs.
    need = max(sum(r[f"demand_{d}"] for r in rows) / limits[d] for d in range(3))
    assert len(totals) <= 1.35 * need + 8
    with pytest.raises(Exception, match="larger than a sequence"):
        pack_examples(df, "key", ["tokens"], (10,)).collect()


def test_dot_product_choice():
    packer = Packer((10, 10))
    packer.add((6, 1), "tokens")
    packer.add((1, 6), "segments")
    packer.room = np.array([10, 6])
    assert packer.payloads[packer.best()] == "tokens"
    packer.room = np.array([6, 10])
    assert packer.payloads[packer.best()] == "segments"
    packer.room = np.array([5, 5])
    assert packer.best() == -1


def test_power_lengths():
    assert power_lengths(1023, 1024) == [512, 256, 128, 64, 32, 16, 8, 4, 2, 1] and power_lengths(0, 8) == []
