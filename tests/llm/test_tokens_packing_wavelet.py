import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridmart.llm.packing import Packer, pack
from gridmart.llm.tokens import Encoder, encoder
from gridmart.llm.wavelet import WaveletMatrix, open_shard, read_tokens, write_shard, write_tokens
from tests.llm.conftest import edge_rows, frame, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = b"\0\0\0\0"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()


def test_encoder_equals_library(library):
    r = random.Random(4)
    texts = ["", " ", "a", " a ", "a  b", "a\n\nb", "\na", "a\n", "it's 's", "x.\ny!? ...", "½ x²", "a\tb", "a\xa0b", "<|endoftext|> x",
             "日本語 テスト", "x\x1cy", "don't.\n'tis", "é x", "ǅ ß.", "naïve café.\nÀ", words(1, 3000)]
    texts += ["".join(r.choice(["a", "B", "é", " ", " ", "\n", ".", ",", "'s", "1", "²", "ß", "-", "\t", " ", "x", "😀", "_"])
                      for _ in range(r.randint(1, 14))) for _ in range(4000)]
    got = encoder(PATH).documents(pa.array([*texts, None]))
    assert got[-1] == END
    for t, g in zip(texts, got, strict=False):
        assert g == library(t), repr(t)


def test_a_word_is_encoded_once_whatever_follows_it(library):
    texts = ["word word. word, word!? word.\nword.\nword: é, é", "word; x a\nword", "word.\nother, word"]
    one = Encoder(PATH, words=100)
    asked, encode = [], one.word
    one.word = lambda part, space: asked.append((part, space)) or encode(part, space)
    for _ in range(2):
        assert one.documents(pa.array(texts)) == [library(t) for t in texts]
    assert sorted(asked) == [("a", " "), ("other", ""), ("word", ""), ("word", " "), ("x", " "), ("é", " ")]
    full = Encoder(PATH, words=1)                               # a full cache changes no id
    assert full.documents(pa.array(texts)) == [library(t) for t in texts] and len(full.parts) == len(full.firsts) == 1


def check_pieces(rows, docs, library, limit=1024):
    """``docs``: (doc_id, text) in any order; rows with the same id are told apart by their ids."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    padding = 0
    for rows_of in by_sequence.values():
        at = 0
        for r in sorted(rows_of, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limit
        padding += 0 if at & (at - 1) == 0 else limit - at
    unique = defaultdict(list)
    for i, t in docs:
        unique[i].append(library(t))
    for i, texts in unique.items():
        assert sum(r.length for r in by_doc[i]) == sum(len(t) // 4 for t in texts)
        if len(texts) == 1:
            at = 0
            for r in sorted(by_doc[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(texts[0]) // 4
                assert r.ids_crc32 == zlib.crc32(texts[0][4 * at: 4 * (at + r.length)])
                at += r.length
    return padding


def test_packing_round_trip(spark, library):
    rows = edge_rows() + [(100 + i, words(i, 1 + i * 7 % 300), None, "s") for i in range(300)]
    got = pack(frame(spark, rows).coalesce(2), PATH).collect()
    assert check_pieces(got, [(i, t) for i, t, *_ in rows], library) == 0
    with_ids = pack(frame(spark, rows).coalesce(1), PATH, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in with_ids)
    assert pack(frame(spark, []), PATH).count() == 0


def test_all_limits_hold(spark, library):
    docs = spark.createDataFrame([(i, words(i, 5 + i % 200), i % 60) for i in range(200)], "doc_id long, text string, prompt long").coalesce(1)
    got = pack(docs, PATH, max_tokens=512, max_segments=3, max_loss_tokens=300, prompt_tokens="prompt").collect()
    check_pieces(got, [(r.doc_id, r.text) for r in docs.collect()], library, 512)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append(r)
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, r.doc_id % 60))
    assert all(len(v) <= 3 and sum(r.loss_tokens for r in v) <= 300 for v in by.values())


def test_packer_prefers_what_fits_the_room():
    p = Packer((100, 10, 100), pool=4)
    for n in (60, 30, 40, 10, 50, 50, 5, 95):
        p.add(n, n)
    p.finish()
    assert sum(r[2] for r in p.rows) == 340
    assert len({r[3] for r in p.rows}) <= 5


def test_wavelet_matrix_against_plain_list():
    r = np.random.default_rng(2)
    for n, top in ((1, 1), (1, 2), (63, 5), (64, 300), (1000, 50257), (5000, 9), (300, 70000)):
        ids = r.integers(0, top, n).astype(np.uint32)
        m = WaveletMatrix.build(ids)
        assert (m.decode() == ids).all()
        plain = ids.tolist()
        for i in r.integers(0, n, 20).tolist():
            assert m.access(i) == plain[i]
            t = plain[i]
            assert m.rank(t, i) == plain[:i].count(t) and m.count(t) == plain.count(t)
            assert m.select(t, plain[:i].count(t)) == i
        assert m.occurrences(plain[0]) == [i for i, x in enumerate(plain) if x == plain[0]]
        assert m.count(top + 200000) == 0 and m.select(plain[0], n + 1) == -1
    empty = WaveletMatrix.build(np.zeros(0, np.uint32))
    assert len(empty.decode()) == 0 and empty.count(0) == 0


def test_shard_file_round_trip():
    blobs = [b"\1\0\0\0\0\0\0\0", END, np.arange(70000, dtype="<u4").tobytes()]
    ids, lengths, m = open_shard(write_shard([5, None, 7], blobs))
    assert ids == [5, None, 7] and lengths.tolist() == [2, 1, 70000] and m.decode().astype("<u4").tobytes() == b"".join(blobs)
    with pytest.raises(ValueError, match="not a shard"):
        open_shard(b"else")


def test_tokens_read_back_in_order(spark, scratch, library):
    rows = [r for r in edge_rows()] + [(100 + i, words(i, 50), None, "s") for i in range(200)]
    files = write_tokens(frame(spark, rows).repartition(5), PATH, scratch, shard_tokens=2000)
    assert files.count() > 5
    got = sorted(read_tokens(files).collect(), key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys) and len(got) == len(rows)
    assert sorted((k, r.ids_crc32, r.n_tokens) for k, r in zip(keys, got, strict=True)) == sorted(
        (-1 if i is None else i, zlib.crc32(library(t)), len(library(t)) // 4) for i, t, *_ in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert read_tokens(write_tokens(frame(spark, []), PATH, scratch)).count() == 0


def test_special_token_strings_are_that_token(spark, scratch, library):
    text = "a <|endoftext|> b"
    special = Tokenizer.from_file(PATH).token_to_id("<|endoftext|>")
    assert special in np.frombuffer(library(text), "<u4").tolist()
    rows = [(1, text, None, None), (2, "<|endoftext|>", None, None), (3, "plain", None, None)]
    packed = pack(frame(spark, rows), PATH).collect()
    check_pieces(packed, [(i, t) for i, t, *_ in rows], library)
    read = {r.doc_id: r for r in read_tokens(write_tokens(frame(spark, rows), PATH, scratch)).collect()}
    for i, t, *_ in rows:
        assert (read[i].n_tokens, read[i].ids_crc32) == (len(library(t)) // 4, zlib.crc32(library(t)))


def test_a_hot_or_missing_id_is_spread_over_tasks(spark, scratch, library):
    rows = [(None, words(i, 40), None, None) for i in range(300)] + [(7, words(1000 + i, 40), None, None) for i in range(300)] \
        + [(i, words(2000 + i, 10), None, None) for i in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # tables this small would be one task
    try:
        files = write_tokens(frame(spark, rows).repartition(8), PATH, scratch, shard_tokens=500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files.select("part").distinct().count() > 4
    got = sorted(read_tokens(files).collect(), key=lambda r: r.start)
    assert [(-1 if r.doc_id is None else r.doc_id) for r in got] == sorted(-1 if i is None else i for i, *_ in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert sorted(r.ids_crc32 for r in got) == sorted(zlib.crc32(library(t)) for _, t, *_ in rows)
