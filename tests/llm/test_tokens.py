"""BPE and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from shelfcast.llm import bpe, token_files
from shelfcast.llm.queries import op3_token_files, op9_bpe

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "ab  \n\t\r\x0b\x1c\x1f\x85\xa0éßÉ'stvertl1²½٣Ⅷ一İſªµ́​　 😀<|endoftext|>.,!?aaaa\x00­"


def fuzz(n=3000):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + ["a" * k for k in range(30)] + ["ha" * 50, "", "<|endoftext|>", "É, à. B.", "a" * 5000]


def test_pair_index_equals_the_library_on_odd_texts():
    texts, lib = fuzz(), Tokenizer.from_file(BYTE)
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    coder = bpe.PairIndexBPE(BYTE, cache_size=500)
    for _ in range(2):  # the second time through a cache that was cleared
        got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_batch(texts)]
        assert got == want
    assert [coder.decode(x) for x in want] == [lib.decode(x, skip_special_tokens=False) for x in want]


def test_chunked_library_equals_whole_texts():
    texts, lib = fuzz(), Tokenizer.from_file(WORD)
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    got = token_files.ChunkEncoder(WORD, cache_size=500).encode_batch(texts, "<u4")
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_chunked_library_with_a_vocabulary_that_keeps_spaces():
    texts, lib = fuzz(200), Tokenizer.from_file(BYTE)
    enc = token_files.ChunkEncoder(BYTE)
    assert not enc.cut
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode_batch(texts, "<u4")] == \
        [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_words_go_to_the_model_directly_with_the_library_s_ids():
    from string import punctuation
    enc, rng = token_files.ChunkEncoder(WORD), random.Random(3)
    words = {"".join(rng.choices(token_files.LETTERS, k=rng.randint(1, 30))) for _ in range(3000)}
    marks = ["".join(rng.choices(punctuation, k=rng.randint(1, 5))) for _ in range(300)]
    chunks = [*words, *(w + m for w, m in zip(words, marks)), "don't", "l'été", "a's!", "a<|endoftext|>", "\u00b5\u0301", "ﬁn", *marks]
    want = [enc.lib.encode(c, add_special_tokens=False).ids for c in chunks]
    enc.lib = CountedLibrary(enc.lib)
    enc.learn(chunks, "<u4")
    assert [np.frombuffer(enc.known[c], "<u4").tolist() for c in chunks] == want
    assert enc.lib.texts <= 306  # of 3606 chunks: the odd ones and the marks alone


class CountedLibrary:
    """Counts the texts that take the library's whole way."""

    def __init__(self, lib):
        self.lib, self.model, self.texts = lib, lib.model, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.lib.encode_batch_fast(texts, **options)

    def encode(self, text, **options):
        self.texts += len(text.split(" "))
        return self.lib.encode(text, **options)


def test_op9_equals_the_library(spark):
    import hashlib
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    lib = Tokenizer.from_file(BYTE)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for d in docs:
        ids = lib.encode(d.text or "", add_special_tokens=False).ids
        want[d.doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(lib.decode(ids, skip_special_tokens=False)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op9_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_op3_equals_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    lib, start, want = Tokenizer.from_file(WORD), 0, {}
    for d in docs:
        ids = np.array(lib.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4")
        want[d.doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op3_token_files(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_round_trip_of_awkward_rows(spark, awkward, nothing):
    rows = bpe.encode(awkward, BYTE)
    texts = bpe.decode(rows, BYTE).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in texts) == \
        sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in awkward.collect())
    assert bpe.encode(nothing, BYTE).count() == 0 and bpe.with_ids_and_text(nothing, BYTE).count() == 0


def test_files_hold_awkward_rows_in_order(spark, awkward, nothing):
    parts = token_files.write(awkward, WORD, 1)
    got = token_files.read(spark, parts).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:]) and len(ids) == awkward.count()
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]
    lib = Tokenizer.from_file(WORD)
    for r in got:
        if r.doc_id == 0:  # the null text
            assert np.frombuffer(r.ids, "<u4").tolist() == [1]
        if r.doc_id == 7:
            text = awkward.where("doc_id = 7").first().text
            assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids + [1]
    assert {r.width for r in parts.collect()} == {2}
    assert token_files.write(nothing, WORD, 1).count() == 0
    assert token_files.read(spark, token_files.write(nothing, WORD, 1)).count() == 0


def test_one_encoder_gives_ids_of_either_width():
    both = {}
    enc = token_files.ChunkEncoder(WORD)
    for dtype in ("<u2", "<u4", "<u2"):
        both[dtype] = [np.frombuffer(x, dtype).tolist() for x in enc.encode_batch(["some words, and some", "words"], dtype)]
    assert both["<u2"] == both["<u4"]


def test_a_wide_end_id_makes_32_bit_files(spark, awkward):
    parts = token_files.write(awkward.where("doc_id < 4"), WORD, 70_000)
    assert {r.width for r in parts.collect()} == {4}
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 70_000 for r in token_files.read(spark, parts).collect())
