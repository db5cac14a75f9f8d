"""BPE by recursive queries against tiktoken, and compressed shards against the
tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import bpe, repair, tokens

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN
ALPHABET = "aAsStT'eErRlLdDmMvV  \n\t.,!0123éÉßñ×÷\x85\xa0漢字e\u0301 \x1c\x0b😀ªº²½\x00<|>"


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.bpe(RANKS, PATTERN).ranks, special_tokens={})


def random_texts(n):
    rng = random.Random(n)
    plain = [c for c in ALPHABET if tokens.simple(c)]
    out = ["".join(rng.choice(a) for _ in range(rng.randint(0, 50))) for a in (ALPHABET, plain) for _ in range(n)]
    return [*out, "", "it's we'll  don't 'sx ''s 's\n's \n's  x", "<|endoftext|>", "antidisestablishmentarianism " * 3]


def test_byte_pieces_equal_the_library(tiktoken_encoding):
    texts = random_texts(1500)
    coder = bpe.bpe(RANKS, PATTERN)
    got = coder.encode(texts)
    assert [g.tolist() for g in got] == [tiktoken_encoding.encode_ordinary(t) for t in texts]
    assert coder.decode(got) == [t.encode() for t in texts]


def test_piece_table_may_start_anew(tiktoken_encoding):
    coder = bpe._Bpe(RANKS, PATTERN)
    coder.table.limit = coder.words.limit = 50
    for part in range(0, 200, 20):
        texts = random_texts(100)[part:part + 20]
        got = coder.encode(texts)
        assert [g.tolist() for g in got] == [tiktoken_encoding.encode_ordinary(t) for t in texts]
        assert coder.decode(got) == [t.encode() for t in texts]


def test_bpe_columns_on_odd_documents(spark, odd_documents, tiktoken_encoding):
    df = odd_documents.select("doc_id", "text", bpe.round_trip("text", RANKS, PATTERN).alias("t"), bpe.encoded("text", RANKS, PATTERN).alias("ids"))
    for r in df.select("*", bpe.decoded("ids", RANKS, PATTERN).alias("raw")).collect():
        want = tiktoken_encoding.encode_ordinary(r.text or "")
        assert r.ids == want == r.t.ids
        assert bytes(r.raw) == bytes(r.t.decoded) == (r.text or "").encode()
    assert odd_documents.limit(0).select(bpe.encoded("text", RANKS, PATTERN)).collect() == []


def test_long_unbroken_piece(tiktoken_encoding):
    texts = ["ab" * 700, "z" * 999, "é" * 300]
    assert [g.tolist() for g in bpe.bpe(RANKS, PATTERN).encode(texts)] == [tiktoken_encoding.encode_ordinary(t) for t in texts]


def test_word_pieces_equal_the_library():
    enc = repair.encoder(WORDS)
    texts = random_texts(1500)
    assert [g.tolist() for g in enc.encode(texts)] == [e.ids for e in enc.library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(4))
def test_compression_round_trip(seed):
    rng = np.random.default_rng(seed)
    base = 500
    ids = rng.choice(base, 5000, p=rng.dirichlet(np.full(base, 0.05)))
    ids = np.concatenate([ids, ids[100:900], np.full(301, 7), ids[:50]])
    rules, symbols = repair.compress(ids, base, min_count=4, per_round=50)
    assert len(symbols) < len(ids) and len(rules)
    assert (repair.expand_symbols(symbols, rules, base) == ids).all()
    lengths = repair.expansion_lengths(rules, base)
    assert [len(repair.expand_symbols(np.array([base + r], np.uint16), rules, base)) for r in range(len(rules))] == lengths.tolist()
    shard = repair.Shard({"base": base, "rules": rules.astype("<u2").tobytes(), "lengths": lengths.astype("<u4").tobytes(),
                          "symbols": symbols.astype("<u2").tobytes(), "offsets": [0, len(ids)]})
    for a, b in rng.integers(0, len(ids) + 1, (200, 2)):
        assert (shard.ids(min(a, b), max(a, b)) == ids[min(a, b):max(a, b)]).all()


def test_tiny_sequences_compress():
    for ids in ([], [1], [1, 1], [1] * 100):
        rules, symbols = repair.compress(np.array(ids, np.int32), 10, min_count=2)
        assert repair.expand_symbols(symbols, rules, 10).tolist() == ids


def check_shards(spark, df, path, **options):
    repair.write_shards(df, path, WORDS, end_id=2, **options)
    got = repair.read_shards(spark, path).collect()
    library = repair.encoder(WORDS).library
    rows = sorted(df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect(),
                  key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    start, want = 0, []
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want


def test_shards_on_odd_documents(spark, odd_documents, tmp):
    check_shards(spark, odd_documents, f"{tmp}/one")
    check_shards(spark, odd_documents, f"{tmp}/many", shard_ids=100)


def test_shards_of_an_empty_table(spark, tmp):
    df = spark.createDataFrame([], "doc_id long, text string")
    repair.write_shards(df, f"{tmp}/none", WORDS, end_id=2)
    assert repair.read_shards(spark, f"{tmp}/none").collect() == []


def test_queries_on_the_smoke_tables(spark, sf, tiktoken_encoding):
    from tablecraft.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op8_byte_bpe"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = tiktoken_encoding.encode_ordinary(docs[r.doc_id])
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest, hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
    out = QUERIES["op7_repair_output"](spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == len(docs)


def test_strings_of_added_tokens_get_their_ids(spark, tmp):
    from tokenizers import Tokenizer

    library, enc = Tokenizer.from_file(WORDS), repair.encoder(WORDS)
    rng = random.Random(9)
    strings = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", " endoftext|>", "\u00e9", "\u6f22"]
    texts = ["see <|endoftext|> here", "<|endoftext|>", "a<|startoftext|><|endoftext|>b", *random_texts(200)]
    texts += ["".join(rng.choice(strings) + x for x in random_texts(3)[:3]) for _ in range(100)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert enc.by_class and want[0] == [862, 49407, 763]
    assert [g.tolist() for g in enc.encode(texts)] == want
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    repair.write_shards(df, f"{tmp}/added", WORDS, end_id=2)
    got = repair.read_shards(spark, f"{tmp}/added").orderBy("id").collect()
    assert [r.ids for r in got] == [ids + [2] for ids in want]
    assert [r.start for r in got] == np.cumsum([0, *(len(ids) + 1 for ids in want[:-1])]).tolist()


def test_patterned_words_keep_their_own_ids(tiktoken_encoding):
    """Thue-Morse words and their complements, on which sums of powers of an odd base agree."""
    word = "a"
    while len(word) < 2048:
        word += word.translate({97: 98, 98: 97})
    words = [word, word.translate({97: 98, 98: 97}), word[:1024], word[1024:]]
    coder = bpe.bpe(RANKS, PATTERN)
    got = coder.encode(words)
    assert [x.tolist() for x in got] == [tiktoken_encoding.encode_ordinary(w) for w in words]
    assert [b.decode() for b in coder.decode(got)] == words
    coder.close()


def test_tables_of_pieces_are_bounded_in_bytes():
    coder = bpe._Bpe(RANKS, PATTERN)
    coder.table.limit = coder.words.limit = 20_000
    sizes = []
    for k in range(20):
        coder.decode(coder.encode([" ".join(f"w{i}" for i in range(100 * k, 100 * k + 300))]))
        sizes += [t.flat.nbytes + 20 * len(t.hashes) for t in (coder.table, coder.words)]
    assert max(sizes) <= 20_000 + 300 * 40 and min(sizes) > 0
    coder.close()
    assert coder.opened is None and len(coder.table.hashes)


def test_ids_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        repair.compress(np.array([1, 70_000]), 80_000)
    with pytest.raises(ValueError):
        repair.compress(np.array([1, 70_000]), 60_000)
