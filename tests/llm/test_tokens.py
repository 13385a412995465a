"""Tokenisation operators against their libraries, on random and hostile texts."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from aspectra.llm import bpe_chunks, packing, token_counts, vocab

HOSTILE = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  ", "a  b", "a   b", "a\n b", "a\n \nb", "a \n b", "a\n ", "\t \t",
    "don't we'll I've 'S it's!'re 'll", "x" * 400, "ab " * 300, "12345678901234567890", "é è ê İı ſK ß ΑΣ ας",
    "日本語のテキスト、句読点。 漢字", "🙂🙂 👩‍👩‍👧 z", " x y　z\x85w\x1cq\x1fr", "á ë", "a<|endoftext|>b <|startoftext|> <|", "<|endoftext|>",
    "<|EndOfText|>", "A B.\r\nC\vD\fE", "한국어 텍스트", "a,b;c  d?!  e", "﻿x", "‍x", "word\u0000word",
]


def random_texts(n, seed, top=0x24F):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        k = r.randrange(1, 120)
        kind = r.randrange(3)
        if kind == 0:
            out.append("".join(chr(r.randrange(1, top)) for _ in range(k)))
        elif kind == 1:
            out.append("".join(r.choice(" \n\t  abcXYZ'sÉ12,.-<|>") for _ in range(k)))
        else:
            out.append(" ".join("".join(r.choice("thonderingçéñ") for _ in range(r.randrange(0, 9))) for _ in range(k)))
    return out


TEXTS = HOSTILE + random_texts(300, 7)


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


def test_whole_tokens_are_proven():
    path = vocab.default_path("word_bpe_49k.json")
    proven = token_counts.prove_whole_tokens(path)
    tok = vocab.hf_tokenizer(path)
    assert 20_000 < len(proven) < 49_500
    for w in random.Random(1).sample(sorted(proven), 400):
        assert len(tok.model.tokenize(w)) == 1


def test_token_counts_equal_library(spark):
    tok = vocab.hf_tokenizer(vocab.default_path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in token_counts.token_counts(frame(spark, TEXTS), limit=50).collect()}
    for i, t in enumerate(TEXTS):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 50), repr(t)


@pytest.mark.parametrize("chunk,overlap,spread,spread_overlap", [
    (4_096, 512, 65_536, 4_096), (40, 20, 65_536, 4_096), (25, 25, 64, 8), (4_096, 512, 40, 20), (40, 20, 400, 60)])
def test_chunked_encoding_equals_library(spark, chunk, overlap, spread, spread_overlap):
    path = vocab.default_path("byte_bpe_multi_50k.tiktoken")
    enc = vocab.rank_encoding(path)
    long = [" ".join(TEXTS[i] or "" for i in range(len(HOSTILE))) * 2, "y" * 500, "it's " * 100]
    texts = TEXTS + long
    coded = bpe_chunks.encode(frame(spark, texts), chunk_chars=chunk, overlap=overlap, spread_chars=spread,
                              spread_overlap=spread_overlap).cache()
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in coded.collect()}
    raw = {r.doc_id: r.bytes for r in bpe_chunks.decode(coded).collect()}
    dig = {r.doc_id: r for r in bpe_chunks.round_trip_digests(coded).collect()}
    once = bpe_chunks.encode_round_trip(frame(spark, texts), chunk_chars=chunk, overlap=overlap, spread_chars=spread,
                                        spread_overlap=spread_overlap).collect()
    assert {r.doc_id: r for r in once} == dig and len(once) == len(texts)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[i] == ids, (i, repr(t))
        assert bytes(raw[i]) == (t or "").encode()
        assert dig[i].n_tokens == len(ids)
        assert dig[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert dig[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_texts_are_cut_into_pieces():
    enc = vocab.rank_encoding(vocab.default_path("byte_bpe_multi_50k.tiktoken"))
    texts = random_texts(200, 11) + [" ".join(random_texts(60, 12)), "it's " * 3_000, "a" * 9_000, "a b\n" * 5_000, " " * 9_000]
    cut = {}
    for chunk, overlap in [(30, 12), (100, 100), (4_096, 512)]:
        for t in texts:
            pieces = bpe_chunks.pieces_of(t, chunk, overlap)
            cut.setdefault(chunk, []).extend([len(pieces) > 1] * (len(t) > chunk))
            assert "".join(pieces) == t
            assert sum((enc.encode_ordinary(p) for p in pieces), []) == enc.encode_ordinary(t), (chunk, t[:80])
            assert len(pieces) in (1, -(-len(t) // chunk))
    # windows of 12 characters often hold no common boundary; of 100 or more nearly always
    assert sum(cut[100]) > 0.9 * len(cut[100]) - 2 and sum(cut[4_096]) == 3 and any(cut[30])
    assert len(bpe_chunks.pieces_of("it's " * 3_000, bpe_chunks.CHUNK_CHARS, bpe_chunks.OVERLAP)) == 4


def test_chunk_parameters_are_checked(spark):
    with pytest.raises(ValueError):
        bpe_chunks.encode(frame(spark, ["a"]), chunk_chars=10, overlap=20)


def check_pack(rows, texts, window):
    tok = vocab.hf_tokenizer(vocab.default_path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and 0 < r.length <= window, repr(t)
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[at:at + r.length], repr(t)
            at += r.length
        assert at == len(ids)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return by_seq


@pytest.mark.parametrize("window", [1024, 37])
def test_packing_is_exact_and_gapless(spark, window):
    texts = TEXTS + ["The thing. " * 900]
    seqs = check_pack(packing.pack(frame(spark, texts), window=window).collect(), texts, window)
    used = sum(r.length for s in seqs.values() for r in s)
    assert used / (window * len(seqs)) > 0.85


def test_best_fit_takes_the_tightest_window():
    assert packing.best_fit_decreasing([6, 5, 4, 3, 2], 10) == [[0, 2], [1, 3, 4]]
    r = random.Random(3)
    for w in (7, 64, 1024):
        sizes = [r.randrange(1, w + 1) for _ in range(400)]
        wins = packing.best_fit_decreasing(sizes, w)
        assert sorted(i for x in wins for i in x) == list(range(400))
        room = []                       # the same rule by linear search
        for n in sorted(sizes, reverse=True):
            fits = [x for x in room if x >= n]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - n)
            else:
                room.append(w - n)
        assert sorted(w - sum(sizes[i] for i in x) for x in wins) == sorted(room)


def test_empty_tables_and_clashing_columns(spark):
    e = spark.createDataFrame([], "doc_id long, text string, ids string, n_tokens int, k int, t int")
    assert bpe_chunks.encode(e).count() == 0 and token_counts.token_counts(e).count() == 0
    assert packing.pack(e).count() == 0
    d = spark.createDataFrame([(None, "a b", "x", 1, 2, 3), (5, None, None, None, None, None), (5, None, None, None, None, None)],
                              e.schema)
    assert bpe_chunks.encode(d, chunk_chars=8, overlap=6).count() == 3
    assert sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.token_counts(d).collect()) == [(0, 2), (5, 0), (5, 0)]
    got = packing.pack(d).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 3), (5, 1), (5, 1)]
    assert {zlib.crc32(r.ids) for r in got if r.doc_id == 5} == {zlib.crc32(bytes(4))}
