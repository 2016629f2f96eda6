"""Encoding equals the libraries' own, decoding and shard files are exact round trips."""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from riskloom.llm import bpe, queries, repair
from tests.llm import helpers

BYTE, WORD = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def word_reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD)
    tokenizer.encode_special_tokens = True
    return tokenizer


ODD = ["\x1c a\x1d\x85b  　c​ d", "a \nb\r\n\t c'lls don't  ", "<|endoftext|> x", "﻿ a᠎ b", " \n \n x", "a\xa0b \xa0 c", "İΑΣ ΑΣΑ ǅ ﬁ é"]


def test_byte_ids_equal_ranks(spark, reference):
    texts = helpers.AWKWARD + ODD
    for r in bpe.encode(helpers.docs(spark, texts), BYTE, offsets=True).collect():
        text = r["text"] or ""
        assert r["ids"] == reference.encode_ordinary(text)
        if len(text) < 1000:
            for i, a, b in zip(r["ids"], r["ids_start"], r["ids_end"]):
                piece = reference.decode_single_token_bytes(i)
                assert piece in text[a:b].encode() and len(text[a:b]) <= len(piece)


PLAIN = st.lists(st.text(st.sampled_from("abcEßÀÿé'’.,!?;: \n1İ\u0301"), max_size=9), max_size=12).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), PLAIN))
def test_any_text(text):
    encoder = bpe.worker_encoder(BYTE, bpe._CHUNK)
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    words = repair.worker_encoder(WORD, repair._WORD, fold=True)
    assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_white_space_of_arrow():
    """Arrow and the vocabulary part words at the same characters, but for four that take the other path."""
    import sys

    import pyarrow as pa
    import pyarrow.compute as pc

    codes = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    split = pc.list_value_length(pc.utf8_split_whitespace(pa.array([f"a{chr(c)}b" for c in codes]))).to_pylist()
    ours = [len(repair._WORD.findall(f"a{chr(c)}b")) for c in codes]
    assert {c for c, x, y in zip(codes, split, ours) if x != y} == {0x1C, 0x1D, 0x1E, 0x1F}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), PLAIN), max_size=6))
def test_words_by_arrow(texts):
    import pyarrow as pa

    words = repair.worker_encoder(WORD, repair._WORD, fold=True)
    for column in (pa.array(texts, pa.string()), pa.array(["x y", *texts, "z"], pa.string()).slice(1, len(texts))):
        flat, counts = words.encode_words(column)
        want = [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert flat.tolist() == [i for ids in want for i in ids] and counts.tolist() == [len(ids) for ids in want]


def test_query_over_a_table(spark):
    got = queries.QUERIES["op7_token_shards"](spark, "/root/testdata/sf0.001").collect()
    docs = sorted(queries.table(spark, "/root/testdata/sf0.001", "documents").collect(), key=lambda r: r["doc_id"])
    tokenizer, start, found = word_reference(), 0, {r["doc_id"]: r for r in got}
    assert len(got) == len(docs)
    for d in docs:
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [2]
        assert tuple(found[d["doc_id"]]) == (d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_ranks_are_checked(tmp_path):
    bpe.check_ranks(BYTE, queries.vocabulary("byte_bpe_50k.tiktoken"))
    (tmp_path / "other").write_text("IQ== 1\n")
    with pytest.raises(ValueError):
        bpe.check_ranks(BYTE, str(tmp_path / "other"))


def test_full_chunk_table(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 3)
    encoder = bpe.ChunkEncoder(BYTE, bpe._CHUNK)
    for text in ("a b c d e", "f g h i", "a b", "x" * 100):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_decoding(spark):
    texts = helpers.AWKWARD + ODD
    coded = bpe.encode(helpers.docs(spark, texts), BYTE)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in bpe.decode(coded, BYTE).collect())
    split = spark.createDataFrame([([i],) for i in range(256)] + [(None,), ([],)], "ids array<int>")
    assert bpe.decode(split, BYTE).count() == 258
    assert bpe.encode(helpers.empty(spark), BYTE).count() == 0


def test_shards(spark):
    texts = helpers.AWKWARD + ODD + ["same words again and again"] * 50
    frame = helpers.docs(spark, texts).repartition(4)
    got = sorted((tuple(r) for r in repair.round_trip(frame, WORD, end=2).collect()))
    tokenizer, start = word_reference(), 0
    for doc_id, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[doc_id] == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert repair.round_trip(helpers.empty(spark), WORD, end=2).count() == 0


def test_null_and_repeated_ids(spark):
    frame = spark.createDataFrame([(None, "a b"), (1, "c"), (1, "c"), (1, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"] is not None, r["start"], r["n_tokens"]) for r in repair.round_trip(frame, WORD, end=2).collect()))
    assert got[0] == (False, 0, 3) and sum(n for *_, n in got) == 3 + 2 + 2 + 1
    assert {s for _, s, _ in got} == {0, *np.cumsum([n for *_, n in sorted(got, key=lambda g: g[1])])[:-1].tolist()}


@pytest.mark.parametrize("seed", range(6))
def test_grammar(seed):
    rng = np.random.RandomState(seed)
    parts = []
    for _ in range(40):
        n = rng.randint(0, 400)
        ids = rng.choice([3, 3, 3, 7, 8, 9, 2], n) if seed % 2 else np.repeat(rng.randint(3, 6), n)
        parts.append(np.append(ids, 2).astype("<u4").tobytes())
    data = repair.to_bytes(list(range(40)), parts, 100, 2)
    shard, flat = repair.Shard(data), np.frombuffer(b"".join(parts), "<u4")
    assert (shard.all_ids() == flat).all() and len(shard.rules)
    assert all((shard.document(k) == np.frombuffer(parts[k], "<u4")).all() for k in range(40))
    for a, b in ((0, len(flat)), (5, 6), (17, 333)):
        assert (shard.ids_between(a, min(b, len(flat))) == flat[a:b]).all()
    sizes = [len(repair.expand(np.array([100 + k]), shard.rules, 100)) for k in range(len(shard.rules))]
    assert sizes == shard.lengths.tolist()
    inner = (shard.symbols[:-1] != 2) & (shard.symbols[1:] != 2)
    keys = (shard.symbols[:-1].astype(np.uint64) << np.uint64(32)) | shard.symbols[1:]
    assert len(repair._frequent(keys, inner, repair.LEAST_USES, 0)[0]) == 0


def test_rounds_look_at_live_positions_only(monkeypatch):
    looked, frequent = [], repair._frequent
    monkeypatch.setattr(repair, "_frequent", lambda keys, *rest: looked.append(len(keys)) or frequent(keys, *rest))
    ids = np.concatenate([np.arange(10, 5010), np.tile([3, 4, 5, 6], 40)])
    rules, symbols = repair.compress(ids, 10_000, 2)
    assert np.array_equal(repair.expand(symbols, rules, 10_000), ids)
    assert len(looked) > 2 and max(looked[1:]) < 500


def test_words_of_letters_stay_arrow(monkeypatch):
    """Only what is no word of letters reaches Python, and a word in another case or before punctuation is met once."""
    import string

    import pyarrow as pa

    words, met = bpe.ChunkEncoder(WORD, repair._WORD, fold=True), []
    learn = words._learn
    monkeypatch.setattr(words, "_learn", lambda seen: met.extend(seen) or learn(seen))
    column = pa.array(["Été ÉTÉ été $$$ Word$$$ word%%% wOrd.", *(f"word{c} Été{c}{c}\tx{c}y é{c}" for c in string.punctuation)])
    flat, counts = words.encode_words(column)
    want = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in column.to_pylist()]
    assert flat.tolist() == [i for ids in want for i in ids] and counts.tolist() == [len(ids) for ids in want]
    assert not any(c.isalpha() for c in met) and not {"Word$$$", "word%%%"} & set(met)
    known = words.words.words.to_pylist()
    assert known.count("été") == known.count("word") == 1 and not {"Été", "ÉTÉ"} & set(known)


def test_many_words_of_letters(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "JOINED_WORDS", 3)
    words = bpe.ChunkEncoder(WORD, repair._WORD, fold=True)
    for n in (0, 1, 3, 7):
        texts = [f"{chr(97 + k) * (k + 1)} {'zq' * k}" for k in range(n)]
        flat, counts = words.encode_words(pa.array(texts, pa.string()))
        want = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert flat.tolist() == [i for ids in want for i in ids] and counts.tolist() == [len(ids) for ids in want]
    words.edge[:] = False  # No end sign is found: each word goes alone.
    words.words.clear()
    flat, _ = words.encode_words(pa.array(texts))
    assert flat.tolist() == [i for ids in want for i in ids]


def test_rules_are_expanded_once(monkeypatch):
    ids = np.tile([3, 4, 5, 6, 7, 8], 3000).astype("<u4")
    shard = repair.Shard(repair.to_bytes([1], [np.append(ids, 2).astype("<u4").tobytes()], 100, 2))
    expanded, expand = [], repair.expand
    monkeypatch.setattr(repair, "expand", lambda symbols, *rest: expanded.append(len(expand(symbols, *rest))) or expand(symbols, *rest))
    assert np.array_equal(shard.all_ids(), np.append(ids, 2))
    assert expanded == [int(shard.lengths.sum())] and expanded[0] < len(ids) / 4
