"""Byte-level BPE over Arrow batches with a public tokenizer file, and its exact inverse.

The pattern that splits a text before the merges never joins what white space separates, so a
text's ids are the ids of its runs ("chunks": an optional space and non-space characters, or
white space alone) in order. Each Python worker lets the tokenizers library encode a chunk once
and keeps its ids in a bounded table.
"""

from __future__ import annotations

import base64
import json
import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from riskloom.llm.common import WHITE_SPACE, list_array, pieces, texts_of

#: Chunks kept per Python worker, and the longest that is kept; rows that are decoded together.
KEPT_CHUNKS, KEPT_CHARS, DECODED_ROWS = 200_000, 40, 512
#: Words kept as Arrow columns.
KEPT_WORDS = 1_500_000
#: Letters without marks of their own, up to 40, and punctuation that ends the chunk.
_PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]{1,40})([.,!?;:]*)")
#: For the regular expressions of Arrow: words of letters; a letter, ASCII punctuation but ``'``, then white space or the end.
_LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]{1,40}$"
_TAIL = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~]+)(\s|$)"
#: Words of letters that go to the library in one text.
JOINED_WORDS = 256
_CHUNK = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")


class ChunkEncoder:
    """Ids of texts as little-endian 32-bit bytes; the library sees only words not met before.

    A chunk of plain letters with punctuation behind it is two pieces for the vocabulary's
    pattern, so it is put together from the word and the punctuation. New words go to the library
    many in one text, and its ids are cut where a token carries the vocabulary's sign of a word's
    begin (``Ġ``) or end (``</w>``); should the number of words not fit, each goes alone.
    ``fold``: the vocabulary lower-cases, so words are kept in lower case.
    """

    def __init__(self, path: str, chunk: re.Pattern, fold: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Strings that look like special tokens are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.chunk, self.fold, self.known = chunk, fold, {}
        self.words = Words(KEPT_WORDS)
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        self.edge = np.zeros(max(words.values(), default=-1) + 1, bool)
        for word, i in words.items():
            self.edge[i] = word.endswith("</w>") if fold else word.startswith("Ġ")

    def _alone(self, chunks: list[str]) -> Iterator[bytes]:
        for i in range(0, len(chunks), 4096):
            for e in self.tokenizer.encode_batch_fast(chunks[i : i + 4096], add_special_tokens=False):
                yield struct.pack(f"<{len(e.ids)}I", *e.ids)

    def _together(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters (each with a space before it, unless the vocabulary folds)."""
        groups = [words[i : i + 256] for i in range(0, len(words), 256)]
        texts = [(" " if self.fold else "").join(g) for g in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            edges = np.flatnonzero(self.edge[ids]) + self.fold
            if len(edges) != len(group):
                yield from self._alone(group)
                continue
            ends = 4 * (edges if self.fold else np.append(edges[1:], len(ids)))
            data = ids.tobytes()
            yield from map(data.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))

    def _learn(self, seen: Iterable[str]) -> tuple[dict[str, bytes], list[str]]:
        """The table with the ids of all ``seen`` chunks, and the new ones that aren't plain words."""
        known = self.known
        new = [c for c in seen if c not in known]
        if len(known) + len(new) > KEPT_CHUNKS:
            known = self.known = {c: known[c] for c in seen if c in known}
        made, words, rest = [], set(), set()
        for c in new:
            if m := _PLAIN.fullmatch(c):
                word, tail = m[1].lower() if self.fold else m[1], m[2]
                made.append((c, word, tail))
                (words if self.fold or word[0] == " " else rest).add(word)
                if tail:
                    rest.add(tail)
            else:
                rest.add(c)
        words, rest = [w for w in words if w not in known], [c for c in rest if c not in known]
        known.update(zip(words, self._together(words)))
        known.update(zip(rest, self._alone(rest)))
        known.update((c, known[w] + known[t] if t else known[w]) for c, w, t in made)
        return known, rest

    def _forget(self, known: dict[str, bytes], rest: list[str]) -> None:
        if len(known) > KEPT_CHUNKS:
            self.known = {}
        else:
            for c in rest:
                if len(c) > KEPT_CHARS:
                    del known[c]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.chunk.findall(t) for t in texts]
        known, rest = self._learn(set().union(*split))
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        self._forget(known, rest)
        return out

    def encode_words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column in a row, and the number of each text's; for vocabularies that drop white space.

        Arrow splits the texts and numbers their different words; the library sees only those not
        met before, and ids are gathered by number.
        """
        # A copy whose buffers begin with the first text: kernels misread slices of other buffers.
        column = pc.fill_null(column.cast(pa.large_string()), "").take(pa.array(np.arange(len(column))))
        if pc.any(pc.match_substring_regex(column, "[\x1c-\x1f]")).as_py():  # Arrow's white space, but not the vocabulary's
            found = self.encode([x.as_py() for x in column])
            return np.frombuffer(b"".join(found), "<u4"), np.array([len(b) // 4 for b in found], np.int64)
        # Punctuation behind a letter is a piece of its own for such vocabularies; apart, both are fewer.
        split = pc.utf8_split_whitespace(pc.replace_substring_regex(column, _TAIL, r"\1 \2\3"))
        first, last = split.offsets[0].as_py(), split.offsets[-1].as_py()
        coded = split.values.slice(first, last - first).dictionary_encode()
        # Words of letters that differ in case only are one.
        cased = coded.dictionary
        words = pc.if_else(pc.match_substring_regex(cased, _LETTERS), pc.utf8_lower(cased), cased).dictionary_encode()
        place = self.words.places(words.dictionary, self._ids_of)[words.indices.to_numpy()][coded.indices.to_numpy(zero_copy_only=False)]
        each = self.words.length[place]
        ends = np.concatenate([[0], np.cumsum(each)])
        kind = np.int32 if max(ends[-1], len(self.words.flat)) < 1 << 31 else np.int64
        # Position of every id: its word's begin plus its place in the word.
        at = np.repeat((self.words.begin[place] - ends[:-1]).astype(kind), each)
        at += np.arange(ends[-1], dtype=kind)
        return self.words.flat[at], np.diff(ends[split.offsets.to_numpy() - first])

    def _ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of different words in a row, where each word's begin and how many they are.

        Words of letters are joined by Arrow and cut by their end sign; only the others become Python strings.
        """
        letters = pc.match_substring_regex(words, _LETTERS).to_numpy(zero_copy_only=False)
        joined, counts = self._ids_of_letters(words.filter(pa.array(letters)))
        others = words.filter(pa.array(~letters)).to_pylist()
        self.known = {}
        known, _ = self._learn(set(others) - {""})
        self.known = {}
        rest = [known[c] if c else b"" for c in others]
        begin, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        length[letters], length[~letters] = counts, [len(b) // 4 for b in rest]
        begin[letters] = np.cumsum(counts) - counts
        begin[~letters] = len(joined) + np.cumsum(length[~letters]) - length[~letters]
        return np.concatenate([joined, np.frombuffer(b"".join(rest), "<u4")]), begin, length

    def _ids_of_letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words of letters in a row, and the number of each one's, for vocabularies that mark a word's end."""
        starts = np.append(np.arange(0, len(words), JOINED_WORDS), len(words))
        groups = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), words)
        texts = pc.binary_join(groups, pa.scalar(" ", pa.large_string())).to_pylist()
        flat, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for k, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) == starts[k + 1] - starts[k]:
                counts.append(np.diff(edges, prepend=-1))
            else:
                alone = list(self._alone(words.slice(starts[k], starts[k + 1] - starts[k]).to_pylist()))
                ids = np.frombuffer(b"".join(alone), "<u4")
                counts.append(np.array([len(b) // 4 for b in alone], np.int64))
            flat.append(ids)
        return np.concatenate(flat), np.concatenate(counts)


class Words:
    """Ids of the words met so far, as columns: the words, where their ids begin and how many they are."""

    def __init__(self, kept: int):
        self.kept = kept
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.begin, self.length, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def places(self, words: pa.Array, ids_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """The place of each of the different ``words``; only new ones are asked for."""
        place = pc.index_in(words, value_set=self.words)
        fresh = words.filter(pc.is_null(place))
        if len(self.words) + len(fresh) > self.kept and len(self.words):
            self.clear()
            return self.places(words, ids_of)
        found = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(fresh):
            flat, begin, length = ids_of(fresh)
            found[found < 0] = len(self.words) + np.arange(len(fresh))
            self.begin = np.concatenate([self.begin, len(self.flat) + begin])
            self.length = np.concatenate([self.length, length])
            self.flat = np.concatenate([self.flat, flat])
            self.words = pa.concat_arrays([self.words, fresh])
        return found


@lru_cache(maxsize=4)
def worker_encoder(path: str, chunk: re.Pattern, fold: bool = False) -> ChunkEncoder:
    """One encoder per Python worker, so later tasks find the chunks of earlier ones."""
    return ChunkEncoder(path, chunk, fold)


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary, and the byte.

    Printable bytes stand for themselves; the others take the code points from 256 upwards.
    """
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes(path: str) -> list[bytes]:
    """Bytes of every id; added tokens are kept as their own text."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    alphabet = byte_alphabet()
    words = {i: bytes(alphabet[c] for c in w) for w, i in content["model"]["vocab"].items()}
    words |= {t["id"]: t["content"].encode() for t in content.get("added_tokens", ())}
    return [words.get(i, b"") for i in range(max(words, default=-1) + 1)]


def check_ranks(path: str, ranks: str) -> None:
    """Refuse a vocabulary whose ids aren't the ranks of a rank file (base64 token and rank a line)."""
    known = token_bytes(path)
    with open(ranks, "rb") as file:
        for token, rank in map(bytes.split, file):
            if int(rank) >= len(known) or known[int(rank)] != base64.b64decode(token):
                raise ValueError(f"{path} and {ranks} differ at rank {int(rank)}")


def character_offsets(data: bytes, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of each token of a UTF-8 text.

    A character split over several tokens belongs to each of them.
    """
    if not len(ids):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    starts_character = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    character = np.cumsum(starts_character) - 1
    ends = np.cumsum(lengths[ids])
    return character[ends - lengths[ids]].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)


def encode(
    docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", offsets: bool = False
) -> DataFrame:
    """All rows and columns plus ``ids`` (array of int), optionally ``ids_start`` / ``ids_end``.

    ``vocabulary``: path of a byte-level tokenizer file, on every machine. Texts are encoded
    whole. Null and empty texts have no ids. Columns of the same names are replaced.
    """
    added = [ids, f"{ids}_start", f"{ids}_end"] if offsets else [ids]
    rows = docs.drop(*added)
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.ArrayType(T.IntegerType(), False), False) for n in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary, _CHUNK)
        lengths = np.array([len(b) for b in token_bytes(vocabulary)]) if offsets else None
        for batch in pieces(batches, text):
            texts = texts_of(batch, text)
            found = encoder.encode(texts)
            counts = [len(b) // 4 for b in found]
            columns = [list_array(np.frombuffer(b"".join(found), "<u4").astype(np.int32), counts, pa.int32())]
            if offsets:
                spans = [character_offsets(t.encode(), np.frombuffer(b, "<u4"), lengths) for t, b in zip(texts, found)]
                columns += [list_array(np.concatenate([s[i] for s in spans]), counts, pa.int32()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added])

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All rows and columns plus ``out``: the bytes of each row's ids, in order.

    Bytes are joined before anyone reads them as characters, so characters split over tokens
    come back whole; ids that cut a character give the bytes they stand for. Null id lists decode
    to no bytes; an id outside the vocabulary is an error.
    """
    rest = rows.drop(out)
    schema = T.StructType([*rest.schema.fields, T.StructField(out, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(vocabulary)
        for batch in batches:
            for i in range(0, batch.num_rows, DECODED_ROWS):
                some = batch.slice(i, DECODED_ROWS)
                column = some.column(some.schema.get_field_index(ids))
                made = [b"".join([table[i] for i in x]) if x else b"" for x in _lists(column)]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(made, type=pa.binary())], names=[*some.schema.names, out]
                )
                del made, column, some
                pa.default_memory_pool().release_unused()

    return rest.mapInArrow(run, schema)


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """Python lists of ids, one at a time."""
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    for i in range(len(column)):
        yield values[offsets[i] : offsets[i + 1]].tolist()
