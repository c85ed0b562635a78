"""Operator 5: encoding and decoding with a word-level BPE vocabulary, in batched numpy merge rounds.

The symbols of many words lie in one flat array. A round finds every pair's rank by binary search over the sorted pair
keys, takes the lowest rank of each word, merges that pair in all words at once, and lets finished words leave. Words
are few compared with their occurrences, so each Python worker keeps a bounded table of words it has encoded.

Words that hold a code point which Python's Unicode tables don't know yet are normalised and split by the library, once for
each such word: which letters it knows, and lowers, is its own. All others are normalised and split here.

Null texts count as empty (no ids, empty decoded text); nothing else in a row matters, so ties, repeated rows and
extra columns need no rule. Each row is handled by itself: no shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType
from tokenizers import Tokenizer

from parceltrail.llm.common import documents, texts_of

VOCABULARY = "word_bpe_49k.json"
KEPT_WORDS = 600_000
SLICE_BYTES = 2_000_000
#: First sign of a unit that the library normalises and splits, white space as no other unit has it.
RAW = "\n"
NO_RANK = np.iinfo(np.int64).max
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACED = re.compile("[^\t-\r \x85\xa0  -     　]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [table[b] for b in range(256)]


@functools.cache
def unassigned() -> re.Pattern[str]:
    """Matches a code point that has no category in Python's Unicode tables."""
    known = bytes(unicodedata.category(chr(c)) != "Cn" for c in range(sys.maxunicode + 1))
    edges = np.flatnonzero(np.diff(np.frombuffer(b"\1" + known + b"\1", np.int8)))
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())) + "]")


def holds_unassigned(text: str) -> bool:
    """Whether a text holds such a code point; texts of Latin letters alone are told by their encoding."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return unassigned().search("".join(set(text))) is not None
    return False


def spans(flat: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the pieces flat[start:stop] in a row, their offsets)."""
    sizes = stops - starts
    ends = np.r_[0, np.cumsum(sizes)]
    return flat[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)], ends


class WordBpe:
    """A vocabulary file of this kind: NFC, lower case, split at white space and by pattern, end-of-word suffix."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.byte_of = {s: b for b, s in enumerate(byte_symbols())}
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = {"\0" + t: i for t, i in self.specials.items()}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + self.suffix] for s in symbols], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.width = len(self.tokens) + 1
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        # A merge may take all its places in a word at once if what it makes is only used by later merges.
        last_made = np.zeros(self.width, np.int64)
        np.maximum.at(last_made, made, np.arange(len(made)))
        at = np.arange(len(made))
        self.all_at_once = bool(((last_made[left] <= at) & (last_made[right] <= at)).all())
        spaced = [self.tokens.get(i, "").encode() + b" " for i in range(max(self.tokens) + 1)]
        self.token_bytes = np.frombuffer(b"".join(spaced), np.uint8)
        self.token_ends = np.r_[0, np.cumsum([len(t) for t in spaced])]
        self.number: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, offsets) by merge rounds over one flat array; words are not empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words)), lengths)
        symbol = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        symbol[ends] = self.last[raw[ends]]
        rank = np.full(len(symbol), NO_RANK)
        made = np.zeros(len(symbol), np.int64)
        fresh = np.arange(len(symbol))
        done_words, done_symbols = [], []
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            last = np.r_[first[1:], len(symbol)] - 1
            # Only pairs that the last round touched have a new rank.
            key = symbol[fresh] * self.width + symbol[np.minimum(fresh + 1, len(symbol) - 1)]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank[fresh] = np.where(self.keys[at] == key, self.ranks[at], NO_RANK)
            made[fresh] = self.made[at]
            rank[last] = NO_RANK
            own_lowest = np.repeat(np.minimum.reduceat(rank, first), last - first + 1)
            active = own_lowest != NO_RANK
            done_words.append(word[~active])
            done_symbols.append(symbol[~active])
            places = np.flatnonzero(active & (rank == own_lowest))
            if len(places) and self.all_at_once:
                # Of touching places (one symbol repeated) every other one from the left merges.
                start = np.r_[True, places[1:] != places[:-1] + 1]
                run_start = np.maximum.accumulate(np.where(start, places, 0))
                places = places[(places - run_start) % 2 == 0]
            elif len(places):
                places = places[np.r_[True, word[places[1:]] != word[places[:-1]]]]
            symbol[places] = made[places]
            touched = np.zeros(len(symbol), bool)
            touched[places] = True
            touched[np.maximum(places - 1, 0)] = True
            active[places + 1] = False
            symbol, word, rank, made = symbol[active], word[active], rank[active], made[active]
            fresh = np.flatnonzero(touched[active])
        all_words, all_symbols = np.concatenate(done_words), np.concatenate(done_symbols)
        order = np.argsort(all_words, kind="stable")
        counts = np.bincount(all_words, minlength=len(words))
        return all_symbols[order], np.r_[0, np.cumsum(counts)]

    def learn(self, units: set[str]) -> None:
        """Encode units not yet in the table; the table is emptied before it passes its bound."""
        fresh = [u for u in units if u not in self.number and u not in self.marks]
        if len(self.number) + len(fresh) > KEPT_WORDS:
            self.number.clear()
            self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
            fresh = [u for u in units if u not in self.marks]
        split = [self.split_by_library(u[1:]) if u[0] == RAW else [p.encode() for p in ((u,) if u.isalpha() else self.pieces.findall(u))] for u in fresh]
        flat = [p for pieces in split for p in pieces]
        values, offsets = self.encode_words(flat) if flat else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        upto = offsets[np.r_[0, np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]]
        self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh))))
        self.ends = np.r_[self.ends, len(self.flat) + upto[1:]]
        self.flat = np.r_[self.flat, values.astype(np.int32)]
        for mark in sorted((self.marks.keys() & units) - self.number.keys()):
            self.number[mark] = len(self.ends) - 1
            self.flat = np.r_[self.flat, np.int32(self.marks[mark])]
            self.ends = np.r_[self.ends, len(self.flat)]

    def split_by_library(self, unit: str) -> list[bytes]:
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(unit))
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in pieces]

    def units(self, text: str) -> list[str]:
        """Words between white space, normalised unless marked RAW; special tokens' strings stand as marks of their own."""
        if self.special_split is not None and "<|" in text:
            found: list[str] = []
            for part in self.special_split.split(text):
                if part in self.specials:
                    found.append("\0" + part)
                elif part:
                    found += self._plain(part)
            return found
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            if holds_unassigned(text):
                units = [(RAW + u,) if holds_unassigned(u) else WordBpe._plain(u) for u in _SPACED.findall(text)]
                return list(itertools.chain.from_iterable(units))
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return _SPACED.findall(text) if _SEPARATORS.search(text) else text.split()

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of each text's ids)."""
        split = [self.units(t) for t in texts]
        if not any(split):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        self.learn(set().union(*split))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        number = np.fromiter(map(self.number.__getitem__, itertools.chain.from_iterable(split)), np.int64, counts.sum())
        values, ends = spans(self.flat, self.ends[number], self.ends[number + 1])
        return values, ends[np.r_[0, np.cumsum(counts)]]

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes of all decoded texts in a row, offsets): tokens with their suffix marks, a space between.

        A vocabulary file without a decoder defines decoding so.
        """
        spaced, at = spans(self.token_bytes, self.token_ends[ids], self.token_ends[ids + 1])
        upto = at[ends]
        # Every token carries a space at its end; the last one of a text loses it.
        keep = np.ones(len(spaced), bool)
        filled = ends[1:] > ends[:-1]
        keep[upto[1:][filled] - 1] = False
        return spaced[keep], upto - np.r_[0, np.cumsum(filled)]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def sliced(texts: list[str], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of slices that hold about so many characters each; one long text is a slice of its own."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, k
            start, held = k, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def encode_decode(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """`docs` with columns ids (array<int>) and decoded (string), which replace columns of these names."""
    docs = docs.drop("ids", "decoded")
    vocabulary_path = path or public_tokenizers.path(VOCABULARY)
    schema = StructType([*docs.schema.fields]).add("ids", ArrayType(IntegerType())).add("decoded", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(vocabulary_path)
        for batch in batches:
            texts = texts_of(batch.column(text))
            for a, b in sliced(texts):
                ids, ends = model.encode_batch(texts[a:b])
                spelled, upto = model.decode_batch(ids, ends)
                part = batch.slice(a, b - a)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                decoded = pa.StringArray.from_buffers(
                    b - a, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(spelled)
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists, decoded], [*part.schema.names, "ids", "decoded"]
                )

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text: the operator's output reduced inside its tasks."""
    vocabulary_path = path or public_tokenizers.path(VOCABULARY)

    def hashes(raw: memoryview, ends: list[int]) -> pa.Array:
        return pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in itertools.pairwise(ends)], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(vocabulary_path)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in sliced(texts):
                ids, ends = model.encode_batch(texts[a:b])
                spelled, upto = model.decode_batch(ids, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).cast(pa.int64()),
                        pa.array(np.diff(ends)),
                        hashes(memoryview(ids.astype("<u4").tobytes()), (4 * ends).tolist()),
                        hashes(memoryview(spelled.tobytes()), upto.tolist()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
