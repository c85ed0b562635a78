"""Token ids and BPE against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parceltrail.llm import bpe, token_blocks


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(public_tokenizers.path(token_blocks.VOCABULARY))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


@pytest.mark.parametrize(
    "ids",
    [[], [7], [0, 2**32 - 1] * 100, list(range(1000)), [5] * 129, np.random.default_rng(1).integers(0, 50257, 10_000).tolist()],
)
def test_blocks_round_trip(ids):
    assert token_blocks.unpack(token_blocks.pack(np.array(ids, np.int64))).tolist() == ids


def expected(rows, library):
    out, start = [], 0
    order = lambda r: (r[0] is not None, r[0] or 0, np.r_[library.encode(r[1] or "", add_special_tokens=False).ids, 2].astype("<u2").tobytes())
    for doc_id, text in sorted(rows, key=order):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def result(spark, docs, path):
    token_blocks.write_tokens(docs, path)
    rows = token_blocks.read_tokens(spark, path).selectExpr("doc_id", "start", "n_tokens", "crc32(ids) AS crc").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_token_files(spark, docs, plain_docs, byte_library, tmp_path):
    assert result(spark, docs, str(tmp_path / "f")) == expected([r[:2] for r in plain_docs], byte_library)


def test_token_files_of_odd_documents(spark, odd, odd_rows, empty, byte_library, tmp_path):
    assert result(spark, odd, str(tmp_path / "f")) == expected([r[:2] for r in odd_rows], byte_library)
    assert result(spark, empty, str(tmp_path / "e")) == []


def test_bpe_rounds(docs, plain_docs, word_library):
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(docs).collect()}
    for doc_id, text, _ in plain_docs:
        ids = word_library.encode(text or "", add_special_tokens=False).ids
        decoded = word_library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        assert got[doc_id] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_bpe_of_odd_documents(odd, odd_rows, empty, word_library):
    rows = bpe.encode_decode(odd).select("doc_id", "text", "ids", "decoded").collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        ids = word_library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids
        assert r.decoded == word_library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(empty).count() == 0
    assert bpe.digests(empty).count() == 0


def test_every_code_point_between_letters(word_library):
    model = bpe.WordBpe(public_tokenizers.path(bpe.VOCABULARY))
    points = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000] + [*range(0xE0000, 0xE0200), 0xF0000, 0x10FFFD, 0x10FFFF]
    for start in range(0, len(points), 2000):
        part = points[start : start + 2000]
        for text in (" ".join(f"a{chr(c)}b" for c in part), "".join(f"É{chr(c)}" for c in part)):
            ids, _ = model.encode_batch([text])
            assert ids.tolist() == word_library.encode(text, add_special_tokens=False).ids, hex(part[0])


def test_newer_code_points_beside_others(word_library):
    model = bpe.WordBpe(public_tokenizers.path(bpe.VOCABULARY))
    texts = ["\ua7cb\ua7da x", "a\u0558b <|endoftext|>\u0558\u3000É\u0301", "J\u030c \u1c89\u0301", "\U000323b0\u2028\x1c\u0558\x85z", "\U00016d67\U00016d67"]
    for text in texts:
        ids, _ = model.encode_batch([text])
        assert ids.tolist() == word_library.encode(text, add_special_tokens=False).ids, text


def test_merging_one_place_at_a_time_gives_the_same():
    model = bpe.WordBpe(public_tokenizers.path(bpe.VOCABULARY))
    words = [b"aaaaaaa", b"banana", b"tthhee", "übungen".encode(), b"x"]
    assert model.all_at_once
    ids, ends = model.encode_words(words)
    model.all_at_once = False
    again, ends_again = model.encode_words(words)
    assert ids.tolist() == again.tolist() and ends.tolist() == ends_again.tolist()
