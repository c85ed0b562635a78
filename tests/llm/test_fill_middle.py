"""Fill-in-the-middle against a plain version, and exact round trips."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parceltrail.llm import fill_middle
from parceltrail.llm.fill_middle import PieceTable


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    p, q = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(text), "plain", None, None, text
    pre, mid, suf = text[:p], text[p:q], text[q:]
    if h[3] % 100 < 20:
        return doc_id, len(text), "spm", p, q - p, f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(text), "psm", p, q - p, f"<P>{pre}<S>{suf}<M>{mid}"


ODD = [(k, t) for k, t in enumerate(
    [None, "", "a", "né", "日本語😀é", "has <P> in it", "<S>", "<M> last", "<P", "S><", "<<S", "P><P", "\x00\n", "x" * 70_000] * 8
)] + [(None, "no id"), (None, None), (-5, "negative"), (7, "again"), (7, "again")]


def key(row):
    return str(tuple(row))


def test_forms_and_round_trip(spark):
    frame = spark.createDataFrame([(*r, "x", 1) for r in ODD], "doc_id long, text string, form string, output int")
    out = fill_middle.transform(frame)
    want = sorted((expected(*r) for r in ODD), key=key)
    assert sorted(map(tuple, out.collect()), key=key) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    back = fill_middle.restore(out)
    assert sorted(map(key, back.collect())) == sorted(key((d, t or "")) for d, t in ODD)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    sums = sorted((r.doc_id is None, r.doc_id or 0, r.output_sha256, r.restored_sha256) for r in fill_middle.digests(frame).collect())
    assert sums == sorted((w[0] is None, w[0] or 0, sha(w[5]), sha(t or "")) for w, (_, t) in ((expected(*r), r) for r in ODD))


def test_whole_table(spark, docs, odd, empty):
    for frame in (docs, odd):
        got = sorted(map(key, fill_middle.transform(frame).collect()))
        assert got == sorted(key(expected(r.doc_id, r.text)) for r in frame.select("doc_id", "text").collect())
    assert fill_middle.transform(empty).count() == 0 and fill_middle.digests(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="<>PSMaé😀", max_size=12), min_size=1, max_size=6), st.integers(0, 10_000))
def test_borders_make_no_sentinels(texts, first):
    import pyarrow as pa

    ids = list(range(first, first + len(texts)))
    got = fill_middle.arrange(ids, pa.array(texts), 1, 0, 50)
    outputs = [got.table.bytes_of(k) for k in range(len(texts))]
    back = fill_middle.restored(outputs, got.form)
    assert [back.bytes_of(k).decode() for k in range(len(texts))] == texts
    for output, form in zip(outputs, got.form.tolist()):
        assert not form or all(output.count(m) == 1 for m in fill_middle.MARKS)


@pytest.mark.parametrize("at", range(10))
def test_cut_keeps_the_text(at):
    table = fill_middle.whole_texts(np.frombuffer(b"abcdefghi", np.uint8), np.array([0, 9]))
    for k in (4, at, 9):
        table = table.cut(np.array([k]))
    assert isinstance(table, PieceTable) and table.start.shape == (1, 4)
    assert table.bytes_of(0) == b"abcdefghi" and at in (table.stop - table.start).cumsum().tolist() + [0]
    order = np.array([[2, 0, 3, 1]])
    assert table.permuted(order).permuted(np.argsort(order, axis=1)).bytes_of(0) == b"abcdefghi"
