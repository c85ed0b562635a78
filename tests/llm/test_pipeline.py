"""Stages of the pipeline against plain versions of what each one promises."""

import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parceltrail.llm import bpe, quality
from parceltrail.llm.common import stored
from .test_duplicates import stays_expected

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_stages(spark, sf_dir, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "bpe"]
    out, frame = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, sf_dir), name)
        out[name] = frame.collect()
        if name != "bpe":
            assert frame.columns == docs.columns
    everything = {tuple(r) for r in docs.collect()}
    for name in ("quality", "exact_dedup", "near_dedup", "mix"):
        assert {tuple(r) for r in out[name]} <= everything

    labels = {r.doc_id: r.quality for r in quality.labels_of(spark, sf_dir).collect()}
    left = {r.doc_id for r in out["quality"]}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in left for d in good) / len(good) > 0.95

    keep = {}
    for r in out["quality"]:
        text = r.text.translate(LOWER)
        keep[text] = max(r.doc_id, keep.get(text, -1))
    assert {r.doc_id for r in out["exact_dedup"]} == set(keep.values())
    assert len(out["exact_dedup"]) == len(keep)

    rows = [(r.doc_id, r.text) for r in out["exact_dedup"]]
    near = {r.doc_id for r in out["near_dedup"]}
    assert sorted(near, key=str) == stays_expected(rows, 4, 4) and len(near) == len(out["near_dedup"])

    copies = Counter(r.doc_id for r in out["mix"])
    assert max(copies.values()) <= 3 and set(copies) <= near

    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    texts = {r.doc_id: r.text for r in out["mix"]}
    assert len(out["bpe"]) == len(out["mix"])
    for r in out["bpe"][:50]:
        decoded = library.decode(library.encode(texts[r.doc_id], add_special_tokens=False).ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("name", ["odd", "empty"])
def test_odd_and_empty_tables_pass_all_stages(spark, sf_dir, request, name):
    table = request.getfixturevalue(name)
    frame = table
    for stage_name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, sf_dir), stage_name)
        if stage_name != "bpe":
            assert frame.columns == table.columns
    assert (frame.count() == 0) == (name == "empty")
