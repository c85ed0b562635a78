"""Documents with everything that may go wrong: nulls, ties, repeats, long texts, extra columns with names used inside."""

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, rank long, chunk long, "
    "score double, size long, ids string, word string, key long, fp long, node long, of string, label string, copies long"
)
LICENSE = "Released Under the MIT License, and not CC BY-NC. "


def prose(seed, words):
    dice = random.Random(seed)
    return " ".join(dice.choice(["the", "and", "Übung", "inthe", "oferea", "thand,", "ed.", "né"]) + str(dice.randrange(40)) for _ in range(words))


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), "x", 1, 2, 0.5, 3, "i", "w", 4, 5, 6, "o", "l", 7)


@pytest.fixture(scope="session")
def odd_rows():
    shared = prose(1, 60)
    return [
        row(1, shared),
        row(1, shared),
        row(2, shared.upper().replace("Ü", "ü").replace("É", "é")),
        row(3, None),
        row(4, ""),
        row(5, " \t\n "),
        row(6, LICENSE + shared + " tail of its own", None),
        row(7, prose(2, 9000), "b"),
        row(8, prose(3, 30) + " " + shared + " " + prose(4, 30), "b"),
        row(None, prose(5, 40)),
        row(None, shared, "b"),
        row(9, "<|endoftext|> a b  c　d 日本語、テキスト"),
        row(9, "another text of one id"),
        row(10, "a" * 500 + " " + "!" * 300),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def plain_docs(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]
