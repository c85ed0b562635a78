"""The divergence audit against a brute force over every term, group and pair."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from parceltrail.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, min_docs, top=50):
    """`rows`: (text, lang, source)."""
    groups, docs, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        own = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
        groups[lang or "", source or ""] += own
        docs[lang or ""].update(own.keys())
        total[lang or ""] += own
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def share(counter):
            size = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // (size + 5 * len(kept)) for t in kept}

        sources = [s for at, s in groups if at == lang]
        p, q = {s: share(groups[lang, s]) for s in sources}, share(total[lang])
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if groups[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(sorted(found))]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def fixture():
    dice = random.Random(4)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)] + ["Übung", "ÜBUNG", "né", "日本", "𝔘", "éa"]
    rows = []
    for k in range(260):
        lang = dice.choice(["en", "en", "de", None])
        source = dice.choice(["s1", "s1", "s2", "s3", "é", None, ""])
        shift = len(source or "") * 30
        text = " ".join(words[min(int(dice.expovariate(0.02)) + shift * (k % 3 == 0), len(words) - 1)] for _ in range(dice.randrange(60)))
        rows.append((dice.choice([text, text.upper(), text + "_9x9"]), lang, source))
    rows += [("alone words here", "xx", "only"), (None, "yy", "a"), ("", "yy", "b"), ("123 !!", "en", "no terms")]
    return rows + [("repeated row", "zz", "r"), ("repeated row", "zz", "r"), ("repeated", "zz", "t")] + [("long " * 50_000, "en", "s2")]


def test_against_brute_force(spark):
    rows = fixture()
    frame = spark.createDataFrame([(None, *r, 5, "x") for r in rows], "doc_id long, text string, lang string, source string, term int, n string")
    for min_docs in (1, 2, 10):
        got = rows_of(divergence.divergence(frame, min_docs))
        assert got == expected(rows, min_docs)
        assert {r[2] for r in got} == {"pair", "term"}
    # Small blocks and strips give the same sums.
    assert rows_of(divergence.divergence(frame, 2, 7, (50, 50), 2)) == expected(rows, 2, top=7)


def test_odd_and_empty_tables(spark, odd, empty):
    rows = [(r.text, r.lang, r.source) for r in odd.select("text", "lang", "source").collect()]
    assert rows_of(divergence.divergence(odd, 1)) == expected(rows, 1)
    nothing = rows_of(divergence.divergence(odd))  # no term is in 30 documents: pairs of value 0
    assert nothing == expected(rows, 30) and {r[4] for r in nothing} == {0}
    assert divergence.divergence(empty).count() == 0


def test_many_terms_share_the_last_value(spark):
    """More terms than ranks in one cell: the first in UTF-8 order stay."""
    names = [f"a{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
    rows = [(" ".join(reversed(names)), "en", "a"), ("b b b other", "en", "b"), ("b é", "en", "b")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    got = rows_of(divergence.divergence(frame, 1))
    assert got == expected(rows, 1)
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[1] == "a" and r[2] == "term"] == sorted(names)[:50]


def test_shares_are_exact_for_large_counts(spark):
    counts = np.array([0, 1, 17, 10**13 + 7, 10**14 + 3], np.int64)
    for total, terms in ((0, 1), (10**14 + 99, 3), (2 * 10**14 + 1, 10**9)):
        want = [1 + 10**9 * (int(c) + 5) // (total + 5 * terms) for c in counts if c <= total]
        assert divergence.shares(counts[counts <= total], total, terms).tolist() == want
        frame = spark.createDataFrame([(int(c), total, terms) for c in counts if c <= total], "n long, size long, terms long")
        assert [r[0] for r in frame.select(divergence.share("n", "size", "terms")).collect()] == want


def test_cells_of_a_pair():
    own = pd.DataFrame({"source": ["a", "a", "a", "b", "b", "c"], "term": list("xyzxwy"), "n": [1, 1, 2, 1, 3, 9]})
    groups = pd.DataFrame({"source": ["a", "b", "c", "d"], "size": [4, 4, 9, 0], "terms": [4] * 4})
    table = own.pivot(index="source", columns="term", values="n").reindex(groups["source"]).fillna(0).to_numpy().astype(int)
    p = np.stack([divergence.shares(row, size, 4) for row, size in zip(table, groups["size"])])
    got = {s: sums.tolist() for s, sums in divergence.cell_sums(own, groups, 0, 4)}
    assert got == {s: [int(np.abs(p[s] - p[t]).sum()) for t in range(s + 1, 4)] for s in range(4)}
