"""Divergence of sources against plain loops in Python's integers."""

import re
from collections import Counter, defaultdict

import pytest
from conftest import table

from shelfsense.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    counts, groups, holders = defaultdict(Counter), set(), defaultdict(Counter)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        terms = TERM.findall(text.translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        holders[lang].update(set(terms))
    out = []
    for lang in {a for a, _ in groups}:
        kept = [t for t, n in holders[lang].items() if n >= 3]
        sources = sorted(b for a, b in groups if a == lang)

        def shares(tally):
            total = sum(tally[t] for t in kept)
            return {t: 1 + 10**9 * (tally[t] + 1) // (total + len(kept)) for t in kept}

        own = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((own[s][t] - own[o][t]) ** 2 // own[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (own[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 200)):
                ordered = sorted(found, key=lambda p: (-p[1], p[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in divergence.divergence(df).select("lang", "source", "part", "item", "value", "rank").collect())


ROWS = [
    ("en", "a", "The cat, the CAT and the dog's tail"), ("en", "b", "the cat sat"), ("en", None, "a cat THE end É é é"), ("en", "", "É the é"),
    ("en", "c", None), ("en", "d", ""), ("en", "a", "1234 -- \x00\x7f{|}"), ("fr", "a", "un deux trois"), ("fr", "b", "un deux"), (None, "a", "x x x"), (None, "b", "x y"),
    ("", "b", "x y"), ("", "z", "y"), ("de", "only", "eins eins"), ("en", "b", "ünï日本 ünï日本 ünï日本"), ("en", "e", "ünï日本"), ("en", "a", "ünï日本"), ("en", "a", "w" * 50_000 + " the" * 9),
]


@pytest.mark.parametrize("cells", [divergence.BLOCK_CELLS, 4])
def test_odd_rows(spark, monkeypatch, cells):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    df = spark.createDataFrame([(*r, 7, "x") for r in ROWS], "lang string, source string, text string, n int, term string")
    assert got(df) == brute(ROWS)
    assert got(df.limit(0)) == []


def test_many_sources_and_words_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_ENTRIES", 50)
    rows = [("en", f"s{i % 37}", " ".join(f"w{chr(97 + (i * j) % 23)}{chr(97 + j % 19)}" for j in range(i % 60))) for i in range(600)]
    assert got(spark.createDataFrame(rows, "lang string, source string, text string")) == brute(rows)


def test_the_whole_table(spark):
    rows = list(table("sf0.001", "documents")[["lang", "source", "text"]].itertuples(index=False, name=None))
    assert got(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) == brute(rows)
