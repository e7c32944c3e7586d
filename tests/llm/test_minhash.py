"""Near copies by signatures against a comparison of all pairs."""

import random

import numpy as np
from conftest import table

from shelfsense.llm import minhash


def brute(rows):
    sets, parent = [], {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    holders = {}
    for place, shingles in enumerate(sets):
        for shingle in shingles:
            holders.setdefault(shingle, []).append(place)
    for a, shingles in enumerate(sets):
        for b in {b for s in shingles for b in holders[s] if b < a}:
            both = len(shingles & sets[b])
            if None not in (rows[a][0], rows[b][0]) and 100 * both >= 85 * len(shingles | sets[b]):
                x, y = find(rows[a][0]), find(rows[b][0])
                parent[max(x, y)] = min(x, y)
    found = [(i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)]
    return sorted(((*r, r[0] == r[2]) for r in found), key=repr)


def got(df):
    return sorted((tuple(r) for r in minhash.near_copies(df).collect()), key=repr)


def family(rng, first, copies, length, edits, vocabulary=10**6):
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
    for i in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"e{rng.randrange(500)}"
        yield first + i, " ".join(words)


def test_hostile_documents(docs, no_docs):
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(no_docs) == []


def test_families_on_both_sides_of_the_threshold(spark):
    rng = random.Random(3)
    rows = [row for f in range(12) for row in family(rng, 100 * f, 40, rng.choice([12, 60, 200]), rng.choice([2, 4, 6]))]
    passage = " ".join(f"p{i}" for i in range(80))
    rows += [(5000 + i, f"{passage} " + " ".join(f"u{i}-{j}" for j in range(15))) for i in range(60)]
    rows += [(i, "one two three") for i in range(6000, 6300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)


def test_a_list_longer_than_a_tile(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 8)
    rng = random.Random(5)
    rows = list(family(rng, 0, 150, 80, 3)) + list(family(rng, 1000, 60, 50, 1, 40))
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_links_of_a_large_group_grow_with_its_size(spark, monkeypatch):
    seen = []
    components = minhash.connected_components

    def counted(links, rounds=None):
        seen.append(links.count())
        return components(links, rounds)

    monkeypatch.setattr(minhash, "connected_components", counted)
    rng = random.Random(11)
    rows = [row for f in range(2) for row in family(rng, 1000 * f, 600, 60, 2)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert max(seen) < 8 * len(rows)


def test_a_cell_gives_fewer_links_than_components(spark):
    sets, cells = [], []
    for node in range(30):
        tokens = np.sort(minhash.mix(np.r_[np.arange(1, 301), 1000 + node].astype(np.uint64)))
        sets.append((node, len(tokens), bytearray(minhash.signature(tokens).tobytes()), -1, bytearray(minhash.fold(tokens)), bytearray(tokens.tobytes())))
        cells.append((0, 0, 0, node, node))
    sets = spark.createDataFrame(sets, "node long, n long, signature binary, prefix long, bitmap binary, tokens binary")
    cells = spark.createDataFrame(cells, "key long, cell long, side long, node long, component long")
    assert 0 < minhash._cell_links(minhash._open_nodes(cells, sets), sets).count() < 30


def test_cells_of_many_shingles_are_cut(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART_BYTES", 8 * 400)
    rng = random.Random(13)
    rows = [row for f in range(4) for row in family(rng, 100 * f, 40, rng.choice([40, 90]), 6)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_rows_of_one_id_are_one_document(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(9, one), (9, two), (4, two + " x"), (7, one), (7, None), (3, ""), (3, one), (None, one), (1, "a b")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_the_whole_table(spark):
    rows = list(table("sf0.01", "documents")[["doc_id", "text"]].itertuples(index=False, name=None))
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(df) == brute(rows)
