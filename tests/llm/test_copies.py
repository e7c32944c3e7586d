"""Near copies, repeated passages and repeated lines against brute force."""

import hashlib
import random

import numpy as np
import pytest
from conftest import table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfsense.llm import components, linededup, repeats, setjoin


def brute_components(rows):
    sets, parent = [], {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and None not in (rows[a][0], rows[b][0]) and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(rows[a][0]), find(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=repr)


def spark_components(df):
    return sorted((tuple(r) for r in setjoin.jaccard_components(df).collect()), key=repr)


def test_components_of_hostile_documents(docs):
    assert spark_components(docs) == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_components_of_many_near_copies(spark):
    rng = random.Random(1)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for family in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([20, 90, 160]))]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(50)}"
            rows.append((len(rows), " ".join(words + passage * (family % 2))))
    rows += [(1000 + i, " ".join([f"u{i}-{j}" for j in range(20)] + passage)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert spark_components(df) == brute_components(rows)


def test_components_of_the_whole_table(spark):
    rows = list(table("sf0.001", "documents")[["doc_id", "text"]].itertuples(index=False, name=None))
    got = spark_components(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert got == brute_components(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1), min_size=2, max_size=70))
def test_traversal_loses_no_link(sets):
    arrays = [np.sort(setjoin.mix(np.array(sorted(s), np.uint64))) for s in sets]
    maps = np.array([setjoin.bitmap(a, 64) for a in arrays])
    tree = setjoin.SignatureTree(maps, np.array([len(a) for a in arrays]), np.arange(len(arrays)))
    found = {tuple(sorted(pair)) for pair in tree.pairs()[:, :2].tolist()}
    links = {(a, b) for b in range(len(sets)) for a in range(b) if setjoin.similar(arrays[a], arrays[b])}
    assert links <= found


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(90, 91), (90, 91)], "a long, b long")
    found = {r.node: r.component for r in components.connected_components(links).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 90: 90, 91: 90}


def brute_repeats(rows):
    seen, expected, marks = set(), [], {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        mark = np.zeros(len(data), int)
        for at in range(len(data) - 99):
            if data[at : at + 100] in seen:
                mark[at : at + 100] = 1
            seen.add(data[at : at + 100])
        kept = np.frombuffer(data, np.uint8)[mark == 0].tobytes()
        spans = int((np.diff(np.r_[0, mark]) == 1).sum())
        expected.append((key, len(data), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return expected


def spark_repeats(df):
    rows = repeats.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept"))
    return sorted(map(tuple, rows.collect()), key=repr)


def test_repeats_of_the_whole_table(spark):
    rows = list(table("sf0.001", "documents")[["doc_id", "text"]].itertuples(index=False, name=None))
    got = spark_repeats(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert got == sorted(brute_repeats(rows), key=repr)


def test_repeats_of_passages_and_long_texts(spark, monkeypatch):
    rng = random.Random(2)
    words = lambda n: " ".join(str(rng.randrange(10**5)) for _ in range(n))
    passage, long = words(60), words(3000)
    rows = [(i, words(20) + passage[rng.randrange(30) :] + words(rng.randrange(9))) for i in range(30)]
    rows += [(40, "ab" * 500), (41, "ab" * 90), (42, long), (43, "é" + long[:9000] + "x" + long[9000:]), (44, "x" * 99), (45, "x" * 99), (46, "x" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(repeats, "SLICE_BYTES", 1000)
    monkeypatch.setattr(repeats, "BATCH", 64)
    assert spark_repeats(df) == sorted(brute_repeats(rows), key=repr)


def test_repeats_of_hostile_documents(docs):
    once = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    assert spark_repeats(once) == sorted(brute_repeats([(r.doc_id, r.text) for r in once.collect()]), key=repr)
    assert len(spark_repeats(docs)) == docs.count()


def brute_lines(rows):
    seen, expected = set(), []
    for key, text in rows:
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if "".join(window).strip(" "):
                if window in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(window)
        expected.append((key, "\n".join(line for i, line in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return expected


def test_lines_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("ab ") for _ in range(rng.randrange(12)))) for i in range(60)]
    rows += [(100, "p\nq\nr\ns\nt"), (101, "q\nr\ns"), (102, "z\np\nq\nr\ns\nt\nz"), (103, "p\nq"), (104, "\n\n\n\n"), (105, "\n\n\n")]
    got = linededup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(brute_lines(rows))


def test_lines_of_hostile_documents(docs):
    got = linededup.drop_repeated_lines(docs)
    assert set(got.columns) == {*docs.columns, "n_lines"}
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[3].text is None and by_id[3].n_lines == 0
    assert by_id[4].text == "" and by_id[4].n_lines == 1
    assert by_id[9].text == "x\ny\nz" and by_id[9].n_removed == 6
    assert got.count() == docs.count()


@pytest.mark.parametrize("operator", [setjoin.jaccard_components, repeats.remove_repeats, linededup.drop_repeated_lines])
def test_no_documents(no_docs, operator):
    assert operator(no_docs).count() == 0




def test_a_run_gives_no_more_links_than_rows_and_families(spark):
    salt = np.uint64(0x9E3779B97F4A7C15)
    tokens = np.arange(1, 401, dtype=np.uint64)
    tokens = tokens[np.argsort(setjoin.mix(tokens ^ salt))]
    low, base, extra = tokens[:2], tokens[2:100], tokens[100:]
    # Neither of the first two is like the other; every other set is like both, and all have the same two minima.
    sets = [np.r_[low, base[15:]], np.r_[low, base[:-15]], *(np.r_[low, base, extra[i]] for i in range(20))]
    rows = spark.createDataFrame([(i, bytearray(np.sort(s).tobytes())) for i, s in enumerate(sets)], "doc_id long, tokens binary")
    links = [(r.a, r.b) for r in setjoin._neighbour_links(rows, 0).collect()]
    assert len(links) == 21
    reached = {0}
    for _ in sets:
        reached |= {i for pair in links if reached & set(pair) for i in pair}
    assert reached == set(range(len(sets)))
