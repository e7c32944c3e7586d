"""Passages: folding, short items, q-grams met very often, and banded alignment against a plain one."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfsense.llm import decontam


def found(texts, items, share=decontam.EDIT_SHARE):
    """{(text, item): (edits, end in the source bytes)} of one task."""
    folded = decontam.Folded(pa.array(texts, pa.string()))
    best = {}
    for t, i, edits, end in decontam.passages_of(folded, decontam.Items([item.encode() for item in items], share)):
        here = (edits, folded.source_end(t, end))
        best[t, i] = min(best.get((t, i), here), here)
    return best


def plain_alignment(item, region):
    """Fewest edits between the item and any stretch of the region."""
    row = [0] * (len(region) + 1)
    for x in item:
        last, row[0] = row[0], row[0] + 1
        for j, y in enumerate(region):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return min(row)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abc", max_size=12), st.text("abc", max_size=14)), min_size=1, max_size=5))
def test_alignment_of_many(pairs):
    items, regions = ([np.frombuffer(text.encode(), np.uint8) for text in side] for side in zip(*pairs))
    lows = np.full(len(pairs), -14)
    edits, ends = decontam.align(list(items), list(regions), lows, 32)
    assert edits.tolist() == [plain_alignment(item, region) for item, region in pairs]
    assert all(0 <= end <= len(region) for end, region in zip(ends.tolist(), regions))


def test_white_space_folds_with_offsets():
    item = "The quick  brown\n\tfox jumps over the lazy dog again"
    texts = ["", None, "   x  \n the QUICK brown fox    jumps over\r\nthe lazy dog again  !", "nothing   at all"]
    end = len(texts[2]) - len("  !")
    assert found(texts, [item, "  \n ", item.upper()]) == {(2, 0): (0, end), (2, 2): (0, end)}


def test_long_blank_and_dash_runs_stay_bounded():
    rng = random.Random(3)
    words = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(30))
    items = [f"    {words()}\n{' ' * 60}{words()} {'-' * 40} {words()}" for _ in range(400)]
    texts = [" " * 20_000 + "end", "-" * 20_000, f"{'-' * 500} {items[7]} {'-' * 500}"]
    tracemalloc.start()
    hits = found(texts, items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {key: edits for key, (edits, _) in hits.items()} == {(2, 7): 0}
    assert peak < 300 << 20


def test_items_of_one_frequent_gram_are_found():
    assert set(found(["x" + "-" * 50, "-" * 39, "- " * 30], ["-" * 40, "- " * 20 + "-"])) == {(0, 0), (1, 0), (2, 1)}


def test_edits_with_frequent_grams():
    """Copies of one item in a block make all its q-grams frequent; the bound still finds it with all edits allowed."""
    rng = random.Random(5)
    item = "".join(rng.choices("abcdefghij ", k=150)).strip().replace("  ", " x")
    items = [f"{item} {i}" for i in range(60)]
    passage = list(item)
    for at in range(7, len(passage) - 2, 13):
        passage[at] = "Z"
    edits = sum(letter == "Z" for letter in passage)
    assert edits <= decontam.budget(len(item), decontam.EDIT_SHARE)
    hits = found(["other words " * 9 + "".join(passage) + " 17 and more"], items)
    assert hits[0, 17][0] == plain_alignment(items[17], "".join(passage).lower() + " 17 and more")


@pytest.mark.parametrize("item", ["a", "hello", "1234567", "12345678", "twelve bytes", "exactly twenty-3 bytes!", "é b", "(x)"])
def test_short_items_between_word_borders(item):
    size = len(item.encode())
    assert size < decontam.SHORT_BYTES
    texts = [item, f"so {item.encode().upper().decode()}.", f"({item}) {item}", f"q{item}", f"{item}q", None, "", f"q{item}q {item}"]
    whole = {0: size, 1: 3 + size, 2: 1 + size, 7: 3 + 2 * size}
    if item == "(x)":  # its ends are no word bytes
        whole |= {3: 1 + size, 4: size, 7: 1 + size}
    if item.endswith("!"):
        whole |= {4: size}
    hits = found(texts, [item, item + "zz"])
    assert {t: end for (t, i), (edits, end) in hits.items() if i == 0 and edits == 0} == whole


def test_short_items_of_a_table(spark):
    items = [(1, "hello"), (2, "twelve bytes"), (3, "a passage of 23 bytes !"), (4, ""), (5, "hello"), (None, "hello")]
    rows = [(1, "Say  HELLO, twice: hello"), (2, "othello"), (3, "twelve  \n bytes"), (4, "a passage of 23 bytes !"), (5, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(*row, 0) for row in rows], "doc_id long, text string, edits int")
    got = {(r.doc_id, r.item_id): (r.edits, r.ends_at) for r in decontam.find_passages(docs, benchmark).collect()}
    assert got == {(1, 1): (0, 10), (1, 5): (0, 10), (1, None): (0, 10), (3, 2): (0, 15), (4, 3): (0, 23)}
    assert {r.doc_id for r in decontam.drop_contaminated(docs, benchmark).collect()} == {2, 5}


def test_a_text_of_many_pieces(monkeypatch):
    monkeypatch.setattr(decontam, "PIECE", 50)
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(200))
    items = [text[300:420], text[47:53] + " ", text[700:790]]
    assert {key for key, (edits, _) in found([text, text[350:]], items).items() if edits == 0 and key[1] != 1} == {(0, 0), (0, 2), (1, 2)}
