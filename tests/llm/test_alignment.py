"""Alignment of two tokenizers against whole texts read token by token."""

import hashlib

import numpy as np
import pytest
from conftest import table
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from shelfsense.llm import alignment
from shelfsense.llm.tokens import BYTE_SHOWN

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  two  spaces ", "a\n\n  b\tc \n", "<|endoftext|> x<|endoftext|>", "<s> </s><unk> <0x0A>", "under▁line", "日本 語　テスト", "café café",
       "x" * 5000, "w " * 3000, "🙂🙂 \u0085 \x1c y", "don't we'll 12345 a.b,c", "﻿bom", "a b   c", "tail \n"]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    shown = {c: i for i, c in enumerate(BYTE_SHOWN)}
    return a, sentencepiece.SentencePieceProcessor(model_file=B), shown


def plain(text, tokenizers):
    """(ids of A, ids of B, groups, links) of a whole text, with two pointers."""
    a, b, shown = tokenizers
    if not text:
        return [], [], [], []
    encoded = a.encode(" " + text, add_special_tokens=False)
    bytes_a = [bytes(shown[c] for c in entry) for entry in encoded.tokens]
    ids_b = b.encode(text)
    pieces = [(b.id_to_piece(i), b.is_byte(i)) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], [], [], []
    groups, links, i, j, end_a, end_b, one, two = [], [], 0, 0, len(bytes_a[0]), len(bytes_b[0]), [encoded.ids[0]], [ids_b[0]]
    while True:
        links.append((encoded.ids[i], ids_b[j]))
        if end_a == end_b:
            groups.append((one, two))
            one, two = [], []
        forward_a, forward_b = end_a <= end_b, end_b <= end_a
        if forward_a:
            i += 1
        if forward_b:
            j += 1
        if i == len(bytes_a) or j == len(bytes_b):
            return encoded.ids, ids_b, groups, links
        if forward_a:
            end_a += len(bytes_a[i])
            one.append(encoded.ids[i])
        if forward_b:
            end_b += len(bytes_b[j])
            two.append(ids_b[j])


def brute(rows, tokenizers):
    read = [plain(text, tokenizers) for _, text in rows]
    counts, highest = {}, {}
    for *_, links in read:
        for link in links:
            counts[link] = counts.get(link, 0) + 1
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for (doc_id, _), (a, b, groups, links) in zip(rows, read):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[k] == highest[k[1]] for k in links), sum(counts[k] for k in links), digest))
    return sorted(out, key=repr)


def got(df, **limits):
    return sorted((tuple(r) for r in alignment.align(df, A, B, **limits).collect()), key=repr)


def test_odd_texts(spark, docs, no_docs, tokenizers):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(None, "no id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_a int")
    expected = brute(rows, tokenizers)
    assert got(df) == expected
    assert got(df, slice_bytes=1000) == expected  # many slices of the table
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()], tokenizers)
    assert got(no_docs) == []


def test_a_small_memory_of_words(spark, monkeypatch, tokenizers):
    monkeypatch.setattr(alignment, "CACHED_CHUNKS", 30)
    monkeypatch.setattr(alignment, "TEXTS", 3)
    rows = [(i, text) for i, text in enumerate(ODD * 3)]
    rows += [(100 + i, " ".join(f"w{(i * j) % 17} common words" for j in range(20))) for i in range(40)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, tokenizers)


def test_the_whole_table(spark, tokenizers):
    rows = list(table("sf0.001", "documents")[["doc_id", "text"]].itertuples(index=False, name=None))
    assert got(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) == brute(rows, tokenizers)


@given(st.text(alphabet=st.sampled_from(list("aeéB'.,<|>0 5\n\té▁ 日🙂")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_chunks_give_the_tokens_of_the_whole_text(tokenizers, text):
    aligner = _kept()
    aligner.clear(False)
    aligner.read(["some words before", None])
    (numbers,), _ = aligner.read([text])
    a, b, groups, links = plain(text, tokenizers)
    assert aligner.sizes[numbers].sum(0).tolist() == [len(a), len(b), len(groups), len(links)]
    pairs, begins = np.concatenate(aligner.pairs), np.cumsum(aligner.sizes[:, 3]) - aligner.sizes[:, 3]
    own = [p for n in numbers for p in pairs[begins[n] : begins[n] + aligner.sizes[n, 3]].tolist()]
    assert [divmod(p, aligner.n_b) for p in own] == links


_KEPT = []


def _kept():
    if not _KEPT:
        _KEPT.append(alignment.Aligner(A, B))
        assert _KEPT[0].cuttable
    return _KEPT[0]


@given(st.sets(st.integers(0, 2**63), max_size=3000))
@settings(max_examples=50, deadline=None)
def test_places_are_all_places(numbers):
    pairs = np.array(sorted(numbers), np.uint64)
    segment = alignment.segment_of(pairs)
    segments = np.unique(segment).tolist()
    built = [alignment.build_hash(pairs[segment == s]) for s in segments]
    table = alignment.PairTable(segments, [s for s, _ in built], [w for _, w in built])
    assert sorted(table.places(pairs).tolist()) == list(range(len(pairs)))
