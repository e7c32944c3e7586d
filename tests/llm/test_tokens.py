import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfsense.llm import huffman, packing, tokens
from shelfsense.llm.common import new_path

WORD, BYTE = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ENCODERS = {path: (Tokenizer.from_file(path), tokens.encoder(path)) for path in (WORD, BYTE)}


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é'ßÑ.,!1 \n\t　\x1ćΣİ日<|endoft>$_"), max_size=60))
def test_ids_are_those_of_the_whole_text(path, text):
    library, own = ENCODERS[path]
    expected = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert own(text) == expected


def test_cutting_rules():
    assert tokens.cutting_rule(WORD) == "drop"
    assert tokens.cutting_rule(BYTE) == "keep"


def expected_ids(rows, path, end_id):
    library = ENCODERS[path][0]
    return [(i, np.array([*library.encode(t or "", add_special_tokens=False).ids, end_id], "<u4")) for i, t in rows]


@given(st.lists(st.integers(1, 2048), min_size=1, max_size=80))
@settings(max_examples=60, deadline=None)
def test_windows_hold_all_pieces_within_capacity(lengths):
    windows = packing.pack_lengths(np.array(lengths), 2048)
    sums = np.bincount(windows, lengths)
    assert sums.max() <= 2048 and (np.bincount(windows) > 0).all()


def test_differencing_balances():
    lengths = np.random.default_rng(0).integers(1, 700, 600)
    _, largest = packing.difference(lengths, 100)
    assert largest <= 1.01 * lengths.sum() / 100


def test_packing_tiles_every_document(spark, docs):
    rows = packing.pack_documents(docs, WORD, 1, 64).toPandas()
    expected = {}
    for doc_id, ids in expected_ids([(r.doc_id, r.text) for r in docs.collect()], WORD, 1):
        expected.setdefault(doc_id, []).append(ids)
    for doc_id, group in rows.groupby("doc_id", dropna=False):
        copies = expected[None if doc_id != doc_id else doc_id]
        assert group["length"].sum() == sum(map(len, copies))
        for piece in group.itertuples():
            part = copies[0][piece.start : piece.start + piece.length]
            assert piece.ids_crc32 == zlib.crc32(part.tobytes()) and piece.doc_tokens == len(copies[0])
    for _, group in rows.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert (group["offset"] == group["length"].cumsum() - group["length"]).all() and group["length"].sum() <= 64


def test_hot_ids_and_repeats_make_no_large_batch(spark):
    rows = [(None, 0, 100 + i % 50, i, 200) for i in range(1500)] + [(None, 0, 100, -1, 100)] * 1500 + [(i, 0, 90, i, 90) for i in range(1000)]
    pieces = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    packed = packing.pack(pieces, 2048, 200).toPandas()
    assert (packed["sequence_id"] // (1 << 32)).value_counts().max() < 600

    def key(r):
        return (-1 if r[0] is None or r[0] != r[0] else int(r[0]), *map(int, r[1:]))

    assert sorted(map(key, packed[pieces.columns].itertuples(index=False))) == sorted(map(key, rows))
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack_documents(docs, WORD, 1).toPandas()
    assert rows["length"].sum() > 0.97 * 2048 * rows["sequence_id"].nunique()


def test_code_is_complete_and_bounded():
    counts = (1e6 / np.arange(1, 3000) ** 1.5).astype(int) + 1
    lengths = huffman.code_lengths(counts, 13)
    assert lengths.max() <= 13 and (2.0**-lengths).sum() == 1
    coder = huffman.Coder(np.arange(0, 2 * len(counts), 2), lengths)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.random.default_rng(n).choice(coder.symbols, n)
        payload, checkpoints = coder.encode(ids)
        assert (coder.decode(payload, checkpoints, n) == ids).all()


def test_code_of_few_symbols():
    for counts in ([], [5], [1, 1], [9, 1, 1]):
        coder = huffman.Coder(np.arange(len(counts)), huffman.code_lengths(np.array(counts)))
        ids = np.arange(len(counts)).repeat(3)
        assert (coder.decode(*coder.encode(ids), len(ids)) == ids).all()


@pytest.mark.parametrize("parts", [1, 5])
def test_token_files_round_trip(spark, docs, parts):
    path = new_path(spark)
    huffman.write_tokens(docs, path, BYTE, 2, parts)
    got = [(r.start, r.doc_id, bytes(r.ids)) for r in huffman.read_tokens(spark, path).collect()]
    rows = expected_ids([(r.doc_id, r.text) for r in docs.collect()], BYTE, 2)
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].astype("<u2").tobytes()))
    start, expected = 0, []
    for doc_id, ids in rows:
        expected.append((start, doc_id, ids.tobytes()))
        start += len(ids)
    assert sorted(got) == expected


def test_token_files_of_split_parts(spark):
    texts = [" ".join(f"{i * 7919 % 10007} {j * i % 9973}" for j in range(40)) for i in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    settings_of_files = {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "1k"}
    old = {key: spark.conf.get(key) for key in settings_of_files}
    hadoop.set("parquet.block.size", "32768")
    try:
        for key, value in settings_of_files.items():
            spark.conf.set(key, value)
        path = new_path(spark)
        huffman.write_tokens(docs, path, BYTE, 2, 2)
        got = [(r.start, r.doc_id, bytes(r.ids)) for r in huffman.read_tokens(spark, path).collect()]
        blocks = spark.read.parquet(f"{path}/blocks")
        assert blocks.count() == blocks.select("part", "block").distinct().count() > 2
    finally:
        hadoop.unset("parquet.block.size")
        for key, value in old.items():
            spark.conf.set(key, value)
    start, expected = 0, []
    for doc_id, ids in expected_ids(enumerate(texts), BYTE, 2):
        expected.append((start, doc_id, ids.tobytes()))
        start += len(ids)
    assert sorted(got) == expected


def test_no_documents(spark, no_docs):
    assert packing.pack_documents(no_docs, WORD, 1).count() == 0
    path = new_path(spark)
    huffman.write_tokens(no_docs, path, BYTE, 2)
    assert huffman.read_tokens(spark, path).agg(F.count("*")).first()[0] == 0


def test_words_around_a_line_end_are_looked_up_apart():
    library = Tokenizer.from_file(BYTE)
    encode = tokens.encoder(BYTE)
    words = next(cell.cell_contents for cell in encode.__closure__ if isinstance(cell.cell_contents, dict))
    ends = ["ab.\nCd", "ab\nCd,", "été.\nÜber!", "a\nb\nc.", "x,.\nİy", "a.\n\nb", "a\n1", "x²\ny²", "a'\ns", "a\n's", "Ⅷ.\nⅧ", "a\r\nb", "ab<|\nendoftext|>", "ab\n", "漢字.\n漢字"]
    text = "first " + " ".join(ends) + " last"
    assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    for end in ends:
        assert np.frombuffer(encode("a " + end), "<u4").tolist() == library.encode("a " + end, add_special_tokens=False).ids
    assert "ab.\nCd" not in words and "ab." in words  # pairs of words are too many to be kept
