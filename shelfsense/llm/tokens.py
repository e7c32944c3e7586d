"""Token ids of whole texts by a public tokenizer file.

A tokenizer spends most of its time on words it has seen before. Where the rules of the file make
words independent of each other, a text is cut into words first, and a worker asks the tokenizer
only once for each distinct word. The ids are those of the whole text:

* "drop": white space is folded and dropped before the merges, so the text can be cut at any ASCII
  white space.
* "keep": a word takes the space before it, so the text can be cut before a space that a
  non-space follows; a run of spaces before it ends the earlier word either way.
* "whole": every other file; each text goes to the tokenizer as it is.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfsense.llm.common import worker_state

CACHED_WORDS = {"drop": 300_000, "keep": 700_000}  # per worker; 70 to 150 MB
LONGEST_CACHED = 40
# Python takes these four for white space, the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
WORD_START = re.compile(r" (?=\S)")
# Letters and the ASCII marks behind them are merged apart from each other; not so after an apostrophe,
# and not after U+0130, whose lower case ends with a combining mark.
MARKED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]+)")
# A line's end between such words is a unit of its own, and the word behind it has no space before it.
LINE_PART = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]*)")

# Byte-level files show the bytes that are printable in Latin-1 as themselves, the others from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = iter(range(256, 512))
BYTE_SHOWN = [chr(byte if byte in _PRINTABLE else next(_OTHERS)) for byte in range(256)]


def cutting_rule(path: str) -> str:
    """Which of the three rules the tokenizer file allows."""
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    if any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in settings["added_tokens"]):
        return "whole"
    before, normal = settings["pre_tokenizer"] or {}, settings["normalizer"] or {}
    if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not normal:
        return "keep"
    steps = [step["type"] for step in normal.get("normalizers", [])]
    splits = before.get("pretokenizers", [{}])
    pattern = str(splits[0].get("pattern", {}).get("Regex", ""))
    dropping = splits[0].get("behavior") == "Removed" and splits[0].get("invert") and r"[^\s\p{L}\p{N}]+" in pattern
    return "drop" if steps == ["NFC", "Replace", "Lowercase"] and dropping else "whole"


class _Words(dict):
    """Ids of words as bytes, asked from the tokenizer on first use; emptied when full."""

    def __init__(self, encode: Callable[[str], bytes], encode_letters: Callable[..., bytes], lead: str, limit: int):
        super().__init__()
        self.encode, self.encode_letters, self.lead, self.limit = encode, encode_letters, lead, limit
        self.marks: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if self.lead and (not word or word[0].isspace()):
            raise ValueError  # the space before this word belongs to a run of spaces
        if self.lead and "\n" in word and "\u0130" not in word:
            first, *rest = word.split("\n")
            parts = [LINE_PART.fullmatch(part) for part in rest]
            if LINE_PART.fullmatch(first) and all(parts):
                return self[first] + b"".join([self._after_line(part) for part in parts])  # the whole is rarely met again
        if word.isalpha() and (word.isascii() or max(word) < "\u0250" and "\u0130" not in word):
            ids = self.encode_letters(word) if self.lead or word.islower() else self[word.lower()]
        elif (marked := MARKED.fullmatch(word)) and "\u0130" not in word:
            letters, marks = marked.groups()
            ids = self[letters] + self._marks(marks)
        else:
            ids = self.encode(self.lead + word)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids

    def _marks(self, marks: str) -> bytes:
        if marks not in self.marks:
            self.marks[marks] = self.encode(marks)
        return self.marks[marks]

    def _after_line(self, part: re.Match) -> bytes:
        """Ids of a line's end and of the word behind it."""
        word = part[0]
        ids = self.starts.get(word)
        if ids is None:
            letters, marks = part.groups()
            plain = letters.isalpha() and max(letters) < "\u0250"
            ids = self._marks("\n") + (self.encode_letters(letters, "") if plain else self.encode(letters))
            if marks:
                ids += self._marks(marks)
            if len(word) <= LONGEST_CACHED:
                if len(self.starts) >= self.limit // 7:
                    self.starts.clear()
                self.starts[word] = ids
        return ids


def encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers."""
    from tokenizers import Tokenizer

    tokenizer, rule = Tokenizer.from_file(path), cutting_rule(path)

    def encode(text: str) -> bytes:
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_letters(word: str, before: str | None = None) -> bytes:
        """A word of letters is one unit of the merges; they see its bytes as printable characters."""
        shown = word if word.isascii() else "".join(map(BYTE_SHOWN.__getitem__, word.encode()))
        return array("I", [token.id for token in model.tokenize((space if before is None else before) + shown)]).tobytes()

    space, model = BYTE_SHOWN[32] if rule == "keep" else "", tokenizer.model
    words = _Words(encode, encode_letters, " " if rule == "keep" else "", CACHED_WORDS.get(rule, 0))

    def drop(text: str) -> bytes:
        return encode(text) if SEPARATORS.search(text) else b"".join(map(words.__getitem__, text.split()))

    def keep(text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            return encode(first) + b"".join(map(words.__getitem__, rest))
        except ValueError:
            first, *rest = WORD_START.split(text)
            return encode(first) + b"".join(map(words.__getitem__, rest))

    return {"drop": drop, "keep": keep, "whole": encode}[rule]


def worker_encoder(path: str) -> Callable[[str], bytes]:
    """The encoder of this worker, kept from task to task."""
    state = worker_state(path)
    if "encoder" not in state:
        state["encoder"] = encoder(path)
    return state["encoder"]


def tokenize(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Token ids of every document: (doc_id, ids binary).

    `ids` are little-endian unsigned 32-bit integers and end with `end_id`. A null text is empty.
    Repeated rows and ids stay as they are; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = worker_encoder(path), array("I", [end_id]).tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                ids = [encode(text) + end if text else end for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
