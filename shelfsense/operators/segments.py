"""An index that is kept up to date by appending immutable segments.

A segment holds the postings and lengths of some documents. Adding documents writes a segment of
these alone; no text and no postings of earlier ones are read. A document that is added again, or
removed, gets a mark in the segment that held it, and marked documents are left out when the index is
read. Segments of about the same size are merged once there are `fanout` of them, so that an index of
n documents has a number of segments that grows with log n, and a posting is rewritten as often.

Where documents share texts, a segment holds the words of the texts once, and which document uses which text;
postings follow when the index is read. Texts are named anew, so those of merged segments stay apart.

The numbers of documents and their total length are kept for every segment, and summed when the index
is read. Document frequencies are counted then, over live postings of query terms only.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.operators.index import SharedWords, TextIndex, by_bucket, counted_words
from shelfsense.sources.store import Store, Version

KIND = "index"
TEXT = "shared_text"
TABLES = ("postings", "doc_stats", "texts", "uses")


class SegmentedIndex:
    """An index in a versioned store. Document ids are strings.

    `buckets` is the number of term buckets of the postings of a segment: a search reads only the
    buckets of its terms.
    """

    def __init__(self, store: Store, id_col: str = "product_id", buckets: int = 16, fanout: int = 4):
        self.store, self.id_col, self.buckets, self.fanout = store, id_col, buckets, fanout

    @staticmethod
    def segments(version: Version) -> list[dict]:
        """Number, size and marks of each segment, oldest first."""
        return version.facts.get(KIND, {}).get("segments", [])

    def append(self, added: TextIndex) -> Version:
        """Add the documents of an index as a new segment; those that are in the index already are replaced.

        An empty table changes nothing but the version.
        """
        base = self.store.latest()
        number = base.facts.get(KIND, {}).get("next", 0)
        own_id, shared = F.col(added.id_col).cast("string").alias(self.id_col), added.shared
        postings, count, kept = added.postings, "tf", None
        if shared is not None:
            # Words that documents have besides their texts are postings as they are.
            postings, count = counted_words(shared.own, shared.id_col), "n"
            text = F.concat_ws(":", F.lit(number), F.col(shared.text_id).cast("string")).alias(TEXT)
            known = F.col(shared.text_id).isNotNull()
            kept = SharedWords(
                counted_words(shared.texts, shared.text_id).filter(known).select(text, "term", "n"), shared.own,
                shared.uses.filter(known).select(own_id, text, "uses"), self.id_col, TEXT,
            )
        fresh = TextIndex(
            postings.select("term", own_id, F.col(count).cast("long").alias("tf")),
            added.doc_stats.select(own_id, F.col("doc_len").cast("long").alias("doc_len")),
            added.corpus_stats, self.id_col, kept,
        )
        tables, segment = self._write(fresh, number)
        ids = self.store.scan(tables[f"doc_stats-{number}"], self._schema("doc_stats")).select(self.id_col)
        marks, segments = self._mark(base, ids)
        version = self.store.publish(base, tables | marks, {KIND: {"next": number + 1, "segments": [*segments, segment]}})
        return self._merge_levels(version)

    def remove(self, ids: DataFrame) -> Version:
        """Remove documents by their ids, given in the id column; unknown ids change nothing."""
        base = self.store.latest()
        marks, segments = self._mark(base, ids.select(F.col(self.id_col).cast("string").alias(self.id_col)))
        return self.store.publish(base, marks, {KIND: {"next": base.facts.get(KIND, {}).get("next", 0), "segments": segments}})

    def read(self, version: Version | None = None) -> TextIndex:
        """The index of a version, the newest by default, for any search over a `TextIndex`."""
        version = version or self.store.latest()
        segments = self.segments(version)
        if not segments:
            raise LookupError("no documents were added yet")
        live = sum(s["documents"] - s["marked"] for s in segments)
        total = sum(s["length"] - s["marked_length"] for s in segments)
        spark = self.store.spark
        row = [(live, total / live if live else None, self.buckets, self.id_col)]
        stats = spark.createDataFrame(row, "n_docs long, avg_doc_len double, buckets int, id_col string")
        postings = self._live(version, "postings", segments).select("bucket", "term", self.id_col, "tf")
        shared = self._shared(version, segments)
        if shared is not None:
            postings = shared.postings()
        return TextIndex(postings, self._live(version, "doc_stats", segments).select(self.id_col, "doc_len"), stats, self.id_col, shared)

    def _schema(self, kind: str) -> str:
        if kind == "postings":
            return f"term string, {self.id_col} string, tf long, segment int, bucket int"
        if kind == "texts":
            return f"term string, {TEXT} string, n long, segment int, bucket int"
        if kind == "uses":
            return f"{self.id_col} string, {TEXT} string, uses long, segment int"
        return f"{self.id_col} string, doc_len long, segment int"

    # Writing

    def _write(self, rows: TextIndex, number: int) -> tuple[dict[str, list[str]], dict]:
        """Store a segment: its tables, and what the manifest says of it."""
        segment = F.lit(number).alias("segment")
        dealt = by_bucket(rows.postings.select("term", self.id_col, "tf", segment), self.id_col, self.buckets)
        stats = rows.doc_stats.select(self.id_col, "doc_len", segment)
        folders = {
            f"postings-{number}": [self.store.write(dealt, "postings", ["bucket"])],
            f"doc_stats-{number}": [self.store.write(stats, "doc_stats")],
        }
        if rows.shared is not None:
            texts = by_bucket(rows.shared.texts.select("term", TEXT, "n", segment), TEXT, self.buckets)
            folders[f"texts-{number}"] = [self.store.write(texts, "texts", ["bucket"])]
            folders[f"uses-{number}"] = [self.store.write(rows.shared.uses.select(self.id_col, TEXT, "uses", segment), "uses")]
        size = self.store.scan(folders[f"doc_stats-{number}"], self._schema("doc_stats")).agg(F.count("*").alias("n"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("total")).first()
        return folders, {"number": number, "documents": size["n"], "length": size["total"], "marked": 0, "marked_length": 0}

    def _mark(self, base: Version, ids: DataFrame) -> tuple[dict[str, list[str]], list[dict]]:
        """Marks for live documents with these ids, and the segments with their new numbers of marks."""
        segments = self.segments(base)
        if not segments:
            return {}, segments
        hit = self._live(base, "doc_stats", segments).join(ids.distinct(), self.id_col, "left_semi").select("segment", self.id_col, "doc_len")
        folder = self.store.write(hit, "marks")
        sums = self.store.scan([folder]).groupBy("segment").agg(F.count("*").alias("n"), F.sum("doc_len").alias("total")).collect()
        if not sums:
            return {}, segments
        found = {row["segment"]: row for row in sums}  # a row for each segment
        updated = [
            s | {"marked": s["marked"] + found[s["number"]]["n"], "marked_length": s["marked_length"] + found[s["number"]]["total"]} if s["number"] in found else s
            for s in segments
        ]
        return {"marks": [*base.tables.get("marks", []), folder]}, updated

    def _live(self, version: Version, kind: str, segments: list[dict]) -> DataFrame:
        """Rows of some segments without marked documents."""
        folders = [folder for s in segments for folder in version.tables.get(f"{kind}-{s['number']}", [])]
        rows = self.store.scan(folders, self._schema(kind))
        if kind == "texts" or "marks" not in version.tables or not any(s["marked"] for s in segments):
            return rows
        marks = self.store.read(version, "marks").filter(F.col("segment").isin([s["number"] for s in segments]))
        return rows.join(marks.select("segment", self.id_col), ["segment", self.id_col], "left_anti")

    def _shared(self, version: Version, segments: list[dict]) -> SharedWords | None:
        """Words of shared texts of some segments, their uses by live documents and other words of these, if any texts are shared."""
        if not any(f"texts-{s['number']}" in version.tables for s in segments):
            return None
        texts = self._live(version, "texts", segments).select(TEXT, "term", "n", "bucket")
        own = self._live(version, "postings", segments).select("bucket", "term", self.id_col, F.col("tf").alias("n"))
        uses = self._live(version, "uses", segments).select(self.id_col, TEXT, "uses")
        return SharedWords(texts, own, uses, self.id_col, TEXT)

    def level(self, segment: dict) -> int:
        """Segments of one level differ in their number of live documents by less than `fanout` times."""
        return int(math.log(max(segment["documents"] - segment["marked"], 1), self.fanout) + 1e-9)

    def _merge_levels(self, version: Version) -> Version:
        """Merge every level that has `fanout` segments, the smallest first, until none has."""
        while True:
            levels: dict[int, list[dict]] = {}
            for segment in self.segments(version):
                levels.setdefault(self.level(segment), []).append(segment)
            full = [level for level, own in levels.items() if len(own) >= self.fanout]
            if not full:
                return version
            version = self._merge(version, levels[min(full)])

    def _merge(self, base: Version, merged: list[dict]) -> Version:
        """One segment instead of several: their live rows as they are, so no text is read again."""
        number = base.facts[KIND]["next"]
        shared = self._shared(base, merged)
        if shared is not None:
            # Texts whose documents all went are dropped.
            shared = replace(shared, texts=shared.texts.join(shared.uses.select(TEXT).distinct(), TEXT, "left_semi"))
        rows = TextIndex(self._live(base, "postings", merged), self._live(base, "doc_stats", merged), None, self.id_col, shared)
        tables, segment = self._write(rows, number)
        gone = {s["number"] for s in merged}
        rest = [s for s in self.segments(base) if s["number"] not in gone]
        dropped = {f"{kind}-{n}": [] for n in gone for kind in TABLES}
        if not any(s["marked"] for s in rest):
            dropped["marks"] = []
        return self.store.publish(base, tables | dropped, {KIND: {"next": number + 1, "segments": [*rest, segment]}})
