"""Repeated passages of lines: overlapping windows of three lines, the later occurrences removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import digest

LINES = 3


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """Remove lines that a window of three consecutive lines, seen earlier, covers.

    Windows are compared over all documents; the earlier one is that of the smaller doc_id, or of the
    earlier line in the same document. Every line of a later window goes, so windows that overlap
    merge into one removed stretch. Windows of blank lines only do not count, and a document of fewer
    than three lines has no window. `text` is replaced, and `n_lines`, `n_removed` are added; other
    columns stay (columns of the added names are replaced). A null text stays null and has no lines.
    Rows with the same doc_id and text are one document in this count and get the same result; rows
    with the same doc_id and different texts are ordered by a digest of the text.

    All steps are column functions. Windows travel as digests; the first of each is found by a
    partially aggregated minimum, and a hot window is split by the skew join.
    """
    docs = docs.drop("n_lines", "n_removed")
    key = F.struct(F.col("doc_id").alias("_id"), digest("text").alias("_digest"))
    lines = F.split("text", "\n", -1)

    def window_digest(seed: int) -> F.Column:
        def at(i: F.Column) -> F.Column:
            three = [F.element_at("_lines", i + step) for step in range(LINES)]
            blank = F.length(F.trim(F.concat(*three))) == 0
            return F.when(~blank, F.xxhash64(F.lit(seed), *three))

        return F.transform(F.sequence(F.lit(1), F.size("_lines") - (LINES - 1)), at)

    split = docs.select(key.alias("_key"), lines.alias("_lines")).filter(F.size("_lines") >= LINES)
    both = F.arrays_zip(window_digest(1).alias("a"), window_digest(2).alias("b"))
    windows = split.select("_key", F.posexplode(both).alias("_at", "_window")).select("_key", "_at", "_window.*").dropna(subset=["a"])
    first = (
        windows.groupBy("a", "b")
        .agg(F.min(F.struct("_key", "_at")).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    later = windows.join(first, ["a", "b"]).filter(F.struct("_key", "_at") > F.col("_first"))
    starts = later.groupBy("_key").agg(F.collect_set("_at").alias("_starts"))
    marked = docs.withColumn("_key", key).join(starts, "_key", "left").withColumn("_lines", lines)
    covered = F.flatten(F.transform("_starts", lambda s: F.array(*(s + step for step in range(LINES)))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), covered)
    rest = F.array_join(F.transform(kept, lambda i: F.element_at("_lines", i + 1)), "\n")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines"))
    removed = F.when(F.col("_starts").isNull(), 0).otherwise(F.size("_lines") - F.size(kept))
    text = F.when(F.col("_starts").isNull(), F.col("text")).otherwise(rest)
    same = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return marked.select(*same, n_lines.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))


SQL = """
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, i, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] AS three
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM split)
),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY three ORDER BY doc_id, i) AS n
    FROM windows WHERE length(trim(replace(three, chr(10), ''))) > 0
  ) WHERE n > 1
),
covered AS (SELECT DISTINCT doc_id, i + step AS i FROM later, (VALUES (0), (1), (2)) steps(step)),
one AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM split),
rest AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS kept
  FROM one ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(r.text, '') END AS text,
       coalesce(len(s.lines), 0) AS n_lines, coalesce(len(s.lines) - coalesce(r.kept, 0), 0) AS n_removed
FROM documents d LEFT JOIN split s USING (doc_id) LEFT JOIN rest r USING (doc_id)
"""
