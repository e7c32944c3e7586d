"""What a service reads: index, ranks, products, vectors and factors, published together as one version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.operators.index import SharedWords, TextIndex, by_bucket, corpus_stats, counted_words
from shelfsense.operators.recommend import PackedVectors
from shelfsense.sources.store import Store, Version

BUCKETS = 64
#: Tables of an index: postings, or the words of shared texts, from which postings follow.
WORDS = ("texts", "own", "uses")
#: Tables of packed vectors.
PACKED = ("vector_docs", "vector_terms")
#: Tables that are stored as they are given.
PLAIN = ("ranks", "products", "titles", "vectors", "user_factors", "item_factors")


def publish(store: Store, index: TextIndex | None = None, buckets: int = BUCKETS, **tables: DataFrame | PackedVectors) -> Version:
    """Write the given parts and publish them in one new version; parts that are not given stay as they were.

    A reader sees the version before, or all of the new parts. `tables` are any of `PLAIN`. An index of shared texts
    is stored as the postings of its texts and the uses of these: a row for each term and document would be many times more.
    Vectors are rows by term or packed.
    """
    unknown = set(tables) - set(PLAIN)
    if unknown:
        raise ValueError(f"no such part: {', '.join(sorted(unknown))}")
    base = store.latest()
    written = {}
    if "vectors" in tables:
        written |= dict.fromkeys(("vectors", *PACKED), [])
        if isinstance(tables["vectors"], PackedVectors):
            vectors = tables.pop("vectors")
            tables |= dict(zip(PACKED, (vectors.docs, vectors.terms)))
    written |= {name: [store.write(df, name)] for name, df in tables.items()}
    facts = {}
    if index is not None:
        written |= dict.fromkeys(("postings", *WORDS), [])
        if index.shared is None:
            postings = index.postings.select("term", index.id_col, "tf")
            written["postings"] = [store.write(by_bucket(postings, index.id_col, buckets), "postings", ["bucket"])]
        else:
            shared, kinds = index.shared, {}
            for name, key in (("texts", shared.text_id), ("own", shared.id_col), ("uses", None)):
                rows = getattr(shared, name) if key is None else by_bucket(counted_words(getattr(shared, name), key), key, buckets)
                written[name] = [store.write(rows, name, ["bucket"] if key else [])]
                kinds[name] = ", ".join(f"`{column}` {kind}" for column, kind in rows.dtypes)
            facts["shared"] = {"text_id": shared.text_id, "kinds": kinds}
        written["doc_stats"] = [store.write(index.doc_stats, "doc_stats")]
        stats = corpus_stats(store.scan(written["doc_stats"])).first()
        facts["corpus"] = {"n_docs": stats["n_docs"], "avg_doc_len": stats["avg_doc_len"], "buckets": buckets, "id_col": index.id_col}
    return store.publish(base, written, facts)


class Snapshot:
    """One published version, the newest by default. Later versions do not change what it reads."""

    def __init__(self, store: Store, version: Version | None = None):
        self.store, self.version = store, version or store.latest()

    def table(self, name: str) -> DataFrame:
        if name not in self.version.tables:
            raise LookupError(f"version {self.version.number} has no {name}")
        return self.store.read(self.version, name)

    def vectors(self) -> DataFrame | PackedVectors:
        """The vectors in the form in which they were published."""
        return PackedVectors(*map(self.table, PACKED)) if PACKED[0] in self.version.tables else self.table("vectors")

    def index(self) -> TextIndex:
        doc_stats = self.table("doc_stats")
        facts = self.version.facts["corpus"]
        stats = self.store.spark.createDataFrame([tuple(facts.values())], "n_docs long, avg_doc_len double, buckets int, id_col string")
        if "postings" in self.version.tables:
            return TextIndex(self.table("postings"), doc_stats, stats, facts["id_col"])
        words = self.version.facts["shared"]
        tables = (self.store.scan(self.version.tables[name], words["kinds"][name]) for name in WORDS)
        shared = SharedWords(*tables, facts["id_col"], words["text_id"])
        return TextIndex(shared.postings(), doc_stats, stats, facts["id_col"], shared)
