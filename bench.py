"""Benchmark of the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES a comma-separated
choice of queries. Besides the registered ones there are `build_index`, which stores the whole product
index, and `search_stored` and `batch_stored`, which search it. Times are seconds of one run each.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfsense.operators import index, search  # noqa: E402
from shelfsense.plans import latent, serving  # noqa: E402
from shelfsense.plans import queries as plain  # noqa: E402
from shelfsense.plans.queries import _benchmark_queries, _queries  # noqa: E402
from shelfsense.session import build_session, checkpoint_dir  # noqa: E402
from shelfsense.sources.tables import reviews_by_text, texts  # noqa: E402

QUERIES = plain.QUERIES | serving.QUERIES | latent.QUERIES
HEADLINE = (
    "reviews_profile", "tokenize", "top_bigrams", "tfidf_features", "preprocess_compare", "category_counts",
    "bm25_search", "review_level_bm25", "graph_stats", "pagerank",
    "fused_search", "pseudo_relevance", "content_recs", "user_item_mean", "page_dedup", "crawl_pages",
    "hits", "bm25_batch", "svd_recs", "known_lemmas",
    "build_index", "search_stored", "batch_stored", "cosine_search", "fielded_search", "als_checks", "page_near_duplicates",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__ui__enabled="false",
        spark__driver__memory="16g", spark__shelfsense__scan__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = f"{checkpoint_dir(spark)}/bench-index-{os.getpid()}"

    def build_index(spark, folder):
        index.write_index(index.build_index_of_shared_texts(reviews_by_text(spark, folder), texts(spark, folder)), path, 8)
        return index.read_index(spark, path).corpus_stats

    def search_stored(spark, folder):
        return search.bm25_search(index.read_index(spark, path), _queries(spark))

    def batch_stored(spark, folder):
        return search.bm25_search(index.read_index(spark, path), _benchmark_queries(spark, folder), top_k=10)

    own = {"build_index": build_index, "search_stored": search_stored, "batch_stored": batch_stored}
    seconds: dict[str, float] = {}
    QUERIES["category_counts"](spark, folder).collect()  # start-up of the session is not measured
    for name in names:
        start = time.perf_counter()
        (own.get(name) or QUERIES[name])(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
