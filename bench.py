"""Time the offline builds and every search method; prints one JSON line.

The builds write their tables like a production run; the searches read them.  A
search is timed from making its plan to its last row, after one untimed round
that warms the JVM, as the median of BENCH_ROUNDS rounds.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gleanery.queries import REGISTRY  # noqa: E402
from gleanery.plans.workbench import Workbench  # noqa: E402
from gleanery.session import local_session  # noqa: E402

HEADLINE = [
    "clean_text",
    "tfidf_search",
    "tfidf_zero_fill",
    "embedding_search",
    "embedding_search_encoded",
    "hybrid_search",
    "chunk_search",
    "chunk_search_low_threshold",
    "chunk_search_in_candidates",
    "prompt_text",
    "prompt_from_hybrid",
    "document_requests",
    "dispatch",
]


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"), memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    bench = Workbench.of(spark, folder)
    spark.range(1_000_000).selectExpr("sum(id)").collect()

    def run(name):
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {
        "build_sparse": timed(lambda: bench.sparse),
        "build_snippets": timed(lambda: bench.snippets),
        "build_embeddings": timed(lambda: bench.embeddings),
        "build_chunks": timed(lambda: bench.chunks),
    }
    for name in HEADLINE:
        run(name)
        seconds[name] = statistics.median(timed(lambda: run(name)) for _ in range(rounds))
    print(
        json.dumps(
            {
                "metric": "retrieval_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cores": spark.sparkContext.defaultParallelism,
                "spark": spark.version,
                "n_queries": bench.queries.count(),
                "n_documents": bench.docs.count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
