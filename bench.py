"""Benchmark of the headline operators.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. Each query is forced to completion with the
``noop`` sink (full evaluation, nothing collected) or written. Before
timing, one small ingest, index-and-search and keyphrase run on the
smallest test tables ($BENCH_WARM_DIR, default sf0.001) warm the JVM.

  ingest        batch load of the cleaned Q&A input (P9, P12, W2, S8)
  stream_ingest the same input as CSV files through micro-batches (ST1)
  index_build   articles -> summaries -> chunk index + search index, written (T9, chunk 500)
  search_one    one query (a stored summary line, so it has hits) end to end
                against the stored search index (T5)
  search_batch  every benchmark item at once against the stored search index (T5)
  topic_counts  rows per topic (A2) ; gaps (W3) ; keyword index (A9)
  keyphrases    corpus keyphrases of every article (T7)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topicspark.operators import audit as A  # noqa: E402
from topicspark.operators.keywords import keyphrases, keyword_index  # noqa: E402
from topicspark.operators.search import search_index, smart_query, write_search_index  # noqa: E402
from topicspark.plans.index import plan_index  # noqa: E402
from topicspark.plans.ingest import ingest  # noqa: E402
from topicspark.plans.q_ingest import _input  # noqa: E402
from topicspark.session import build_session, scratch_path  # noqa: E402
from topicspark.sources import csv_io, store  # noqa: E402
from topicspark.sources import fixtures as fx  # noqa: E402
from topicspark.streaming import ingest as stream  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", int(cpus) * 2)))
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)

    # Warm-up on the smallest test tables (not the measured data): JVM start,
    # code generation and first file listings are not part of any query.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        ingest(_input(spark, warm), scratch_path(spark, "bench-warm"), fx.AS_OF, ["conv_id", "turn"])
        warm_arts = fx.articles(spark, warm)
        run(smart_query(fx.queries(spark, warm), plan_index(warm_arts, 10, fx.AS_OF), warm_arts))
        run(keyphrases(warm_arts, ["topic", "id"], "answer", 5))
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(1).collect()

    art_path = scratch_path(spark, "bench-articles")
    idx_path = scratch_path(spark, "bench-index")

    def ingest_once():
        ingest(_input(spark, sf_dir), scratch_path(spark, "bench-load"), fx.AS_OF, ["conv_id", "turn"])
    timed("ingest", ingest_once)

    def stream_ingest():
        base = scratch_path(spark, "bench-stream")
        folder, table, ckpt = stream.stream_paths(base)
        csv_io.write_input_csv(_input(spark, sf_dir).repartition(4, "topic"), folder)
        stream.run_ingest_stream(spark, folder, table, ckpt, fx.AS_OF, files_per_batch=2)
    timed("stream_ingest", stream_ingest)

    store.append_articles(fx.articles(spark, sf_dir), art_path, mode="overwrite")
    articles = store.read_articles(spark, art_path)

    terms_path, lines_path = idx_path + "-terms", idx_path + "-lines"

    def index_build():
        store.write_chunk_index(plan_index(articles, 500, fx.AS_OF), idx_path)
        write_search_index(spark.read.parquet(idx_path), terms_path, lines_path)
    timed("index_build", index_build)

    q_all = fx.queries(spark, sf_dir)
    # One query that finds articles: the first stored summary line.
    q_one = (spark.read.parquet(lines_path).orderBy("topic", "chunk_start", "line_no").limit(1)
                  .selectExpr("1L AS qid", "row_text AS query"))
    timed("search_one", lambda: run(search_index(q_one, terms_path, lines_path, articles)))
    timed("search_batch", lambda: run(search_index(q_all, terms_path, lines_path, articles)))
    timed("topic_counts", lambda: run(A.rows_per_topic(articles)))
    small_ci = spark.read.parquet(idx_path)
    timed("gap_check", lambda: run(A.chunk_gaps(small_ci)))
    timed("keyword_index", lambda: run(keyword_index(fx.keyword_rows(spark, sf_dir), 500)))
    timed("keyphrases", lambda: run(keyphrases(articles, ["topic", "id"], "answer", 5)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
