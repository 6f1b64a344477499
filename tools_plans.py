"""Executed-plan shapes of the headline operators (writes docs/PLANS.md).

python tools_plans.py [sf_dir]
"""
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topicspark.operators import audit as A  # noqa: E402
from topicspark.operators.chunks import build_chunk_index  # noqa: E402
from topicspark.operators.keywords import keyphrases  # noqa: E402
from topicspark.operators.numbering import number_rows  # noqa: E402
from topicspark.operators.chunks import summary_lines  # noqa: E402
from topicspark.operators.search import index_hits, relevant_lines, search_index, top_hits, write_search_index  # noqa: E402
from topicspark.operators.summarize import summarize  # noqa: E402
from topicspark.plans.ingest import prepare_load  # noqa: E402
from topicspark.plans.q_ingest import _input  # noqa: E402
from topicspark.session import build_session  # noqa: E402
from topicspark.sources import fixtures as fx  # noqa: E402
from topicspark.sources import store  # noqa: E402


def shape(df):
    df.write.format("noop").mode("overwrite").save()
    p = df._jdf.queryExecution().executedPlan().toString()
    exch = len(re.findall(r"\bExchange (hash|range|Single|Round)", p)) + len(re.findall(r"\bExchange\b(?! )", p))
    scans = []
    for line in p.split("\n"):
        if "FileScan" in line:
            pf = re.search(r"PushedFilters: (\[[^\]]{0,90})", line)
            part = re.search(r"PartitionFilters: (\[[^\]]{0,90})", line)
            rs = re.search(r"ReadSchema: (struct<[^>]{0,90})", line)
            scans.append(f"{(part.group(1) + ']') if part else ''} {(pf.group(1) + ']') if pf else ''} "
                         f"{rs.group(1) + '>' if rs else ''}".strip())
    return {
        "shuffle exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", p)),
        "broadcast exchanges": p.count("BroadcastExchange"),
        "sort-merge joins": p.count("SortMergeJoin"),
        "broadcast hash joins": p.count("BroadcastHashJoin"),
        "window group limit": "WindowGroupLimit" in p,
        "scans": list(dict.fromkeys(scans)),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=16)
    base = tempfile.mkdtemp(prefix="plans-")
    store.append_articles(fx.articles(spark, sf), base + "/articles", mode="overwrite")
    arts = store.read_articles(spark, base + "/articles")
    ci = build_chunk_index(arts, summarize(arts, ["topic", "id"]), 500)
    store.write_chunk_index(ci, base + "/index")
    ci = spark.read.parquet(base + "/index")
    write_search_index(ci, base + "/terms", base + "/lines")
    q = fx.queries(spark, sf)
    cases = {
        "T6 summaries (degree)": summarize(arts, ["topic", "id"]),
        "W1/W2 number_rows per topic": number_rows(arts.select("topic", "id"), ["topic"], ["id"], "pos"),
        "T5 scoring + top-k, stored search index, one query": index_hits(
            q.orderBy("qid").limit(1), base + "/terms", base + "/lines"),
        "T5 article lookup of the hits (after the hits are checkpointed)": search_index(
            spark.read.parquet(base + "/lines").orderBy("topic", "chunk_start", "line_no").limit(1)
                 .selectExpr("1L AS qid", "row_text AS query"), base + "/terms", base + "/lines", arts),
        "T3 + L2 scoring + top-k from a chunk index (all queries)": top_hits(
            relevant_lines(q, summary_lines(ci)), 5),
        "S9 topic scan": store.scan_topic(spark, base + "/articles", "src3").select("id", "answer"),
        "T7 keyphrases": keyphrases(arts, ["topic", "id"], "answer"),
        "W3 gap check": A.chunk_gaps(ci),
        "ingest plan (P9, P12, W2)": prepare_load(_input(spark, sf), None, fx.AS_OF, ["conv_id", "turn"]).rows,
    }
    out = ["# Executed plan shapes", "",
           f"Generated by `python tools_plans.py {sf}` (local[8], 16 shuffle partitions, AQE on).",
           "Counts are taken from the final adaptive plan of each operator alone; the",
           "small eager jobs of the numbering (a checkpointed per-group table) are not",
           "part of these plans.", ""]
    for name, df in cases.items():
        s = shape(df)
        out.append(f"## {name}")
        out.append("")
        for k, v in s.items():
            if k == "scans":
                for sc in v:
                    if sc:
                        out.append(f"- scan: `{sc}`")
            else:
                out.append(f"- {k}: {v}")
        out.append("")
    text = "\n".join(out)
    os.makedirs("docs", exist_ok=True)
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "docs", "PLANS.md"), "w") as fh:
        fh.write(text)
    print(text)


if __name__ == "__main__":
    main()
