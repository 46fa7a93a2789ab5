"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Each query is counted through a full pass over its rows (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "postings_ws", "postings_words", "postings_text", "spell_dictionary",
    "kw_and", "kw_phrase", "score_tfidf", "score_bm25", "sort_relevance",
    "facet_multi", "facet_or_exclude", "facet_fulltext", "group_limit", "filter_nested", "top_k",
    "more_like_this", "autocomplete", "spell_suggest", "geo_radius", "latest_version", "stream_index",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from catalog import QUERIES, base
    from catalog.base import NORMED, documents
    from gleaner import Condition, Facet, IndexStore, Similar, search
    from gleaner.sources.tables import work_dir

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    base.PARTITIONS = int(cpus)  # the documents are one small file with one row group: a task for each core
    names = sys.argv[1:] or HEADLINE
    drain(QUERIES["match_all"](spark, sf_dir))  # start the JVM's engine once
    times = {name: timed(lambda: drain(QUERIES[name](spark, sf_dir))) for name in names}
    if not sys.argv[1:]:
        from pyspark.sql import functions as F

        store = IndexStore(spark, work_dir(spark, "bench"), NORMED)
        docs = documents(spark, sf_dir, NORMED).docs.withColumns({"version": F.lit(1), "op": F.lit("U")})
        times["store_build"] = timed(lambda: store.append(docs))
        times["store_top10"] = timed(lambda: drain(search(
            store.index(), keys="de la", where=Condition("lang", "fr"), limit=10).hits))
        parts = IndexStore(spark, work_dir(spark, "bench"), NORMED)
        for k in range(5):
            parts.append(docs.where(F.col("item_id").cast("long") % 5 == k), unique=True)
        times["store5_top10"] = timed(lambda: drain(search(
            parts.index(), keys="de la", where=Condition("lang", "fr"), limit=10).hits))
        times["store5_facet"] = timed(lambda: drain(search(
            parts.index(), keys="de", facets=(Facet("source"), Facet("lang"))).facets))
        times["store5_mlt"] = timed(lambda: drain(search(parts.index(), similar=Similar("3", ("text",)), limit=10).hits))
        store.drop()
        parts.drop()
    found = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(found.group(1)) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
