"""Skew evidence: the largest task's share of each stage's shuffle input.

Derives a skewed frame from lineitem: one ``by`` key ("hot") holds a third of
the rows, and inside it a single value holds a third of that key's rows
(a hot value).  Runs each operator with ``by=["seg"]`` (rank buckets forced
on with a small split threshold) and, for contrast, a naive
``rank() over (partition by key order by v)``; prints per operator the worst
stage's max-task share of shuffle records.  A balanced stage on 32 shuffle
partitions is about 0.03; a stage dominated by the hot key is about 0.33.

The broadcast threshold is lowered to 1 MB so the size relation matches a
large cluster: per-key tables (KB) are broadcast, distinct-value tables
(here ~8 MB, at scale terabytes) are not.  ``BCAST=-1`` disables broadcasts
entirely (the fallback path for very many keys).
Usage: [BCAST=bytes] python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from twosample.operators import chisquare as CS  # noqa: E402
from twosample.operators import distribution as DI  # noqa: E402
from twosample.operators.levene import levene  # noqa: E402
from twosample.operators.mannwhitney import mannwhitney  # noqa: E402
from twosample.operators.prepare import prepare  # noqa: E402
from twosample.operators.sampling import sample_groups  # noqa: E402
from twosample.operators.shapiro import shapiro  # noqa: E402
from twosample.operators.summary import moments  # noqa: E402
from twosample.operators.ttests import pair_align, paired_t  # noqa: E402
from twosample.session import local_session  # noqa: E402

PARTS = 64  # range partitions at this small scale


def main(sf_dir: str) -> None:
    ev = tempfile.mkdtemp(prefix="skew-ev-", dir="/tmp")
    spark = local_session(8, shuffle_partitions=32, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
        "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": os.environ.get("BCAST") or str(1 << 20)})
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = (F.col("l_orderkey") % 3) == 0
    skewed = (li.withColumn("seg", F.when(hot, F.lit("hot"))
                            .otherwise(F.concat(F.lit("k"), (F.col("l_orderkey") % 97).cast("string"))))
                .withColumn("price", F.when(hot & (F.col("l_linenumber") <= 2), F.lit(1000.0))
                            .otherwise(F.col("l_extendedprice")))
                .withColumn("pair", F.when(hot, F.lit(-1)).otherwise(F.col("l_orderkey")))
                .withColumn("rid", F.monotonically_increasing_id()))
    fr = prepare(skewed, "price", "l_returnflag", ("A", "R"), by=["seg"], keep=["pair", "rid"])
    keys = ["seg"]
    w = Window.partitionBy("seg").orderBy("v")
    jobs = {
        "naive_rank_window": fr.withColumn("r", F.rank().over(w)).groupBy("seg").agg(F.sum("r")),
        "moments": moments(fr, keys),
        "mannwhitney": mannwhitney(fr, keys, parts=PARTS),
        "levene": levene(fr, keys, parts=PARTS),
        "box_stats": DI.box_stats(fr, keys, parts=PARTS),
        "qq_points": DI.qq_points(fr, keys, parts=PARTS),
        "hist_density": DI.hist_density(fr, keys),
        "kde_curve": DI.kde_curve(fr, keys),
        "chisq_binned": CS.chisq_binned(fr, keys),
        "shapiro": shapiro(fr, [*keys, "g"]),
        "sample_groups": sample_groups(fr, keys, 1000, ["rid"]),
        "paired_hot_pair_key": paired_t(pair_align(fr, keys, "pair"), keys),
    }
    for name, df in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group, tasks = {}, {}
    files = [f for f in glob.glob(ev + "/*") + glob.glob(ev + "/*/*") if not os.path.isdir(f)]
    for f in files:
        for line in open(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = e.get("Properties", {}).get("spark.jobGroup.id")
                for sid in e["Stage IDs"]:
                    stage_group[sid] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                tasks.setdefault(e["Stage ID"], []).append(m.get("Total Records Read", 0))
    worst = {}
    for sid, recs in tasks.items():
        tot = sum(recs)
        if tot < 10000:
            continue
        share = max(recs) / tot
        g = stage_group.get(sid)
        if share > worst.get(g, (0, 0))[0]:
            worst[g] = (round(share, 3), tot)
    print(json.dumps({"worst_stage_max_task_share": worst,
                      "note": "largest task's share of a stage's shuffle records (stages with "
                              ">= 10,000 records); hot key holds 1/3 of rows, 32 partitions"}))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
