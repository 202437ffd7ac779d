"""Print the physical plans of the main pipeline stages and marts.

Usage: python scripts/show_plans.py [sf_dir] [--no-auto-broadcast] [--markdown]

With --no-auto-broadcast the size-based broadcast threshold is disabled, which shows the
plan a large cluster would get for inputs above the threshold: only joins against
dimensions with a proven size bound stay broadcast.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tripmart import configure  # noqa: E402
from tripmart.operators import contracts  # noqa: E402
from tripmart.operators.conform import conform  # noqa: E402
from tripmart.operators.facts import build_fact  # noqa: E402
from tripmart.operators.quality import quality_report, trip_rules  # noqa: E402
from tripmart.plans import marts  # noqa: E402
from tripmart.plans.runs import Paths, backfill, load_dimensions, read_star  # noqa: E402
from tripmart.plans.star import silver_trips  # noqa: E402
from tripmart.schemas import TRIP_KEYS, TRIP_SPEC  # noqa: E402
from tripmart.sources import adapter  # noqa: E402
from tripmart.sources.raw import read_raw_trips, write_bronze, write_zone_lookup_csv  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


KEY_LINES = ("PushedFilters", "PartitionFilters", "ReadSchema")


def condensed(text: str) -> str:
    """Operator tree plus the scan lines that show pushdown, pruning and column pruning."""
    tree, _, details = text.partition("\n\n\n")
    keep = [ln for ln in details.splitlines() if ln.startswith(KEY_LINES) and ln.split(":", 1)[1].strip() not in ("[]",)]
    out = [tree.strip(), ""]
    out += [ln if len(ln) < 400 else ln[:400] + " ..." for ln in keep]
    return "\n".join(out)


def main():
    sf = next((a for a in sys.argv[1:] if not a.startswith("--")), "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    root = tempfile.mkdtemp(prefix="plans-", dir="/tmp")
    p = Paths(bronze=f"{root}/b", silver=f"{root}/s", quality=f"{root}/q", gold_fact=f"{root}/f",
              gold_dims=f"{root}/g", zone_lookup_csv=f"{root}/z")
    write_bronze(adapter.raw_trips(spark, sf), p.bronze)
    write_zone_lookup_csv(adapter.raw_zone_lookup(spark, sf), p.zone_lookup_csv)
    backfill(spark, p, "plans", enforce_gate=False)
    load_dimensions(spark, p, ("1995-01-01", "2001-12-31"))
    if "--no-auto-broadcast" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    raw = read_raw_trips(spark, p.bronze)
    star = read_star(spark, p)
    stages = {
        "silver (one period)": silver_trips(read_raw_trips(spark, p.bronze, 1997, 2), "r", "t", 1997, 2),
        "quality_report (all periods)": quality_report(conform(raw, TRIP_SPEC), trip_rules(), TRIP_KEYS, processed_at="t"),
        "fact projection": build_fact(spark.read.parquet(p.silver)),
        "mart_mom": marts.mart_mom(star),
        "mart_zones": marts.mart_zones(star),
        "mart_zones one period (partition-pruned fact)": marts.mart_zones(star, period=(1997, 2)),
        "top_pickup_zones": marts.top_pickup_zones(star),
        "contract_foreign_keys": contracts.contract_foreign_keys(star.fact, star.dims()),
        "adapter raw_trips": adapter.raw_trips(spark, sf),
    }
    md = "--markdown" in sys.argv
    for name, df in stages.items():
        if md:
            print(f"\n## {name}\n\n```\n{condensed(plan(df))}\n```")
        else:
            print(f"\n######## {name}\n")
            print(plan(df))


if __name__ == "__main__":
    main()
