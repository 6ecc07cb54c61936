"""Regenerates docs/PLANS.md: formatted physical plans of the main operators."""
import os
import io, sys, contextlib
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from faclake.session import build_session
spark = build_session(master="local[8]", shuffle_partitions=16, driver_memory="8g")
from pyspark.sql import functions as F
from faclake.workload.ingest_queries import _fact_lake
from faclake.workload import adapters as A
from faclake.plans import refresh as R
from faclake.plans.views import VIEWS_BY_NAME, build_view
from faclake.operators import crosswalk as X, schema as S
from faclake.sources.csv import scan_csv
from faclake.sources import html as H
from faclake.session import scratch_path
sf = "/root/testdata/sf0.01"
names = ["AIR_COMPLIANCE_MVIEW", "AIR_ENFORCEMENTS_MVIEW"]
lake = _fact_lake(spark, sf, sorted({t for n in names for t in VIEWS_BY_NAME[n].tables}))
lake.write(A.wide_facility(spark, sf), "ECHO_EXPORTER_WIDE")
dim = R.write_dimension(lake, [VIEWS_BY_NAME[n] for n in names])
def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    out = buf.getvalue()
    out = out.replace(lake.root, "<lake>")
    return out.strip()
sections = []
sections.append(("Crosswalk build (X2): one scan of the facility table, no shuffle",
                 plan(X.build_crosswalk(lake.read("ECHO_EXPORTER_WIDE")))))
air = VIEWS_BY_NAME["AIR_COMPLIANCE_MVIEW"]
tb = {t: lake.read(t) for t in air.tables}
sections.append(("Crosswalk view from the shared dimension, measured small -> broadcast (J2/J3)",
                 plan(build_view(air, tb, shared_dim=dim, broadcast_dim=True))))
spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1"); spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
sections.append(("Same view when the dimension is over the limit: one shuffle of the fact, on its key",
                 plan(build_view(air, tb, shared_dim=dim))))
hot = tb[air.fact].select(F.first(air.fact_key)).first()[0]
skewed = dict(tb)
skewed[air.fact] = tb[air.fact].withColumn(air.fact_key, F.when(F.pmod(F.xxhash64("ACTIVITY_ID"), F.lit(3)) == 0, F.lit(hot)).otherwise(F.col(air.fact_key)))
spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
sections.append(("Large fact: runtime bloom filter before the shuffle (scan-size threshold forced to 0 here)",
                 plan(build_view(air, tb, shared_dim=dim))))
spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "10GB")
sections.append(("Same view with explicit hot-key salting (skew='salt'), one key holding a third of the fact rows",
                 plan(build_view(air, skewed, shared_dim=dim, skew="salt", hot_fraction=1/64))))
spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB"); spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
enf = VIEWS_BY_NAME["AIR_ENFORCEMENTS_MVIEW"]
sections.append(("Bridge view (J4): case bridge joined to the facility first, fact filtered at the scan",
                 plan(build_view(enf, {t: lake.read(t) for t in enf.tables}))))
land = scratch_path(spark, "plans-csv")
A.read(spark, sf, "part").write.option("header", True).csv(f"{land}/part.csv")
from faclake.workload.ingest_queries import PART_COLUMNS
sections.append(("Typed CSV scan (S1) written to the lake",
                 plan(scan_csv(spark, f"{land}/part.csv", S.struct_from_columns(PART_COLUMNS)).where("P_SIZE > 10").select("P_PARTKEY", "P_NAME")).replace(land, "<landing>")))
sections.append(("Directory-listing extraction (S8): per-row regex/array expressions, no shuffle",
                 plan(H.extract_listing(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")))))
NOTES = {
 "Crosswalk build": "Scan -> Generate(inline) -> Filter -> Generate(explode): one pass, no Exchange. Only REGISTRY_ID, the four flags and the four id lists are read (ReadSchema); `isnotnull(REGISTRY_ID)` is pushed to the scan. At 100 TB this is a map-only job whose cost is one read of nine columns of the facility table.",
 "Crosswalk view from the shared dimension, measured small -> broadcast": "The dimension partition `PGM=AIR_IDS` was measured from its footers and found under the broadcast limit, so it is broadcast; the fact is streamed, never shuffled. PartitionFilters shows that only one program's dimension files are read; the fact's ReadSchema holds only the view's columns.",
 "Same view when the dimension is over the limit": "With broadcasting off (as for a dimension over the limit), the plan is one sort-merge join: the fact is exchanged once, on its join key, and the dimension once. AQE's skew-join split applies to this join at run time.",
 "Large fact": "A bloom filter is aggregated over the dimension's join keys (bloom_filter_agg, a scalar subquery of bounded size) and applied to the fact scan (might_contain) before the exchange, so fact rows without a facility never reach the shuffle. Spark applies it by default when the fact scan exceeds 10 GB.",
 "Same view with explicit hot-key salting": "The hot key was found by a pre-aggregated count (bounded list). Fact rows of hot keys get `pmod(xxhash64(row), 32)` as salt; only the hot keys' dimension rows are replicated (Generate explode of a sequence); the join is on (key, salt), so the hot key is spread over 32 tasks.",
 "Bridge view": "The case bridge is joined to the facility first (the dimension), then to the fact, which is filtered on HQ_DIVISION = 'AIR' at the scan. At this size Spark broadcasts the side its file-size estimate says is smaller; at scale, where the fact is large, this becomes one shuffle of the fact on CASE_NUMBER.",
 "Typed CSV scan": "Declared schema, projection and filter pushed into the CSV scan; the scan is split across tasks by file ranges.",
 "Directory-listing extraction": "All per-row regex and array expressions run inside the Generate/Project of one stage; no shuffle, no Python.",
}
with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
    f.write("# Physical plans\n\nGenerated with `df.explain(\"formatted\")` on the sf0.01 test data "
            "(paths shortened).  Notes on what each plan does at scale are in the README; this file is the evidence.\n\n")
    for title, p in sections:
        f.write(f"## {title}\n\n{NOTES.get(title.split(' (')[0].split(':')[0], '')}\n\n```\n{p}\n```\n\n")
print("ok", len(sections))
