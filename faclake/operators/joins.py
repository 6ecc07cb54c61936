"""Join operators for the enrichment views (J1-J5) and skew handling.

All joins are inner equi-joins.  The facility side is first reduced to a
*dimension* keyed by the fact's join key (crosswalk slice joined with the
facility projection, or the case bridge joined with the facility), so the
large fact table is shuffled exactly once, on its own key.

Skew: Spark's AQE splits a skewed shuffle partition of a sort-merge join at
run time (on by default, tuned in ``session.SCALE_CONF``).  ``salted_join``
is the explicit alternative when one key may hold a large share of the fact
rows: it finds the hot keys with a pre-aggregated count (a bounded list,
at most ``1/hot_fraction`` keys), spreads their fact rows over ``buckets``
salts and replicates only the matching dimension rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

KEY = "k__"


def side_name(side: str, name: str) -> str:
    return f"{side}__{name}"


def facility_projection(facility: DataFrame, cols) -> DataFrame:
    """Facility columns renamed ``e__<name>`` plus the bare join key."""
    return facility.select(F.col("REGISTRY_ID"),
                           *[F.col(c).alias(side_name("e", c)) for c in cols])


def program_dimension(crosswalk: DataFrame, facility: DataFrame, program: str | None,
                      facility_cols) -> DataFrame:
    """Crosswalk slice joined to the facility: ``k__`` (= PGM_ID) -> facility columns.

    With ``program=None`` all programs are kept and ``PGM`` is carried along
    (the shared dimension written once per view refresh).
    """
    xw = crosswalk
    if program is not None:
        xw = xw.where(F.col("PGM") == F.lit(program))
    keep = ["PGM"] if program is None else []
    xw = xw.select(*keep, F.col("PGM_ID").alias(KEY), "REGISTRY_ID")
    return xw.join(facility_projection(facility, facility_cols), "REGISTRY_ID").drop("REGISTRY_ID")


def registry_dimension(facility: DataFrame, facility_cols) -> DataFrame:
    fac = facility_projection(facility, facility_cols)
    return fac.withColumnRenamed("REGISTRY_ID", KEY)


def bridge_dimension(bridge: DataFrame, bridge_key: str, bridge_cols, facility: DataFrame,
                     facility_cols) -> DataFrame:
    """Case bridge joined to the facility: ``k__`` (= bridge key) -> columns."""
    b = bridge.select(F.col(bridge_key).alias(KEY), "REGISTRY_ID",
                      *[F.col(c).alias(side_name("c", c)) for c in bridge_cols])
    return b.join(facility_projection(facility, facility_cols), "REGISTRY_ID").drop("REGISTRY_ID")


def is_bucketed(df: DataFrame) -> bool:
    """Is a bucketed catalog table read?  A join with it is to shuffle the fact only."""
    if not hasattr(df, "_jdf"):
        return False
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    tables = [leaf.catalogTable() for leaf in map(leaves.apply, range(leaves.size())) if leaf.getClass().getSimpleName() == "LogicalRelation"]
    return any(t.isDefined() and t.get().bucketSpec().isDefined() for t in tables)


def may_broadcast(df: DataFrame) -> bool:
    """Does the session of ``df`` broadcast at all?  A limit below 0 switches that off."""
    return not df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


# Bits of a key filter, as bitmaps of 32,768 bits each: 32 MB at most on an executor,
# and one bitmap at most for a key, so a short list of keys takes little.
FILTER_BITS = 1 << 28


def _filter_bits(key) -> tuple[F.Column, list[F.Column]]:
    """The bitmap of a key and its three bits there, from different bits of one hash."""
    h = F.xxhash64(key)
    return F.pmod(h, F.lit(FILTER_BITS >> 15)), [F.shiftrightunsigned(h, n).bitwiseAND(F.lit(0x7FFF)) for n in (13, 28, 43)]


def linked_rows(fact: DataFrame, fact_key: str, keys: DataFrame, key: str = KEY) -> DataFrame:
    """The rows of ``fact`` whose key may be among ``keys``, before any shuffle of them.

    Three bits of one bitmap are set for the hash of each key; the bitmaps are broadcast
    and every fact row looks its own bits up.  A row whose key is there always stays; of the
    others a few stay too (below 2 % up to ``FILTER_BITS`` / 10 keys), so a join must
    follow.  Keys of different types, whose hashes differ, leave ``fact`` as it is.
    """
    if fact.schema[fact_key].dataType != keys.schema[key].dataType or fact.schema[fact_key].dataType not in (StringType(), LongType()):
        return fact
    bucket, places = _filter_bits(F.col(key))
    bits = keys.where(F.col(key).isNotNull()).select(bucket.alias("bucket__"), F.explode(F.array(*places)).alias("place__"))
    bitmaps = bits.groupBy("bucket__").agg(F.bitmap_construct_agg("place__").alias("bitmap__"))
    bucket, places = _filter_bits(F.col(fact_key))
    found = bucket == F.col("bucket__")
    for place in places:
        at = place.cast("int")
        byte = F.conv(F.hex(F.substring("bitmap__", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        found &= F.call_function("shiftright", byte, at % 8).bitwiseAND(F.lit(1)) == 1
    return fact.join(F.broadcast(bitmaps), found).select(*fact.columns)


def packed_texts(df: DataFrame, key: str, name: str) -> tuple[DataFrame, dict[str, F.Column]]:
    """``df`` with the bytes of all texts but the key in one column ``name``, their
    lengths beside it, and each text as an expression over the two.

    A row of many short texts is shuffled as one: the place and padding that Spark's
    rows hold for each go, and the lengths are much alike from row to row.  Any text
    comes back as it was, a missing one as missing.
    """
    texts = [f.name for f in df.schema if f.dataType == StringType() and f.name != key]
    if len(texts) < 2:
        return df, {}
    sizes = f"{name}_sizes"
    read, at = {}, F.lit(1)
    for i, c in enumerate(texts):
        size = F.get(F.col(sizes), F.lit(i))
        read[c] = F.substring(F.col(name), at, size).cast("string")      # without a size none
        at = at + F.coalesce(size, F.lit(0))
    rest = [c for c in df.columns if c not in texts]
    return df.select(*rest, F.concat(*[F.coalesce(F.col(c).cast("binary"), F.lit(b"")) for c in texts]).alias(name),
                     F.array(*[F.octet_length(c) for c in texts]).alias(sizes)), read


def hot_keys(df: DataFrame, key: str, hot_fraction: float = 1 / 64) -> list:
    """Keys holding more than ``hot_fraction`` of the rows of ``df``, largest first.

    One pass: counts are pre-aggregated per key (map-side combine) and the largest
    of them come to the driver with the total.  Fewer than ``1 / hot_fraction``
    keys can hold more than that share each, so that many counts are enough.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most = int(1 / hot_fraction) + 1
    # the total travels with the rows: grouping sets give it from the same counts
    rows = (counts.rollup(key).agg(F.sum("n").alias("n"), F.grouping(key).alias("all"))
            .orderBy(F.col("all").desc(), F.col("n").desc(), key).limit(most + 1).collect())
    total = rows[0]["n"] or 0 if rows else 0
    return [r[0] for r in rows[1:] if r["n"] > total * hot_fraction]


# Plan nodes below which a task's rows, and their order, are those of a stored file.
_IN_PLACE = ("Project", "Filter", "LogicalRelation", "SubqueryAlias", "View", "LocalRelation", "Range", "DataSourceV2ScanRelation")


def reads_in_place(df: DataFrame) -> bool:
    """Is ``df`` a scan with filters and projections only?  A repeated task then sees
    the same rows in the same order, which after a shuffle it need not."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() not in _IN_PLACE:
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return True


def salted_join(big: DataFrame, big_key: str, dim: DataFrame, dim_key: str = KEY,
                hot_fraction: float = 1 / 64, buckets: int = 32) -> DataFrame:
    """Inner equi-join that spreads hot keys of ``big`` over ``buckets`` tasks.

    The salt of a fact row is its row number within its input partition, so equal
    rows of a hot key spread as well.  That holds on a repeated task only if ``big`` is
    read in place; the salt of other frames is a hash of the whole row, which is the
    same wherever the row is (their equal rows stay together).  The dimension rows of
    hot keys are replicated once per salt, every other row gets salt 0.
    """
    hot = hot_keys(big, big_key, hot_fraction)
    if not hot:
        return big.join(dim, big[big_key] == dim[dim_key])
    is_hot_big = F.col(big_key).isin(hot)
    place = F.monotonically_increasing_id() if reads_in_place(big) else F.xxhash64(*big.columns)
    b = big.withColumn("__salt_b", F.when(is_hot_big, F.pmod(place, F.lit(buckets))).otherwise(F.lit(0)))
    d = dim.withColumn("__salt_d", F.explode(F.when(
        F.col(dim_key).isin(hot), F.sequence(F.lit(0), F.lit(buckets - 1)))
        .otherwise(F.array(F.lit(0)))))
    cond = (b[big_key] == d[dim_key]) & (b["__salt_b"] == d["__salt_d"])
    return b.join(d, cond).drop("__salt_b", "__salt_d")


def join_to_dimension(fact: DataFrame, fact_key: str, dim: DataFrame, skew: str = "aqe",
                      **salt_opts) -> DataFrame:
    """Fact joined to a dimension keyed by ``k__``; the fact keeps its names."""
    if skew == "salt":
        return salted_join(fact, fact_key, dim, KEY, **salt_opts)
    return fact.join(dim, fact[fact_key] == dim[KEY])
