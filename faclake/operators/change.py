"""Change detection against a manifest.

The manifest is a table keyed by the file's full URL with its listing fields
(link, last_modified ``yyyy-MM-dd HH:mm``, size in MB, local location).  A new
listing is compared with it by a left join; updates are merged with a full
outer join.  Both are single shuffles on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_listing_ts, url_basename
from ..sources.parts import PART, PartTable, hash_part

MANIFEST_DDL = "url string, link string, last_modified string, size_mb string, file_location string"


def last_per_key(df: DataFrame, key: str, order: str = "last_modified") -> DataFrame:
    """One row per key: that with the latest ``order`` time, then the largest row by
    its columns in order, so the choice does not depend on the input's order.  Rows
    without key stay.  One pre-aggregated shuffle."""
    when = parse_listing_ts(order) if order in df.columns else F.lit(None).cast("timestamp")
    rest = F.struct(when.alias("when__"), *[F.col(c) for c in df.columns if c != key])
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(rest).alias("_r"))
    own = [F.col(key) if c == key else F.col(f"_r.`{c}`").alias(c) for c in df.columns]
    return one.select(*own).unionByName(df.where(F.col(key).isNull()))


def manifest_diff(listing: DataFrame, manifest: DataFrame, key: str = "url") -> DataFrame:
    """Status of every listed file against the manifest.

    ``new``: no stored timestamp; ``updated``: the listed time is strictly
    newer; ``unchanged``: not newer; ``unknown``: the listed time is missing
    or does not parse.  ``to_fetch`` is true for new and updated files.
    """
    m = last_per_key(manifest, key).select(F.col(key), F.col("last_modified").alias("_stored"))
    j = listing.join(m, key, "left")
    listed_ts = parse_listing_ts("last_modified")
    stored_ts = parse_listing_ts("_stored")
    status = (F.when(F.col("_stored").isNull() | stored_ts.isNull(), F.lit("new"))
              .when(listed_ts.isNull(), F.lit("unknown"))
              .when(listed_ts > stored_ts, F.lit("updated"))
              .otherwise(F.lit("unchanged")))
    return (j.withColumn("status", status)
            .withColumn("to_fetch", F.col("status").isin("new", "updated"))
            .withColumnRenamed("_stored", "stored_last_modified"))


def manifest_upsert(manifest: DataFrame, updates: DataFrame, key: str = "url",
                    mode: str = "merge") -> DataFrame:
    """K9: insert new keys; for existing keys take the update's fields.

    ``merge``: fields present in ``updates`` overwrite (even with NULL),
    fields only in the manifest are kept.  ``replace``: an updated key's row
    is the update alone (manifest-only fields become NULL).  Keys not in
    ``updates`` are unchanged.  A key that repeats on either side counts once,
    with its last row (``last_per_key``), so an upsert never multiplies rows.
    """
    manifest, updates = last_per_key(manifest, key), last_per_key(updates, key)
    m_cols = [c for c in manifest.columns if c != key]
    u_cols = [c for c in updates.columns if c != key]
    m = manifest.select(key, *[F.col(c).alias(f"_m_{c}") for c in m_cols])
    u = updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_u_{c}") for c in u_cols])
    j = m.join(u, key, "full_outer")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = []
    for c in dict.fromkeys(m_cols + u_cols):
        if c in u_cols and c in m_cols:
            v = F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(f"_m_{c}"))
        elif c in u_cols:
            v = F.col(f"_u_{c}")
        else:
            v = F.col(f"_m_{c}") if mode == "merge" else F.when(~hit, F.col(f"_m_{c}"))
        out.append(v.alias(c))
    return j.select(key, *out)


class ManifestTable:
    """A stored manifest whose rows are kept in hash buckets of the key.  An upsert
    reads and rewrites only the buckets its keys fall into; the files of the others
    stay.  Two upserts that overlap: the second to publish gets ``ConcurrentReplace``
    and can be repeated."""

    def __init__(self, spark: SparkSession, path: str, key: str = "url", buckets: int = 64):
        self.table, self.key, self.buckets = PartTable(spark, path), key, buckets

    def read(self) -> DataFrame | None:
        return self.table.read()

    def upsert(self, updates: DataFrame, mode: str = "merge") -> list[str]:
        """K9 on the stored rows (``manifest_upsert``); returns the buckets rewritten.
        ``updates`` are evaluated twice: once for their buckets, at most ``buckets``
        numbers."""
        with self.table.change() as change:
            buckets = change.extra.setdefault("buckets", self.buckets)      # fixed by the first upsert
            part = hash_part(self.key, buckets)
            touched = sorted(r[0] for r in updates.select(part).distinct().collect())
            old = change.read(touched)
            merged = last_per_key(updates, self.key) if old is None else manifest_upsert(old, updates, self.key, mode)
            if touched:
                # rows of a bucket meet in one task, so a bucket is one file
                change.put(merged.withColumn(PART, part).repartition(len(touched), PART), touched)
        return [str(t) for t in touched]


def tracker_status(tracker: DataFrame, archive: DataFrame, link_col: str = "download_link",
                   name_col: str = "file_name") -> DataFrame:
    """H3: a tracked dataset is ``present`` when the base name of its download
    link is in the local archive listing (extract it), else ``missing``
    (fetch it)."""
    a = archive.select(F.col(name_col).alias("remote_name"), F.lit(True).alias("_in")).distinct()
    t = tracker.withColumn("remote_name", url_basename(link_col))
    return (t.join(a, "remote_name", "left")
            .withColumn("status", F.when(F.col("_in"), "present").otherwise("missing"))
            .drop("_in"))
