"""Vendor and product reports over ``affected_products`` (G4.1-G4.3, E4.1, E4.3) and the two reports that
join it with ``core_cves`` (G5.1, G5.2).

Skew: a vendor (or a record) may carry a third of all affected rows. Every grouping here is a hash
aggregate with map-side partial aggregation, and the ``COUNT(DISTINCT ...)`` rewrite first groups on
(key, distinct value), which spreads a hot key across tasks. Joins are left to AQE, which broadcasts a side
only when its runtime size is under ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions
of sort-merge joins otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.numeric import avg_rounded, count_when, label_at_least, ratio


def vendor_leaderboard(aff: DataFrame, vendor: str = "vendor_name", key: str = "cve_id",
                       product: str = "product_name", n: int = 25, digits: int = 2) -> DataFrame:
    """Top-``n`` vendors by distinct records (ties by name); records per product guarded against 0."""
    grouped = (aff.filter(F.col(vendor).isNotNull()).groupBy(vendor)
                  .agg(F.count_distinct(key).alias("total_vulnerabilities"),
                       F.count(F.lit(1)).alias("total_product_instances"),
                       F.count_distinct(product).alias("unique_products_affected")))
    return (grouped.withColumn("avg_cves_per_product",
                               ratio(F.col("total_vulnerabilities"), F.col("unique_products_affected"), digits))
                   .orderBy(F.desc("total_vulnerabilities"), F.asc(vendor)).limit(n))


def product_priority(aff: DataFrame, vendor: str = "vendor_name", product: str = "product_name",
                     key: str = "cve_id", n: int = 30, bounds=S.PRIORITY_BOUNDS,
                     labels=S.PRIORITY_LABELS) -> DataFrame:
    grouped = (aff.filter(F.col(vendor).isNotNull() & F.col(product).isNotNull()).groupBy(vendor, product)
                  .agg(F.count_distinct(key).alias("vulnerability_count"), F.count(F.lit(1)).alias("total_records")))
    return (grouped.withColumn("priority_level", label_at_least(F.col("vulnerability_count"), bounds, labels))
                   .orderBy(F.desc("vulnerability_count"), F.asc(vendor), F.asc(product)).limit(n))


def portfolio_density(aff: DataFrame, vendor: str = "vendor_name", product: str = "product_name",
                      key: str = "cve_id", min_products: int = 3, n: int = 20, risk_bounds=None,
                      risk_labels=S.VENDOR_RISK_LABELS, digits: int = 2) -> DataFrame:
    """Vendors with at least ``min_products`` products: records per product. ``risk_bounds`` (strict ``>``,
    e.g. ``(100, 50)``) adds the exploratory risk label."""
    grouped = (aff.filter(F.col(vendor).isNotNull() & F.col(product).isNotNull()).groupBy(vendor)
                  .agg(F.count_distinct(product).alias("product_portfolio_size"),
                       F.count_distinct(key).alias("total_vulnerabilities"))
                  .filter(F.col("product_portfolio_size") >= min_products))
    out = grouped.withColumn("vulnerability_density",
                             ratio(F.col("total_vulnerabilities"), F.col("product_portfolio_size"), digits))
    if risk_bounds is not None:
        out = out.withColumn("vendor_risk_level",
                             label_at_least(F.col("total_vulnerabilities"), risk_bounds, risk_labels, strict=True))
    return out.orderBy(F.desc("total_vulnerabilities"), F.asc(vendor)).limit(n)


def critical_detail(core: DataFrame, aff: DataFrame, n: int = 25, band_value: str = "CRITICAL",
                    excerpt: int = 80) -> DataFrame:
    """Records of one risk band with their distinct affected vendor/product counts (0 when none).

    Same result as ``core LEFT JOIN aff GROUP BY (id, score, band, time, description)``, planned so that a
    record with a huge fan-out cannot pin one task: (1) the affected rows of the band's ids (a semi-join
    that adaptive execution broadcasts or, as an exchange follows, splits where an id is hot); (2) their distinct
    (id, vendor) and (id, product) pairs, dealt by all of id and name, so a hot id spreads over many tasks; (3)
    counts per id, summed up map-side first; (4) a left join that matches at most one count row per record.
    """
    five = ["cve_id", "cvss_base_score", "risk_category", "published_timestamp", "cve_description"]
    in_band = core.filter(F.col("risk_category") == band_value)
    chosen = in_band.select(*five).distinct()
    # ids straight from the scan: an aggregation on this side would keep adaptive execution from splitting the join
    relevant = aff.select("cve_id", "vendor_name", "product_name").join(in_band.select("cve_id"), "cve_id", "left_semi")
    tagged = relevant.select("cve_id", F.explode(F.array(
        F.struct(F.lit("v").alias("kind"), F.col("vendor_name").alias("name")),
        F.struct(F.lit("p").alias("kind"), F.col("product_name").alias("name")))).alias("x"))
    # dealt anew: the join's partitioning by id would satisfy the distinct and keep a hot id together
    pairs = (tagged.select("cve_id", "x.kind", "x.name").where("name is not null").repartition("cve_id", "kind", "name").distinct())
    counts = (pairs.groupBy("cve_id")
              .agg(F.count(F.when(F.col("kind") == "v", 1)).alias("affected_vendor_count"),
                   F.count(F.when(F.col("kind") == "p", 1)).alias("affected_product_count")))
    joined = chosen.join(counts, "cve_id", "left").fillna(0, ["affected_vendor_count", "affected_product_count"])
    return (joined.orderBy(F.desc_nulls_last("cvss_base_score"), F.desc("affected_vendor_count"),
                           F.asc_nulls_first("cve_id"))
                  .limit(n)
                  .select("cve_id", "cvss_base_score", "risk_category", F.to_date("published_timestamp").alias("published_date"),
                          "affected_vendor_count", "affected_product_count",
                          F.substring("cve_description", 1, excerpt).alias("description_excerpt")))


def vendor_risk_profile(aff: DataFrame, core: DataFrame, n: int = 20, levels=("CRITICAL", "HIGH", "MEDIUM"),
                        digits: int = 2) -> DataFrame:
    """Per vendor over ``aff INNER JOIN core`` (scored records only). Averages and level counts run over
    the joined (record, product) rows, not distinct records — as in the analysed report."""
    a = aff.filter(F.col("vendor_name").isNotNull()).select("cve_id", "vendor_name", "product_name")
    c = core.filter(F.col("cvss_base_score").isNotNull()).select("cve_id", "cvss_base_score", "risk_category")
    joined = a.join(c, "cve_id")
    return (joined.groupBy("vendor_name")
                  .agg(F.count_distinct("cve_id").alias("total_cves"),
                       avg_rounded("cvss_base_score", digits).alias("avg_cvss_score"),
                       F.max("cvss_base_score").alias("max_cvss_score"),
                       *[count_when(F.col("risk_category") == lvl).alias(f"{lvl.lower()}_vulns") for lvl in levels],
                       F.count_distinct("product_name").alias("products_affected"))
                  .orderBy(F.desc("total_cves"), F.asc("vendor_name")).limit(n))
