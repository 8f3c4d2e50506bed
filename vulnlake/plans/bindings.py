"""Bindings of the driver's test tables to the vulnerability data model.

* ``documents``: one JSON document per order (orders + customer + nation, lines from lineitem + supplier +
  part), rendered by Spark with ``to_json``; the silver operators parse them back.
* ``core_twin`` / ``affected_twin``: the same records computed relationally (joins and a grouped
  aggregate, no JSON), used as cheap inputs of the gold reports. Equality of the two paths is itself a
  registered check (``t11_affected_products``, ``t12_build_core``).

Binding rules (fixed; the DuckDB oracle states them again in SQL):

==========================  =============================================================================
cveId                       ``CVE-<year(o_orderdate)>-<o_orderkey, zero-padded to at least 7 digits>``
state                       REJECTED when o_orderstatus = 'F', else PUBLISHED
assignerOrgId / ShortName   ``org-<c_nationkey>`` / n_name, the name absent when c_acctbal < 0
datePublished               o_orderdate + (o_orderkey mod 86400) s, ISO text with 'Z'; absent when
                            o_orderstatus = 'P' and o_orderpriority = '5-LOW'
dateReserved / dateUpdated  published - 30 days / + (o_orderkey mod 10) days; absent with it
descriptions                {es: "hola"}, then {en: "Order <key> <priority>"}; the second is tagged en-US
                            (so not English) when o_orderpriority = '4-NOT SPECIFIED'
metrics[] (per line)        l_returnflag R -> cvssV3_1, A -> cvssV3_0, N -> other {type: ssvc};
                            score 0.0 on line 7 else l_quantity / 5; severity by score band (NONE at 0)
affected[] (per line)       vendor s_name (absent when s_acctbal < 0), product p_name (absent when
                            p_size > 48), defaultStatus 'affected' when l_linestatus = 'O', versions
                            [{version: "<l_linenumber>"}], platforms ["<l_linestatus>"], collectionURL,
                            packageName p_brand
==========================  =============================================================================
"""

from __future__ import annotations

import datetime as _dt
import json

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import documents as J
from ..functions import scores as SC
from ..operators import silver
from ..session import scratch_path, shuffles_freed
from ..sources import Listing, to_bronze_columns, with_ingest_metadata

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the binding.
INGESTED_AT = _dt.datetime(2001, 8, 2, 0, 0, 0)
AS_OF = _dt.date(2001, 8, 1)
DOC_KEYS = ("containers", "cveMetadata", "dataType", "dataVersion")
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SEVERITY_BANDS = S.RISK_BANDS
SEVERITY_NONE = "NONE"
FREED_FILES = 10_000  # that a task deletes, about
VENDOR_URL_PREFIX = "https://vendors.test/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cve_id(orderkey: str = "o_orderkey", orderdate: str = "o_orderdate") -> Column:
    return F.concat(F.lit("CVE-"), F.year(orderdate).cast("string"), F.lit("-"),
                    F.format_string("%07d", F.col(orderkey)))


def _published_ntz() -> Column:
    missing = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return F.when(~missing, F.expr("timestampadd(SECOND, o_orderkey % 86400, o_orderdate)"))


def _line_score(at=F.col) -> Column:
    return F.when(at("l_linenumber") == 7, F.lit(0.0)).otherwise(at("l_quantity") / 5)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its supplier and part attributes (left joins: a missing dimension row only blanks
    fields). Supplier and part grow with the data, so the join strategy is left to AQE."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                 "l_quantity", "l_returnflag", "l_linestatus")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    prt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    return (li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left")
              .join(prt, F.col("l_partkey") == F.col("p_partkey"), "left"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with customer and nation. nation has 25 rows at every scale: broadcasting it is bounded."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
             .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left"))


def _vendor() -> Column:
    return F.when(F.col("s_acctbal") >= 0, F.col("s_name"))


def _product() -> Column:
    return F.when(F.col("p_size") <= 48, F.col("p_name"))


def _vendor_url(at=F.col) -> Column:
    return F.when(at("s_suppkey").isNotNull(), F.concat(F.lit(VENDOR_URL_PREFIX), at("s_suppkey").cast("string")))


def _state() -> Column:
    return F.when(F.col("o_orderstatus") == "F", F.lit("REJECTED")).otherwise(F.lit("PUBLISHED"))


def _org_id() -> Column:
    return F.concat(F.lit("org-"), F.col("c_nationkey").cast("string"))


def _org_name() -> Column:
    return F.when(F.col("c_acctbal") >= 0, F.col("n_name"))


def _description() -> Column:
    return F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" "), F.col("o_orderpriority"))


# ---------------------------------------------------------------------------------------------------
# JSON documents
# ---------------------------------------------------------------------------------------------------

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per order: columns ``doc_year`` (int) and ``value`` (the document text). Lines are dealt by
    the order key before they are grouped on it, and the join with orders reuses that partitioning. What is dealt
    is the few values of a line; its JSON parts are rendered behind the last exchange."""
    def metric(line: Column) -> Column:
        score = _line_score(line.getItem)
        sev = SC.band(score, SEVERITY_BANDS, SEVERITY_NONE)

        def cvss(prefix: str) -> Column:
            return F.struct(score.alias("baseScore"), sev.alias("baseSeverity"),
                            F.concat(F.lit(prefix), line["l_linenumber"].cast("string")).alias("vectorString"))

        rf = line["l_returnflag"]
        return F.struct(F.when(rf == "R", cvss("CVSS:3.1/")).alias("cvssV3_1"),
                        F.when(rf == "A", cvss("CVSS:3.0/")).alias("cvssV3_0"),
                        F.when(rf == "N", F.struct(F.lit("ssvc").alias("type"))).alias("other"))

    def entry(line: Column) -> Column:
        return F.struct(
            line["vendor"].alias("vendor"), line["product"].alias("product"),
            F.when(line["l_linestatus"] == "O", F.lit("affected")).alias("defaultStatus"),
            F.array(F.struct(line["l_linenumber"].cast("string").alias("version"))).alias("versions"),
            F.array(line["l_linestatus"]).alias("platforms"),
            _vendor_url(line.getItem).alias("collectionURL"), line["p_brand"].alias("packageName"))

    lines = _lines(spark, sf_dir).select("l_orderkey", F.struct(
        "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", _vendor().alias("vendor"),
        _product().alias("product"), "s_suppkey", "p_brand").alias("line"))
    per_doc = (lines.repartition("l_orderkey").groupBy("l_orderkey").agg(F.collect_list("line").alias("lines")))

    pub = _published_ntz()
    meta = F.struct(
        _cve_id().alias("cveId"), _state().alias("state"), _org_id().alias("assignerOrgId"),
        _org_name().alias("assignerShortName"),
        F.date_format(pub, ISO_FORMAT).alias("datePublished"),
        F.date_format(F.expr("timestampadd(DAY, -30, _pub)"), ISO_FORMAT).alias("dateReserved"),
        F.date_format(F.expr("timestampadd(DAY, o_orderkey % 10, _pub)"), ISO_FORMAT).alias("dateUpdated"))
    english = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("en-US")).otherwise(F.lit("en"))
    descriptions = F.array(F.struct(F.lit("es").alias("lang"), F.lit("hola").alias("value")),
                           F.struct(english.alias("lang"), _description().alias("value")))
    doc = F.struct(F.lit("CVE_RECORD").alias("dataType"), F.lit("5.1").alias("dataVersion"), meta.alias("cveMetadata"),
                   F.struct(F.struct(descriptions.alias("descriptions"), F.transform("lines", metric).alias("metrics"),
                                     F.transform("lines", entry).alias("affected")).alias("cna")).alias("containers"))
    orders = _orders(spark, sf_dir).withColumn("_pub", pub)
    joined = orders.join(per_doc, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(F.year("o_orderdate").alias("doc_year"), F.to_json(doc).alias("value"))


def bronze(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None, ingested_at=INGESTED_AT) -> DataFrame:
    """Bronze rows of the documents: four text columns plus ingest metadata (source year = record year)."""
    docs = documents(spark, sf_dir) if docs is None else docs
    cols = to_bronze_columns(docs, keys=DOC_KEYS, keep=["doc_year"])
    return with_ingest_metadata(cols, F.col("doc_year"), ingested_at).drop("doc_year")


def write_document_files(docs: DataFrame, root: str) -> None:
    """Render ``docs`` (as ``documents`` makes them) as the archive has them: one indented JSON file each,
    ``<root>/<year>/<NNN>xxx/<cveId>.json``, written by the tasks.

    Ids ending in 5 begin with white space. Beside each id ending in 00 there are a truncated file, one with
    text behind the object, one of zero bytes, one that holds a list, and one whose name is no record's.
    """
    def write(rows) -> None:
        (fs, base), made = pafs.FileSystem.from_uri(root), set()
        for r in rows:
            doc = json.loads(r.value)
            cve = doc["cveMetadata"]["cveId"]
            folder = f"{base}/{r.doc_year}/{cve.split('-')[2][:3]}xxx"
            if folder not in made:
                fs.create_dir(folder, recursive=True)
                made.add(folder)
            text = json.dumps(doc, indent=4, ensure_ascii=False)
            files = {cve: ("\n\t" if cve.endswith("5") else "") + text}
            if cve.endswith("00"):
                files |= {f"{cve}-cut": text[:len(text) // 2], f"{cve}-more": text + " more", f"{cve}-empty": "", f"{cve}-list": f"[{text}]", f"notes-{cve[-7:]}": text}
            for name, content in files.items():
                with fs.open_output_stream(f"{folder}/{name}.json") as f:
                    f.write(content.encode())

    docs.foreachPartition(write)


def free_document_files(listing: Listing) -> None:
    """Deletes the listed files of a tree that ``write_document_files`` made, folder by folder in tasks, then the tree."""
    uri = listing.uri

    def free(rows) -> None:
        fs, _ = pafs.FileSystem.from_uri(uri)
        for r in rows:
            fs.delete_dir_contents(r.folder, missing_dir_ok=True)

    folders = listing.files.select(F.regexp_extract("file", r"(?s)^(.*)/", 1).alias("folder"))
    folders.distinct().repartition(max(1, -(-listing.files.count() // FREED_FILES)), "folder").foreachPartition(free)
    fs, base = pafs.FileSystem.from_uri(uri)
    fs.delete_dir(base)


def documents_in_parts(spark: SparkSession, sf_dir: str, parts: int) -> dict[int, tuple[DataFrame, list[int]]]:
    """``documents`` stored once, dealt by their ids to ``parts``: the documents of a part and their years. Documents of one id
    meet in one part; parts without documents are left out."""
    docs, path = documents(spark, sf_dir), scratch_path(spark, "document-parts")
    with shuffles_freed(spark):
        docs.withColumn("part", F.pmod(F.xxhash64(J.json_path("value", "$.cveMetadata.cveId")), F.lit(parts))).write.partitionBy(
            "part").parquet(path, compression="zstd")
    found = spark.read.schema("doc_year int, part int").parquet(path).distinct().collect()  # a row per part and year
    return {k: (spark.read.schema(docs.schema).parquet(f"{path}/part={k}"), sorted({r["doc_year"] for r in found if r["part"] == k}))
            for k in sorted({r["part"] for r in found})}


def bronze_with_redeliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze where every urgent record's document arrives twice in the same load (exact copies)."""
    docs = documents(spark, sf_dir)
    return bronze(spark, sf_dir, docs.unionByName(docs.filter(F.col("value").contains("1-URGENT"))))


# ---------------------------------------------------------------------------------------------------
# Relational twin
# ---------------------------------------------------------------------------------------------------

def _parts_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, the max score / severity / vector of each CVSS version (grouped aggregate)."""
    score = _line_score()
    sev = SC.band(score, SEVERITY_BANDS, SEVERITY_NONE)
    ln = F.col("l_linenumber").cast("string")
    aggs = []
    for flag, (label, container) in (("R", S.CVSS_VERSIONS[0]), ("A", S.CVSS_VERSIONS[1])):
        hit = F.col("l_returnflag") == flag
        aggs += [F.max(F.when(hit, score)).alias(f"_{container}_baseScore"),
                 F.max(F.when(hit, sev)).alias(f"_{container}_baseSeverity"),
                 F.max(F.when(hit, F.concat(F.lit(f"CVSS:{label}/"), ln))).alias(f"_{container}_vectorString")]
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*aggs)


def core_twin(spark: SparkSession, sf_dir: str, at=INGESTED_AT) -> DataFrame:
    """``core_cves`` computed without JSON (one row per order)."""
    pub = _published_ntz()
    has_english = F.col("o_orderpriority") != "4-NOT SPECIFIED"
    rows = _orders(spark, sf_dir).withColumn("_pub", pub.cast("timestamp")).select(
        "o_orderkey",
        _cve_id().alias("cve_id"), _state().alias("publication_state"), _org_id().alias("assigning_org_id"),
        _org_name().alias("assigning_org_name"),
        F.col("_pub").alias("published_timestamp"),
        F.expr("timestampadd(DAY, -30, _pub)").alias("reserved_timestamp"),
        F.expr("timestampadd(DAY, o_orderkey % 10, _pub)").alias("updated_timestamp"),
        F.when(has_english, _description()).alias("cve_description"),
        F.to_timestamp(F.lit(INGESTED_AT.strftime("%Y-%m-%d %H:%M:%S"))).alias("bronze_ingestion_ts"),
        F.year("o_orderdate").alias("data_year"))
    merged = rows.join(_parts_per_order(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return silver.finish_core(merged.drop("o_orderkey", "l_orderkey"), at)


def affected_twin(spark: SparkSession, sf_dir: str, at=INGESTED_AT) -> DataFrame:
    """``affected_products`` computed without JSON (one row per line with a vendor)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ln = F.col("l_linenumber").cast("string")
    rows = (_lines(spark, sf_dir).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(_cve_id().alias("cve_id"), _vendor().alias("vendor_name"), _product().alias("product_name"),
                    F.when(F.col("l_linestatus") == "O", F.lit("affected")).alias("vulnerability_status"),
                    F.concat(F.lit('[{"version":"'), ln, F.lit('"}]')).alias("affected_versions_json"),
                    F.concat(F.lit('["'), F.col("l_linestatus"), F.lit('"]')).alias("affected_platforms_json"),
                    _vendor_url().alias("vendor_url"), F.col("p_brand").alias("package_identifier")))
    out = silver.with_processing_time(rows.filter(F.col("vendor_name").isNotNull()), at)
    return silver.fill_defaults(out, S.AFFECTED_DEFAULTS).select(*S.AFFECTED_COLUMNS)


def with_revisions(core: DataFrame) -> DataFrame:
    """Core plus a revised row (new description) for every urgent record: the same id twice."""
    revised = (core.filter(F.col("cve_description").endswith("1-URGENT"))
                   .withColumn("cve_description", F.concat(F.col("cve_description"), F.lit(" (revised)"))))
    return core.unionByName(revised)


def with_strays(aff: DataFrame) -> DataFrame:
    """Affected rows plus, for every product of vendors with a name ending in 7, one entry of a record that
    core does not have: orphans against the whole core table."""
    strays = aff.filter(F.col("vendor_name").endswith("7")).withColumn("cve_id", F.concat(F.lit("LOST-"), F.col("cve_id")))
    return aff.unionByName(strays)


def unfilled_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affected rows before defaults: the vendor always, the product only where the supplier's balance is at
    least 5000."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rows = _lines(spark, sf_dir).join(o, F.col("l_orderkey") == F.col("o_orderkey")).where(F.col("s_name").isNotNull())
    return rows.select(_cve_id().alias("cve_id"), F.col("s_name").alias("vendor_name"),
                       F.when(F.col("s_acctbal") >= 5000, F.col("p_name")).alias("product_name"))


# ---------------------------------------------------------------------------------------------------
# Inputs of the operators along time and of the upsert
# ---------------------------------------------------------------------------------------------------

def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the org of their supplier's nation and their ship time."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_orderkey", "l_linenumber", "l_quantity", F.concat(F.lit("org-"), F.col("s_nationkey").cast("string")).alias("assigning_org_id"),
        F.expr("timestampadd(SECOND, l_orderkey % 86400, l_shipdate)").cast("timestamp").alias("ship_time"))


def score_history(core: DataFrame) -> DataFrame:
    """What an org published as a score, and when."""
    return core.where(F.col("cvss_base_score").isNotNull()).select(
        "assigning_org_id", F.col("published_timestamp").alias("score_time"), F.col("cvss_base_score").alias("score_in_force"))


def stored_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: an input of several loads is computed once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_load(core: DataFrame) -> DataFrame:
    """The records whose assigner is known."""
    return core.where(F.col("assigning_org_name").isNotNull())


def republished(core: DataFrame) -> DataFrame:
    """The load after it: records of unknown assigners; urgent records revised a day later, delivered twice; and the same
    urgent records once more as they were a day before, with a stale text."""
    day = F.expr("INTERVAL 1 DAY")
    urgent = core.where(F.col("cve_description").endswith("1-URGENT"))

    def as_of(text: str, time: Column) -> DataFrame:
        return urgent.withColumns({"cve_description": F.concat(F.col("cve_description"), F.lit(text)), "updated_timestamp": time})

    revised = as_of(" (revised)", F.col("updated_timestamp") + day)
    stale = as_of(" (stale)", F.col("updated_timestamp") - day)
    return core.where(F.col("assigning_org_name").isNull()).unionByName(revised).unionByName(revised).unionByName(stale)


EVENT_LOADS = ("2024-01-08", "2024-01-15", "2024-01-22", "9999-01-01")  # the stand-in stream arrives up to each of these


def event_loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events as they arrive: by week; each load repeats the errors of the day before it, and the last one brings
    clicks of the first week under new ids."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type",
                                                   F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    loads, since = [], "0001-01-01"
    for until in EVENT_LOADS:
        new = events.where((F.col("ts") >= since) & (F.col("ts") < until))
        again = events.where((F.col("event_type") == "error") & (F.col("ts") < since) & (F.col("ts") >= F.lit(since).cast("timestamp") - F.expr("INTERVAL 1 DAY")))
        loads.append(new.unionByName(again))
        since = until
    late = events.where((F.col("ts") < EVENT_LOADS[0]) & (F.col("event_type") == "click")).withColumn("event_id", -1 - F.col("event_id"))
    loads[-1] = loads[-1].unionByName(late)
    return loads
