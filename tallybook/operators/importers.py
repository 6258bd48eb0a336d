"""Linking declarations to an official registry by name, or by the evidence of single keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.cdc import latest_by_key


def name_candidates(registry: DataFrame) -> DataFrame:
    """(business_name, candidates, only_code): how many codes each trimmed name has; the code where it is one.

    Names are compared byte by byte; entries without a code are no candidates.
    """
    known = registry.where("code is not null and trim(code) <> ''").select(F.trim("business_name").alias("business_name"), "code").distinct()
    per = known.groupBy("business_name").agg(F.count("*").alias("candidates"), F.min("code").alias("code"))
    return per.select("business_name", "candidates", F.when(F.col("candidates") == 1, F.col("code")).alias("only_code"))


def resolve_groups(decls: DataFrame, registry: DataFrame, gallery: DataFrame) -> DataFrame:
    """Per declaration: (rcno, business_name, code, link_source).

    A name with one candidate links all its declarations (PAGE_NAME).  With many, a declaration needs a gallery
    record of the same key, name and a candidate's code, and a process date (PAGE_RCNO).  Others stay null.
    """
    d = decls.select("rcno", F.trim("business_name").alias("business_name"), "process_date")
    known = registry.select(F.trim("business_name").alias("business_name"), "code").distinct()
    seen = gallery.select("rcno", F.trim("business_name").alias("business_name"), "code").join(known, ["business_name", "code"], "left_semi")
    seen = seen.groupBy("rcno", "business_name").agg(F.min("code").alias("seen_code"))
    r = d.join(name_candidates(registry), "business_name", "left").join(seen, ["rcno", "business_name"], "left")
    by_key = (F.col("candidates") > 1) & F.col("process_date").isNotNull() & F.col("seen_code").isNotNull()
    code = F.coalesce("only_code", F.when(by_key, F.col("seen_code")))
    source = F.when(F.col("only_code").isNotNull(), "PAGE_NAME").when(by_key, "PAGE_RCNO")
    return r.select("rcno", "business_name", code.alias("code"), source.alias("link_source"))


def resolve_link(decls: DataFrame, links: DataFrame, registry: DataFrame) -> DataFrame:
    """(rcno, code, link_source): a stored link under the same name wins over the name's only code."""
    kept = links.where("code is not null").select("rcno", F.col("business_name"), F.col("code").alias("own"), F.col("link_source").alias("own_source"))
    d = decls.select("rcno", F.trim("business_name").alias("business_name"))
    r = d.join(kept, ["rcno", "business_name"], "left").join(name_candidates(registry), "business_name", "left")
    source = F.when(F.col("own").isNotNull(), F.col("own_source")).when(F.col("only_code").isNotNull(), "PAGE_NAME")
    return r.select("rcno", F.coalesce("own", "only_code").alias("code"), source.alias("link_source"))


def link_conflicts(gallery: DataFrame) -> DataFrame:
    """Keys that resolve to more than one code."""
    return gallery.groupBy("rcno").agg(F.min("code").alias("least"), F.max("code").alias("most")).where("least <> most")


def link_summary(resolved: DataFrame) -> DataFrame:
    """(groups, keys, resolved, unresolved)."""
    return resolved.agg(
        F.count_distinct("business_name").alias("groups"), F.count("*").alias("keys"), F.count("code").alias("resolved"), F.count_if(F.col("code").isNull()).alias("unresolved"),
    )


def upsert(target: DataFrame, batch: DataFrame, key: str, *order: str) -> DataFrame:
    """Target and batch as one table; of each key the newest row stays."""
    return latest_by_key(target.unionByName(batch), key, *order)


def importer_list(decls: DataFrame, registry: DataFrame) -> DataFrame:
    """Per name: declarations, first and last day, number of registry entries and the code if there is one."""
    stats = decls.groupBy(F.trim("business_name").alias("business_name")).agg(
        F.count("*").alias("declarations"), F.min("process_date").alias("first_day"), F.max("process_date").alias("last_day")
    )
    known = stats.join(name_candidates(registry), "business_name", "left").fillna({"candidates": 0})
    return known.select("business_name", "declarations", "first_day", "last_day", "candidates", F.col("only_code").alias("code"))


def pending_groups(decls: DataFrame, links: DataFrame) -> DataFrame:
    """(business_name, keys, first_rcno): declarations that no link of the same key and name covers, by trimmed name."""
    d = decls.select("rcno", F.trim("business_name").alias("business_name")).where("business_name <> ''")
    known = links.where("code is not null").select("rcno", "business_name").distinct()
    return d.join(known, ["rcno", "business_name"], "left_anti").groupBy("business_name").agg(F.count_distinct("rcno").alias("keys"), F.min("rcno").alias("first_rcno"))


def search_candidates(names: DataFrame, found: DataFrame) -> DataFrame:
    """(business_name, code): search results whose trimmed name is the one asked for, each code once."""
    f = found.where("code is not null and trim(code) <> ''").select(F.trim("business_name").alias("business_name"), "code")
    asked = names.select(F.trim("business_name").alias("business_name")).distinct()
    return f.join(asked, "business_name", "left_semi").distinct()


#: Where the registry sends a request for a detail page that it does not show.
UNAVAILABLE = ("/error/noAuth", "/error/error")
_DETAIL = ("license_number", "business_name", "representative", "institution", "address", "industry")


def verify_detail(candidates: DataFrame, details: DataFrame) -> DataFrame:
    """Per candidate: (code, the fields above, phone, permit_date, operating_status, outcome).

    ``details`` has one row a request: asked_code, http_status, location and the fields of the page.  A page must repeat the candidate's
    code and name, and its licence where the list gives one: VERIFIED, else MISMATCH with no fields.  Where the registry redirects to one of its error pages the
    fields of the list count and the status is UNKNOWN: UNAVAILABLE.  Any other answer, or none, is FAILED.
    """
    c = candidates.select("code", *_DETAIL)
    d = details.select(F.col("asked_code").alias("code"), "http_status", "location", *[F.col(x).alias(f"d_{x}") for x in ("code", *_DETAIL, "phone", "permit_date", "operating_status")])
    tidy = lambda x: F.trim(F.coalesce(F.col(x), F.lit("")))
    same = (tidy("d_code") == tidy("code")) & (tidy("d_business_name") == tidy("business_name")) & ((tidy("license_number") == "") | (tidy("d_license_number") == tidy("license_number")))
    path = F.regexp_extract(F.coalesce("location", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    outcome = (
        F.when((F.col("http_status") == 200) & same, "VERIFIED").when(F.col("http_status") == 200, "MISMATCH")
        .when((F.col("http_status") == 302) & path.isin(*UNAVAILABLE), "UNAVAILABLE").otherwise("FAILED")
    )
    page, listed = F.col("outcome") == "VERIFIED", F.col("outcome") == "UNAVAILABLE"
    return c.join(d, "code", "left").withColumn("outcome", outcome).select(
        "code", *[F.when(page, F.col(f"d_{x}")).when(listed, F.col(x)).alias(x) for x in _DETAIL],
        F.when(page, F.col("d_phone")).alias("phone"), F.when(page, F.col("d_permit_date")).alias("permit_date"),
        F.when(page, F.col("d_operating_status")).when(listed, "UNKNOWN").alias("operating_status"), "outcome",
    )


def job_pending(items: DataFrame, decls: DataFrame, links: DataFrame, job_id: int) -> DataFrame:
    """(business_name, process_date, rcno) that a job has to link: the newest item of each key in the job, and declarations outside it that have no importer.

    Links count under the same name, byte by byte; items without a name are left out, and they do not hide an older one of the same key.  A name's keys stay rows, since
    one name may hold a large share of them.
    """
    named = items.withColumn("business_name", F.trim("importer_name")).where("business_name <> ''")
    now = latest_by_key(named.where(F.col("job_id") == job_id).select("rcno", "item_id", "observed_at", "business_name", "processed_date"), "rcno", "observed_at", "item_id")
    source = named.select(F.col("item_id").alias("source_item_id"), "business_name", "processed_date")
    old = decls.where("importer_id is null").select("rcno", "source_item_id").join(source, "source_item_id").join(now.select("rcno"), "rcno", "left_anti")
    both = now.select("rcno", "business_name", "processed_date").unionByName(old.select("rcno", "business_name", "processed_date"))
    known = links.select("rcno", F.col("source_importer_name").alias("business_name"))
    return both.join(known, ["rcno", "business_name"], "left_anti").select("business_name", F.col("processed_date").alias("process_date"), "rcno")


def upsert_registry(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Registry entries by code: those of the batch replace all attributes of the target's; of several in a batch the last observed counts.

    The name is trimmed and gets its SHA-256 as ``name_key``; empty optional texts become null, a missing status UNKNOWN.
    """
    empty = lambda c: F.when(F.col(c) != "", F.col(c))
    optional = [c for c in ("representative", "permit_date", "institution", "address", "phone", "industry") if c in batch.columns]
    fresh = batch.withColumns({
        "business_name": F.trim("business_name"), "name_key": F.sha2(F.trim("business_name"), 256),
        "operating_status": F.coalesce(empty("operating_status"), F.lit("UNKNOWN")), **{c: empty(c) for c in optional},
    })
    fresh = latest_by_key(fresh, "code", "observed_at", "name_key")
    return target.join(fresh.select("code"), "code", "left_anti").unionByName(fresh.select(*target.columns))


def upsert_links(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Links by rcno: one of the batch replaces the target's, whatever its age; of several in a batch the last observed counts."""
    fresh = latest_by_key(batch, "rcno", "source_observed_at", "code")
    return target.join(fresh.select("rcno"), "rcno", "left_anti").unionByName(fresh.select(*target.columns))
