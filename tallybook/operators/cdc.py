"""State of declarations over an append-only ledger of repeated observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERMINAL = ("NORMALIZED", "PARTIAL", "REVIEW_REQUIRED", "UNPARSED")
#: What a new or changed declaration starts with; columns not named hold null.
CLAIM = {"claim_owner": None, "claim_lease_until": None, "claim_attempts": 0, "claim_next_attempt_at": None, "claim_last_error": None}
FRESH = CLAIM | {"review_status": "NOT_REQUIRED", "reviewed_by": None, "reviewed_at": None, "review_note": None, "importer_id": None, "importer_link_source": None, "importer_linked_at": None}


def latest_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest row of each key.  One aggregation with map-side combine, no sort of a hot key's rows."""
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return df.groupBy(key).agg(newest).select(key, "r.*").select(*df.columns)


def append_new(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose keys the target lacks, each key once."""
    return batch.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def expand_dates(df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per calendar day, both ends included; ``total`` is their number."""
    days = F.sequence(F.to_date(first), F.to_date(last), F.expr("interval 1 day"))
    return df.withColumn("total", (F.datediff(last, first) + 1).cast("long")).withColumn("task_date", F.explode(days))


def recent_range(now: Column, zone: str, days: int = 7) -> tuple[Column, Column]:
    """First and last of the latest calendar days in a zone, today included."""
    today = F.to_date(F.from_utc_timestamp(now, zone))
    return F.date_sub(today, days - 1), today


def sync_declarations(current: DataFrame, latest: DataFrame) -> DataFrame:
    """The next state: (rcno, source_item_id, semantic_sha256, status, changed).

    A new key starts PENDING; a newer row of equal hash only moves the source; another hash makes
    it STALE.  Comparison is null-safe, and syncing again changes nothing.  Columns of ``FRESH`` that ``current`` has come along: another hash
    or a new key sets them back.
    """
    c, n = current.alias("c"), latest.alias("n")
    same = F.col("c.semantic_sha256").eqNullSafe(F.col("n.semantic_sha256"))
    status = (
        F.when(F.col("c.source_item_id").isNull(), "PENDING").when(F.col("n.source_item_id").isNull() | same, F.col("c.status")).otherwise("STALE")
    )
    changed = F.col("c.source_item_id").isNull() | (F.col("n.source_item_id").isNotNull() & ~same)
    return c.join(n, F.col("c.rcno") == F.col("n.rcno"), "full_outer").select(
        F.coalesce("c.rcno", "n.rcno").alias("rcno"), F.coalesce("n.source_item_id", "c.source_item_id").alias("source_item_id"),
        F.when(F.col("n.source_item_id").isNull(), F.col("c.semantic_sha256")).otherwise(F.col("n.semantic_sha256")).alias("semantic_sha256"),
        status.alias("status"), changed.alias("changed"), *[F.when(changed, F.lit(FRESH[x])).otherwise(F.col(f"c.{x}")).alias(x) for x in current.columns if x in FRESH],
    )


def force_requeue(state: DataFrame) -> DataFrame:
    """Terminal rows become STALE again and lose their claim; derived values stay."""
    done = F.col("status").isin(*TERMINAL)
    claim = {c: F.when(done, F.lit(v)).otherwise(F.col(c)) for c, v in CLAIM.items() if c in state.columns}
    return state.withColumns({**claim, "status": F.when(done, "STALE").otherwise(F.col("status"))})


def select_work(latest: DataFrame, state: DataFrame, limit: int) -> DataFrame:
    """Keys without state, PENDING or STALE: newest day first, then largest id."""
    known = state.select("rcno", "status")
    open_ = F.col("status").isNull() | F.col("status").isin("PENDING", "STALE")
    return latest.join(known, "rcno", "left").where(open_).orderBy(F.desc("processed_date"), F.desc("source_item_id")).limit(limit)


def due_work(latest: DataFrame, state: DataFrame, now: Column, max_attempts: int, limit: int, key: str | None = None) -> DataFrame:
    """Like ``select_work`` for a state with claims: no live lease, next attempt due, attempts left.

    One ``key`` asks for that declaration in whatever state it is, unless somebody holds it.
    """
    known = state.select("rcno", F.lit(True).alias("known"), "status", *[c for c in CLAIM if c != "claim_last_error"])
    free = F.col("claim_owner").isNull() | (F.col("claim_lease_until") < now)
    due = (F.col("claim_next_attempt_at").isNull() | (F.col("claim_next_attempt_at") <= now)) & (F.col("claim_attempts") < max_attempts)
    wanted = F.col("known").isNull() | (F.col("status").isin("PENDING", "STALE") & due) if key is None else F.col("rcno") == key
    found = latest.join(known, "rcno", "left").where(free & wanted).withColumn("claim_attempts", F.coalesce("claim_attempts", F.lit(0)))
    return found.orderBy(F.desc("processed_date"), F.desc("source_item_id")).limit(limit).drop("known")


def remaining(ledger: DataFrame, state: DataFrame) -> DataFrame:
    """(missing, pending, stale) counts."""
    missing = ledger.select("rcno").distinct().join(state.select("rcno"), "rcno", "left_anti").agg(F.count("*").alias("missing"))
    return missing.crossJoin(state.agg(F.count_if(F.col("status") == "PENDING").alias("pending"), F.count_if(F.col("status") == "STALE").alias("stale")))


def apply_results(state: DataFrame, results: DataFrame, key: str, fence: list[str], values: list[str]) -> DataFrame:
    """State with the values of results whose fence still matches null-safely."""
    r = results.select(key, *[F.col(c).alias(f"_f_{c}") for c in fence], *[F.col(c).alias(f"_v_{c}") for c in values], F.lit(True).alias("_hit"))
    joined = state.join(r, key, "left")
    ok = F.coalesce(F.col("_hit"), F.lit(False))
    for c in fence:
        ok = ok & F.col(c).eqNullSafe(F.col(f"_f_{c}"))
    changed = {c: F.when(ok, F.col(f"_v_{c}")).otherwise(F.col(c)) for c in values}
    return joined.withColumn("applied", ok).withColumns(changed).drop("_hit", *[f"_f_{c}" for c in fence], *[f"_v_{c}" for c in values])


def rejected_results(state: DataFrame, results: DataFrame, key: str, fence: list[str]) -> DataFrame:
    """Results whose key the state lacks or whose fence no longer matches it: what ``apply_results`` does not write."""
    s, r = state.alias("s"), results.alias("r")
    same = F.col(f"s.{key}") == F.col(f"r.{key}")
    for c in fence:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}"))
    return r.join(s, same, "left_anti")


def merge_selection(selected: Column, auto: Column) -> Column:
    """A manual choice stays; else the automatic one."""
    return F.coalesce(selected, auto)


def review_status(status: Column) -> Column:
    return F.when(status == "REVIEW_REQUIRED", "PENDING").otherwise("NOT_REQUIRED")


def carry_linked_at(old_id: Column, old_source: Column, new_id: Column, new_source: Column, linked_at: Column, now: Column) -> Column:
    """Unlinked: null; unchanged: the old time; else now."""
    same = old_id.eqNullSafe(new_id) & old_source.eqNullSafe(new_source)
    return F.when(new_id.isNull(), F.lit(None)).when(same, linked_at).otherwise(now)


def declaration_details(state: DataFrame, items: DataFrame) -> DataFrame:
    """State with the columns of its source item, prefixed ``source_``."""
    source = items.select(*[F.col(c).alias(f"source_{c}") for c in items.columns])
    return state.join(source, F.col("source_item_id_ref") == F.col("source_item_id"))


def orphans(state: DataFrame, items: DataFrame) -> DataFrame:
    """State rows whose source item is missing or carries another key."""
    source = items.select(F.col("item_id").alias("source_item_id"), F.col("rcno").alias("item_rcno"))
    return state.join(source, "source_item_id", "left").where(~F.col("rcno").eqNullSafe(F.col("item_rcno"))).drop("item_rcno")
