"""Registered queries over matching, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.functions.lineage import cut
from tallybook.operators import match
from tallybook.sources import ledger

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_AGE = r"(?:\baged\s*)?([1-9][0-9]?)\s*(?:yo|y\.o\.?|y(?:ears?)?(?:\s*old)?)\b"
#: Scores of products: names against names, all pairs, then attributes; the operator blocks instead.
_SCORES = f"""WITH refs AS ({ledger.ALCOHOLS}), ins AS ({ledger.WANTED}),
i AS (SELECT *, trim(regexp_replace(lower(regexp_replace(base_name_en, '{_AGE}', ' ', 'gi')), '[^a-z0-9]+', ' ', 'g')) x, CAST(nullif(regexp_extract(base_name_en, '(?i){_AGE}', 1), '') AS INTEGER) in_age FROM ins),
p AS (SELECT input_id, id, i.abv_percent in_abv, r.abv_percent ref_abv, in_age, r.age_years ref_age, unit_volume_ml in_volume, CASE r.volume WHEN '70cl' THEN 700 END ref_volume, i.category in_category, r.category ref_category, distillery_id, region_id,
  string_split(x, ' ') sx, string_split(eng_name, ' ') sy, x, eng_name y FROM i CROSS JOIN refs r),
e AS (SELECT *, CASE WHEN x = y THEN 8.0 WHEN contains(' ' || x || ' ', ' ' || y || ' ') OR contains(' ' || y || ' ', ' ' || x || ' ') THEN 5.0 WHEN len(list_intersect(sx, sy)) >= 0.6 * len(list_distinct(list_concat(sx, sy))) THEN 2.5 END w,
  CASE WHEN in_age = ref_age THEN 3.0 WHEN in_age <> ref_age THEN -6.0 ELSE 0 END wa, CASE WHEN abs(in_abv - ref_abv) <= 0.05 THEN 2.5 WHEN abs(in_abv - ref_abv) <= 0.5 THEN 1.0 ELSE -4.0 END wb,
  CASE WHEN in_volume = ref_volume THEN 1.0 WHEN in_volume <> ref_volume THEN -0.5 ELSE 0 END wv, (in_category = '브랜디') <> (ref_category = 'Brandy') wrong FROM p),
s AS (SELECT *, CAST(w + wa + wb + wv AS DOUBLE) score, CASE WHEN w = 8 THEN 4 ELSE 2 END + CASE WHEN in_age = ref_age THEN 2 WHEN in_age <> ref_age THEN 1 ELSE 0 END + CASE WHEN wb = 2.5 THEN 2 ELSE 1 END + CASE WHEN wv <> 0 THEN 1 ELSE 0 END strength,
  coalesce(in_age <> ref_age, false) OR wb = -4.0 conflict FROM e WHERE w IS NOT NULL AND NOT wrong),
k AS (SELECT *, row_number() OVER (PARTITION BY input_id ORDER BY score DESC, strength DESC, id) rank, max(score) OVER (PARTITION BY input_id) top FROM s),
c AS (SELECT input_id, max(top) top_score, min(CASE WHEN rank = 1 THEN id END) top_id, bool_or(rank = 1 AND conflict) conflict, max(top) - max(CASE WHEN rank = 2 THEN score END) margin, count(*) FILTER (score >= 10 AND top - score < 3) competitive FROM k GROUP BY 1),
d AS (SELECT *, CASE WHEN conflict THEN 'A_ATTRIBUTE_CONFLICT' WHEN top_score >= 10 AND competitive > 1 THEN 'A_AMBIGUOUS' WHEN top_score >= 10 AND coalesce(margin >= 3, true) THEN 'A_UNIQUE_STRONG' ELSE 'A_WEAK' END stop_reason FROM c)
"""


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _ranked(spark, d):
    """Ranked candidates of profiles, the inputs of each profile, and the products."""
    alcohols, distilleries, regions = ledger.references(spark, d)
    kinds, members = match.profiles(ledger.wanted(spark, d))
    return match.rank(match.score_alcohols(cut(kinds), alcohols, cut(match.build_name_index(alcohols, distilleries, regions)))), members, alcohols


def _matched(spark, d):
    inputs = ledger.wanted(spark, d)
    return inputs, match.match(inputs, *ledger.references(spark, d))


@query(f"WITH refs AS ({ledger.ALCOHOLS}) SELECT id, age_years ref_age, CAST(NULL AS VARCHAR) ref_conflict FROM refs")
def e4_reference_age(spark, d):
    return match.reference_age(ledger.references(spark, d)[0]).select("id", "ref_age", "ref_conflict")


@query(f"""WITH a AS ({ledger.ALCOHOLS}), m AS ({ledger.DISTILLERIES}), r AS ({ledger.REGIONS})
 SELECT 'ALCOHOL' entity, id, 'alcohol_en' AS label, lower(eng_name) base_key FROM a UNION ALL SELECT 'DISTILLERY', id, 'distillery_en', lower(eng_name) FROM m UNION ALL SELECT 'REGION', id, 'region_en', lower(eng_name) FROM r""")
def e6_name_index(spark, d):
    return match.build_name_index(*ledger.references(spark, d)).select("entity", "id", "label", "base_key")


@query(_SCORES + "SELECT input_id, id, score, CAST(strength AS INTEGER) strength, CAST(rank AS INTEGER) AS rank FROM k")
def e16_scored_candidates(spark, d):
    ranked, members, _ = _ranked(spark, d)
    return match.told(ranked.select("input_id", "id", "score", "strength", "rank"), members)


@query(_SCORES + "SELECT input_id, " + ", ".join(f"max(CASE WHEN rank = {k} THEN {c} END) candidate_{k}_{c}" for k in (1, 2, 3) for c in ("id", "score")) + " FROM k WHERE rank <= 3 GROUP BY 1")
def e18_top_three(spark, d):
    ranked, members, _ = _ranked(spark, d)
    return match.told(match.top3(ranked), members)


@query(_SCORES + """SELECT input_id, CASE stop_reason WHEN 'A_ATTRIBUTE_CONFLICT' THEN 'CONFLICT_REVIEW' WHEN 'A_AMBIGUOUS' THEN 'AMBIGUOUS' WHEN 'A_UNIQUE_STRONG' THEN 'AUTO_SELECTED' ELSE 'REVIEW' END decision, stop_reason,
 CASE WHEN stop_reason = 'A_UNIQUE_STRONG' THEN top_id END selected_id, top_score, CAST(margin AS DOUBLE) margin, competitive FROM d""")
def e20_match_names(spark, d):
    ranked, members, _ = _ranked(spark, d)
    return match.told(match.decide_alcohol(ranked).select("input_id", "decision", "stop_reason", "selected_id", "top_score", "margin", "competitive"), members)


@query(_SCORES + """SELECT input_id, CASE WHEN min(distillery_id) = max(distillery_id) THEN min(distillery_id) ELSE 0 END distillery_id, CASE WHEN min(region_id) = max(region_id) THEN min(region_id) ELSE 0 END region_id
 FROM k WHERE score >= 10 AND top - score < 3 GROUP BY 1 HAVING count(*) > 1""")
def e21_consensus(spark, d):
    ranked, members, alcohols = _ranked(spark, d)
    return match.told(match.consensus(ranked, alcohols), members)


@query(f"""WITH a AS ({ledger.ALCOHOLS}), m AS ({ledger.DISTILLERIES}), r AS ({ledger.REGIONS}), n AS (SELECT distillery_id, region_id, count(*) n FROM a WHERE distillery_id IN (SELECT id FROM m) AND region_id IN (SELECT id FROM r) GROUP BY ALL)
 SELECT distillery_id, region_id, n, CAST(sum(n) OVER (PARTITION BY distillery_id) AS BIGINT) total, 4.0::DOUBLE * n / sum(n) OVER (PARTITION BY distillery_id) prior FROM n""")
def e23_maker_regions(spark, d):
    return match.region_prior(*ledger.references(spark, d))


@query(f"WITH RECURSIVE r AS ({ledger.REGIONS}), up AS (SELECT id, parent_id ancestor FROM r WHERE parent_id > 0 UNION SELECT up.id, r.parent_id FROM up JOIN r ON r.id = up.ancestor WHERE r.parent_id > 0) SELECT * FROM up")
def e24_region_ancestors(spark, d):
    return match.region_ancestors(ledger.references(spark, d)[2])


@query(f"WITH r AS ({ledger.REGIONS}), i AS ({ledger.WANTED}) SELECT input_id, id, manufacture_country country, lower(manufacture_country) AS name FROM i JOIN r ON lower(manufacture_country) = lower(eng_name) WHERE parent_id = 0")
def e25_country_roots(spark, d):
    alcohols, distilleries, regions = ledger.references(spark, d)
    return match.country_root(ledger.wanted(spark, d), match.build_name_index(alcohols, distilleries, regions), regions)


@query()
def e28_match(spark, d):
    inputs, matched = _matched(spark, d)
    return match.all_decisions(inputs, matched)


@query()
def e30_evidence(spark, d):
    inputs, matched = _matched(spark, d)
    return match.audit_frames(inputs, matched)["evidence"]


@query()
def e31_match_summary(spark, d):
    inputs, matched = _matched(spark, d)
    return match.match_summary(inputs, matched)
