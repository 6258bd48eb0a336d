"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import stages
from .byte_bpe import token_digests
from .decontaminate import overlaps
from .embedding_dedup import embedding_links
from .hard_negatives import hard_negatives
from .html_main import main_text
from .minhash_dedup import near_duplicates
from .mixing import mix
from .pii import pseudonymise
from .quality import quality_scores
from .secret_scan import secret_digest
from .suffix_dedup import remove_repeats
from .tables import Stages, read
from .token_align import alignment_scores
from .toxicity import toxicity_scores


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(read(spark, sf_dir, "embeddings"), Stages(spark, "op1"), threshold=0.93)


def op2_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), Stages(spark, "op2"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), Stages(spark, "op3"))


def op4_toxicity_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), Stages(spark, "op4"))


def op5_html_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"), Stages(spark, "op5"))


def op6_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"), Stages(spark, "op6"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


def op7_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymise(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_email", "n_ip", "n_phone", "n_card", "n_ssn", "n_date")


def op8_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), Stages(spark, "op8"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), Stages(spark, "op9"), length=50)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(read(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return token_digests(read(spark, sf_dir, "documents"), public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("case when vec_id % 7 = 0 then (cast(label as long) + 1) % 10 else label end")
    return hard_negatives(read(spark, sf_dir, "embeddings"), Stages(spark, "op12"), F.expr("vec_id % 50 = 0"), label=label)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    a, b = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
    return alignment_scores(read(spark, sf_dir, "documents"), Stages(spark, "op13"), a, b, public.PATTERN)


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_quality_pu, op3_minhash_near_dedup, op4_toxicity_weak_supervision, op5_html_template_extraction,
    op6_entropy_mixing, op7_pii_feistel, op8_spaced_seed_decontamination, op9_suffix_array_dedup, op10_secret_scan,
    op11_byte_bpe, op12_hard_negatives, op13_token_alignment,
)}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline

#: DuckDB SQL for the queries that SQL can express over whole tables.
ORACLES: dict[str, str] = {
    "op12_hard_negatives": """
        with e as (
            select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label, [floor(256 * x::double) for x in embedding] as q from embeddings
            where vec_id is not null and label is not null and embedding is not null and coalesce(list_bool_and([coalesce(isfinite(x), false) for x in embedding]), true)
        ), s as (
            select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, coalesce(list_sum([x[1] * x[2] for x in list_zip(a.q, b.q)]), 0)::bigint as score
            from e as a join e as b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)
        ), p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
        w as (
            select p.anchor_id, p.id as positive_id, row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) as rank,
                n.id as negative_id, p.score as positive_score, n.score as negative_score
            from p join s as n on n.anchor_id = p.anchor_id and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
        )
        select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from w where rank <= 3
    """,
}
