"""The operators on the whole of their tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonmart.llm import conversations, license_scan
from seasonmart.llm.bpe import token_digests
from seasonmart.llm.common import table
from seasonmart.llm.exact_dedup import exact_dedup
from seasonmart.llm.line_dedup import MAX_RATIO, MIN_SEEN, line_dedup
from seasonmart.llm.lm_scoring import lm_scores
from seasonmart.llm.mixing import OBSERVED, OTHERS, Targets, mix, topic
from seasonmart.llm.near_dedup import near_groups
from seasonmart.llm.sharding import shard
from seasonmart.llm.token_files import token_index
from seasonmart.llm.topk_search import exact_top_k
from seasonmart.llm.toxicity import toxicity

#: Target shares of the mixture: sources alike, languages and topics near their own shares. Sources
#: and languages not named, null included, keep theirs; only the topic 'empty' has no place in it.
TARGETS: Targets = {
    "source": {**{f"src{i}": 1.0 for i in range(20)}, OTHERS: OBSERVED},
    "lang": {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13, OTHERS: OBSERVED},
    "topic": {"prose": 0.94, "legal": 0.045, "contact": 0.015},
}
#: Share of all tokens that the mixture keeps. Cells that would need more than all their documents
#: keep all of them; the shares then miss their targets a little.
KEEP_SHARE = 0.6
#: Words of a shingle in the query for near copies.
NEAR_SHINGLE = 4


def tokenizer_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def mixing_dimensions() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic("text")}


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return line_dedup(docs, dropped="n_dropped").select("doc_id", "source", "n_dropped", "text")


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(table(spark, folder, "documents"))


def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return exact_top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mix(docs, TARGETS, mixing_dimensions(), keep_share=KEEP_SHARE).select(
        "doc_id", *(f"mix_{c}" for c in ("source", "lang", "topic", "tokens", "weight", "probability", "kept"))
    )


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard(table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"), tokenizer_file())


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_index(table(spark, folder, "documents"), tokenizer_file())


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"), size=NEAR_SHINGLE)


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents")).drop("places")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_topk_search": op3_topk_search,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_bpe": op7_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_token_files": op9_token_files,
    "op10_near_dedup": op10_near_dedup,
    "op12_license_scan": op12_license_scan,
    **conversations.QUERIES,
}

SQL: dict[str, str] = {
    "op1_line_dedup": f"""
with pages as (select doc_id, source, text, string_split(text, chr(10)) as lines from documents),
texts as (select distinct source, text, lines from pages where source is not null and text is not null),
counts as (
    select source, line, count(*) as seen
    from (select source, unnest(list_distinct(lines)) as line from texts)
    where trim(line, ' ') <> '' group by source, line
),
sites as (select source, count(*) as n from texts group by source),
rules as (
    select source, list(line) as drops
    from counts join sites using (source) where seen >= {MIN_SEEN} and seen > {MAX_RATIO}::double * n group by source
),
cleaned as (
    select doc_id, source, text, lines,
        list_filter(lines, lambda x: not list_contains(coalesce(drops, cast([] as varchar[])), x)) as kept
    from pages left join rules using (source)
)
select doc_id, source, coalesce(len(lines) - len(kept), 0) as n_dropped,
    case when len(kept) = len(lines) then text else coalesce(array_to_string(kept, chr(10)), '') end as text
from cleaned""",
    "op3_topk_search": """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x:
        x is null or isnan(x) or isinf(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id as vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
),
ranked as (
    select query_id, vec_id, score,
        cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
    from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op6_exact_dedup": """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id is not distinct from max(doc_id) over same as kept,
    sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))""",
    "op10_near_dedup": rf"""
with recursive split as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as words
    from documents
),
sets as (
    select doc_id, list_distinct(case
        when len(words) = 0 then cast([] as varchar[])
        when len(words) < {NEAR_SHINGLE} then [array_to_string(words, ' ')]
        else list_transform(range(1, len(words) - {NEAR_SHINGLE} + 2),
            lambda i: array_to_string(words[i:i + {NEAR_SHINGLE - 1}], ' ')) end) as shingles
    from split
),
single as (select doc_id, unnest(shingles) as shingle from sets),
common as (
    select a.doc_id as x, b.doc_id as y, count(*) as n
    from single a join single b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
),
links as (
    select x, y from common c join sets a on a.doc_id = c.x join sets b on b.doc_id = c.y
    where 100 * n >= 80 * (len(a.shingles) + len(b.shingles) - n)
),
edges as (select x, y from links union all select y, x from links),
reach as (
    select doc_id, doc_id as other from sets
    union
    select r.doc_id, b.y from reach r join edges b on b.x = r.other
),
components as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, cast(len(shingles) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sets join components using (doc_id)""",
    "op12_license_scan": license_scan.SQL,
    **conversations.SQL,
}
