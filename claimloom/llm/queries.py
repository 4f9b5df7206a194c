"""One query for each operator: the tables read, production parameters, and the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    common,
    decontamination,
    fingerprints,
    language_id,
    mixing,
    piece_bpe,
    secret_scan,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
    topk,
    whitening,
)

#: Tokenizer files; any other path works, the files are read where tasks run.
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
END_OF_TEXT = 50256


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of each document, counted in flat token files of the whole table.

    (doc_id, n_tokens, file, place, token_start): where its first token lies in which file.
    """
    blocks = common.stored(
        token_counts.flatten(
            common.table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE),
            public_tokenizers.PATTERN, END_OF_TEXT,
        ),
        "flat-tokens",
    )
    counts = token_counts.count_tokens(blocks, END_OF_TEXT)
    return counts.join(token_counts.named(blocks), ["file", "place"]).select(
        "doc_id", "n_tokens", "file", "place", F.col("start").alias("token_start")
    )


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(common.table(spark, folder, "documents"))
    named = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: ~s["kind"].startswith("like_"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secret_scan.BASE),
        F.sha2(F.concat_ws(",", F.transform(base, named)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", named)).alias("spans"),
    )


def op3_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_by_bytes(common.table(spark, folder, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(common.table(spark, folder, "documents"), 3, 2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(common.table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5, 256.0)


def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(common.table(spark, folder, "documents"), (1, 2, 3), 3)
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source", "copies",
    )


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = substring_dedup.dedup_substrings(common.table(spark, folder, "documents"), 35)
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_BPE)
    docs = common.documents(common.table(spark, folder, "documents"), "text")
    return piece_bpe.digest(piece_bpe.encode_and_decode(docs, path))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = language_id.identify(common.table(spark, folder, "documents"))
    return found.select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred", "score", "ambiguous",
    )


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.with_next(common.table(spark, folder, "documents"))


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.occurrences(
        common.table(spark, folder, "documents"), common.table(spark, folder, "benchmark"), 10
    )
    return found.select(
        "doc_id", "n_words", decontamination.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("ranges") > 0).alias("contaminated"),
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_rows(common.table(spark, folder, "embeddings"), 8)


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(common.table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: The other operators have no form in SQL: tokenizers, learned models, drawn copies, packing, hashes
#: that SQL does not offer. They are tested against plain versions in ``tests/llm``.
ORACLE_SQL: dict[str, str] = {
    "op5_top_k": """
with whole as (
    select vec_id, [floor(256 * cast(x as double)) for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from whole q join whole c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
ranked as (
    select query_id, vec_id, score,
        cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
    from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op11_decontamination": r"""
with lowered as (
    select row_number() over () as r, doc_id,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents),
split as (
    select r, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from lowered),
items as (
    select cast(item_id as varchar) as item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark where text is not null),
parts as (
    select item_id, least(10, len(words)) as n, words,
        unnest(range(1, greatest(len(words) - 10, 0) + 2)) as place
    from items where len(words) > 0),
strings as (
    select distinct item_id, n, array_to_string(words[place : place + n - 1], ' ') as string from parts),
places as (
    select r, n, words, unnest(range(1, len(words) - n + 2)) as place
    from split, (select distinct n from strings)),
found as (
    select r, place, p.n, item_id
    from (select r, n, place, array_to_string(words[place : place + n - 1], ' ') as string from places) p
    join strings s on p.n = s.n and p.string = s.string),
hit as (
    select r, count(distinct place) as n_hit
    from (select r, unnest(range(place, place + n)) as place from found) group by r),
named as (
    select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
    from (select distinct r, item_id from found where item_id is not null) group by r)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from split left join hit using (r) left join named using (r)""",
    "op7_substring_dedup": r"""
with split as (
    select row_number() over () as r, doc_id,
        [w for w in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if w <> ''] as words
    from documents),
placed as (
    select r, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from split),
windows as (
    select r, place, array_to_string(words[place : place + 34], ' ') as passage
    from (select r, words, unnest(range(1, len(words) - 33)) as place from split)),
again as (
    select r, place as first from windows
    where passage in (select passage from windows group by passage having count(*) > 1)),
covered as (
    select distinct r, unnest(range(first, first + 35)) as place from again),
kept as (
    select r, count(*) as n, string_agg(word, ' ' order by place) as rest
    from placed where (r, place) not in (select r, place from covered) group by r)
select doc_id, cast(len(words) as bigint) as n_words,
    cast(len(words) - coalesce(n, 0) as bigint) as n_removed,
    sha256(coalesce(rest, '')) as kept_sha256
from split left join kept using (r)""",
}
