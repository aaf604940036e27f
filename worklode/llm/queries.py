"""The named queries of this subpackage: each applies one operator to its whole table, as ``fn(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklode.llm import bit_slices, chat, language, merkle, mixing_lm, pii, piece_bpe, quality_forest, simhash, source_mix, token_counts, whitening, wrappers
from worklode.llm.common import remainder, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for each vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    return bit_slices.search(bit_slices.build_index(rows), rows.filter(F.col("vec_id") % 50 == 0), k=5)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles of every document, linked at 4 or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, budget=4)


def op3_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned from six sevenths of them."""
    held_out = remainder("doc_id", 7) == 2
    out = mixing_lm.score_documents(table(spark, sf_dir, "documents"), ~held_out)
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    return out.select("doc_id", (~F.col("in_training")).alias("held_out"), *columns)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = (remainder("doc_id", 3) == 1).alias("held_out")
    model = language.fit(docs.filter(~held_out))
    out = language.identify(docs, model)
    return out.select("doc_id", held_out, "lang_pred", "score", "rejected")


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of every document that bring good and poor tokens to nine to one and toxic ones to none."""
    labelled = source_mix.label_domains(table(spark, sf_dir, "labels"))
    return source_mix.mix(table(spark, sf_dir, "documents"), labelled, {"good": 0.9, "poor": 0.1, "toxic": 0.0})


def op9_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document, calibrated on the labels."""
    return quality_forest.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds the template's own marks, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], rows.schema)
    return chat.read_back(chat.format_conversations(rows.unionByName(own))).drop("attachment_tokens")


def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document; over the limit are those of more than 4096."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECES)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; the ids and the decoded text as digests."""
    return piece_bpe.round_trip(table(spark, sf_dir, "documents"), PIECES)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a leaf below its source's root; half of them lose their line feeds and are checked by their proofs."""
    docs = table(spark, sf_dir, "documents")
    touched = F.when(remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    built = merkle.build(docs, ["doc_id", "source", "lang", "n_chars", "text"], altered={"text": touched})
    return merkle.check(built.proofs)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every vector, fitted on all of them."""
    rows = table(spark, sf_dir, "embeddings")
    out = whitening.whiten(rows, whitening.fit(rows), k=8)
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans as counts and digest, and all spans."""
    return pii.digests(pii.find_personal_data(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bit_sliced_top_k": op1_bit_sliced_top_k,
    "op2_simhash": op2_simhash,
    "op3_mixing_lm": op3_mixing_lm,
    "op4_language": op4_language,
    "op5_chat": op5_chat,
    "op6_wrappers": op6_wrappers,
    "op8_source_mix": op8_source_mix,
    "op9_quality_forest": op9_quality_forest,
    "op7_token_counts": op7_token_counts,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_pii": op13_pii,
}

SQL: dict[str, str] = {
    "op1_bit_sliced_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
            from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
        )
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
        from s qualify rank <= 5
    """,
    "op5_chat": r"""
        with own as (select unnest(['user', 'assistant']) as role, '\### Assistant: </turn> ok' as text), t as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, case role when 'user' then 0 else 1 end, role, text from own
        ), e as (
            select *,
                replace(replace(replace(replace(text, '\', '\\'), '###', '\#\#\#'), '</turn>', '\</turn>'), '<|', '\<|') as t,
                replace(replace(replace(replace(replace(role, '\', '\\'), '###', '\#\#\#'), '</turn>', '\</turn>'), '<|', '\<|'),
                    ':', '\:') as r
            from t
        )
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
            cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
            cast(sum(length('### ' || r || ': ' || t || '</turn>' || chr(10))) as bigint) as formatted_chars
        from e group by conv_id
    """,
    "op11_merkle": r"""
        with recursive d as (
            select row_number() over () as rid, *, cast(doc_id as varchar) as i from documents
        ), bits as (
            select *, list_reduce(
                flatten(list_transform(range(length(i)), lambda k: [cast(ascii(i[k + 1]) as bigint), 0, 0, 0, 0, 0, 0, 0])),
                lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384), 4294967295::bigint) & 1 = 1 as odd_before
            from d
        ), x as (
            select *, case when odd_before then replace(text, chr(10), '') else text end as touched,
                coalesce(strlen(i) || ':' || i, '-') || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head
            from bits
        ), h as (
            select rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
                sha256(head || coalesce(strlen(touched) || ':' || touched, '-')) as held from x
        ), g as (
            select source, count(*) as n, row_number() over (order by source nulls first) - 1 as tree from h group by source
        ), r as (
            select rid, doc_id, leaf, held, tree, n, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as j
            from h join g on h.source is not distinct from g.source
        ), lv(tree, lev, j, n, digest) as (
            select tree, 0, j, n, leaf from r
            union all
            select tree, lev + 1, j // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by j)) from lv where n > 1
            group by tree, lev, j // 3, n
        ), tp(lev, j, n, digest) as (
            select 0, tree, (select count(*) from g), digest from lv where n = 1
            union all
            select lev + 1, j // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by j)) from tp where n > 1 group by lev, j // 3, n
        ), st as (
            select rid, lev, coalesce(string_agg(digest, '' order by lv.j) filter (lv.j < r.j // cast(pow(3, lev) as bigint)), '') as before,
                coalesce(string_agg(digest, '' order by lv.j) filter (lv.j > r.j // cast(pow(3, lev) as bigint)), '') as after
            from r join lv on r.tree = lv.tree and lv.n > 1 and lv.j // 3 = r.j // cast(pow(3, lev + 1) as bigint) group by rid, lev
            union all
            select rid, 1000 + lev, coalesce(string_agg(digest, '' order by tp.j) filter (tp.j < tree // cast(pow(3, lev) as bigint)), ''),
                coalesce(string_agg(digest, '' order by tp.j) filter (tp.j > tree // cast(pow(3, lev) as bigint)), '')
            from r join tp on tp.n > 1 and tp.j // 3 = tree // cast(pow(3, lev + 1) as bigint) group by rid, lev
        ), nr as (
            select *, row_number() over (partition by rid order by lev) as k from st
        ), fo(rid, k, cur) as (
            select rid, 0, held from r
            union all
            select fo.rid, fo.k + 1, sha256(before || cur || after) from fo join nr on nr.rid = fo.rid and nr.k = fo.k + 1
        ), z as (
            select rid, arg_max(cur, k) as folded_root from fo group by rid
        ), pf as (
            select rid, string_agg(before || after, '' order by k) as proof from nr group by rid
        )
        select doc_id, leaf, s.digest as subroot, t.digest as root, sha256(coalesce(proof, '')) as proof_sha256, folded_root,
            folded_root = t.digest as verified
        from r join z on z.rid = r.rid left join pf on pf.rid = r.rid join lv s on s.tree = r.tree and s.n = 1
        join tp t on t.n = 1
    """,
}
