"""Name matching: fuzzy join without a cross join, and cascades over the distinct names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.functions.text import matching_company_name
from worklode.operators.ranking import best_per_key


def allowed_edits(longest: Column, ratio: float) -> Column:
    """Largest edit distance d with 1 - d / longest >= ratio."""
    return F.floor(longest * F.lit(round(1 - ratio, 9)) + F.lit(1e-9)).cast("int")


def _pieces(df: DataFrame, name: str, size: int) -> DataFrame:
    """(name, piece, place) for the pieces of ``size`` characters of a name with ``size - 1`` marks on both ends."""
    marked = F.concat(F.lit("\u0002" * (size - 1)), F.col(name), F.lit("\u0003" * (size - 1)))
    cut = F.transform(F.sequence(F.lit(1), F.length(name) + (size - 1)), lambda i: F.substring(marked, i, F.lit(size)))
    return df.select(name, F.posexplode(cut).alias("_place", "_piece"))


def fuzzy_candidates(names: DataFrame, name: str, canon: DataFrame, canon_name: str, ratio: float = 0.85) -> DataFrame:
    """Pairs (name, canonical) that may have 1 - levenshtein / max length >= ratio, found by equi-joins over rare pieces.

    An edit changes q (two) of a name's q-character pieces at most, and moves the others by at most one place.  So two names at
    most t edits apart each have at most q * t pieces that are not kept in the other, and if the pieces of both are put in
    one order, one kept piece is among the first q * t + 1 of both, no more than t places apart.  The order is by rarity over
    all names: what most names share stands last, and is hardly ever among the first.  With t the most edits that a match of
    any length allows, nothing is missed; the ratio must be two thirds or more, so that every name has enough pieces.  A pair
    comes once for each such piece in common, and only if the lengths allow a match.
    """
    if ratio < 2 / 3:
        raise ValueError("names are matched at a ratio of two thirds or more")
    size = 2
    a = names.select(F.col(name).alias("_a")).distinct().filter("_a <> ''")
    c = canon.select(F.col(canon_name).alias("_c")).distinct().filter("_c <> ''")
    of_a, of_c = _pieces(a, "_a", size), _pieces(c, "_c", size)
    often = of_a.select("_piece").unionByName(of_c.select("_piece")).groupBy("_piece").count()

    def first(pieces: DataFrame, side: str) -> DataFrame:
        edits = F.floor(F.length(side) * F.lit(round((1 - ratio) / ratio, 9)) + F.lit(1e-6)).cast("int")
        ranked = pieces.join(often, "_piece").groupBy(side).agg(F.sort_array(F.collect_list(F.struct("count", "_piece", "_place"))).alias("_p"))
        return ranked.select(side, F.explode(F.slice("_p", F.lit(1), size * edits + 1)).alias("_p")).select(
            side, F.col("_p._piece").alias("_piece"), F.col("_p._place").alias(f"{side}_at")
        )

    la, lc = F.length("_a"), F.length("_c")
    edits = allowed_edits(F.greatest(la, lc), ratio)
    near = (F.greatest(la, lc) - F.least(la, lc) <= edits) & (F.abs(F.col("_a_at") - F.col("_c_at")) <= edits)
    return first(of_a, "_a").join(first(of_c, "_c"), "_piece").filter(near).select("_a", "_c")


def fuzzy_pairs(names: DataFrame, name: str, canon: DataFrame, canon_name: str, ratio: float = 0.85) -> DataFrame:
    """All (name, canonical) pairs with 1 - levenshtein / max length >= ratio, each once.

    Both sides are reduced to distinct names first.  The distance test is done where candidates are joined, so near misses
    never leave the join; skewed pieces are split by adaptive execution.
    """
    limit = allowed_edits(F.greatest(F.length("_a"), F.length("_c")), ratio)
    # With a limit the distance stops early and is -1 beyond it.
    near = F.call_function("levenshtein", F.col("_a"), F.col("_c"), limit) >= 0
    pairs = fuzzy_candidates(names, name, canon, canon_name, ratio).filter(near).select("_a", "_c").distinct()
    score = 1 - F.levenshtein("_a", "_c").cast("double") / F.greatest(F.length("_a"), F.length("_c")).cast("double")
    return pairs.select(F.col("_a").alias(name), F.col("_c").alias("matched_name"), score.alias("similarity"))


def fuzzy_best(names: DataFrame, name: str, canon: DataFrame, canon_name: str, ratio: float = 0.85) -> DataFrame:
    """Best canonical name per distinct name; equal scores go to the alphabetically first."""
    pairs = fuzzy_pairs(names, name, canon, canon_name, ratio)
    return best_per_key(pairs, [name], [F.desc("similarity"), F.asc("matched_name")])


def canonicalize(
    names: DataFrame, name: str, canon: DataFrame, aliases: DataFrame, ratio: float = 0.85, shortest: int = 3
) -> DataFrame:
    """Exact, then alias, then fuzzy match of company names; one row per row of ``names``.

    ``canon``: canonical_id, canonical_name.  ``aliases``: canonical_id, alias.  Only distinct normalized
    names are matched, each step sees what the steps before left over, and the result is joined back.
    Names of fewer than ``shortest`` characters are not matched; they come out as ``too_short``.
    """
    rows = names.withColumn("normalized_name", matching_company_name(F.col(name)))
    long = F.length("normalized_name") >= shortest
    todo = rows.filter(long).select("normalized_name").distinct()
    c = canon.withColumn("_c", matching_company_name(F.col("canonical_name")))
    exact = c.groupBy(F.col("_c").alias("normalized_name")).agg(F.min("canonical_id").alias("_exact"))
    alias = aliases.groupBy(matching_company_name(F.col("alias")).alias("normalized_name")).agg(
        F.min("canonical_id").alias("_alias")
    )
    known = todo.join(exact, "normalized_name", "left").join(alias, "normalized_name", "left")
    rest = known.filter(F.col("_exact").isNull() & F.col("_alias").isNull()).select("normalized_name")
    near = fuzzy_best(rest, "normalized_name", c, "_c", ratio)
    near = near.join(exact.withColumnRenamed("normalized_name", "matched_name"), "matched_name").select(
        "normalized_name", "similarity", F.col("_exact").alias("_fuzzy")
    )
    found = known.join(near, "normalized_name", "left").select(
        "normalized_name",
        F.coalesce("_exact", "_alias", "_fuzzy").alias("canonical_id"),
        F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_alias").isNotNull(), "alias")
        .when(F.col("_fuzzy").isNotNull(), "fuzzy").otherwise("no_match").alias("match_method"),
        F.when(F.col("_exact").isNotNull(), 1.0).when(F.col("_alias").isNotNull(), 0.95)
        .otherwise(F.coalesce("similarity", F.lit(0.0))).alias("confidence"),
    )
    titled = found.join(canon.select("canonical_id", "canonical_name"), "canonical_id", "left")
    joined = rows.join(titled, "normalized_name", "left")
    missing = F.coalesce("match_method", F.lit("too_short"))
    return joined.withColumns({"match_method": missing, "confidence": F.coalesce("confidence", F.lit(0.0))})


METHOD_NAMES = {"exact": "EXACT_MATCH", "alias": "ALIAS_MATCH", "fuzzy": "FUZZY"}


def company_outputs(matched: DataFrame, key: str, name: str, threshold: float = 0.75) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mapping, review queue, new canonical rows) of a canonicalization.

    Ids are hashes of business keys, so a rerun yields the same ids, and a new canonical row appears
    once per normalized name.
    """
    method = F.lit("MANUAL")
    for short, long in METHOD_NAMES.items():
        method = F.when(F.col("match_method") == short, long).otherwise(method)
    sure = F.col("confidence") >= threshold
    mapping = matched.filter(sure).select(
        F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("canonical_id").cast("string"))).alias("company_map_id"),
        key, "canonical_id", "canonical_name", method.alias("normalization_method"), "confidence",
        F.to_json(F.struct(F.col(name).alias("input"), F.col("normalized_name").alias("normalized"),
                           F.col("match_method").alias("method"))).alias("explanation_json"),
    )
    issue = F.when(F.col("match_method").isin("no_match", "too_short"), F.col("match_method")).otherwise("low_confidence")
    review = matched.filter(~sure).select(
        F.md5(F.concat_ws("|", F.lit("company"), F.col(key).cast("string"))).alias("review_id"), key,
        F.lit("company").alias("entity_type"), issue.alias("issue_type"), F.col(name).alias("value"), "normalized_name",
        F.col("canonical_id").alias("suggested_id"), "confidence", F.lit("pending").alias("status"),
    )
    fresh = matched.filter(F.col("match_method") == "no_match").groupBy("normalized_name").agg(
        F.min(name).alias("canonical_name")
    ).select(F.concat(F.lit("company_"), F.md5("normalized_name")).alias("company_id"), "canonical_name")
    return mapping, review, fresh


def low_confidence(scored: DataFrame, key: str, entity: str, label: str, confidence: str, threshold: float) -> DataFrame:
    """Review-queue rows for missing or weak assignments."""
    weak = F.col(label).isNull() | (F.col(confidence) < threshold)
    issue = F.when(F.col(label).isNull(), "no_match").otherwise("low_confidence")
    return scored.filter(weak).select(
        F.md5(F.concat_ws("|", F.lit(entity), F.col(key).cast("string"))).alias("review_id"), key,
        F.lit(entity).alias("entity_type"), issue.alias("issue_type"), F.col(label).alias("suggested"),
        F.coalesce(confidence, F.lit(0.0)).alias("confidence"), F.lit("pending").alias("status"),
    )


def apply_decisions(queue: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply reviewers' decisions.  ``decisions``: review_id, decision (approve, create, correct or
    reject), new_value.  Returns (queue', accepted mappings, audit rows); undecided rows stay pending."""
    given = decisions.select("review_id", "decision", "new_value")
    joined = queue.join(given, "review_id", "left")
    decided = F.col("decision").isNotNull() & (F.col("status") == "pending")
    outcome = F.when(F.col("decision") == "reject", "rejected").otherwise("resolved")
    state = joined.withColumn("status", F.when(decided, outcome).otherwise(F.col("status"))).select(*queue.columns)
    target = F.when(F.col("decision") == "approve", F.col("suggested")).when(
        F.col("decision").isin("create", "correct"), F.col("new_value")
    )
    taken = joined.filter(decided).withColumn("mapped_value", target)
    mappings = taken.filter(F.col("mapped_value").isNotNull()).select("review_id", "entity_type", "mapped_value", "decision")
    audit = taken.select("review_id", "decision", F.col("suggested").alias("old_value"), F.col("mapped_value").alias("new_value"))
    return state, mappings, audit
