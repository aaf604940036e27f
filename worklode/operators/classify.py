"""Sectors, roles and skills from text, with word lists held as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.functions import fixed_values as fixed
from worklode.functions.text import first_group_hit, matching_sector_name, untagged_title
from worklode.operators.dictionaries import bind, contained
from worklode.operators.ranking import best_per_key


def assign_sector(
    df: DataFrame, company: str, title: str,
    company_words: dict[str, list[str]] = fixed.COMPANY_SECTOR_WORDS, title_words: dict[str, list[str]] = fixed.TITLE_SECTOR_WORDS,
) -> DataFrame:
    """Sector by company name, else by title, else unknown; with method and confidence.

    The hits are generated, not projected, so filters on the outcome do not search the texts again.
    """
    hits = F.struct(first_group_hit(F.col(company), company_words).alias("_by_company"), first_group_hit(F.col(title), title_words).alias("_by_title"))
    found = df.select("*", F.inline(F.array(hits)))
    by_company, by_title = F.col("_by_company").isNotNull(), F.col("_by_title").isNotNull()
    return found.withColumns(
        {
            "sector": F.coalesce("_by_company", "_by_title", F.lit("unknown")),
            "assignment_method": F.when(by_company, "company_pattern").when(by_title, "title_keyword").otherwise("no_match"),
            "sector_confidence": F.when(by_company, fixed.COMPANY_SECTOR_CONFIDENCE)
            .when(by_title, fixed.TITLE_SECTOR_CONFIDENCE).otherwise(0.0),
        }
    ).drop("_by_company", "_by_title")


def score_sectors(df: DataFrame, key: str, title: str, description: str, dictionary: DataFrame, threshold: int = 1) -> DataFrame:
    """Best and second sector by keyword hits: 2 per word in the title, 1 per word in the description.

    ``dictionary``: sector_id, words; any number of both.  Equal scores go to the lower id; below the threshold the sector is
    -1 and the second is null.  ``key`` is unique.
    """
    words = dictionary.select("sector_id", F.explode("words").alias("_w"))
    fields = F.inline(F.array(*[F.struct(F.lit(n).alias("_points"), F.lower(c).alias("_t")) for c, n in ((title, 2), (description, 1))]))
    hits = contained(df.select(key, fields).filter("_t is not null"), [key, "_points"], "_t", words, "_w")
    scores = hits.join(words, "_w").groupBy(key, "sector_id").agg(F.sum("_points").cast("int").alias("_s")).filter(F.col("_s") >= threshold)
    top = best_per_key(scores, [key], [F.desc("_s"), F.asc("sector_id")], 2)
    best = top.groupBy(key).agg(F.sort_array(F.collect_list(F.struct((-F.col("_s")).alias("n"), "sector_id"))).alias("_b"))
    first, second = F.get("_b", F.lit(0)), F.get("_b", F.lit(1))
    return df.join(best, key, "left").withColumns(
        {
            "sector_id": F.coalesce(first["sector_id"], F.lit(-1)),
            "sector_score": F.coalesce(-first["n"], F.lit(0)),
            "second_sector_id": second["sector_id"],
        }
    ).drop("_b")


def evidence(text: Column, word: Column, around: int = 30) -> Column:
    """The first place of a word with up to ``around`` characters of its line on both sides.

    Where the word comes again within ``around`` characters of where the excerpt starts, the excerpt reaches on from there.
    """
    n = F.length(word)

    def line_start(w: Column) -> Column:
        before = F.substring_index(F.substring(w["near"], F.lit(1), w["lead"]), "\n", -1)
        return F.substring(w["near"], w["lead"] - F.length(before) + 1, F.length(w["near"]))

    def excerpt(near: Column) -> Column:
        room = F.length(F.substring_index(F.substring(near, 1, around), "\n", 1)) + n
        last = bind(F.substring(near, F.lit(1), room), lambda x: F.length(x) + 1 - F.position(F.reverse(word), F.reverse(x)))
        return bind(last, lambda end: F.concat(F.substring(near, F.lit(1), end), F.substring_index(F.substring(near, end + 1, F.lit(around)), "\n", 1)))

    def window(first: Column) -> Column:
        lead = F.least(first - 1, F.lit(around))
        return F.struct(F.substring(text, first - lead, lead + n + 2 * around).alias("near"), lead.alias("lead"))

    first = F.position(word, text)
    return bind(bind(bind(first, window), line_start), excerpt)


def extract_skills(df: DataFrame, key: str, text: Column, dictionary: DataFrame, sector: Column | None = None, whole_words: bool = False) -> DataFrame:
    """One row per (record, skill): the skill's first keyword found, with up to 30 characters around it.

    ``dictionary``: skill, words, sector, ord; any number of skills and words.  Entries without a sector apply to all, the
    others to their own sector and, for two-digit codes, to sectors sharing the first digit.  Keywords are plain text, found
    anywhere or as whole words.  ``key`` is unique.
    """
    code = sector if sector is not None else F.lit(None).cast("string")
    lines = df.select(key, F.lower(text).alias("_t"), code.alias("sector_context")).filter("_t is not null")
    words = dictionary.select("ord", "skill", "sector", F.posexplode("words").alias("_no", "_w"))
    hits = contained(lines, [key], "_t", words, "_w")
    if whole_words:
        edge = r"[\p{L}\p{N}]"
        quoted = F.concat(F.lit(rf"(?<!{edge})\Q"), "_w", F.lit(rf"\E(?!{edge})"))
        hits = hits.join(lines.select(key, "_t"), key).filter(F.regexp_like("_t", quoted)).select(key, "_w")
    context, own = F.col("sector_context"), F.col("sector")
    family = (F.length(context) == 2) & (F.left(own, F.lit(1)) == F.left(context, F.lit(1)))
    known = hits.join(words, "_w").join(lines.select(key, "sector_context"), key)
    known = known.filter(own.isNull() | F.coalesce((own == context) | family, F.lit(False)))
    first = known.groupBy(key, "ord", "skill").agg(F.min(F.struct("_no", "_w"))["_w"].alias("skill_raw"))
    listed = first.groupBy(key).agg(F.collect_list(F.struct("skill", "skill_raw")).alias("_s"))
    # The text meets all skills of its record at once.
    shown = F.transform("_s", lambda s: F.struct(s["skill"].alias("skill"), s["skill_raw"].alias("skill_raw"), evidence(F.col("_t"), s["skill_raw"]).alias("evidence")))
    return listed.join(lines, key).select(key, "sector_context", F.inline(shown)).select(
        key, "skill", "skill_raw", "evidence", F.lit("KEYWORD").alias("extraction_method"), F.lit(0.95).alias("confidence"), "sector_context"
    )


def match_roles(titles: DataFrame, title: str, dictionary: DataFrame, patterns: list[tuple[str, str, float]] = fixed.ROLE_PATTERNS) -> DataFrame:
    """Canonical role, confidence and method for every distinct title.

    ``dictionary``: alias, role, boost, and its priority in ord; any number of aliases.  Exact alias first; else the alias
    with the best substring score (equal scores: the earlier alias); else title patterns.
    """
    distinct = titles.select(title).distinct().withColumn("_t", untagged_title(F.col(title)))
    cleaned = distinct.filter("_t is not null").select("_t").distinct()
    aliases = dictionary.filter(F.length("alias") >= 4).select("alias").distinct()
    inside = contained(cleaned, ["_t"], "_t", aliases, "alias").withColumn("_inside", F.lit(True))
    around = contained(aliases, ["alias"], "alias", cleaned.filter(F.length("_t") >= 5), "_t").withColumn("_inside", F.lit(False))
    around = around.filter(F.col("_t") != F.col("alias"))
    share = F.length("alias").cast("double") / F.length("_t").cast("double")
    score = F.when(F.col("_inside") & (share >= 0.2), F.col("boost") * 0.95 * F.least(share * 1.5, F.lit(1.0)))
    score = score.when(~F.col("_inside") & (1 / share >= 0.4), F.col("boost") * 0.9)
    close = inside.unionByName(around).join(dictionary, "alias").withColumn("_score", score).filter("_score is not null")
    close = close.select("_t", F.lit(1).alias("_rank"), "_score", "ord", "role", F.lit("dictionary_fuzzy").alias("method"))
    exact = cleaned.join(dictionary, F.col("_t") == F.col("alias"))
    exact = exact.select("_t", F.lit(0).alias("_rank"), F.col("boost").alias("_score"), "ord", "role", F.lit("dictionary").alias("method"))
    # Of exact aliases the first counts, of the others the best.
    order = F.struct("_rank", F.when(F.col("_rank") == 1, -F.col("_score")).alias("_by"), "ord", "role", "_score", "method")
    best = close.unionByName(exact).groupBy("_t").agg(F.min(order).alias("_b"))
    hit = F.struct(F.col("_b.role").alias("role"), F.col("_b._score").alias("confidence"), F.col("_b.method").alias("method"))

    by_pattern = F.lit(None).cast("struct<role:string,confidence:double,method:string>")
    for pattern, role, confidence in reversed(patterns):
        found = F.struct(F.lit(role).alias("role"), F.lit(confidence).alias("confidence"), F.lit("regex").alias("method"))
        by_pattern = F.when(F.col(title).rlike(pattern), found).otherwise(by_pattern)
    matched = distinct.join(best, "_t", "left").withColumn("_m", F.when(F.col("_b").isNotNull(), hit).otherwise(by_pattern))
    return matched.select(title, F.col("_m.role").alias("role"), F.col("_m.confidence").alias("confidence"), F.col("_m.method").alias("method"))


def normalize_sectors(
    labels: DataFrame, label: str, keywords: DataFrame, taxonomy: DataFrame, level_cap: int = 4, threshold: float = 0.8
) -> DataFrame:
    """Taxonomy code per distinct sector label.

    ``keywords``: keyword, code, level; any number.  Exact keyword (1.0), else a keyword containing or contained in the
    label (0.85, the deepest level wins, then the lower code).  Codes below ``level_cap`` roll up to their parent at 0.9 of
    the confidence.  ``taxonomy``: code, name, level, parent_code.
    """
    distinct = labels.select(label).distinct().withColumn("_t", matching_sector_name(F.col(label)))
    cleaned = distinct.filter("_t <> ''").select("_t").distinct()
    listed = keywords.select("keyword").distinct()
    either = contained(cleaned, ["_t"], "_t", listed, "keyword").union(
        contained(listed, ["keyword"], "keyword", cleaned, "_t").select("_t", "keyword")
    ).distinct()
    order = F.struct((F.col("keyword") != F.col("_t")).alias("part"), (-F.col("level")).alias("l"), "code")
    best = either.join(keywords, "keyword").groupBy("_t").agg(F.min(order).alias("_b"))
    partial = F.col("_b.part")
    hit = distinct.join(best, "_t", "left").select(
        label, F.col("_b.code").alias("code"), F.when(partial, "partial_keyword").when(~partial, "exact_keyword").alias("method"),
        F.when(partial, 0.85).when(~partial, 1.0).alias("confidence"),
    )
    own = taxonomy.select("code", F.col("level").alias("_level"), F.col("parent_code").alias("_parent"))
    up = hit.join(own, "code", "left")
    rolled = (F.col("_level") > level_cap) & F.col("_parent").isNotNull()
    up = up.withColumns(
        {
            "method": F.when(rolled, "hierarchical_rollup").otherwise(F.col("method")),
            "confidence": F.when(rolled, F.col("confidence") * 0.9).otherwise(F.coalesce("confidence", F.lit(0.0))),
            "code": F.when(rolled, F.col("_parent")).otherwise(F.col("code")),
        }
    ).drop("_level", "_parent")
    named = taxonomy.select("code", F.col("name").alias("sector_name"), F.col("level").alias("sector_level"), "parent_code")
    return up.join(named, "code", "left").withColumn("accepted", F.col("confidence") >= threshold)


def skill_key(name: Column) -> Column:
    """What names of one skill share: case and spacing do not count."""
    return F.lower(F.trim(F.regexp_replace(name, r"\s+", " ")))


def sync_catalog(sources: DataFrame, catalog: DataFrame) -> DataFrame:
    """Merge skill sources into the catalog.  ``sources``: skill_name, category, priority (0 = canonical,
    larger is weaker); ``catalog``: skill_id, skill_name, category.  One row per normalized name, the
    strongest source wins; known skills keep their id, new ids are hashes of the name."""
    normal = skill_key(F.col("skill_name"))
    best = best_per_key(
        sources.withColumn("normal", normal).filter("normal <> ''"), ["normal"],
        [F.asc("priority"), F.asc("skill_name"), F.asc("category")],
    )
    known = catalog.withColumn("normal", normal).groupBy("normal").agg(
        F.min(F.struct("skill_id", F.col("skill_name").alias("_n"), F.col("category").alias("_c"))).alias("_k")
    )
    both = best.join(known, "normal", "full")
    return both.select(
        F.coalesce(F.col("_k.skill_id"), F.concat(F.lit("skill_"), F.md5("normal"))).alias("skill_id"),
        F.coalesce("skill_name", F.col("_k._n")).alias("skill_name"), F.coalesce("category", F.col("_k._c")).alias("category"),
        F.when(F.col("_k").isNull(), "NEW").when(F.col("skill_name").isNull(), "KEPT").otherwise("UPDATED").alias("sync_state"),
    )


def skill_evidence(mappings: DataFrame, catalog: DataFrame, name: str) -> DataFrame:
    """Catalog id for every extracted skill by case- and space-insensitive name; unknown names get a hash id."""
    lookup = catalog.groupBy(skill_key(F.col("skill_name")).alias("_n")).agg(F.min("skill_id").alias("_id"))
    joined = mappings.withColumn("_n", skill_key(F.col(name))).join(lookup, "_n", "left")
    fallback = F.concat(F.lit("skill_"), F.md5("_n"))
    return joined.withColumn("is_catalogued", F.col("_id").isNotNull()).withColumn(
        "skill_id", F.coalesce("_id", fallback)
    ).drop("_id", "_n")


def lookup_group(df: DataFrame, column: str, groups: DataFrame, key: str, outs: list[str], unknown: str = "Other") -> DataFrame:
    """Carry group columns (category to sector to industry group) over by equality, with a default."""
    joined = df.join(groups.select(F.lower(F.trim(key)).alias("_k"), *outs), F.lower(F.trim(column)) == F.col("_k"), "left")
    return joined.fillna(unknown, outs).drop("_k")
