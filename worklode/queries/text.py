"""Text rules, classification, name matching, identity and review queues."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklode.functions import fixed_values as fixed
from worklode.functions import text as tx
from worklode.operators import classify, identity, matching
from worklode.operators.dictionaries import literal_dictionary, match_words, table_dictionary
from worklode.plans.feed import AS_OF
from worklode.queries.registry import query
from worklode.session import cut_lineage

SUFFIXES = "|".join(fixed.COMPANY_SUFFIXES)


def norm_sql(col: str) -> str:
    return (rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim({col})), '[.,\-_]', ' ', 'g'), "
            rf"'\b({SUFFIXES})\b', '', 'g'), '\s+', ' ', 'g'))")  # fmt: skip


@query("stored_company_names", "T-01", r"""
    select name_id, trim(regexp_replace(regexp_replace(regexp_replace(upper(trim(raw_name)), '[,.]', '', 'g'),
           '\b(INC|LLC|LTD|GMBH)\b', '', 'g'), '\s+', ' ', 'g')) as stored_name from {raw_names}""")
def _(t):
    return t.raw_names.select("name_id", tx.stored_company_name(F.col("raw_name")).alias("stored_name"))


@query("matching_company_names", "T-02", f"""
    select name_id, {norm_sql("raw_name")} as normalized_name from {{raw_names}} where length({norm_sql("raw_name")}) >= 3""")
def _(t):
    named = t.raw_names.select("name_id", tx.matching_company_name(F.col("raw_name")).alias("normalized_name"))
    return named.filter(F.length("normalized_name") >= 3)


@query("titles_and_seniority", "T-03 T-15", """
    select p_partkey, upper(trim(p_name)) as title, case when p_name like '%old%' then 'SENIOR' else 'MID' end as level from {part}""")
def _(t):
    renamed = F.replace(F.col("p_name"), F.lit("old"), F.lit("Lead"))
    return t.part.select("p_partkey", tx.stored_title(F.col("p_name")).alias("title"), tx.seniority(renamed).alias("level"))


@query("remote_types", "T-04", """
    select job_id, case when coalesce(loc, '') = '' and coalesce(d, '') = '' then 'UNKNOWN'
        when (flag or contains(lower(coalesce(loc, '')), 'remote') or contains(lower(coalesce(d, '')), 'remote'))
             and (contains(lower(coalesce(loc, '')), 'hybrid') or contains(lower(coalesce(d, '')), 'hybrid')) then 'HYBRID'
        when flag or contains(lower(coalesce(loc, '')), 'remote') or contains(lower(coalesce(d, '')), 'remote') then 'REMOTE'
        else 'ONSITE' end as remote_type
    from (select l_orderkey * 10 + l_linenumber as job_id, case when l_tax < 0.02 then null when l_tax < 0.04 then 'Remote' else 'Berlin' end as loc,
          l_returnflag = 'R' and l_tax > 0.05 as flag, case when l_discount < 0.03 then null when l_discount < 0.06 then 'Hybrid team' else 'on site' end as d
          from {lineitem})""")
def _(t):
    jobs = t.sql("""select l_orderkey * 10 + l_linenumber as job_id, case when l_tax < 0.02 then null when l_tax < 0.04 then 'Remote'
        else 'Berlin' end as loc, l_returnflag = 'R' and l_tax > 0.05 as flag, case when l_discount < 0.03 then null
        when l_discount < 0.06 then 'Hybrid team' else 'on site' end as d from {lineitem}""")  # fmt: skip
    return jobs.select("job_id", tx.remote_type(F.col("loc"), F.col("flag"), F.col("d")).alias("remote_type"))


@query("record_hashes", "T-05", """
    select doc_id, sha256(concat(coalesce(lang, ''), '|', case when n_chars > 500 then '' else source end, '|', text)) as record_hash,
           true as well_formed from {documents}""")
def _(t):
    optional = F.when(F.col("n_chars") <= 500, F.col("source"))
    hashed = t.documents.select("doc_id", tx.record_hash(["lang", optional, "text"]).alias("record_hash"))
    return hashed.withColumn("well_formed", tx.is_sha256(F.col("record_hash")))


@query("snapshots", "IO-02 T-05", """
    select concat(source, ':', cast(doc_id as varchar)) as snapshot_id, source as source_name, 'b1' as batch_id,
           sha256(concat('{"doc_id":', cast(doc_id as varchar), ',"lang":"', lang, '"}')) as payload_hash
    from {documents}""".replace("'{\"doc_id\":'", "chr(123) || '\"doc_id\":'").replace("'\"}'", "'\"' || chr(125)"))
def _(t):
    from worklode.sources.ingest import snapshots

    found = snapshots(t.documents.select("doc_id", "lang", "source"), ["source", "doc_id"], ["doc_id", "lang"], "source", "b1", AS_OF)
    return found.select("snapshot_id", "source_name", "batch_id", "payload_hash")


@query("quarantine_reasons", "T-27", """
    select doc_id, case when source is null or trim(source) = '' or trim(lang) = '' then 'MISSING_REQUIRED_FIELD'
        when (length(title) - length(replace(title, '!', ''))) > 2 or (length(text) - length(replace(text, '!', ''))) > 5
          or (length(text) - length(replace(text, '$', ''))) > 3 or length(text) > 5000 then 'SUSPICIOUS_CONTENT' end as reason
    from (select *, split_part(text, ' ', 1) as title from {documents})""")
def _(t):
    docs = t.documents.withColumn("title", F.split_part("text", F.lit(" "), F.lit(1)))
    posted = F.lit("2001-08-01").cast("timestamp")
    reason = tx.quarantine_reason(["source", "lang"], F.col("title"), F.col("text"), posted, AS_OF)
    return docs.select("doc_id", reason.alias("reason"))


@query("implausible_dates", "T-27", f"""
    select o_orderkey, case when o_orderdate < timestamp '{AS_OF} 00:00:00' - interval 12 month then 'INVALID_DATE' end as reason
    from {{orders}}""")
def _(t):
    reason = tx.quarantine_reason(["o_orderpriority"], F.lit(""), F.lit(""), F.col("o_orderdate"), AS_OF)
    return t.orders.select("o_orderkey", reason.alias("reason"))


# Classification ---------------------------------------------------------------------------------


def sector_case(col: str, groups: dict[str, list[str]]) -> str:
    arms = " ".join(f"when {' or '.join(f'contains({col}, {w!r})' for w in words)} then '{name}'" for name, words in groups.items())
    return f"case {arms} end"


SECTORED = f"""
    select job_id, coalesce(a, b, 'unknown') as sector,
           case when a is not null then 'company_pattern' when b is not null then 'title_keyword' else 'no_match' end as assignment_method,
           cast(case when a is not null then 0.85 when b is not null then 0.75 else 0 end as double) as sector_confidence
    from (select job_id, {sector_case("lower(title)", fixed.COMPANY_SECTOR_WORDS)} as a,
                 {sector_case("lower(description)", fixed.TITLE_SECTOR_WORDS)} as b from {{text_jobs}})"""


@query("assign_sectors", "T-10", SECTORED)
def _(t):
    found = classify.assign_sector(t.text_jobs, "title", "description")
    return found.select("job_id", "sector", "assignment_method", "sector_confidence")


@query("sector_review_queue", "T-12", f"""
    select md5(concat('sector|', cast(job_id as varchar))) as review_id, job_id, 'sector' as entity_type,
           case when s is null then 'no_match' else 'low_confidence' end as issue_type, s as suggested, sector_confidence as confidence,
           'pending' as status
    from (select *, nullif(sector, 'unknown') as s from ({SECTORED})) where s is null or sector_confidence < 0.8""")
def _(t):
    found = classify.assign_sector(t.text_jobs, "title", "description").withColumn("s", F.nullif(F.col("sector"), F.lit("unknown")))
    return matching.low_confidence(found, "job_id", "sector", "s", "sector_confidence", 0.8)


SECTOR_LISTS = [{"sector_id": 1, "words": ["the", "with", "tion"]}, {"sector_id": 2, "words": ["eau", "que", "ment"]},
                {"sector_id": 3, "words": ["und", "sch", "ung"]}, {"sector_id": 4, "words": ["los", "ci", "dad"]}]


def score_sql(entry) -> str:
    title = " + ".join(f"contains(lower(title), '{w}')::int" for w in entry["words"])
    body = " + ".join(f"contains(lower(description), '{w}')::int" for w in entry["words"])
    return f"select job_id, {entry['sector_id']} as id, 2 * ({title}) + ({body}) as score from {{text_jobs}}"


@query("score_sectors", "T-11", f"""
    with s as ({" union all ".join(score_sql(e) for e in SECTOR_LISTS)}),
    r as (select *, row_number() over (partition by job_id order by score desc, id) as rn from s where score >= 2)
    select j.job_id, coalesce(a.id, -1) as sector_id, coalesce(a.score, 0) as sector_score, b.id as second_sector_id
    from {{text_jobs}} j left join r a on a.job_id = j.job_id and a.rn = 1 left join r b on b.job_id = j.job_id and b.rn = 2""")
def _(t):
    words = literal_dictionary(SECTOR_LISTS, ["sector_id", "words"])
    found = classify.score_sectors(t.text_jobs, "job_id", "title", "description", words, threshold=2)
    return found.select("job_id", "sector_id", "sector_score", "second_sector_id")


SKILL_LISTS = [
    {"skill": "alpha", "words": ["tion", "ion"], "sector": None}, {"skill": "beta", "words": ["c++", "ing"], "sector": None},
    {"skill": "gamma", "words": ["edth", "re. "], "sector": "en"}, {"skill": "delta", "words": ["ar", "la"], "sector": "es"},
    {"skill": "epsilon", "words": ["eau"], "sector": "fr"}, {"skill": "zeta", "words": ["sch"], "sector": "de"},
]


def skill_sql() -> str:
    parts = []
    for s in SKILL_LISTS:
        word = "case " + " ".join(f"when contains(t, '{w}') then '{w}'" for w in s["words"]) + " end"
        where = "true" if s["sector"] is None else f"(lang = '{s['sector']}' or lang[1] = '{s['sector'][0]}')"
        escaped = "case " + " ".join(
            "when contains(t, '{0}') then regexp_extract(t, '.{{{{0,30}}}}{1}.{{{{0,30}}}}')".format(w, w.replace("+", r"\+").replace(".", r"\.")) for w in s["words"]
        ) + " end"
        parts.append(f"select job_id, '{s['skill']}' as skill, {word} as skill_raw, {escaped} as evidence, lang as sector_context from x where {where}")
    return "with x as (select job_id, lang, lower(description) as t from {text_jobs}) select * from (" + " union all ".join(parts) + ") where skill_raw is not null"


@query("extract_skills", "T-13 GR-01", skill_sql().replace("{{0,30}}", "{0,30}"))
def _(t):
    words = literal_dictionary(SKILL_LISTS, ["skill", "words", "sector"])
    found = classify.extract_skills(t.text_jobs, "job_id", F.col("description"), words, F.col("lang"))
    return found.select("job_id", "skill", "skill_raw", "evidence", "sector_context")


@query("match_catalog_words", "GR-01 J-21", r"""
    with terms as (select distinct split_part(p_name, ' ', 1) as term from {part} union select distinct r_name from {region}
                   union select 'the'  union select 'of the' union select 'and is'
                   union select 'is of the' union select 'the and of the and'),
    x as (select doc_id, concat(' ', array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}#+]+'), lambda w: w <> ''), ' '), ' ') as w
          from {documents})
    select doc_id, term from x, terms where contains(w, concat(' ', lower(term), ' '))""")
def _(t):
    words = t.sql("""select distinct split_part(p_name, ' ', 1) as term from {part} union select distinct r_name from {region}
                     union select 'the' union select 'of the' union select 'and is'
                     union select 'is of the' union select 'the and of the and'""")  # fmt: skip
    return match_words(t.documents, "doc_id", F.col("text"), words, "term").select("doc_id", "term")


ALIASES = """select p_name as alias, concat('Role ', upper(p_name)) as role,
             cast(case when min(p_size) > 1 then 0.9 else 1.0 end as double) as boost from {part} group by p_name"""
ROLES_SQL = f"""
    with tt as (select distinct raw_name, trim(replace(replace(replace(lower(trim(raw_name)), '(m/w/d)', ''), '(m/f/d)', ''), '(gn)', '')) as t
                from {{raw_names}}),
    al as ({ALIASES}),
    sc as (select raw_name, role, alias, case when alias = t then boost when length(alias) < 4 then null
             when contains(t, alias) then case when length(alias)::double / length(t)::double >= 0.2
                 then boost * 0.95 * least(length(alias)::double / length(t)::double * 1.5, 1.0) end
             when contains(alias, t) and length(t) >= 5 and 1 / (length(alias)::double / length(t)::double) >= 0.4 then boost * 0.9 end as s,
             alias = t as is_exact from tt, al),
    bb as (select * from (select *, row_number() over (partition by raw_name order by is_exact desc, s desc, alias) as rn
          from sc where s is not null) where rn = 1),
    roles_found as (select tt.raw_name, role, s as confidence, case when is_exact then 'dictionary' when s is not null then 'dictionary_fuzzy' end as method
    from tt left join bb on bb.raw_name = tt.raw_name)"""


def roles_found(t):
    aliases = table_dictionary(t.sql(ALIASES), ["alias", "role", "boost"], ["alias"])
    return classify.match_roles(t.raw_names, "raw_name", aliases)


@query("match_roles", "T-14", ROLES_SQL + " select * from roles_found")
def _(t):
    return roles_found(t)


@query("role_review_bands", "T-26 T-15", ROLES_SQL + """
    select case when confidence is null then 'NO_MATCH' when confidence >= 0.65 then 'ACCEPTED' when confidence >= 0.5 then 'MEDIUM'
                else 'LOW' end as band, count(*) as titles from roles_found group by 1""")
def _(t):
    from worklode.operators.review import confidence_band

    return roles_found(t).groupBy(confidence_band("confidence", fixed.ROLE_THRESHOLD).alias("band")).agg(F.count(F.lit(1)).alias("titles"))


KEYWORDS = """select p_name as keyword, min(p_partkey) as code, cast(length(p_name) as int) as level from {part} group by p_name"""
SECTOR_LABELS = f"""
    with kw as ({KEYWORDS}), tax as (select code, keyword as name, level, case when level > 11 then (select min(code) from kw) end as parent_code from kw),
    d as (select distinct raw_name, trim(regexp_replace(lower(trim(raw_name)), '\\s+', ' ', 'g')) as t from {{raw_names}}),
    m as (select raw_name, code, keyword = t as is_exact, row_number() over (partition by raw_name order by keyword = t desc, level desc, code) as rn
          from d, kw where keyword = t or (t <> '' and (contains(t, keyword) or contains(keyword, t)))),
    f as (select d.raw_name, m.code, case when is_exact then 'exact_keyword' when m.code is not null then 'partial_keyword' end as method,
                 case when is_exact then 1.0::double when m.code is not null then 0.85::double end as c
          from d left join m on m.raw_name = d.raw_name and rn = 1),
    u as (select raw_name, case when tax.level > 11 then tax.parent_code else f.code end as code,
                 case when tax.level > 11 then 'hierarchical_rollup' else method end as method,
                 case when tax.level > 11 then c * 0.9::double else coalesce(c, 0) end as confidence from f left join tax on tax.code = f.code)
    select raw_name, u.code, method, confidence, tax.name as sector_name, tax.level as sector_level, tax.parent_code,
           confidence >= 0.8 as accepted from u left join tax on tax.code = u.code"""


@query("normalize_sectors", "T-16 J-10 J-24", SECTOR_LABELS)
def _(t):
    kw = t.sql(KEYWORDS)
    root = kw.select(F.min("code")).scalar()
    taxonomy = kw.select("code", F.col("keyword").alias("name"), "level", F.when(F.col("level") > 11, root).alias("parent_code"))
    words = table_dictionary(kw, ["keyword", "code", "level"], ["keyword"])
    return classify.normalize_sectors(t.raw_names, "raw_name", words, taxonomy, level_cap=11)


@query("category_groups", "T-20 J-20", """
    select p_partkey, coalesce(r_name, 'Other') as industry_group, coalesce(n_name, 'Other') as category
    from {part} left join {nation} on lower(trim(p_brand)) = lower(concat('brand#', n_nationkey)) left join {region} on r_regionkey = n_regionkey""")
def _(t):
    groups = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit(" BRAND#"), F.col("n_nationkey").cast("string")).alias("k"), F.col("r_name").alias("industry_group"), F.col("n_name").alias("category")
    )
    return classify.lookup_group(t.part, "p_brand", groups, "k", ["industry_group", "category"]).select("p_partkey", "industry_group", "category")


# Names ------------------------------------------------------------------------------------------

CANON_CTES = f"""
    nm as (select name_id, raw_name, {norm_sql("raw_name")} as n from {{raw_names}}),
    cn as (select canonical_id, canonical_name, {norm_sql("canonical_name")} as c from {{canonical_names}}),
    al as (select min(p_partkey) as canonical_id, concat(p_name, 's ', p_brand) as alias from {{part}} where p_type = 'PROMO' group by p_name, p_brand)"""
NEAR = "1 - levenshtein(n, c)::double / greatest(length(n), length(c))::double"
FUZZY_SQL = f"""
    with {CANON_CTES},
    p as (select n, c, {NEAR} as similarity from (select distinct n from nm) a, (select distinct c from cn) b
          where length(n) > 0 and levenshtein(n, c) <= floor(greatest(length(n), length(c)) * 0.15 + 1e-9))"""


def normal_names(t):
    n = t.raw_names.select("name_id", tx.matching_company_name(F.col("raw_name")).alias("n"))
    c = t.canonical_names.select("canonical_id", tx.matching_company_name(F.col("canonical_name")).alias("c"))
    return n, c


@query("fuzzy_pairs", "J-09", FUZZY_SQL + " select n, c as matched_name, similarity from p")
def _(t):
    n, c = normal_names(t)
    return matching.fuzzy_pairs(n, "n", c, "c")


@query("fuzzy_best", "J-09 W-03", FUZZY_SQL + """
    select n, c as matched_name, similarity from (select *, row_number() over (partition by n order by similarity desc, c) as rn from p) where rn = 1""")
def _(t):
    n, c = normal_names(t)
    return matching.fuzzy_best(n, "n", c, "c")


def aliases(t):
    promo = t.part.filter("p_type = 'PROMO'")
    return promo.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("canonical_id")).select(
        "canonical_id", F.concat("p_name", F.lit("s "), "p_brand").alias("alias")
    )


CASCADE = f"""
    with {CANON_CTES},
    ex as (select c as n, min(canonical_id) as e from cn group by 1),
    ax as (select {norm_sql("alias")} as n, min(canonical_id) as a from al group by 1),
    kn as (select d.n, e, a from (select distinct n from nm where length(n) >= 3) d left join ex on ex.n = d.n left join ax on ax.n = d.n),
    fz as (select n, c, {NEAR} as similarity, row_number() over (partition by n order by {NEAR} desc, c) as rn
           from (select n from kn where e is null and a is null) k, (select distinct c from cn) b
           where levenshtein(n, c) <= floor(greatest(length(n), length(c)) * 0.15 + 1e-9)),
    fd as (select kn.n, coalesce(kn.e, kn.a, ex.e) as canonical_id,
             case when kn.e is not null then 'exact' when a is not null then 'alias' when fz.c is not null then 'fuzzy' else 'no_match' end as match_method,
             case when kn.e is not null then 1.0::double when a is not null then 0.95::double else coalesce(similarity, 0) end as confidence
           from kn left join fz on fz.n = kn.n and rn = 1 left join ex on ex.n = fz.c),
    matched as (select name_id, raw_name, nm.n as normalized_name, fd.canonical_id, canonical_name,
                       coalesce(match_method, 'too_short') as match_method, coalesce(confidence, 0) as confidence
                from nm left join fd on fd.n = nm.n left join cn on cn.canonical_id = fd.canonical_id)"""


def matched(t):
    return matching.canonicalize(t.raw_names, "raw_name", t.canonical_names, aliases(t))


@query("canonicalize_companies", "T-17 J-11 J-09", CASCADE + " select * from matched")
def _(t):
    return matched(t)


@query("company_map", "T-17 M-01", CASCADE + """
    select md5(concat(name_id, '|', canonical_id)) as company_map_id, name_id, canonical_id, canonical_name, confidence,
           case match_method when 'exact' then 'EXACT_MATCH' when 'alias' then 'ALIAS_MATCH' when 'fuzzy' then 'FUZZY' end as normalization_method
    from matched where confidence >= 0.75""")
def _(t):
    return matching.company_outputs(matched(t), "name_id", "raw_name")[0].drop("explanation_json")


@query("company_review_rows", "T-17 T-12", CASCADE + """
    select name_id, 'company' as entity_type,
           case when match_method in ('no_match', 'too_short') then match_method else 'low_confidence' end as issue_type, raw_name as "value", normalized_name, canonical_id as suggested_id,
           confidence, 'pending' as status from matched where confidence < 0.75""")
def _(t):
    return matching.company_outputs(matched(t), "name_id", "raw_name")[1].drop("review_id")


@query("new_canonical_companies", "T-17", CASCADE + """
    select concat('company_', md5(normalized_name)) as company_id, min(raw_name) as canonical_name
    from matched where match_method = 'no_match' group by normalized_name""")
def _(t):
    return matching.company_outputs(matched(t), "name_id", "raw_name")[2]


SKILL_SOURCES = """
    select p_name as skill_name, p_type as category, 0 as priority from {part} where p_size < 25
    union all select concat(' ', upper(p_name)), p_brand, 1 from {part} where p_size > 20
    union all select c_mktsegment, 'segment', 2 from {customer}"""
SKILL_CATALOG = """select concat('id', min(p_partkey)) as skill_id, p_name as skill_name, 'old' as category from {part} where p_size > 40 group by p_name
    union all select 'idx', 'unused skill', 'old'"""


@query("sync_skill_catalog", "T-18 IO-07 M-02 U-03", f"""
    with s as ({SKILL_SOURCES}), k as ({SKILL_CATALOG}),
    b as (select *, row_number() over (partition by lower(trim(skill_name)) order by priority, skill_name, category) as rn,
                 lower(trim(skill_name)) as nn from s),
    c as (select *, lower(trim(skill_name)) as nn from k)
    select coalesce(c.skill_id, concat('skill_', md5(b.nn))) as skill_id, coalesce(b.skill_name, c.skill_name) as skill_name,
           coalesce(b.category, c.category) as category,
           case when c.skill_id is null then 'NEW' when b.nn is null then 'KEPT' else 'UPDATED' end as sync_state
    from (select * from b where rn = 1) b full join c on b.nn = c.nn""")
def _(t):
    return classify.sync_catalog(t.sql(SKILL_SOURCES), t.sql(SKILL_CATALOG))


@query("skill_evidence", "T-19 J-20", f"""
    with c as ({SKILL_CATALOG}), x as (select lower(trim(skill_name)) as n, min(skill_id) as id from c group by 1)
    select p_partkey, coalesce(id, concat('skill_', md5(lower(p_name)))) as skill_id, id is not null as is_catalogued
    from {{part}} left join x on x.n = lower(p_name)""")
def _(t):
    told = t.part.select("p_partkey", F.concat(F.upper("p_name"), F.lit(" ")).alias("name"))
    return classify.skill_evidence(told, t.sql(SKILL_CATALOG), "name").select("p_partkey", "skill_id", "is_catalogued")


# Identity ---------------------------------------------------------------------------------------

KEYED = """
    keyed as (select job_id, source_name, rule, score, k from (
        select job_id, source_name, 'EXACT_MATCH' as rule, 1.0::double as score, concat(lang, '|', title, '|', n_chars) as k from {text_jobs}
        union all select job_id, source_name, 'COMPOSITE_HASH', 0.95, concat(lang, '|', title, '|', description) from {text_jobs}
        union all select job_id, source_name, 'COMPANY_TITLE', 0.85, concat(lang, '|', title) from {text_jobs})),
    partners as (select a.job_id, a.source_name, a.rule as match_rule, a.score as match_score, min(b.job_id) as partner_id,
                        arg_min(b.source_name, b.job_id) as partner_source
                 from keyed a join keyed b on a.rule = b.rule and a.k = b.k and a.source_name <> b.source_name group by 1, 2, 3, 4)"""


def keyed(t):
    keys = identity.match_keys(t.text_jobs, "job_id", "source_name", "lang", "title", "n_chars", "description", ["job_id"])
    return cut_lineage(keys)


@query("identity_partners", "T-07 J-07", f"with {KEYED} select * from partners")
def _(t):
    return identity.cross_source_partners(keyed(t), "job_id", "source_name", ["job_id"])


@query("identity_map", "T-07 W-03", f"""
    with {KEYED} select * exclude (rn) from (select *, row_number() over (partition by job_id order by match_score desc, partner_id) as rn from partners) where rn = 1""")
def _(t):
    return identity.best_partner(identity.cross_source_partners(keyed(t), "job_id", "source_name", ["job_id"]), "job_id")


@query("identity_pair_counts", "J-07 T-07", f"""
    with {KEYED} select a.rule as match_rule, count(*) as pair_count from keyed a join keyed b on a.rule = b.rule and a.k = b.k
    and a.source_name <> b.source_name and a.job_id < b.job_id group by 1""")
def _(t):
    return identity.pair_counts(keyed(t), "source_name").filter("pair_count > 0")


@query("first_posting_per_identity", "T-08 W-01", """
    select job_id, source_name from (select *, row_number() over (partition by lang, title order by n_chars, case source_name when 'src1' then 0
        when 'src2' then 1 else 2 end, job_id) as rn from {text_jobs}) where rn = 1""")
def _(t):
    priority = F.when(F.col("source_name") == "src1", 0).when(F.col("source_name") == "src2", 1).otherwise(2)
    return identity.keep_first_posting(t.text_jobs, ["lang", "title"], "n_chars", priority, "job_id").select("job_id", "source_name")


@query("identity_clusters", "T-09", f"""
    with recursive {KEYED},
    e as (select job_id as a, partner_id as b from partners where match_rule <> 'COMPANY_TITLE'
          union select partner_id, job_id from partners where match_rule <> 'COMPANY_TITLE'),
    reach(node, r) as (select a, a from e union select reach.node, e.b from reach join e on reach.r = e.a)
    select node, min(r) as cluster from reach group by 1""")
def _(t):
    partners = identity.cross_source_partners(keyed(t), "job_id", "source_name", ["job_id"])
    return identity.clusters(partners.filter("match_rule <> 'COMPANY_TITLE'"), "job_id", "partner_id")


# Review -----------------------------------------------------------------------------------------

QUEUE = ROLES_SQL + """,
    q as (select md5(concat('role|', raw_name)) as review_id, raw_name, case when role is null then 'no_match' else 'low_confidence' end as issue_type,
          role as suggested, coalesce(confidence, 0) as confidence from roles_found where role is null or confidence < 0.65),
    dec as (select *, case when raw_name like '%Holding%' then 'reject' when raw_name like '% LLC' then 'create' when raw_name like '%x%' then 'approve' end as decision
            from q)"""


def review(t):
    queue = matching.low_confidence(roles_found(t), "raw_name", "role", "role", "confidence", fixed.ROLE_THRESHOLD)
    name = F.col("raw_name")
    decision = F.when(name.like("%Holding%"), "reject").when(name.like("% LLC"), "create").when(name.like("%x%"), "approve")
    decisions = t.raw_names.select(F.md5(F.concat(F.lit("role|"), name)).alias("review_id"), decision.alias("decision"), F.upper(name).alias("new_value"))
    return queue, decisions.dropna(subset=["decision"]).distinct()


@query("review_queue_after_decisions", "T-24 T-25", QUEUE + """
    select review_id, issue_type, case when decision = 'reject' then 'rejected' when decision is not null then 'resolved' else 'pending' end as status from dec""")
def _(t):
    return matching.apply_decisions(*review(t))[0].select("review_id", "issue_type", "status")


@query("review_mappings", "T-24", QUEUE + """
    select review_id, decision, case when decision = 'approve' then suggested else upper(raw_name) end as mapped_value from dec
    where decision in ('approve', 'create') and (decision = 'create' or suggested is not null)""")
def _(t):
    return matching.apply_decisions(*review(t))[1].drop("entity_type")


@query("review_audit", "T-24", QUEUE + """
    select review_id, decision, suggested as old_value, case when decision = 'approve' then suggested when decision = 'create' then upper(raw_name) end as new_value
    from dec where decision is not null""")
def _(t):
    return matching.apply_decisions(*review(t))[2]


@query("review_summary", "T-25 A-02", QUEUE + """
    select issue_type, count(*) as items, count(case when decision is null then 1 end) as pending,
           count(case when decision = 'reject' then 1 end) as rejected, count(case when decision <> 'reject' then 1 end) as resolved,
           round(min(confidence), 6) as lowest from dec group by 1""")
def _(t):
    from worklode.operators.review import summary

    return summary(matching.apply_decisions(*review(t))[0])
