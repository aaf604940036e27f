"""The rule catalog as data: every rule's name, category, severity, table and condition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from worklode.functions import fixed_values as fixed
from worklode.operators.quality import Rule


def _missing(*columns: str) -> dict:
    return {"bad": " or ".join(f"{c} is null" for c in columns)}


def _not_one_of(column: str, values: list[str]) -> dict:
    listed = ", ".join(f"'{v}'" for v in values)
    return {"bad": f"{column} is not null and {column} not in ({listed})"}


def _completeness() -> list[Rule]:
    rows = [
        ("BR_COMPL_001", "ERROR", "rf_snapshots", _missing("snapshot_id", "source_name", "source_job_id", "payload_json", "ingestion_timestamp")),
        ("BR_COMPL_002", "ERROR", "rf_batches", _missing("batch_id", "source_name", "started_at")),
        ("SV_COMPL_001", "ERROR", "rf_jobs", _missing("enterprise_job_id", "source_name", "source_job_id", "title_raw", "posted_at", "is_active")),
        ("SV_COMPL_002", "WARNING", "rf_jobs", {"bad": "is_active and (company_name_norm is null or title_normalized is null or location_norm is null)"}),
        ("SV_COMPL_003", "ERROR", "rf_skill_mapping", _missing("enterprise_job_id", "skill_name_raw")),
        ("SM_COMPL_001", "ERROR", "rf_sector_map", _missing("sector_map_id", "enterprise_job_id", "canonical_sector_code", "canonical_sector_name")),
        ("SM_COMPL_002", "ERROR", "rf_company_canonical", _missing("canonical_company_id", "canonical_company_name")),
        ("SM_COMPL_003", "ERROR", "rf_skill_catalog", _missing("canonical_skill_id", "canonical_skill_name")),
        ("WH_COMPL_001", "ERROR", "rf_dim_company", _missing("company_sk", "company_name")),
        ("WH_COMPL_002", "ERROR", "rf_dim_location", _missing("location_sk", "location_name", "active_flag")),
        ("WH_COMPL_003", "ERROR", "rf_dim_sector", _missing("sector_sk", "sector_name", "sector_family", "active_flag")),
        ("WH_COMPL_004", "ERROR", "rf_postings", _missing("job_sk", "company_sk", "location_sk", "sector_sk", "source_sk")),
        ("WH_COMPL_005", "ERROR", "rf_salary", _missing("fact_salary_sk", "job_sk", "observation_date_sk", "salary_observation_type")),
        ("GD_COMPL_001", "WARNING", "rf_hiring_mart", _missing("trend_period", "total_postings")),
        ("GD_COMPL_002", "WARNING", "rf_salary_mart", _missing("observation_period", "median_salary")),
    ]
    return [Rule(n, "Completeness", s, t, "where", spec) for n, s, t, spec in rows]


def _uniqueness() -> list[Rule]:
    rows = [
        ("BR_UNIQ_001", "ERROR", "rf_snapshots", ["snapshot_id"]),
        ("BR_UNIQ_002", "WARNING", "rf_snapshots", ["batch_id", "payload_hash"]),
        ("SV_UNIQ_001", "ERROR", "rf_jobs", ["enterprise_job_id"]),
        ("SV_UNIQ_002", "WARNING", "rf_jobs", ["source_name", "source_job_id"]),
        ("SV_UNIQ_003", "ERROR", "rf_identity_map", ["mapping_id"]),
        ("SM_UNIQ_001", "ERROR", "rf_company_canonical", ["canonical_company_id"]),
        ("SM_UNIQ_002", "ERROR", "rf_skill_catalog", ["canonical_skill_id"]),
        ("SM_UNIQ_003", "ERROR", "rf_sector_map", ["sector_map_id"]),
        ("WH_UNIQ_001", "ERROR", "rf_dim_company", ["company_sk"]),
        ("WH_UNIQ_002", "ERROR", "rf_dim_location", ["location_sk"]),
        ("WH_UNIQ_003", "ERROR", "rf_dim_sector", ["sector_sk"]),
        ("WH_UNIQ_004", "ERROR", "rf_dim_skill", ["skill_sk"]),
        ("WH_UNIQ_005", "ERROR", "rf_salary", ["fact_salary_sk"]),
        ("GD_UNIQ_001", "WARNING", "rf_company_names", ["canonical_company_id", "raw_company_name"]),
        ("LOC_008", "ERROR", "rf_dim_location", ["location_nk"]),
    ]
    return [
        Rule(n, "Location Normalization" if n.startswith("LOC") else "Uniqueness", s, t, "unique", {"keys": k})
        for n, s, t, k in rows
    ]


def _freshness(as_of: str) -> list[Rule]:
    def older(column: str, hours: int) -> dict:
        return {"bad": f"is_active and {column} < timestamp '{as_of} 00:00:00' - interval {hours} hours"}

    return [
        Rule("BR_FRESH_001", "Freshness", "WARNING", "rf_snapshots", "fresh", {"at": "ingestion_timestamp", "hours": 24, "per": "source_name"}),
        Rule("SV_FRESH_001", "Freshness", "WARNING", "rf_jobs", "where", older("updated_at", 48)),
        Rule("SV_FRESH_002", "Freshness", "ERROR", "rf_jobs", "where", older("last_seen", 168)),
        Rule("SM_FRESH_001", "Freshness", "WARNING", "rf_sector_map", "fresh", {"at": "created_at", "hours": 168}),
        Rule("WH_FRESH_001", "Freshness", "WARNING", "rf_postings", "fresh", {"at": "load_timestamp", "hours": 24}),
        Rule("GD_FRESH_001", "Freshness", "WARNING", "rf_hiring_mart", "fresh", {"at": "calculated_at", "hours": 24}),
        Rule("AUDIT_FRESH_001", "Freshness", "ERROR", "rule_results", "fresh", {"at": "evaluated_at", "hours": 24}),
    ]


def _referential() -> list[Rule]:
    def to(parent: str, **pairs: str) -> dict:
        return {"parent": parent, "on": pairs}

    jobs = {"enterprise_job_id": "enterprise_job_id"}
    rows = [
        ("SV_REF_001", "ERROR", "rf_jobs", to("rf_snapshots", source_name="source_name", source_job_id="source_job_id")),
        ("SM_REF_001", "ERROR", "rf_sector_map", to("rf_jobs", **jobs)),
        ("SM_REF_002", "ERROR", "rf_company_map", to("rf_jobs", **jobs)),
        ("WH_REF_001", "ERROR", "rf_postings", to("rf_dim_job", job_sk="job_sk")),
        ("WH_REF_002", "ERROR", "rf_postings", to("rf_dim_company", company_sk="company_sk")),
        ("WH_REF_003", "ERROR", "rf_postings", to("rf_dim_location", location_sk="location_sk")),
        ("WH_REF_004", "ERROR", "rf_postings", to("rf_dim_sector", sector_sk="sector_sk")),
        ("WH_REF_005", "ERROR", "rf_salary", {"any": [("rf_dim_job", "job_sk", "job_sk"), ("rf_dim_company", "company_sk", "company_sk"), ("rf_dim_location", "location_sk", "location_sk"), ("rf_dim_sector", "sector_sk", "sector_sk")]}),
        ("WH_REF_006", "ERROR", "rf_bridge", {"any": [("rf_dim_job", "job_sk", "job_sk"), ("rf_dim_skill", "skill_sk", "skill_sk")]}),
        ("QUAR_REF_001", "WARNING", "rf_quarantine", to("rf_jobs", **jobs)),
    ]
    return [Rule(n, "Referential Integrity", s, t, "orphan", spec) for n, s, t, spec in rows]


def _business(as_of: str) -> list[Rule]:
    rows = [
        ("BIZ_001", "ERROR", "rf_jobs", {"bad": f"posted_at > timestamp '{as_of} 00:00:00'"}),
        ("BIZ_002", "ERROR", "rf_jobs", {"bad": "soft_delete_flag and is_active"}),
        ("BIZ_003", "ERROR", "rf_jobs", {"bad": "posted_at > last_seen"}),
        ("BIZ_004", "ERROR", "rf_jobs", {"bad": "created_at > updated_at"}),
        ("BIZ_005", "ERROR", "rf_sector_map", {"bad": "normalization_confidence < 0 or normalization_confidence > 1"}),
        ("BIZ_006", "WARNING", "rf_jobs", _not_one_of("remote_type", fixed.REMOTE_TYPES)),
        ("BIZ_007", "WARNING", "rf_jobs", _not_one_of("dq_overall_status", fixed.QUALITY_STATUSES)),
        ("BIZ_008", "ERROR", "rf_salary", _not_one_of("salary_observation_type", fixed.SALARY_SOURCES)),
        ("BIZ_010", "ERROR", "rf_quarantine", _not_one_of("severity", fixed.SEVERITIES[:2])),
        ("BIZ_011", "ERROR", "rf_quarantine", _not_one_of("status", fixed.REPROCESS_STATUSES)),
    ]
    used = {"bad": "not active_flag", "child": "rf_postings", "child_key": "sector_sk", "key": "sector_sk"}
    return [Rule(n, "Business Logic", s, t, "where", spec) for n, s, t, spec in rows] + [
        Rule("BIZ_009", "Business Logic", "WARNING", "rf_dim_sector", "used", used)
    ]


def _unnamed_sectors(tables):
    dim = tables["rf_dim_sector"]
    names = dim.select(F.explode(F.concat(F.array("sector_name"), F.split("aliases", r"\|"))).alias("name")).distinct()
    mapped = tables["rf_sector_map"].filter(F.col("canonical_sector_code").isNotNull())
    return mapped.join(names, F.col("canonical_sector_name") == F.col("name"), "left_anti")


def _lonely_families(tables):
    # NOT IN over families with more than one active sector; a null family counts as such a family.
    dim = tables["rf_dim_sector"]
    families = dim.filter("active_flag and sector_family is not null").groupBy("sector_family").agg(F.count(F.lit(1)).alias("n"))
    return dim.filter("sector_family is not null").join(families.filter("n > 1"), "sector_family", "left_anti")


def _unclassified_companies(tables):
    family = tables["rf_dim_sector"].filter("sector_family = 'HOME'").select("sector_sk")
    posted = tables["rf_postings"].select("company_sk")
    good = tables["rf_dim_company"].join(posted, "company_sk", "left_semi").join(family, "sector_sk", "left_semi")
    listed = tables["rf_sector_companies"].filter(F.col("sector_name") == "Hospitality")
    return listed.join(good.select("company_name"), "company_name", "left_anti")


def _thin_sectors(tables):
    counts = tables["rf_salary"].groupBy("sector_sk").agg(F.count("fact_salary_sk").alias("n"))
    active = tables["rf_dim_sector"].filter("active_flag")
    return active.join(counts, "sector_sk", "left").filter(F.coalesce("n", F.lit(0)) < 10)


def _unpaid_postings(tables):
    paid = tables["rf_salary"].select("job_sk")
    return tables["rf_postings"].filter("is_active").join(paid, "job_sk", "left_anti")


def _moving_places(tables):
    place = F.lower(F.trim("location_name"))
    located = tables["rf_dim_location"].dropna(subset=["latitude", "longitude", "location_name"])
    return located.groupBy(place.alias("p")).agg(F.countDistinct("latitude", "longitude").alias("n")).filter("n > 1")


def _sector() -> list[Rule]:
    rows = [
        ("SECT_001", "WARNING", "rf_jobs", "where", {"bad": "is_active and sector_assigned is null"}),
        ("SECT_002", "WARNING", "rf_jobs", "where", {"bad": "is_active and sector_confidence < 0.6 and sector_assigned is not null"}),
        ("SECT_003", "ERROR", "rf_jobs", "orphan", {"where": "sector_assigned is not null", "parent": "rf_sector_map", "on": {"enterprise_job_id": "enterprise_job_id"}}),
        ("SECT_004", "ERROR", "rf_sector_map", "frame", {"rows": _unnamed_sectors}),
        ("SECT_005", "WARNING", "rf_jobs", "where", {"bad": "sector_assigned is not null and sector_assignment_method is null"}),
        ("SECT_006", "WARNING", "rf_sector_map", "where", _not_one_of("normalization_method", fixed.SECTOR_METHODS)),
        ("SECT_007", "WARNING", "rf_sector_map", "where", _not_one_of("taxonomy_type", fixed.TAXONOMY_TYPES)),
        ("SECT_008", "WARNING", "rf_dim_sector", "frame", {"rows": _lonely_families}),
        ("SECT_009", "WARNING", "rf_sector_companies", "frame", {"rows": _unclassified_companies}),
    ]
    return [Rule(n, "Sector Classification", s, t, k, spec) for n, s, t, k, spec in rows]


def _pay_outside(period: str, low: float, high_min: float, high_max: float) -> dict:
    return {
        "bad": f"salary_period = '{period}' and salary_currency = 'USD' and "
        f"(salary_min < {low} or salary_min > {high_min} or salary_max < {low} or salary_max > {high_max})"
    }


def _salary() -> list[Rule]:
    rows = [
        ("SAL_001", "ERROR", "rf_salary", "where", {"bad": "salary_min > salary_max"}),
        ("SAL_002", "ERROR", "rf_salary", "where", {"bad": "salary_min <= 0 or salary_max <= 0"}),
        ("SAL_003", "ERROR", "rf_salary", "where", _not_one_of("salary_currency", fixed.CURRENCIES)),
        ("SAL_004", "ERROR", "rf_salary", "where", _not_one_of("salary_period", fixed.SALARY_PERIODS)),
        ("SAL_005", "ERROR", "rf_salary", "where", {"bad": "salary_confidence < 0 or salary_confidence > 1"}),
        ("SAL_006", "WARNING", "rf_salary", "where", _pay_outside("ANNUAL", 15000, 1000000, 5000000)),
        ("SAL_007", "WARNING", "rf_salary", "where", _pay_outside("HOURLY", 7.25, 500, 1000)),
        ("SAL_008", "WARNING", "rf_salary", "where", {"bad": "salary_observation_type = 'INFERRED' and salary_confidence < 0.5"}),
        ("SAL_009", "WARNING", "rf_dim_sector", "frame", {"rows": _thin_sectors}),
        ("SAL_010", "WARNING", "rf_salary_mart", "where", {"bad": "median_salary < min_salary or median_salary > max_salary or min_salary > max_salary"}),
        ("SAL_011", "INFO", "rf_postings", "frame", {"rows": _unpaid_postings}),
    ]
    return [Rule(n, "Salary Validation", s, t, k, spec) for n, s, t, k, spec in rows]


def _location() -> list[Rule]:
    rows = [
        ("LOC_001", "WARNING", "rf_jobs", {"bad": "is_active and location_raw is not null and location_norm is null"}),
        ("LOC_002", "ERROR", "rf_dim_location", {"bad": "length(iso_country_code) <> 2"}),
        ("LOC_003", "ERROR", "rf_dim_location", {"bad": "latitude < -90 or latitude > 90"}),
        ("LOC_004", "ERROR", "rf_dim_location", {"bad": "longitude < -180 or longitude > 180"}),
        ("LOC_005", "WARNING", "rf_dim_location", {"bad": "city is not null and (state is null or country is null)"}),
        ("LOC_006", "WARNING", "rf_dim_location", {"bad": "active_flag and city is not null and (latitude is null or longitude is null)"}),
        ("LOC_007", "WARNING", "rf_jobs", {"bad": "remote_type = 'REMOTE' and location_raw not like '%Remote%' and location_raw not like '%Anywhere%'"}),
        ("LOC_009", "WARNING", "rf_dim_location", {"bad": "length(iso_region_code) < 4 or length(iso_region_code) > 6"}),
        ("LOC_010", "WARNING", "rf_location_mart", _missing("location_name", "country")),
    ]
    used = {"bad": "not active_flag", "child": "rf_postings", "child_key": "location_sk", "key": "location_sk"}
    return [Rule(n, "Location Normalization", s, t, "where", spec) for n, s, t, spec in rows] + [
        Rule("LOC_011", "Location Normalization", "WARNING", "rf_dim_location", "frame", {"rows": _moving_places}),
        Rule("LOC_012", "Location Normalization", "WARNING", "rf_dim_location", "used", used),
    ]


def catalog(as_of: str) -> list[Rule]:
    """All rules, evaluated against ``as_of`` where they look at time."""
    groups = [_completeness(), _uniqueness(), _freshness(as_of), _referential(), _business(as_of), _sector(), _salary(), _location()]
    return reduce(lambda a, b: a + b, groups)


# What a failed rule of a severity leads to.
ACTIONS = {"ERROR": ["QUARANTINE", "ALERT"], "WARNING": ["LOG_WARNING", "FLAG_FOR_REVIEW"], "INFO": ["LOG_INFO"]}
