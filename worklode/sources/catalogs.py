"""Taxonomies and external catalogs from files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklode.functions.text import matching_sector_name
from worklode.operators.dictionaries import table_dictionary

# Column layouts of the four taxonomy files (pipe-separated word lists).
TAXONOMY_SCHEMAS = {
    "sectors": "sector_key string, sector_name string, parent_sector string, naics_code string, keywords string",
    "role_families": "family_key string, family_name string, sector_key string, description string",
    "canonical_roles": "role_key string, canonical_role string, family_key string, sector_key string, seniority string, aliases string",
    "canonical_skills": "skill_key string, canonical_skill string, skill_category string, sector_key string, aliases string",
}


def read_taxonomy(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A taxonomy CSV with its declared schema; a file with other headers fails instead of shifting."""
    return spark.read.schema(TAXONOMY_SCHEMAS[name]).options(header="true", enforceSchema="false").csv(path)


def exploded_words(taxonomy: DataFrame, words: str, out: str, separator: str = r"\|") -> DataFrame:
    """One row per entry and word of its list, trimmed and lower-cased, blanks dropped."""
    parts = F.explode(F.split(words, separator)).alias(out)
    return taxonomy.select(*[c for c in taxonomy.columns if c != words], parts).withColumn(out, F.lower(F.trim(out))).filter(F.col(out) != "")


def load_catalogs(spark: SparkSession, configs: list[dict]) -> DataFrame:
    """External catalogs {path, format, schema, name, category, priority} in one frame.

    The format decides the reader (csv, json or parquet); ``name`` and ``category`` say which columns of
    the file to take."""
    def one(c: dict) -> DataFrame:
        reader = spark.read.schema(c["schema"]) if "schema" in c else spark.read
        if c["format"] == "csv":
            reader = reader.option("header", "true")
        df = reader.format(c["format"]).load(c["path"])
        return df.select(F.col(c["name"]).cast("string").alias("skill_name"), F.col(c["category"]).cast("string").alias("category"),
                         F.lit(c["priority"]).alias("priority"))

    return reduce(lambda a, b: a.unionByName(b), [one(c) for c in configs])


def role_dictionary(roles: DataFrame) -> DataFrame:
    """Alias list for ``classify.match_roles`` from the role taxonomy: the canonical title counts 1.0, an
    alias 0.9; an alias listed for several roles belongs to the first role key."""
    words = exploded_words(roles, "aliases", "alias")
    own = F.when(F.col("alias") == F.lower("canonical_role"), 1.0).otherwise(0.9)
    first = words.groupBy("alias").agg(
        F.min_by(F.struct(F.col("canonical_role").alias("role"), own.alias("boost"), F.col("role_key").alias("key")), "role_key").alias("r")
    )
    return table_dictionary(first.select("alias", "r.*"), ["alias", "role", "boost"], ["key", "alias"])


def skill_dictionary(skills: DataFrame) -> DataFrame:
    """Keyword list for ``classify.extract_skills`` from the skill taxonomy, in the file's word order."""
    words = F.filter(F.transform(F.split(F.lower("aliases"), r"\|"), lambda w: F.trim(w)), lambda w: w != "")
    rows = skills.select(F.col("canonical_skill").alias("skill"), words.alias("words"), F.col("sector_key").alias("sector"), "skill_key")
    return table_dictionary(rows, ["skill", "words", "sector"], ["skill_key"])


def sector_dictionary(sectors: DataFrame) -> DataFrame:
    """Keyword list for ``classify.normalize_sectors`` from the sector taxonomy (top level 1, below it 2)."""
    words = exploded_words(sectors, "keywords", "keyword").withColumn("keyword", matching_sector_name(F.col("keyword")))
    level = F.when(F.coalesce("parent_sector", F.lit("")) == "", 1).otherwise(2)
    rows = words.filter("keyword <> ''").select("keyword", F.col("sector_key").alias("code"), level.alias("level")).distinct()
    return table_dictionary(rows, ["keyword", "code", "level"], ["keyword", "code"])
