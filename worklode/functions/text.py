"""Text rules of the feed as Column expressions (no Python per row)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from worklode.functions import fixed_values as fixed


def stored_company_name(name: Column) -> Column:
    """Upper case, without commas, dots and legal forms standing as words of their own."""
    forms = "|".join(fixed.STORED_NAME_FORMS)
    bare = F.regexp_replace(F.upper(F.trim(name)), "[,.]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, rf"\b({forms})\b", ""), r"\s+", " "))


def matching_company_name(name: Column) -> Column:
    """Lower case, punctuation to spaces, suffix words dropped, spaces squeezed; null becomes ''."""
    words = "|".join(fixed.COMPANY_SUFFIXES)
    spaced = F.regexp_replace(F.lower(F.trim(name)), r"[.,\-_]", " ")
    return F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(spaced, rf"\b({words})\b", ""), r"\s+", " ")), F.lit(""))


def matching_sector_name(name: Column) -> Column:
    """Lower-case words without the stop words."""
    words = F.split(F.lower(F.trim(name)), r"\s+")
    stop = F.array(*[F.lit(w) for w in fixed.SECTOR_STOP_WORDS])
    return F.coalesce(F.array_join(F.filter(words, lambda w: ~F.array_contains(stop, w)), " "), F.lit(""))


def stored_title(title: Column) -> Column:
    return F.upper(F.trim(title))


def stored_location(location: Column) -> Column:
    return F.initcap(F.trim(location))


def untagged_title(title: Column) -> Column:
    """Lower case without gender notes."""
    lowered = F.lower(F.trim(title))
    return F.trim(reduce(lambda c, tag: F.replace(c, F.lit(tag), F.lit("")), fixed.GENDER_TAGS, lowered))


def remote_type(location: Column, remote_flag: Column, description: Column) -> Column:
    """UNKNOWN without any text; else HYBRID or REMOTE by word or flag; else ONSITE."""

    def says(word: str) -> Column:
        return F.lower(F.coalesce(location, F.lit(""))).contains(word) | F.lower(
            F.coalesce(description, F.lit(""))
        ).contains(word)

    blank = (F.coalesce(location, F.lit("")) == "") & (F.coalesce(description, F.lit("")) == "")
    remote = F.coalesce(remote_flag, F.lit(False)) | says("remote")
    return F.when(blank, "UNKNOWN").when(remote & says("hybrid"), "HYBRID").when(remote, "REMOTE").otherwise("ONSITE")


def record_hash(columns: list[str | Column], null_as: str = "") -> Column:
    """SHA-256 of the fields joined by '|'; a null keeps its place, so fields cannot shift."""
    cells = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_as)) for c in columns]
    return F.sha2(F.concat_ws("|", *cells), 256)


def is_sha256(col: Column) -> Column:
    return F.coalesce(col.rlike("^[0-9a-f]{64}$"), F.lit(False))


def seniority(role: Column) -> Column:
    return reduce(
        lambda acc, pair: acc.when(role.contains(pair[0]), pair[1]), fixed.SENIORITY_WORDS, F.when(F.lit(False), "")
    ).otherwise("MID")


def location_parts(location: Column) -> list[Column]:
    """City, state and country of 'city', 'city, country' or 'city, state, country'."""
    parts = F.transform(F.split(location, ","), lambda p: F.trim(p))
    size = F.size(parts)
    return [
        F.element_at(parts, 1).alias("city"),
        F.when(size >= 3, F.get(parts, F.lit(1))).alias("state"),
        F.when(size >= 3, F.get(parts, F.lit(2))).when(size == 2, F.get(parts, F.lit(1))).otherwise("Unknown").alias("country"),
    ]


def first_group_hit(text: Column, groups: dict[str, list[str]]) -> Column:
    """Name of the first group with a word contained in the text (order of the groups decides)."""

    def hit(lowered: Column) -> Column:
        tests = [(name, reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])) for name, words in groups.items()]
        return reduce(lambda acc, test: acc.when(test[1], test[0]), tests, F.when(F.lit(False), ""))

    return F.transform(F.array(F.lower(text)), hit)[0]  # bound, so the text is lowered once and not once per word


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def quarantine_reason(required: list[str], title: Column, description: Column, posted: Column, as_of: str) -> Column:
    """Why a record is set aside: missing field before implausible date before suspicious content."""
    now = F.lit(as_of).cast("timestamp")
    missing = reduce(lambda a, b: a | b, [F.coalesce(F.trim(F.col(c)), F.lit("")) == "" for c in required])
    implausible = (posted > now) | (posted < F.add_months(now, -12))
    suspicious = (
        (count_char(title, "!") > 2) | (count_char(description, "!") > 5)
        | (count_char(description, "$") > 3) | (F.length(description) > 5000)
    )
    return (
        F.when(missing, "MISSING_REQUIRED_FIELD").when(implausible, "INVALID_DATE").when(suspicious, "SUSPICIOUS_CONTENT")
    )
