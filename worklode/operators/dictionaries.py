"""Word lists of any size as tables, and texts matched against them by indexes over their words and q-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklode.session import write_table

FEW = 64  # a list of so many terms needs no index
GRAM = 3  # length of the q-grams that terms are looked up by; shorter terms are their own gram


def literal_dictionary(rows: list[dict], fields: list[str]) -> DataFrame:
    """A configured word list with its order in ``ord``; its column types follow from the values."""
    spark = SparkSession.active()
    listed = [F.struct(*[F.lit(r[f]).alias(f) for f in fields], F.struct(F.lit(i).alias("at")).alias("ord")) for i, r in enumerate(rows)]
    return spark.range(1).select(F.inline(F.array(*listed)))


def table_dictionary(df: DataFrame, fields: list[str], order: list[str]) -> DataFrame:
    """The same from a table of any size; ``ord`` holds the columns it is ordered by and is only compared, never counted."""
    return df.select(*fields, F.struct(*order).alias("ord"))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` refers to it in a lambda."""
    return F.transform(F.array(value), use)[0]


def grams(text: str, size: Column) -> Column:
    """The substrings of ``size`` characters, each once; none of a shorter text."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(text), i, size)))


def contained(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, term: str) -> DataFrame:
    """(keys, term) for every distinct term that occurs anywhere in a text, as plain text; any number of terms and texts.

    Texts are cut at spaces, and so are terms.  The longest part of a term has to lie inside a word of the text (at its end
    or start, if other parts come before or behind), so only distinct words are searched.  Parts stand in an inverted index
    below the one of their q-grams that the fewest parts have, and a word is compared with the parts below its own q-grams.
    A term of several parts is then compared with the texts that have its word.  Nothing is missed, and no text meets all
    terms; only a list of FEW or fewer is looked for in every text as it is.  ``keys`` are unique in ``texts``; terms
    without any character but spaces are left out.
    """
    listed = terms.select(F.col(term).alias("_term")).filter(F.trim("_term") != "").distinct()
    lines = texts.select(*keys, F.col(text).alias("_text"))
    few = [r["_term"] for r in listed.limit(FEW + 1).collect()]
    if len(few) <= FEW:
        there = F.filter(F.array(*map(F.lit, few)).cast("array<string>"), lambda t: F.contains("_text", t))
        return lines.select(*keys, F.explode(there).alias(term))
    parts = F.transform(F.split("_term", " "), lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("neg"), p.alias("part")))
    anchor = listed.withColumn("_longest", F.array_max(parts)).withColumn("_parts", F.size(F.split("_term", " ")))
    anchor = anchor.select(
        "_term", F.col("_longest.part").alias("_part"), (F.col("_parts") > 1).alias("_several"),
        (F.col("_longest.neg") < 0).alias("_at_start"), (F.col("_parts") - 1 > -F.col("_longest.neg")).alias("_at_end"),
    )

    words = lines.select(*keys, F.explode(F.array_distinct(F.split("_text", " "))).alias("_word")).filter("_word <> ''")
    looked = anchor.select("_part").distinct().withColumn("_size", F.least(F.length("_part"), F.lit(GRAM)))
    sizes = looked.agg(F.collect_set("_size")).scalar()  # three numbers at most
    looked = looked.select("_part", F.explode(grams("_part", F.col("_size"))).alias("_gram"))
    often = looked.groupBy("_gram").count()
    index = looked.join(often, "_gram").groupBy("_part").agg(F.min(F.struct("count", "_gram"))["_gram"].alias("_gram"))
    vocabulary = words.select("_word").distinct().select("_word", F.explode(sizes).alias("_size"))
    near = vocabulary.select("_word", F.explode(grams("_word", F.col("_size"))).alias("_gram")).join(index, "_gram")
    near = near.filter(F.contains("_word", F.col("_part"))).select("_word", "_part")
    fits = (~F.col("_at_start") | F.startswith("_word", F.col("_part"))) & (~F.col("_at_end") | F.endswith("_word", F.col("_part")))
    # Written once: both kinds of terms are read from it, and it is small beside the texts.
    found = write_table(near.join(anchor, "_part").filter(fits).select("_word", "_term", "_several"))
    hits = words.join(found.filter("not _several"), "_word").select(*keys, F.col("_term").alias(term)).distinct()
    if found.filter("_several").isEmpty():
        return hits
    some = words.join(found.filter("_several"), "_word").select(*keys, "_term").distinct()
    whole = some.join(lines, keys).filter(F.contains("_text", F.col("_term")))
    return hits.unionByName(whole.select(*keys, F.col("_term").alias(term)))


def match_words(texts: DataFrame, key: str, text: str, terms: DataFrame, term: str) -> DataFrame:
    """(key, term columns) for every term that occurs in a text as whole words: any number of terms of any length.

    A term is looked up by the one of its words that the fewest texts have; where that word occurs, a term of
    several words is then compared with the text.  ``key`` is unique in ``texts``.
    """
    apart = r"[^\p{L}\p{N}#+]+"
    lines = texts.select(key, F.filter(F.split(F.lower(text), apart), lambda w: w != "").alias("_words"))
    found = lines.select(key, F.explode(F.array_distinct("_words")).alias("_word"))
    wanted = terms.withColumn("_run", F.trim(F.regexp_replace(F.lower(term), apart, " "))).filter("_run <> ''")
    parts = wanted.select("_run", F.explode(F.split("_run", " ")).alias("_word")).distinct()
    often = found.join(parts.select("_word").distinct(), "_word", "left_semi").groupBy("_word").count()
    rarest = parts.join(often, "_word").groupBy("_run").agg(F.min(F.struct("count", "_word"))["_word"].alias("_word"))
    near = found.join(rarest, "_word").select(key, "_run")
    several = F.col("_run").contains(" ")
    spaced = F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" "))
    whole = near.filter(several).join(lines.select(key, spaced.alias("_line")), key)
    whole = whole.filter(F.col("_line").contains(F.concat(F.lit(" "), "_run", F.lit(" "))))
    return near.filter(~several).unionByName(whole.select(key, "_run")).join(wanted, "_run").drop("_run")
