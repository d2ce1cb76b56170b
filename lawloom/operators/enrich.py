"""Tags, flags, hashes, dictionary ids and keys."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.functions import codes, text

LEVELS = ["DivisionHeadingLevel1", "DivisionHeadingLevel2", "DivisionHeadingLevel3"]
TAGGED = ["SectionName", "Text", "LawTitle", "DivisionHeadingLevel1"]
#: Dictionary terms that are folded into an expression; a longer dictionary is matched by one Python pass.
LITERAL_TERMS = 2000


def terms(lookup: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct lower-cased terms of several columns."""
    out = None
    for c in columns:
        part = lookup.select(F.lower(text.strip(F.col(c))).alias("term")).where("term is not null and term <> '' and term <> 'nan'")
        out = part if out is None else out.union(part)
    return out.distinct()


def tags(columns: list[str], known: list[str]) -> Column:
    """The sorted distinct terms that any of the columns contains; null if there is none.

    Columns are searched as one text, parted by a character that no term holds, so each term is looked for once.
    """
    whole = F.lower(F.concat_ws("\u0000", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))
    found = F.filter(F.array(*(F.lit(t) for t in sorted(set(known)))), lambda t: F.contains(whole, t)) if known else F.array().cast("array<string>")
    return F.when(F.size(found) > 0, found)


def tag_rows(df: DataFrame, columns: list[str], known: list[str], name: str = "Agencies_Row") -> DataFrame:
    if len(known) <= LITERAL_TERMS:
        return df.withColumn(name, tags(columns, known))
    import ahocorasick

    shared = df.sparkSession.sparkContext.broadcast(sorted(set(known)))

    @F.pandas_udf("array<string>")
    def search(whole: pd.Series) -> pd.Series:
        a = ahocorasick.Automaton()
        for t in shared.value:
            a.add_word(t, t)
        a.make_automaton()
        return whole.map(lambda t: sorted({w for _, w in a.iter(t)}) or None)

    return df.withColumn(name, search(F.lower(F.concat_ws("\u0000", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))))


def law_tags(df: DataFrame, law: list[str], row: str = "Agencies_Row", name: str = "Agencies_Law") -> DataFrame:
    """The union of a law's row tags on each of its rows; an empty list if there is none."""
    by_law = df.select(*law, F.explode(row).alias("__t")).distinct().groupBy(*law).agg(F.array_sort(F.collect_list("__t")).alias(name))
    return df.join(by_law, law, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))


def exists_flag(df: DataFrame, law: list[str], condition: Column, name: str) -> DataFrame:
    """Whether any row of the law meets the condition."""
    return df.withColumn(name, F.coalesce(F.max(condition.cast("int")).over(Window.partitionBy(*law)), F.lit(0)) == 1)


def content_hash(df: DataFrame, law: list[str], column: str = "Text", name: str = "ContentHash") -> DataFrame:
    """A hash of each group's texts that are not blank, sorted and put together; null for a group without any."""
    kept = df.where(~text.is_blank(F.col(column))).groupBy(*law).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(column)), ""), 256).alias(name))
    return kept


def grow_dictionary(known: DataFrame, values: DataFrame) -> DataFrame:
    """term, id of a dictionary with the new values after the old ones, in their order.

    ``known`` has term, id; ``values`` has term and may have vol: then the terms of a lower volume come first, as if the
    volumes had been added one by one. Ids are numbered from the size of the dictionary on.
    """
    size = known.count()
    vol = F.col("vol").cast("long") if "vol" in values.columns else F.lit(0).cast("long")
    new = values.select(F.lower(text.strip(F.col("term"))).alias("term"), vol.alias("vol")).where("term is not null and term not in ('', 'nan')").groupBy("term").agg(F.min("vol").alias("vol")).join(known, "term", "left_anti")
    # ranks without one task for all new terms: counts of what sorts before a volume and first pair of characters, then numbers within it
    new = new.select("term", F.struct("vol", F.substring("term", 1, 2).alias("start")).alias("__p"))
    ranked = new.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy("term")))
    before = new.groupBy("__p").count().select(F.col("__p").alias("__q"), (F.sum("count").over(Window.orderBy("__p")) - F.col("count")).alias("__before"))
    numbered = ranked.join(before, F.col("__p") == F.col("__q"))
    return known.select("term", F.col("id").cast("long")).unionByName(numbered.select("term", (F.lit(size) + F.col("__before") + F.col("__n")).cast("long").alias("id")))


def headings(df: DataFrame) -> DataFrame:
    return df.select("vol", F.explode(F.array(*LEVELS)).alias("term"))


def unique_keys(df: DataFrame, dictionary: DataFrame, *, version: str) -> DataFrame:
    """UniqueKey and KeyVersion. The dictionary (term, id) is joined once for each heading level."""
    out = df
    for n, c in enumerate(LEVELS):
        d = dictionary.select(F.col("term").alias(f"__t{n}"), F.col("id").alias(f"__id{n}"))
        out = out.join(d, F.lower(text.strip(F.col(c))) == F.col(f"__t{n}"), "left")
    key = codes.unique_key(law_id=F.col("LawIdentifier"), division=F.col("Division"), title=F.col("Title"), subtitle=F.col("SubTitle"), chapter=F.col("Chapter"), subchapter=F.col("SubChapter"), entry_type=F.col("EntryType"), section_number=F.col("SectionNumber"), heading_codes=[codes.heading_code(F.col(f"__id{n}"), F.col(c)) for n, c in enumerate(LEVELS)])
    return out.withColumn("UniqueKey", key).withColumn("KeyVersion", F.lit(version)).drop(*(f"__{x}{n}" for n in range(3) for x in ("t", "id")))


def suffix_keys(df: DataFrame, *, key: str, order: list, scope: list[str] = ()) -> DataFrame:
    """k, k-1, k-2, ... for repeated keys."""
    n = F.row_number().over(Window.partitionBy(*scope, key).orderBy(*order)) - 1
    return df.withColumn("__n", n).withColumn(key, F.when(F.col("__n") > 0, F.concat_ws("-", key, F.col("__n").cast("string"))).otherwise(F.col(key))).drop("__n")


def suffix_keys_in_type(df: DataFrame, *, key: str, order: list) -> DataFrame:
    """The older form: S becomes S1, S2, ... in the eighth part of repeated keys."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    parts = F.split(F.col(key), "-")
    eighth = F.transform(parts, lambda p, i: F.when((i == 7) & (F.col("__n") > 0), F.concat(p, F.col("__n").cast("string"))).otherwise(p))
    return df.withColumn("__n", n).withColumn(key, F.array_join(eighth, "-")).drop("__n")


def enrich(df: DataFrame, *, agencies: list[str], dictionary: DataFrame, version: str) -> DataFrame:
    """Tags, appropriation flag, content hash and keys of a segment table."""
    law = ["vol", "LawIdentifier"]
    df = law_tags(tag_rows(df, TAGGED, agencies), law)
    df = exists_flag(df, law, F.col("EntryType") == "Division", "IsAppropriation")
    df = df.join(content_hash(df, law), law, "left")
    return unique_keys(df, dictionary, version=version)
