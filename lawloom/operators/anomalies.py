"""Anomalies of numbered sequences, duplicate keys, and the rows around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sequence_anomalies(df: DataFrame, *, group: list[str], position: str, number: str, at_least: int = 2) -> DataFrame:
    """kind, with the first place of a duplicate, for suspect rows of each group.

    unparseable: no number. duplicate: a number seen before. Among first occurrences: suspect_endpoint (the first or
    last, if it breaks with the two next to it, which follow each other), out_of_place (its neighbours are two apart),
    gap (it does not follow the one before). Groups of fewer rows than ``at_least`` have no anomalies.
    """
    n, p = F.col(number), F.col(position)
    by_number = Window.partitionBy(*group, number).orderBy(position)
    whole = Window.partitionBy(*group)
    df = df.withColumns({"__size": F.count("*").over(whole), "__rn": F.row_number().over(by_number), "__first": F.first(position).over(by_number)}).where(F.col("__size") >= at_least)
    odd = df.where(n.isNull() | (F.col("__rn") > 1)).withColumn("kind", F.when(n.isNull(), "unparseable").otherwise("duplicate")).withColumn("duplicate_of", F.when(n.isNotNull(), F.col("__first")))
    firsts = df.where(n.isNotNull() & (F.col("__rn") == 1))
    w = Window.partitionBy(*group).orderBy(position)
    firsts = firsts.withColumns({"__p": F.lag(number, 1).over(w), "__pp": F.lag(number, 2).over(w), "__nx": F.lead(number, 1).over(w), "__nn": F.lead(number, 2).over(w)})
    P, PP, NX, NN = (F.col(x) for x in ("__p", "__pp", "__nx", "__nn"))
    kind = (
        F.when(P.isNull(), F.when((NX - n != 1) & (NN - NX == 1), "suspect_endpoint"))
        .when(NX.isNull(), F.when((n - P != 1) & (P - PP == 1), "suspect_endpoint"))
        .when((n - P != 1) | (NX - n != 1), F.when(NX - P == 2, "out_of_place").when(n - P != 1, "gap"))
    )
    breaks = firsts.withColumn("kind", kind).where("kind is not null").withColumn("duplicate_of", F.lit(None).cast(df.schema[position].dataType)).drop("__p", "__pp", "__nx", "__nn")
    return odd.unionByName(breaks).drop("__size", "__rn", "__first")


def neighbours(*, group: list[str], position: str, fields: list[str], reach: int = 3, name: str = "neighbours") -> Column:
    """The rows up to ``reach`` before and after, without the row itself, in order."""
    w = Window.partitionBy(*group).orderBy(position).rowsBetween(-reach, reach)
    own = F.col(position)
    return F.filter(F.collect_list(F.struct(position, *fields)).over(w), lambda x: x[position] != own).alias(name)


def duplicate_groups(df: DataFrame, *, key: str, order: str, fields: list[str], most: int = 6) -> DataFrame:
    """Keys that repeat: how many rows, the first few of them, and whether there are more.

    Counts are made before any row moves; of a key's rows only the first few are gathered.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    w = Window.partitionBy(key).orderBy(order)
    some = df.join(counts, key).withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= most)
    return some.groupBy(key, "n").agg(F.sort_array(F.collect_list(F.struct(order, *fields))).alias("rows")).withColumn("truncated", F.col("n") > most)


def duplicate_context(df: DataFrame, laws: DataFrame, *, key: str = "UniqueKey", order: str = "OriginalOrder", law: str = "LawIdentifier", fields: list[str], most: int = 6) -> DataFrame:
    """duplicate_groups with the group's law identifiers (distinct, rising) and, for each, what ``laws`` knows of it.

    laws has ``law``, citable_as, statutes_citation, sourceline, line_end and tag_path; a law that it lacks is cited as itself.
    """
    groups = duplicate_groups(df, key=key, order=order, fields=fields, most=most)
    own = df.join(groups.select(key), key, "left_semi").where(F.col(law).isNotNull()).select(key, F.col(law).cast("string").alias(law)).distinct()
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    known = own.join(laws.dropDuplicates([law]), law, "left")
    each = F.struct(F.col(law).alias("law_identifier"), F.coalesce("citable_as", F.col(law)).alias("citable_as"), blank("statutes_citation"), "sourceline", "line_end", blank("tag_path"))
    context = known.groupBy(key).agg(F.array_sort(F.collect_list(each)).alias("per_law_context"))
    none = F.array().cast(context.schema["per_law_context"].dataType)
    out = groups.join(context, key, "left").withColumn("per_law_context", F.coalesce("per_law_context", none))
    return out.withColumn("law_identifiers", F.col("per_law_context.law_identifier"))


def top(df: DataFrame, order: list, n: int = 80) -> DataFrame:
    """The first n rows: a report."""
    return df.orderBy(*order).limit(n)
