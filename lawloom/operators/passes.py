"""Repairs after extraction: ordinals and markers that keep keys apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lawloom.functions import codes, text


def null_ordinals(df: DataFrame, *, law: list[str], number: str, order: list) -> DataFrame:
    """U1, U2, ... for missing section numbers of a law with several of them, or with a section 1 beside them."""
    c = F.col(number)
    # a number of parts that is given is not cut down where rows are short, so one task's sort stays small
    df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *law)
    # rows with a number come first, so a missing one has them all before it, and others that are missing right after it:
    # one window and one sort give everything, in frames that only look back
    w = Window.partitionBy(*law).orderBy(c.isNull(), *order)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.sum(c.isNull().cast("int")).over(back)
    taken = F.max((c.isNotNull() & codes.is_first_section(c)).cast("int")).over(back) == 1
    several = (n >= 2) | F.lead(F.lit(True)).over(w).isNotNull()
    return df.withColumn(number, F.when(c.isNull() & (several | taken), F.concat(F.lit("U"), n.cast("string"))).otherwise(c))


def heading_ordinals(df: DataFrame, *, law: list[str], levels: list[str], order: list) -> DataFrame:
    """' 2', ' 3', ... after the deepest heading of later rows of a law with equal heading paths, letter case aside."""
    path = [F.lower(F.coalesce(F.col(c), F.lit(""))) for c in levels]
    n = F.row_number().over(Window.partitionBy(*law, *path).orderBy(*order))
    df = df.withColumn("__n", n)
    for i, c in enumerate(levels):
        deepest = F.col(c).isNotNull()
        for later in levels[i + 1 :]:
            deepest = deepest & F.col(f"__was_{later}").isNull()
        df = df.withColumns({f"__was_{x}": F.col(x) for x in levels[i + 1 :]}) if i == 0 else df
        df = df.withColumn(c, F.when((F.col("__n") > 1) & deepest, F.concat_ws(" ", c, F.col("__n").cast("string"))).otherwise(F.col(c)))
    return df.drop("__n", *(f"__was_{x}" for x in levels[1:]))


def block_ordinals(df: DataFrame, *, group: list[str], suffix, position: str, name: str = "block") -> DataFrame:
    """0 for a group's first rows, one more whenever a suffix has come before within the current block.

    The set of suffixes starts anew with each block, which no window frame can express: the group's (position, suffix)
    pairs are folded in order. A group is one law's container, so its array is small.
    """
    pairs = df.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), suffix.alias("s")))).alias("a"))
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("seen"), F.lit(0).alias("b"), F.array().cast("array<int>").alias("o"))

    def step(acc, e):
        again = F.array_contains(acc["seen"], e["s"])
        b = F.when(again, acc["b"] + 1).otherwise(acc["b"])
        seen = F.when(again, F.array(e["s"])).otherwise(F.concat(acc["seen"], F.array(e["s"])))
        return F.struct(seen.alias("seen"), b.alias("b"), F.concat(acc["o"], F.array(b)).alias("o"))

    folded = pairs.withColumn("o", F.aggregate("a", start, step, lambda acc: acc["o"]))
    places = folded.select(*group, F.explode(F.arrays_zip("a", "o")).alias("x")).select(*group, F.col("x.a.p").alias(position), F.col("x.o").alias(name))
    return places


def sibling_levels(df: DataFrame, *, law: list[str], position: str) -> DataFrame:
    """B, C, ... in the first empty of SubTitle, Chapter and SubChapter for repeated blocks of section numbers."""
    containers = ["Title", "SubTitle", "Chapter", "SubChapter"]
    keyed = df.withColumns({f"__{c}": text.strip(F.coalesce(F.col(c), F.lit(""))) for c in containers})
    group = [*law, *(f"__{c}" for c in containers)]
    sections = keyed.where("EntryType = 'Section'")
    blocks = block_ordinals(sections, group=group, suffix=codes.section_code(F.col("SectionNumber")), position=position).select(*law, position, "block")
    out = keyed.join(blocks, [*law, position], "left").withColumn("block", F.coalesce("block", F.lit(0)))
    marker, free = codes.alpha_marker(F.col("block")), F.col("block") > 0
    sub, chap = F.col("__SubTitle") == "", F.col("__Chapter") == ""
    out = out.withColumns(
        {
            "SubTitle": F.when(free & sub, marker).otherwise(F.col("SubTitle")),
            "Chapter": F.when(free & ~sub & chap, marker).otherwise(F.col("Chapter")),
            "SubChapter": F.when(free & ~sub & ~chap, F.concat_ws(" ", F.nullif("__SubChapter", F.lit("")), marker)).otherwise(F.col("SubChapter")),
        }
    )
    return out.drop("block", *(f"__{c}" for c in containers))


def repair(rows: DataFrame) -> DataFrame:
    """All passes over extracted rows, in their order. Rows need vol, xml_index and counter."""
    law, order = ["vol", "LawIdentifier"], [F.col("xml_index"), F.col("counter")]
    keyed = rows.withColumn("__at", F.struct("xml_index", "counter"))
    sections = null_ordinals(keyed.where("EntryType = 'Section'"), law=law, number="SectionNumber", order=order)
    sections = sibling_levels(sections, law=law, position="__at")
    divisions = heading_ordinals(keyed.where("EntryType <> 'Section'"), law=law, levels=["DivisionHeadingLevel1", "DivisionHeadingLevel2", "DivisionHeadingLevel3"], order=order)
    return sections.unionByName(divisions).drop("__at")
