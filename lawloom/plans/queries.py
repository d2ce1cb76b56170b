"""Queries over the driver's tables: each applies library operators to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.functions import codes, ids, text
from lawloom.functions.jsonblob import json_blob
from lawloom.operators import anomalies, enrich, passes, registry, rules, segment, validate, workflow
from lawloom.schemas import ENTRY
from lawloom.sources import publish, volumes, workspace
from lawloom.streaming import incremental

#: Terms that tagging queries look for.
TERMS = ["all rights reserved", "apache license", "gnu", "license", "thtion", "keit", "mente", "eaux", "idiot"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(docs: DataFrame) -> DataFrame:
    parts = docs.select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return parts.select("doc_id", "source", (F.col("n") + 1).cast("long").alias("line_no"), "line").where(~text.is_blank(F.col("line")))


@query
def segment_lines(spark, sf_dir):
    """Lines as sections of a document: repeats dropped, numbered, hashed and keyed."""
    lines = segment.distinct_first(_lines(_t(spark, sf_dir, "documents")), ["doc_id", "line"], [F.col("line_no")])
    numbered = segment.with_order(lines, ["doc_id"], [F.col("line_no")], "original_order")
    hashes = enrich.content_hash(lines, ["doc_id"], "line", "content_hash")
    keyed = numbered.join(hashes, "doc_id").withColumn("unique_key", F.concat_ws("-", F.format_string("%03d", "doc_id"), F.substring(F.md5(F.substring("line", 1, 3)), 1, 2)))
    keyed = enrich.suffix_keys(keyed, key="unique_key", order=["original_order"])
    return keyed.select("doc_id", "source", "line_no", "original_order", "unique_key", "content_hash", F.length("line").cast("long").alias("n_chars"))


@query
def dedup_keep_first(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.sha2("text", 256).alias("text_sha256"))
    return segment.distinct_first(d, ["text_sha256", "lang"], [F.col("doc_id")])


@query
def union_tagged(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.length("text").cast("long").alias("n_chars"), "lang")
    bench = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.length("text").cast("long").alias("n_chars"))
    return segment.union_tagged({"Section": docs, "Division": bench}, "entry_type")


@query
def union_terms(spark, sf_dir):
    """Set union of two lookup columns."""
    a = _t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("a"), F.lit(None).cast("string").alias("b"))
    b = _t(spark, sf_dir, "orders").select(F.lit(None).cast("string").alias("a"), F.col("o_orderpriority").alias("b"))
    return enrich.terms(a.unionByName(b), ["a", "b"])


@query
def selection_sample(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", F.split("text", "\n")[0].alias("name"), F.lit("").alias("title"))
    s = segment.sample(d, keys=["lang"], id_column="doc_id", n=50, where=segment.eligible("name", "title"))
    return s.select("doc_id", "lang", F.col("Selection").alias("selection"), F.col("Order").alias("order_no"))


def _volumes(spark, sf_dir):
    """Lines as extracted rows: a source is a volume, a document a law; one source may have most of the rows."""
    lines = _lines(_t(spark, sf_dir, "documents"))
    kind = F.when(F.col("line_no") % 3 == 0, "Division").otherwise("Section")
    return lines.select(F.col("source").alias("vol"), F.concat(F.lit("Public Law 1-"), F.col("doc_id").cast("string")).alias("LawIdentifier"), "line", kind.alias("EntryType"), (F.col("line_no") % 7).alias("counter"), F.col("line_no").alias("xml_index"), F.lit(None).cast("string").alias("error"))


@query
def volume_order(spark, sf_dir):
    """Rows numbered within volumes of any size, repeats of a law's content dropped."""
    t = segment.build(_volumes(spark, sf_dir))
    return t.select("vol", F.col("LawIdentifier").alias("law"), "xml_index", F.col("OriginalOrder").alias("original_order"))


@query
def selection_places(spark, sf_dir):
    """Which rows of a volume numpy's generator draws, and in what order they are shown."""
    t = segment.sample_like_numpy(segment.build(_volumes(spark, sf_dir)), keys=["vol"], order=[F.col("OriginalOrder")], where=F.col("EntryType") == "Section")
    return t.select("vol", F.col("OriginalOrder").alias("original_order"), F.col("Selection").alias("selection"), F.col("Order").alias("order_no"))


@query
def content_hash(spark, sf_dir):
    return enrich.content_hash(_t(spark, sf_dir, "conversations"), ["conv_id"], "text", "content_hash")


@query
def law_flag_semi(spark, sf_dir):
    """Orders with a returned line; the flag of each order."""
    li = _t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    return _t(spark, sf_dir, "orders").select("o_orderkey").join(li, "o_orderkey", "left").select("o_orderkey", F.coalesce("hit", F.lit(False)).alias("is_appropriation"))


@query
def group_flag(spark, sf_dir):
    """The same as a window over the rows of a law."""
    return enrich.exists_flag(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), ["l_orderkey"], F.col("l_returnflag") == "R", "is_appropriation")


@query
def existence_semi(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", "lang").join(_t(spark, sf_dir, "labels"), "doc_id", "left_semi")


@query
def missing_anti(spark, sf_dir):
    lacking = workspace.to_fetch(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("vol")), _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("vol")))
    return lacking.withColumnRenamed("vol", "doc_id")


def _tagged(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return enrich.tag_rows(d, ["text"], TERMS, "tags").drop("text")


@query
def agency_tags_row(spark, sf_dir):
    return publish.as_text(_tagged(spark, sf_dir))


@query
def agency_tags_law(spark, sf_dir):
    d = enrich.law_tags(_tagged(spark, sf_dir), ["source"], "tags", "law_tags")
    return publish.as_text(d.select("doc_id", "source", "law_tags"))


@query
def dictionary_ids(spark, sf_dir):
    """A dictionary of part types that grows by those it lacks."""
    p = _t(spark, sf_dir, "part")
    known = p.where("p_partkey <= 20").select(F.lower("p_type").alias("term")).distinct()
    # ids of the start are any fixed numbering
    start = known.join(known.select(F.col("term").alias("u")), F.col("u") <= F.col("term")).groupBy("term").agg(F.count("*").alias("id"))
    return enrich.grow_dictionary(start, p.select(F.col("p_type").alias("term"))).select("term", "id")


@query
def dictionary_lookup(spark, sf_dir):
    n, r = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region").where("r_regionkey <> 3")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
    return j.select("n_nationkey", "n_name", codes.heading_code(F.col("r_regionkey"), F.col("n_name")).alias("heading_code"), F.coalesce("r_name", F.lit("(blank)")).alias("region"))


def _law_id(key="o_orderkey", cust="o_custkey"):
    c, k = F.col(cust) % 120, F.col(key)
    return F.when(k % 5 == 0, F.concat(F.lit("Public Law "), c.cast("string"), F.lit("–"), k.cast("string"))).when(k % 5 == 1, F.concat(c.cast("string"), F.lit(" - "), k.cast("string"))).when(k % 5 == 2, F.concat(F.lit("75 Stat. "), k.cast("string"))).when(k % 5 == 3, F.concat(F.lit("Pub. L. "), c.cast("string"), F.lit("—"), k.cast("string"), F.lit(" note"))).otherwise(F.lit(None))


@query
def normalize_ids(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", _law_id().alias("law_id"))
    c = F.col("law_id")
    return o.select("o_orderkey", ids.normalize(c).alias("plain"), ids.published(c).alias("published"), ids.number(c).alias("number"), ids.pair(c, 1).alias("congress"), ids.pair(c, 2).alias("law"))


@query
def derive_ids(spark, sf_dir):
    """Identifiers from metadata of modern and of old volumes, and the repair of malformed ones."""
    k = F.col("o_orderkey")
    vol = (k % 40 + 50).cast("int")
    congress, number = (k % 90 + 30).cast("string"), F.col("o_custkey").cast("string")
    cited = F.when(k % 4 == 0, F.concat(F.lit("Public Law "), congress, F.lit("-"), number)).when(k % 4 == 1, F.concat(F.lit("75 Stat. "), number)).when(k % 4 == 2, F.concat(F.lit("Public Law "), congress, F.lit("–v")))
    note = F.when(k % 4 == 0, F.concat(F.lit("[Public Law "), number, F.lit("]"))).when(k % 4 == 1, F.concat(F.lit("Public, No. "), number, F.lit(".]"))).when(k % 4 == 2, F.concat(F.lit("Private Law "), number))
    o = _t(spark, sf_dir, "orders").select("o_orderkey", vol.alias("vol"), congress.alias("congress"), number.alias("number"), cited.alias("cited"), note.alias("note"))
    d = o.withColumn("law_id", ids.derive(F.col("vol"), F.col("cited"), F.col("note"), F.col("congress"), F.col("number")))
    return d.select("o_orderkey", "law_id", ids.repair(F.col("law_id"), F.col("congress"), F.col("number")).alias("repaired"))


@query
def alpha_code(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    letters = F.substring(F.regexp_replace("p_name", "[^A-Za-z]", ""), 1, 2)
    v = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" Division "), letters)).when(F.col("p_partkey") % 3 == 1, letters).otherwise(F.concat(letters, F.lit("1")))
    return p.select("p_partkey", codes.alpha_code(v, "DIVISION").alias("code"))


@query
def alpha_markers(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    n = (F.col("p_partkey") % 1500 + 1).cast("int")
    return p.select("p_partkey", codes.alpha_marker(n).alias("marker"))


def _roman():
    digits = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "IIII"]
    tens = ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "XC", "IX"]
    pick = lambda xs, n: F.element_at(F.array(*(F.lit(x) for x in xs)), (n % len(xs) + 1).cast("int"))
    return F.concat(F.lit("TITLE "), pick(tens, F.col("l_partkey")), pick(digits, F.col("l_suppkey") + F.col("l_linenumber")))


@query
def roman_code(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", codes.numeral_code(_roman(), "TITLE").alias("roman"), codes.numeral_code(F.concat(F.lit("chapter "), F.col("l_partkey").cast("string")), "CHAPTER").alias("numeric"))


def _section_number():
    k = F.col("l_partkey")
    return F.when(F.col("l_linenumber") == 1, F.lit(None)).when(k % 4 == 0, F.concat(F.lit("Sec. "), k.cast("string"), F.lit("."))).when(k % 4 == 1, F.concat(F.lit("SECTION "), k.cast("string"), F.lit("-ab"))).when(k % 4 == 2, F.concat(F.lit("U"), k.cast("string"))).otherwise("(blank)")


@query
def section_code(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumn("number", _section_number())
    return li.select("l_orderkey", "l_linenumber", codes.section_code(F.col("number")).alias("code"), codes.is_first_section(F.col("number")).alias("is_first"))


def _keyed(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    none = F.lit(None).cast("string")
    key = codes.unique_key(law_id=F.concat((F.col("l_orderkey") % 117).cast("string"), F.lit("–"), F.col("l_orderkey").cast("string")), division=F.concat(F.lit("DIVISION "), F.col("l_returnflag")), title=_roman(), subtitle=none, chapter=F.concat(F.lit("CHAPTER "), F.col("l_linenumber").cast("string")), subchapter=none, entry_type=F.when(F.col("l_linestatus") == "O", "Section").otherwise("Division"), section_number=_section_number(), heading_codes=[codes.heading_code(F.col("l_suppkey"), F.col("l_returnflag")), F.lit("00001"), F.lit("00001")])
    return li.select("l_orderkey", "l_linenumber", key.alias("unique_key"))


@query
def unique_key(spark, sf_dir):
    return _keyed(spark, sf_dir)


def _short_keys(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.lit("1-2-3-4-5-6"), F.col("l_returnflag"), F.lit("9")).alias("unique_key"))


@query
def key_suffix(spark, sf_dir):
    return enrich.suffix_keys(_short_keys(spark, sf_dir), key="unique_key", order=["l_linenumber"])


@query
def key_suffix_legacy(spark, sf_dir):
    return enrich.suffix_keys_in_type(_short_keys(spark, sf_dir), key="unique_key", order=["l_linenumber"])


@query
def duplicate_keys(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").groupBy(F.md5("text").alias("text_md5")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))
    return d.where("n > 1")


@query
def duplicate_groups_top6(spark, sf_dir):
    g = anomalies.duplicate_groups(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), key="o_custkey", order="o_orderkey", fields=["o_orderpriority"])
    listed = F.array_join(F.transform("rows", lambda r: F.concat_ws(":", r["o_orderkey"].cast("string"), r["o_orderpriority"])), "|")
    return g.select("o_custkey", "n", listed.alias("rows"), "truncated")


def _numbered(spark, sf_dir):
    number = F.when(F.col("event_id") % 11 == 0, None).otherwise(F.floor(F.col("event_id") / 40) + F.when(F.col("event_id") % 5 == 0, 2).otherwise(0))
    return _t(spark, sf_dir, "events").select("user_id", "event_id", number.cast("long").alias("number"))


@query
def sequence_anomalies(spark, sf_dir):
    return anomalies.sequence_anomalies(_numbered(spark, sf_dir), group=["user_id"], position="event_id", number="number")


@query
def neighbour_context(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    near = anomalies.neighbours(group=["user_id"], position="event_id", fields=["event_type"])
    e = e.withColumn("near", near)
    return e.select("user_id", "event_id", F.array_join(F.transform("near", lambda r: F.concat_ws(":", r["event_id"].cast("string"), r["event_type"])), "|").alias("near"))


@query
def null_ordinals(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.concat(F.lit("Sec. "), F.col("l_linenumber").cast("string"), F.lit("."))).alias("number"))
    return passes.null_ordinals(li, law=["l_orderkey"], number="number", order=["l_linenumber"])


@query
def heading_ordinals(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    name = F.substring("p_name", 1, 4)
    level2 = F.when(F.col("p_size") % 3 > 0, F.when(F.col("p_partkey") % 2 == 0, F.upper(name)).otherwise(F.lower(name)))
    rows = p.select("p_brand", "p_partkey", F.col("p_type").alias("level1"), level2.alias("level2"), F.lit(None).cast("string").alias("level3"))
    return passes.heading_ordinals(rows, law=["p_brand"], levels=["level1", "level2", "level3"], order=["p_partkey"])


@query
def sibling_blocks(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return passes.block_ordinals(li, group=["l_orderkey"], suffix=F.col("l_returnflag"), position="l_linenumber")


RULES = [("7-", "urgent", "8-1"), ("8-1", "urgent", "9-9"), ("11-", "(high)", "12-0")]
SECTION_RULES = [("1", "bolt", None, "SEC. 1."), ("2", "o", None, "SEC. 2."), ("1", "a", "steel", "SEC. 3.")]


@query
def rules_law_id(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws("-", (F.col("o_custkey") % 20).cast("string"), F.col("o_orderkey").cast("string")).alias("LawIdentifier"), F.regexp_replace("o_orderpriority", "^2-HIGH$", "2 (High)").alias("LawTitle"))
    return rules.apply(o, law_ids=RULES).select("o_orderkey", F.col("LawIdentifier").alias("law_id"))


def _ruled(spark, sf_dir, how):
    p = _t(spark, sf_dir, "part")
    c = how(F.col("p_brand"), F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_type"), SECTION_RULES)
    return p.select("p_partkey", c.alias("number"))


@query
def rules_section(spark, sf_dir):
    return _ruled(spark, sf_dir, rules.last_wins)


@query
def rules_first_match(spark, sf_dir):
    return _ruled(spark, sf_dir, rules.first_wins)


@query
def rule_mutations(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    after = rules.last_wins(F.col("p_brand"), F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_type"), SECTION_RULES)
    return p.agg(rules.mutations(F.col("p_brand"), after).alias("n_changed"))


def _table(spark, sf_dir):
    """Line items in the shape of a published table."""
    k, c = F.col("l_orderkey"), F.col("l_partkey")
    law = F.when(k % 97 == 0, "81-175").when(k % 89 == 0, "none").otherwise(F.concat_ws("-", (k % 60 + 60).cast("string"), (k % 500).cast("string")))
    title = F.when(k % 194 == 0, "Social Security Amendments").otherwise("An Act")
    return _t(spark, sf_dir, "lineitem").select((k % 7 + 110).cast("int").alias("vol"), F.concat_ws("-", law, c.cast("string")).alias("UniqueKey"), F.when(F.col("l_linestatus") == "O", "Section").when(k % 301 == 0, "Chapter").otherwise("Division").alias("EntryType"), law.alias("LawIdentifier"), title.alias("LawTitle"), F.lit("name").alias("SectionName"), F.lit("1").alias("SectionNumber"), F.when(c % 4 > 0, F.lit("text")).alias("Text"), (c % 50 == 0).cast("int").alias("Selection"))


@query
def validate_report(spark, sf_dir):
    m = validate.measures(_table(spark, sf_dir), ["vol"])
    r = validate.report(m)
    out = r.join(m.select("vol", "duplicate_keys", "bad_ids", "with_text", "selected", "law_0", F.size("bad_types").cast("long").alias("n_bad_types")), "vol")
    return out.select("vol", "row_count", "law_count", "duplicate_keys", "bad_ids", "with_text", "selected", F.col("law_0").alias("law_rule_0"), "n_bad_types", F.size("failed").cast("long").alias("n_failed"), F.size("warnings").cast("long").alias("n_warnings"), "status")


@query
def law_count_diff(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("laws"))
    li = _t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey").distinct()
    there = _t(spark, sf_dir, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderpriority").agg(F.count("*").alias("with_rows"))
    return o.join(there, "o_orderpriority", "left").select("o_orderpriority", "laws", F.coalesce("with_rows", F.lit(0).cast("long")).alias("with_rows"), (F.col("laws") - F.coalesce("with_rows", F.lit(0).cast("long"))).alias("missing"))


@query
def report_status(spark, sf_dir):
    some = lambda c: F.when(c, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return _t(spark, sf_dir, "events").select("event_id", validate.status(some(F.col("value") > 80), some(F.col("value") > 40)).alias("status"))


@query
def classify_family(spark, sf_dir):
    k = F.col("p_partkey")
    said = F.when(k % 6 == 0, "The SectionNumber is NULL here").when(k % 6 == 1, "<main> contains <part> only").when(k % 6 == 2, "two sibling <appropriations>").when(k % 6 == 3, "sibling <level> and no <num>").when(k % 6 == 4, F.col("p_name"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.first_match(said, rules.FAMILIES, "none").alias("family"))


@query
def registry_dedupe_seen_again(spark, sf_dir):
    e = _t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("id"), (F.count("*") - 1).alias("seen_again_count"))
    return e


@query
def issue_append(spark, sf_dir):
    """Rows whose key, letter case and outer space aside, the table lacks."""
    c = _t(spark, sf_dir, "customer")
    there = c.where("c_custkey % 3 = 0").select(F.upper("c_name").alias("name"), F.concat(F.lit(" "), F.col("c_mktsegment")).alias("kind"))
    return registry.append_new(there, c.select(F.col("c_name").alias("name"), F.lower("c_mktsegment").alias("kind")), ["name", "kind"])


@query
def run_summary(spark, sf_dir):
    return _t(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("priorities"))


@query
def active_over_pending(spark, sf_dir):
    a = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("active").alias("status"))
    p = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("pending").alias("status"))
    return registry.override_union(a, p, "id")


@query
def sme_view(spark, sf_dir):
    s = selection_sample(spark, sf_dir).withColumnsRenamed({"selection": "Selection", "order_no": "Order"})
    return publish.review_view(s).select("lang", F.col("Order").alias("order_no"), "doc_id")


@query
def publish_columns(spark, sf_dir):
    """The 26 columns in their order; absent ones are null."""
    d = _t(spark, sf_dir, "documents")
    t = d.select((F.col("doc_id") % 5).cast("int").alias("vol"), F.col("doc_id").cast("string").alias("UniqueKey"), F.concat(F.lit("106-"), F.col("doc_id").cast("string")).alias("LawIdentifier"), F.sha2("text", 256).alias("ContentHash"), (F.col("doc_id") % 3 == 0).cast("int").alias("Selection"), F.lit("Section").alias("EntryType"))
    return publish.as_text(publish.final(t))


@query
def blank_fill(spark, sf_dir):
    d = _t(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "fine").alias("verdict"))
    return publish.filled(d)


@query
def review_merge(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("UniqueKey"), "lang", F.lit("Pending").alias("ReviewStatus"))
    b = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("UniqueKey"), F.when(F.col("quality") == 1, "Approved").when(F.col("quality") == 0, "Rejected").alias("ReviewStatus"))
    return publish.merge_reviews(d, b).select(F.col("UniqueKey").alias("doc_id"), "lang", F.col("ReviewStatus").alias("review_status"))


@query
def markup_walk(spark, sf_dir):
    """Documents as volumes of markup, parsed back into rows: one section for each line."""
    safe = F.regexp_replace("text", "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    lines = F.filter(F.transform(F.split(F.replace(safe, F.lit("\r"), F.lit("")), "\n"), lambda x: text.strip(x)), lambda x: x != "")
    esc = lambda x: F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    sections = F.array_join(F.transform(lines, lambda x, i: F.concat(F.lit("<section><num>"), (i + 1).cast("string"), F.lit("</num><content>"), esc(x), F.lit("</content></section>"))), "")
    xml = F.concat(F.lit('<uslm xmlns="http://schemas.gpo.gov/xml/uslm"><pLaw><publicPrivate>public</publicPrivate><citableAs>Public Law 99-1</citableAs><approvedDate>1964-07-07</approvedDate><officialTitle>T</officialTitle><docTitle>AN ACT</docTitle><main>'), sections, F.lit("</main></pLaw></uslm>"))
    files = _t(spark, sf_dir, "documents").select((F.col("doc_id") + 1000).cast("int").alias("vol"), xml.cast("binary").alias("content"))
    rows = volumes.law_rows(volumes.identified(volumes.read_laws(files).where("error is null")))
    return rows.where("error is null").select((F.col("vol") - 1000).cast("long").alias("doc_id"), (F.col("counter") + 1).alias("line_no"), F.col("SectionNumber").alias("number"), F.md5("Text").alias("text_md5"))


@query
def json_extract(spark, sf_dir):
    said = F.concat(F.lit("The answer is {as asked}: "), F.col("props"), F.lit(" - done."))
    e = _t(spark, sf_dir, "events").select("event_id", json_blob(said).alias("blob"))
    return e.select("event_id", F.from_json("blob", "k long").getField("k").alias("k"))


@query
def incremental_skip(spark, sf_dir):
    """Orders that are new or changed since the last snapshot."""
    digest = F.md5(F.concat_ws("|", "o_orderstatus", "o_orderpriority", F.col("o_custkey").cast("string")))
    now = _t(spark, sf_dir, "orders").select("o_orderkey", digest.alias("digest"))
    seen = now.where("o_orderkey % 2 = 0").withColumn("digest", F.when(F.col("o_orderkey") % 10 == 0, "old").otherwise(F.col("digest")))
    return incremental.pending(now, seen, key="o_orderkey", digest="digest")


@query
def incremental_state(spark, sf_dir):
    k = F.col("o_orderkey")
    old = F.when(k % 4 == 0, None).when(k % 4 == 1, "a").otherwise("b")
    return _t(spark, sf_dir, "orders").select("o_orderkey", incremental.state(old, F.lit("a"), F.when(k % 3 == 0, "failed").otherwise("published")).alias("state"))


@query
def anomaly_report(spark, sf_dir):
    """The first 80 anomalies: a report."""
    return anomalies.top(sequence_anomalies(spark, sf_dir).select("user_id", "event_id", "kind"), ["user_id", "event_id", "kind"])


def _entries(spark, sf_dir):
    """Suppliers as registry entries: kinds, triggers and states by their numbers."""
    k = F.col("s_suppkey")
    m = lambda name, v: F.create_map(F.lit(name), v.cast("string"))
    kind = F.when(k % 3 == 0, "law_id").when(k % 3 == 1, "section_number").otherwise("other")
    base = _t(spark, sf_dir, "supplier").select(k.cast("long").alias("id"), kind.alias("type"), m("pattern", F.col("s_nationkey")).alias("trigger"), m("description", k % 4).alias("correction"), F.when(k % 5 == 0, "approved").otherwise("pending").alias("status"), F.col("s_nationkey").cast("int").alias("discovered_in_vol"), F.when(k % 7 == 0, "failed").when(k % 7 == 1, "implemented").alias("implementation_status"))
    have = {f: t for f, t in base.dtypes}
    return base.select(*(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in ENTRY))


@query
def registry_append(spark, sf_dir):
    """Proposals into a registry: known ones are counted, new ones come in once."""
    old = registry.append_pending(_entries(spark, sf_dir).limit(0), _entries(spark, sf_dir).withColumn("proposed_at", F.lit("a")), next_id=1)
    c = _t(spark, sf_dir, "customer")
    kind = F.when(F.col("c_custkey") % 4 == 0, "law_id").when(F.col("c_custkey") % 4 == 1, "other").when(F.col("c_custkey") % 4 == 2, "section_number").otherwise("strange")
    m = lambda name, v: F.create_map(F.lit(name), v.cast("string"))
    new = c.select(kind.alias("type"), m("pattern", F.col("c_nationkey")).alias("trigger"), m("description", F.col("c_custkey") % 8).alias("correction"), F.lit("b").alias("proposed_at"))
    got = registry.append_pending(old, new, next_id=1_000_000)
    return got.select("type", F.element_at("trigger", "pattern").alias("pattern"), F.element_at("correction", "description").alias("description"), "status", "seen_again_count", (F.col("id") >= 1_000_000).alias("is_new"))


@query
def registry_review(spark, sf_dir):
    """Promotion, rejection, marking and backfill; which entries may be called applied."""
    e = _entries(spark, sf_dir)
    e = registry.move(e, [1, 2, 3, 4, 5, 6], to="approved", reviewer="r", at="now")
    e = registry.move(e, [7, 8, 5], to="rejected", reviewer="s", note="no")
    e = registry.backfill(registry.mark(e, [2, 3], implementation_status="in_progress"))
    done = registry.applied(e).select("id", F.lit(True).alias("applied"))
    return e.join(done, "id", "left").select("id", "status", "reviewer", "review_note", "implementation_status", F.coalesce("applied", F.lit(False)).alias("applied"))


@query
def status_fan_out(spark, sf_dir):
    e = _entries(spark, sf_dir)
    tables = {"active": e.where("status = 'approved'"), "pending": e.where("status = 'pending'")}
    out = workflow.fan_out(tables, [5, 6, 7], "implemented", sha="abc")
    return segment.union_tagged({k: v.select("id", "implementation_status", "implementation_commit_sha") for k, v in out.items()}, "file")


@query
def proposals_to_entries(spark, sf_dir):
    """Reviewers' answers in free text into entries."""
    k = F.col("event_id")
    kind = F.when(k % 4 == 0, '"type": "law_id", ').when(k % 4 == 1, '"type": "other", ').when(k % 4 == 2, '"type": "odd", ').otherwise("")
    said = F.concat(F.lit('So: {"proposals": [{'), kind, F.lit('"trigger": {"pattern": "'), F.col("event_type"), F.lit('"}, "more": 1, "confidence": 0.5}], "issues": []} - end'))
    e = _t(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("vol"), workflow.answers(json_blob(said)).alias("a"))
    got = workflow.entries(e.select("vol", F.inline("a.proposals")), agent_version="v", at="now")
    return got.select("type", F.element_at("trigger", "pattern").alias("pattern"), F.size("correction").cast("long").alias("n_correction"), "discovered_in_vol", "agent_version", "confidence", "status", F.get("applied_in_runs", 0)["vol"].alias("run_vol"), "seen_again_count")


def _issues(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select((F.col("doc_id") % 9).cast("int").alias("vol"), F.when(F.col("doc_id") % 2 == 0, 7).cast("int").alias("volume"), F.col("source").alias("citable_as"), F.lit(None).cast("string").alias("congress"), F.col("lang").alias("issue"), F.lit(None).cast("string").alias("should_say"), F.col("text").alias("text_says"), F.lit("x").alias("location_in_xml"), (F.col("doc_id") % 50).cast("string").alias("line_numbers"))


@query
def issue_rows(spark, sf_dir):
    r = workflow.issue_rows(_issues(spark, sf_dir))
    return r.select(F.col("Citable As").alias("citable_as"), F.col("Volume").alias("volume"), F.col("Congress").alias("congress"), "issue", F.length("text_says").cast("long").alias("n_chars"), F.md5("text_says").alias("text_md5"), "line_numbers")


@query
def issue_log(spark, sf_dir):
    """New issues by volume, citation, lines and issue, whatever the letter case."""
    rows = workflow.issue_rows(_issues(spark, sf_dir))
    there = rows.where("Volume < 4").withColumns({"issue": F.upper("issue"), "Citable As": F.concat(F.lit(" "), F.col("Citable As"))})
    return workflow.new_issues(there, rows).select(F.lower("Citable As").alias("citable_as"), F.col("Volume").alias("volume"), "issue", "line_numbers")


@query
def issue_coverage(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select((F.col("event_id") % 40).cast("int").alias("vol"), "event_type")
    return workflow.coverage(e.where("event_type = 'view' or vol < 20"), e.where("vol % 3 > 0 and event_type <> 'view'"))


@query
def coder_gates(spark, sf_dir):
    k = F.col("p_partkey")
    status = F.when(k % 5 == 0, "failed").when(k % 5 < 4, "success")
    files = F.when(k % 3 == 0, F.array(F.lit("parser/a.py"), F.col("p_brand"))).when(k % 3 == 1, F.array(F.lit("tests/x.py"), F.lit("pipeline/corrections_registry.py"))).otherwise(F.array(F.lit("pipeline/b.py")))
    return _t(spark, sf_dir, "part").select("p_partkey", workflow.gate(status, files, F.when(k % 2 == 0, F.array(F.lit("t")))).alias("why"))


@query
def family_batches(spark, sf_dir):
    """Families of entries and the batch that each becomes."""
    e = _entries(spark, sf_dir).withColumns({"type": F.lit("other"), "trigger": F.create_map(F.lit("pattern"), F.when(F.col("id") % 4 == 0, "sibling <level>").when(F.col("id") % 4 == 1, "SectionNumber is NULL").otherwise("else"))})
    b = workflow.task(workflow.family_members(registry.backfill(e), pending_only=True))
    return b.select("family", "task_id", F.array_join(F.transform("entry_ids", lambda i: i.cast("string")), "|").alias("entry_ids"))


@query
def affected_volumes(spark, sf_dir):
    """The volumes that entries of a family concern: by their reports, and where they were found."""
    o = _t(spark, sf_dir, "orders")
    said = F.when(F.col("o_custkey") % 3 == 0, F.array(F.concat(F.col("o_orderkey").cast("string"), F.lit(" rows share a UniqueKey")))).otherwise(F.array(F.lit("text coverage 0.1")))
    reports = o.select((F.col("o_orderkey") % 5000).cast("int").alias("vol"), said.alias("warnings"), F.array().cast("array<string>").alias("failed"))
    entry = _entries(spark, sf_dir).where("id = 1").withColumn("trigger", F.create_map(F.lit("pattern"), F.lit("Two sibling <LEVEL> blocks")))
    return registry.volumes_of(entry, reports)


@query
def last_runs(spark, sf_dir):
    g = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("runs"))
    return g.select("o_custkey", F.array_join(F.transform(workflow.last_runs(F.col("runs")), lambda x: x.cast("string")), "|").alias("runs"))


@query
def duplicate_context(spark, sf_dir):
    """Repeated keys with their laws and what is known of those."""
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("UniqueKey"), F.col("o_orderkey").alias("OriginalOrder"), F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderpriority")).alias("LawIdentifier"))
    laws = _t(spark, sf_dir, "nation").select(F.concat_ws("-", (F.col("n_nationkey") + 1).cast("string"), F.when(F.col("n_nationkey") == 0, "URGENT").otherwise("HIGH")).alias("LawIdentifier"), F.col("n_name").alias("citable_as"), F.lit(None).cast("string").alias("statutes_citation"), F.col("n_nationkey").cast("int").alias("sourceline"), F.lit(9).alias("line_end"), F.lit("a/b").alias("tag_path")).where("sourceline < 2")
    g = anomalies.duplicate_context(o, laws, fields=["LawIdentifier"])
    told = F.transform("per_law_context", lambda c: F.concat_ws(":", c["law_identifier"], c["citable_as"], c["tag_path"]))
    return g.select("UniqueKey", "n", F.size("rows").cast("long").alias("n_rows"), "truncated", F.array_join("law_identifiers", "|").alias("law_identifiers"), F.array_join(told, "|").alias("context"))


@query
def schema_diff(spark, sf_dir):
    """A table that lacks columns and has others: what its report says."""
    t = _table(spark, sf_dir).withColumn("more", F.lit(1))
    r = validate.report(validate.measures(t, ["vol"]), columns=publish.output_columns(t))
    starts = lambda c, p: F.filter(c, lambda x: F.startswith(x, F.lit(p)))
    return r.select("vol", F.array_join(starts("failed", "missing columns"), "|").alias("missing"), F.array_join(starts("warnings", "extra columns"), "|").alias("extra"), "status")


@query
def law_count_check(spark, sf_dir):
    """Laws of a table against those of its source, as the report warns of them."""
    t = _table(spark, sf_dir)
    public = t.where("EntryType = 'Section'").groupBy("vol").agg(F.countDistinct("LawIdentifier").alias("public_count"))
    r = validate.report(validate.measures(t, ["vol"]), public)
    said = F.array_join(F.filter("warnings", lambda x: F.contains(x, F.lit("in the source"))), "|")
    return r.select("vol", said.alias("said"), F.array_join(F.filter("failed", lambda x: F.contains(x, F.lit("malformed"))), "|").alias("malformed"))


@query
def appropriation_laws(spark, sf_dir):
    return workspace.appropriation_laws(_table(spark, sf_dir).distinct()).withColumnRenamed("isAppropriation", "is_appropriation")


@query
def dictionary_volumes(spark, sf_dir):
    """A dictionary grown by many volumes at once, numbered as if one by one."""
    known = _t(spark, sf_dir, "region").select(F.lower("r_name").alias("term"), (F.col("r_regionkey") + 1).alias("id"))
    terms = _t(spark, sf_dir, "part").select((F.col("p_partkey") % 5).alias("vol"), F.concat(F.lit(" "), F.upper(F.col("p_type"))).alias("term"))
    return enrich.grow_dictionary(known, terms)


@query
def older_codes(spark, sf_dir):
    said = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Division "), F.col("p_name"))).when(F.col("p_partkey") % 3 == 1, F.col("p_name")).when(F.col("p_partkey") % 2 == 0, "7 x")
    return _t(spark, sf_dir, "part").select("p_partkey", codes.first_letter_code(said, "DIVISION").alias("code"))


@query
def files_to_fetch(spark, sf_dir):
    """Orders of an index that a folder lacks."""
    index = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("vol"), "o_orderstatus")
    return workspace.to_fetch(index, _t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("vol")))


WALK_PATHS = ["", "level", "title/level", "title", "title/chapter/level", "title/chapter", "title/part/chapter/level", "title/part/chapter", "title/subtitle/level", "title/subtitle", "division", "division/title/subtitle/level", "division/title/subtitle", "division/title/level", "division/title", "title/part", "division/title/chapter", "division/title/part/chapter", "title/chapter/subchapter"]
WALK_BLOCKS = ["", "title/chapter", "title/part/chapter", "title", "division/title", "division"]


def _walked(spark, sf_dir, paths, leaf, **how):
    """Parts as laws, each a body nested along one of the paths, parsed and walked."""
    k = F.col("p_partkey")
    cases = None
    for n, p in enumerate(paths):
        parts = p.split("/") if p else []
        head = F.lit("".join(f"<{x}><num>{x.upper()} 1</num>" for x in parts))
        body = F.concat(head, leaf, F.lit("".join(f"</{x}>" for x in reversed(parts))))
        cases = F.when(k % len(paths) == n, body) if cases is None else cases.when(k % len(paths) == n, body)
    xml = F.concat(F.lit('<uslm xmlns="http://schemas.gpo.gov/xml/uslm"><pLaw><publicPrivate>public</publicPrivate><citableAs>Public Law 99-1</citableAs><approvedDate>1964-07-07</approvedDate><officialTitle>T</officialTitle><docTitle>AN ACT</docTitle><main>'), cases, F.lit("</main></pLaw></uslm>"))
    files = _t(spark, sf_dir, "part").select((k + 1000).cast("int").alias("vol"), xml.cast("binary").alias("content"))
    rows = volumes.law_rows(volumes.identified(volumes.read_laws(files).where("error is null")), **how).where("error is null")
    return rows.select((F.col("vol") - 1000).cast("long").alias("p_partkey"), "EntryType", "Division", "Title", "SubTitle", "Chapter", "SubChapter", "SectionNumber", "SectionName", "DivisionHeadingLevel1", "DivisionHeadingLevel2", "Text")


@query
def walk_paths(spark, sf_dir):
    """A section below every path of containers."""
    leaf = F.concat(F.lit("<section><num>SEC. "), F.col("p_size").cast("string"), F.lit(".</num><heading>"), F.col("p_name"), F.lit("</heading><content>"), F.col("p_type"), F.lit("</content></section>"))
    return _walked(spark, sf_dir, WALK_PATHS, leaf)


@query
def walk_paths_strict(spark, sf_dir):
    """The same bodies, where only the known paths are open; others are recovered as headings, but not from divisions."""
    leaf = F.concat(F.lit("<section><num>SEC. "), F.col("p_size").cast("string"), F.lit(".</num><heading>"), F.col("p_name"), F.lit("</heading><content>"), F.col("p_type"), F.lit("</content></section>"))
    return _walked(spark, sf_dir, WALK_PATHS, leaf, strict=True)


@query
def walk_blocks(spark, sf_dir):
    """Nested appropriations below every path of containers that has them."""
    leaf = F.concat(F.lit("<appropriations><heading>"), F.col("p_brand"), F.lit("</heading><appropriations><heading>"), F.col("p_name"), F.lit("</heading><content>"), F.col("p_type"), F.lit("</content></appropriations></appropriations>"))
    return _walked(spark, sf_dir, WALK_BLOCKS, leaf)


@query
def walk_compat(spark, sf_dir):
    """What stands beside chapters of a division's title comes again under each of them."""
    leaf = F.concat(F.lit("<division><num>D</num><title><num>T</num><level><section><num>1</num><content>"), F.col("p_type"), F.lit("</content></section></level><section><num>2</num><content>"), F.col("p_name"), F.lit("</content></section><appropriations><heading>H</heading><content>"), F.col("p_brand"), F.lit("</content></appropriations><chapter><num>CHAPTER 1</num></chapter><part><chapter><num>CHAPTER 2</num></chapter></part></title></division>"))
    return _walked(spark, sf_dir, [""], leaf, compat=True)


@query
def walk_recovery(spark, sf_dir):
    """Bodies that give no row otherwise: nested parts, blocks alone, subsections, quotes, bare text."""
    k, t = F.col("p_partkey"), lambda c: F.col(c)
    sec = F.concat(F.lit("<section><num>9</num><content>"), t("p_type"), F.lit("</content></section>"))
    body = (
        F.when(k % 5 == 0, F.concat(F.lit("<part><num>PART I</num><heading>-X</heading>"), sec, F.lit("</part>")))
        .when(k % 5 == 1, F.concat(F.lit("<part><num>PART I</num><heading>-X</heading><appropriations><heading>"), t("p_brand"), F.lit("</heading><content>"), t("p_name"), F.lit("</content></appropriations></part>")))
        .when(k % 5 == 2, F.concat(F.lit("<subsection><num>(a)</num><content> "), t("p_name"), F.lit("</content></subsection><subsection><num>(b)</num><content> y</content></subsection>")))
        .when(k % 5 == 3, F.concat(F.lit("<quotedContent> "), t("p_name"), F.lit(" </quotedContent>")))
        .otherwise(F.concat(F.lit("<p>"), t("p_name"), F.lit("</p><content>two</content>")))
    )
    return _walked(spark, sf_dir, [""], body)


@query
def law_sequence(spark, sf_dir):
    """Laws in the order of their file, with lines, ancestors, identifiers and numbers."""
    k = F.col("s_suppkey")
    one = F.concat(F.lit("\n<pLaw><publicPrivate>"), F.when(k % 4 == 0, "private").otherwise("public"), F.lit("</publicPrivate>\n<citableAs>Public Law 99-"), k.cast("string"), F.lit("</citableAs><main><section>\n</section></main></pLaw>"))
    docs = _t(spark, sf_dir, "supplier").groupBy((F.col("s_nationkey") + 100).cast("int").alias("vol")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), one.alias("x")))), lambda e: e["x"]), "").alias("x"))
    files = docs.select("vol", F.concat(F.lit('<uslm xmlns="http://schemas.gpo.gov/xml/uslm">'), "x", F.lit("</uslm>")).cast("binary").alias("content"))
    s = volumes.sequence(volumes.read_laws(files))
    return s.select("vol", "xml_index", "citable_as", "law_number", "is_public", "sourceline", "line_end", "tag_path")
