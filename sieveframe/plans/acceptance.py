"""Acceptance queries: one call of the library per query on the driver's tables,
with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    as_type, call_function, field, geodist, hash_rand_int, instant_column, log10, mul, rand_int,
    register_function,
)
from ..operators import (
    apply_filters, bit_all_filter, bit_any_filter, build_filter, classify_requests, copy_field,
    delete_by_ids, delete_by_query, export_sorted, filter_in, find_hot_keys, get_by_ids, in_filter,
    is_update_request,
    log_history, lookup, match_rules, name_tree, normalize_code, parse_request_log, range_filter,
    register_filter, request_params, terms_doc_freq, unknown_code, upsert_latest,
    with_constant_score, with_defaults,
)
from ..sources import Catalog, shared_dir
from ..streaming import HistorySink, UpsertTable, read_stream, run_available
from .request import asc, deep_page, desc, num_found, select, sort_columns

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their label's quality; missing where there is no label."""
    return lookup(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "quality")


# --- scans and key access -------------------------------------------------------


@query("select * from nation")
def d_scan(spark, d):
    catalog = Catalog()
    catalog.register_parquet(spark, "nation", f"{d}/nation.parquet", "n_nationkey")
    return catalog.table("nation")


@query("select o_orderkey, o_totalprice from orders where o_orderkey between 100 and 2000")
def d_key_range(spark, d):
    return select(
        table(spark, d, "orders"), where=range_filter("o_orderkey", "[100 TO 2000]"),
        fields=["o_orderkey", "o_totalprice"], rows=None,
    )


# --- filters --------------------------------------------------------------------


@query("select l_orderkey,l_linenumber,l_quantity from lineitem where l_linenumber in (2,3)")
def f_in_int(spark, d):
    df = apply_filters(table(spark, d, "lineitem"), in_filter("l_linenumber", "(2, 3)"))
    return df.select("l_orderkey", "l_linenumber", "l_quantity")


@query("select c_custkey,c_mktsegment from customer where c_mktsegment in ('BUILDING','MACHINERY')")
def f_in_string(spark, d):
    df = apply_filters(table(spark, d, "customer"), in_filter("c_mktsegment", "(BUILDING, MACHINERY)"))
    return df.select("c_custkey", "c_mktsegment")


@query("select d.doc_id, l.quality from documents d left join labels l on d.doc_id=l.doc_id"
       " where l.quality is null or not (l.quality in (1))")
def f_in_not_nullsafe(spark, d):
    return apply_filters(labelled(spark, d), in_filter("quality", "1", not_=True)).select("doc_id", "quality")


@query("select c_custkey, c_name from customer c where not exists"
       " (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderstatus = 'F')")
def f_in_table(spark, d):
    listed = apply_filters(table(spark, d, "orders"), in_filter("o_orderstatus", "F")).select("o_custkey")
    return filter_in(table(spark, d, "customer"), "c_custkey", listed, not_=True).select("c_custkey", "c_name")


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey % 3 = 0 and l_orderkey between 3 and 9000")
def f_in_long_list(spark, d):
    """A list of 3,000 values, and one that equals nothing."""
    lines = table(spark, d, "lineitem")
    return filter_in(lines, "l_orderkey", [str(i) for i in range(3, 9001, 3)] + [None]).select("l_orderkey", "l_linenumber")


@query("select p_partkey,p_size from part where p_size >= 10 and p_size <= 20")
def f_range_closed(spark, d):
    return apply_filters(table(spark, d, "part"), range_filter("p_size", "[10 TO 20]")).select("p_partkey", "p_size")


@query("select p_partkey,p_size from part where p_size > 10 and p_size <= 20")
def f_range_half_open(spark, d):
    return apply_filters(table(spark, d, "part"), range_filter("p_size", "(10 TO 20]")).select("p_partkey", "p_size")


@query("select p_partkey,p_size from part where p_size < 15")
def f_range_unbounded(spark, d):
    return apply_filters(table(spark, d, "part"), range_filter("p_size", "[* TO 15)")).select("p_partkey", "p_size")


@query("select p_partkey,p_retailprice from part where p_retailprice > 950 and p_retailprice <= 1100.5")
def f_range_params(spark, d):
    price = build_filter("range", "p_retailprice", l="950", u="1100.5", incl=False)
    return apply_filters(table(spark, d, "part"), price).select("p_partkey", "p_retailprice")


@query("select p_partkey, p_retailprice from part where log10(p_retailprice) >= 2.97 and log10(p_retailprice) <= 2.99")
def f_range_expr(spark, d):
    df = apply_filters(table(spark, d, "part"), range_filter(log10("p_retailprice"), "[2.97 TO 2.99]"))
    return df.select("p_partkey", "p_retailprice")


@query("select o_orderkey,o_orderdate from orders where o_orderdate >= timestamp '1995-01-01 00:00:00'"
       " and o_orderdate < timestamp '1996-01-01 00:00:00'")
def f_range_timestamp(spark, d):
    year = range_filter("o_orderdate", "[1995-01-01T00:00:00Z TO 1995-01-01T00:00:00Z+1YEAR)")
    return apply_filters(table(spark, d, "orders"), year).select("o_orderkey", "o_orderdate")


@query("select d.doc_id, l.quality from documents d left join labels l on d.doc_id=l.doc_id"
       " where l.quality is null or not (l.quality >= 1 and l.quality <= 1)")
def f_range_not_nullsafe(spark, d):
    return apply_filters(labelled(spark, d), range_filter("quality", "[1 TO 1]", not_=True)).select("doc_id", "quality")


@query("select c_custkey,c_nationkey from customer where (cast(c_nationkey as bigint) & 9) <> 0")
def f_bit_any(spark, d):
    return apply_filters(table(spark, d, "customer"), bit_any_filter("c_nationkey", "(0b1000, 0x1)")).select("c_custkey", "c_nationkey")


@query("select c_custkey,c_nationkey from customer where (cast(c_nationkey as bigint) & 9) = 9")
def f_bit_all(spark, d):
    return apply_filters(table(spark, d, "customer"), bit_all_filter("c_nationkey", "(9)")).select("c_custkey", "c_nationkey")


@query("select l_orderkey,l_linenumber,l_quantity from lineitem where (cast(trunc(l_quantity) as bigint) & 6) = 6")
def f_bit_all_double(spark, d):
    df = apply_filters(table(spark, d, "lineitem"), bit_all_filter("l_quantity", "(2, 4)"))
    return df.select("l_orderkey", "l_linenumber", "l_quantity")


@query("select c_custkey,c_nationkey from customer where not ((cast(c_nationkey as bigint) & 9) <> 0)")
def f_bit_not(spark, d):
    return apply_filters(table(spark, d, "customer"), ~bit_any_filter("c_nationkey", "9")).select("c_custkey", "c_nationkey")


@query("select d.doc_id, (coalesce(l.quality,0) & 1) <> 0 as any_hit, (coalesce(l.quality,0) & 0) = 0 as all_zero_hit"
       " from documents d left join labels l on d.doc_id=l.doc_id")
def f_bit_missing_is_zero(spark, d):
    fields = ["doc_id", ("any_hit", bit_any_filter("quality", "1")), ("all_zero_hit", bit_all_filter("quality", "0"))]
    return select(labelled(spark, d), fields=fields, rows=None)


@query("select l_orderkey,l_linenumber,l_quantity from lineitem where l_linenumber in (1,2,3)"
       " and l_quantity >= 10 and l_quantity < 30 and (cast(trunc(l_quantity) as bigint) & 1) <> 0")
def f_conjunction(spark, d):
    return select(
        table(spark, d, "lineitem"),
        where=in_filter("l_linenumber", "(1, 2, 3)"),
        filters=[range_filter("l_quantity", "[10 TO 30)"), bit_any_filter("l_quantity", "1")],
        fields=["l_orderkey", "l_linenumber", "l_quantity"], rows=None,
    )


@query("select p_partkey, cast(1.0 as float) as score from part where p_size in (1,2)")
def f_constant_score(spark, d):
    df = with_constant_score(apply_filters(table(spark, d, "part"), in_filter("p_size", "(1, 2)")))
    return df.select("p_partkey", "score")


@query("select p_partkey, p_name from part where not starts_with(p_name, 'red')")
def f_custom(spark, d):
    register_filter("starts", lambda column, dtype, value: column.startswith(value))
    return apply_filters(table(spark, d, "part"), build_filter("starts", "p_name", "red", not_=True)).select("p_partkey", "p_name")


# --- rule matching ----------------------------------------------------------------

RULES_SQL = (
    "with rules(rule_id,op,lo,hi,mask) as (values (1,'range',10,20,null),(2,'bit',null,null,9),(3,'cbit',null,null,9))"
    " select p_partkey, rule_id from part, rules where (op='range' and p_size between lo and hi)"
    " or (op='bit' and (p_size & mask)<>0) or (op='cbit' and (p_size & mask)=mask)"
)
RULE_SCHEMA = "rule_id int, op string, value_text string, not boolean"


@query(RULES_SQL)
def r_match_rules(spark, d):
    rules = spark.createDataFrame(
        [(1, "range", "[10 TO 20]", False), (2, "bit", "(8, 1)", False), (3, "cbit", "0b1001", False)], RULE_SCHEMA
    )
    return match_rules(table(spark, d, "part"), "p_partkey", "p_size", rules)


# Rules made from a table: one of each kind per nation, around its key.
NATION_RULES = {
    "in": ("n_nationkey", "concat('(', n_nationkey, ', ', n_nationkey + 25, ')')", "false"),
    "range": ("n_nationkey + 100", "concat('[', n_nationkey, ' TO ', n_nationkey + 3, ')')", "false"),
    "cbit": ("n_nationkey + 200", "concat('(', n_nationkey, ')')", "false"),
    "not in": ("n_nationkey + 300", "concat('(', n_nationkey, ', 7)')", "true"),
    "open range": ("n_nationkey + 400", "concat('(', n_nationkey + 20, ' TO *]')", "false"),
}
NATION_RULES_SQL = (
    "select p_partkey, n_nationkey as rule_id from part, nation where p_size in (n_nationkey, n_nationkey + 25)"
    " union all select p_partkey, n_nationkey + 100 from part, nation where p_size >= n_nationkey and p_size < n_nationkey + 3"
    " union all select p_partkey, n_nationkey + 200 from part, nation where (p_size & n_nationkey) = n_nationkey"
    " union all select p_partkey, n_nationkey + 300 from part, nation where p_size not in (n_nationkey, 7)"
    " union all select p_partkey, n_nationkey + 400 from part, nation where p_size > n_nationkey + 20"
)


def nation_rules(spark, d):
    nation = table(spark, d, "nation")
    parts = [
        nation.selectExpr(f"{rule_id} as rule_id", f"'{kind.split()[-1]}' as op", f"{text} as value_text", f"{negated} as not")
        for kind, (rule_id, text, negated) in NATION_RULES.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(NATION_RULES_SQL)
def r_match_rule_table(spark, d):
    return match_rules(table(spark, d, "part"), "p_partkey", "p_size", nation_rules(spark, d))


@query(NATION_RULES_SQL)
def r_match_rules_shuffled(spark, d):
    """The plan for rule sets too large to broadcast."""
    return match_rules(table(spark, d, "part"), "p_partkey", "p_size", nation_rules(spark, d), broadcast_rules=40)


# --- lookups ----------------------------------------------------------------------


@query("select d.doc_id, l.quality from documents d left join labels l on d.doc_id=l.doc_id")
def l_lookup_object(spark, d):
    return labelled(spark, d).select("doc_id", "quality")


@query("select d.doc_id, cast(coalesce(l.quality,0) as double)*2 as v from documents d left join labels l on d.doc_id=l.doc_id")
def l_lookup_numeric(spark, d):
    df = lookup(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", "quality", mode="numeric")
    return df.select("doc_id", mul("quality", 2).alias("v"))


@query("select d.doc_id, l.doc_id is not null as hit from documents d left join labels l on d.doc_id=l.doc_id")
def l_lookup_exists(spark, d):
    df = lookup(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", "quality", mode="exists", name="hit")
    return df.select("doc_id", "hit")


@query("select c.c_custkey, o.o_orderkey from customer c left join (select o_custkey,o_orderkey,"
       " row_number() over (partition by o_custkey order by o_orderdate,o_orderkey) rn from orders) o"
       " on c.c_custkey=o.o_custkey and o.rn=1")
def l_lookup_first_match(spark, d):
    first = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    df = lookup(table(spark, d, "customer"), table(spark, d, "orders"), "c_custkey", "o_orderkey",
                target_key="o_custkey", order=first)
    return df.select("c_custkey", "o_orderkey")


@query("select d.doc_id, cast(coalesce(l.quality,0) as double)*2 as v from documents d left join labels l"
       " on d.doc_id=l.doc_id order by v desc, d.doc_id limit 10")
def l_lookup_sort_topk(spark, d):
    df = lookup(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", "quality", mode="numeric")
    return select(df, fields=["doc_id", ("v", mul("quality", 2))], order=[desc(mul("quality", 2))], key="doc_id")


@query("select d.doc_id, coalesce(l.quality, 0) as quality, coalesce(l.toxic, 0) as toxic from documents d left join labels l on d.doc_id=l.doc_id")
def l_lookup_fields(spark, d):
    df = lookup(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", ["quality", "toxic"], mode="numeric")
    return df.select("doc_id", "quality", "toxic")


@query("select d.doc_id, d.lang, coalesce(l.quality, case when l.doc_id is null then -1 end) as quality"
       " from documents d left join labels l on d.doc_id=l.doc_id")
def l_lookup_ref_default(spark, d):
    catalog = Catalog()
    catalog.register("documents", table(spark, d, "documents"), "doc_id")
    catalog.register("labels", table(spark, d, "labels"), "doc_id", defaults={"quality": -1})
    return catalog.lookup("documents", "labels.quality", name="quality").select("doc_id", "lang", "quality")


@query("select l_orderkey, l_linenumber, l_partkey, n_name from lineitem left join nation on l_linenumber = n_nationkey")
def l_lookup_hot_keys(spark, d):
    """Every line number holds more than a tenth of the rows; the nations are kept from a broadcast."""
    items = table(spark, d, "lineitem")
    hot = find_hot_keys(items, "l_linenumber", share=0.1)
    if not hot:
        raise AssertionError("no hot key in lineitem")
    df = lookup(items, table(spark, d, "nation"), "l_linenumber", "n_name", target_key="n_nationkey",
                hot_keys=hot, spread_by=["l_orderkey", "l_partkey"], may_broadcast=False)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "n_name")


@query("select event_id, event_type, n from events join (select event_type as t, count(*) as n from events group by event_type) on event_type = t")
def l_lookup_hot_keys_found(spark, d):
    """The hot keys are looked for, and whole rows part them."""
    events = table(spark, d, "events")
    counts = events.groupBy("event_type").agg(F.count("*").alias("n"))
    return lookup(events, counts, "event_type", "n", may_broadcast=False).select("event_id", "event_type", "n")


@query("select o_orderkey, min(l_partkey) as part from orders left join lineitem on o_orderkey = l_orderkey group by o_orderkey")
def l_lookup_catalog_repeated_key(spark, d):
    """A catalog lookup sees one row per key, though orders have several lines."""
    catalog = Catalog()
    catalog.register("orders", table(spark, d, "orders"), "o_orderkey")
    catalog.register("lines", table(spark, d, "lineitem"), "l_orderkey")
    return catalog.lookup("orders", "lines.l_partkey", name="part").select("o_orderkey", "part")


@query("select d.doc_id, l.quality from documents d join labels l on d.doc_id=l.doc_id where l.quality in (1) and d.lang in ('en','de')")
def l_lookup_filter(spark, d):
    return apply_filters(
        labelled(spark, d), in_filter("quality", "1"), in_filter("lang", "(en, de)")
    ).select("doc_id", "quality")


# --- aliases ----------------------------------------------------------------------


def parties(spark, d) -> Catalog:
    catalog = Catalog()
    catalog.register("customer", table(spark, d, "customer").selectExpr(
        "c_custkey as id", "c_name as name", "c_mktsegment as segment"), "id")
    catalog.register("supplier", table(spark, d, "supplier").selectExpr("s_suppkey as id", "s_name as name"), "id")
    catalog.alias("party", "customer, supplier, customer")
    return catalog


@query("select c_custkey as id, c_name as name, c_mktsegment as segment from customer"
       " union all select s_suppkey, s_name, null from supplier")
def l_alias_union(spark, d):
    return parties(spark, d).table("party")


# --- order, pages, counts -----------------------------------------------------------


@query("select p_partkey,p_size from part order by p_size desc, p_partkey limit 10 offset 20")
def o_page(spark, d):
    return select(table(spark, d, "part"), fields=["p_partkey", "p_size"], order=["p_size desc"], start=20, key="p_partkey")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100 offset 7000")
def o_deep_page(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return deep_page(orders, ["o_totalprice desc", "o_orderkey"], 7000, 100)


@query("select c_custkey as id, c_mktsegment as segment from customer union all select s_suppkey, null from supplier"
       " order by segment desc nulls last, id limit 30 offset 1490")
def o_missing_last(spark, d):
    df = parties(spark, d).table("party")
    return select(df, fields=["id", "segment"], order=["segment desc"], start=1490, rows=30, key=["id", "name"])


@query("select d.doc_id, l.quality from documents d left join labels l on d.doc_id=l.doc_id"
       " order by l.quality asc nulls first, d.doc_id limit 500")
def o_missing_first(spark, d):
    return select(labelled(spark, d), fields=["doc_id", "quality"], order=[asc("quality")], rows=500, key="doc_id")


@query("select p_partkey from part")
def o_random_order(spark, d):
    return select(table(spark, d, "part"), fields=["p_partkey"], order=[desc(rand_int(seed=7))], rows=None)


@query("select p_partkey, cast(p_size as double) * 2 as twice from part order by p_size desc, p_partkey limit 20")
def s_field(spark, d):
    """A field named as a function, in a sort and in a value."""
    return select(
        table(spark, d, "part"), fields=["p_partkey", ("twice", mul(field("p_size"), 2))], order=[desc(field("p_size"))],
        key="p_partkey", rows=20,
    )


@query("select r_regionkey, case r_regionkey when 0 then 'LookupError' when 1 then 'ReadOnlyError' when 2 then 'LookupError'"
       " when 3 then 'ValueError' else 'fine' end as outcome from region")
def d_errors(spark, d):
    """What is refused: an unknown collection, a change to a read-only one, a lookup of an unknown field, a name in use."""
    regions = table(spark, d, "region")
    catalog = Catalog()
    catalog.register("regions", regions, "r_regionkey", read_only=True)
    catalog.register("nations", table(spark, d, "nation"), "n_regionkey")
    cases = [
        lambda: catalog.table("nowhere"),
        lambda: catalog.upsert("regions", regions, "r_regionkey"),
        lambda: catalog.lookup("regions", "nations.nothing"),
        lambda: catalog.lookup("regions", "nations.n_name", name="r_name"),
        lambda: catalog.lookup("regions", "nations.n_name", name="n_name"),
    ]
    outcome = F.lit(None).cast("string")
    for number, case in enumerate(cases):
        try:
            case()
            said = "fine"
        except Exception as error:
            said = type(error).__name__
        outcome = F.when(F.col("r_regionkey") == number, said).otherwise(outcome)
    return regions.select("r_regionkey", outcome.alias("outcome"))


@query("select count(*) as num_found from part where p_size in (1,2)")
def o_num_found(spark, d):
    return num_found(table(spark, d, "part"), filters=[in_filter("p_size", "(1, 2)")])


# --- projections --------------------------------------------------------------------


@query("select p_partkey, p_name, round(log10(p_retailprice),6) as log_price from part")
def p_fields(spark, d):
    fields = ["p_partkey", "p_name", ("log_price", F.round(log10("p_retailprice"), 6))]
    return select(table(spark, d, "part"), fields=fields, rows=None)


@query("select l_orderkey, l_linenumber, cast(trunc(l_extendedprice) as int) as as_int,"
       " cast(((cast(trunc(l_extendedprice) as bigint) + 128) % 256) - 128 as tinyint) as as_byte,"
       " l_discount <> 0 as as_bool, cast(l_linenumber as double) as as_double, true as has_value from lineitem")
def p_typed_access(spark, d):
    fields = [
        "l_orderkey", "l_linenumber", ("as_int", as_type("l_extendedprice", "int")),
        ("as_byte", as_type("l_extendedprice", "byte")), ("as_bool", as_type("l_discount", "bool")),
        ("as_double", as_type("l_linenumber", "double")), ("has_value", as_type("l_tax", "exists")),
    ]
    return select(table(spark, d, "lineitem"), fields=fields, rows=None)


@query("select doc_id, cast(coalesce(quality,0) as double)*2 as sort_1, lang as sort_2 from"
       " (select d.doc_id, d.lang, l.quality from documents d left join labels l on d.doc_id=l.doc_id)"
       " order by sort_1 desc, sort_2, doc_id limit 25")
def p_sort_values(spark, d):
    df = lookup(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", "quality", mode="numeric")
    return select(df, fields=["doc_id"], order=[desc(mul("quality", 2)), "lang"], rows=25, key="doc_id",
                  return_sort_values=True)


@query("select c_custkey,c_name from customer where c_custkey in (1,5,42)")
def p_get_by_id(spark, d):
    return get_by_ids(table(spark, d, "customer"), "c_custkey", [1, 5, 42]).select("c_custkey", "c_name")


@query("select p_partkey, concat(p_name,' ',p_type) as text from part")
def p_copy_field(spark, d):
    return copy_field(table(spark, d, "part"), ["p_name", "p_type"], "text").select("p_partkey", "text")


# --- writes -------------------------------------------------------------------------

LATEST_SQL = (
    "select user_id,event_id,ts,value from (select *, row_number() over"
    " (partition by user_id order by ts desc, event_id desc) rn from events) where rn=1"
)


def clicks_and_others(spark, d):
    events = table(spark, d, "events").select("user_id", "event_id", "ts", "value", "event_type")
    click = in_filter("event_type", "click")
    return (apply_filters(events, ~click).drop("event_type"), apply_filters(events, click).drop("event_type"))


@query(LATEST_SQL)
def w_upsert_latest(spark, d):
    current, incoming = clicks_and_others(spark, d)
    return upsert_latest(current, incoming, "user_id", ["ts", "event_id"])


@query(LATEST_SQL)
def w_upsert_changes(spark, d):
    """The change set is merged into a collection with one row per key."""
    current, incoming = clicks_and_others(spark, d)
    catalog = Catalog()
    nothing = current.limit(0)
    catalog.register("latest", upsert_latest(nothing, current, "user_id", ["ts", "event_id"]), "user_id")
    catalog.upsert("latest", incoming, ["ts", "event_id"])
    return catalog.table("latest")


@query("select event_type, max(event_id) as event_id, true as replaced from events where event_type <> 'error' group by event_type"
       " union all select event_type, max(event_id), false from events where event_type = 'error' group by event_type")
def w_upsert_ties(spark, d):
    """Rows of equal order are replaced, and within one side the content decides, in either form."""
    events = table(spark, d, "events").select("event_type", "event_id", F.lit(0).alias("version"))
    old = events.withColumn("replaced", F.lit(False))
    new = events.filter("event_type <> 'error'").withColumn("replaced", F.lit(True))
    one = upsert_latest(old, new, "event_type", "version")
    unique = upsert_latest(old.limit(0), old, "event_type", "version")
    two = upsert_latest(unique, new, "event_type", "version", current_unique=True)
    return one.intersectAll(two).select("event_type", "event_id", "replaced")


@query("select doc_id,lang from documents d where not exists (select 1 from labels l where l.doc_id=d.doc_id)")
def w_delete_by_ids(spark, d):
    return delete_by_ids(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id").select("doc_id", "lang")


@query("select event_id,event_type from events where not (event_type in ('error'))")
def w_delete_by_query(spark, d):
    return delete_by_query(table(spark, d, "events"), in_filter("event_type", "error")).select("event_id", "event_type")


@query("select d.doc_id, coalesce(l.quality, -1) as quality, timestamp '2024-01-01 00:00:00' as added"
       " from documents d left join labels l on d.doc_id=l.doc_id")
def w_defaults(spark, d):
    rows = labelled(spark, d).select("doc_id", "quality", F.lit(None).cast("timestamp_ntz").alias("added"))
    return with_defaults(rows, {"quality": -1, "added": "2024-01-01T12:34:56Z/YEAR"})


@query("select o_orderkey, o_custkey, o_orderdate from orders")
def w_export_sorted(spark, d):
    path = shared_dir(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    export_sorted(orders, sort_columns(orders, ["o_orderdate desc"]), path, "o_orderkey")
    return spark.read.parquet(path)


# --- functions ----------------------------------------------------------------------


@query("select count(*) as n, true as in_bounds from lineitem")
def s_rand_bounds(spark, d):
    draws = table(spark, d, "lineitem").select(rand_int(20, seed=11).alias("r"))
    return draws.agg(F.count("*").alias("n"), F.every((F.col("r") >= 0) & (F.col("r") < 20)).alias("in_bounds"))


@query("select count(*) as n, true as in_bounds, true as varied from events")
def s_hash_rand_bounds(spark, d):
    draws = table(spark, d, "events").select(hash_rand_int(["event_id"], 20, seed=11).alias("r"))
    return draws.agg(
        F.count("*").alias("n"), F.every((F.col("r") >= 0) & (F.col("r") < 20)).alias("in_bounds"),
        (F.count_distinct("r") == 20).alias("varied"),
    )


@query("select c_custkey, round(2 * 6371.0087714 * asin(sqrt(least(1.0, pow(sin((radians(c_nationkey * 3.0) - radians(48.85)) / 2), 2)"
       " + cos(radians(c_nationkey * 3.0)) * cos(radians(48.85)) * pow(sin((radians(c_acctbal / 60) - radians(2.35)) / 2), 2)))), 3) as km"
       " from customer")
def s_geodist(spark, d):
    km = geodist(F.lit(48.85), F.lit(2.35), F.col("c_nationkey") * 3.0, F.col("c_acctbal") / 60)
    return table(spark, d, "customer").select("c_custkey", F.round(km, 3).alias("km"))


@query("select event_id, ts from events where ts >= timestamp '2024-01-03 00:00:00' and ts < timestamp '2024-01-03 00:00:00' + interval 36 hour")
def s_date_math(spark, d):
    days = range_filter("ts", "[2024-01-31T10:00:00Z/MONTH+2DAYS TO 2024-01-03T12:30:00Z/DAY+36HOURS)")
    return apply_filters(table(spark, d, "events"), days).select("event_id", "ts")


@query("select o_orderkey, cast(last_day(o_orderdate) as timestamp) as month_end from orders")
def s_date_math_column(spark, d):
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z/MONTH+1MONTH-1DAY"))
    return table(spark, d, "orders").select("o_orderkey", instant_column(text, ntz=True).alias("month_end"))


@query("select p_partkey, p_size * p_retailprice as worth, p_size + 1 as next_size from part")
def e_named_functions(spark, d):
    register_function("inc", lambda value: F.col(value) + 1)
    return table(spark, d, "part").select(
        "p_partkey", call_function("mul", "p_size", "p_retailprice").alias("worth"),
        call_function("inc", "p_size").alias("next_size"),
    )


# --- terms --------------------------------------------------------------------------


@query("select term, count(distinct doc_id) as doc_freq from (select doc_id,"
       " unnest(regexp_extract_all(lower(text),'\\p{L}+')) as term from documents) group by term")
def t_terms_doc_freq(spark, d):
    # doc_id is the unique key of the collection
    return terms_doc_freq(table(spark, d, "documents"), "doc_id", "text", unique_key=True)


@query("select term, count(distinct conv_id) as doc_freq from (select conv_id,"
       " unnest(regexp_extract_all(lower(text),'\\p{L}+')) as term from conversations) group by term")
def t_terms_repeated_key(spark, d):
    return terms_doc_freq(table(spark, d, "conversations"), "conv_id", "text")


# --- log events and requests ----------------------------------------------------------

# Levels stand in for event types.
EVENT_LEVELS = {"error": "ERROR", "purchase": "WARN", "signup": "INFO", "click": "DEBUG"}
LEVEL_SQL = ("case event_type when 'error' then 'ERROR' when 'purchase' then 'WARN' when 'signup' then 'INFO'"
             " when 'click' then 'DEBUG' else 'TRACE' end")


def log_events(df: DataFrame) -> DataFrame:
    level = F.lit("TRACE")
    for event_type, name in EVENT_LEVELS.items():
        level = F.when(F.col("event_type") == event_type, name).otherwise(level)
    return df.select("event_id", "ts", level.alias("level"))


@query(f"select event_id, ts, level from (select event_id, ts, {LEVEL_SQL} as level from events"
       " where event_type in ('error','purchase') order by ts desc, event_id desc limit 50)"
       " where ts > timestamp '2024-01-30 20:00:00'")
def g_history(spark, d):
    since = F.lit("2024-01-30 20:00:00").cast("timestamp_ntz")
    return log_history(log_events(table(spark, d, "events")), "ts", "level", "warn", 50, since, "event_id")


@query("select distinct array_to_string(list_slice(parts,1,i),'.') as name from (select parts,"
       " unnest(range(1,len(parts)+1)) as i from (select string_split(regexp_extract(url,'https?://([^/?#]+)',1),'.')"
       " as parts from pages))")
def g_name_tree(spark, d):
    host = F.regexp_extract("url", "https?://([^/?#]+)", 1)
    return name_tree(table(spark, d, "pages"), host, include_root=False).select("name")


@query("with hosts as (select distinct regexp_extract(url,'https?://([^/?#]+)',1) as own from pages),"
       " chain as (select own, array_to_string(list_slice(string_split(own,'.'),1,i),'.') as name from"
       " (select own, unnest(range(1,len(string_split(own,'.'))+1)) as i from hosts))"
       " select name, bool_or(name = own) as is_own from chain group by name union all select 'root', true")
def g_name_tree_own(spark, d):
    host = F.regexp_extract("url", "https?://([^/?#]+)", 1)
    return name_tree(table(spark, d, "pages"), host)


@query("select page_id, split_part(kv,'=',1) as k, url_decode(substr(kv,strpos(kv,'=')+1)) as v from (select page_id,"
       " unnest(string_split(regexp_extract(url,'[?]([^#]*)',1),'&')) as kv from pages)"
       " where strpos(kv,'=')>1 and strpos(kv,'=')<length(kv)")
def g_request_params(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "[?]([^#]*)", 1).alias("q"))
    return request_params(pages, "q", as_rows=True).select("page_id", "k", "v")


@query("select page_id, len(list_distinct(list_filter(kvs, lambda x: strpos(x,'=')>1 and strpos(x,'=')<length(x)))) as n_keys from"
       " (select page_id, string_split(regexp_extract(url,'[?]([^#]*)',1),'&') as kvs from pages)")
def g_request_params_map(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "[?]([^#]*)", 1).alias("q"))
    return request_params(pages, "q").select("page_id", F.size("params").cast("bigint").alias("n_keys"))


@query("select event_id, case when value*100 > 2000 then 408 else 200 end as code from events")
def g_request_status(spark, d):
    return classify_requests(table(spark, d, "events"), F.col("value") * 100).select("event_id", "code")


@query("select event_id, case when c in (400,401,403,404,408,409,415,429,500,503,510) then c else 0 end as code,"
       " case when c not in (0,400,401,403,404,408,409,415,429,500,503,510) then c end as unknown_code"
       " from (select event_id, 400 + cast(user_id as int) as c from events)")
def g_response_codes(spark, d):
    events = table(spark, d, "events").select("event_id", (F.col("user_id").cast("int") + 400).alias("c"))
    return events.select("event_id", normalize_code("c").alias("code"), unknown_code("c").alias("unknown_code"))


@query("select event_id, event_id as rid, '/' || event_type as path, user_id as request_size,"
       " cast(trunc(value) as bigint) as wait_time, 'q={x} id=' || event_id as params, user_id + 1 as hits,"
       " cast(0 as int) as status, cast(5 as bigint) as qtime from events")
def g_request_log(spark, d):
    line = F.concat(
        F.date_format("ts", "HH:mm:ss.SSS"), F.lit(" [worker-1] rid="), F.col("event_id"), F.lit(" path=/"),
        F.col("event_type"), F.lit(" core= RS="), F.col("user_id"), F.lit(" WT="), F.col("value").cast("bigint"),
        F.lit(" ET= r=local params={q={x} id="), F.col("event_id"), F.lit("} hits="), F.col("user_id") + 1,
        F.lit(" status=0 QTime=5 "),
    )
    lines = table(spark, d, "events").select("event_id", line.alias("line"))
    return parse_request_log(lines, "line").select(
        "event_id", "rid", "path", "request_size", "wait_time", "params", "hits", "status", "qtime"
    )


@query("select event_id, path, path = '/update' or starts_with(path, '/update/') as is_update from"
       " (select event_id, case when event_type = 'error' then '/update' else '/' || replace(event_type, 'click', 'update/json') end as path from events)")
def g_update_requests(spark, d):
    path = F.when(F.col("event_type") == "error", "/update").otherwise(
        F.concat(F.lit("/"), F.replace("event_type", F.lit("click"), F.lit("update/json")))
    )
    events = table(spark, d, "events").select("event_id", path.alias("path"))
    return events.withColumn("is_update", is_update_request("path"))


# --- streams ------------------------------------------------------------------------


def stream(spark, d, name):
    return read_stream(spark, f"{d}/{name}.parquet")


def run_to_table(df, spark):
    folder = shared_dir(spark)
    run_available(df, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


@query("select event_id, event_type, value from events where event_type in ('error','click') and value >= 10 and value < 100")
def x_filter_stream(spark, d):
    events = apply_filters(
        stream(spark, d, "events"), in_filter("event_type", "(error, click)"), range_filter("value", "[10 TO 100)")
    )
    return run_to_table(events.select("event_id", "event_type", "value"), spark)


@query("select e.event_id, e.user_id, c.c_name from events e left join customer c on e.user_id = c.c_custkey")
def x_lookup_stream(spark, d):
    named = lookup(stream(spark, d, "events"), table(spark, d, "customer"), "user_id", "c_name", target_key="c_custkey")
    return run_to_table(named.select("event_id", "user_id", "c_name"), spark)


@query(f"select event_id, ts, {LEVEL_SQL} as level from events where event_type in ('error','purchase')"
       " order by ts desc, event_id desc limit 50")
def x_history_stream(spark, d):
    folder = shared_dir(spark)
    history = HistorySink(f"{folder}/history", "ts", "level", "event_id", size=50)
    run_available(log_events(stream(spark, d, "events")), history.write_batch, f"{folder}/checkpoint")
    return history.read(spark)


@query(LATEST_SQL)
def x_upsert_stream(spark, d):
    folder = shared_dir(spark)
    latest = UpsertTable(f"{folder}/latest", "user_id", ["ts", "event_id"])
    events = stream(spark, d, "events").select("user_id", "event_id", "ts", "value")
    run_available(events, latest.write_batch, f"{folder}/checkpoint")
    return latest.read(spark)


def split_stream(spark, d, folder):
    """The events as several files, a micro-batch each."""
    events = table(spark, d, "events").select("event_id", "event_type", "user_id", "ts", "value")
    events.repartition(4, "event_id").write.parquet(f"{folder}/in")
    return read_stream(spark, f"{folder}/in", max_files_per_trigger=1)


@query(f"select event_id, ts, {LEVEL_SQL} as level from events where event_type in ('error','purchase')"
       " order by ts desc, event_id desc limit 50")
def x_history_restarted(spark, d):
    """Several micro-batches, then the whole stream again under a new checkpoint."""
    folder = shared_dir(spark)
    history = HistorySink(f"{folder}/history", "ts", "level", "event_id", size=50, kept_versions=1)
    events = log_events(split_stream(spark, d, folder))
    for checkpoint in ("one", "two"):
        run_available(events, history.write_batch, f"{folder}/{checkpoint}")
    return history.read(spark)


@query(LATEST_SQL)
def x_upsert_restarted(spark, d):
    """Several micro-batches, a full state between two streams, and the second stream's batches after it."""
    folder = shared_dir(spark)
    latest = UpsertTable(f"{folder}/latest", "user_id", ["ts", "event_id"])
    events = split_stream(spark, d, folder).select("user_id", "event_id", "ts", "value")
    early, late = events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")
    run_available(early, latest.write_batch, f"{folder}/one")
    latest.compact(spark)
    latest.vacuum(spark)
    run_available(late, latest.write_batch, f"{folder}/two")
    return latest.read(spark)


# --- flagship -----------------------------------------------------------------------


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a size in a list and a price in a range: the ten dearest."""
    return select(
        table(spark, sf_dir, "part"),
        filters=[in_filter("p_size", "(1, 5, 10, 20, 40)"), range_filter("p_retailprice", "[900 TO 1500)")],
        fields=["p_partkey", "p_name", "p_size", "p_retailprice"],
        order=["p_retailprice desc"], key="p_partkey",
    )


@query("select p_partkey, p_name, p_size, p_retailprice from part where p_size in (1,5,10,20,40)"
       " and p_retailprice >= 900 and p_retailprice < 1500 order by p_retailprice desc, p_partkey limit 10")
def q_filtered_page(spark, d):
    return flagship(spark, d)
