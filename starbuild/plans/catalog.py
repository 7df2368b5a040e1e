"""Query catalog: one Spark query per operator key, with its DuckDB oracle.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver's tables
(whole tables, no row subsets); each oracle is ANSI SQL over the same
tables registered as views.  Column names match between the two.
Queries that write scratch data (CSV, Parquet, dictionary text) put it in
the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.operators import aggregates, columns, dims, locations, periods, profile, quality
from starbuild.operators.joins import fill_from_lookup, hot_keys, prefix_key_join
from starbuild.plans import fixtures as fx
from starbuild.session import scratch_path
from starbuild.sources import dictionary, quarantine, readers, schema, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


_DATE_PARTS = """
    cast(day({d}) as integer) as day_of_month,
    cast(dayofyear({d}) as integer) as day_of_year,
    cast(week({d}) as integer) as week,
    cast(month({d}) as integer) as month,
    cast(year({d}) as integer) as year"""

_ORDERS_STAGED = """(select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       cast(o_orderdate as date) as o_orderdate,
       nullif(o_orderpriority, '5-LOW') as o_orderpriority from orders)"""

_STATUS_DIM = f"""(select o_orderstatus, o_orderpriority,
        row_number() over (order by o_orderstatus, o_orderpriority) - 1 as status_flag_id
   from (select distinct o_orderstatus, o_orderpriority from {_ORDERS_STAGED} s
          where o_orderstatus is not null and o_orderpriority is not null) c)"""

FLAGS = ["o_orderstatus", "o_orderpriority"]
FACT_LAYOUT = [
    ("order_id", "o_orderkey", "bigint"),
    ("status", "status_flag_id", None),
    ("customer_id", "o_custkey", "bigint"),
    ("order_dt", "o_orderdate", "date"),
    ("total_price", "o_totalprice", "double"),
    ("priority", "o_orderpriority", None),
]


# --------------------------------------------------------------- sources

@register("staging_scan", f"select * from {_ORDERS_STAGED} s")
def staging_scan(spark, sf):
    raw = readers.read_staging(spark, f"{sf.rstrip('/')}/orders.parquet", "parquet")
    typed = columns.timestamps_to_dates(raw)
    return typed.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        "o_orderdate", F.expr("nullif(o_orderpriority, '5-LOW')")
                        .alias("o_orderpriority"))


@register("csv_scan", "select * from customer")
def csv_scan(spark, sf):
    path = fx.write_customer_csv(spark, sf, sep=";")
    raw = readers.read_delimited(spark, path, sep=";")          # all strings, raw headers
    clean = columns.normalize_headers(raw)
    clean = columns.cast_columns(clean, ["c_custkey"], "bigint")
    clean = columns.cast_columns(clean, ["c_nationkey"], "int")
    return columns.cast_columns(clean, ["c_acctbal"], "double")


_DIRTY = """(select o_orderkey as k, o_custkey as c, o_totalprice as price, o_orderdate::date as d, o_orderstatus as st,
    o_orderkey % 29 = 0 or o_orderkey % 31 = 0 as fields, o_orderkey % 23 = 0 as id, o_orderkey % 11 = 0 as customer,
    o_orderkey % 13 = 0 as cost, o_orderkey % 19 = 0 as day from orders)"""


@register("quarantine_accepted", f"""
select k as order_id, c::int as customer, case when k % 17 = 0 then null else price end as price, d as ordered, d as arrived,
       st || ';x' as status from {_DIRTY} t where not (fields or id or customer or cost or day)""")
def quarantine_accepted(spark, sf):
    """Typed rows of delimited lines that are good throughout."""
    found = quarantine.write_checked(
        quarantine.read_checked(spark, fx.write_dirty_orders(spark, sf), fx.DIRTY_KINDS, ["order_id"], sep=";"),
        scratch_path(spark, "checked-orders"))
    return found.accepted(spark)


@register("quarantine_rejected", f"""
select case when fields then null else coalesce(nullif(concat_ws(',', case when id then 'order_id' end,
            case when customer then 'customer' end, case when cost then 'price' end, case when day then 'ordered' end), ''), null)
       end as columns,
       case when fields then 'not 6 fields' else concat_ws(',', case when id then 'required value is missing' end,
            case when customer then 'not a int' end, case when cost then 'not a double' end,
            case when day then 'not a date:yyyyMMdd' end) end as reasons,
       count(*) as lines, min(st) as least_status
from {_DIRTY} t where fields or id or customer or cost or day group by all""")
def quarantine_rejected(spark, sf):
    """Rejected lines by what failed in them."""
    found = quarantine.write_checked(
        quarantine.read_checked(spark, fx.write_dirty_orders(spark, sf), fx.DIRTY_KINDS, ["order_id"], sep=";"),
        scratch_path(spark, "checked-orders"))
    each = found.rejected(spark).select(
        F.expr("nullif(array_join(transform(failed, f -> f.column), ','), '')").alias("columns"),
        F.expr("array_join(transform(failed, f -> f.reason), ',')").alias("reasons"),
        F.regexp_extract("line", '"([A-Z]);x"', 1).alias("status"), "line")
    return (each.groupBy("columns", "reasons")
            .agg(F.count(F.lit(1)).alias("lines"), F.min(F.when(F.col("status") != "", F.col("status"))).alias("least_status")))


@register("limit_rows", """
select 'preview' as read, 100 as rows, 100 as rows_in_source
union all select 'chunks', 1050, 1050
union all select 'all', (select count(*) from region), (select count(*) from region)""")
def limit_rows(spark, sf):
    """Bounded reads return the asked number of rows, all of them the source's."""
    o, r = fx.table(spark, sf, "orders"), fx.table(spark, sf, "region")
    return (readers.checked_rows(readers.preview(o, 100), o, "preview")
            .unionByName(readers.checked_rows(readers.read_in_chunks(o, 1001, 350), o, "chunks"))
            .unionByName(readers.checked_rows(readers.read_in_chunks(r, 1000, 10), r, "all")))


@register("sample_fraction", """
select * from orders
where ('0x' || substr(md5('42:' || o_orderkey), 1, 13))::bigint < 450359962737049""")
def sample_fraction(spark, sf):
    return readers.sample_rows(fx.table(spark, sf, "orders"), 0.1, seed=42, key=["o_orderkey"])


@register("parquet_roundtrip", f"select * from {_ORDERS_STAGED} s")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "orders-parquet")
    staged = fx.orders_staged(spark, sf)
    sinks.write_parquet(staged, path, partition_by=["o_orderstatus"], compression="gzip")
    return sinks.read_parquet(spark, path, staged.schema, ["o_orderstatus"])


@register("schema_contract", f"""
select o_orderpriority, o_orderdate, o_totalprice, o_orderstatus, o_custkey, o_orderkey
from {_ORDERS_STAGED} s""")
def schema_contract(spark, sf):
    path = f"{sf.rstrip('/')}/orders.parquet"
    # Export the raw schema (column order reversed) to a JSON file, import it,
    # and re-read the source typed by the imported schema.
    raw_schema = readers.read_staging(spark, path).schema
    stored = schema.write_schema(type(raw_schema)(list(reversed(raw_schema.fields))),
                                 scratch_path(spark, "schema"), spark)
    imported = schema.read_schema(spark, stored)
    typed = readers.read_staging(spark, path, "parquet", schema=imported)
    staged = typed.select(*[F.col(c) for c in typed.columns if c != "o_orderpriority"],
                          F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"))
    staged = columns.timestamps_to_dates(staged, ["o_orderdate"])
    contract = schema.schema_from_json(schema.schema_to_json(
        fx.orders_staged(spark, sf).select(*reversed(fx.orders_staged(spark, sf).columns))))
    return schema.conform(staged, contract)


# --------------------------------------------------------------- columns

@register("normalize_headers", "select * from customer")
def normalize_headers(spark, sf):
    c = fx.table(spark, sf, "customer")
    raw = c.select(*[F.col(k).alias(v) for k, v in fx.customer_csv_headers().items()])
    return columns.normalize_headers(raw)


@register("cast_columns", """
select c_custkey, cast(trunc(c_acctbal) as integer) as c_acctbal,
       cast(c_nationkey as bigint) as c_nationkey,
       try_cast(c_mktsegment as integer) as c_mktsegment
from customer""")
def cast_columns(spark, sf):
    c = fx.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_mktsegment")
    c = columns.cast_columns(c, ["c_acctbal", "c_mktsegment"], "int")
    return columns.cast_columns(c, ["c_nationkey"], "bigint")


@register("epoch_day_decode", """
select l_orderkey, l_linenumber, cast(l_shipdate as date) as l_shipdate from lineitem""")
def epoch_day_decode(spark, sf):
    li = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.datediff(F.col("l_shipdate").cast("date"), F.lit("1960-01-01").cast("date"))
         .cast("double") + F.lit(0.5)).alias("l_shipdate"))
    return columns.decode_epoch_days(li, ["l_shipdate"])


@register("pattern_date_parse", """
select o_orderkey,
       case when o_orderpriority = '1-URGENT' then null else cast(o_orderdate as date) end as valid_until,
       cast(o_orderdate as date) as filed_on
from orders""")
def pattern_date_parse(spark, sf):
    o = fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("D/S"))
         .otherwise(F.date_format("o_orderdate", "MMddyyyy")).alias("valid_until"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("filed_on"))
    return columns.parse_pattern_dates(o, {"valid_until": "MMddyyyy", "filed_on": "yyyyMMdd"})


@register("drop_missing_required", f"""
select * from {_ORDERS_STAGED} s where o_orderpriority is not null""")
def drop_missing_required(spark, sf):
    return columns.drop_missing_required(fx.orders_staged(spark, sf), ["o_orderkey", "o_orderpriority"])


@register("non_null_contract", f"""
select * from {_ORDERS_STAGED} s where o_orderpriority is not null""")
def non_null_contract(spark, sf):
    return columns.require_non_null(fx.orders_staged(spark, sf), ["o_orderkey", "o_orderpriority"])


@register("split_pair_trim", """
select p_partkey, trim(string_split(p_name, ' ')[1]) as name_first,
       trim(string_split(p_name, ' ')[2]) as name_second
from part""")
def split_pair_trim(spark, sf):
    p = fx.table(spark, sf, "part").select("p_partkey", "p_name")
    return columns.split_pair(p, "p_name", " ", ("name_first", "name_second"))


@register("calendar_parts", f"""
select o_orderkey, cast(o_orderdate as date) as datestamp,
{_DATE_PARTS.format(d="cast(o_orderdate as date)")}
from orders""")
def calendar_parts(spark, sf):
    from starbuild.functions.dates import calendar_parts as parts
    o = fx.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("datestamp"))
    return o.select("o_orderkey", "datestamp",
                    *[v.alias(k) for k, v in parts(F.col("datestamp")).items()])


# --------------------------------------------------------------- dimensions

@register("entity_dimension", """
select cast(s_suppkey as varchar) as code, s_nationkey,
       trim(string_split(s_name, '#')[1]) as name_prefix,
       trim(string_split(s_name, '#')[2]) as name_number
from supplier where s_nationkey <> 0""")
def entity_dimension(spark, sf):
    s = fx.table(spark, sf, "supplier").select(
        F.when(F.col("s_nationkey") != 0,
               F.concat(F.lit("  "), F.col("s_suppkey").cast("string"), F.lit(" ")))
         .alias("code"),
        "s_name", "s_nationkey")
    return dims.entity_dimension(s, "code", ["code", "s_nationkey", "s_name"],
                                 split=("s_name", "#", ("name_prefix", "name_number")))


@register("date_dimension", f"""
with d as (
  select nullif(cast(o_orderdate as date), date '1995-01-01') as datestamp from orders
  union
  select cast(l_shipdate as date) from lineitem)
select datestamp, {_DATE_PARTS.format(d="datestamp")} from d""")
def date_dimension(spark, sf):
    o = fx.table(spark, sf, "orders").select(
        F.expr("nullif(cast(o_orderdate as date), date '1995-01-01')").alias("o_orderdate"))
    li = fx.table(spark, sf, "lineitem")
    return dims.date_dimension([(o, ["o_orderdate"]), (li, ["l_shipdate"])])


@register("combination_dimension", f"select * from {_STATUS_DIM} d")
def combination_dimension(spark, sf):
    return dims.combination_dimension(fx.orders_staged(spark, sf), FLAGS, "status_flag_id")


@register("group_rollup_dimension", """
select p_brand, cast(sum(p_size) as bigint) as p_size,
       cast(sum(p_retailprice * p_size) as double) / cast(sum(p_size) as double) as avg_price
from (select distinct nullif(p_brand, 'Brand#1') as p_brand, p_type, p_size,
             case when p_type = 'SMALL' then null
                  else cast(p_retailprice as decimal(15,2)) end as p_retailprice
        from part) d
where p_brand is not null group by p_brand""")
def group_rollup_dimension(spark, sf):
    return dims.group_rollup_dimension(fx.part_staged(spark, sf), "p_brand", ["p_size"],
                                       mean_column="p_retailprice", weight_column="p_size",
                                       mean_name="avg_price")


# --------------------------------------------------------------- aggregates

@register("group_sums", """
select p_brand, cast(sum(p_size) as bigint) as p_size,
       cast(sum(p_retailprice) as double) as p_retailprice
from (select nullif(p_brand, 'Brand#1') as p_brand, p_size,
             case when p_type = 'SMALL' then null
                  else cast(p_retailprice as decimal(15,2)) end as p_retailprice from part) s
group by p_brand""")
def group_sums(spark, sf):
    s = aggregates.group_sums(fx.part_staged(spark, sf).drop("p_type"), "p_brand")
    return s.select("p_brand", "p_size", F.col("p_retailprice").cast("double").alias("p_retailprice"))


@register("weighted_average", """
select p_brand, cast(sum(p_retailprice * p_size) as double) / cast(sum(p_size) as double) as weighted_avg
from (select nullif(p_brand, 'Brand#1') as p_brand, p_size,
             case when p_type = 'SMALL' then null
                  else cast(p_retailprice as decimal(15,2)) end as p_retailprice from part) s
where p_brand is not null group by p_brand""")
def weighted_average(spark, sf):
    return aggregates.weighted_average(fx.part_staged(spark, sf), "p_retailprice", "p_size",
                                       "p_brand")


@register("group_aggregates_double", """
select l_returnflag, round(sum(l_extendedprice), 2) as total, round(sum(l_tax), 4) as tax,
       round(sum(l_discount * l_quantity) / sum(l_quantity), 8) as mean_discount
from lineitem group by l_returnflag""")
def group_aggregates_double(spark, sf):
    """Sums and weighted means of plain doubles, rounded (the order of
    additions differs between engines)."""
    li = fx.table(spark, sf, "lineitem")
    sums = aggregates.group_sums(li, "l_returnflag", ["l_extendedprice", "l_tax"])
    means = aggregates.weighted_average(li, "l_discount", "l_quantity", "l_returnflag")
    return sums.join(means, "l_returnflag").select(
        "l_returnflag", F.round("l_extendedprice", 2).alias("total"), F.round("l_tax", 4).alias("tax"),
        F.round("weighted_avg", 8).alias("mean_discount"))


# --------------------------------------------------------------- facts

@register("fact_with_combination_key", f"""
select o.o_orderkey, o.o_orderstatus, o.o_orderpriority, d.status_flag_id
from {_ORDERS_STAGED} o left join {_STATUS_DIM} d
  on o.o_orderstatus = d.o_orderstatus and o.o_orderpriority = d.o_orderpriority""")
def fact_with_combination_key(spark, sf):
    from starbuild.plans.star import fact_with_checked_dimension
    staged = fx.orders_staged(spark, sf).select("o_orderkey", *FLAGS)
    fact, _ = fact_with_checked_dimension(staged, FLAGS, "status_flag_id", salt_by=["o_orderkey"])
    return fact


@register("fact_projection", f"""
select o.o_orderkey as order_id, d.status_flag_id as status, o.o_custkey as customer_id,
       o.o_orderdate as order_dt, o.o_totalprice as total_price, o.o_orderpriority as priority
from {_ORDERS_STAGED} o left join {_STATUS_DIM} d
  on o.o_orderstatus = d.o_orderstatus and o.o_orderpriority = d.o_orderpriority""")
def fact_projection(spark, sf):
    from starbuild.plans.star import fact_with_checked_dimension
    fact, _ = fact_with_checked_dimension(fx.orders_staged(spark, sf), FLAGS, "status_flag_id",
                                          FACT_LAYOUT)
    return fact


# --------------------------------------------------------------- quality

@register("reconcile_counts", """
select s.n as stage_rows, o.n as output_rows, s.n - o.n as row_diff,
       s.u as stage_unique, o.u as output_unique, s.u = o.u as keys_equal,
       o.n - o.u as duplicates
from (select count(*) as n, count(distinct l_orderkey)
             + max(case when l_orderkey is null then 1 else 0 end) as u from lineitem) s,
     (select count(*) as n, count(distinct o_orderkey)
             + max(case when o_orderkey is null then 1 else 0 end) as u from orders) o""")
def reconcile_counts(spark, sf):
    return quality.reconcile_counts(fx.table(spark, sf, "lineitem"), "l_orderkey",
                                    fx.table(spark, sf, "orders"), "o_orderkey")


_COVERAGE_SQL = """
with p as (select distinct {id} as id, trim(cast({fk} as varchar)) as fk from {fact}),
     d as (select distinct cast({dk} as varchar) as k from {dim}),
     t as (select p.fk, d.k from p left join d on p.fk = d.k)
select cast(sum(case when k is not null then 1 else 0 end) as bigint) as matched,
       cast(sum(case when k is null then 1 else 0 end) as bigint) as unmatched,
       cast(count(*) as bigint) as total,
       round_even(sum(case when k is not null then 1 else 0 end) / count(*) * 100, 1) as matched_pct
from t"""


@register("content_check", f"""
with s as {_ORDERS_STAGED},
     e as (select min(o_orderkey) as a, max(o_orderkey) as b from s),
     swapped as (select s.* replace (case when s.o_orderkey = e.a then (select o_totalprice from s where o_orderkey = e.b)
                                          when s.o_orderkey = e.b then (select o_totalprice from s where o_orderkey = e.a)
                                          else s.o_totalprice end as o_totalprice) from s, e),
     n as (select count(*) as n from s)
select c.name as "case", n as rows_staged, n as rows_written, true as rows_equal, c.differing = 0 as content_equal from n,
     (select 'written' as name, 0 as differing
      union all select 'one value swapped', (select count(*) from (select * from swapped except all select * from s) x)) c""")
def content_check_q(spark, sf):
    """A table written with its fingerprint observed: as staged, and with one
    value swapped between two rows (which no count can see)."""
    from starbuild.operators import fingerprint as fp
    staged = fx.orders_staged(spark, sf)
    first, last = staged.agg(F.min_by(F.struct("o_orderkey", "o_totalprice"), "o_orderkey"),
                             F.max_by(F.struct("o_orderkey", "o_totalprice"), "o_orderkey")).first()
    swapped = staged.withColumn("o_totalprice", F.when(F.col("o_orderkey") == first[0], F.lit(last[1]))
                                .when(F.col("o_orderkey") == last[0], F.lit(first[1])).otherwise(F.col("o_totalprice")))
    out = None
    for name, df in (("written", staged.repartition(4)), ("one value swapped", swapped)):
        seen, want = fp.observed_content(df, name)
        sinks.write_parquet(seen, scratch_path(spark, "content"))
        found = fp.content_check(spark, fp.content_fingerprint(staged), fp.Fingerprint.of(want.get)).select(
            F.lit(name).alias("case"), "*")
        out = found if out is None else out.unionByName(found)
    return out


@register("join_coverage", _COVERAGE_SQL.format(id="o_orderkey", fk="o_orderkey", fact="orders",
                                                dk="l_orderkey", dim="lineitem"))
def join_coverage(spark, sf):
    o = fx.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("fk"))
    li = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("k"))
    return quality.join_coverage(o, "fk", li, "k")


@register("label_coverage", _COVERAGE_SQL.format(id="doc_id", fk="doc_id", fact="documents",
                                                 dk="doc_id", dim="labels"))
def label_coverage(spark, sf):
    d = fx.table(spark, sf, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("fk"))
    lb = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("k"))
    return quality.join_coverage(d, "fk", lb, "k")


@register("unmatched_keys_topk", """
with p as (select distinct o_orderkey as id, trim(cast(o_orderkey as varchar)) as fk from orders),
     c as (select fk, count(*) as pairs from p group by fk)
select fk, pairs from c
where not exists (select 1 from lineitem l where cast(l.l_orderkey as varchar) = c.fk)
order by pairs desc, fk asc nulls last limit 20""")
def unmatched_keys_topk(spark, sf):
    o = fx.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("fk"))
    li = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("k"))
    return quality.unmatched_keys(o, "fk", li, "k", top=20)


@register("hidden_duplicates", """
select text, count(*) as copies from documents group by text having count(*) >= 2""")
def hidden_duplicates(spark, sf):
    return quality.hidden_duplicates(fx.table(spark, sf, "documents"), ["text"])


@register("code_list_validation", """
select f as value, count(*) as rows from (select nullif(l_returnflag, 'A') as f from lineitem) t
where f is not null and f not in (select o_orderstatus from orders)
group by f""")
def code_list_validation(spark, sf):
    codes = fx.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("code"))
    li = fx.table(spark, sf, "lineitem").select(F.expr("nullif(l_returnflag, 'A')").alias("f"))
    return quality.code_list_violations(li, "f", codes)


@register("code_lists_from_dictionary", """
select 'o_custkey' as "column", 'n1_city' as list_name, cast(o_custkey as varchar) as value, count(*) as rows
from orders where o_custkey not in (select c_custkey from customer where c_nationkey = 1) group by o_custkey
union all
select 'low', 'n2_city', cast(nullif(o_custkey, 7) as varchar), count(*) from orders
where nullif(o_custkey, 7) not in (select c_custkey from customer where c_nationkey = 2) group by o_custkey""")
def code_lists_from_dictionary(spark, sf):
    """Two columns (one with NULLs) against the code lists that the dictionary
    parser finds."""
    codes = dictionary.dictionary_codes(dictionary.read_dictionary_lines(spark, fx.write_dictionary(spark, sf)))
    o = fx.table(spark, sf, "orders").select("o_custkey", F.expr("nullif(o_custkey, 7)").alias("low"))
    return quality.code_lists_violations(o, {"o_custkey": "n1_city", "low": "n2_city"}, codes)


# --------------------------------------------------------------- profile

_CUSTOMER_NULLED = """(select c_custkey, c_name, c_nationkey, c_acctbal,
        nullif(c_mktsegment, 'HOUSEHOLD') as c_mktsegment from customer)"""


def _customer_nulled(spark, sf):
    return fx.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        F.expr("nullif(c_mktsegment, 'HOUSEHOLD')").alias("c_mktsegment"))


_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _per_column(cols, body):
    return "\nunion all\n".join(body.format(c=c) for c in cols)


@register("distinct_counts", _per_column(_CUSTOMER_COLS, """
select '{c}' as "column",
       count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as distinct_values
from """ + _CUSTOMER_NULLED + " t"))
def distinct_counts(spark, sf):
    return profile.distinct_counts(_customer_nulled(spark, sf))


@register("column_profile", "select *, unique_values / rows as unique_ratio, "
          "missing / rows as missing_ratio from (" + _per_column(_CUSTOMER_COLS, """
select '{c}' as "column", count(*) as rows,
       count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as unique_values,
       count(*) - count({c}) as missing
from """ + _CUSTOMER_NULLED + " t") + ") p")
def column_profile(spark, sf):
    return profile.column_profile(_customer_nulled(spark, sf))


@register("columns_with_missing", "select * from (" + _per_column(_CUSTOMER_COLS, """
select '{c}' as "column", count(*) - count({c}) as missing from """ + _CUSTOMER_NULLED + " t")
          + ") p where missing > 0")
def columns_with_missing(spark, sf):
    return profile.columns_with_missing(_customer_nulled(spark, sf))


_DOC_LABEL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_DOC_LABEL = """(select d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
   from documents d left join labels l on d.doc_id = l.doc_id)"""


@register("column_fill_rates", "select \"column\", non_null, rows, "
          "round_even(non_null / rows * 100, 1) as fill_pct from (" + _per_column(_DOC_LABEL_COLS, """
select '{c}' as "column", count({c}) as non_null, count(*) as rows from """ + _DOC_LABEL + " t")
          + ") p")
def column_fill_rates(spark, sf):
    d = fx.table(spark, sf, "documents")
    lb = fx.table(spark, sf, "labels")
    joined = d.join(lb, "doc_id", "left").select(*_DOC_LABEL_COLS)
    return profile.column_fill_rates(joined)


_LINEITEM_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_LINEITEM_MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _numeric_profile_sql(c: str, source: str, shift: str, scale: str = "1") -> str:
    """The oracle's own way: ``stddev_samp`` of exact deviations (``shift`` is
    subtracted in the column's type), ``quantile_cont``, ``count(distinct)``."""
    def r(x):
        return f"round({x} / {scale}, 4)"

    return f"""
select '{c}' as "column", count({c}) as count,
       {r(f"cast(sum({c}) as double) / count({c})")} as mean, {r(f"stddev_samp(cast({c} - {shift} as double))")} as std,
       min({c})::double as min,
       {r(f"quantile_cont({c}::double, 0.25)")} as q25, {r(f"quantile_cont({c}::double, 0.5)")} as q50,
       {r(f"quantile_cont({c}::double, 0.75)")} as q75, max({c})::double as max,
       count(distinct {c}) as unique_values, count(*) - count({c}) as missing
from {source} t"""


@register("profile_numeric", "\nunion all\n".join(
    _numeric_profile_sql(c, "lineitem", "0") for c in _LINEITEM_KEYS + _LINEITEM_MONEY))
def profile_numeric(spark, sf):
    li = fx.table(spark, sf, "lineitem").select(*_LINEITEM_KEYS, *_LINEITEM_MONEY)
    return profile.profile_numeric(li, digits=4)


_WIDE = """(select o_orderkey * 2 + 9007199254740993 as big_id,
        epoch_ms(o_orderdate::timestamp) as ms,
        case when o_custkey % 5 = 0 or o_custkey % 7 = 0 then null else o_totalprice end as price from orders)"""


@register("profile_numeric_wide", "\nunion all\n".join(
    _numeric_profile_sql(c, _WIDE, shift, "1e6") for c, shift in
    (("big_id", "9007199254740993"), ("ms", "700000000000"), ("price", "0"))))
def profile_numeric_wide(spark, sf):
    """Ids above 2**53 (neighbours share a double), epoch milliseconds, and
    doubles with NaN and NULL."""
    nan = F.lit(float("nan"))
    o = fx.table(spark, sf, "orders").select(
        (F.col("o_orderkey") * 2 + F.lit(9007199254740993)).alias("big_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ms"),
        F.when(F.col("o_custkey") % 5 == 0, nan).when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice")).alias("price"))
    out = profile.profile_numeric(o)
    return out.select("column", "count", *[F.round(F.col(c) / 1e6, 4).alias(c) if c in ("mean", "std", "q25", "q50", "q75")
                                           else F.col(c) for c in out.columns[2:]])


_DECIMALS = """(select cast(l_extendedprice as decimal(38,2)) * 1000000000000000000000 as price,
        cast(l_tax as decimal(20,18)) as tax, cast(l_discount as decimal(9,2)) as discount from lineitem)"""


@register("profile_numeric_decimal", "\nunion all\n".join(
    _numeric_profile_sql(c, _DECIMALS, "0", scale) for c, scale in (("price", "1e24"), ("tax", "1"), ("discount", "1"))))
def profile_numeric_decimal(spark, sf):
    """Decimals of different widths, one with 27 digits and one with 18 places."""
    li = fx.table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice").cast("decimal(14,2)") * F.lit("1000000000000000000000").cast("decimal(22,0)")).alias("price"),
        F.col("l_tax").cast("decimal(20,18)").alias("tax"), F.col("l_discount").cast("decimal(9,2)").alias("discount"))
    out = profile.profile_numeric(li)
    scale = F.when(F.col("column") == "price", 1e24).otherwise(1.0)
    return out.select("column", "count", *[F.round(F.col(c) / scale, 4).alias(c) if c in ("mean", "std", "q25", "q50", "q75")
                                           else F.col(c) for c in out.columns[2:]])


_ORDER_STR = {"o_orderstatus": "string", "o_orderdate": "timestamp_ntz",
              "o_orderpriority": "string"}


@register("profile_string", _per_column(list(_ORDER_STR), """
select '{c}' as "column", '__T_{c}' as dtype, count(*) as lines, count({c}) as non_null,
       count(*) - count({c}) as missing, count({c}) / count(*) * 100 as fill_pct,
       count(distinct {c}) as unique_values, count(distinct {c}) / count(*) * 100 as uniq_pct
from (select o_orderstatus, o_orderdate, nullif(o_orderpriority, '5-LOW') as o_orderpriority
        from orders) t""").replace("'__T_o_orderstatus'", "'string'")
          .replace("'__T_o_orderdate'", "'timestamp_ntz'")
          .replace("'__T_o_orderpriority'", "'string'"))
def profile_string(spark, sf):
    o = fx.table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderdate", F.expr("nullif(o_orderpriority, '5-LOW')")
        .alias("o_orderpriority"), "o_orderkey", "o_totalprice")
    return profile.profile_string(o)


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]


@register("low_cardinality_values", """
with pairs as (""" + "\nunion\n".join(
    f"select '{c}' as \"column\", cast({c} as varchar) as value from orders where {c} is not null"
    for c in _ORDER_COLS) + """),
     small as (select "column" from pairs group by "column" having count(*) <= 10)
select pairs."column", pairs.value from pairs join small on pairs."column" = small."column\"""")
def low_cardinality_values(spark, sf):
    return profile.low_cardinality_values(fx.table(spark, sf, "orders"), max_values=10)


@register("summarize", "\nunion all\n".join(
    [f"""select 'numeric' as part, '{c}' as "column", cast(count(distinct {c}) as varchar) as found from customer"""
     for c in ("c_custkey", "c_nationkey", "c_acctbal")]
    + [f"select 'string', '{c}', cast(count(distinct {c}) as varchar) from {_CUSTOMER_NULLED} t"
       for c in ("c_name", "c_mktsegment")]
    + [f"select 'missing', 'c_mktsegment', cast(count(*) - count(c_mktsegment) as varchar) from {_CUSTOMER_NULLED} t",
       f"select distinct 'values', 'c_mktsegment', c_mktsegment from {_CUSTOMER_NULLED} t where c_mktsegment is not null"]))
def summarize(spark, sf):
    """The combined profile: unique values, missing values, value lists."""
    s = profile.summarize(_customer_nulled(spark, sf))
    out = None
    for part, found in (("numeric", "unique_values"), ("string", "unique_values"), ("missing", "missing"), ("values", "value")):
        f = s[part].select(F.lit(part).alias("part"), "column", F.col(found).cast("string").alias("found"))
        out = f if out is None else out.unionByName(f)
    return out


@register("group_size_balance", """
with s as (select event_type as k, count(*) as n from events group by event_type)
select cast(count(*) as bigint) as groups, cast(sum(n) as bigint) as rows, avg(n) as mean_rows,
       (select k from s order by n desc, k limit 1) as largest_group, max(n) as largest_rows,
       (select k from s order by n asc, k limit 1) as smallest_group, min(n) as smallest_rows
from s""")
def group_size_balance(spark, sf):
    return profile.group_size_balance(fx.table(spark, sf, "events"), "event_type")


@register("latest_date", "select max(cast(o_orderdate as date)) as latest from orders")
def latest_date(spark, sf):
    return profile.latest_value(columns.timestamps_to_dates(fx.table(spark, sf, "orders")),
                                "o_orderdate")


@register("period_overlap", """
with a as (select min(o_orderdate)::date as s, max(o_orderdate)::date as e from orders),
     b as (select min(ts)::date as s, max(ts)::date as e from events)
select a.s as a_start, a.e as a_end, b.s as b_start, b.e as b_end,
       greatest(a.s, b.s) as overlap_start, least(a.e, b.e) as overlap_end,
       case when least(a.e, b.e) >= greatest(a.s, b.s)
            then cast(datediff('day', greatest(a.s, b.s), least(a.e, b.e)) + 1 as integer) end
         as overlap_days
from a, b""")
def period_overlap(spark, sf):
    return profile.period_overlap(fx.table(spark, sf, "orders"), "o_orderdate",
                                  fx.table(spark, sf, "events"), "ts")


# --------------------------------------------------------------- joins

_COVERS = {"a": ("select o_orderdate::date as s, o_orderdate::date as e from orders where o_orderstatus = 'P'", "o_orderdate"),
           "b": ("select l_shipdate::date as s, (l_shipdate + interval 2 day)::date as e from lineitem "
                 "where l_returnflag = 'R' and l_quantity >= 49", "l_shipdate")}


def _covers(spark, sf):
    """Days of one kind of orders, and two days after the shipments of some lines."""
    o = fx.table(spark, sf, "orders").where("o_orderstatus = 'P'")
    li = (fx.table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity >= 49")
          .select("l_shipdate", F.date_add(F.col("l_shipdate").cast("date"), 2).alias("due")))
    return o, li


_COVERED = f"""
a as (select distinct unnest(generate_series(s, e, interval 1 day))::date as d from ({_COVERS['a'][0]}) x),
b as (select distinct unnest(generate_series(s, e, interval 1 day))::date as d from ({_COVERS['b'][0]}) x),
c as (select d from a intersect select d from b)"""


@register("overlap_days", f"""
with {_COVERED}
select (select count(*) from a) as a_days, (select count(*) from b) as b_days, (select count(*) from c) as overlap_days""")
def overlap_days_q(spark, sf):
    """Days that two tables really share, gaps of either left out."""
    o, li = _covers(spark, sf)
    return periods.overlap_days(o, "o_orderdate", li, "l_shipdate", b_end="due")


@register("covered_periods", f"""
with {_COVERED},
     s as (select 'a' as side, d from a union all select 'b', d from b union all select 'overlap', d from c),
     r as (select side, d, d - (row_number() over (partition by side order by d))::integer as run from s)
select side, min(d) as first_day, max(d) as last_day, count(*) as days from r group by side, run""")
def covered_periods(spark, sf):
    """Stretches of covered days without a gap, of two tables and of both."""
    o, li = _covers(spark, sf)
    a, b = periods.covered_days(o, "o_orderdate"), periods.covered_days(li, "l_shipdate", "due")
    out = None
    for side, cover in (("a", a), ("b", b), ("overlap", periods.shared_days(a, b))):
        part = periods.islands(cover).select(F.lit(side).alias("side"), "first_day", "last_day", "days")
        out = part if out is None else out.unionByName(part)
    return out


@register("near_locations", """
with p as (select lat, lon, count(*) as rows from (
        select (c_custkey * 7919 % 11521 - 5760) / 64.0::double as lat, (c_custkey * 104729 % 23040 - 11520) / 64.0::double as lon
        from customer union all
        select (s_suppkey * 7919 % 11521 - 5760) / 64.0::double, (s_suppkey * 104729 % 23040 - 11520) / 64.0::double + 360
        from supplier) x group by all),
     q as (select lat, case when lon >= 180 then lon - 360 else lon end as lon, rows from p),
     r as (select case when abs(lat) = 90 then 0 else lon end as lon, lat, sum(rows) as rows from q group by all),
     d as (select a.lat, a.lon, a.rows, b.lat as near_lat, b.lon as near_lon, b.rows as near_rows,
                  2 * 6371000.0::double * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
                      + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) as metres
           from r a join r b on a.lat < b.lat or (a.lat = b.lat and a.lon < b.lon))
select lat, lon, rows::bigint as rows, near_lat, near_lon, near_rows::bigint as near_rows, round(metres / 1000, 3) as km
from d where metres <= 150000""")
def near_locations_q(spark, sf):
    """Customers and suppliers at coordinates derived from their keys, some given
    one turn further east: distinct places within 150 km of each other."""
    def at(df, key, turn):
        k = F.col(key)
        return df.select(((k * 7919 % 11521 - 5760) / 64.0).alias("lat"), ((k * 104729 % 23040 - 11520) / 64.0 + turn).alias("lon"))

    both = at(fx.table(spark, sf, "customer"), "c_custkey", 0).unionByName(at(fx.table(spark, sf, "supplier"), "s_suppkey", 360))
    found = locations.near_locations(both, "lat", "lon", 150_000)
    return found.select(*found.columns[:-1], F.round(F.col("metres") / 1000, 3).alias("km"))


@register("top_keys", """
select * from (select l_partkey as key, count(*) as rows from lineitem group by all order by rows desc, key limit 25) x
union all
select * from (select cast(c_custkey % 7 as bigint), count(*) as rows from customer group by all order by rows desc, 1 limit 3) y""")
def top_keys_q(spark, sf):
    """Most frequent keys, exactly, of a column of even counts and of one of few values."""
    part = quality.top_keys(fx.table(spark, sf, "lineitem"), "l_partkey", 25, slots=1 << 12)
    few = quality.top_keys(fx.table(spark, sf, "customer").select((F.col("c_custkey") % 7).alias("k")), "k", 3)
    return part.unionByName(few)


@register("distinct_counts_text", _per_column(_CUSTOMER_COLS, """
select '{c}' as "column", count(distinct {c}) + (case when count(*) > count({c}) then 1 else 0 end) as distinct_values
from customer t"""))
def distinct_counts_text(spark, sf):
    """Exact distinct counts of a delimited text source, parsed once."""
    raw = columns.normalize_headers(readers.read_delimited(spark, fx.write_customer_csv(spark, sf, sep=";"), sep=";"))
    return profile.distinct_counts(raw, one_scan=True)


@register("prefix_key_join", """
with c as (select try_cast(regexp_replace(name, '^Customer#', '') as bigint) as k, name, c_mktsegment
           from (select c_name as name, c_mktsegment from customer
                 union all select cast(c_custkey as varchar), 'UNPREFIXED' from customer where c_custkey % 3 = 0)),
     one as (select k, min_by(c_mktsegment, name) as c_mktsegment from c where k is not null group by k)
select o.o_orderkey, one.c_mktsegment
from (select o_orderkey, case when o_custkey % 7 = 0 then null else o_custkey end as o_custkey from orders) o
left join one on o.o_custkey = one.k""")
def prefix_key_join_q(spark, sf):
    """Some keys come with and without the prefix, some left keys are NULL."""
    o = fx.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"))
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    c = c.select("c_name", "c_mktsegment").unionByName(c.where("c_custkey % 3 = 0").select(
        F.col("c_custkey").cast("string").alias("c_name"), F.lit("UNPREFIXED").alias("c_mktsegment")))
    j = prefix_key_join(o, "o_custkey", c, "c_name", "Customer#", key_type="bigint", how="left",
                        hot=hot_keys(o, ["o_custkey"]))
    return j.select("o_orderkey", "c_mktsegment")


@register("fill_from_lookup", """
select c.c_custkey, c.c_nationkey,
       coalesce(case when c.c_custkey % 4 = 0 then 99 end, n.n_regionkey) as c_regionkey
from (select c_custkey, nullif(c_nationkey, 3) as c_nationkey from customer) c
left join nation n on c.c_nationkey = n.n_nationkey""")
def fill_from_lookup_q(spark, sf):
    """Present values (99) stay, NULL keys find nothing."""
    c = fx.table(spark, sf, "customer").select(
        "c_custkey", F.expr("nullif(c_nationkey, 3)").alias("c_nationkey"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(99)).cast("int").alias("c_regionkey"))
    n = fx.table(spark, sf, "nation")
    return fill_from_lookup(c, "c_regionkey", "c_nationkey", n, "n_nationkey", "n_regionkey", salt_by=["c_custkey"])


# --------------------------------------------------------------- dictionary

@register("dictionary_fields", """
select lower(n) as field,
       case when p_size > 45 then p_name || ' value fakel A = ''1'' ' || p_type
            when p_size > 25 then p_name || ' ' || p_type
            else p_name || ' - ' || p_type end as description
from part, unnest(['P' || p_partkey, 'Q' || p_partkey]) as t(n)
union all select 'note', 'x value innerl'""")
def dictionary_fields(spark, sf):
    lines = dictionary.read_dictionary_lines(spark, fx.write_dictionary(spark, sf))
    return dictionary.dictionary_fields(lines)


@register("dictionary_unclosed", """
select '/* lost - never closed' as line union all select 'value ' || r_name from region""")
def dictionary_unclosed(spark, sf):
    lines = dictionary.read_dictionary_lines(spark, fx.write_dictionary(spark, sf))
    return dictionary.unclosed_comment_lines(lines).select("line")


@register("dictionary_codes", """
select 'n' || c_nationkey || '_city' as list_name, cast(c_custkey as varchar) as code,
       case when c_acctbal < 0 then c_name || ' = ' || c_mktsegment
            when c_mktsegment = 'BUILDING' then '  ' || c_name || ' '
            else c_name end as label
from customer""")
def dictionary_codes(spark, sf):
    lines = dictionary.read_dictionary_lines(spark, fx.write_dictionary(spark, sf))
    return dictionary.dictionary_codes(lines)


# --------------------------------------------------------------- end-to-end star

def _star_inputs(spark, sf):
    from starbuild.plans.star import StagingSpec, StarSpec, stage
    staged = stage(fx.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority")),
        StagingSpec(timestamp_date_columns=["o_orderdate"], required=["o_orderkey"]))
    entity = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment")
    spec = StarSpec(
        fact_name="order_facts", fact_key="o_orderkey", flags=FLAGS,
        flag_dim_name="dim_status", flag_key="status_flag_id",
        date_columns=["o_orderdate"], date_dim_name="dim_time", fact_layout=FACT_LAYOUT,
        entity_name="dim_customer", entity_key="c_custkey",
        entity_columns=["c_custkey", "c_name", "c_mktsegment"],
        entity_split=("c_name", "#", ("name_prefix", "name_number")), entity_fk="customer_id",
        rollup_name="dim_brand", rollup_key="p_brand", rollup_sums=["p_size"],
        rollup_mean="p_retailprice", rollup_weight="p_size")
    return staged, entity, fx.part_staged(spark, sf), spec


@register("star_fact_written", ORACLE["fact_projection"])
def star_fact_written(spark, sf):
    from starbuild.plans.star import write_star
    staged, entity, rollup, spec = _star_inputs(spark, sf)
    star = write_star(spark, staged, spec, scratch_path(spark, "star"), entity_src=entity,
                      rollup_src=rollup, fact_partition_by=["priority"])
    return star.read(spark, "order_facts")


@register("star_checks", f"""
with s as (select * from {_ORDERS_STAGED} x),
     d as (select distinct o_orderdate as datestamp from s),
     r as (
        select 'reconcile_order_facts' as check_name, (select count(*) from s) as a, (select count(*) from s) as b,
               (select count(distinct o_orderkey) from s) as c, (select count(distinct o_orderkey) from s) as d
        union all
        select 'reconcile_dim_time_o_orderdate', (select count(*) from s), (select count(*) from d),
               (select count(distinct o_orderdate) from s), (select count(distinct datestamp) from d)
        union all
        select 'reconcile_dim_customer', count(*), count(*), count(distinct c_custkey), count(distinct c_custkey)
        from customer),
     v as (select count(*) as total, count(c.c_custkey) as matched
           from s left join customer c on c.c_custkey = s.o_custkey)
select check_name, a as stage_rows, b as output_rows, a - b as row_diff, c as stage_unique, d as output_unique,
       c = d as keys_equal, b - d as duplicates, null::bigint as matched, null::bigint as unmatched,
       null::double as matched_pct from r
union all
select 'coverage_order_facts_dim_customer', null, null, null, null, null, null, null, matched, total - matched,
       round_even(matched / total * 100, 1) from v""")
def star_checks(spark, sf):
    from starbuild.plans.star import run_star
    staged, entity, rollup, spec = _star_inputs(spark, sf)
    checks = run_star(spark, staged, spec, scratch_path(spark, "star-run"), entity_src=entity,
                      rollup_src=rollup).checks
    out = None
    for name, df in checks.items():
        if name.startswith("content_"):             # star_content has these
            continue
        f = df.drop("total").withColumn("check_name", F.lit(name))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out.select("check_name", "stage_rows", "output_rows", "row_diff", "stage_unique", "output_unique",
                      "keys_equal", "duplicates", "matched", "unmatched", "matched_pct")


@register("star_content", """
select 'content_order_facts' as check_name, count(*) as rows_staged, count(*) as rows_written, true as rows_equal,
       true as content_equal from orders""")
def star_content(spark, sf):
    """The fact holds the staged values, by fingerprints gathered in its write."""
    from starbuild.plans.star import run_star
    staged, entity, rollup, spec = _star_inputs(spark, sf)
    run = run_star(spark, staged, spec, scratch_path(spark, "star-run"), entity_src=entity, rollup_src=rollup,
                   fact_partition_by=["priority"])
    return run.checks["content_order_facts"].select(F.lit("content_order_facts").alias("check_name"), "*")


@register("star_coverage", """
with p as (select distinct o_orderkey as id, trim(cast(o_custkey as varchar)) as fk from orders),
     d as (select distinct cast(c_custkey as varchar) as k from customer),
     t as (select p.fk, d.k from p left join d on p.fk = d.k)
select cast(sum(case when k is not null then 1 else 0 end) as bigint) as matched,
       cast(sum(case when k is null then 1 else 0 end) as bigint) as unmatched,
       cast(count(*) as bigint) as total,
       round_even(sum(case when k is not null then 1 else 0 end) / count(*) * 100, 1) as matched_pct
from t""")
def star_coverage(spark, sf):
    from starbuild.plans.star import build_star, run_checks
    staged, entity, rollup, spec = _star_inputs(spark, sf)
    tables = build_star(staged, spec, entity, rollup)
    return run_checks(staged, tables, spec, entity)["coverage_order_facts_dim_customer"]


LINE_FLAGS = ["l_returnflag", "l_linestatus"]
LINE_LAYOUT = [
    ("order_id", "l_orderkey", "bigint"),
    ("line_no", "l_linenumber", "int"),
    ("status", "line_status_id", None),
    ("part_id", "l_partkey", "bigint"),
    ("supplier_id", "l_suppkey", "bigint"),
    ("ship_dt", "l_shipdate", "date"),
    ("quantity", "l_quantity", "double"),
    ("extended_price", "l_extendedprice", "double"),
    ("discount", "l_discount", "double"),
]


@register("star_lineitem_written", """
with d as (select l_returnflag, l_linestatus,
                  row_number() over (order by l_returnflag, l_linestatus) - 1 as line_status_id
             from (select distinct l_returnflag, l_linestatus from lineitem) c)
select l.l_orderkey as order_id, l.l_linenumber as line_no, d.line_status_id as status,
       l.l_partkey as part_id, l.l_suppkey as supplier_id, cast(l.l_shipdate as date) as ship_dt,
       l.l_quantity as quantity, l.l_extendedprice as extended_price, l.l_discount as discount
from lineitem l left join d on l.l_returnflag = d.l_returnflag and l.l_linestatus = d.l_linestatus""")
def star_lineitem_written(spark, sf):
    """The whole star build over the largest table: stage, flag and date
    dimensions, fact with a checked broadcast join, Parquet writes."""
    from starbuild.plans.star import StagingSpec, StarSpec, stage, write_star
    staged = stage(fx.table(spark, sf, "lineitem"),
                   StagingSpec(timestamp_date_columns=["l_shipdate"],
                               required=["l_orderkey", "l_linenumber"]))
    spec = StarSpec(fact_name="line_facts", fact_key="l_orderkey", flags=LINE_FLAGS,
                    flag_dim_name="dim_line_status", flag_key="line_status_id",
                    date_columns=["l_shipdate"], date_dim_name="dim_ship_date",
                    fact_layout=LINE_LAYOUT)
    star = write_star(spark, staged, spec, scratch_path(spark, "line-star"),
                      fact_partition_by=["status"])
    return star.read(spark, "line_facts")


@register("star_text_partition", """
with f as (select o_orderkey as order_id, lpad(cast(o_custkey % 25 as varchar), 2, '0') as port from orders)
select 'coverage' as name, count(*) as matched, 0::bigint as unmatched, 'string' as port_type from f""")
def star_text_partition(spark, sf):
    """A fact partitioned by a zero-padded text code keeps the code's type and
    finds every code in the dimension again; files are range-clustered."""
    from starbuild.plans.star import StarSpec, run_star
    port = F.lpad((F.col("o_custkey") % 25).cast("string"), 2, "0")
    staged = fx.orders_staged(spark, sf).withColumn("port", port)
    entity = staged.select("port").distinct()
    spec = StarSpec(fact_name="port_facts", fact_key="o_orderkey", flags=FLAGS,
                    flag_dim_name="dim_status", flag_key="status_flag_id", date_columns=["o_orderdate"],
                    date_dim_name="dim_time", entity_name="dim_ports", entity_key="port",
                    entity_columns=["port"], entity_fk="port",
                    fact_layout=[("order_id", "o_orderkey", "bigint"), ("status", "status_flag_id", None),
                                 ("port", "port", None)])
    run = run_star(spark, staged, spec, scratch_path(spark, "port-star"), entity_src=entity,
                   fact_partition_by=["port"], cluster="range", max_records_per_file=100_000)
    kind = dict(run.star.read(spark, "port_facts").dtypes)["port"]
    return run.checks["coverage_port_facts_dim_ports"].select(
        F.lit("coverage").alias("name"), "matched", "unmatched", F.lit(kind).alias("port_type"))


@register("sequence_id_payload", """
select c.*, row_number() over (order by c_name) - 1 as name_rank from customer c""")
def sequence_id_payload(spark, sf):
    from starbuild.operators.sequence import with_sequence_id
    return with_sequence_id(fx.table(spark, sf, "customer"), ["c_name"], "name_rank")


# --------------------------------------------------------------- loads and publishing

@register("incremental_dimension", """
with first as (select distinct c_nationkey, c_mktsegment from customer where c_acctbal < 0),
     ranked as (select *, row_number() over (order by c_nationkey, c_mktsegment) - 1 as k from first),
     fresh as (select distinct c_nationkey, c_mktsegment from customer where c_acctbal >= 0
               except select * from first)
select * from ranked
union all
select *, (select count(*) from first) + row_number() over (order by c_nationkey, c_mktsegment) - 1 from fresh""")
def incremental_dimension(spark, sf):
    """A combination dimension in two loads: the keys of the first one stay, the
    combinations that the second one adds continue from them."""
    c = fx.table(spark, sf, "customer")
    flags = ["c_nationkey", "c_mktsegment"]
    first = dims.combination_dimension(c.where("c_acctbal < 0"), flags, "k").checkpoint(eager=True)
    combos = dims.flag_combinations(c.where("c_acctbal >= 0"), flags)
    return dims.extend_combinations(first, combos, flags, "k", first.count())


@register("star_published", f"""
with s as (select * from {_ORDERS_STAGED} x)
select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_dt, o_orderpriority as priority,
       case when o_orderpriority is null then null else o_orderstatus end as status,
       case when o_orderdate < date '1995-01-01' then 1 else 2 end as load,
       {_DATE_PARTS.format(d="o_orderdate")} from s""")
def star_published(spark, sf):
    """Orders loaded by period into a published star, read through its manifest:
    every fact finds its flags and its date, whichever load it came with."""
    from starbuild.plans import publish
    staged, entity, rollup, spec = _star_inputs(spark, sf)
    root = scratch_path(spark, "published")
    old = F.col("o_orderdate") < F.lit("1995-01-01").cast("date")
    made = None
    for part in (old, ~old):
        made = publish.load_star(spark, staged.where(part), spec, root, append=True, entity_src=entity,
                                 rollup_src=rollup, fact_partition_by=["priority"])
    fact = publish.read_table(spark, root, "order_facts", made)
    flags = publish.read_table(spark, root, "dim_status", made)
    days = publish.read_table(spark, root, "dim_time", made)
    out = (fact.join(flags.withColumnRenamed("o_orderstatus", "flag"), fact["status"] == flags["status_flag_id"], "left")
           .join(days, fact["order_dt"] == days["datestamp"], "left"))
    load = F.when(F.col("order_dt") < F.lit("1995-01-01").cast("date"), 1).otherwise(2)
    return out.select("order_id", "customer_id", "order_dt", "priority", F.col("flag").alias("status"), load.alias("load"),
                      "day_of_month", "day_of_year", "week", "month", "year")
