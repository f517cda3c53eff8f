"""One query per building block, on the given tables."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanops.functions import rules, timekit
from loanops.operators import aggregates, history, joins
from loanops.sources.catalog import from_frames
from loanops.sources.sinks import with_row_number
from workload.registry import query
from workload.standins import AS_OF, EVENTS_AS_OF

ORDERS_NOW, EVENTS_NOW = f"timestamp '{AS_OF}'", f"timestamp '{EVENTS_AS_OF}'"
OFFSET = "interval '330 minutes'"


# ---- A, B: sources, projections, filters


@query("a1_scan", "select l_orderkey, l_linenumber, l_shipdate from lineitem")
def _(t):
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "a2_federation",
    "select o_orderkey, c_name, n_name from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey",
)
def _(t):
    both = from_frames({"orders": t["orders"]}) | from_frames({"customer": t["customer"], "nation": t["nation"]})
    joined = both["orders"].join(both["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return joined.join(both["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")


@query(
    "a5_row_number",
    "select row_number() over (order by o_orderdate desc, o_orderkey) - 1 as index, o_orderkey, o_orderdate from orders",
)
def _(t):
    rows = t["orders"].select("o_orderkey", "o_orderdate")
    return with_row_number(rows, [F.col("o_orderdate").desc(), F.col("o_orderkey")])


@query(
    "b3_rename_drop_literal",
    "select c_custkey as \"Customer ID\", c_name as \"Customer Name\", 'LMS' as source from customer",
)
def _(t):
    frame = t["customer"].drop("c_nationkey", "c_acctbal", "c_mktsegment").withColumn("source", F.lit("LMS"))
    return frame.withColumnsRenamed({"c_custkey": "Customer ID", "c_name": "Customer Name"})


@query(
    "b7_case_in_null",
    """select o_orderkey, case when o_orderstatus in ('F', null) then 'done' when o_orderstatus not in ('F', 'O') then
       case when o_totalprice > 250000 then 'large' else null end else 'open' end as kind from orders""",
)
def _(t):
    status = F.col("o_orderstatus")
    large = F.when(F.col("o_totalprice") > 250000, "large")
    kind = F.when(status.isin("F", None), "done").when(~status.isin("F", "O"), large).otherwise("open")
    return t["orders"].select("o_orderkey", kind.alias("kind"))


@query("b12_lookback", f"select o_orderkey from orders where cast(o_orderdate as date) >= cast({ORDERS_NOW} as date) - 900")
def _(t):
    return t["orders"].filter(timekit.since_day(F.col("o_orderdate"), AS_OF, 900)).select("o_orderkey")


@query("b12_lookback_instant", f"select event_id from events where ts >= {EVENTS_NOW} - interval '15 days'")
def _(t):
    return t["events"].filter(timekit.since_instant(F.col("ts"), EVENTS_AS_OF, 15)).select("event_id")


@query(
    "b13_cutoff",
    f"""select event_id from events where ts + {OFFSET} < cast(cast({EVENTS_NOW} as date) as timestamp) + interval '750 minutes'
        and ts + {OFFSET} > cast(cast({EVENTS_NOW} as date) as timestamp) - interval '1 day' + interval '750 minutes'""",
)
def _(t):
    return t["events"].filter(timekit.business_day_window(F.col("ts"), EVENTS_AS_OF)).select("event_id")


@query(
    "b14_late_arrivals",
    """select event_id from events where cast(ts as date) = date '2024-01-20' or (cast(ts as date) < date '2024-01-20'
       and ts + interval '1' hour * (event_id % 240) > timestamp '2024-01-20 09:00:00')""",
)
def _(t):
    updated = F.expr("ts + interval '1' hour * (event_id % 240)")
    return t["events"].filter(timekit.on_day_or_late(F.col("ts"), updated, EVENTS_AS_OF)).select("event_id")


@query("b15_same_day", f"select event_id from events where date_trunc('day', ts) = date_trunc('day', {EVENTS_NOW})")
def _(t):
    return t["events"].filter(timekit.same_day(F.col("ts"), EVENTS_AS_OF)).select("event_id")


@query("b18_point_lookup", "select * from orders where o_orderkey = 77")
def _(t):
    return t["orders"].filter(F.col("o_orderkey") == 77)


@query(
    "b19_last_match",
    """select o_orderkey, case when o_orderstatus = 'F' then 'c' when o_totalprice > 100000 then 'b' when o_orderkey % 2 = 0 then 'a' end
       as mark from orders""",
)
def _(t):
    marks = [
        (F.col("o_orderkey") % 2 == 0, "a"),
        (F.col("o_totalprice") > 100000, "b"),
        (F.col("o_orderstatus") == "F", "c"),
    ]
    return t["orders"].select("o_orderkey", rules.last_match(marks).alias("mark"))


@query("b21_exclude_rows", "select s_suppkey, s_name from supplier where s_suppkey not in (3, 5)")
def _(t):
    return t["supplier"].filter(~F.col("s_suppkey").isin(3, 5)).select("s_suppkey", "s_name")


# ---- C: joins


@query(
    "c1_left_dims",
    """select o_orderkey, c_mktsegment as segment, n_name as nation from orders left join customer on c_custkey = o_custkey + 5
       left join nation on n_nationkey = c_nationkey - 2""",
)
def _(t):
    fact = t["orders"].select("o_orderkey", (F.col("o_custkey") + 5).alias("k"))
    fact = joins.left_dims(
        fact, [joins.Dimension(t["customer"], "k", "c_custkey", {"segment": "c_mktsegment", "n": "c_nationkey"})]
    )
    fact = joins.left_dims(
        fact.withColumn("n", F.col("n") - 2), [joins.Dimension(t["nation"], "n", "n_nationkey", {"nation": "n_name"})]
    )
    return fact.select("o_orderkey", "segment", "nation")


@query(
    "c3_full_coalesce",
    """select coalesce(a.k, b.k) as k, a.n, b.total from (select l_partkey % 150 as k, count(*) as n from lineitem group by 1) a
       full join (select o_custkey % 200 as k, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from orders group by 1) b
       on a.k = b.k""",
)
def _(t):
    left = t["lineitem"].groupBy((F.col("l_partkey") % 150).alias("k")).agg(F.count("*").alias("n"))
    money = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    right = t["orders"].groupBy((F.col("o_custkey") % 200).alias("k")).agg(money.alias("total"))
    return joins.full_coalesce(left, right, ["k"])


@query(
    "c4_full_two_keys",
    """select coalesce(a.day, b.day) as day, coalesce(a.lender, b.lender) as lender, coalesce(a.n, 0) as bought, coalesce(b.n, 0) as failed
       from (select cast(ts as date) as day, nullif(user_id % 7, 0) as lender, count(*) as n from events where event_type = 'purchase' group by all) a
       full join (select cast(ts as date) as day, nullif(user_id % 7, 0) as lender, count(*) as n from events where event_type = 'error' group by all) b
       on a.day = b.day and a.lender = b.lender""",
)
def _(t):
    rows = t["events"].select(F.to_date("ts").alias("day"), F.expr("nullif(user_id % 7, 0)").alias("lender"), "event_type")

    def count(kind, name):
        return rows.filter(F.col("event_type") == kind).groupBy("day", "lender").agg(F.count("*").alias(name))

    both = joins.full_coalesce(count("purchase", "bought"), count("error", "failed"), ["day", "lender"])
    return both.fillna(0, ["bought", "failed"])


@query(
    "c5_full_rows",
    """select a.o_orderkey, a.k as order_person, b.event_id, b.k as event_person
       from (select o_orderkey, nullif(o_custkey % 400, 7) as k from orders) a
       full join (select event_id, nullif(user_id + event_id % 300, 11) as k from events where event_type = 'signup') b on a.k = b.k""",
)
def _(t):
    left = t["orders"].select("o_orderkey", F.expr("nullif(o_custkey % 400, 7)").alias("order_person"))
    right = t["events"].filter("event_type = 'signup'").select("event_id", F.expr("nullif(user_id + event_id % 300, 11)").alias("event_person"))
    return joins.spread_join(left, right, ["order_person"], ["event_person"], "full")


@query(
    "c5_full_rows_hot",
    """select a.o_orderkey, a.k as order_person, b.event_id, b.k as event_person
       from (select o_orderkey, nullif(o_custkey % 400, 7) as k from orders) a
       full join (select event_id, nullif(user_id + event_id % 300, 11) as k from events where event_type = 'signup') b on a.k = b.k""",
)
def _(t):
    left = t["orders"].select("o_orderkey", F.expr("nullif(o_custkey % 400, 7)").alias("order_person"))
    right = t["events"].filter("event_type = 'signup'").select("event_id", F.expr("nullif(user_id + event_id % 300, 11)").alias("event_person"))
    return joins.spread_join(left, right, ["order_person"], ["event_person"], "full", hot_parts=5000)


_KEYED = "select event_id, nullif(user_id, 3) as person, case when user_id % 5 > 0 then cast(ts as date) end as seen from events"


def _keyed(t):
    return t["events"].select(
        "event_id",
        F.expr("nullif(user_id, 3)").alias("person"),
        F.when(F.col("user_id") % 5 > 0, F.to_date("ts")).alias("seen"),
    )


def _extreme(fn):
    return f"""select r.* from ({_KEYED}) r join (select person, {fn}(seen) as best from ({_KEYED}) where person is not null group by 1) b
       on r.person = b.person and r.seen is not distinct from b.best"""


@query("c6_keep_latest", _extreme("max"))
def _(t):
    return history.keep_extreme(_keyed(t), ["person"], "seen", "max")


@query("c6_keep_earliest", _extreme("min"))
def _(t):
    return history.keep_extreme(_keyed(t), ["person"], "seen", "min")


@query("c7_group_max", _extreme("max") + " and r.seen is not null")
def _(t):
    return history.group_max_rows(_keyed(t), ["person"], "seen")


@query(
    "c8_next_after",
    """select e.user_id, min(e.ts) as next_on from events e
       join (select user_id, max(ts) as last from events where event_type = 'click' group by 1) c on c.user_id = e.user_id
       where e.event_type = 'purchase' and e.ts > c.last group by 1""",
)
def _(t):
    return history.next_after(t["events"], "user_id", "event_type", "ts", "click", "purchase")


@query(
    "c9_attach_min",
    """select o_orderkey, o_custkey, first_on from orders join (select o_custkey as k, min(o_orderdate) as first_on from orders group by 1) on k = o_custkey""",
)
def _(t):
    rows = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    return history.with_group_min(rows, ["o_custkey"], "o_orderdate", "first_on").drop("o_orderdate")


@query(
    "c10_filtered_left",
    """select c_custkey, o_orderkey from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'F' and o_totalprice > 400000""",
)
def _(t):
    large = t["orders"].filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)).select("o_orderkey", "o_custkey")
    joined = t["customer"].select("c_custkey").join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.drop("o_custkey")


@query(
    "c11_exists_flag",
    "select c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P') as has_open from customer",
)
def _(t):
    buyers = t["orders"].filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")).distinct()
    joined = t["customer"].select("c_custkey").join(buyers, F.col("c_custkey") == F.col("k"), "left")
    return joined.select("c_custkey", F.col("k").isNotNull().alias("has_open"))


# ---- D: aggregates


@query("d1_count", "select l_returnflag, l_linestatus, l_shipdate, count(*) as count from lineitem group by all")
def _(t):
    return t["lineitem"].groupBy("l_returnflag", "l_linestatus", "l_shipdate").agg(F.count("*").alias("count"))


@query(
    "d6_mean",
    """select o_orderpriority, cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as mean_price from orders group by 1""",
)
def _(t):
    money = t["orders"].withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    return money.groupBy("o_orderpriority").agg(aggregates.mean("price").alias("mean_price"))


@query("d7_median", "select l_suppkey, round(median(l_extendedprice), 4) as median from lineitem group by 1")
def _(t):
    frame = aggregates.exact_median(t["lineitem"], ["l_suppkey"], "l_extendedprice")
    return frame.withColumn("median", F.round("median", 4))


@query(
    "d7_median_signed",
    """select event_type, round(median(value * if(event_id % 2 = 0, -1, 1)), 4) as median from events group by 1""",
)
def _(t):
    signed = t["events"].withColumn("v", F.col("value") * F.when(F.col("event_id") % 2 == 0, -1).otherwise(1))
    return aggregates.exact_median(signed, ["event_type"], "v").withColumn("median", F.round("median", 4))


@query(
    "d7_median_hard_values",
    """select event_type, median(1.7e9 + event_id / 1024) as far, median(value / 1e9) as small,
       median(case when event_id % 7 > 0 then value end) as known from events group by 1""",
)
def _(t):
    """A narrow range far from 0, values near 0, and values that are not a number."""
    rows = t["events"].select(
        "event_type",
        (F.lit(1.7e9) + F.col("event_id") / 1024).alias("far"),
        (F.col("value") / F.lit(1e9)).alias("small"),
        F.when(F.col("event_id") % 7 > 0, F.col("value")).otherwise(F.lit(float("nan"))).alias("known"),
    )
    parts = [aggregates.exact_median(rows, ["event_type"], c, c) for c in ("far", "small", "known")]
    return parts[0].join(parts[1], "event_type").join(parts[2], "event_type")


@query(
    "d10_count_if",
    """select user_id, count(case when event_type = 'click' then 1 end) as clicks, count(case when value > 50 then 1 end) as large,
       count(nullif(event_id % 3, 0)) as named from events group by 1""",
)
def _(t):
    return t["events"].groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("value") > 50).alias("large"),
        F.count(F.expr("nullif(event_id % 3, 0)")).alias("named"),
    )


@query(
    "d12_distinct_if",
    """select cast(ts as date) as day, count(distinct user_id) as users, count(distinct case when event_type = 'purchase' then user_id end) as buyers,
       count(distinct props) as payloads, count(distinct case when event_type = 'error' then props end) as failed_payloads from events group by 1""",
)
def _(t):
    kind = F.col("event_type")
    return aggregates.distinct_counts(
        t["events"].withColumn("day", F.to_date("ts")).select("day", "user_id", "event_type", "props"),
        ["day"],
        {
            "users": ("user_id", None),
            "buyers": ("user_id", kind == "purchase"),
            "payloads": ("props", None),
            "failed_payloads": ("props", kind == "error"),
        },
    )


@query(
    "d13_sum_if",
    """select o_custkey, cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) end) as double) as done from orders group by 1""",
)
def _(t):
    done = F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)"))).cast("double")
    return t["orders"].groupBy("o_custkey").agg(done.alias("done"))


@query(
    "d14_flag_max",
    """select user_id, max(case when event_type = 'purchase' then 'Y' else 'N' end) as bought, max(case when value > 300 then 'Y' else 'N' end)
       as large from events group by 1""",
)
def _(t):
    return t["events"].groupBy("user_id").agg(
        aggregates.flag_any(F.col("event_type") == "purchase").alias("bought"),
        aggregates.flag_any(F.col("value") > 300).alias("large"),
    )


@query(
    "d16_count_all",
    """select k, count(event_id) as event_id, count(user_id) as user_id, count(value) as value from
       (select nullif(user_id % 9, 0) as k, event_id, nullif(user_id, 4) as user_id, case when value > 5 then value end as value from events)
       where k is not null group by 1""",
)
def _(t):
    rows = t["events"].select(
        F.expr("nullif(user_id % 9, 0)").alias("k"),
        "event_id",
        F.expr("nullif(user_id, 4)").alias("user_id"),
        F.when(F.col("value") > 5, F.col("value")).alias("value"),
    )
    return aggregates.count_columns(rows, ["k"])


@query(
    "d18_min_of_max",
    """select c_nationkey, min(last_on) as first_last from (select o_custkey, max(o_orderdate) as last_on from orders group by 1)
       join customer on c_custkey = o_custkey group by 1""",
)
def _(t):
    last = t["orders"].groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_on"))
    joined = last.join(t["customer"].select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
    return joined.groupBy("c_nationkey").agg(F.min("last_on").alias("first_last"))


@query(
    "d19_span",
    "select l_suppkey, l_partkey, min(l_shipdate) as first_on, max(l_shipdate) as last_on from lineitem group by 1, 2",
)
def _(t):
    return t["lineitem"].groupBy("l_suppkey", "l_partkey").agg(
        F.min("l_shipdate").alias("first_on"), F.max("l_shipdate").alias("last_on")
    )


# ---- E, F: ranking, set operations


@query(
    "e1_latest_row",
    """select l_orderkey, l_shipdate, l_partkey, l_quantity from (select l_orderkey, l_shipdate, l_partkey, l_quantity,
       row_number() over (partition by l_orderkey order by l_shipdate desc nulls first, l_partkey, l_quantity) as rn from
       (select l_orderkey, case when l_partkey % 10 > 0 then l_shipdate end as l_shipdate, l_partkey, l_quantity from lineitem)) where rn = 1""",
)
def _(t):
    rows = t["lineitem"].select(
        "l_orderkey", F.when(F.col("l_partkey") % 10 > 0, F.col("l_shipdate")).alias("l_shipdate"), "l_partkey", "l_quantity"
    )
    return history.latest_row(rows, ["l_orderkey"], "l_shipdate")


@query(
    "f1_union_distinct",
    """select l_partkey as k, l_returnflag as tag from lineitem union select l_suppkey, 'S' from lineitem
       union select o_custkey, 'C' from orders union select s_suppkey, 'S' from supplier""",
)
def _(t):
    arms = [
        t["lineitem"].select(F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("tag")),
        t["lineitem"].select(F.col("l_suppkey").alias("k"), F.lit("S").alias("tag")),
        t["orders"].select(F.col("o_custkey").alias("k"), F.lit("C").alias("tag")),
        t["supplier"].select(F.col("s_suppkey").alias("k"), F.lit("S").alias("tag")),
    ]
    return reduce(DataFrame.unionByName, arms).distinct()


@query(
    "f3_union_all",
    """select 'customer' as side, c_custkey as k, c_acctbal as balance from customer union all select 'supplier', s_suppkey, null from supplier""",
)
def _(t):
    left = t["customer"].select(F.lit("customer").alias("side"), F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"))
    right = t["supplier"].select(F.lit("supplier").alias("side"), F.col("s_suppkey").alias("k"))
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "j16_first_state_time",
    """select user_id, min(case when event_type in ('click', 'view') then ts end) as looked_on,
       min(case when event_type in ('purchase', 'view') then ts end) as acted_on from events
       where event_type in ('click', 'view', 'purchase') group by 1""",
)
def _(t):
    return history.first_state_times(
        t["events"], "user_id", "event_type", "ts", {"looked_on": ("click", "view"), "acted_on": ("purchase", "view")}
    )


# ---- G, H: scalar rules


@query(
    "g1_elapsed",
    f"""select event_id, (epoch_us({EVENTS_NOW}) - epoch_us(ts)) / 3600000000.0 as hours, (epoch_us({EVENTS_NOW}) - epoch_us(ts)) / 86400000000.0 as days,
        (epoch_us({EVENTS_NOW}) - epoch_us(ts)) / 60000000.0 as minutes from events""",
)
def _(t):
    now, ts = timekit.instant(EVENTS_AS_OF), F.col("ts")
    return t["events"].select("event_id", *[timekit.elapsed_in(now, ts, u).alias(u) for u in ("hours", "days", "minutes")])


@query(
    "g2_bucket",
    f"""select event_id, case when {EVENTS_NOW} - since <= interval '2 hours' then 'L1' when {EVENTS_NOW} - since <= interval '6 days' then 'L2'
        else 'L3' end as level from (select event_id, case when event_id % 8 > 0 then ts end as since from events)""",
)
def _(t):
    since = F.when(F.col("event_id") % 8 > 0, F.col("ts"))
    gap = timekit.elapsed(timekit.instant(EVENTS_AS_OF), since)
    return t["events"].select("event_id", timekit.level(gap, timedelta(hours=2), timedelta(days=6)).alias("level"))


@query(
    "g3_platform_type",
    """select n_nationkey, case when n_name in ('NATION_1', 'NATION_2') then 'Direct' when n_name in ('NATION_3') then 'Software' else 'Other' end
       as platform_type from nation""",
)
def _(t):
    kind = rules.platform_type(F.col("n_name"), {"Direct": ["NATION_1", "NATION_2"], "Software": ["NATION_3"]})
    return t["nation"].select("n_nationkey", kind.alias("platform_type"))


@query(
    "g6_trunc",
    """select event_id, cast(date_trunc('day', ts) as timestamp) as day_start, cast(date_trunc('week', ts) as timestamp) as week_start,
       cast(date_trunc('month', ts) as timestamp) as month_start from events""",
)
def _(t):
    return t["events"].select("event_id", *[timekit.trunc(u, F.col("ts")).alias(f"{u}_start") for u in ("day", "week", "month")])


@query(
    "g7_month_diff",
    f"""select o_orderkey, (year({ORDERS_NOW}) - year(o_orderdate)) * 12 + month({ORDERS_NOW}) - month(o_orderdate) as month_count from orders""",
)
def _(t):
    gap = timekit.month_gap(timekit.instant(AS_OF), F.col("o_orderdate"))
    return t["orders"].select("o_orderkey", gap.alias("month_count"))


@query("g8_day_part", f"select event_id, date_part('day', {EVENTS_NOW} - ts) as whole_days from events")
def _(t):
    return t["events"].select("event_id", timekit.whole_days(timekit.instant(EVENTS_AS_OF), F.col("ts")).alias("whole_days"))


@query(
    "g9_interval_shift",
    """select event_id, ts + interval '30 minutes' as half_hour_on, ts + interval '4 hours' as hours_on, ts - interval '7 days' as week_back,
       ts - interval '2 months' as months_back from events""",
)
def _(t):
    ts = F.col("ts")
    return t["events"].select(
        "event_id",
        (ts + F.lit(timedelta(minutes=30))).alias("half_hour_on"),
        (ts + F.lit(timedelta(hours=4))).alias("hours_on"),
        (ts - F.lit(timedelta(days=7))).alias("week_back"),
        (ts - F.make_ym_interval(F.lit(0), F.lit(2))).alias("months_back"),
    )


@query(
    "g10_text_to_time",
    """select event_id, try_cast(text as timestamp) as moment from (select event_id,
       case when event_id % 9 = 0 then 'n/a' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as text from events)""",
)
def _(t):
    text = F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t["events"].select("event_id", text.try_cast("timestamp_ntz").alias("moment"))


@query("g11_ist", f"select event_id, ts + {OFFSET} as local_on, cast(ts + {OFFSET} as date) as local_day from events")
def _(t):
    local = timekit.to_business_time(F.col("ts"))
    return t["events"].select("event_id", local.alias("local_on"), F.to_date(local).alias("local_day"))


@query(
    "g11_zone_names",
    """select o_orderkey, at_sea at time zone 'UTC' at time zone 'Asia/Kolkata' as in_india,
         at_sea at time zone 'UTC' at time zone 'America/New_York' as in_new_york,
         cast(at_sea at time zone 'UTC' at time zone 'Europe/Berlin' as date) as day_in_berlin
       from (select o_orderkey, cast(o_orderdate as timestamp) + interval 1 minute * (o_orderkey % 1440) as at_sea from orders)""",
)
def _(t):
    """Seven years of moments, over every change of the clock."""
    moment = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    return t["orders"].select(
        "o_orderkey",
        timekit.to_zone(moment, "Asia/Kolkata").alias("in_india"),
        timekit.to_zone(moment, "America/New_York").alias("in_new_york"),
        F.to_date(timekit.to_zone(moment, "Europe/Berlin")).alias("day_in_berlin"),
    )


@query(
    "g12_period",
    "select strftime(l_shipdate, '%Y-%m') as month, strftime(l_shipdate, '%Y-%m-%d') as day, count(*) as n from lineitem group by all",
)
def _(t):
    ship = F.col("l_shipdate")
    keys = [timekit.period(ship, "M").alias("month"), timekit.period(ship, "D").alias("day")]
    return t["lineitem"].groupBy(*keys).agg(F.count("*").alias("n"))


@query("g13_display_date", "select event_id, strftime(ts, '%d %b %Y') as shown from events")
def _(t):
    return t["events"].select("event_id", F.date_format("ts", "dd MMM yyyy").alias("shown"))


@query(
    "g16_row_min",
    """select o_orderkey, least(case when o_orderkey % 3 > 0 then o_totalprice end, case when o_orderkey % 5 > 0 then o_custkey * 100.0 end) as low,
       coalesce(case when o_orderkey % 3 > 0 then o_totalprice end, case when o_orderkey % 5 > 0 then o_custkey * 100.0 end, 0) as filled from orders""",
)
def _(t):
    a = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice"))
    b = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey") * F.lit(100.0))
    return t["orders"].select("o_orderkey", F.least(a, b).alias("low"), F.coalesce(a, b, F.lit(0.0)).alias("filled"))


@query(
    "g17_safe_ratio",
    "select o_orderkey, cast(o_custkey as double) / nullif(o_orderkey % 4, 0) as ratio from orders",
)
def _(t):
    return t["orders"].select("o_orderkey", rules.safe_ratio(F.col("o_custkey"), F.col("o_orderkey") % 4).alias("ratio"))


@query(
    "g19_blank_nulls",
    "select cast(c_custkey as varchar) as c_custkey, coalesce(case when c_custkey % 2 = 0 then c_name end, '') as c_name from customer",
)
def _(t):
    rows = t["customer"].select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("c_name"))
    return rules.blank_nulls(rows)


_PADDED = "case c_custkey % 3 when 0 then '  ' || c_name || ' ' when 1 then '   ' end"


@query("g20_trim", f"select c_custkey, trim({_PADDED}) as text from customer")
def _(t):
    return t["customer"].select("c_custkey", rules.trimmed(F.expr(_PADDED)).alias("text"))


@query("g21_bracket", f"select c_custkey, if(trim({_PADDED}) <> '', '[' || {_PADDED} || ']', {_PADDED}) as text from customer")
def _(t):
    return t["customer"].select("c_custkey", rules.bracketed(F.expr(_PADDED)).alias("text"))


@query("g22_json", "select event_id, props ->> '$.k' as k, props ->> '$.absent' as absent from events")
def _(t):
    props = F.col("props")
    return t["events"].select("event_id", rules.json_text(props, "k").alias("k"), rules.json_text(props, "absent").alias("absent"))


@query("g23_array_lookup", "select conv_id, turn, case when turn = 2 then text when turn > 3 then role end as found from conversations")
def _(t):
    items = F.array(
        F.struct(F.col("turn").alias("id"), F.col("text").alias("value")),
        F.struct(F.when(F.col("turn") > 3, 2).cast("bigint").alias("id"), F.col("role").alias("value")),
    )
    return t["conversations"].select("conv_id", "turn", rules.value_by_id(items, 2).alias("found"))


@query(
    "h1_limit",
    """select o_orderkey, cast(case when o_totalprice >= 250000 then o_totalprice when o_custkey * 400 >= 250000 then o_custkey * 400 else 0 end as double)
       as eligible from orders""",
)
def _(t):
    limit = rules.eligible_limit(F.col("o_totalprice"), F.col("o_custkey") * 400, 250000)
    return t["orders"].select("o_orderkey", limit.cast("double").alias("eligible"))


_STAGE_INPUT = """select event_id, nullif(event_id % 3, 0) as lead_id, nullif(event_id % 5, 0) as application_id,
    case when event_id % 2 = 0 then value else 0 end as available, case when event_id % 7 > 3 then value else 0 end as pledged,
    case event_type when 'purchase' then 'COMPLETED' when 'click' then 'IN_PROGRESS' end as state from events"""


@query(
    "h6_stage",
    f"""select event_id, case when state = 'COMPLETED' then 'Completed' when pledged > 0 and state = 'IN_PROGRESS' then 'Post Pledge'
        when available > 0 and pledged = 0 then 'Post Fetch' when application_id is not null then 'Pre Fetch'
        when lead_id is not null then 'MFC Fetch' end as stage, if(lead_id is not null, 'mfc_journey', 'app_only_journey') as journey
        from ({_STAGE_INPUT})""",
)
def _(t):
    kind = F.col("event_type")
    lead, app = F.expr("nullif(event_id % 3, 0)"), F.expr("nullif(event_id % 5, 0)")
    available = F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(0)
    pledged = F.when(F.col("event_id") % 7 > 3, F.col("value")).otherwise(0)
    state = F.when(kind == "purchase", "COMPLETED").when(kind == "click", "IN_PROGRESS")
    stage = rules.application_stage(lead, app, available, pledged, state)
    return t["events"].select("event_id", stage.alias("stage"), rules.journey_kind(lead).alias("journey"))


@query(
    "h8_channel",
    """select o_orderkey, case when platform is not null and platform not in (1, 2) then 'B2B'
       when (platform in (1, 2) or platform is null) and partner is not null and kind in ('INDIVIDUAL', null) then 'B2B2C' else 'B2C' end as channel
       from (select o_orderkey, nullif(o_orderkey % 6, 0) as platform, nullif(o_orderkey % 4, 0) as partner,
             case o_orderkey % 5 when 0 then null when 1 then 'COMPANY' else 'INDIVIDUAL' end as kind from orders)""",
)
def _(t):
    kind = F.when(F.col("o_orderkey") % 5 == 1, "COMPANY").when(F.col("o_orderkey") % 5 > 1, "INDIVIDUAL")
    channel = rules.business_channel(
        F.expr("nullif(o_orderkey % 6, 0)"), F.expr("nullif(o_orderkey % 4, 0)"), kind, [1, 2]
    )
    return t["orders"].select("o_orderkey", channel.alias("channel"))


_RAW_PHONE = "case c_custkey % 4 when 0 then '0' when 1 then '+91-' when 2 then ' ' else '91' end || cast(5000000000 + c_custkey * 3141592 as string)"
_DIGITS = f"regexp_replace(regexp_replace({_RAW_PHONE}, '[^0-9]', '', 'g'), '^0+', '')"


@query(
    "h5_phone",
    f"""select c_custkey, case when regexp_full_match(bare, '[6-9][0-9]{{9}}') then bare end as phone from (select c_custkey,
        case when length(digits) > 10 then regexp_replace(digits, '^91', '') else digits end as bare from (select c_custkey, {_DIGITS} as digits from customer))""",
)
def _(t):
    return t["customer"].select("c_custkey", rules.valid_phone(F.expr(_RAW_PHONE)).alias("phone"))
