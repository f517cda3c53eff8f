"""Reports written by the sinks and read back, and ticket pages from JSON text."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanops.functions.rules import flatten
from loanops.plans import daily, sla, tickets
from loanops.session import checkpoint_folder
from loanops.sources import sinks
from loanops.sources.ticket_pages import parse_pages, read_ticket_pages
from workload.daily_queries import COLLECTED
from workload.registry import ORACLES, query
from workload.sla_queries import BOARDS, RECENT_AS_OF, RECENT_CUBES, TERMS
from workload.standins import AS_OF


def _folder(frame: DataFrame) -> str:
    """A new folder that driver and executors share."""
    return f"{checkpoint_folder(frame.sparkSession)}/report-{uuid4()}"


def _read_csv(like: DataFrame, folder: str) -> DataFrame:
    return like.sparkSession.read.schema(like.schema).options(**sinks.CSV).csv(folder)


@query("a4_csv", "select c_custkey, c_name, c_acctbal, '[\"' || c_mktsegment || '\",\"x\"]' as tags from customer")
def _(t):
    frame = t["customer"].select("c_custkey", "c_name", "c_acctbal", F.array("c_mktsegment", F.lit("x")).alias("tags"))
    sinks.write_csv(frame, folder := _folder(frame), [F.desc("c_acctbal")])
    return _read_csv(sinks.as_text(frame), folder)


@query(
    "a5_indexed_csv",
    """select row_number() over (order by c_acctbal desc, c_custkey) - 1 as index, c_custkey, c_acctbal, c_name as dotted_name from customer""",
)
def _(t):
    frame = t["customer"].select("c_custkey", "c_acctbal", F.col("c_name").alias("customer.name"))
    sinks.write_indexed_csv(frame, folder := _folder(frame), [F.desc("c_acctbal"), "c_custkey"])
    back = t["customer"].sparkSession.read.schema("index long, c_custkey long, c_acctbal double, `customer.name` string")
    return back.options(**sinks.CSV).csv(folder).withColumnRenamed("customer.name", "dotted_name")


@query(
    "a6_publish",
    f"""select channel_type as request_type, success_within_sla as resolved_within_sla, success_l1 as l1_resolved_sla_breached,
        success_l2 as l2_resolved_sla_breached, success_l3 as l3_resolved_sla_breached, non_success_within_sla as unresolved_within_sla,
        non_success_l1 as "1d_unresolved_sla_breached", non_success_l2 as "3d_unresolved_sla_breached",
        non_success_l3 as "5d_unresolved_sla_breached", non_success_l4 as "5d_plus_unresolved_sla_breached", lender_id as lender
        from ({BOARDS['j15_scoreboard']})""",
)
def _(t):
    board = sla.scoreboard(t, TERMS, AS_OF, display=True)
    folder = _folder(board)
    for _ in range(2):  # the second write replaces the first
        sinks.publish(board, "Aggregate sheet", folder, order=["Lender", "Request Type"])
    return board.sparkSession.read.parquet(f"{folder}/aggregate_sheet")


@query("a8_per_lender", f"select request_id, lender_id, lender_id as lender from ({COLLECTED})")
def _(t):
    frame = daily.foreclosure_collections(t, AS_OF).select("request_id", "lender_id")
    sinks.write_per_lender(frame, folder := _folder(frame), order=["request_id"])
    back = frame.sparkSession.read.schema(f"{frame.schema.simpleString()[7:-1]}, lender string".replace(":", " "))
    return back.options(**sinks.CSV).csv(folder)


# Published titles of the cubes.
_TITLES = {
    "j01_withdrawals": "data_withdrawal",
    "j02_repayments": "data_repayments",
    "j03_lien_removal": "data_lien_removal",
    "j04_foreclosure": "data_foreclosure",
    "j05_account_opening": "data_account_opening",
    "j06_lodgement": "data_lodgement",
    "j07_enhancement": "data_enhancement",
}


@query(
    "a9_publish_all",
    " union all ".join(
        f"""select '{title}' as report, {date} as day, {verdict} as verdict, time_delay_till_today, delay_in_settlement, count
            from ({RECENT_CUBES[name]}) as cube(day, verdict, time_delay_till_today, delay_in_settlement, count)"""
        for name, title in _TITLES.items()
        for date, verdict in (("day", "verdict"),)
    ),
)
def _(t):
    reports = sla.published_reports(t, TERMS, RECENT_AS_OF)
    folder = _folder(t["orders"])
    sinks.publish_all(reports, folder)
    read = t["orders"].sparkSession.read.parquet
    back = [read(f"{folder}/{title}") for title in _TITLES.values()]
    names = ["day", "verdict", "time_delay_till_today", "delay_in_settlement", "count"]
    return reduce(DataFrame.unionByName, [f.toDF(*names).withColumn("report", F.lit(n)) for n, f in zip(_TITLES.values(), back)])


@query("a9_publish_run", ORACLES["a9_publish_all"])
def _(t):
    """Two runs; the first publishes other figures, the last one is read."""
    folder = _folder(t["orders"])
    sinks.publish_run({title: f.limit(0) for title, f in sla.published_reports(t, TERMS, RECENT_AS_OF).items()}, folder)
    sinks.publish_run(sla.published_reports(t, TERMS, RECENT_AS_OF), folder)
    back = {sinks.table_name(title): f for title, f in sinks.read_published(t["orders"].sparkSession, folder).items()}
    names = ["day", "verdict", "time_delay_till_today", "delay_in_settlement", "count"]
    return reduce(DataFrame.unionByName, [back[title].toDF(*names).withColumn("report", F.lit(title)) for title in _TITLES.values()])


def _placed(rows: DataFrame, first: list, name: str) -> DataFrame:
    """Rows read from files with their place in the order of the files."""
    spots = {"__file": F.col("_metadata.file_name"), "__block": F.col("_metadata.file_block_start"), "__row": F.monotonically_increasing_id()}
    spotted = rows.select("*", *[c.alias(n) for n, c in spots.items()])
    return sinks.with_row_number(spotted, [*first, *spots], name).drop(*spots)


@query("e2_order_of_rows", "select row_number() over (order by c_acctbal desc, c_custkey) - 1 as place, c_custkey from customer")
def _(t):
    frame = t["customer"].select("c_custkey", "c_acctbal")
    sinks.write_csv(frame, folder := _folder(frame), [F.desc("c_acctbal"), "c_custkey"])
    return _placed(_read_csv(frame, folder), [], "place").select("place", "c_custkey")


@query(
    "e6_order_per_lender",
    f"""select lender_id, request_id, row_number() over (partition by lender_id order by request_id) - 1 as place
        from (select distinct lender_id, request_id from ({COLLECTED}))""",
)
def _(t):
    """A first write of everything, then the lenders of a part of the rows are replaced by whole ones; the others stay."""
    frame = daily.foreclosure_collections(t, AS_OF).select("lender_id", "request_id").distinct()
    folder = _folder(frame)
    sinks.write_per_lender(frame, folder, order=["request_id"])
    sinks.write_per_lender(frame.filter("lender_id = 'Alpha'"), folder, order=["request_id"], keep_others=True)
    placed = _placed(_read_csv(frame, folder), ["lender_id"], "at")
    first = placed.groupBy("lender_id").agg(F.min("at").alias("first"))
    both = placed.join(first.withColumnRenamed("lender_id", "l"), F.col("lender_id").eqNullSafe(F.col("l")))
    return both.select("lender_id", "request_id", (F.col("at") - F.col("first")).alias("place"))


_PAGE = """'{"tickets": [{"id": ' || conv_id || ', "via": {"channel": "' || coalesce(role, '-') || '", "source": {"rank": ' || turn || '}}, "odd name": null}]}'"""


@query(
    "a3_tickets_of_any_fields",
    """select conv_id as page, 0 as position, conv_id as id, role as "via.channel", turn as "via.source.rank", cast(null as varchar) as "odd name"
       from conversations""",
)
def _(t):
    """Fields that no schema names become columns, nested ones too."""
    pages = t["conversations"].select(F.col("conv_id").alias("page"), F.expr(_PAGE).alias("text"))
    return flatten(parse_pages(pages, "text", "page", schema=None))


@query(
    "e5_page_limit",
    "select conv_id + 1 as page, turn as id, role as status, text as subject from conversations where conv_id + 1 <= 10",
)
def _(t):
    """Landed page files, a conversation each; the first ten are read."""
    ticket = F.struct(F.col("turn").alias("id"), F.col("role").alias("status"), F.col("text").alias("subject"))
    page = t["conversations"].groupBy((F.col("conv_id") + 1).alias("page")).agg(F.collect_list(ticket).alias("tickets"))
    folder = _folder(page)
    page.write.partitionBy("page").json(folder)
    rows = read_ticket_pages(page.sparkSession, folder, max_pages=10, page_number=r"page=(\d+)/")
    return rows.select(F.col("page").cast("long").alias("page"), "id", "status", "subject")


@query(
    "a3_ticket_pages",
    """select conv_id * 100 + turn as id, role as status, text as subject, role || ',chat' as tags, upper(role) as stage, 0 as position
       from conversations union all
       select -(conv_id * 100 + turn), null, null, null, null, 1 from conversations""",
)
def _(t):
    """One page document of two tickets for each message, as JSON text."""
    full = F.struct(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
        F.col("role").alias("status"),
        F.col("text").alias("subject"),
        F.array(F.col("role"), F.lit("chat")).alias("tags"),
        F.array(F.struct(F.lit(2).alias("id"), F.upper("role").alias("value"))).alias("custom_fields"),
    )
    bare = F.struct((-(F.col("conv_id") * 100 + F.col("turn"))).alias("id"))
    page = F.concat(F.lit('{"tickets": ['), F.to_json(full), F.lit(", "), F.to_json(bare), F.lit('], "links": {"next": null}}'))
    pages = t["conversations"].select(F.col("conv_id").alias("page"), page.alias("text"))
    rows = parse_pages(pages, "text", "page")
    shown = tickets.tickets(rows, {2: "stage"}, display=False, keep=["position"])
    return shown.select("id", "status", "subject", F.concat_ws(",", "tags").alias("tags"), "stage", "position").withColumn(
        "tags", F.nullif("tags", F.lit(""))
    )
