"""Quote-shaped views over the test tables.

The tables hold no option data. Each view is one SQL text used by Spark and by
the checking engine; only the marked tokens differ.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenorline.schema import as_utc_instants
from tenorline.session import prepare

MONDAY = {
    "spark": "trunc(cast({0} as date), 'week')",
    "ansi": "cast(date_trunc('week', {0}) as date)",
}
WEEKS = {
    "spark": "(datediff(trunc(cast({0} as date), 'week'), date '1994-12-26') div 7)",
    "ansi": "(date_diff('day', date '1994-12-26', cast(date_trunc('week', {0}) as date)) // 7)",
}
ADD_DTE = {"spark": "date_add(dt, dte)", "ansi": "dt + cast(dte as int)"}

STOCK_QUOTES = """
select d as dt, concat('U', u) as ticker,
       min_by(px, o_orderkey) as open, max(px) as high, min(px) as low,
       max_by(px, o_orderkey) as close, count(*) as volume,
       case (w + u) % 3 when 0 then null when 1 then false else true end as fetched
from (select @MONDAY(o_orderdate) as d, o_custkey % 5 as u, o_orderkey,
             @WEEKS(o_orderdate) as w,
             400 + (cast(round(o_totalprice * 100) as bigint) % 2000) / 100.0e0 as px
      from orders) x
group by d, u, w
"""

OPTION_QUOTES = """
select ((w * 5 + u) * 2 + (case when option_type = 'put' then 1 else 0 end)) * 128
         + k * 32 + dte as id,
       dt, concat('U', u, '-', option_type, '-', cast(400 + 5 * k as varchar(9)), '-',
                  cast(w * 7 + dte as varchar(9))) as ticker,
       concat('U', u) as underlying_ticker, option_type, 400 + 5 * k as strike, dte,
       @ADD_DTE as exp_date, volume,
       case (w + u) % 3 when 0 then null when 1 then false else true end as fetched,
       round(4 + dte / 10.0e0 + 10 * disc, 2) as close,
       round(0.10e0 + 3 * disc, 4) as iv,
       (case when option_type = 'put' then -1 else 1 end)
         * (5 + (k * 7 + dte * 3 + w) % 90) / 100.0e0 as delta,
       -(20 + (w * 13 + dte) % 100) / 1.0e0 as theta
from (select @MONDAY(l_shipdate) as dt, @WEEKS(l_shipdate) as w,
             l_suppkey % 5 as u,
             case when l_returnflag = 'R' then 'put' else 'call' end as option_type,
             l_partkey % 4 as k,
             case l_linenumber when 1 then 3 when 2 then 4 when 3 then 7 when 4 then 10
                               when 5 then 11 when 6 then 14 else 17 end as dte,
             min(l_discount) as disc, count(*) as volume
      from lineitem group by 1, 2, 3, 4, 5, 6) x
"""

RAW_SAMPLES = """
select event_id, ts as sample_ts, event_type as underlying,
       concat(upper(event_type), '_', lpad(cast(month(ts) as varchar(2)), 2, '0'),
              lpad(cast(day(ts) as varchar(2)), 2, '0'), '24',
              case when user_id % 2 = 0 then 'C' else 'P' end,
              cast(400 + 5 * (user_id % 4) as varchar(9))) as symbol,
       value as bid, case when event_id % 7 = 0 then null else value + 0.5 end as ask
from events
"""

CONTRACTS = """
select ticker, underlying_ticker, option_type, strike, exp_date, min(dt) as listed
from option_quotes group by 1, 2, 3, 4, 5
"""

# Three samples a day of each quote: before, inside and late in the last hour.
OPTION_SAMPLES = """
select q.dt as day, q.underlying_ticker as underlying,
       concat(q.underlying_ticker, '_', lpad(cast(month(q.exp_date) as varchar(2)), 2, '0'),
              lpad(cast(day(q.exp_date) as varchar(2)), 2, '0'),
              lpad(cast(year(q.exp_date) % 100 as varchar(2)), 2, '0'),
              case when q.option_type = 'put' then 'P' else 'C' end,
              cast(q.strike as varchar(9))) as symbol,
       case when h.n = 3 and q.id % 5 = 0 then null else q.close + h.n / 4.0e0 end as ask,
       q.close - h.n / 4.0e0 as bid, q.delta, q.theta,
       q.iv * 100 + h.n as volatility, q.dte as "daysToExpiration",
       @EPOCH_DAYS(q.exp_date) * 86400000 + 75600000 as "expirationDate",
       @EPOCH_DAYS(q.exp_date) * 86400000 + 72000000 as "lastTradingDay",
       @EPOCH_DAYS(q.dt) * 86400000 + h.ms - 2000 as "quoteTimeInLong",
       @EPOCH_DAYS(q.dt) * 86400000 + h.ms - 5000 as "tradeTimeInLong",
       @EPOCH_DAYS(q.dt) * 86400000 + h.ms as "sampleTimeInLong"
from (select *, @SAMPLES as h from option_quotes) q
"""

EPOCH_DAYS = {
    "spark": "cast(unix_date({0}) as bigint)",
    "ansi": "cast(date_diff('day', date '1970-01-01', {0}) as bigint)",
}

SAMPLES = {
    "spark": "explode(array(named_struct('n', 1, 'ms', 70200000), "
             "named_struct('n', 2, 'ms', 72900000), named_struct('n', 3, 'ms', 74700000)))",
    "ansi": "unnest([{'n': 1, 'ms': 70200000}, {'n': 2, 'ms': 72900000}, "
            "{'n': 3, 'ms': 74700000}])",
}

VIEWS = {
    "stock_quotes": STOCK_QUOTES,
    "option_quotes": OPTION_QUOTES,
    "raw_samples": RAW_SAMPLES,
    "contracts": CONTRACTS,
    "option_samples": OPTION_SAMPLES,
}


def view_sql(name: str, engine: str) -> str:
    text = VIEWS[name]
    for token, form in (("@MONDAY", MONDAY), ("@WEEKS", WEEKS), ("@EPOCH_DAYS", EPOCH_DAYS)):
        text = re.sub(token + r"\(([\w.]+)\)", lambda m: form[engine].format(m.group(1)), text)
    text = text.replace("@ADD_DTE", ADD_DTE[engine]).replace("@SAMPLES", SAMPLES[engine])
    return text.replace('"', "`") if engine == "spark" else text


def ansi_with(body: str) -> str:
    """Puts the views a checking query uses in front of it."""
    body = body.strip()
    used: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in used and re.search(rf"\b{name}\b", text):
                need(VIEWS[name])
                if name not in used:
                    used.append(name)

    need(body)
    ctes = ",\n".join(f"{n} as ({view_sql(n, 'ansi').strip()})" for n in used)
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


class Tables:
    """Lazy access to the tables and views of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return as_utc_instants(self.spark.read.parquet(self.path(name)))

    def _view(self, name: str, **inputs: DataFrame) -> DataFrame:
        text = view_sql(name, "spark")
        for source in inputs:
            text = re.sub(rf"\b(from|join) {source}\b", rf"\1 {{{source}}}", text)
        return self.spark.sql(text, **inputs)

    @cached_property
    def stock_days(self) -> DataFrame:
        """stock_quotes with ``dt`` as a date."""
        return self._view("stock_quotes", orders=self.table("orders"))

    @cached_property
    def stock_quotes(self) -> DataFrame:
        """stock_quotes with ``dt`` as an instant (midnight UTC)."""
        return self.stock_days.withColumn("dt", F.col("dt").cast("timestamp"))

    @cached_property
    def option_days(self) -> DataFrame:
        return self._view("option_quotes", lineitem=self.table("lineitem"))

    @cached_property
    def option_quotes(self) -> DataFrame:
        return self.option_days.withColumn("dt", F.col("dt").cast("timestamp"))

    @cached_property
    def raw_samples(self) -> DataFrame:
        return self._view("raw_samples", events=self.table("events"))

    @cached_property
    def contracts(self) -> DataFrame:
        return self._view("contracts", option_quotes=self.option_days)

    @cached_property
    def option_samples(self) -> DataFrame:
        return self._view("option_samples", option_quotes=self.option_days)
