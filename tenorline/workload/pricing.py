"""Model prices, Greeks, implied volatility and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorline.functions import sql
from tenorline.functions.black_scholes import Terms, with_greeks, with_price, year_fraction
from tenorline.operators.enrich import add_implied_vol, enrich
from tenorline.operators.spot import attach_spot
from tenorline.workload.registry import query
from tenorline.workload.views import Tables

CDF_SQL = """
  (case when {x} >= 0 then 1 - {tail} else {tail} end)
"""


def cdf_sql(x: str) -> str:
    t = f"(1 / (1 + 0.2316419e0 * abs({x})))"
    poly = (f"({t} * (0.319381530e0 + {t} * (-0.356563782e0 + {t} * (1.781477937e0 + {t} * "
            f"(-1.821255978e0 + {t} * 1.330274429e0)))))")
    tail = f"(exp(-{x} * {x} / 2) / sqrt(2 * pi()) * {poly})"
    return CDF_SQL.format(x=x, tail=tail)


# Spot 0.0025 a year, 252 days to the year; sigma comes from the quote.
MODEL_SQL = f"""
priced as (
  select q.id, q.option_type, q.close, cast(q.strike as double) as k, s.close as s,
         q.dte / 252.0e0 as t, q.iv as v
  from option_quotes q join stock_quotes s on s.dt = q.dt and s.ticker = q.underlying_ticker),
d as (
  select *, (ln(s / k) + (0.0025e0 + v * v / 2) * t) / (v * sqrt(t)) as d1,
         (ln(s / k) + (0.0025e0 - v * v / 2) * t) / (v * sqrt(t)) as d2,
         k * exp(-0.0025e0 * t) as kdf
  from priced),
n as (
  select *, {cdf_sql("d1")} as n1, {cdf_sql("d2")} as n2,
         exp(-d1 * d1 / 2) / sqrt(2 * pi()) as pdf1
  from d)
"""


def with_spot(t: Tables):
    joined = attach_spot(t.option_quotes, t.stock_quotes).filter(F.col("spot").isNotNull())
    return joined.withColumn("years", year_fraction(F.col("dte")))


@query("greeks", f"""
with {MODEL_SQL}
select id, round(case when option_type = 'put' then n1 - 1 else n1 end, 4) + 0.0e0 as delta,
       round(pdf1 / (s * v * sqrt(t)), 4) + 0.0e0 as gamma,
       round(s * pdf1 * sqrt(t), 4) + 0.0e0 as vega,
       round(-s * pdf1 * v / (2 * sqrt(t))
             + 0.0025e0 * kdf * (case when option_type = 'put' then 1 - n2 else -n2 end), 4)
         + 0.0e0 as theta
from n
""")
def greeks(t: Tables):
    names = ("delta", "gamma", "vega", "theta")
    out = with_greeks(with_spot(t).drop("delta", "theta"), Terms())
    return out.select("id", *[(F.round(c, 4) + 0.0).alias(c) for c in names])


@query("model_price", f"""
with {MODEL_SQL}
select id, round(s * n1 - kdf * n2 - case when option_type = 'put' then s - kdf else 0 end, 4)
         + 0.0e0 as model_price
from n
""")
def model_price(t: Tables):
    return with_price(with_spot(t), Terms()).select(
        "id", (F.round("model_price", 4) + 0.0).alias("model_price"))


# A volatility comes back from its price unless the price hardly depends on it.
TOLD_SQL = """
price_of as (
  select *, s * n1 - kdf * n2 - case when option_type = 'put' then s - kdf else 0 end as price,
         s * pdf1 * sqrt(t) as m_vega
  from n),
told as (
  select *, price > 0 and price > case when option_type = 'put' then kdf - s else s - kdf end
            and 7.5e-8 * (s + kdf) / m_vega <= 1e-3 as told
  from price_of)
"""


def at_model_price(t: Tables):
    return with_price(with_spot(t), Terms(), name="close")


@query("implied_vol", f"""
with {MODEL_SQL}, {TOLD_SQL}
select id, round(case when told then v end, 4) as iv from told
""")
def implied_vol_round_trip(t: Tables):
    """Every quote priced at its volatility, and the volatility inverted from that price."""
    return add_implied_vol(at_model_price(t).drop("iv")).select("id", F.round("iv", 4).alias("iv"))


@query("sql_implied_vol", f"""
with {MODEL_SQL}, {TOLD_SQL}
select id, round(case when told then v end, 4) as iv from told
""")
def sql_implied_vol(t: Tables):
    """The same inversion, called from SQL text."""
    sql.register(t.spark)
    quotes = at_model_price(t).select("id", "close", "spot", "strike", "years", "option_type")
    return t.spark.sql("""
        select id, round(implied_vol(double(close), double(spot), double(strike), double(years), option_type), 4) as iv
        from {quotes}""", quotes=quotes)


ENRICHED_SQL = f"""
with {MODEL_SQL}, {TOLD_SQL}
select q.id, cast(q.dt as timestamp) as dt, q.ticker, s.close as spot,
       round(case when coalesce(q.fetched, true) then coalesce(n.price, q.close) end, 6) as close,
       case when coalesce(q.fetched, true) then q.dte end as dte,
       case when coalesce(q.fetched, true) then cast(extract(isodow from q.exp_date) - 1 as int) end
         as exp_date_weekday,
       round(case when {{0}} then v end, 3) as iv,
       round(case when {{0}} then case when q.option_type = 'put' then n1 - 1 else n1 end end, 3)
         + 0.0e0 as delta,
       round(case when {{0}} then pdf1 / (n.s * v * sqrt(n.t)) end, 3) + 0.0e0 as gamma,
       round(case when {{0}} then m_vega end, 3) + 0.0e0 as vega,
       round(case when {{0}} then -n.s * pdf1 * v / (2 * sqrt(n.t))
         + 0.0025e0 * kdf * (case when q.option_type = 'put' then 1 - n2 else -n2 end) end, 3)
         + 0.0e0 as theta
from option_quotes q
left join stock_quotes s on s.dt = q.dt and s.ticker = q.underlying_ticker
left join told n on n.id = q.id
""".replace("{0}", "coalesce(q.fetched, true) and n.told")
ENRICHED_NULLABLE = {"dte": "double", "exp_date_weekday": "double"}


def quotes_at_model_price(t: Tables):
    """Those whose fetch failed have had no trade."""
    traded = F.coalesce(F.col("fetched"), F.lit(True))
    model = at_model_price(t).select("id", F.col("close").alias("_price"))
    return (
        t.option_quotes.join(model, "id", "left")
        .withColumn("close", F.when(traded, F.coalesce("_price", "close"))).drop("_price")
    )


def rounded(enriched: DataFrame) -> DataFrame:
    """The columns that ``ENRICHED_SQL`` gives."""
    values = [F.round("iv", 3).alias("iv")] + [
        (F.round(c, 3) + 0.0).alias(c) for c in ("delta", "gamma", "vega", "theta")]
    return enriched.select("id", "dt", "ticker", "spot", F.round("close", 6).alias("close"), "dte",
                           "exp_date_weekday", *values)


@query("enrich_quotes", ENRICHED_SQL, nullable=ENRICHED_NULLABLE)
def enrich_quotes(t: Tables):
    return rounded(enrich(quotes_at_model_price(t), t.stock_quotes))
