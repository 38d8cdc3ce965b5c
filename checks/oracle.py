"""SQL that states each query's result over the driver's tables.

Shared steps are named once in STEPS; a query's text gets the steps it names,
directly or through other steps, as common table expressions. Steps ending in
_l build on lineitem, steps ending in _e on events.
"""

from __future__ import annotations

import re

from checks import projection as P
from marketmill import schemas as S

#: White space around a text, of any script, and separators: the pattern as the rules state it.
OUTER_SPACE = r"^[\s\x0b\x1c-\x1f\x85\p{Z}]+|[\s\x0b\x1c-\x1f\x85\p{Z}]+$"

# First days of the named ranges, counted back by hand from 2001-06-30.
RANGES_ON_2001_06_30 = {
    "1D": "2001-06-29",
    "5D": "2001-06-25",
    "1M": "2001-05-31",
    "6M": "2000-12-30",
    "YTD": "2001-01-01",
    "1Y": "2000-06-30",
    "5Y": "1996-07-01",
    "ALL": "2024-07-01",
}


def _f2(x: str) -> str:
    return f"format('{{:,.2f}}', {x})"


def _f0(x: str) -> str:
    return f"format('{{:,}}', {x})"


def _plain(x: str) -> str:
    return f"trim(replace({x}, ',', ''))"


def dbl(x: str) -> str:
    return f"case when regexp_full_match({_plain(x)}, '[+-]?\\d+\\.?\\d*') then try_cast({_plain(x)} as double) end"


def lng(x: str) -> str:
    return f"case when regexp_full_match({_plain(x)}, '[+-]?\\d+') then try_cast({_plain(x)} as bigint) end"


def r4(x: str, name: str | None = None) -> str:
    return f"round({x} + 1e-7, 4) as {name or x}"


def _market(key: str) -> str:
    return P.MARKET.replace("l_suppkey", key)


LONGS_A = {"trade_volume", "transaction_count", "trade_value", "last_bid_volume", "last_ask_volume"}
LONGS_B = LONGS_A | {"issued_shares"}
DOUBLES_A = {
    "open_price", "high_price", "low_price", "close_price", "last_bid_price", "last_ask_price", "pe_ratio", "change_amount",
}
DOUBLES_B = {
    "close_price", "open_price", "high_price", "low_price", "average_price", "last_bid_price", "last_ask_price",
    "next_day_reference_price", "next_day_limit_up", "next_day_limit_down",
}
A, B = S.RAW_ROW_A.names, S.RAW_ROW_B.names
QUOTES = S.names(S.QUOTES)
STAGED = [
    "trade_date", "stock_id", "stock_name", "market", "open_price", "high_price", "low_price", "close_price",
    "average_price", "trade_volume", "trade_value", "transaction_count", "change_amount", "pe_ratio", "issued_shares",
]
FACT_KEYS = [
    "trade_date", "stock_id", "market", "open_price", "high_price", "low_price", "close_price", "average_price",
    "trade_volume", "trade_value", "transaction_count", "change_amount",
]
STEPS: dict[str, str] = {
    "trades_l": "select * from lineitem",
    "trades_e": P.EVENT_TRADES,
}


def _typed(names, longs, doubles) -> str:
    return ", ".join(f"{lng(n)} as {n}" if n in longs else f"{dbl(n)} as {n}" if n in doubles else n for n in names)


def _row(expressions, names) -> str:
    return ", ".join(f"{e} as {n}" for e, n in zip(expressions, names, strict=True))


def _contract(**given: str) -> str:
    return ", ".join(
        f"cast({given[n] if n in given else 'null'} as {t}) as {n}" for n, t in S.fields(S.QUOTES)
    )


def _as_is(names, **over: str) -> dict[str, str]:
    return {n: n for n in QUOTES if n in names} | over


for f in ("l", "e"):
    trade_order = "l_orderkey, l_linenumber, l_extendedprice"
    keep = "cast(cast(l_shipdate as date) as varchar) as dt, l_orderkey, l_linenumber, l_suppkey"
    for side, row, names, longs, doubles in (
        ("a", P.raw_row_a(_f2, _f0), A, LONGS_A, DOUBLES_A),
        ("b", P.raw_row_b(_f2, _f0), B, LONGS_B, DOUBLES_B),
    ):
        STEPS[f"raw_{side}_{f}"] = f"select {keep}, {_row(row, names)} from trades_{f}"
        cut = ", ".join([*names[:10], *(f"null as {n}" for n in names[10:])])
        STEPS[f"flat_{side}_{f}"] = (
            f"select dt, l_suppkey, l_orderkey, {', '.join(names)} from raw_{side}_{f} where l_orderkey % 23 <> 0 "
            f"union all select dt, l_suppkey, l_orderkey, {cut} from raw_{side}_{f} where l_orderkey % 23 <> 0 and l_linenumber = 6"
        )
        for src in ("raw", "flat"):
            tag = "" if src == "raw" else "flat_"
            extra = (
                ", trim(regexp_extract(change_symbol_raw, '<p[^>]*>(.*?)</p>', 1)) as change_direction"
                if side == "a" else f", {dbl('change_symbol_raw')} as change_amount"
            )
            STEPS[f"typed_{tag}{side}_{f}"] = f"select dt, l_suppkey, {_typed(names, longs, doubles)}{extra} from {src}_{side}_{f}"
            if side == "a":
                STEPS[f"clean_{tag}a_{f}"] = (
                    "select *, case when change_direction = '-' then -change_amount when change_direction = 'X' then null "
                    f"else change_amount end as signed_change_amount from typed_{tag}a_{f}"
                )
                given = _as_is(A, dt="dt", market=f"'{S.MARKET_A}'", change_amount="signed_change_amount")
            else:
                STEPS[f"clean_{tag}b_{f}"] = f"select * from typed_{tag}b_{f}"
                given = _as_is(B, dt="dt", market=f"'{S.MARKET_B}'", change_amount="change_amount")
            STEPS[f"unified_{tag}{side}_{f}"] = f"select {_contract(**given)} from clean_{tag}{side}_{f}"
    STEPS[f"days_{f}"] = f"""
        select l_suppkey, cast(l_shipdate as date) as day,
            first(l_extendedprice order by {trade_order}) as open_price, last(l_extendedprice order by {trade_order}) as close_price,
            max(l_extendedprice) as high_price, min(l_extendedprice) as low_price,
            cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents,
            cast(sum(cast(round(l_extendedprice * l_quantity * 100) as bigint)) as bigint) as value_cents,
            cast(sum(l_quantity) as bigint) as trade_volume, count(*) as n, cast(min(l_quantity) as bigint) as min_qty,
            cast(max(l_quantity) as bigint) as max_qty, max(l_tax) as tax, max(l_partkey) as part
        from trades_{f} group by all"""
    STEPS[f"quotes_{f}"] = f"""
        select cast(day as varchar) as dt, cast(l_suppkey as varchar) as stock_id, 'Stock ' || cast(l_suppkey as varchar) as stock_name,
            {P.MARKET} as market, open_price, high_price, low_price, close_price,
            case when l_suppkey % 2 = 1 then ((2 * cents + n) // (2 * n)) / cast(100 as double) end as average_price, trade_volume,
            case when not (l_suppkey % 2 = 1 and day < date '1998-01-01') and not (l_suppkey % 10 = 1 and day < date '1998-07-01')
                then (value_cents + 50) // 100 end as trade_value,
            n as transaction_count, round(close_price - open_price, 2) as change_amount, low_price as last_bid_price,
            min_qty as last_bid_volume, high_price as last_ask_price, max_qty as last_ask_volume,
            case when l_suppkey % 2 = 0 then round(tax * 100, 2) end as pe_ratio,
            case when l_suppkey % 2 = 1 then part * 1000 end as issued_shares
        from days_{f}"""
    STEPS[f"bars_{f}"] = f"select cast(dt as date) as trade_date, {', '.join(STAGED[1:])} from quotes_{f}"
    hist = ", ".join(
        f"case when trade_volume % 11 = 0 then cast('nan' as double) else {c}_price / 3 end as {c}" for c in ("open", "high", "low", "close")
    )
    STEPS[f"history_{f}"] = f"select stock_id, market, dt as trade_date, {hist}, trade_volume as volume from quotes_{f}"
    fixed = ", ".join(f"round(case when not isnan({c}) then {c} end, 2) as {c}" for c in ("open", "high", "low", "close"))
    STEPS[f"clean_history_{f}"] = f"select stock_id, market, trade_date, {fixed}, volume from history_{f}"
    given = dict(
        dt="trade_date", stock_id="stock_id", market="market", open_price="open", high_price="high", low_price="low",
        close_price="close", trade_volume="volume",
    )
    STEPS[f"unified_history_{f}"] = f"select {_contract(**given)} from clean_history_{f}"
    STEPS[f"prev_{f}"] = (
        f"select *, lag(close_price) over (partition by stock_id order by trade_date) as prior_close from bars_{f}"
    )
    STEPS[f"change_{f}"] = (
        "select *, greatest(close_price - prior_close, 0.0) as gain, greatest(prior_close - close_price, 0.0) as loss "
        f"from prev_{f}"
    )

    def _avg(col: str, back: int) -> str:
        return f"avg(cast({col} as double)) over (partition by stock_id order by trade_date rows between {back} preceding and current row)"

    STEPS[f"means_{f}"] = (
        f"select *, {_avg('close_price', 4)} as ma5, {_avg('close_price', 19)} as ma20, {_avg('gain', 13)} as mean_gain, "
        f"{_avg('loss', 13)} as mean_loss from change_{f}"
    )
    STEPS[f"fact_{f}"] = (
        f"select {', '.join(FACT_KEYS)}, ma5, ma20, case when mean_loss = 0 then 100.0 "
        f"else 100 * mean_gain / (mean_gain + mean_loss) end as rsi14 from means_{f}"
    )
    STEPS[f"weighed_{f}"] = (
        "select *, coalesce(trade_value, trade_volume) as weight_basis, case when trade_value is not null then 'trade_value' "
        f"else 'trade_volume' end as weighting_method from bars_{f}"
    )
    STEPS[f"idaily_{f}"] = f"""
        select w.trade_date, u.industry_code, w.market, cast(sum(weight_basis) as bigint) as total_weight_basis,
            sum(close_price * weight_basis) / cast(sum(weight_basis) as double) as weighted_avg_price,
            count(distinct w.stock_id) as stock_count,
            case min(weighting_method) when max(weighting_method) then min(weighting_method) else 'mixed' end as weighting_method
        from weighed_{f} w join universe u on w.stock_id = u.stock_id
        where weight_basis > 0 and close_price is not null group by all"""
    STEPS[f"paired_{f}"] = f"""
        select *, lag(weighted_avg_price) over series as prior_price, lag(weighting_method) over series as prior_method
        from idaily_{f} window series as (partition by industry_code, market order by trade_date)"""
    STEPS[f"ifact_{f}"] = f"""
        select trade_date, industry_code, industry_name, market, total_weight_basis, weighted_avg_price, stock_count, weighting_method,
            case when prior_method = weighting_method and prior_price <> 0
                then round((weighted_avg_price - prior_price) / prior_price * 100, 2) + 0.0 end as daily_return_pct
        from paired_{f} left join dim_industry using (industry_code)"""
    STEPS[f"obt_{f}"] = f"""
        select f.trade_date, f.stock_id, s.company_name, s.stock_name, f.market, s.industry_code, i.industry_name, f.open_price,
            f.high_price, f.low_price, f.close_price, f.trade_volume, f.trade_value, f.change_amount, f.ma5, f.ma20, f.rsi14,
            p.weighted_avg_price as industry_weighted_price, m.fear_greed_score, m.fear_greed_rating
        from fact_{f} f left join universe s on f.stock_id = s.stock_id left join dim_industry i on s.industry_code = i.industry_code
        left join ifact_{f} p on f.trade_date = p.trade_date and s.industry_code = p.industry_code and f.market = p.market
        left join sentiment m on f.trade_date = m.index_date"""
    STEPS[f"actual_{f}"] = f"select market, cast(dt as date) as dt, count(distinct stock_id) as actual_count from quotes_{f} group by all"
    STEPS[f"expected_{f}"] = f"""
        select d.market, d.dt, (select count(*) from universe u where u.market = d.market and u.listing_date <= d.dt) as expected_count
        from actual_{f} d"""
    STEPS[f"absent_{f}"] = f"""
        select d.market, d.dt, u.stock_id, u.company_name from actual_{f} d join universe u
            on u.market = d.market and u.listing_date <= d.dt
        where not exists (select 1 from quotes_{f} q where q.market = d.market and cast(q.dt as date) = d.dt and q.stock_id = u.stock_id)"""

STEPS |= {
    "universe": f"""
        select cast(s_suppkey as varchar) as stock_id, s_name as company_name, 'Stock ' || cast(s_suppkey as varchar) as stock_name,
            lpad(cast(s_nationkey % 5 + 1 as varchar), 2, '0') as industry_code,
            cast(date '1995-01-01' + cast(s_suppkey % 700 as integer) as date) as listing_date, {_market('s_suppkey')} as market
        from supplier""",
    "official": f"select cast(s_suppkey as varchar) as stock_id, {_market('s_suppkey')} as market from supplier where s_acctbal >= 0",
    "raw_list": f"""
        select s_suppkey, s_name, {_market('s_suppkey')} as market, t.dt,
            case when t.dt = '2001-06-01' then lpad(cast(s_nationkey % 5 + 1 as varchar), 2, '0') else '99' end as code,
            case when s_suppkey % 11 = 3 then '20260231' when s_suppkey % 11 = 4 then ''
                else strftime(date '1995-01-01' + cast(s_suppkey % 700 as integer), '%Y%m%d') end as listed
        from supplier, (values ('2001-01-01'), ('2001-06-01')) t(dt)""",
    "clean_list": """
        select cast(s_suppkey as varchar) as stock_id, s_name as company_name, 'Stock ' || cast(s_suppkey as varchar) as stock_name,
            code as industry_code, cast(try_strptime(nullif(listed, ''), '%Y%m%d') as date) as listing_date, market, dt from raw_list""",
    "seed": "select lpad(cast(r_regionkey + 2 as varchar), 2, '0') as industry_code, r_name as industry_name from region",
    "dim_industry": """
        select distinct u.industry_code, s.industry_name from universe u left join seed s on u.industry_code = s.industry_code
        where u.industry_code is not null""",
    "sentiment_days": "select cast(ts as date) as day, cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents, count(*) as n from events group by all",
    "scores": f"select cast(day - {P.DAY_SHIFT} as varchar) as dt, ((2 * cents + n) // (2 * n)) / cast(100 as double) as score from sentiment_days",
    "clean_sentiment": f"select dt, score, {P.RATING.format('score')} as fear_greed_rating from scores",
    "sentiment": "select cast(dt as date) as index_date, score as fear_greed_score, fear_greed_rating from clean_sentiment",
    "records": f"""
        select cast(epoch_us(ts) // 1000 - cast({P.DAY_SHIFT} as bigint) * 86400000 as double) as x, value as y,
            {P.RATING.format('value')} as rating, ts from events""",
    "per_day": f"""
        select cast(cast(ts as date) - {P.DAY_SHIFT} as varchar) as dt, round(last(y order by x, y, rating), 2) as score,
            last(rating order by x, y, rating) as fear_greed_rating from records group by 1""",
    "nested_records": "select x, y, rating from records union all select x + 3600000, y, rating from records",
    "nested_per_day": """
        select cast(cast(epoch_ms(cast(x as bigint)) as date) as varchar) as dt, round(last(y order by x, y, rating), 2) as score,
            last(rating order by x, y, rating) as fear_greed_rating from nested_records group by 1""",
    "run_log": """
        select ts as run_timestamp, 'dag_' || cast(user_id % 3 as varchar) as dag_id, event_type as task_id,
            case when value > 100 then 'failed' else 'success' end as status, value as duration_seconds
        from events where ts >= timestamp '2024-01-31 00:00:00' - interval 30 day""",
    "run_summary": """
        select dag_id, task_id, count(*) as total_runs, count(*) filter (status = 'success') as success_runs,
            round(count(*) filter (status = 'success') / count(*) * 100, 1) as success_rate_pct,
            round(avg(duration_seconds), 1) as avg_duration_sec from run_log group by all""",
    "pages_plain": f"""
        select *, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '{OUTER_SPACE}', '', 'g') as plain from pages""",
    "page_codes": """
        select page_id, 1 as part, cast(page_id % 7 as varchar) as code from pages
        union all select page_id, 2, cast(page_id % 9 as varchar) from pages
        union all select page_id, 3, 'X' from pages where page_id % 2 = 0""",
    "feed": f"""
        select case when page_id % 3 = 0 then md5(trim(url)) else cast(page_id as varchar) end as article_id,
            trim(url) as title, 'page ' || cast(page_id as varchar) as summary, plain as content, length(plain) as plain_chars, url, page_id as position,
            case when page_id % 5 = 0 then '2024-02-01' else strftime(make_timestamp((1700000000 + page_id * 60) * 1000000), '%Y-%m-%dT%H:%M:%SZ') end as published_at,
            case when page_id % 4 > 0 then 'c' || cast(page_id % 4 as varchar) else '' end as category, 'news,k' || cast(page_id % 4 as varchar) as keyword,
            (select string_agg(code, ',' order by first_part) from (select code, min(part) as first_part from page_codes c
                where c.page_id = p.page_id group by code)) as related_stocks,
            'feed' as source_name, '2024-02-01' as fetched_date, 0 as source_rank from pages_plain p where trim(url) <> ''""",
    "vendor_rows": """
        select url as title, null as summary, url, page_id as position, 1600000000 + page_id as epoch, cast(page_id as varchar) as symbol from pages
        union all select text, text, 'doc/' || source || '/' || case when doc_id % 10 = 0 then lang else cast(doc_id as varchar) end, doc_id, 1500000000 + doc_id, source from documents""",
    "vendor": f"""
        select md5(url) as article_id, regexp_replace(title, '{OUTER_SPACE}', '', 'g') as title,
            coalesce(regexp_replace(summary, '{OUTER_SPACE}', '', 'g'), '') as summary, '' as content, 0 as plain_chars, url, position,
            strftime(make_timestamp(epoch * 1000000), '%Y-%m-%dT%H:%M:%SZ') as published_at, 'tw_stock' as category, '' as keyword, symbol as related_stocks,
            'vendor' as source_name, '2024-02-01' as fetched_date, 1 as source_rank from vendor_rows where regexp_replace(title, '{OUTER_SPACE}', '', 'g') <> '' and url <> ''""",
    "articles": """
        select * exclude (source_rank, position, rn) from (select *, row_number() over (partition by article_id order by source_rank, position) as rn
            from (select * from feed union all select * from vendor)) where rn = 1""",
    "attempts": """
        select cast(o_orderdate as date) as dt, o_orderkey % 4 + 1 as attempt, o_orderstatus <> 'P' as http_ok,
            o_orderpriority like '1%' as retryable, o_orderstatus = 'F' as is_ok, 7 + o_custkey % 4 as n_tables,
            cast(trunc(o_totalprice / 100) as integer) as n_rows from orders""",
    "attempt_kinds": """
        select dt, attempt, attempt <= 3 and http_ok and not is_ok as is_empty,
            case when attempt > 3 then null when (not http_ok and not retryable) or (http_ok and is_ok and (n_tables < 9 or n_rows < 1105)) then 'unknown_failure'
                 when http_ok and is_ok then 'success' end as decision from attempts""",
    "history_mode": """
        select dt, coalesce((select case when min(k.attempt) is null then null
                 when bool_or(k.decision = 'unknown_failure') filter (k.attempt = m.first_at) then 'unknown_failure' else 'success' end
                 from attempt_kinds k where k.dt = m.dt and k.decision is not null), 'unknown_failure') as decided, first_at, second_empty
        from (select d.dt, (select min(attempt) from attempt_kinds k where k.dt = d.dt and decision is not null) as first_at,
                (select min(attempt) from attempt_kinds k where k.dt = d.dt and is_empty
                   and attempt > (select min(attempt) from attempt_kinds j where j.dt = d.dt and is_empty)) as second_empty
              from (select distinct dt from attempts) d) m""",
    "daily_kinds": """
        select dt, attempt, case when is_empty then 'unknown_failure' else decision end as decision from attempt_kinds""",
}

for f in ("l", "e"):
    for side, market in (("a", S.MARKET_A), ("b", S.MARKET_B)):
        for tag in ("", "flat_"):
            STEPS[f"listed_{tag}{side}_{f}"] = (
                f"select q.* from unified_{tag}{side}_{f} q where {_market('cast(stock_id as bigint)')} = '{market}' "
                f"and stock_id in (select stock_id from official where market = '{market}')"
            )

_QUOTE_LIST = ", ".join(QUOTES)
_FACT = f"{', '.join(FACT_KEYS)}, {r4('ma5')}, {r4('ma20')}, {r4('rsi14')}"
_IDAILY = f"trade_date, industry_code, market, total_weight_basis, {r4('weighted_avg_price')}, stock_count, weighting_method"
_OBT = (
    "trade_date, stock_id, company_name, stock_name, market, industry_code, industry_name, open_price, high_price, low_price, "
    f"close_price, trade_volume, trade_value, change_amount, {r4('ma5')}, {r4('ma20')}, {r4('rsi14')}, "
    f"{r4('industry_weighted_price')}, fear_greed_score, fear_greed_rating"
)
# Dashboards and gates read stored marts, which are those of the events.
_RANKED = """from ifact_e where market = 'TWSE' and daily_return_pct is not null and industry_name is not null
    and trade_date = (select max(trade_date) from ifact_e where market = 'TWSE')"""
_CALENDAR = """cast({0} as date) as calendar_date, cast(year({0}) as integer) as year, cast(month({0}) as integer) as month,
    cast(day({0}) as integer) as day, cast(dayofweek({0}) + 1 as integer) as day_of_week, dayname({0}) as day_name,
    dayofweek({0}) in (0, 6) as is_weekend"""
_SPINE = "(select unnest(generate_series(min(trade_date), max(trade_date), interval 1 day)) as d from bars_l)"
_GAPS = """select a.market, a.dt, a.actual_count, e.expected_count, e.expected_count - a.actual_count as gap
    from actual_l a join expected_l e on a.market = e.market and a.dt = e.dt"""


def _completeness(market: str, official_only: bool) -> str:
    off = f"(select distinct stock_id from official where market = '{market}')"
    member = f" and q.stock_id in {off}" if official_only else ""
    return f"""
        with wanted as (select cast(unnest(generate_series(date '1998-06-10', date '1998-07-20', interval 1 day)) as date) as dt),
        q as (select cast(dt as date) as dt, stock_id from quotes_e where market = '{market}'),
        judged as (select w.dt, exists (select 1 from q where q.dt = w.dt) as landed,
            (select count(distinct q.stock_id) from q where q.dt = w.dt{member}) as present, (select count(*) from {off}) as official_count from wanted w),
        scored as (select *, present / official_count as ratio, not landed or present / official_count >= 0.95 as passed from judged),
        missing as (select s.dt, o.stock_id as missing_id from scored s join {off} o on not s.passed
            where not exists (select 1 from q where q.dt = s.dt and q.stock_id = o.stock_id))
        select dt, landed, present, official_count, {r4('ratio')}, passed, missing_id from scored left join missing using (dt)"""


def _gate(table: str, step: str, rules: list[tuple[str, str, str]]) -> list[str]:
    return [
        f"select '{table}' as table_name, '{rule}' as rule, '{column}' as column_name, (select count(*) from {step} where {fails}) as failing_rows"
        for rule, column, fails in rules
    ]


def _key_gate(table: str, step: str, column: str) -> str:
    present = " and ".join(f"{c} is not null" for c in column.split(","))
    return (
        f"select '{table}' as table_name, 'unique' as rule, '{column}' as column_name, (select count(*) from "
        f"(select {column} from {step} where {present} group by {column} having count(*) > 1)) as failing_rows"
    )


_TRADED = "(market = 'TWSE' or (market = 'TPEx' and trade_value is not null))"
_GATES = [
    *_gate("fact_stock_daily", "fact_e", [
        ("not_null", "stock_id", "stock_id is null"), ("not_null", "trade_date", "trade_date is null"),
        ("accepted_values", "market", "market not in ('TWSE', 'TPEx')"),
        *[("accepted_range", c, f"{c} < 0 or {c} > 100000") for c in ("close_price", "open_price", "high_price", "low_price")],
        ("accepted_range", "trade_volume", "trade_volume < 0"), ("accepted_range", "trade_value", "trade_value < 0"),
        ("accepted_range", "ma5", "ma5 <= 0"), ("accepted_range", "ma20", "ma20 <= 0"), ("accepted_range", "rsi14", "rsi14 < 0 or rsi14 > 100"),
        ("high_is_highest", "high_price", f"{_TRADED} and (high_price < open_price or high_price < low_price or high_price < close_price)"),
        ("low_is_lowest", "low_price", f"{_TRADED} and (low_price > open_price or low_price > high_price or low_price > close_price)"),
        ("not_future", "trade_date", f"trade_date > date '{P.TODAY}'"),
    ]),
    *_gate("fact_industry_price", "ifact_e", [
        ("not_null", "trade_date", "trade_date is null"), ("not_null", "industry_code", "industry_code is null"),
        ("accepted_values", "market", "market not in ('TWSE', 'TPEx')"), ("accepted_range", "weighted_avg_price", "weighted_avg_price <= 0"),
        ("accepted_range", "total_weight_basis", "total_weight_basis < 0"), ("accepted_range", "stock_count", "stock_count < 1"),
        ("accepted_values", "weighting_method", "weighting_method not in ('trade_value', 'trade_volume', 'mixed')"),
        ("no_mixed_method", "weighting_method", "weighting_method = 'mixed'"),
    ]),
    *_gate("fact_fear_greed", "sentiment", [
        ("not_null", "index_date", "index_date is null"), ("accepted_range", "fear_greed_score", "fear_greed_score < 0 or fear_greed_score > 100"),
        ("accepted_values", "fear_greed_rating", "fear_greed_rating not in ('extreme fear', 'fear', 'neutral', 'greed', 'extreme greed')"),
    ]),
    *_gate("dim_stock", "universe", [
        ("not_null", "stock_id", "stock_id is null"), ("accepted_values", "market", "market not in ('TWSE', 'TPEx')"),
        ("accepted_range", "listing_date", f"listing_date > date '{P.TODAY}'"),
    ]),
    *_gate("dim_date", f"{_SPINE.replace('bars_l', 'bars_e')} spine", [("not_null", "calendar_date", "d is null")]),
    *_gate("dim_industry", "dim_industry", [("not_null", "industry_code", "industry_code is null")]),
    _key_gate("fact_stock_daily", "fact_e", "stock_id,trade_date"), _key_gate("fact_fear_greed", "sentiment", "index_date"), _key_gate("dim_stock", "universe", "stock_id"),
    _key_gate("dim_date", f"(select d as calendar_date from {_SPINE.replace('bars_l', 'bars_e')}) spine", "calendar_date"),
    _key_gate("dim_industry", "dim_industry", "industry_code"),
    """select 'events' as table_name, 'freshness' as rule, 'loaded_at' as column_name,
        case when epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(max(ts)) > 48 * 3600000000 then 1 else 0 end as failing_rows from events""",
    "select 'never_loaded' as table_name, 'freshness' as rule, 'loaded_at' as column_name, 1 as failing_rows",
]

BODIES: dict[str, str] = {
    # scans and staging
    "scan_quotes_day": f"select dt, {', '.join(A)} from flat_a_e where dt = '1998-06-20' and l_suppkey % 2 = 0",
    "scan_quotes_history": f"select dt, {', '.join(A)} from flat_a_e where l_suppkey % 2 = 0",
    "scan_quotes_sound": f"select dt, {', '.join(A)} from (select f.*, {P.DAMAGE.replace('l_orderkey', 'f.l_orderkey')} as damage from flat_a_e f) where l_suppkey % 2 = 0 and damage = 'none'",
    "scan_quotes_rejects": f"""select dt, case damage when 'cut' then 'no JSON' else 'does not fit the schema' end as reason, 'unknown_failure' as status, cast(count(*) as bigint) as records
        from (select dt, l_suppkey, {P.DAMAGE} as damage from raw_a_e) where l_suppkey % 2 = 0 and damage <> 'none' group by all""",
    "backlog_set_aside": f"""select cast(d as date) as dt from (select unnest(generate_series(date '1998-06-01', date '1998-07-31', interval 1 day)) as d)
        where cast(d as date) not in (select cast(dt as date) from raw_a_e where l_suppkey % 2 = 0)
        or cast(d as date) in (select cast(dt as date) from (select dt, l_suppkey, {P.DAMAGE} as damage from raw_a_e) where l_suppkey % 2 = 0 and damage <> 'none')""",
    "scan_quotes_history_b": f"select dt, {', '.join(B)} from flat_b_e where l_suppkey % 2 <> 0",
    "scan_instrument_history": "select stock_id, market, trade_date, " + ", ".join(
        r4(f"case when not isnan({c}) then {c} end", c) for c in ("open", "high", "low", "close")) + ", volume from history_e",
    "scan_sentiment_nested": "select x, y, rating from nested_records",
    "scan_universe_latest": """select cast(s_suppkey as varchar) as stock_id, s_name as company_name, 'Stock ' || cast(s_suppkey as varchar) as stock_name,
        code as industry_code, listed as listing_date, dt from raw_list where dt = (select max(dt) from raw_list)""",
    "scan_clean_partitioned": "select dt, stock_id, close_price, trade_volume from quotes_e where market = 'TWSE'",
    "scan_seed_codes": "select industry_code, industry_name from seed",
    "stg_quotes": f"select {', '.join(STAGED)} from bars_l",
    "stg_sentiment": "select index_date, fear_greed_score, fear_greed_rating from sentiment",
    "fact_sentiment": "select index_date, fear_greed_score, fear_greed_rating from sentiment",
    "stg_universe": "select stock_id, company_name, stock_name, industry_code, listing_date, market from universe",
    # sinks
    "sink_replace_partition": "select dt, stock_id, case when dt < '1998-07-01' then -1.0 else close_price end as close_price from quotes_e",
    "sink_versions": "select dt, stock_id, case when dt < '1998-07-01' then -1.0 else close_price end as close_price from quotes_e where dt <> '1998-06-20'",
    "sink_backfill_union_once": f"""select {_QUOTE_LIST} from unified_a_e where {_market('cast(stock_id as bigint)')} = 'TWSE'
        union all select {_QUOTE_LIST} from unified_history_e where market = 'TPEx'""",
    "sink_snapshot": "select stock_id, company_name, stock_name, industry_code, listing_date, market from universe",
    "load_day_partition": "select dt, stock_id, case when dt = '1998-06-20' then close_price else -1.0 end as close_price from quotes_e",
    "presence_days": "select market, cast(dt as date) as dt, count(distinct stock_id) as actual_count from quotes_e group by all",
    "presence_months": "select market, cast(date_trunc('month', cast(dt as date)) as date) as month, count(distinct stock_id) as instruments from quotes_l group by all",
    "bucketed_tables": f"select {_FACT} from fact_l",
    "incremental_digests": """select cast(dt as date) as trade_date, cast(sum(n) as bigint) as n_rows, count(*) as n_keys, cast(count_if(n > 1) as bigint) as n_repeated
        from (select dt, stock_id, count(*) as n from quotes_e group by all) group by all""",
    "incremental_replace": f"select {_FACT} from fact_e",
    "materialize_table": f"select {_IDAILY} from idaily_e",
    "run_log_observed": """select cast(dt as date) as target_date, t.task || '.' || market as task_id, 'success' as status, count(*) as row_count, 90.0::double as duration_seconds
        from quotes_e, (values ('clean'), ('load')) t(task) group by all""",
    "run_log_append": """select cast(dt as date) as target_date, t.task || '.' || market as task_id, 'success' as status, count(*) as row_count, 90.0::double as duration_seconds
        from quotes_e, (values ('clean'), ('load')) t(task) group by all""",
    "land_raw_partition": "select dt, case when dt < '1998-07-01' then score else 0.0 end as score, fear_greed_rating from clean_sentiment",
    "requeue_partitions": "select dt, count(*) as row_count from quotes_e where dt not in ('1998-06-20', '1998-07-01') group by dt",
    # scalar expressions
    "parse_numeric": f"""select dt, stock_id, {lng('trade_volume')} as volume, {dbl('open_price')} as open_price,
        {lng('transaction_count')} as count_long, {dbl('transaction_count')} as count_double from raw_a_l""",
    "explode_flatten": f"select dt, {', '.join(A)} from flat_a_l",
    "drop_null_payload": "select dt, count(*) as payloads from raw_a_l where l_orderkey % 23 <> 0 group by dt",
    "html_direction": "select dt, stock_id, change_direction from clean_a_l",
    "signed_change": "select dt, stock_id, change_direction, signed_change_amount as change_amount from clean_a_l",
    "clean_quotes_a": f"select dt, {', '.join(A)}, change_direction, signed_change_amount from clean_a_l",
    "clean_quotes_b": f"select dt, {', '.join(B)}, change_amount from clean_b_l",
    "nan_to_null_round": "select stock_id, market, trade_date, open, high, low, close, volume from clean_history_l",
    "unify_a": f"select {_QUOTE_LIST} from unified_a_l",
    "unify_b": f"select {_QUOTE_LIST} from unified_b_l",
    "unify_history": f"select {_QUOTE_LIST} from unified_history_l",
    "epoch_ms_to_date": f"select x, cast(ts - interval {P.DAY_SHIFT} day + interval 8 hour as date) as local_date from records",
    "clean_universe": "select stock_id, company_name, stock_name, industry_code, listing_date, market from clean_list",
    "weight_basis": "select trade_date, stock_id, weight_basis, weighting_method from weighed_l",
    "calendar_attributes": f"select {_CALENDAR.format('d')} from (select distinct cast(o_orderdate as date) as d from orders)",
    "rsi_band": """select trade_date, stock_id, case when round(rsi14 + 1e-7, 4) > 70 then 'overbought'
        when round(rsi14 + 1e-7, 4) < 30 then 'oversold' else 'neutral' end as rsi_status from fact_l""",
    "health_band": """select *, case when success_rate_pct >= 95 then 'green' when success_rate_pct >= 80 then 'orange' else 'red' end as health
        from run_summary""",
    "era_date_to_iso": """select o_orderkey, case when o_orderkey % 10 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end as iso_date from orders""",
    "iso_to_era_date": "select o_orderkey, cast(year(o_orderdate) - 1911 as varchar) || strftime(o_orderdate, '/%m/%d') as era_date from orders",
    "normalize_symbol": """select c_custkey, case when c_custkey % 4 = 3 then cast(c_custkey as varchar) || '.US' else cast(c_custkey as varchar) end as stock_id,
        case c_custkey % 4 when 0 then 'TWSE' when 1 then 'TPEx' else 'UNKNOWN' end as market from customer""",
    "vendor_symbol": """select c_custkey, cast(c_custkey as varchar) || case c_custkey % 3 when 0 then '.TW' when 1 then '.TWO' end as symbol,
        c_custkey % 3 = 2 as rejected from customer""",
    "id_format_class": """select case when length(id) = 4 and id not like '%A' then 'four_digits' when length(id) = 5 and id not like '%A' then 'five_digits'
        when id like '%A' then 'has_letter' else 'other' end as id_format, count(*) as id_count
        from (select cast(o_orderkey as varchar) || case when o_custkey % 5 = 0 then 'A' else '' end as id from orders) group by 1""",
    "article_strip_html": "select page_id, plain as content, length(plain) as plain_chars from pages_plain",
    "article_id": "select page_id, case when page_id % 3 = 0 then md5(url) else cast(page_id as varchar) end as article_id from pages",
    "article_epoch_iso": """select page_id, case when page_id % 5 = 0 then '2024-02-01'
        else strftime(make_timestamp((1700000000 + page_id * 60) * 1000000), '%Y-%m-%dT%H:%M:%SZ') end as published_at from pages""",
    "article_related_codes": """select page_id, string_agg(code, ',' order by first_part) as related_stocks
        from (select page_id, code, min(part) as first_part from page_codes group by all) group by page_id""",
    "array_dedup_ordered": """
        select d.doc_id, coalesce(words, '') as words, coalesce(word_count, 0) as word_count from documents d left join (select doc_id, string_agg(w, ' ' order by pos) as words, count(*) as word_count from (
            select doc_id, w, min(pos) as pos from (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as pos
                from (select doc_id, string_split(text, ' ') as ws from documents)) where w <> '' group by doc_id, w) group by doc_id) x on x.doc_id = d.doc_id""",
    # filters
    "filter_official": "select dt, stock_id, close_price from quotes_l where stock_id in (select stock_id from official)",
    "filter_weightable": "select trade_date, stock_id, close_price from weighed_l where weight_basis > 0 and close_price is not null",
    "filter_trading_weekday": "select trade_date, stock_id from bars_l where dayofweek(trade_date) between 1 and 5",
    "filter_range_preset": " union all ".join(
        f"select '{p}' as preset, count(*) as rows_in_range from bars_l where trade_date >= date '{day}'" for p, day in RANGES_ON_2001_06_30.items()),
    # joins
    "join_universe": "select b.trade_date, b.stock_id, b.market, u.industry_code from bars_l b join universe u on b.stock_id = u.stock_id",
    "dim_industry": "select industry_code, industry_name from dim_industry",
    "industry_name_join": "select d.trade_date, d.industry_code, d.market, i.industry_name from idaily_l d left join dim_industry i on d.industry_code = i.industry_code",
    "market_obt": f"select {_OBT} from obt_l",
    "industry_vs_sentiment": f"""select i.trade_date, {r4('i.weighted_avg_price', 'weighted_avg_price')}, s.fear_greed_score from ifact_e i
        left join sentiment s on i.trade_date = s.index_date where i.industry_name = 'AMERICA' and i.market = 'TWSE' and i.trade_date >= date '1998-01-01'""",
    "join_expected_actual": _GAPS,
    "listed_asof_count": "select market, dt, expected_count from expected_l",
    "missing_anti": """
        select market, stock_id, company_name, min(dt) as first_day, max(dt) as last_day, count(*) as days_absent from (
            select a.*, d.day_no - row_number() over (partition by a.market, a.stock_id order by a.dt) as run from absent_l a
            join (select market, dt, row_number() over (partition by market order by dt) as day_no from actual_l) d on a.market = d.market and a.dt = d.dt)
        group by market, stock_id, company_name, run""",
    "raw_gap_days": "select market, dt, stock_id, company_name from absent_l where dt between date '1998-06-10' and date '1998-07-20'",
    "sentiment_asof": """select d.dt, s.score, s.fear_greed_rating from (select distinct dt from quotes_l) d asof left join per_day s on d.dt >= s.dt""",
    "events_asof": """select event_id, view_id, view_value from (
        select event_id, kind, last_value(view_id ignore nulls) over w as view_id, last_value(view_value ignore nulls) over w as view_value from (
            select null as event_id, ts, 0 as kind, event_id as view_id, value as view_value from events where event_type = 'view'
            union all select event_id, ts, 1, null, null from events)
        window w as (order by ts, kind, view_id rows between unbounded preceding and current row)) where kind = 1""",
    "latest_day_served": f"""select market, trade_date, industry_code, {r4('weighted_avg_price')}, daily_return_pct from ifact_e i
        where trade_date = (select max(trade_date) from ifact_e j where j.market = i.market)""",
    "scalar_latest_filter": f"""select trade_date, industry_code, {r4('weighted_avg_price')}, daily_return_pct from ifact_e where market = 'TWSE'
        and trade_date = (select max(trade_date) from ifact_e where market = 'TWSE')""",
    # aggregations
    "industry_daily_price": f"select {_IDAILY} from idaily_l",
    "weighting_label": "select trade_date, industry_code, market, weighting_method from idaily_l",
    "count_by_market": "select 'TWSE' as market, count(*) as row_count from raw_a_l union all select 'TPEx', count(*) from raw_b_l",
    "daily_distinct_instruments": "select market, cast(dt as varchar) as dt, actual_count from actual_l",
    "date_bounds": "select min(trade_date) as min_date, max(trade_date) as max_date from bars_l",
    "latest_date": "select max(trade_date) as latest_date from bars_l",
    "run_success_summary": "select * from run_summary",
    "run_overall_kpi": """select round(sum(success_runs) / sum(total_runs) * 100, 1) as success_rate_pct, cast(sum(total_runs) as bigint) as total_runs,
        count(distinct task_id) as task_count from run_summary""",
    "run_daily_trend": "select cast(run_timestamp as date) as run_date, status, count(*) as cnt from run_log group by all",
    "duplicate_key_audit": """select l_orderkey, l_linenumber, l_suppkey, row_count from (select l_orderkey, l_linenumber, l_suppkey,
        count(*) over (partition by l_orderkey, l_linenumber) as row_count from lineitem) where row_count > 1""",
    "id_length_histogram": "select trade_value is null as is_subset, cast(length(stock_id) as integer) as id_length, count(*) as row_count from bars_l group by all",
    # windows
    "prev_close": "select trade_date, stock_id, close_price, prior_close from prev_l",
    "gain_loss": f"select trade_date, stock_id, {r4('gain')}, {r4('loss')} from change_l",
    "ma5": f"select trade_date, stock_id, {r4('ma5')} from fact_l",
    "ma20": f"select trade_date, stock_id, {r4('ma20')} from fact_l",
    "rsi14": f"select trade_date, stock_id, {r4('rsi14')} from fact_l",
    "fact_stock_daily": f"select {_FACT} from fact_l",
    "industry_return_pct": f"""select trade_date, industry_code, industry_name, market, total_weight_basis, {r4('weighted_avg_price')}, stock_count,
        weighting_method, daily_return_pct from ifact_l""",
    "latest_vs_previous": f"""select stock_id, trade_date, close_price, {r4('close_price - coalesce(prior_close, close_price)', 'close_change')}
        from prev_l p where trade_date = (select max(trade_date) from prev_l x where x.stock_id = p.stock_id)""",
    # sorts and limits
    "sentiment_last2": "select index_date, fear_greed_score, fear_greed_rating from sentiment order by index_date desc limit 2",
    "industry_ranking_latest": f"select trade_date, industry_code, industry_name, {r4('weighted_avg_price')}, daily_return_pct {_RANKED}",
    "latest_ranking_served": f"""with r as (select * {_RANKED}) select b.industry_name as best_industry, b.daily_return_pct as best_return_pct,
        w.industry_name as worst_industry, w.daily_return_pct as worst_return_pct
        from (select * from r order by daily_return_pct desc, industry_code limit 1) b, (select * from r order by daily_return_pct, industry_code desc limit 1) w""",
    "best_worst_industry": f"""with r as (select * {_RANKED}) select b.industry_name as best_industry, b.daily_return_pct as best_return_pct,
        w.industry_name as worst_industry, w.daily_return_pct as worst_return_pct
        from (select * from r order by daily_return_pct desc, industry_code limit 1) b, (select * from r order by daily_return_pct, industry_code desc limit 1) w""",
    "stock_series": f"""select trade_date, open_price, high_price, low_price, close_price, trade_volume, {r4('ma5')}, {r4('ma20')}, {r4('rsi14')}
        from fact_l where stock_id = '7' and trade_date >= date '1998-01-01'""",
    "stock_info": "select stock_id, company_name, stock_name, market, industry_name from obt_e where stock_id = '7' order by trade_date desc limit 1",
    "top_gaps": f"select * from ({_GAPS}) where gap > 20",
    "industry_picker": "select industry_code, industry_name from dim_industry where industry_name is not null",
    # sets
    "merge_markets": f"select {_QUOTE_LIST} from listed_a_l union all select {_QUOTE_LIST} from listed_b_l",
    "merge_three_sources": f"""select {_QUOTE_LIST} from unified_a_l where {_market('cast(stock_id as bigint)')} = 'TWSE'
        union all select {_QUOTE_LIST} from unified_b_l where {_market('cast(stock_id as bigint)')} = 'TPEx'
        union all select {_QUOTE_LIST} from unified_history_l""",
    "merge_universe": "select stock_id, company_name, stock_name, industry_code, listing_date, market from clean_list where dt = '2001-06-01'",
    "sentiment_dedup_day": "select dt, score, fear_greed_rating from per_day",
    "set_difference_ids": "select cast(user_id as varchar) as stock_id from events except select cast(s_suppkey as varchar) from supplier",
    "article_dedup": "select article_id, title, url, published_at, source_name from articles",
    # generators
    "date_spine": f"select cast(d as date) as calendar_date from {_SPINE}",
    "backlog_dates": """select cast(d as date) as dt from (select unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as d)
        where cast(d as date) not in (select trade_date from bars_l where day(trade_date) <> 13)
        and cast(d as date) not in (select trade_date from bars_l where day(trade_date) = 13)""",
    "backlog_outcomes": """select case when exists (select 1 from bars_l where trade_date = cast(d as date) and day(trade_date) <> 13) then 'skipped'
        when exists (select 1 from bars_l where trade_date = cast(d as date)) then 'no_trading' else 'to_do' end as outcome, count(*) as days
        from (select unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as d) group by 1""",
    "backlog_instruments": "select stock_id from universe where stock_id not in (select stock_id from official)",
    "dim_stock": "select stock_id, company_name, stock_name, industry_code, listing_date, market from universe",
    "dim_date": f"select {_CALENDAR.format('d')} from {_SPINE}",
    # quality
    "dq_not_null": "select trade_date, stock_id from bars_l where trade_value is null",
    "dq_unique": "select dt, stock_id, count(*) as row_count from raw_a_l group by all having count(*) > 1",
    "dq_accepted_values": "select x, rating from records where rating not in ('fear', 'neutral', 'greed')",
    "dq_accepted_range": "select trade_date, stock_id, close_price from bars_l where trade_value is not null and (close_price <= 0 or close_price >= 100000)",
    "dq_high_is_highest": f"""select trade_date, stock_id, high_price from (select * replace (coalesce(average_price, high_price) as high_price) from bars_l)
        where {_TRADED} and (high_price < open_price or high_price < low_price or high_price < close_price)""",
    "dq_low_is_lowest": f"""select trade_date, stock_id, low_price from (select * replace (coalesce(average_price, low_price) as low_price) from bars_l)
        where {_TRADED} and (low_price > open_price or low_price > high_price or low_price > close_price)""",
    "dq_not_future": f"select trade_date, stock_id from bars_l where trade_date > date '{P.TODAY}'",
    "dq_no_mixed_method": "select trade_date, industry_code, market from ifact_l where weighting_method = 'mixed'",
    "dq_freshness": f"""select source, {r4('age', 'age_hours')}, case when age > 48 then 'error' when age > 30 then 'warn' else 'pass' end as state
        from (select 'user_' || cast(user_id as varchar) as source, epoch_us(timestamp '2024-02-01 00:00:00') / 3.6e9 - epoch_us(max(ts)) / 3.6e9 as age
            from events group by 1)
        union all select 'never_loaded', null, 'error'""",
    "completeness_a": _completeness("TWSE", False),
    "completeness_b": _completeness("TPEx", True),
    "raw_gap_scan": """select a.market, a.dt, any_value(d.actual_count) as actual_count, count(*) as missing_count
        from absent_l a join actual_l d on a.market = d.market and a.dt = d.dt group by a.market, a.dt""",
    "clean_gap_scan": f"select * from ({_GAPS}) where gap > 10",
    "field_contract": f"""select l_orderkey, l_linenumber, l_linenumber not in (5, 7) as fields_match,
        case when l_linenumber = 5 then '{S.RAW_FIELDS_A[-1]}' else '' end as missing_fields, '' as extra_fields from trades_l""",
    "payload_contract": """select event_id, event_type in ('view', 'click') as has_block,
        case event_type when 'view' then '' when 'click' then 'rating' else 'score,rating,timestamp' end as missing_keys,
        event_type = 'view' as contract_ok from events""",
    "landing_status": """
        select 'history' as mode, dt, case when second_empty is not null and (first_at is null or second_empty < first_at) then 'no_data' else decided end as status
        from history_mode
        union all
        select 'daily', d.dt, coalesce((select case when bool_or(k.decision = 'unknown_failure') then 'unknown_failure' else 'success' end from daily_kinds k
            where k.dt = d.dt and k.decision is not null and k.attempt = (select min(attempt) from daily_kinds j where j.dt = d.dt and j.decision is not null)
            having count(*) > 0), 'unknown_failure')
        from (select distinct dt from attempts) d
        union all
        select 'single', dt, case when not http_ok then 'unknown_failure' when n_tables = 7 then 'no_data' else 'success' end from attempts""",
    "unparseable_scan": "select * from (" + " union all ".join(
        f"select '{c}' as column_name, {c} as value, count(*) as row_count from raw_a_l where {c} is not null and ({dbl(c)}) is null group by {c}"
        for c in A if c in LONGS_A | DOUBLES_A) + ")",
    "null_ohlc_audit": "select dt, stock_id, average_price from listed_b_l where close_price is null and average_price is not null",
    "nan_residual_check": """select count(*) as row_count, count(*) filter (coalesce(isnan(open), false) or coalesce(isnan(high), false)
        or coalesce(isnan(low), false) or coalesce(isnan(close), false)) as nan_rows from clean_history_l""",
    # jobs
    "job_clean_day": f"""select {_QUOTE_LIST} from listed_flat_a_e where dt = '1998-06-25'
        union all select {_QUOTE_LIST} from listed_flat_b_e where dt = '1998-06-25'""",
    "job_backfill_quotes": f"select {_QUOTE_LIST} from listed_flat_a_e union all select {_QUOTE_LIST} from unified_history_e",
    "job_sentiment_day": "select '1998-07-20' as dt, score, fear_greed_rating from nested_per_day order by nested_per_day.dt desc limit 1",
    "job_sentiment_history": "select dt, score, fear_greed_rating from nested_per_day",
    "job_universe": "select stock_id, company_name, stock_name, industry_code, listing_date, market from clean_list where dt = '2001-06-01'",
    "job_marts": f"select {_OBT} from obt_e",
    "job_quality_gates": "select *, failing_rows = 0 as passed from (" + " union all ".join(_GATES) + ")",
    "job_dashboard_overview": f"""with r as (select * {_RANKED}),
        s as (select *, fear_greed_score - lag(fear_greed_score) over (order by index_date) as score_change from sentiment)
        select s.index_date, s.fear_greed_score, s.fear_greed_rating, {r4('s.score_change', 'score_change')}, b.industry_name as best_industry,
            b.daily_return_pct as best_return_pct, w.industry_name as worst_industry, w.daily_return_pct as worst_return_pct
        from (select * from s order by index_date desc limit 1) s, (select * from r order by daily_return_pct desc, industry_code limit 1) b,
            (select * from r order by daily_return_pct, industry_code desc limit 1) w""",
    "job_articles": "select article_id, title, summary, content, plain_chars, url, published_at, category, keyword, related_stocks, source_name, fetched_date from articles",
}

#: What stored marts are asked, over all days of lineitem.
BODIES |= {
    f"{key}_all_days": re.sub(r"\b(ifact|fact|obt|bars)_e\b", r"\1_l", BODIES[key])
    for key in ("industry_vs_sentiment", "scalar_latest_filter", "industry_ranking_latest", "best_worst_industry", "stock_info", "job_quality_gates", "job_dashboard_overview")
}


def _needed(text: str, found: dict[str, None]) -> None:
    for name in STEPS:
        if name not in found and re.search(rf"\b(?:from|join)\s+{name}\b", text):
            _needed(STEPS[name], found)
            found[name] = None


def statement(key: str) -> str:
    body = BODIES[key]
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body
    steps = ",\n".join(f"{name} as ({STEPS[name]})" for name in found)
    if body.lstrip().startswith("with "):
        return f"with {steps},\n{body.lstrip()[5:]}"
    return f"with {steps}\n{body}"


def statements() -> dict[str, str]:
    return {key: statement(key) for key in BODIES}
