"""Jobs from the command line: spark-submit or python -m marketmill JOB ..."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill import schemas as S
from marketmill.operators import backlog, coverage, quotes, sentiment
from marketmill.plans import cleaning, marts
from marketmill.session import build_session
from marketmill.sources import aside, raw

SEED = str(Path(__file__).parent / "seeds" / "industry_names.csv")
JOBS = ["universe", "clean-day", "backfill", "sentiment-day", "sentiment-history", "marts", "gates", "backlog", "gaps", "raw-gaps", "completeness", "requeue"]

#: Jobs that return rows.
ANSWERS = {"gates", "backlog", "gaps", "raw-gaps", "completeness"}


def _arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="marketmill", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--lake", required=True, help="root of the raw lake")
    parser.add_argument("--clean", required=True, help="root of the clean lake")
    parser.add_argument("--marts", help="root of the marts")
    parser.add_argument("--seed", default=SEED, help="CSV of industry codes and names")
    parser.add_argument("--date", help="day of a daily job, or today for the gates: YYYY-MM-DD")
    parser.add_argument("--start", help="first day of a range")
    parser.add_argument("--end", help="last day of a range")
    parser.add_argument("--since", help="marts: rewrite from this day on, for rows that came late")
    parser.add_argument("--full", action="store_true", help="marts: rewrite all days")
    parser.add_argument("--market", default=S.MARKET_A, choices=S.MARKETS, help="market of gaps and completeness")
    parser.add_argument("--aside", help="table of files set aside; broken raw files go there instead of failing the job")
    parser.add_argument("--out", help="folder for the whole answer of a job that asks (JSON lines)")
    parser.add_argument("--rows", type=int, help="print so many rows of the answer; without it an answer needs --out")
    parser.add_argument("--zone", default="Asia/Taipei", help="time zone of calendar dates")
    parser.add_argument("--json-lines", action="store_true", help="raw files hold one object per line")
    return parser.parse_args(argv)


def run(spark: SparkSession, a: argparse.Namespace) -> DataFrame | None:
    """Run one job; jobs that answer a question return its rows."""
    multiline = not a.json_lines
    clean_quotes, clean_sentiment, clean_universe = (f"{a.clean}/{n}" for n in ("quotes", "sentiment", "universe"))

    def official(market: str) -> DataFrame:
        return cleaning.official_ids(raw.clean_universe(spark, clean_universe), market)

    def staged() -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return (
            quotes.stage_quotes(raw.clean_quotes(spark, clean_quotes)),
            raw.clean_universe(spark, clean_universe),
            raw.seed_codes(spark, a.seed),
            sentiment.stage_sentiment(raw.clean_sentiment(spark, clean_sentiment)),
        )

    def dated() -> DataFrame:
        return raw.clean_quotes(spark, clean_quotes, a.market).withColumn("dt", F.col("dt").cast("date"))

    def judged_days() -> DataFrame:
        requested = backlog.requested_days(spark, a.start, a.end)
        members = raw.clean_universe(spark, clean_universe).select("market", "stock_id")
        return coverage.completeness(requested, dated(), members, a.market, a.market == S.MARKET_B, start=a.start, end=a.end)

    if a.job == "universe":
        cleaning.universe(spark, a.lake, clean_universe, multiline)
    elif a.job == "clean-day":
        cleaning.clean_day(spark, a.lake, official(S.MARKET_A), official(S.MARKET_B), a.date, clean_quotes, multiline, a.aside)
    elif a.job == "backfill":
        cleaning.backfill_quotes(spark, a.lake, official(S.MARKET_A), clean_quotes, multiline, a.aside)
    elif a.job == "sentiment-day":
        payload = raw.partition_path(a.lake, "sentiment", "dt", a.date)
        cleaning.sentiment_day(spark, payload, a.date, a.zone, clean_sentiment, multiline)
    elif a.job == "sentiment-history":
        payload = raw.partition_path(a.lake, "sentiment_history", "range", "full")
        cleaning.sentiment_history(spark, payload, a.zone, clean_sentiment, multiline)
    elif a.job == "marts":
        marts.refresh_marts(spark, *staged(), a.marts, since=date.fromisoformat(a.since) if a.since else None, full=a.full)
    elif a.job == "gates":
        return marts.quality_gates(marts.read_marts(spark, a.marts), date.fromisoformat(a.date))
    elif a.job == "backlog":
        return cleaning.backlog(spark, a.lake, cleaning.SOURCE_A, a.start, a.end, a.aside).orderBy("dt")
    elif a.job == "requeue":
        days = backlog.requested_days(spark, a.start or a.date, a.end or a.date)
        for source in (cleaning.SOURCE_A, cleaning.SOURCE_B):
            aside.requeue(spark, a.lake, source, days, a.aside)
    elif a.job == "completeness":
        return judged_days().orderBy("dt", "missing_id")
    else:
        scan = coverage.raw_gap_scan if a.job == "raw-gaps" else coverage.clean_gap_scan
        return scan(dated(), raw.clean_universe(spark, clean_universe))
    return None


def main(argv: list[str]) -> int:
    arguments = _arguments(argv)
    if arguments.job in ANSWERS and not arguments.out and arguments.rows is None:
        print(f"{arguments.job} has an answer of any length: name --out for all of it, or --rows", file=sys.stderr)
        return 2
    spark = build_session(f"marketmill {arguments.job}", time_zone=arguments.zone)
    answer = run(spark, arguments)
    if answer is None:
        return 0
    # A whole answer is planned once: what was written tells whether a gate failed.
    failed = False
    if arguments.out:
        answer.write.mode("overwrite").json(arguments.out)
        rows = spark.read.schema(answer.schema).json(arguments.out)
        failed = arguments.job == "gates" and not rows.where(~F.col("passed")).isEmpty()
    else:
        for row in answer.limit(arguments.rows).collect():
            print(json.dumps(row.asDict(), default=str, ensure_ascii=False))
        failed = arguments.job == "gates" and not answer.where(~F.col("passed")).isEmpty()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
