"""Times of the main plans on generated tables, even and with keys that hold a third of the rows.

python tests/trial.py <folder> [millions of subscriptions] writes the tables there (a new folder) and prints, for each query, the wall
time and, from Spark's own event log, the longest and the mean task of the stage with the longest task.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections import defaultdict
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans import dashboard, facts, indicators, staging  # noqa: E402
from tidemark.plans import lifecycle as life  # noqa: E402

AS_OF = date(2024, 1, 20)


def generate(spark: SparkSession, folder: str, millions: float, skewed: bool) -> None:
    n = int(millions * 1_000_000)

    def drawn(name: str, most: int) -> F.Column:
        return F.pmod(F.xxhash64("id", F.lit(name)), F.lit(most))

    def key(name: str, most: int) -> F.Column:
        """A key among ``most``; in the skewed variant one key has a third of the rows."""
        even = drawn(name, most) + 1
        return F.when(drawn(f"{name} hot", 3) == 0, 1).otherwise(even).cast("bigint") if skewed else even

    def on(name: str, days: int) -> F.Column:
        return F.date_sub(F.lit(AS_OF), drawn(name, days).cast("int"))

    def pick(name: str, *values: str) -> F.Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (drawn(name, len(values)) + 1).cast("int"))

    status = pick("status", "active", "active", "active", "cancelled", "fraud")
    subs = spark.range(0, n, 1, 32).select(
        F.col("id").alias("subscription_id"),
        key("customer", n // 3).alias("customer_id"),
        pick("product", "voip", "mobile").alias("product_type"),
        F.lit("plan").alias("plan"),
        (drawn("mrr", 100) + 0.5).cast("double").alias("mrr"),
        on("live", 1500).alias("go_live_date"),
        status.alias("status"),
        F.when(status == "cancelled", on("end", 700)).alias("cancelled_date"),
        F.lit(12).cast("bigint").alias("contract_term_months"),
    )
    # six keys come very often, as copies
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("subscription_id") < 6, n // 15).otherwise(1)))
    subs.select("*", copies.alias("c")).drop("c").repartition(32).write.parquet(f"{folder}/subscriptions")
    rows = spark.range(0, 5 * n, 1, 32)
    rows.select(
        key("sub", n).alias("subscription_id"),
        on("day", 900).alias("usage_date"),
        drawn("calls", 4).alias("call_count"),
        drawn("minutes", 90).cast("double").alias("call_minutes"),
        drawn("peak", 12).alias("concurrent_peak"),
    ).write.parquet(f"{folder}/usage_daily")
    rows = spark.range(0, 2 * n, 1, 32)
    rows.select(
        F.col("id").alias("invoice_id"),
        key("bill", n // 3).alias("customer_id"),
        F.trunc(on("month", 900), "month").alias("period_month"),
        F.lit(10.0).alias("amount_due"),
        F.lit(5.0).alias("amount_paid"),
        pick("paid", "paid", "paid", "unpaid", "part_paid").alias("status"),
    ).write.parquet(f"{folder}/billings")
    moment = on("at", 900).cast("timestamp_ntz")
    rows.select(
        F.col("id").alias("contact_id"),
        key("contact", n // 3).alias("customer_id"),
        moment.alias("created_at"),
        F.lit("email").alias("channel"),
        pick("category", "complaint", "technical_fault", "general").alias("category"),
        moment.alias("resolved_at"),
    ).write.parquet(f"{folder}/support_contacts")
    rows.select(
        F.col("id").alias("event_id"),
        F.concat(key("event", n // 3).cast("string"), F.lit(".0")).alias("customer_id"),
        pick("type", "login", "support_ticket_open").alias("event_type"),
        moment.alias("event_timestamp"),
    ).write.parquet(f"{folder}/portal_events")


def queries(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    raw = {t.name: spark.read.parquet(str(t)) for t in Path(folder).iterdir()}
    first = staging.subscription_history(raw["subscriptions"], None, datetime(2024, 1, 18))
    changed = raw["subscriptions"].where("subscription_id % 19 <> 7").withColumn(
        "mrr", F.when(F.col("subscription_id") % 11 == 0, F.col("mrr") + 1).otherwise(F.col("mrr"))
    )
    second = staging.subscription_history(changed, first, datetime(2024, 1, 19))
    states = life.subscription_lifecycle(staging.stage_subscriptions(first, AS_OF))
    base = life.indicator_base(states, AS_OF)
    staged = {t: getattr(staging, f"stage_{t}")(raw[t]) for t in ("billings", "support_contacts", "portal_events", "usage_daily")}
    return {
        "lifecycle": states,
        "monthly fact": facts.subscription_monthly(states, AS_OF),
        "churn metrics": facts.churn_metrics(states, AS_OF),
        "billing signal": indicators.customer_signal(base, indicators.billing_sightings(staged["billings"]), "billing"),
        "usage signals": indicators.usage_flags(base, staged["usage_daily"]),
        "indicator scan": indicators.leading_indicator_scan(
            base, staged["support_contacts"], staged["portal_events"], staged["billings"], staged["usage_daily"]
        ),
        "KPIs": dashboard.kpis(states, staged["billings"], AS_OF),
        "two-run snapshot": second,
    }


def tasks(log: Path) -> dict[str, dict[int, list[float]]]:
    """Seconds of the tasks of each stage, by the job group in which the stage first ran."""
    groups, found = {}, defaultdict(lambda: defaultdict(list))
    for line in log.read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            for stage in event["Stage IDs"]:
                groups.setdefault(stage, event["Properties"].get("spark.jobGroup.id"))
        elif event["Event"] == "SparkListenerTaskEnd":
            info = event["Task Info"]
            found[groups.get(event["Stage ID"])][event["Stage ID"]].append((info["Finish Time"] - info["Launch Time"]) / 1000)
    return found


def main() -> None:
    folder, millions = sys.argv[1], float(sys.argv[2]) if len(sys.argv) > 2 else 6
    os.makedirs(f"{folder}/events")
    conf = {
        "spark.master": "local[8]", "spark.driver.memory": "20g", "spark.sql.shuffle.partitions": "64", "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{folder}/events", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
        "spark.local.dir": f"{folder}/local",
    }
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for kind in ("even", "skewed"):
        generate(spark, f"{folder}/{kind}", millions, kind == "skewed")
        for name, df in queries(spark, f"{folder}/{kind}").items():
            spark.sparkContext.setJobGroup(f"{kind} {name}", name)
            start = time.time()
            df.write.format("noop").mode("overwrite").save()
            seconds[f"{kind} {name}"] = time.time() - start
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.stop()
    (log,) = Path(f"{folder}/events").iterdir()
    of = tasks(log)
    for name, s in seconds.items():
        worst = max(of[name].values(), key=max, default=[0.0])
        print(f"{name}: {s:.1f} s; longest task {max(worst):.1f} s, mean of its stage {sum(worst) / len(worst):.1f} s")


if __name__ == "__main__":
    main()
