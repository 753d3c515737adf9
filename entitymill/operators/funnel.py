"""Funnel, cost and return figures; money stays in integer cents until the last step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import FUNNEL_STAGES
from ..functions.scores import div_half_up, percent

# Which stages count as having passed a step.
PAST_CONTACT = ["CONTACTED", "RESPONDED", "DEMO_SET", "OPPORTUNITY", "CLOSED_WON"]
PAST_RESPONSE = ["RESPONDED", "DEMO_SET", "OPPORTUNITY", "CLOSED_WON"]
PAST_DEMO = ["DEMO_SET", "OPPORTUNITY", "CLOSED_WON"]
ACTIVE = ["CONTACTED", "RESPONDED", "DEMO_SET"]
COST_CATEGORIES = ["infrastructure", "enrichment", "outreach", "labor"]
CLOSED = ["WON", "LOST"]


def stage_position(c) -> Column:
    stage = F.col(c) if isinstance(c, str) else c
    arms = reduce(
        lambda acc, item: acc.when(stage == item[1], item[0]),
        list(enumerate(FUNNEL_STAGES, start=1))[1:],
        F.when(stage == FUNNEL_STAGES[0], 1),
    )
    return arms.otherwise(len(FUNNEL_STAGES) + 1)


def usd(cents: Column) -> Column:
    return cents / F.lit(100.0)


def total_cost() -> Column:
    return F.col("acquisition_cost_cents") + F.col("enrichment_cost_cents") + F.col(
        "outreach_cost_cents"
    )


def unit_cost(amount: str, units: str) -> Column:
    """Whole cents per unit, NULL without units."""
    return F.call_function("div", F.col(amount), F.nullif(F.col(units), F.lit(0).cast("long")))


def stage_metrics(attribution: DataFrame) -> DataFrame:
    """Leads, cost and days per stage, in stage order."""
    rows = attribution.withColumn("total", total_cost())
    return (
        rows.groupBy("stage")
        .agg(
            F.count(F.lit(1)).alias("lead_count"),
            usd(div_half_up(F.sum("total"), F.count(F.lit(1)))).alias("avg_cost_per_lead"),
            usd(F.sum("total")).alias("total_cost"),
            (div_half_up(F.sum("days_to_contact") * 10, F.count("days_to_contact")) / F.lit(10.0)).alias(
                "avg_days_to_contact"
            ),
            (div_half_up(F.sum("days_to_response") * 10, F.count("days_to_response")) / F.lit(10.0)).alias(
                "avg_days_to_response"
            ),
        )
        .orderBy(stage_position("stage"), "stage")
    )


def monthly_costs(costs: DataFrame) -> DataFrame:
    rows = costs.withColumn("unit", unit_cost("amount_cents", "billable_units"))
    return rows.groupBy(F.date_format("cost_date", "yyyy-MM").alias("month"), "category").agg(
        usd(F.sum("amount_cents")).alias("total_cost_usd"),
        F.sum("billable_units").alias("total_units"),
        (div_half_up(F.sum("unit") * 100, F.count("unit")) / F.lit(10000.0)).alias(
            "avg_cost_per_unit"
        ),
    ).orderBy(F.desc("month"), F.desc("total_cost_usd"))


def return_on_investment(
    costs: DataFrame, attribution: DataFrame, opportunities: DataFrame, entities: DataFrame
) -> DataFrame:
    """The one-row summary: each table is read once, the four one-row results are put together."""
    spent = costs.agg(
        F.coalesce(F.sum("amount_cents"), F.lit(0)).alias("all_cents"),
        *[
            F.coalesce(F.sum(F.when(F.col("category") == c, F.col("amount_cents"))), F.lit(0)).alias(c)
            for c in COST_CATEGORIES
        ],
    )
    leads = entities.where(F.coalesce(F.col("is_deleted"), F.lit(0)) == 0).agg(
        F.count(F.lit(1)).alias("total_leads")
    )
    stages = attribution.agg(
        F.count_if(F.col("stage") == "ENRICHED").alias("enriched_leads"),
        F.count_if(F.col("stage").isin(ACTIVE)).alias("active_leads"),
    )
    is_open, won = ~F.col("stage").isin(CLOSED), F.col("stage") == "WON"
    deals = opportunities.agg(
        F.count_if(is_open).alias("open_opportunities"),
        F.coalesce(F.sum(F.when(is_open, F.col("amount_cents"))), F.lit(0)).alias("open_cents"),
        F.count_if(won).alias("closed_won_count"),
        F.coalesce(F.sum(F.when(won, F.col("amount_cents"))), F.lit(0)).alias("won_cents"),
        F.count_if(F.col("stage") == "LOST").alias("closed_lost_count"),
    )
    one = reduce(lambda a, b: a.join(F.broadcast(b)), [spent, leads, stages, deals])
    return one.select(
        usd(F.col("all_cents")).alias("total_investment_usd"),
        *[usd(F.col(c)).alias(f"{c}_cost") for c in COST_CATEGORIES],
        "total_leads", "enriched_leads", "active_leads", "open_opportunities",
        usd(F.col("open_cents")).alias("pipeline_value_usd"),
        "closed_won_count",
        usd(F.col("won_cents")).alias("closed_won_value_usd"),
        "closed_lost_count",
        percent_signed(F.col("won_cents") - F.col("all_cents"), F.col("all_cents")).alias("roi_percentage"),
        (div_half_up(F.col("all_cents") * 100, F.col("total_leads")) / F.lit(10000.0)).alias(
            "cost_per_lead_usd"
        ),
        usd(div_half_up(F.col("all_cents"), F.col("closed_won_count"))).alias("cost_per_closed_deal_usd"),
    )


def percent_signed(part: Column, whole: Column) -> Column:
    return F.when(part < 0, -percent(-part, whole)).otherwise(percent(part, whole))


def conversion_rates(attribution: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Five steps from one pass over the leads and one over the deals."""
    stage = F.col("stage")
    leads = attribution.agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(stage != "RAW_LEAD").alias("n_enriched"),
        F.count_if(stage.isin(PAST_CONTACT)).alias("n_contact"),
        F.count_if(stage.isin(PAST_RESPONSE)).alias("n_response"),
        F.count_if(stage.isin(PAST_DEMO)).alias("n_demo"),
    )
    deals = opportunities.agg(
        F.count_if(stage == "WON").alias("n_won"), F.count_if(stage.isin(CLOSED)).alias("n_closed")
    )
    steps = [
        ("Raw -> Enriched", "n_enriched", "n_all"),
        ("Enriched -> Contacted", "n_contact", "n_enriched"),
        ("Contacted -> Response", "n_response", "n_contact"),
        ("Response -> Demo", "n_demo", "n_response"),
        ("Demo -> Closed Won", "n_won", "n_closed"),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("conversion"), F.col(part).alias("numerator"),
                F.col(whole).alias("denominator"),
            )
            for name, part, whole in steps
        ]
    )
    return (
        leads.join(F.broadcast(deals))
        .select(F.inline(rows))
        .withColumn("conversion_rate_pct", percent(F.col("numerator"), F.col("denominator")))
    )


def time_in_previous_stage(
    events: DataFrame, entity: str, at: str, stage: str, event_id: str = "event_id"
) -> DataFrame:
    """Previous stage of every event and the whole hours since then.

    A busy entity is cut into hours: inside an hour a window finds the event before, and the
    first event of an hour takes the last one of the entity's previous active hour. So no
    task sees more than one hour of an entity, plus one row per active hour.
    """
    rows = events.select(
        event_id, entity, F.col(at).cast("timestamp").alias("_at"), F.col(stage).alias("stage_to")
    ).withColumn("_hour", F.date_trunc("hour", "_at"))
    inside = Window.partitionBy(entity, "_hour").orderBy("_at", event_id)
    seen = F.struct("_at", "stage_to")
    rows = rows.withColumn("_prev", F.lag(seen).over(inside))
    hours = rows.groupBy(entity, "_hour").agg(
        F.max_by(seen, F.struct("_at", event_id)).alias("_last")
    )
    by_entity = Window.partitionBy(entity).orderBy("_hour")
    carried = hours.select(entity, "_hour", F.lag("_last").over(by_entity).alias("_carried"))
    before = F.coalesce("_prev", "_carried")
    return (
        rows.join(carried, [entity, "_hour"])
        .withColumn("_before", before)
        .select(
            event_id,
            entity,
            F.col("_before.stage_to").alias("stage_from"),
            "stage_to",
            F.floor((F.unix_timestamp("_at") - F.unix_timestamp("_before._at")) / 3600)
            .cast("long")
            .alias("hours_in_previous"),
        )
    )
