"""Which accounts a strategy reads, which it writes for, and whether it is in use."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from vitrine.functions.times import stamp
from vitrine.operators.spread import spread

RECENT = timedelta(days=30)

# Input names that hold a strategy id, and lists of strategy ids.
SINGLE_INPUTS = ("recset_id", "strategy_id")
LIST_INPUTS = ("rec_set_ids", "fallback_rec_set_ids")
EMAIL_CAMPAIGN = "email_exp"


def fact_accounts(
    accounts: DataFrame,
    market_accounts: DataFrame,
    account_id: int | None = None,
    market_id: int | None = None,
    retailer_id: int | None = None,
    whole_retailer: bool = False,
) -> DataFrame:
    """Accounts whose facts count: all of a retailer, those of a market, or a single one."""
    if whole_retailer:
        chosen = accounts.where(F.col("retailer_id") == retailer_id)
    elif market_id is not None:
        members = market_accounts.where(F.col("market_id") == market_id)
        chosen = accounts.join(members, "account_id", "left_semi")
    else:
        chosen = accounts.where(F.col("account_id") == account_id)
    return chosen


def output_accounts(
    accounts: DataFrame,
    features: DataFrame,
    feature: str,
    account_id: int | None = None,
    retailer_id: int | None = None,
) -> DataFrame:
    """Accounts that get documents: live ones of the retailer, or the one account, holding the feature."""
    if account_id is not None:
        chosen = accounts.where(F.col("account_id") == account_id)
    else:
        chosen = accounts.where((F.col("retailer_id") == retailer_id) & (F.col("archived") == 0))
    return chosen.join(features.where(F.col("feature") == feature), "account_id", "left_semi")


def active_strategies(
    strategies: DataFrame,
    inputs: DataFrame,
    actions: DataFrame,
    placements: DataFrame,
    campaigns: DataFrame,
    campaign_groups: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """Strategies in use: components, recently updated ones, and those a live experience refers to.

    Action inputs form a nested-set tree. A strategy id counts when it is a plain
    input of an action that has a root, or lies inside a list of ids.
    """
    since = stamp(as_of - RECENT)
    live_groups = campaign_groups.where(
        (F.col("archived") == 0)
        & (
            (F.col("last_modified_time") > since)
            | ((F.col("active") == 1) & (F.col("end_time").isNull() | (F.col("end_time") > since)))
            | (F.col("campaign_type") == EMAIL_CAMPAIGN)
        )
    ).select(F.col("id").alias("campaign_group_id"))
    live_campaigns = campaigns.join(live_groups, "campaign_group_id", "left_semi").select(
        F.col("id").alias("campaign_id")
    )
    live_places = spread(placements, "campaign_id").join(live_campaigns, "campaign_id", "left_semi").select(F.col("id").alias("where_id"))
    live_actions = spread(actions, "where_id").join(live_places, "where_id", "left_semi").select(F.col("id").alias("action_id"))

    live = spread(inputs, "action_id").join(live_actions, "action_id", "left_semi").select("action_id", "lft", "rgt", "int_value", "name")
    roots = live.where(F.col("lft") == 1).select("action_id")
    lists = live.where(F.col("name").isin(*LIST_INPUTS)).select(
        F.col("action_id").alias("list_action"), F.col("lft").alias("list_lft"), F.col("rgt").alias("list_rgt")
    )
    plain = live.where(F.col("name").isin(*SINGLE_INPUTS)).join(roots, "action_id", "left_semi")
    inside = (F.col("lft") > F.col("list_lft")) & (F.col("rgt") < F.col("list_rgt"))
    listed = live.where(F.col("int_value").isNotNull()).join(
        lists, (F.col("action_id") == F.col("list_action")) & inside, "left_semi"
    )
    referenced = plain.select("int_value").unionByName(listed.select("int_value")).distinct()

    own_merit = F.col("is_component") | (F.col("updated") >= since)
    used = strategies.join(
        referenced.withColumn("referenced", F.lit(True)), F.col("id") == F.col("int_value"), "left"
    )
    return used.where(own_merit | F.coalesce("referenced", F.lit(False))).select(*strategies.columns)
