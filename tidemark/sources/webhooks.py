"""Webhook bodies (JSON text) to typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import epoch, strip_modifier
from ..operators.flatten import nested_elements
from ..operators.joins import lookup_join

ISSUE_BODY = """webhookEvent STRING, issue STRUCT<key STRING, fields STRUCT<created STRING, updated STRING,
    status STRUCT<name STRING>, labels ARRAY<STRING>>>"""

REPO_BODY = """repository STRUCT<id BIGINT, name STRING, description STRING, url STRING, html_url STRING,
    owner STRUCT<login STRING>, created_at STRING, updated_at STRING, pushed_at STRING, language STRING,
    forks_count BIGINT, stargazers_count BIGINT, default_branch STRING>"""

CHAT_BODY = """team_id STRING, type STRING, event_time BIGINT, event STRUCT<type STRING, channel STRING,
    subtype STRING, reaction STRING, item STRUCT<channel STRING>, blocks ARRAY<STRUCT<elements ARRAY<STRUCT<
    elements ARRAY<STRUCT<type STRING, name STRING>>>>>>>"""

PULL_BODY = """id STRING, type STRING, repo STRUCT<name STRING>, payload STRUCT<pull_request STRUCT<
    merged_at STRING, created_at STRING, base STRUCT<ref STRING>>>"""


def parse(df: DataFrame, body: str, schema: str) -> DataFrame:
    return df.withColumn("b", F.from_json(F.col(body), schema)).drop(body)


def or_blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def issue_record(b: str = "b") -> list[Column]:
    fields = f"{b}.issue.fields"
    return [
        F.element_at(F.split(f"{b}.webhookEvent", ":"), -1).alias("event_type"),
        F.col(f"{b}.issue.key").alias("issue"),
        F.coalesce(F.get(f"{fields}.labels", F.lit(0)), F.lit("")).alias("customer"),
        F.col(f"{fields}.status.name").alias("issue_status"),
        epoch(f"{fields}.created").alias("created"),
        epoch(f"{fields}.updated").alias("updated"),
    ]


def repo_record(b: str = "b") -> list[Column]:
    r = f"{b}.repository"
    texts = ["name", "description", "url", "html_url"]
    return [
        F.col(f"{r}.id").alias("id"), *[or_blank(f"{r}.{c}").alias(c) for c in texts],
        or_blank(f"{r}.owner.login").alias("owner"),
        *[epoch(f"{r}.{c}").alias(c) for c in ("created_at", "updated_at", "pushed_at")],
        or_blank(f"{r}.language").alias("language"),
        F.col(f"{r}.forks_count").alias("forks_count"), F.col(f"{r}.stargazers_count").alias("stargazers_count"),
        or_blank(f"{r}.default_branch").alias("default_branch"),
    ]


def repo_rows(bodies: DataFrame, body: str) -> DataFrame:
    """Repository records of webhook bodies; bodies without a repository, and texts that are no JSON, have none. Other columns stay."""
    others = [c for c in bodies.columns if c != body]
    parsed = parse(bodies, body, REPO_BODY).filter("b.repository IS NOT NULL")
    return parsed.select(*others, *repo_record())


def human_message(kind: Column, channel: Column, subtype: Column, kinds=("reaction_added", "message")) -> Column:
    """Whether a chat event is a reaction or message of a person in a public channel."""
    return F.coalesce(channel.startswith("C") & (F.coalesce(subtype, F.lit("")) != "bot_message") & kind.isin(*kinds), F.lit(False))


def with_channel_names(rows: DataFrame, channels: DataFrame) -> DataFrame:
    """Adds `channel_name` from `channels` (channel, channel_name); null where the channel is unknown."""
    known = channels.groupBy("channel").agg(F.min("channel_name").alias("channel_name"))
    return lookup_join(rows, known, ["channel"], "left")


def merged_to_default(kind: Column, merged_at: Column, base: Column, default: Column, wanted: str = "PullRequestEvent") -> Column:
    """Whether an event is a pull request that was merged into the default branch."""
    return (kind == wanted) & merged_at.isNotNull() & base.eqNullSafe(default)


def exclude_accounts(rows: DataFrame, own: list[str], author: str, reply_to: str) -> DataFrame:
    """Found tweets without those of the own accounts; a reply is kept as such only if it answers one of them."""
    others = rows.filter(~F.coalesce(F.col(author).isin(*own), F.lit(False)))
    return others.withColumn(reply_to, F.when(F.col(reply_to).isin(*own), F.col(reply_to)))


def found_tweets(rows: DataFrame, own: list[str], author: str = "user_screen_name") -> DataFrame:
    """One struct `tweet` per found tweet as it is landed: own accounts' tweets left out, the author not kept."""
    kept = exclude_accounts(rows, own, author, "reply_to")
    return kept.select(F.struct("tweet_id", "created_at", "text", "is_retweet", "favorite_count", "retweet_count", "language", "hashtags", "place",
                                "reply_to").alias("tweet"))


def emoji_rows(parsed: DataFrame, channels: DataFrame | None = None) -> DataFrame:
    """Emoji uses in public-channel reactions and messages, one row each; bots are ignored.

    `channels` (channel, channel_name) adds names; without it they are null.
    """
    event = parsed.select("b.*").withColumn(
        "channel", F.coalesce("event.channel", "event.item.channel", F.lit("")))
    kept = event.filter(human_message(F.col("event.type"), F.col("channel"), F.col("event.subtype")))
    inside = nested_elements(F.coalesce("event.blocks", F.array()), lambda x: x["type"] == "emoji")
    names = F.when(F.col("event.type") == "reaction_added", F.array("event.reaction")) \
        .otherwise(F.transform(inside, lambda x: x["name"]))
    rows = kept.select(F.col("event.type").alias("event_type"), "channel", F.col("event_time").alias("event_ts"),
                       "team_id", F.explode(names).alias("emoji")) \
        .withColumn("emoji", strip_modifier("emoji"))
    if channels is None:
        named = rows.withColumn("channel_name", F.lit(None).cast("string"))
    else:
        named = with_channel_names(rows, channels)
    return named.select("event_type", "channel", "channel_name", "event_ts", "team_id", "emoji")


def merged_pulls(parsed: DataFrame, branches: DataFrame) -> DataFrame:
    """Merged pull requests into the default branch of their repository (`branches`: name, default_branch)."""
    pull = parsed.select(
        F.col("b.id").alias("id"), F.col("b.repo.name").alias("name"), F.col("b.type").alias("type"),
        epoch("b.payload.pull_request.merged_at").alias("merged_at"),
        epoch("b.payload.pull_request.created_at").alias("created_at"),
        F.col("b.payload.pull_request.base.ref").alias("base-ref"))
    known = lookup_join(pull, branches.select("name", "default_branch"), ["name"])
    return (known.filter(merged_to_default(F.col("type"), F.col("merged_at"), F.col("base-ref"), F.col("default_branch")))
            .select("id", "name", "type", "merged_at", "created_at", "base-ref", "default_branch"))
