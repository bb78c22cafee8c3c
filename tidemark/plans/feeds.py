"""Source jobs of flat feeds: weather, chat, issues, repositories, tweets, blog, calendar, deployments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.flatten import route, split_dim_fact
from ..operators.joins import new_rows
from ..operators.windows import one_per_key
from ..sources.envelopes import with_meta_time
from .job import job


@job("""ARRAY<STRUCT<location STRING, location_name STRING, time_from BIGINT, time_to BIGINT, precipitation DOUBLE,
        wind_speed DOUBLE, temperature INT, air_pressure DOUBLE>>""",
     partitions={"yr_weather": ["location_name"]})
def weather(envelopes, context):
    return {"yr_weather": with_meta_time(envelopes)}


@job("""ARRAY<STRUCT<event_type STRING, channel STRING, channel_name STRING, event_ts BIGINT, team_id STRING,
        emoji STRING>>""", partitions={"slack_emoji": ["event_type"]})
def emoji(envelopes, context):
    return {"slack_emoji": with_meta_time(envelopes, as_float=True)}


@job("ARRAY<STRUCT<issue STRING, customer STRING, issue_status STRING, created BIGINT, updated BIGINT>>",
     partitions={"jira_issue_created": ["issue_status"], "jira_issue_updated": ["issue_status"]}, parse_once=True)
def sales_issues(envelopes, context):
    rows = envelopes.select(F.inline("data"), F.col("metadata.timestamp").cast("long").alias("time"),
                            F.col("metadata.event_type").alias("event_type"))
    return route(rows, "event_type", {"jira_issue_created": ["issue_created", "both"],
                                      "jira_issue_updated": ["issue_updated", "both"]})


REPO = """ARRAY<STRUCT<id BIGINT, name STRING, description STRING, url STRING, html_url STRING, owner STRING,
    created_at BIGINT, updated_at BIGINT, pushed_at BIGINT, language STRING, forks_count BIGINT,
    stargazers_count BIGINT, default_branch STRING>>"""


@job(REPO, partitions={"github_repos": ["language", "default_branch"], "github_repo_status": []}, parse_once=True)
def repositories(envelopes, context):
    rows = with_meta_time(envelopes)
    fresh = new_rows(rows, context.existing("github_repos"), ["id"])
    repos, status = split_dim_fact(
        fresh,
        ["id", "name", "description", "url", "html_url", "owner", "created_at", "language", "default_branch", "time"],
        ["id", "updated_at", "pushed_at", "forks_count", "stargazers_count", "time"])
    if context.options.get("status_all"):
        status = rows.select(*status.columns)
    return {"github_repos": repos, "github_repo_status": status}


@job("""STRUCT<search ARRAY<STRUCT<tweet_id BIGINT, created_at BIGINT, text STRING, is_retweet BOOLEAN,
        favorite_count BIGINT, retweet_count BIGINT, language STRING, hashtags STRING, place STRING,
        reply_to STRING>>,
      timeline ARRAY<STRUCT<tweet_id BIGINT, created_at BIGINT, user_screen_name STRING, text STRING,
        is_retweet BOOLEAN, favorite_count BIGINT, retweet_count BIGINT, language STRING, hashtags STRING,
        mentions STRING, user_name STRING>>,
      accounts ARRAY<STRUCT<user_id BIGINT, screen_name STRING, name STRING, statuses_count BIGINT,
        followers_count BIGINT, favourites_count BIGINT, friends_count BIGINT, listed_count BIGINT>>>""",
     partitions={"twitter_timeline": ["user_screen_name"], "twitter_account_status_update": ["screen_name"]},
     parse_once=True)
def tweets(envelopes, context):
    # The same tweet found by two search terms is one tweet.
    search = envelopes.select(F.inline("data.search")).transform(one_per_key, ["tweet_id"])
    timeline = envelopes.select(F.inline("data.timeline"))
    accounts = envelopes.select(F.inline("data.accounts"), F.col("metadata.timestamp").cast("long").alias("time"))
    return {
        "twitter_tweets": new_rows(search, context.existing("twitter_tweets"), ["tweet_id"]),
        "twitter_timeline": new_rows(timeline, context.existing("twitter_timeline"), ["tweet_id"]),
        "twitter_account_status_update": accounts,
    }


@job("""ARRAY<STRUCT<medium_id STRING, author_name STRING, author_username STRING, title STRING, created_at BIGINT,
        updated_at BIGINT, first_published_at BIGINT, latest_published_at BIGINT, word_count BIGINT,
        reading_time DOUBLE, total_claps BIGINT, total_unique_claps BIGINT, language STRING, url STRING,
        comments_count BIGINT>>""", parse_once=True)
def blog(envelopes, context):
    posts, updates = split_dim_fact(
        with_meta_time(envelopes),
        ["medium_id", "author_name", "author_username", "title", "created_at", "first_published_at", "word_count",
         "reading_time", "url", "language"],
        ["medium_id", "updated_at", "latest_published_at", "total_claps", "total_unique_claps", "comments_count",
         "time"])
    return {"blog_posts": new_rows(posts, context.existing("blog_posts"), ["medium_id"]), "blog_updates": updates}


@job("""ARRAY<STRUCT<event_id STRING, calendar_id STRING, timestamp_from BIGINT, timestamp_to BIGINT,
        event_summary STRING, event_button_names ARRAY<STRING>, creator STRING>>""")
def calendar(envelopes, context):
    return {"google_calendar_events": with_meta_time(envelopes)}


@job("""ARRAY<STRUCT<id STRING, name STRING, type STRING, merged_at BIGINT, created_at BIGINT, `base-ref` STRING,
        default_branch STRING>>""", partitions={"github_dora_repos": ["name"]})
def deployments(envelopes, context):
    rows = with_meta_time(envelopes)
    return {"github_dora_repos": rows.select("name", "id", "type", "merged_at", "created_at", "`base-ref`")}
