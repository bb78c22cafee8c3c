"""§ source jobs: landed envelopes built from the test tables, run through each job into a fresh store."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import presto as P
from ..plans import feeds, people, uploads
from ..plans.job import Context
from ..session import new_folder
from ..sources import documents as docs
from ..sources.envelopes import read_envelopes, wrap, write_envelopes
from ..sources.webhooks import CHAT_BODY, PULL_BODY, emoji_rows, found_tweets, merged_pulls, repo_rows
from ..tables.store import TableStore
from .cleansing import json_value
from .registry import query
from .scans import FORECAST_SQL, forecast_xml, issue_bodies
from ..sources.webhooks import issue_record

NOW = datetime(2024, 2, 1, 12, tzinfo=timezone.utc)


def context(t, **options) -> Context:
    return Context(t.spark, NOW, TableStore(t.spark, new_folder(t.spark, "zone")), options)


def text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def directory(t):
    """Customers as known people, those of nation 3 unknown."""
    return t.customer.filter("c_nationkey <> 3").select(
        F.sha1(F.encode("c_name", "utf-8")).alias("guid"),
        F.concat(F.lit("c"), text("c_custkey"), F.lit("@x.org")).alias("email"),
        F.concat(F.lit("a"), text("c_custkey")).alias("alias"), F.col("c_name").alias("displayName"),
        F.lit("").alias("manager"), F.lit("").alias("manager_email"))


@query("p_weather", f"""
    SELECT *, CAST(50 AS BIGINT) AS time FROM ({FORECAST_SQL})""")
def p_weather(t):
    place = F.concat(F.lit("p/"), text("user_id"))
    rows = docs.forecast_texts(t.spread("events"), forecast_xml(), place).withColumn("wind_speed", F.round("wind_speed", 2))
    c = context(t)
    feeds.weather.run(wrap(rows, F.array(F.struct(*rows.columns)), F.lit(50.7)), c)
    return c.store.read("yr_weather")


def chat_bodies(t):
    """Each event as a chat webhook body: reactions, messages with emoji blocks, and noise."""
    piece = lambda kind, name: F.struct(F.lit(kind).alias("type"), name.alias("name"))
    inner = F.array(piece("emoji", F.concat(F.lit("e"), text("user_id"), F.lit("::skin-tone-3"))),
                    piece("text", F.lit("x")), piece("emoji", F.col("event_type")))
    blocks = F.array(F.struct(F.array(F.struct(inner.alias("elements"))).alias("elements")))
    reaction = F.col("event_type") == "click"
    channel = F.concat(F.when(F.col("event_type") == "error", "D").otherwise("C"), text("user_id"))
    body = F.to_json(F.struct(
        F.lit("T1").alias("team_id"), F.lit("event_callback").alias("type"),
        F.floor(F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("event_time"),
        F.struct(
            F.when(reaction, "reaction_added").when(F.col("event_type") == "signup", "other").otherwise("message").alias("type"),
            F.when(~reaction, channel).alias("channel"),
            F.when(F.col("user_id") == 5, "bot_message").alias("subtype"),
            F.when(reaction, F.concat(F.lit("r"), text("user_id"))).alias("reaction"),
            F.struct(F.when(reaction, channel).alias("channel")).alias("item"),
            F.when(~reaction, blocks).alias("blocks")).alias("event")))
    return t.events.select("event_id", body.alias("body"))


EMOJI_SQL = """
    SELECT CASE WHEN event_type = 'click' THEN 'reaction_added' ELSE 'message' END AS event_type,
           'C' || user_id AS channel, CASE WHEN user_id < 50 THEN 'name ' || user_id END AS channel_name,
           CAST(floor(epoch(ts)) AS BIGINT) AS event_ts, 'T1' AS team_id, emoji
    FROM (SELECT *, unnest(CASE WHEN event_type = 'click' THEN ['r' || user_id] ELSE ['e' || user_id, event_type] END) AS emoji
          FROM events WHERE event_type NOT IN ('error', 'signup') AND user_id <> 5)"""


def channel_names(t):
    return t.events.filter("user_id < 50").select("user_id").distinct().select(
        F.concat(F.lit("C"), text("user_id")).alias("channel"),
        F.concat(F.lit("name "), text("user_id")).alias("channel_name"))


@query("p_emoji", f"SELECT *, CAST(7.5 AS DOUBLE) AS time FROM ({EMOJI_SQL})")
def p_emoji(t):
    parsed = chat_bodies(t).select(F.from_json("body", CHAT_BODY).alias("b"))
    rows = emoji_rows(parsed, channel_names(t))
    path, c = new_folder(t.spark, "raw"), context(t)
    write_envelopes(wrap(rows, F.array(F.struct(*rows.columns)), F.lit(7.5)), path)
    feeds.emoji.run(read_envelopes(t.spark, path, feeds.emoji.payload), c)
    return c.store.read("slack_emoji")


@query("p_sales_issues", """
    SELECT target, issue, customer, issue_status, created, updated, CAST(9 AS BIGINT) AS time FROM (
      SELECT event_type, 'K-' || event_id AS issue, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'c' || user_id END AS customer,
             CAST(props->>'$.k' AS VARCHAR) AS issue_status, CAST(floor(epoch(ts)) AS BIGINT) AS created,
             CAST(floor(epoch(ts)) AS BIGINT) + 3600 AS updated FROM events)
    JOIN (VALUES ('click', 'created'), ('view', 'updated'), ('purchase', 'created'), ('purchase', 'updated')) r(kind, target)
      ON kind = event_type""")
def p_sales_issues(t):
    rows = issue_bodies(t).select(*issue_record())
    kind = F.when(F.col("event_type") == "click", "issue_created").when(F.col("event_type") == "view", "issue_updated") \
        .when(F.col("event_type") != "purchase", "deleted")
    record = F.struct("issue", "customer", "issue_status", "created", "updated")
    path, c = new_folder(t.spark, "raw"), context(t)
    # Webhooks land one object, polls a list: both forms are read.
    write_envelopes(wrap(rows.filter("event_type = 'click'"), record, F.lit(9.9), kind), path)
    write_envelopes(wrap(rows.filter("event_type <> 'click'"), F.array(record), F.lit(9.9), kind), path)
    feeds.sales_issues.run(read_envelopes(t.spark, path, feeds.sales_issues.payload), c)
    return c.store.read("jira_issue_created").withColumn("target", F.lit("created")).unionByName(
        c.store.read("jira_issue_updated").withColumn("target", F.lit("updated")))


@query("p_repos", """
    SELECT 'repos' AS "table", c_custkey AS id, coalesce(nullif(c_mktsegment, 'BUILDING'), 'undefined') AS detail,
           CASE WHEN c_nationkey < 10 THEN 1 ELSE 2 END AS time FROM customer
    UNION ALL SELECT 'status', c_custkey, CAST(c_nationkey AS VARCHAR), CASE WHEN c_nationkey < 10 THEN 1 ELSE 2 END
    FROM customer""")
def p_repos(t):
    """A first poll of some repositories, then a webhook body for each: the known ones are skipped."""
    rows = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_name").alias("description"),
        F.lit("u").alias("url"), F.lit("h").alias("html_url"), F.lit("o").alias("owner"),
        F.lit(1).cast("bigint").alias("created_at"), F.lit(2).cast("bigint").alias("updated_at"),
        F.lit(3).cast("bigint").alias("pushed_at"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("language"),
        F.col("c_nationkey").cast("bigint").alias("forks_count"), F.lit(5).cast("bigint").alias("stargazers_count"),
        F.lit("main").alias("default_branch"))
    landed = lambda df, at: wrap(df, F.array(F.struct(*rows.columns)), F.lit(at))
    c = context(t)
    feeds.repositories.run(landed(rows.filter("forks_count < 10"), 1), c)
    moment = lambda n: F.lit(f"1970-01-01T00:00:0{n}Z")
    sent = rows.select(F.to_json(F.struct(F.lit("push").alias("action"), F.struct(
        "id", "name", "description", "url", "html_url", F.struct(F.col("owner").alias("login")).alias("owner"), moment(1).alias("created_at"),
        moment(2).alias("updated_at"), moment(3).alias("pushed_at"), "language", "forks_count", "stargazers_count", "default_branch").alias("repository"))).alias("body"))
    noise = t.region.select(F.when(F.col("r_regionkey") % 2 == 0, "{}").otherwise("no json").alias("body"))
    webhooks = repo_rows(sent.unionByName(noise), "body").withColumn("language", F.nullif("language", F.lit("")))
    feeds.repositories.run(landed(webhooks.select(*rows.columns), 2), c)
    repos = c.store.read("github_repos").select(F.lit("repos").alias("table"), "id", F.col("language").alias("detail"),
                                                F.col("time").cast("int").alias("time"))
    return repos.unionByName(c.store.read("github_repo_status").select(
        F.lit("status").alias("table"), "id", text("forks_count").alias("detail"), F.col("time").cast("int").alias("time")))


OWN = ["src3", "src7"]


@query("p_tweets", """
    SELECT 'tweets' AS "table", doc_id AS id, starts_with(text, 'The') AS is_retweet, source AS account,
           CASE WHEN doc_id % 3 = 0 THEN 'src7' END AS reply_to, 0 AS time FROM documents WHERE source IS NULL OR source NOT IN ('src3', 'src7')
    UNION ALL SELECT 'timeline', doc_id, starts_with(text, 'The'), source, NULL, 0 FROM documents WHERE source IN ('src3', 'src7')
    UNION ALL SELECT 'accounts', c_custkey, NULL, c_mktsegment, NULL, 4 FROM customer""")
def p_tweets(t):
    """Documents as tweets, landed twice and found by two searches each: every tweet is stored once. Tweets of the two own accounts are found, too, but
    only their timelines are stored, and replies count as such only if they answer one of them.
    """
    stamp, none = F.lit(1).cast("bigint"), F.lit(None).cast("string")
    both = t.documents.select(
        F.col("doc_id").alias("tweet_id"), stamp.alias("created_at"), "text", C.prefix_flag("text", "The").alias("is_retweet"),
        stamp.alias("favorite_count"), stamp.alias("retweet_count"), F.col("lang").alias("language"), none.alias("hashtags"),
        F.col("source").alias("place"), F.when(F.col("doc_id") % 3 == 0, "src7").otherwise("src1").alias("reply_to"), F.col("source").alias("user_screen_name"))
    payload = feeds.tweets.payload
    landed = lambda df, part: wrap(df, F.from_json(F.to_json(F.struct(part)), payload), F.lit(4))
    search = lambda df: landed(found_tweets(df, OWN), F.array("tweet", "tweet").alias("search"))
    timeline = F.array(F.struct("tweet_id", "created_at", "user_screen_name", "text", "is_retweet", "favorite_count", "retweet_count", "language",
                                F.lit("h").alias("hashtags"), F.lit("m").alias("mentions"), F.lit("n").alias("user_name")))
    accounts = landed(t.customer, F.array(F.struct(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("screen_name"), F.col("c_name").alias("name"),
        *[stamp.alias(x) for x in ("statuses_count", "followers_count", "favourites_count", "friends_count", "listed_count")])).alias("accounts"))
    own = landed(both.filter(F.col("user_screen_name").isin(*OWN)), timeline.alias("timeline"))
    c = context(t)
    feeds.tweets.run(search(both.filter("language = 'en'")), c)
    feeds.tweets.run(search(both).unionByName(own).unionByName(accounts), c)
    columns = lambda name, key, retweet, account, reply, time: c.store.read(name).select(
        F.lit(name.split("_")[1]).alias("table"), F.col(key).alias("id"), retweet.alias("is_retweet"), F.col(account).alias("account"), reply.alias("reply_to"),
        time.cast("int").alias("time"))
    out = columns("twitter_tweets", "tweet_id", F.col("is_retweet"), "place", F.col("reply_to"), F.lit(0))
    out = out.unionByName(columns("twitter_timeline", "tweet_id", F.col("is_retweet"), "user_screen_name", none, F.lit(0)))
    return out.unionByName(columns("twitter_account_status_update", "user_id", F.lit(None).cast("boolean"), "screen_name", none, F.col("time")).withColumn(
        "table", F.lit("accounts")))


MARKER = '// data\nwindow["init"]('


def blog_pages(t):
    """Each page gets a script block with its posts and authors, as blog archives carry them."""
    post = lambda n: F.struct(
        F.concat(text("page_id"), F.lit(f"-{n}")).alias("id"), F.lit(f"u{n}").alias("creatorId"),
        F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"),
        *[(F.col("page_id") * 1000 + 999).alias(x) for x in ("createdAt", "updatedAt", "firstPublishedAt",
                                                             "latestPublishedAt")],
        F.lit("no").alias("detectedLanguage"), F.concat(F.lit("s-"), text("page_id")).alias("uniqueSlug"),
        F.struct(F.length("html").alias("wordCount"), F.lit(1.5).alias("readingTime"), F.lit(n).alias("totalClapCount"),
                 F.lit(n).alias("recommends"), F.lit(0).alias("responsesCreatedCount")).alias("virtuals"))
    posts = F.map_from_arrays(F.array(F.lit("p1"), F.lit("p2")), F.array(post(1), post(2)))
    users = F.create_map(F.lit("u1"), F.struct(F.col("url").alias("name"), F.lit("ann").alias("username")))
    block = F.to_json(F.struct(F.struct(users.alias("User"), posts.alias("Post")).alias("references")))
    return t.pages.select("page_id", F.concat("html", F.lit("<script>" + MARKER), block, F.lit(")\n// ]]></script>"))
                          .alias("html"))


@query("p_blog_posts", r"""
    WITH p AS (SELECT *, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages),
    posts AS (SELECT page_id || '-' || n AS medium_id, CASE n WHEN 1 THEN url ELSE '' END AS author_name, title,
                     page_id AS created_at, CAST(length(html) AS BIGINT) AS word_count, 'https://b.example.org/s-' || page_id AS url
              FROM p, (VALUES (1), (2)) v(n))
    SELECT 'posts' AS "table", * FROM posts
    UNION ALL SELECT 'updates', medium_id, NULL, NULL, created_at, NULL, NULL FROM posts
    UNION ALL SELECT 'updates', medium_id, NULL, NULL, created_at, NULL, NULL FROM posts""")
def p_blog_posts(t):
    rows = docs.blog_posts(blog_pages(t), "html", MARKER, "https://b.example.org")
    landed = lambda at: wrap(rows, F.array(F.struct(*rows.columns)), F.lit(at))
    c = context(t)
    feeds.blog.run(landed(1), c)
    feeds.blog.run(landed(2), c)
    posts = c.store.read("blog_posts").select(
        F.lit("posts").alias("table"), "medium_id", "author_name", "title", "created_at", "word_count", "url")
    updates = c.store.read("blog_updates").select(F.lit("updates").alias("table"), "medium_id",
                                                  F.col("updated_at").alias("created_at"))
    return posts.unionByName(updates, allowMissingColumns=True)


@query("p_calendar", """
    SELECT 'e' || event_id AS event_id, event_type AS calendar_id, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp_from,
           CAST(epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS BIGINT) + 86400 AS timestamp_to,
           CASE WHEN user_id = 5 THEN '' ELSE 's' || user_id END AS event_summary, 'u' || user_id || ';x' AS buttons,
           '' AS creator, CAST(3 AS BIGINT) AS time FROM events""")
def p_calendar(t):
    ts = F.col("ts").cast("timestamp")
    start = F.struct(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("dateTime"), F.lit(None).cast("string").alias("date"))
    end = F.struct(F.lit(None).cast("string").alias("dateTime"), F.date_format(F.date_add(ts, 1), "yyyy-MM-dd").alias("date"))
    place = F.concat(F.lit("Oslo,Enheter-1-u"), text("user_id"), F.lit(",Enheter-x,Room-2"))
    named = t.events.withColumns({"start": start, "end": end})
    record = F.struct(F.concat(F.lit("e"), text("event_id")).alias("event_id"), F.col("event_type").alias("calendar_id"),
                      C.start_or_date("start").alias("timestamp_from"), C.start_or_date("end").alias("timestamp_to"),
                      F.coalesce(F.when(F.col("user_id") != 5, F.concat(F.lit("s"), text("user_id"))), F.lit(""))
                      .alias("event_summary"), C.location_units(place).alias("event_button_names"), F.lit("").alias("creator"))
    c = context(t)
    feeds.calendar.run(wrap(named, F.array(record), F.lit(3.2)), c)
    return c.store.read("google_calendar_events").withColumn("buttons", F.array_join("event_button_names", ";")) \
        .drop("event_button_names")


@query("p_deployments", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'org/' || lower(o_orderpriority[1]) AS name, 'PullRequestEvent' AS type,
           CAST(epoch(o_orderdate) AS BIGINT) AS merged_at, CAST(epoch(o_orderdate) AS BIGINT) AS created_at, 'main' AS "base-ref"
    FROM orders WHERE o_orderstatus = 'F'""")
def p_deployments(t):
    at = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX")
    name = F.concat(F.lit("org/"), F.lower(F.substring("o_orderpriority", 1, 1)))
    body = F.to_json(F.struct(
        text("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") != "X", "PullRequestEvent").alias("type"),
        F.struct(name.alias("name")).alias("repo"), F.struct(F.struct(
            F.when(F.col("o_orderstatus") != "P", at).alias("merged_at"), at.alias("created_at"),
            F.struct(F.when(F.col("o_orderstatus") == "O", "topic").otherwise("main").alias("ref")).alias("base"))
            .alias("pull_request")).alias("payload")))
    branches = t.orders.select(name.alias("name")).distinct().withColumn("default_branch", F.lit("main"))
    rows = merged_pulls(t.orders.select(F.from_json(body, PULL_BODY).alias("b")), branches)
    c = context(t)
    feeds.deployments.run(wrap(rows, F.array(F.struct(*[f"`{x}`" for x in rows.columns])), F.lit(1)), c)
    return c.store.read("github_dora_repos")


# -- people ------------------------------------------------------------------------------


@query("p_directory", """
    SELECT sha1('a' || c_custkey) AS guid, 'c' || c_custkey || '@x.org' AS email, c_name AS "displayName", 'a' || c_custkey AS alias,
           c_mktsegment AS company, '' AS branch, c_name AS distinguished_name,
           CASE WHEN boss.k IS NULL THEN '' ELSE boss.n END AS manager,
           CASE WHEN boss.k IS NULL THEN '' ELSE 'c' || boss.k || '@x.org' END AS manager_email
    FROM customer c LEFT JOIN (SELECT c_custkey AS k, c_name AS n FROM customer) boss ON boss.k = c.c_custkey // 10 - 1
    WHERE c_nationkey > 2""")
def p_directory(t):
    """Accounts with the tenth of their key as manager; nations 0 to 2 are service, external, deleted."""
    dn = lambda key: F.concat(F.lit("CN=Customer#"), F.lpad(text(key), 9, "0"), F.lit(",OU=all"))
    users = t.customer.select(
        F.concat(F.lit("c"), text("c_custkey"), F.lit("@x.org")).alias("primaryEmailAddress"),
        F.col("c_name").alias("displayName"), F.concat(F.lit("a"), text("c_custkey")).alias("samAccountName"),
        F.col("c_mktsegment").alias("company"), F.lit(None).cast("string").alias("branch"),
        dn("c_custkey").alias("distinguishedName"),
        dn(F.expr("c_custkey div 10 - 1")).alias("managerDistinguishedName"),
        (F.col("c_nationkey") == 0).alias("isServiceUser"), (F.col("c_nationkey") == 1).alias("isExternalUser"),
        (F.col("c_nationkey") == 2).alias("isDeleted"))
    store = TableStore(t.spark, new_folder(t.spark, "zone"))
    store.write(people.directory(users), "person_directory", overwrite=True)
    return store.read("person_directory")


@query("p_directory_tables", """
    SELECT 'active_directory' AS "table", sha1(c_name) AS guid, CAST(NULL AS BIGINT) AS n FROM customer WHERE c_nationkey <> 3
    UNION ALL SELECT 'ad_number_of_employees', NULL, count(*) FROM customer WHERE c_nationkey <> 3
    UNION ALL SELECT 'ad_number_of_employees', NULL, count(*) FROM customer WHERE c_nationkey <> 3""")
def p_directory_tables(t):
    c = context(t, directory=directory(t))
    trigger = wrap(t.region.agg(F.count(F.lit(1))), F.struct(F.lit("").alias("trigger")), F.lit(0))
    for _ in range(2):
        people.directory_tables.run(trigger, c)
    n = c.store.read("ad_number_of_employees").select(
        F.lit("ad_number_of_employees").alias("table"), F.lit(None).cast("string").alias("guid"),
        F.col("number_of_employees").alias("n"))
    return c.store.read("active_directory").select(
        F.lit("active_directory").alias("table"), "guid", F.lit(None).cast("bigint").alias("n")).unionByName(n)


def hours_records(t, flags: str):
    """Order lines as worked hours; the order's ISO week is the period, unpadded as the feed has it."""
    period = F.concat(text(P.iso_year("o_orderdate")), text(P.iso_week("o_orderdate")))
    return t.lineitem.filter(F.col("l_returnflag").isin(*flags)).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")) \
        .select(F.array(F.struct(
            F.lit("B").alias("tab"), period.alias("reg_period"), text("l_quantity").alias("used_hrs"),
            F.concat(F.lit("A"), text("o_custkey")).alias("resource_id"), F.col("o_orderpriority").alias("xr1project"),
            F.concat_ws("/", text("l_orderkey"), text("l_linenumber"), text("l_partkey")).alias("work_order"),
            F.concat(F.lit("w"), text("l_linenumber")).alias("xwork_order"),
            F.concat(F.lit("s"), text("l_suppkey")).alias("xr0work_order"))).alias("data"))


HOURS_SQL = """
    h AS (SELECT isoyear(o_orderdate) || CAST(week(o_orderdate) AS VARCHAR) AS reg_period,
                 isoyear(o_orderdate) * 100 + week(o_orderdate) AS code, l_quantity AS used_hrs, 'a' || o_custkey AS alias,
                 o_orderpriority AS project_type, l_orderkey || '/' || l_linenumber || '/' || l_partkey AS work_order,
                 'w' || l_linenumber AS work_order_description, 's' || l_suppkey AS customer, c_nationkey, c_name,
                 CASE l_returnflag WHEN 'A' THEN 'A' ELSE 'R' END AS l_returnflag
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, alias
                 ORDER BY used_hrs DESC, work_order, project_type, reg_period) AS weigth FROM h),
    known AS (SELECT * FROM ranked WHERE c_nationkey <> 3),
    kept AS (SELECT * FROM known WHERE l_returnflag = 'A'
               AND code IN (SELECT DISTINCT code FROM known WHERE l_returnflag = 'A' ORDER BY code DESC LIMIT 4)),
    both_runs AS (SELECT *, 200 AS time FROM known WHERE l_returnflag = 'R' UNION ALL SELECT *, 100 FROM kept),
    one AS (SELECT *, row_number() OVER (PARTITION BY reg_period, alias, project_type, work_order, work_order_description,
              customer, weigth ORDER BY time DESC) AS n FROM both_runs)"""


def run_hours(t):
    c = context(t)
    for flags, at in (("A", 100), ("NR", 200)):
        people.hours_per_resource.run(wrap(hours_records(t, flags), F.col("data"), F.lit(at)), c, directory(t))
    return c.store


@query("p_hours_per_resource", f"""
    WITH {HOURS_SQL} SELECT reg_period, alias, project_type, work_order, work_order_description, customer,
           CAST(time AS BIGINT) AS time, weigth, sha1(c_name) AS guid FROM one WHERE n = 1""")
def p_hours_per_resource(t):
    return run_hours(t).read("ubw_customer_per_resource")


@query("p_hours_per_project", f"""
    WITH {HOURS_SQL}, per AS (
      SELECT l_returnflag, customer, work_order_description AS work_order, reg_period, sum(used_hrs) AS hours FROM h
      WHERE l_returnflag IN ('A', 'R') GROUP BY ALL),
    heads AS (SELECT l_returnflag, customer, work_order_description AS work_order, count(DISTINCT alias) AS employees FROM h
              GROUP BY ALL)
    SELECT per.customer, employees, hours, reg_period, CAST(CASE per.l_returnflag WHEN 'A' THEN 100 ELSE 200 END AS BIGINT)
           AS timestamp, per.work_order FROM per JOIN heads ON per.l_returnflag = heads.l_returnflag
      AND per.customer = heads.customer AND per.work_order = heads.work_order""")
def p_hours_per_project(t):
    return run_hours(t).read("ubw_per_project_data")


@query("p_experience", """
    SELECT 'a' || c_custkey AS alias, c_name AS name, CAST(CASE WHEN c_nationkey < 8 THEN 0 ELSE 2024 - (1980 + c_nationkey) END
           AS INTEGER) AS experience, CASE WHEN c_nationkey < 4 THEN NULL WHEN c_nationkey < 8 THEN '0'
           ELSE CAST(1980 + c_nationkey AS VARCHAR) END AS examination_year, c_mktsegment AS grade,
           CAST(NULL AS VARCHAR) AS start_year FROM customer""")
def p_experience(t):
    year = F.when(F.col("c_nationkey") < 4, None).when(F.col("c_nationkey") < 8, "0").otherwise(text(1980 + F.col("c_nationkey")))
    record = F.struct(F.concat(F.lit("a"), text("c_custkey")).alias("resource_id"), F.col("c_name").alias("name"),
                      year.alias("r0_x0023_exami0_x0023_612"), F.col("c_mktsegment").alias("xr0_x0023_e1_x0023_611_x0023_U00"),
                      F.lit(None).cast("string").alias("date_from"))
    c = context(t)
    people.experience.run(wrap(t.customer, F.array(record), F.lit(1)), c)
    return c.store.read("ubw_experience")


@query("p_activity_hours", """
    SELECT reg_period, CAST(min(time) AS DOUBLE) AS time, min(used_hrs) AS used_hrs FROM (
      SELECT isoyear(ts) || CAST(week(ts) AS VARCHAR) AS reg_period, CAST(value AS VARCHAR) AS used_hrs, 8.5 AS time, *
      FROM events WHERE event_type <> 'view' AND isoyear(ts) * 52 + week(ts) <= 2024 * 52 + 8 - 4)
    GROUP BY reg_period""")
def p_activity_hours(t):
    record = t.events.select(
        F.when(F.col("event_type") == "view", "N").otherwise("B").alias("tab"),
        F.concat(text(P.iso_year("ts")), text(P.iso_week("ts"))).alias("reg_period"), text("value").alias("used_hrs"))
    closed = people.closed_hours(record, datetime(2024, 2, 20))
    landed = lambda at: wrap(closed, F.array(F.struct("tab", "reg_period", "used_hrs")), F.lit(at))
    c = context(t)
    people.activity_hours.run(landed(8.5), c)
    people.activity_hours.run(landed(9.5), c)
    return c.store.read("ubw_fagtimer")


def cv_envelopes(t):
    """Customers as CVs; section lengths vary with the nation, so some sections are empty or missing."""
    no = lambda c: F.struct((F.lit(c) if isinstance(c, str) else c).alias("no"))
    seg, key = F.col("c_mktsegment"), F.col("c_nationkey")
    count = F.sequence(F.lit(1), key % 4 + 1)
    some = lambda f: F.when(key != 7, F.filter(F.transform(count, f), lambda x: key % 4 > 0))
    span = lambda i: [text(i).alias("month_from"), F.lit("x").alias("month_to"), text(2000 + i).alias("year_from"),
                      F.lit(None).cast("string").alias("year_to")]
    skills = F.array(F.struct(no(seg).alias("tags")), F.struct(F.struct(F.lit(None).cast("string").alias("no")).alias("tags")))
    cv = F.struct(
        F.col("c_name").alias("navn"), F.concat(F.lit("c"), text("c_custkey"), F.lit("@x.org")).alias("email"),
        F.lit(None).cast("string").alias("telefon"), text(1950 + key).alias("born_year"),
        F.struct(F.lit("nor").alias("int")).alias("nationality"),
        F.struct(F.lit(None).cast("string").alias("int")).alias("place_of_residence"), F.lit("@t").alias("twitter"),
        no(seg).alias("title"),
        some(lambda i: F.struct(no(F.concat(seg, text(i))).alias("degree"), no("d").alias("description"),
                                F.struct(F.lit(None).cast("string").alias("no")).alias("school"), *span(i))).alias("educations"),
        some(lambda i: F.struct(no("l").alias("long_description"), text(i).alias("month"), no("b").alias("name"),
                                F.lit("u").alias("url"), F.lit("2001").alias("year"))).alias("blogs"),
        some(lambda i: F.struct(no("l").alias("long_description"), no(seg).alias("name"), no("p").alias("program"),
                                text(i).alias("year"))).alias("courses"),
        some(lambda i: F.struct(no("l").alias("long_description"), no(text(i)).alias("label"), no("t").alias("tag_line")))
        .alias("key_qualifications"),
        some(lambda i: F.struct(no(F.concat(F.lit("lang"), text(i))).alias("name"), no("good").alias("level"))).alias("languages"),
        some(lambda i: F.struct(no(seg).alias("customer"), no("d").alias("description"), no("l").alias("long_description"),
                                no("i").alias("industry"), skills.alias("project_experience_skills"),
                                F.array(F.struct(no(text(i)).alias("name"))).alias("roles"),
                                F.lit("50.9").alias("percent_allocated"), span(i)[2], span(i)[3], span(i)[0], span(i)[1]))
        .alias("project_experiences"),
        some(lambda i: F.struct(no(F.concat(F.lit("cat"), text(i))).alias("category"), skills.alias("technology_skills")))
        .alias("technologies"),
        some(lambda i: F.struct(no("d").alias("description"), no(seg).alias("employer"), no("l").alias("long_description"),
                                *span(i))).alias("work_experiences"))
    person = F.struct(text("c_custkey").alias("user_id"), text("c_custkey").alias("default_cv_id"),
                      C.cv_link("https://cv.example.com", "c_custkey", "c_custkey").alias("cv_link"),
                      F.lit(None).cast("string").alias("image_key"), cv.alias("cv"))
    return wrap(t.spread("customer"), F.array(person), F.lit(1))


@query("p_employees_cv", """
    WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS seg, c_name, c_nationkey AS k FROM customer),
    s AS (SELECT *, unnest(range(1, k % 4 + 2)) AS i FROM c WHERE k % 4 > 0 AND k <> 7)
    SELECT 'employees' AS "table", user_id, c_name || '|c' || user_id || '@x.org||' || (1950 + k) || '|nor||@t|' || seg || '|'
           || 'https://cv.example.com/' || user_id || '/' || user_id || '/{LANG}/{FORMAT}|' || sha1(c_name) AS body
    FROM c WHERE k <> 3
    UNION ALL SELECT 'education', user_id, seg || i || '|d||' || i || '|0|' || (2000 + i) || '|0' FROM s
    UNION ALL SELECT 'blogs', user_id, 'l|' || i || '|b|u|2001' FROM s
    UNION ALL SELECT 'courses', user_id, 'l|' || seg || '|p|' || i FROM s
    UNION ALL SELECT 'key_qualification', user_id, 'l|' || i || '|t' FROM s
    UNION ALL SELECT 'languages', user_id, 'lang' || i || '|good' FROM s
    UNION ALL SELECT 'project_experience', user_id, seg || '|d|l|i|' || seg || ';|' || i || '|50|' || (2000 + i) || '|0|' || i
           || '|0' FROM s
    UNION ALL SELECT 'technology_skills', user_id, 'cat' || i || '|' || seg || ';' FROM s
    UNION ALL SELECT 'work_experience', user_id, 'd|' || seg || '|' || i || '|0|' || (2000 + i) || '|0|l' FROM s""")
def p_employees_cv(t):
    path, c = new_folder(t.spark, "raw"), context(t)
    write_envelopes(cv_envelopes(t), path)
    people.employees_cv.run(read_envelopes(t.spark, path, people.CV), c, directory(t))
    columns = {
        "employees": ["navn", "email", "telefon", "born_year", "nationality", "place_of_residence", "twitter", "title",
                      "link", "guid"],
        "education": ["degree", "description", "school", "month_from", "month_to", "year_from", "year_to"],
        "blogs": ["long_description", "month", "name", "url", "year"],
        "courses": ["long_description", "name", "program", "year"],
        "key_qualification": ["long_description", "label", "tag_line"], "languages": ["name", "level"],
        "project_experience": ["customer", "description", "long_description", "industry", "project_experience_skills",
                               "roles", "percent_allocated", "year_from", "year_to", "month_from", "month_to"],
        "technology_skills": ["category", "technology_skills"],
        "work_experience": ["description", "employer", "month_from", "month_to", "year_from", "year_to", "long_description"],
    }
    out = None
    for name, cells in columns.items():
        part = c.store.read(f"cv_partner_{name}").select(
            F.lit(name).alias("table"), "user_id", F.concat_ws("|", *[text(x) for x in cells]).alias("body"))
        out = part if out is None else out.unionByName(part)
    return out


@query("p_competence", """
    SELECT 'users' AS "table", 'c' || c_custkey || '@x.org' AS id, sha1(c_name) AS detail FROM customer WHERE c_nationkey <> 3
    UNION ALL SELECT 'answers', 'c' || c_custkey || '@x.org', 'q' || i || '|' || (i + 1) || '.0|' || sha1(c_name) FROM
      (SELECT *, unnest(range(1, c_nationkey % 4 + 2)) AS i FROM customer) WHERE c_nationkey <> 3
    UNION ALL SELECT 'catalogs', CAST(r_regionkey AS VARCHAR), r_name FROM region
    UNION ALL SELECT 'questions', 'q' || p_partkey, p_type FROM part
    UNION ALL SELECT 'categories', CAST(n_nationkey AS VARCHAR), n_name FROM nation""")
def p_competence(t):
    email = F.concat(F.lit("c"), text("c_custkey"), F.lit("@x.org"))
    number = lambda c: c.cast("double")
    answer = lambda i: F.struct(F.struct(F.concat(F.lit("q"), text(i)).alias("id")).alias("question"),
                                number(i + 1).alias("knowledge"), number(i).alias("motivation"),
                                F.lit("2024").alias("updatedAt"), F.lit(None).cast("double").alias("customScaleValue"))
    lists = [
        (t.customer, "users", F.struct(F.col("c_name").alias("username"), F.array(F.struct(
            F.lit("email").alias("Name"), email.alias("Value"))).alias("attributes"))),
        (t.customer, "answers", F.struct(F.col("c_name").alias("username"), email.alias("email"), F.transform(
            F.sequence(F.lit(1), F.col("c_nationkey") % 4 + 1), answer).alias("answers"))),
        (t.region, "catalogs", F.struct(text("r_regionkey").alias("id"), F.col("r_name").alias("label"))),
        (t.part, "questions", F.struct(F.concat(F.lit("q"), text("p_partkey")).alias("id"), F.col("p_type").alias("topic"))),
        (t.nation, "categories", F.struct(text("n_nationkey").alias("id"), F.col("n_name").alias("text"))),
    ]
    path, c = new_folder(t.spark, "raw"), context(t)
    for df, name, record in lists:
        write_envelopes(wrap(df, F.struct(F.array(record).alias(name)), F.lit(1)), path)
    people.competence.run(read_envelopes(t.spark, path, people.COMPETENCE), c, directory(t))
    read = lambda name, key, detail: c.store.read(f"competence_{name}").select(
        F.lit(name).alias("table"), F.col(key).alias("id"), detail.alias("detail"))
    return (read("users", "email", F.col("guid"))
            .unionByName(read("answers", "email", F.concat_ws("|", "questionId", text("knowledge"), "guid")))
            .unionByName(read("catalogs", "id", F.col("label")))
            .unionByName(read("questions", "id", F.col("topic")))
            .unionByName(read("categories", "id", F.col("text"))))


# -- uploads -----------------------------------------------------------------------------


def form_envelopes(t):
    """Each turn as a response to a form: a text, a quiz choice, a checkbox list and a grid question."""
    question = lambda title, kind, response, rows, points: F.struct(
        F.lit(title).alias("title"), F.lit("help").alias("helpText"), F.lit(1).cast("bigint").alias("id"),
        F.lit(kind).alias("type"), F.struct(response.alias("response")).alias("answer"),
        F.struct(F.array(*[F.struct(F.lit(v).alias("value"), F.lit(ok).alias("isCorrect"))
                           for v, ok in (("user", True), ("system", False))]).alias("choices"),
                 rows.alias("rows"), F.lit("good").alias("feedbackCorrect"),
                 F.lit(None).cast("string").alias("feedbackIncorrect"), F.lit(points).alias("points")).alias("typeData"))
    none = F.lit(None).cast("array<string>")
    questions = F.array(
        question("t", "TEXT", json_value(F.concat(F.lit('["'), "text")), none, 1),
        question("m", "MULTIPLE_CHOICE", json_value(F.col("role")), none, 5),
        question("c", "CHECKBOX", json_value(F.array("role", F.lit("user"))), none, 7),
        question("g", "CHECKBOX_GRID", json_value(F.array(F.array("role", F.lit("[x")), F.array(F.lit('"y')))),
                 F.array(F.lit("r1"), F.lit("r2")), 2),
        question("s", "SCALE", json_value(F.col("turn")), none, 0))
    response = F.struct(F.lit("me").alias("respondent"), F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
                        F.concat_ws("-", text("conv_id"), text("turn")).alias("id"), (F.col("role") != "system").alias("isQuiz"),
                        questions.alias("questions"))
    return wrap(t.conversations, F.struct(F.concat(F.lit("my form, "), "role").alias("tableName"),
                                          F.when(F.col("role") != "system", "ann").alias("user"),
                                          F.array(response).alias("responses")), F.lit(3.5))


@query("p_forms", """
    WITH a AS (
      SELECT *, 't' AS question_title, '' AS sub, '["' || text AS answer, 1 AS points, CAST(NULL AS BOOLEAN) AS ok FROM conversations
      UNION ALL SELECT *, 'm', '', role, 5, CASE role WHEN 'user' THEN true END FROM conversations
      UNION ALL SELECT *, 'c', '', role, 7, CASE role WHEN 'user' THEN true END FROM conversations
      UNION ALL SELECT *, 'c', '', 'user', 0, CASE WHEN role <> 'system' THEN true END FROM conversations
      UNION ALL SELECT *, 'g', 'r1', role, 2, NULL FROM conversations
      UNION ALL SELECT *, 'g', 'r1', '[x', 0, NULL FROM conversations
      UNION ALL SELECT *, 'g', 'r2', '"y', 0, NULL FROM conversations
      UNION ALL SELECT *, 's', '', CAST(turn AS VARCHAR), 0, NULL FROM conversations)
    SELECT question_title, conv_id || '-' || turn AS responder, CAST(1704067200 AS BIGINT) AS timestamp, role <> 'system' AS is_quiz,
           sub, answer, 'good' AS feedback_correct, '' AS feedback_incorrect, points AS available_points, ok AS is_correct,
           'my_form_' || role AS form_name, CASE WHEN role = 'system' THEN 'undefined' ELSE 'ann' END AS uploaded_by_user,
           CAST(3.5 AS DOUBLE) AS time_uploaded FROM a""")
def p_forms(t):
    path, c = new_folder(t.spark, "raw"), context(t)
    write_envelopes(form_envelopes(t), path)
    uploads.forms.run(read_envelopes(t.spark, path, uploads.FORM), c)
    return c.store.read("google_forms_data").withColumnRenamed("sub_question text", "sub").drop("type", "help_text")


@query("p_sheets", """
    WITH last AS (SELECT lang, arg_max(doc_id, doc_id) AS doc_id, arg_max(text, doc_id) AS text FROM documents GROUP BY lang)
    SELECT 'sheet' AS kind, 'ann_' || lang AS "table", line, chars FROM (
      SELECT lang, CASE WHEN regexp_full_match(l, '\\s*') THEN NULL ELSE l END AS line, CAST(length(l) AS VARCHAR) AS chars
      FROM (SELECT lang, unnest(string_split(text, chr(10))) AS l FROM last))
    UNION ALL SELECT 'metadata', 'ann_' || lang, CAST(doc_id AS VARCHAR), NULL FROM documents""")
def p_sheets(t):
    """Every document as a two-column sheet of its language; the newest upload of a sheet stays."""
    return stored_sheets(t, F.col("lang"), F.lit("ann"))


def stored_sheets(t, name, user):
    """Every document as a two-column sheet (line, its length) of the given name and user, landed, processed and read back."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.array(x, text(F.length(x))))
    head = F.array(F.array(F.lit("line"), F.lit("chars")))
    blank = F.array(F.array(F.lit(""), F.lit("")))
    landed = wrap(t.spread("documents"), F.struct(name.alias("tableName"), F.concat(blank, head, lines, blank).alias("values"),
                                        user.alias("user")), F.col("doc_id"))
    path, c = new_folder(t.spark, "raw"), context(t)
    write_envelopes(landed, path)
    uploads.sheets.run(read_envelopes(t.spark, path, uploads.SHEET), c)
    sheets = c.store.read(uploads.SHEETS).select(
        F.lit("sheet").alias("kind"), F.col("sheet").alias("table"), F.col("cells")["line"].alias("line"), F.col("cells")["chars"].alias("chars"))
    return sheets.unionByName(c.store.read("google_sheets_metadata").select(
        F.lit("metadata").alias("kind"), F.col("inserted_tables").alias("table"),
        text(F.col("time_added").cast("bigint")).alias("line"), F.lit(None).cast("string").alias("chars")))


@query("sheet_tables", """
    SELECT 'sheet' AS kind, source || '_doc_' || doc_id AS "table", CASE WHEN regexp_full_match(l, '\\s*') THEN NULL ELSE l END AS line,
           CAST(length(l) AS VARCHAR) AS chars
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS l FROM documents)
    UNION ALL SELECT 'metadata', source || '_doc_' || doc_id, CAST(doc_id AS VARCHAR), NULL FROM documents""")
def sheet_tables(t):
    """Every document as a sheet of its own."""
    return stored_sheets(t, F.concat(F.lit("doc "), text("doc_id")), F.col("source"))
