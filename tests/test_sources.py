"""Source jobs on small landed documents."""

import hashlib
import hmac
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clean as C
from tidemark.functions import presto as P
from tidemark.functions import signature as S
from tidemark.operators.joins import lookup_manager, resolve_person
from tidemark.plans import feeds, people, uploads
from tidemark.plans.job import Context, job
from tidemark.sources import documents as docs
from tidemark.sources.envelopes import read_envelopes
from tidemark.sources.webhooks import CHAT_BODY, emoji_rows

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


@pytest.fixture
def land(spark, tmp_path):
    def write(payload, *objects):
        for i, o in enumerate(objects):
            (tmp_path / f"{i}.json").write_text(json.dumps(o))
        return read_envelopes(spark, str(tmp_path), payload)
    return write


@pytest.fixture
def context(spark, store):
    return Context(spark, NOW, store)


def envelope(data, timestamp=0, **more):
    return {"metadata": {"timestamp": timestamp, **more}, "data": data}


@pytest.fixture
def directory(spark):
    return spark.createDataFrame(
        [(f"g{i}", f"p{i}@x.org", f"al{i}", f"Person {i}", "Boss One" if i else "", "") for i in range(4)],
        "guid STRING, email STRING, alias STRING, displayName STRING, manager STRING, manager_email STRING")


def one(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy(*columns).collect()]


# -- single expressions ------------------------------------------------------------------


def test_hmac_equals_the_library(spark):
    row = spark.createDataFrame([("héllo",)], "m STRING").select(
        S.hmac_hex("m", "key", "sha256").alias("a"), S.hmac_hex("m", "key", "sha1").alias("b")).head()
    assert row["a"] == hmac.new(b"key", "héllo".encode(), hashlib.sha256).hexdigest()
    assert row["b"] == hmac.new(b"key", "héllo".encode(), hashlib.sha1).hexdigest()


def test_repository_signature(spark):
    expected = "sha1=" + hmac.new(b"k", b"body", hashlib.sha1).hexdigest()
    df = spark.createDataFrame([("body", expected), ("body", "sha1=00"), ("body", None)], "b STRING, s STRING")
    assert [r["ok"] for r in df.select(S.matches("s", S.repository_signature("b", "k")).alias("ok")).collect()] == \
        [True, False, False]


@pytest.mark.parametrize("text, whole, real", [
    ("12", 12, 12.0), ("12.7", 12, 12.699999809265137), ("-3", -3, -3.0), ("x", 0, 0.0), ("", 0, 0.0), (None, 0, 0.0),
    ("1d", 0, 0.0), (" 4 ", 4, 4.0), ("1e2", 100, 100.0),
])
def test_numbers(spark, text, whole, real):
    row = spark.createDataFrame([(text,)], "c STRING").select(C.int_or_zero("c"), C.float_or_zero("c")).head()
    assert tuple(row) == (whole, real)


@pytest.mark.parametrize("start, end, months", [
    ("2020-01-31", "2020-02-29", 1), ("2020-01-30", "2020-02-29", 1), ("2020-01-30", "2020-02-28", 0),
    ("2020-02-29", "2020-03-28", 0), ("2020-02-29", "2020-03-29", 1), ("2020-03-29", "2020-02-29", -1),
    ("2000-05-01", "2002-04-30", 23), ("2000-05-01", "2002-05-01", 24),
])
def test_complete_months(spark, start, end, months):
    df = spark.createDataFrame([(start, end)], "a STRING, b STRING")
    assert df.select(P.complete_months(F.to_date("a"), F.to_date("b"))).head()[0] == months


def test_missing_event_time_is_an_error(spark):
    df = spark.createDataFrame([((None, None),)], "w STRUCT<dateTime STRING, date STRING>")
    with pytest.raises(Exception, match="event time"):
        df.select(C.start_or_date("w")).collect()


def test_location_units(spark):
    df = spark.createDataFrame([("Oslo,Enheter-1-blue,Enheter-2-red,Room-3",), (None,)], "p STRING")
    assert [r[0] for r in df.select(C.location_units("p")).collect()] == [["blue", "red"], []]


# -- people ------------------------------------------------------------------------------


@pytest.mark.parametrize("by, value", [("guid", "g1"), ("email", "p1@x.org"), ("alias", "al1"), ("full_name", "Person 1")])
def test_resolve_person(spark, directory, by, value):
    df = spark.createDataFrame([(value,)], "who STRING")
    assert resolve_person(df, directory, by, "who").head()["guid"] == "g1"


def test_unknown_people_are_dropped(spark, directory):
    df = spark.createDataFrame([("al1",), ("nobody",), (None,)], "alias STRING")
    assert resolve_person(df, directory, "alias").count() == 1


def test_missing_id_column(spark, directory):
    with pytest.raises(ValueError):
        resolve_person(spark.range(1), directory, "alias")


def test_lookup_manager_blank_when_unknown(spark, directory):
    df = spark.createDataFrame([("al1",), ("nobody",)], "alias STRING")
    assert one(lookup_manager(df, directory, "alias"), "alias", "manager") == [("al1", "Boss One"), ("nobody", "")]


def test_directory(spark):
    user = lambda n, boss, service=False: (
        f"{n}@x.org", n, n.lower(), "co", "br", f"CN={n},OU=a", f"CN={boss},OU=a" if boss else None, service, False, False)
    users = spark.createDataFrame(
        [user("Ann", None), user("Bob", "Ann"), user("Cy", "Zed"), user("Dee", "Eve"), user("Eve", None, True)],
        "primaryEmailAddress STRING, displayName STRING, samAccountName STRING, company STRING, branch STRING, "
        "distinguishedName STRING, managerDistinguishedName STRING, isServiceUser BOOLEAN, isExternalUser BOOLEAN, "
        "isDeleted BOOLEAN")
    got = people.directory(users)
    # A manager may be a left-out account; an unknown one is blank.
    assert one(got, "alias", "distinguished_name", "manager", "manager_email") == [
        ("ann", "Ann", "", ""), ("bob", "Bob", "Ann", "Ann@x.org"), ("cy", "Cy", "", ""), ("dee", "Dee", "Eve", "Eve@x.org")]
    assert got.filter("alias = 'ann'").head()["guid"] == hashlib.sha1(b"ann").hexdigest()


def hours(period, hrs, who="AL1", customer="cust", order="wo"):
    return {"tab": "B", "reg_period": period, "used_hrs": hrs, "resource_id": who, "xr1project": "p", "work_order": "1",
            "xwork_order": order, "xr0work_order": customer}


def test_hours_weights_and_projects(land, context, directory):
    env = land(people.HOURS, envelope([hours("201801", "5"), hours("201801", "9", customer="big"), hours("201801", "0"),
                                       hours("201801", "x"), hours("201801", "3", "al2"), hours("201801", "2", "none")], 7.9))
    assert people.hours_per_resource.run(env, context, directory) == ["ubw_customer_per_resource", "ubw_per_project_data"]
    assert one(context.store.read("ubw_customer_per_resource"), "alias", "customer", "weigth", "time", "guid") == [
        ("al1", "big", 1, 7, "g1"), ("al1", "cust", 2, 7, "g1"), ("al2", "cust", 1, 7, "g2")]
    assert one(context.store.read("ubw_per_project_data"), "customer", "employees", "hours", "timestamp") == [
        ("big", 1, 9.0, 7), ("cust", 3, 10.0, 7)]


def test_hours_keep_the_latest_weeks(spark, land, context, directory):
    context.options["weeks"] = 2
    env = land(people.HOURS, envelope([hours(p, "5") for p in ("202252", "20231", "202310", "20239")], 1))
    people.hours_per_resource.run(env, context, directory)
    second = land(people.HOURS, envelope([hours("202311", "5")], 2))
    people.hours_per_resource.run(second, context, directory)
    # 20231 is week 1, older than week 9: it must not win as the larger-looking text.
    assert {r[0] for r in one(context.store.read("ubw_customer_per_resource"), "reg_period")} == {"20239", "202310", "202311"}
    assert context.store.read("ubw_per_project_data").count() == 5


def test_activity_hours_never_rewritten(land, context):
    run = lambda *rows: people.activity_hours.run(land(people.activity_hours.payload, envelope(
        [{"tab": "B", "reg_period": p, "used_hrs": h} for p, h in rows], 3.5)), context)
    run(("201817", "9"), ("201817", "10"))
    run(("201817", "1"), ("201907", "4"))
    assert one(context.store.read("ubw_fagtimer"), "reg_period", "used_hrs", "time") == [("201817", "10", 3.5), ("201907", "4", 3.5)]


def test_closed_period(spark):
    df = spark.createDataFrame([("B", "20245"), ("B", "20246"), ("N", "20241"), ("B", None), ("B", "x")], "tab STRING, reg_period STRING")
    assert [r[0] for r in df.filter(C.closed_period("reg_period", "tab", 2024, 9)).select("reg_period").collect()] == ["20245"]


def test_cv_without_a_section(land, context, directory):
    person = {"user_id": "u", "default_cv_id": "d", "cv_link": "l", "image_key": None, "cv": {
        "navn": "N", "email": "p1@x.org", "born_year": None, "title": {"no": "T"},
        "languages": [{"name": {"no": "Norsk"}, "level": {"int": "x"}}, {"name": None, "level": None}], "educations": [],
        "technologies": [{"category": {"no": "c"}, "technology_skills": [{"tags": {"no": "Yarn"}}, {"tags": {"no": "VS Code"}},
                                                                         {"tags": None}, None]},
                         {"category": None, "technology_skills": None}]}}
    names = people.employees_cv.run(land(people.CV, envelope([person])), context, directory)
    assert names == ["cv_partner_employees", "cv_partner_languages", "cv_partner_technology_skills"]
    assert one(context.store.read("cv_partner_languages"), "name", "level") == [("", ""), ("Norsk", "")]
    assert one(context.store.read("cv_partner_technology_skills"), "category", "technology_skills") == [
        ("", ""), ("c", "Yarn;VS Code;;")]
    assert one(context.store.read("cv_partner_employees"), "born_year", "telefon", "guid") == [(0, "", "g1")]


# -- feeds -------------------------------------------------------------------------------


def test_weather_xml(spark, tmp_path):
    step = '<time from="2024-01-01T{0:02d}:00:00" to="2024-01-01T{0:02d}:59:00"><precipitation value="0.1"/>' \
           '<windSpeed mps="2.5"/><temperature value="{0}"/><pressure value="990.5"/></time>'
    body = "".join(step.format(i % 24) for i in range(30))
    (tmp_path / "a.xml").write_text(f"<weatherdata><location><name>Oslo</name></location><forecast><tabular>{body}"
                                    "</tabular></forecast></weatherdata>")
    parsed = docs.read_xml(spark, str(tmp_path), "weatherdata", docs.FORECAST)
    got = docs.forecast_rows(parsed, F.lit("here"))
    assert got.count() == 24
    assert one(got.filter("temperature = 3"), "location_name", "time_from", "precipitation", "wind_speed", "air_pressure") == [
        ("Oslo", 1704078000, 0.1, 2.5, 990.5)]


def test_tweets_skip_known(land, context):
    tweet = lambda i: {"tweet_id": i, "created_at": 1, "text": "t", "is_retweet": False, "favorite_count": 0,
                       "retweet_count": 0, "language": "no", "hashtags": None, "place": None, "reply_to": None}
    body = lambda *ids: envelope({"search": [tweet(i) for i in ids], "timeline": [], "accounts": [
        {"user_id": 1, "screen_name": "s", "name": "n", "statuses_count": 1}]}, 5)
    payload = feeds.tweets.payload
    assert feeds.tweets.run(land(payload, body(1, 2, 2)), context) == ["twitter_tweets", "twitter_account_status_update"]
    assert feeds.tweets.run(land(payload, body(1, 2, 3)), context) == ["twitter_tweets", "twitter_account_status_update"]
    assert feeds.tweets.run(land(payload, body(3)), context) == ["twitter_account_status_update"]
    assert one(context.store.read("twitter_tweets"), "tweet_id") == [(1,), (2,), (3,)]
    assert context.store.read("twitter_account_status_update").count() == 3


def test_repositories_status_option(land, context):
    repo = {"id": 1, "name": "r", "language": None, "default_branch": "main", "forks_count": 2}
    for forks in (2, 3):
        feeds.repositories.run(land(feeds.REPO, envelope({**repo, "forks_count": forks})), context)
    assert one(context.store.read("github_repos"), "id", "language") == [(1, "undefined")]
    assert context.store.read("github_repo_status").count() == 1
    context.options["status_all"] = True
    feeds.repositories.run(land(feeds.REPO, envelope([{**repo, "forks_count": 4}])), context)
    assert one(context.store.read("github_repo_status"), "forks_count") == [(2,), (4,)]


def test_issue_routing(land, context):
    issue = lambda n: {"issue": n, "customer": "", "issue_status": "open", "created": 1, "updated": 2}
    env = land(feeds.sales_issues.payload, envelope(issue("a"), event_type="issue_created"),
               envelope(issue("b"), event_type="issue_updated"), envelope([issue("c")]), envelope(issue("d"), event_type="issue_deleted"))
    feeds.sales_issues.run(env, context)
    assert one(context.store.read("jira_issue_created"), "issue") == [("a",), ("c",)]
    assert one(context.store.read("jira_issue_updated"), "issue") == [("b",), ("c",)]
    assert "event_type" not in context.store.read("jira_issue_created").columns


def chat(kind, channel="C1", **event):
    return json.dumps({"team_id": "T", "type": "event_callback", "event_time": 9, "event": {"type": kind, "channel": channel, **event}})


def test_emoji_rows(spark):
    emoji = lambda n: {"type": "emoji", "name": n}
    bodies = [chat("message", blocks=[{"elements": [{"elements": [emoji("a::skin-tone-2"), {"type": "text"}, emoji("a")]}]}, {}]),
              chat("message", "D1", blocks=[{"elements": [{"elements": [emoji("private")]}]}]),
              chat("message", subtype="bot_message", blocks=[{"elements": [{"elements": [emoji("bot")]}]}]),
              chat("pin_added"), chat("message"),
              json.dumps({"team_id": "T", "event_time": 8, "event": {"type": "reaction_added", "reaction": "r::skin-tone-5",
                                                                      "item": {"channel": "C2"}}})]
    df = spark.createDataFrame([(b,) for b in bodies], "body STRING")
    got = emoji_rows(df.select(F.from_json("body", CHAT_BODY).alias("b")),
                     spark.createDataFrame([("C1", "general")], "channel STRING, channel_name STRING"))
    assert sorted(tuple(r) for r in got.select("emoji", "channel", F.coalesce("channel_name", F.lit("-"))).collect()) == [
        ("a", "C1", "general"), ("a", "C1", "general"), ("r", "C2", "-")]


# -- uploads -----------------------------------------------------------------------------


def question(kind, response, **type_data):
    return {"title": "q", "helpText": "h", "id": 1, "type": kind, "answer": None if response is None else
            {"response": response}, "typeData": type_data}


def form(*questions, quiz=False):
    return envelope({"tableName": "My form, 1", "responses": [
        {"respondent": "r", "timestamp": "2024-01-01T00:00:00Z", "id": "i", "isQuiz": quiz, "questions": list(questions)}]}, 2)


def test_form_types(land):
    env = land(uploads.FORM, form(
        question("TEXT", "plain"), question("TEXT", None), question("CHECKBOX", ["a", "b"]), question("SCALE", 4),
        question("GRID", ["x", None], rows=["r1", "r2"]), question("CHECKBOX_GRID", [["x", "y"], ["z"]], rows=["r1", "r2"])))
    got = uploads.forms.tables(env, None)["google_forms_data"]
    assert [(r["type"], r["sub_question text"], r["answer"]) for r in got.collect()] == [
        ("TEXT", "", "plain"), ("TEXT", "", ""), ("CHECKBOX", "", "a"), ("CHECKBOX", "", "b"), ("SCALE", "", "4"),
        ("GRID", "r1", "x"), ("GRID", "r2", None), ("CHECKBOX_GRID", "r1", "x"), ("CHECKBOX_GRID", "r1", "y"),
        ("CHECKBOX_GRID", "r2", "z")]
    assert {(r["form_name"], r["uploaded_by_user"], r["time_uploaded"]) for r in got.collect()} == {("My_form_1", "undefined", 2.0)}


def test_quiz(land):
    choices = [{"value": "a", "isCorrect": True}, {"value": "b", "isCorrect": False}]
    env = land(uploads.FORM, form(question("CHECKBOX", ["a", "b", "other"], choices=choices, points=3),
                                  question("TEXT", "a", points=2), quiz=True))
    got = uploads.forms.tables(env, None)["google_forms_data"]
    assert [(r["is_correct"], r["available_points"]) for r in got.collect()] == [(True, 3), (False, 0), (None, 0), (None, 2)]


def test_unknown_question_type(land):
    with pytest.raises(Exception, match="not supported"):
        uploads.forms.tables(land(uploads.FORM, form(question("NEW", "x"))), None)["google_forms_data"].collect()


def test_form_without_responses(land, context):
    env = land(uploads.FORM, envelope({"tableName": "t", "responses": []}))
    assert uploads.forms.run(env, context) == []


def test_sheets(land, context):
    grid = [["", "", "", ""], ["", "a", "b", "A"], ["", "1", " ", "x"], ["", "2", "3", ""], ["", "", "", ""]]
    names = uploads.sheets.run(land(uploads.SHEET, envelope({"tableName": "t 1", "user": "me@x", "values": grid}, 4),
                                    envelope({"tableName": "blank", "values": [["", ""]]}, 4)), context)
    assert sorted(names) == ["google_sheets_metadata", "google_sheets_rows"]
    table = uploads.read_sheet(context.store, "me_x_t_1")
    assert table.columns == ["a", "b", "A_2"]
    assert table.count() == 2 and table.filter("b IS NULL").count() == 1
    with pytest.raises(KeyError):
        uploads.read_sheet(context.store, "undefined_blank")
    assert one(context.store.read("google_sheets_metadata"), "inserted_tables", "uploaded_by_user", "time_added") == [
        ("me_x_t_1", "me@x", 4.0), ("undefined_blank", "undefined", 4.0)]


def test_uploads_of_equal_time_are_not_mixed(land, context):
    sheet = lambda name, at, *values: envelope({"tableName": name, "user": "u", "values": [list(v) for v in values]}, at)
    first = land(uploads.SHEET, sheet("s", 1, ("z", "a"), ("1", "2")), sheet("s", 1, ("other", "head"), ("8", "9")),
                 sheet("s", 0, ("old",), ("0",)), sheet("kept", 1, ("k",), ("v",)), sheet("s", 1, ("z", "a"), ("1", "2")))
    uploads.sheets.run(first, context)
    got = uploads.read_sheet(context.store, "u_s")
    assert (got.columns, [tuple(r) for r in got.collect()]) in ((["z", "a"], [("1", "2")]), (["other", "head"], [("8", "9")]))
    uploads.sheets.run(land(uploads.SHEET, sheet("s", 5, ("new",), ("n",))), context)
    assert [tuple(r) for r in uploads.read_sheet(context.store, "u_s").collect()] == [("n",)]
    assert [tuple(r) for r in uploads.read_sheet(context.store, "u_kept").collect()] == [("v",)]


# -- declaring jobs ----------------------------------------------------------------------


def test_job_must_return_a_dict(spark, context):
    @job("STRUCT<a INT>")
    def wrong(envelopes, context):
        return envelopes
    with pytest.raises(TypeError):
        wrong.tables(spark.range(1), context)


def test_html_links(spark):
    html = '<a href="https://b.org/archive/2019">x</a><link HREF=\'https://b.org/archive/2020\'><a href="https://b.org/archive/2019">'
    df = spark.createDataFrame([(html, "u"), ("<p>", "own")], "html STRING, url STRING")
    got = [sorted(r[0]) for r in df.select(docs.html_links("html", r"https://b\.org/archive/\d{4}", "url")).collect()]
    assert got == [["https://b.org/archive/2019", "https://b.org/archive/2020"], ["own"]]


def test_grids_against_brute_force(spark):
    import random
    from tidemark.operators.grids import grid_to_rows
    rng = random.Random(7)
    grids = [(n, [[rng.choice(["", "", " ", "a", "b", "1"]) for _ in range(w)] for _ in range(h)])
             for n in range(60) for w, h in [(rng.randint(1, 5), rng.randint(1, 5))]]
    expected = []
    for n, g in grids:
        cells = [(r, c) for r, row in enumerate(g) for c, x in enumerate(row) if x != ""]
        if not cells:
            continue
        top, bottom = min(r for r, _ in cells), max(r for r, _ in cells)
        left, right = min(c for _, c in cells), max(c for _, c in cells)
        for i, r in enumerate(range(top + 1, bottom + 1)):
            line = {g[top][c]: (g[r][c] if g[r][c].strip() else None) for c in range(left, right + 1)}
            expected.append((n, i, sorted(line.items(), key=str)))
    got = grid_to_rows(spark.createDataFrame(grids, "n INT, g ARRAY<ARRAY<STRING>>"), ["n"], "g").collect()
    assert sorted(((r["n"], r["row_no"], sorted(r["cells"].items(), key=str)) for r in got), key=str) == sorted(expected, key=str)


def test_answers_that_look_like_json_stay(land):
    odd = ["[not json", '["a"]', '"quoted"', "{", "null", "[maybe"]
    env = land(uploads.FORM, form(*[question("TEXT", x) for x in odd], question("CHECKBOX", odd),
                                  question("CHECKBOX_GRID", [["[x", '"y'], "[z"], rows=["r1", "r2"]), question("GRID", None, rows=["r1"])))
    got = [(r["type"], r["sub_question text"], r["answer"]) for r in uploads.forms.tables(env, None)["google_forms_data"].collect()]
    assert got == [("TEXT", "", x) for x in odd] + [("CHECKBOX", "", x) for x in odd] + [
        ("CHECKBOX_GRID", "r1", "[x"), ("CHECKBOX_GRID", "r1", '"y'), ("CHECKBOX_GRID", "r2", "[z"), ("GRID", "r1", "")]


@pytest.mark.parametrize("line", ['{"metadata": {"timestamp": 1}, "data": [{"k": 1', '{"metadata": {"timestamp": 1}, "data": [{"k": "text"}]}'])
def test_broken_envelopes_fail(spark, folder, line):
    path = folder("raw")
    spark.createDataFrame([(line,)], "value STRING").write.text(path)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_envelopes(spark, path, "ARRAY<STRUCT<k INT>>").collect()
    assert read_envelopes(spark, path, "ARRAY<STRUCT<k INT>>", mode="PERMISSIVE").count() == 1


def test_iso_text_is_utc_in_any_zone(spark):
    from tidemark.functions import presto
    from pyspark.sql import functions as F
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
        presto.register_sql_functions(spark)
        row = spark.range(1).select(presto.to_iso8601(F.timestamp_seconds("id")).alias("a"), F.expr("to_iso8601(timestamp_seconds(id))").alias("b")).first()
        assert row.a == row.b == "1970-01-01T00:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_tweets_of_own_accounts_are_not_landed(spark):
    from tidemark.sources.webhooks import found_tweets
    rows = spark.createDataFrame([(1, "me", "friend"), (2, "you", "me"), (3, None, "friend"), (4, "you", None)], "tweet_id LONG, user_screen_name STRING, reply_to STRING")
    for c in ("created_at", "text", "is_retweet", "favorite_count", "retweet_count", "language", "hashtags", "place"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    found = {r.tweet["tweet_id"]: r.tweet["reply_to"] for r in found_tweets(rows, ["me", "other"]).collect()}
    assert found == {2: "me", 3: None, 4: None}


def test_repository_records_of_webhook_bodies(spark):
    from tidemark.sources.webhooks import repo_rows
    whole = '{"repository": {"id": 7, "name": "n", "owner": {"login": "o"}, "created_at": "2020-01-01T00:00:00Z", "pushed_at": 99, "forks_count": 3}}'
    rows = spark.createDataFrame([(1, whole), (2, "{}"), (3, "no json"), (4, None), (5, '{"repository": null}')], "k INT, body STRING")
    found = [r.asDict() for r in repo_rows(rows, "body").collect()]
    assert len(found) == 1
    row = found[0]
    assert (row["k"], row["id"], row["name"], row["owner"], row["description"], row["created_at"], row["pushed_at"], row["forks_count"]) == (
        1, 7, "n", "o", "", 1577836800, 99, 3)
