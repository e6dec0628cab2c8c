"""Hand-made rows for the rules that differ from Spark's defaults."""

import json
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from footform.functions import exprs
from footform.operators import core, odds, players, quality, teams, value
from footform.plans.queries import QUERIES
from footform.schemas import SCHEMAS, Tables
from footform.sources import ingest, merge, proxy, sinks


def at(text):
    return datetime.fromisoformat(text) if text else None


@pytest.fixture(scope="module")
def t(spark):
    fx = [  # id, league, season, starting_at, home, away, scores
        (1, 1, 10, at("2024-01-01 15:00"), 1, 2, 2, 1), (2, 1, 10, at("2024-01-08 15:00"), 2, 1, 0, 0), (3, 1, 10, at("2024-01-08 15:00"), 1, 3, 3, 0),
        (4, 1, 10, None, 3, 1, 1, 1), (5, 1, 11, at("2024-07-01 23:30"), 1, 2, None, None), (6, 1, 10, at("2024-01-15 15:00"), None, 1, 1, 2),
    ]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    return Tables(
        fixtures=frame(fx, "id int, league_id int, season_id int, starting_at timestamp, home_team_id int, away_team_id int, home_score int, away_score int"),
        teams=frame([(1, "Ángel FC", "ANG", None), (2, "Bees", "BEE", None)], "id int, name string, short_code string, image_path string"),
        players=frame([(100, "Jörg O'Neill", "J. O'Neill", "Jörg", 1), (101, "Sam 100% Lee", "S. Lee", None, 2)], "id int, name string, short_name string, common_name string, team_id int"),
        fixture_players=frame([(1, 100, 1, True, 90), (2, 100, 1, False, None), (3, 100, 2, True, 45), (4, 100, 1, None, 10), (1, 101, 2, True, 90), (1, 999, 2, True, 90)], "fixture_id int, player_id int, team_id int, is_starter boolean, minutes_played int"),
        fixture_player_statistics=frame([(1, 100, 42, "a", 3), (1, 100, 42, "b", 5), (2, 100, 42, "a", None), (3, 100, 42, "a", 1), (1, 101, 42, "a", None), (1, 999, 42, "a", 9)], "fixture_id int, player_id int, type_id int, code string, value int"),
        fixture_participants=frame([(1, 1, "home", 2), (1, 2, "away", 1)], "fixture_id int, team_id int, location string, score int"),
        fixture_statistics=frame([(1, 1, 42, 5), (1, 1, 42, 7), (1, 2, 42, 2), (3, 1, 84, 2), (3, 3, 42, 4)], "fixture_id int, team_id int, type_id int, value int"),
    )


def test_null_kickoff_is_newest_and_equal_ones_by_id(t):
    apps = core.player_appearances(t, 1).filter("player_id = 100")
    assert [r.fixture_id for r in core.last_n(apps, "player_id", 3).orderBy("rn").collect()] == [4, 3, 2]
    assert core.latest_team(t, 1).filter("player_id = 100").head().team_id == 1


def test_sequence_keeps_nulls_and_repeats_collapse_to_max(t):
    row = players.player_stat_window_last_n(t, league=1, type_id=42, n=1).collect()
    assert row == []  # the newest game has no value
    games = core.stat_value(core.last_n(core.player_appearances(t, 1).filter("player_id = 100"), "player_id", 4), t.fixture_player_statistics, 42, ["fixture_id", "player_id"])
    assert core.window_agg(games, "player_id").head().last_values == [None, 1, None, 5]


def test_unknown_minutes_fail_a_minimum_and_missing_player_disappears(t):
    assert {r.fixture_id for r in core.player_appearances(t, 1, min_minutes=10).filter("player_id = 100").collect()} == {1, 3, 4}
    board = players.player_stat_leaderboard(t, league=1, type_id=42).collect()
    assert [(r.player_id, r.total_value) for r in board] == [(101, None), (100, 9)]


def test_home_and_away_together_leave_nothing(t):
    assert teams.team_btts_pct_season(t, league=1, home_only=True, away_only=True).count() == 0
    seen = {r.team_id for r in teams.team_btts_pct_season(t, league=1).collect()}
    assert seen == {1, 2}  # team 3 is no row of teams
    assert 3 in {r.team_id for r in teams.team_clean_sheets(t, league=1).collect()}


def test_conceded_is_the_opponents_value(t):
    got = {(r.team_id, r.value) for r in teams.conceded_games(t, 1, 42).collect()}
    assert got == {(1, 2), (2, 7)}


def test_cards_count_fixtures_with_any_statistic(t):
    assert {(r.team_id, r.fixture_id, r.value) for r in teams.card_games(t, 1).collect()} == {(1, 1, 0), (2, 1, 0), (1, 3, 2), (3, 3, 0)}


def test_day_is_londons(t):
    assert players.fixtures_on(t, "2024-07-02", 1).head().id == 5
    assert teams.teams_playing_on_date(t, on="2024-07-02", league=1).count() == 2


def test_recency_rules(spark):
    df = spark.createDataFrame([(at("2024-03-31 00:30"),)], "last_fixture_at timestamp")
    calendar = lambda now, n: df.filter(core.recent_calendar(now, n)).count()
    assert [calendar("2024-03-31 22:00:00", 0), calendar("2024-03-31 22:00:00", 1), calendar("2024-03-31 23:30:00", 1)] == [1, 1, 0]
    assert df.filter(core.recent_rolling("2024-04-01 00:30:00", 1)).count() == 1


def test_search(t):
    names = lambda q: [r.player_id for r in players.search_players(t, league=1, query=q).collect()]
    assert names("") == names("  ") == []
    assert names("jörg") == [100] and names("s. lee") == [101] and names("lee 100%") == [101] and names("nobody") == []


def test_likely_players(t):
    got = {(r.team_id, r.player_id, r.confidence) for r in teams.likely_players(t, league=1, recent_days=None, as_of="2024-02-01 00:00:00").collect()}
    assert got == {(1, 100, 0.6), (2, 100, 1.0)}


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, n int")
    new = spark.createDataFrame([(2, None), (3, "c")], "id int, name string")
    assert {tuple(r) for r in merge.merge_by_key(old, new, ["id"]).collect()} == {(1, "a", 1), (2, None, 2), (3, "c", None)}
    assert {tuple(r) for r in merge.fill_by_key(old, new, ["id"]).collect()} == {(1, "a", 1), (2, "b", 2), (3, "c", None)}
    empty = old.limit(0)
    assert merge.merge_by_key(empty, new.limit(0), ["id"]).count() == 0


def test_odds_with_null_line_always_add(spark):
    schema = "fixture_id long, bookmaker_id int, market_key string, selection_key string, line double, participant_type string, participant_id long, price_decimal double"
    row = spark.createDataFrame([(1, 2, "m", "s", None, "player", 7, 1.5), (1, 2, "m", "s", 0.5, "player", 7, 1.5)], schema)
    new = row.withColumn("participant_id", F.lit(None).cast("long")).withColumn("price_decimal", F.lit(2.0))
    got = sorted(((r.line or 0, r.participant_id or 0, r.price_decimal) for r in odds.upsert_outcomes(row, new).collect()))
    assert got == [(0, 0, 2.0), (0, 7, 1.5), (0.5, 7, 2.0)]


def test_scalars(spark):
    texts = spark.createDataFrame([("2.7",), ("abc",), ("",), ("7",), (None,), ("nan",)], "x string")
    assert [r.v for r in texts.select(exprs.safe_int(F.col("x")).alias("v")).collect()] == [2, None, None, 7, None, None]
    stats = spark.createDataFrame([('{"total": 3, "value": null}',), ('{"odd": "x", "other": "4"}',), ("5",), ("{}",), (None,)], "x string")
    assert [r.v for r in stats.select(exprs.stat_value(F.col("x")).alias("v")).collect()] == [3, 4, 5, None, None]
    names = spark.createDataFrame([("Jörg O'Neill",), ("Øre",), (None,)], "x string")
    assert [r.v for r in names.select(exprs.fold_name("x").alias("v")).collect()] == ["jorgoneill", "re", None]
    lines = spark.createDataFrame([('{"label": "Over 2.5"}',), ('{"label": -1.5}',), ('{"label": "x", "handicap": "-0.25"}',), ("{}",)], "x string")
    assert [r.v for r in lines.select(exprs.parse_line(F.col("x")).alias("v")).collect()] == [2.5, -1.5, 0.25, None]
    spots = spark.createDataFrame([("Right-Back", None), (None, "Deep Central-Midfield"), (None, "Libero")], "c string, n string")
    assert [r.v for r in spots.select(exprs.position_abbr(F.col("c"), F.col("n")).alias("v")).collect()] == ["RB", "CM", None]
    assert [r.v for r in spark.createDataFrame([("Hello, World!",), ("--",)], "x string").select(exprs.slug(F.col("x")).alias("v")).collect()] == ["hello_world", "unknown"]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    entry = lambda side, goals, kind=1525: {"type_id": kind, "score": {"participant": side, "goals": goals}}
    fixture = {
        "id": 9, "league_id": 1, "season_id": 10, "starting_at": "2024-02-01T20:00:00Z", "state": {"state": "FT"}, "scores": [entry("home", 1, 1), entry("home", 0), entry("home", 2), entry("away", 0)],
        "participants": [{"id": 1, "name": "One", "meta": {"location": "HOME"}}, {"team_id": 2, "name": "", "meta": {"venue": "away", "score": 0}}],
        "statistics": [{"type": {"id": 42, "code": "shots"}, "participant_id": 1, "data": {"value": 11}}, {"type_id": 84, "data": {"value": 1}}],
        "lineups": [{"player_id": 100, "team_id": 1, "type_id": 11, "player": {"fullname": "A B"}, "detailedposition": {"code": "left-back"}, "details": [{"type_id": 119, "data": {"value": 88}}, {"type_id": 42, "stat": 3}, {"type_id": 52, "value": "1"}]}],
    }
    second = {"id": 10, "scores": {"localteam_score": 3, "away": 0}, "participants": [], "lineups": None}
    folder = tmp_path_factory.mktemp("landing")
    (folder / "a.json").write_text(json.dumps({"data": [fixture]}) + "\n" + json.dumps({"data": second}) + "\nnot json\n" + json.dumps({"message": "none"}) + "\n")
    return ingest.read_raw_payloads(spark, f"file://{folder}")


def test_ingest(raw):
    assert raw.count() == 2
    tables = ingest.build_tables(raw)
    one, two = tables.fixtures.orderBy("id").collect()
    assert (one.home_score, one.away_score, one.home_team_id, one.away_team_id, one.status_code) == (2, 0, 1, 2, "FT")
    assert one.starting_at == at("2024-02-01 20:00") and (two.home_score, two.away_score) == (3, 0)
    assert {(r.team_id, r.location, r.score) for r in tables.fixture_participants.collect()} == {(1, "home", None), (2, "away", 0)}
    assert {(r.id, r.name) for r in tables.teams.collect()} == {(1, "One"), (2, None)}
    assert [(r.type_id, r.code, r.value) for r in tables.fixture_statistics.collect()] == [(42, "shots", 11)]
    row = tables.fixture_players.head()
    assert (row.is_starter, row.minutes_played, row.position_abbr, row.name) == (True, 88, "LB", "A B")
    assert {(r.type_id, r.value) for r in tables.fixture_player_statistics.collect()} == {(119, 88), (42, None), (52, 1)}


def test_parse_outcomes(spark, t):
    data = [
        {"market_id": 268, "name": "Jorg ONeill", "label": "Over 1.5", "value": "1.8"}, {"market_description": "Result", "name": "Bees", "label": "2", "dp3": "3.1"}, {"market_id": 268, "name": "Who", "label": "0.5", "value": "2"},
        {"market_id": 1, "name": "x", "value": "no"},
    ]
    shots = spark.createDataFrame([(1, 1, 2, at("2024-01-01 10:00"), json.dumps({"data": data}))], SCHEMAS["odds_snapshots"])
    got = {(r.market_key, r.participant_type, r.participant_id, float(r.line)) for r in odds.parse_outcomes(t, shots, t.fixtures).collect()}
    assert got == {("player_shots", "player", 100, 1.5), ("result", "team", 2, 2.0), ("player_shots", "player", None, 0.5)}
    assert [r.name for r in odds.unmatched_player_odds(odds.parse_outcomes(t, shots, t.fixtures)).collect()] == ["Who"]


def test_squad_names_of_every_fixture(spark, sf_dir):
    """A fixture's names are those of both squads, however its row looks: teams that are unknown or the same, ids that repeat or lack."""
    rows = [(1, 5, 6), (2, 6, 5), (3, 5, None), (4, None, None), (5, 7, 7), (6, 5, 6), (6, 5, 7), (None, 6, 8), (7, 8, 9)]
    known = [(9, "Á", "A b", "!!", 5), (8, "A", None, None, 6), (7, "Cé", "ab", None, 7), (6, "Free", None, None, None), (5, None, "", None, 6)]
    t = Tables(fixtures=spark.createDataFrame(rows, "id long, home_team_id int, away_team_id int"), players=spark.createDataFrame(known, "id int, name string, common_name string, short_name string, team_id int"))
    both = {("a", 8), ("ab", 9)}
    want = {1: both, 2: both, 3: {("a", 9), ("ab", 9)}, 5: {("ce", 7), ("ab", 7)}, 6: {("a", 8), ("ab", 7), ("ce", 7)}, None: {("a", 8)}}
    got = odds.fixture_squad_name_map(t, t.fixtures).collect()
    assert sorted(map(str, got)) == sorted(str(Row(fixture_id=f, folded=name, player_id=p)) for f, names in want.items() for name, p in names)
    teamless = Tables(**{**vars(t), "players": t.players.drop("team_id")})
    assert odds.fixture_squad_name_map(teamless, t.fixtures).count() == 0
    # The registered query leaves out no fixture and no name of its squads.
    full = proxy.tables(spark, sf_dir)
    squads = odds.squad_name_map(full)
    sides = full.fixtures.select(F.col("id").alias("fixture_id"), F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    plain = sides.join(squads, "team_id").groupBy("fixture_id", "folded").agg(F.min("player_id").alias("player_id"))
    found = QUERIES["squad_name_map"](spark, sf_dir)
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0
    assert found.select("fixture_id").distinct().count() == full.fixtures.count()


def test_stream_keeps_newest(spark, tmp_path):
    from footform.streaming.odds_stream import current_outcomes, odds_stream, write_epoch

    source, target = tmp_path / "in", f"file://{tmp_path}/out"
    source.mkdir()
    price = lambda i, when, p, **more: {"id": i, "fixture_id": 1, "bookmaker_id": 2, "pulled_at": when, "raw": json.dumps({"data": [{"market_id": 268, "name": "A", "label": "1.5", "value": p, **more}]})}
    t = Tables(
        fixtures=spark.createDataFrame([(1, 5, 6)], "id long, home_team_id int, away_team_id int"), teams=spark.createDataFrame([], "id int, name string, short_code string"),
        players=spark.createDataFrame([(9, "Á", None, None, 5)], "id int, name string, common_name string, short_name string, team_id int"), fixture_players=spark.createDataFrame([], "fixture_id long, player_id int"),
    )
    run = lambda: odds_stream(spark, f"file://{source}", target, f"file://{tmp_path}/ck", t, once=True).awaitTermination()
    (source / "1.json").write_text(json.dumps(price(1, "2024-01-01T10:30:00Z", "2.0")) + "\n" + json.dumps(price(1, "2024-01-01T10:30:00Z", "2.0")))
    run()
    (source / "2.json").write_text(json.dumps(price(2, "2024-01-01T10:00:00Z", "9.0")))
    run()
    read = lambda: sorted(((r.market_key, r.participant_id, r.line and float(r.line), float(r.price_decimal)) for r in current_outcomes(spark, target).collect()), key=str)
    assert read() == [("player_shots", 9, 1.5, 2.0)]
    # An epoch that is applied twice leaves the same rows, also those without a line.
    more = spark.createDataFrame([tuple(price(3, "2024-01-01T11:00:00Z", "3.0", label="Yes").values())], "id long, fixture_id long, bookmaker_id int, pulled_at string, raw string").withColumn("pulled_at", F.to_timestamp("pulled_at"))
    for _ in range(2):
        write_epoch(more, 7, target, t)
        assert read() == [("player_shots", 9, 1.5, 2.0), ("player_shots", 9, None, 3.0)]


def test_last_price_of_a_line_wins(spark):
    rows = [(1, 2, 292, "Over 8.5", None, 2.5, "{}", "2024-01-01", 0), (1, 2, 292, "Over 8.5", None, 1.5, "{}", "2024-01-02", 0), (1, 2, 292, "Over 8.5", None, 1.25, "{}", "2024-01-02", 1), (1, 2, 292, "Under 8.5", None, 9.0, "{}", "2024-01-03", 0)]
    odds = spark.createDataFrame(rows, "fixture_id long, bookmaker_id int, market_id int, selection string, line string, decimal_odds double, raw string, pulled_at string, place int")
    assert [tuple(r) for r in value.shot_over_odds(odds).collect()] == [(1, "match", 8.5, 1.25)]


def test_quoted_zero_is_a_score(spark):
    df = spark.createDataFrame([('{"localteam_score": "0", "home": 5}',), ('{"localteam_score": 0, "home": 5}',), ('{"localteam_score": 0, "home": 0}',), ('{"home": ""}',)], "s string")
    home, _ = ingest.extract_scores(F.col("s"))
    assert [r[0] for r in df.select(home).collect()] == [0, 5, 0, None]


def test_upsert_into_a_database(spark):
    from py4j.protocol import Py4JJavaError

    url, props = "jdbc:derby:memory:footform;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    frame = lambda *rows: spark.createDataFrame(rows, "id int, name string")
    sinks.write_jdbc(frame((1, "a"), (2, "b")), url, "teams", props)
    for _ in range(2):  # a repeated run changes nothing more
        sinks.upsert_jdbc(frame((2, "B"), (3, "c")), url, "teams", ["id"], props)
        assert sorted(map(tuple, spark.read.jdbc(url, "teams", properties=props).collect())) == [(1, "a"), (2, "B"), (3, "c")]

    def stagings():
        found = spark.read.jdbc(url, "(SELECT CAST(tablename AS VARCHAR(99)) AS n FROM sys.systables) x", properties=props).collect()
        return [r[0] for r in found if "STAGING" in r[0].upper()]

    assert stagings() == []
    # A load that fails and a merge that fails leave the table as it was, and no staging table.
    broken = frame((1, "z")).withColumn("name", F.when(F.rand() < 2, F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        sinks.upsert_jdbc(broken, url, "teams", ["id"], props)
    with pytest.raises(Py4JJavaError):
        sinks.upsert_jdbc(frame((1, "z")), url, "no_such_table", ["id"], props)
    assert stagings() == [] and spark.read.jdbc(url, "teams", properties=props).count() == 3


def test_exports(spark, t, tmp_path):
    with pytest.raises(ValueError):
        seasons = spark.createDataFrame([(10, 1, True, at("2024-06-01")), (11, 1, False, at("2023-06-01")), (12, 1, False, None)], "id int, league_id int, is_current boolean, end_date timestamp")
        sinks.export_subset(Tables(**{**vars(t), "seasons": seasons}), as_of="2024-01-10 00:00:00")
    assert {r.id for r in ingest.keep_seasons(seasons).collect()} == {10, 11}
    kept = sinks.export_subset(Tables(**{**vars(t), "seasons": seasons}), as_of="2024-01-10 00:00:00", strict=False)
    assert {r.id for r in kept.fixtures.collect()} == {1, 2} and {r.id for r in kept.players.collect()} == {100, 101}
    sinks.write_csv(kept.teams, str(tmp_path / "teams"))
    assert spark.read.option("header", True).csv(str(tmp_path / "teams")).count() == 2


def test_golden(spark, t):
    # Newest first: the unknown kick-off, then the 15th, then equal kick-offs by id.
    assert quality.team_results_sequence(t, team=1, n=3).head()["results"] == ["D 1-1", "W 1-2", "W 3-0"]
    want = spark.createDataFrame([("a", ["1"]), ("b", None)], "check string, values array<string>")
    got = spark.createDataFrame([("a", ["2"])], "check string, values array<string>")
    assert {(r.check, r.ok) for r in quality.golden_compare(got, want).collect()} == {("a", False), ("b", True)}


def test_empty_tables(spark, t):
    empty = Tables(**{k: None if v is None else v.limit(0) for k, v in vars(t).items()})
    assert players.player_streak(empty, league=1, type_id=42, n=3, threshold=1, required=1).count() == 0
    assert teams.team_stat_streak_last_n_meta(empty, league=1, type_id=42, n=3, threshold=1, required=1).head().candidate_teams_count == 0
    assert quality.freshness_report(empty, as_of="2024-01-01 00:00:00", league=1, team=1, since="2024-01-01 00:00:00").head().stale
    assert value.player_forms(empty).count() == 0
