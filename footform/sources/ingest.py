"""Raw payloads in a landing folder to domain tables, as batch jobs over JSON lines."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.exprs import first_true, is_starter, json_true, minutes, parse_dt, position_abbr, safe_int, stat_value
from ..operators.core import instant
from ..schemas import Tables
from .folders import scratch_dir, written
from .merge import fill_by_key, latest_wins

TYPE = "type:struct<id:int,code:string,name:string>"
DETAIL = f"struct<type_id:int,{TYPE},data:string,value:string,stat:string>"
PARTICIPANT = "struct<id:int,team_id:int,name:string,team_name:string,display_name:string,short_code:string,code:string,image_path:string,logo_path:string,logo:string,meta:struct<location:string,venue:string,side:string,score:string,outcome:string>>"
STATISTIC = f"struct<type_id:int,{TYPE},location:string,data:string,participant_id:int,team_id:int>"
PLAYER = "struct<id:int,fullname:string,name:string,short_name:string,short_code:string,common_name:string,image_path:string,image:string,position_name:string,position:string,detailed_position_id:string,detailed_position_name:string,detailed_position_code:string>"
SPOT = "struct<id:string,name:string,code:string>"
LINEUP = (
    f"struct<player_id:int,team_id:int,team:struct<id:int>,participant_id:int,player_name:string,player_image:string,image_path:string,player:{PLAYER},type:string,type_id:string,lineup_type:string,position:string,position_name:string,"
    f"detailed_position_id:string,detailed_position_name:string,detailed_position_code:string,detailedposition:{SPOT},detailed_position:{SPOT},formation_field:string,formation_position:string,jersey_number:string,number:string,"
    f"minutes_played:string,minutes:string,played_minutes:string,details:array<{DETAIL}>>"
)
FIXTURE_FIELDS = {
    "id": "int", "league_id": "int", "season_id": "int", "starting_at": "string", "status": "string", "status_code": "string", "state": "struct<state:string>", "home_team_id": "int", "away_team_id": "int", "scores": "string", "score": "string",
    "participants": f"array<{PARTICIPANT}>", "statistics": f"array<{STATISTIC}>", "lineups": f"array<{LINEUP}>",
}
LISTS = ("participants", "statistics", "lineups")
FIXTURE = f"struct<{','.join(f'{name}:{kind}' for name, kind in FIXTURE_FIELDS.items())}>"
HEAD = f"struct<{','.join(f'{name}:{kind}' for name, kind in FIXTURE_FIELDS.items() if name not in LISTS)}>"
SIDES = f"{HEAD[:-1]},participants:array<{PARTICIPANT}>>"
FACTS = f"struct<player_id:int,team_id:int,team:struct<id:int>,participant_id:int,player:struct<id:int>,details:array<struct<type_id:int,{TYPE},data:string,value:string>>>"
SEASON = "struct<id:int,league_id:int,league:struct<id:int>,name:string,start_date:string,starting_at:string,end_date:string,ending_at:string,is_current:boolean,current:boolean>"
TEAM = "struct<id:int,name:string,short_code:string,image_path:string,logo_path:string>"
STAT_TYPE = "struct<id:int,name:string,code:string,developer_name:string,model_type:string,stat_group:string>"
SCORE = "struct<type_id:int,score:struct<participant:string,goals:string>,participant:string,goals:string>"


def read_raw_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per item of the responses below ``path`` (a JSON object a line): ``source, position, item`` as JSON text.

    ``data`` may be a list or one object; a line without it, or that is no JSON, gives nothing. ``line`` orders the lines
    of a file: by the block that a line is in, then by its turn, however the blocks of a file are dealt to tasks.
    """
    order = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("turn"))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source"), order.alias("line"), F.get_json_object("value", "$.data").alias("data"))
    items = F.from_json(F.when(F.col("data").startswith("["), F.col("data")).otherwise(F.concat(F.lit("["), F.col("data"), F.lit("]"))), "array<string>")
    return lines.filter("data is not null").select("source", "line", F.posexplode(items).alias("position", "item"))


def parsed(raw: DataFrame, schema: str) -> DataFrame:
    """Items with an id, as ``x``; items that are parsed already stay as they are."""
    if "x" in raw.columns:
        return raw
    # A generator parses: a filter that moved below a projection, or into a join, would parse again.
    return raw.select("*", F.explode(F.array(F.from_json("item", schema))).alias("x")).filter("x.id is not null")


def flatten_seasons(raw: DataFrame, league_ids: list[int] | None = None) -> DataFrame:
    out = parsed(raw, SEASON).select(
        "x.id", F.coalesce("x.league_id", "x.league.id").alias("league_id"), "x.name", parse_dt(first_true(F.col("x.start_date"), F.col("x.starting_at"))).alias("start_date"),
        parse_dt(first_true(F.col("x.end_date"), F.col("x.ending_at"))).alias("end_date"), (F.coalesce("x.is_current", F.lit(False)) | F.coalesce("x.current", F.lit(False))).alias("is_current"), F.col("item").alias("extra"),
    )
    return out.filter(F.col("league_id").isin(league_ids)) if league_ids else out


def flatten_teams(raw: DataFrame) -> DataFrame:
    """The first team seen of each id, in the order of files, lines and positions."""
    teams = parsed(raw, TEAM).select("x.id", "x.name", "x.short_code", first_true(F.col("x.image_path"), F.col("x.logo_path")).alias("image_path"), F.col("item").alias("extra"), "source", "line", "position")
    return latest_wins(teams, ["id"], ["source", "line", "position"]).drop("source", "line", "position")


def extract_scores(scores: Column) -> tuple[Column, Column]:
    """Home and away goals: the last CURRENT entry of a side, else its first entry with goals; or the fields of an object."""
    text = F.trim(scores)
    entries = F.transform(
        F.from_json(F.when(text.startswith("["), text), f"array<{SCORE}>"),
        lambda s: F.struct(s["type_id"].alias("type_id"), F.coalesce(first_true(s["score"]["participant"]), s["participant"]).alias("side"), safe_int(F.coalesce(s["score"]["goals"], s["goals"])).alias("goals")),
    )

    def side(name: str, *fields: str) -> Column:
        own = F.filter(entries, lambda s: (s["side"] == name) & s["goals"].isNotNull())
        current = F.filter(own, lambda s: s["type_id"] == 1525)
        flat = F.when(text.startswith("{"), safe_int(F.coalesce(*(json_true(text, f) for f in fields))))
        # A zero in the first field of an object reads as missing; the last field's zero stays.
        last = F.when(text.startswith("{"), safe_int(F.get_json_object(text, f"$.{fields[-1]}")))
        return F.coalesce(F.try_element_at(current, F.lit(-1))["goals"], F.try_element_at(own, F.lit(1))["goals"], flat, last)

    return side("home", "localteam_score", "home"), side("away", "visitorteam_score", "away")


def flatten_fixtures(raw: DataFrame) -> DataFrame:
    home, away = extract_scores(F.coalesce("x.scores", "x.score"))
    return parsed(raw, HEAD).select(
        "x.id", "x.league_id", "x.season_id", parse_dt(F.col("x.starting_at")).alias("starting_at"), "x.status", F.coalesce(first_true(F.col("x.status_code")), F.col("x.state.state")).alias("status_code"),
        "x.home_team_id", "x.away_team_id", home.alias("home_score"), away.alias("away_score"), *(F.col(c).alias("extra") for c in ("item",) if c in raw.columns),
    )


def _each(raw: DataFrame, field: str, entry: str) -> DataFrame:
    """Entries of a list of fixtures, of which text is parsed as ``entry`` alone."""
    fixtures = parsed(raw, f"struct<id:int,{field}:array<{entry}>>")
    # Columns of their own: an entry's row would otherwise carry the fixture with all its entries.
    lists = fixtures.select(F.col("x.id").alias("fixture_id"), "source", "line", "position", F.col(f"x.{field}").alias("entries"))
    return lists.select("fixture_id", "source", "line", "position", F.posexplode("entries").alias("place", "e"))


def _last(df: DataFrame, keys: list[str], item: str = "position") -> DataFrame:
    """The last row of each key."""
    order = ["source", "line", item, "place"]
    return latest_wins(df, keys, [F.desc(c) for c in order]).drop(*order)


def _together(df: DataFrame) -> DataFrame:
    """Rows dealt by fixture: they are packed best beside each other, and only sorted where they arrive."""
    return df.repartition("fixture_id")


def flatten_participants(raw: DataFrame) -> DataFrame:
    meta = F.col("e.meta")
    rows = _each(raw, "participants", PARTICIPANT).select(
        "fixture_id", first_true(F.col("e.id"), F.col("e.team_id")).try_cast("int").alias("team_id"), F.lower(first_true(meta["location"], meta["venue"], meta["side"])).alias("location"),
        F.coalesce(safe_int(first_true(meta["score"], meta["outcome"])), safe_int(meta["outcome"]), F.when(meta["outcome"].isNull(), safe_int(meta["score"]))).alias("score"), "source", "line", "position", "place",
    )
    return _last(_together(rows.filter("team_id is not null")), ["fixture_id", "team_id"])


def teams_from_participants(raw: DataFrame) -> DataFrame:
    """Partial team rows; apply them with :func:`merge.fill_by_key`, so that only what is given overwrites."""
    e = F.col("e")
    rows = _each(raw, "participants", PARTICIPANT).select(
        first_true(e["id"], e["team_id"]).try_cast("int").alias("id"), first_true(e["name"], e["team_name"], e["display_name"]).alias("name"), first_true(e["short_code"], e["code"]).alias("short_code"),
        first_true(e["image_path"], e["logo_path"], e["logo"]).alias("image_path"), "source", "line", "position", "place",
    ).filter("id is not null")
    order = F.struct("source", "line", "position", "place")
    return rows.groupBy("id").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in ("name", "short_code", "image_path")))


def flatten_team_statistics(raw: DataFrame) -> DataFrame:
    e = F.col("e")
    type_id = F.coalesce(first_true(e["type_id"]), e["type"]["id"].cast("string")).try_cast("int")
    rows = _each(raw, "statistics", STATISTIC).select(
        "fixture_id", first_true(e["participant_id"], e["team_id"]).try_cast("int").alias("team_id"), type_id.alias("type_id"), F.coalesce(first_true(e["type"]["code"]), type_id.cast("string")).alias("code"),
        F.lower(first_true(e["location"])).alias("location"), e["type"]["name"].alias("name"), stat_value(e["data"]).alias("value"), "source", "line", "position", "place",
    )
    return _last(_together(rows.filter("team_id is not null")), ["fixture_id", "team_id", "type_id", "code", "location"])


def _lineups(raw: DataFrame, entry: str = LINEUP) -> DataFrame:
    e = F.col("e")
    ids = _each(raw, "lineups", entry).withColumn("player_id", first_true(e["player_id"], e["player"]["id"]).try_cast("int"))
    return ids.filter("player_id is not null").withColumn("team_id", first_true(e["team_id"], e["team"]["id"], e["participant_id"]).try_cast("int"))


def flatten_players(raw: DataFrame) -> DataFrame:
    p = F.col("e.player")
    rows = _lineups(raw).select(
        F.col("player_id").alias("id"), first_true(p["fullname"], p["name"], F.col("e.player_name")).alias("name"), first_true(p["short_name"], p["short_code"]).alias("short_name"), p["common_name"].alias("common_name"),
        "team_id", first_true(p["image_path"], p["image"], F.col("e.player_image"), F.col("e.image_path")).alias("image_path"), "source", "line", "position", "place",
    )
    return _last(rows, ["id"])


def flatten_fixture_players(raw: DataFrame) -> DataFrame:
    e, p = F.col("e"), F.col("e.player")
    spot = lambda f: F.coalesce(e["detailedposition"][f], e["detailed_position"][f])
    held = lambda f: F.get_json_object(F.when(e["position"].startswith("{"), e["position"]), f"$.{f}")
    position_name = first_true(held("name"), e["position_name"], p["position_name"], p["position"], e["position"])
    detailed_name = first_true(e["detailed_position_name"], p["detailed_position_name"], held("detailed_position_name"), held("name"))
    details = F.transform(e["details"], lambda d: F.struct(F.coalesce(d["type_id"], d["type"]["id"]).alias("type_id"), first_true(d["type"]["name"], d["type"]["code"]).alias("type_name"), stat_value(F.coalesce(first_true(d["data"]), d["value"])).alias("value")))
    rows = _lineups(raw).select(
        "fixture_id", "player_id", "team_id", first_true(e["player_name"], p["fullname"], p["name"]).alias("name"), first_true(e["position"], p["position"], p["position_name"]).alias("position"),
        first_true(e["type"], e["type_id"]).alias("lineup_type"), first_true(e["jersey_number"], e["number"]).alias("jersey_number"), position_name.alias("position_name"), e["formation_field"].alias("formation_field"),
        position_abbr(spot("code"), F.coalesce(first_true(spot("name")), detailed_name, position_name)).alias("position_abbr"), is_starter(first_true(e["type"], e["type_id"], e["lineup_type"])).alias("is_starter"),
        minutes([e["minutes_played"], e["minutes"], e["played_minutes"]], details).alias("minutes_played"), safe_int(e["formation_position"]).alias("formation_position"),
        safe_int(first_true(e["detailed_position_id"], p["detailed_position_id"], held("detailed_position_id"))).alias("detailed_position_id"), detailed_name.alias("detailed_position_name"),
        first_true(e["detailed_position_code"], p["detailed_position_code"], held("detailed_position_code"), held("code")).alias("detailed_position_code"), safe_int(spot("id")).alias("lineup_detailed_position_id"),
        spot("name").alias("lineup_detailed_position_name"), spot("code").alias("lineup_detailed_position_code"), "source", "line", "position", "place",
    )
    return _last_named(rows)


def _last_named(rows: DataFrame) -> DataFrame:
    """The last row of each appearance; a player's own position column stands beside the item's place."""
    names = rows.columns
    item = len(names) - 2
    renamed = rows.toDF(*names[:item], "item_position", names[-1])
    return _last(_together(renamed), ["fixture_id", "player_id"], "item_position")


def flatten_player_statistics(raw: DataFrame) -> DataFrame:
    """Details of every appearance; the value comes from ``data`` or ``value``, so one given as ``stat`` alone is null."""
    # An appearance goes its way in one row, with the details as they are.
    own = ["fixture_id", "player_id", "team_id", "source", "line", "position"]
    rows = _together(_lineups(raw, FACTS).select(*own, F.col("place").alias("entry"), F.col("e.details").alias("details"))).select(*own, "entry", F.posexplode("details").alias("detail", "d"))
    rows = rows.withColumn("place", F.struct("entry", "detail"))
    d = F.col("d")
    type_id = F.coalesce(first_true(d["type_id"]), d["type"]["id"].cast("string")).try_cast("int")
    rows = rows.select("fixture_id", "player_id", type_id.alias("type_id"), F.coalesce(first_true(d["type"]["code"]), type_id.cast("string")).alias("code"), "team_id", d["type"]["name"].alias("name"), stat_value(F.coalesce(first_true(d["data"]), d["value"])).alias("value"), "source", "line", "position", "place")
    return _last(rows, ["fixture_id", "player_id", "type_id", "code"])


def derive_fixture_sides(fixtures: DataFrame, participants: DataFrame) -> DataFrame:
    """Fixtures with null teams and scores filled from their participants."""
    pick = lambda side, c: F.max(F.when(F.col("location") == side, F.col(c))).alias(f"__{side}_{c}")
    sides = participants.groupBy(F.col("fixture_id").alias("id")).agg(*(pick(s, c) for s in ("home", "away") for c in ("team_id", "score")))
    fill = {f"{s}_{c}": F.coalesce(f"{s}_{c}", f"__{s}_{c}") for s in ("home", "away") for c in ("team_id", "score")}
    return fixtures.join(sides, "id", "left").withColumns(fill).select(*fixtures.columns)


def stored_fixtures(raw: DataFrame, folder: str | None = None, schema: str = FIXTURE, text: bool = True) -> DataFrame:
    """Items with an id, parsed once into ``folder`` (a scratch folder by default) as Parquet: ``x`` is what is there.

    ``text`` keeps the items' text beside it, which is what fixtures have as ``extra``.
    """
    own = ["source", "line", "position", *(["item"] if text else [])]
    flat = written(parsed(raw, schema).select(*own, "x.*"), folder or scratch_dir(raw.sparkSession, "parsed"), compression="zstd")
    return flat.select(*own, F.struct(*(c for c in flat.columns if c not in own)).alias("x"))


def build_tables(raw: DataFrame, current: Tables | None = None, folder: str | None = None) -> Tables:
    """All tables of a landing folder of fixtures.

    The text is read and parsed once, into ``folder`` (a scratch folder by default) as Parquet with nested columns; each
    table then reads the columns it is made of. Nothing is cached, and a lost task reads its part again.
    """
    raw = stored_fixtures(raw, folder)
    participants = flatten_participants(raw)
    teams = teams_from_participants(raw)
    return Tables(
        fixtures=derive_fixture_sides(flatten_fixtures(raw), participants), fixture_participants=participants, fixture_statistics=flatten_team_statistics(raw), players=flatten_players(raw),
        fixture_players=flatten_fixture_players(raw), fixture_player_statistics=flatten_player_statistics(raw), teams=teams if current is None or current.teams is None else fill_by_key(current.teams, teams, ["id"]),
    )


def flatten_types(raw: DataFrame) -> DataFrame:
    return parsed(raw, STAT_TYPE).select("x.*")


def in_months(fixtures: DataFrame, first: date, last: date) -> DataFrame:
    """Fixtures that are stored by month: only the months of those days."""
    if "starting_month" not in fixtures.columns:
        return fixtures
    return fixtures.filter(F.col("starting_month").between(first.year * 100 + first.month, last.year * 100 + last.month))


def fixtures_in_window(t: Tables, start: date | str, end: date | str, leagues: list[int] | None = None) -> DataFrame:
    """Fixtures whose UTC day is from ``start`` to ``end``, both included."""
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end)) + timedelta(days=1)
    fx = in_months(t.fixtures, first, last).filter((F.col("starting_at") >= instant(f"{first} 00:00:00")) & (F.col("starting_at") < instant(f"{last} 00:00:00")))
    return fx.filter(F.col("league_id").isin(leagues)) if leagues else fx


def recent_window(t: Tables, as_of: str, leagues=None, days: int = 120) -> DataFrame:
    today = date.fromisoformat(str(as_of)[:10])
    return fixtures_in_window(t, today - timedelta(days=days), today + timedelta(days=1), leagues)


def upcoming_window(t: Tables, as_of: str, leagues=None, days: int = 14) -> DataFrame:
    today = date.fromisoformat(str(as_of)[:10])
    return fixtures_in_window(t, today, today + timedelta(days=days), leagues)


def season_window(seasons: DataFrame, as_of: str) -> DataFrame:
    """``id, first_day, last_day``: a season without a start began a year ago; the current one ends tomorrow at most."""
    today = F.to_date(instant(as_of))
    end = F.coalesce(F.to_date("end_date"), F.date_add(today, 1))
    last = F.when(F.col("is_current"), F.least(end, F.date_add(today, 1))).otherwise(end)
    return seasons.select("id", F.to_date(F.coalesce("start_date", instant(as_of) - F.make_dt_interval(F.lit(365)))).alias("first_day"), last.alias("last_day"))


def keep_seasons(seasons: DataFrame) -> DataFrame:
    """Per league the current season and the newest other one; without a current one, just the first."""
    order = [F.col("is_current").desc_nulls_last(), F.col("end_date").desc_nulls_last(), F.col("id").desc()]
    ranked = seasons.withColumn("rank", F.row_number().over(Window.partitionBy("league_id").orderBy(*order)))
    ranked = ranked.withColumn("has_current", F.max(F.coalesce("is_current", F.lit(False))).over(Window.partitionBy("league_id")))
    return ranked.filter(F.col("rank") <= F.when(F.col("has_current"), 2).otherwise(1)).drop("rank", "has_current")


def history_fixtures(t: Tables, leagues: list[int]) -> DataFrame:
    kept = keep_seasons(t.seasons.filter(F.col("league_id").isin(leagues))).select(F.col("id").alias("season_id"))
    return t.fixtures.join(kept, "season_id", "left_semi")
