"""Odds: payload rows to outcomes with resolved participants, upserts, and queries over prices."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.exprs import first_true, fold_name, market_key, parse_dt, parse_float, parse_line, participant_type, safe_int, slug
from ..schemas import Tables
from ..sources.merge import latest_wins
from ..sources.sinks import window_ids
from .core import day, instant, london_date


def odds_target_fixtures(t: Tables, *, leagues: list[int], as_of: str, days: int) -> DataFrame:
    ids = window_ids(t, as_of, days, leagues)
    return t.fixtures.join(ids.withColumnRenamed("fixture_id", "id"), "id", "left_semi").select("id", "league_id", "starting_at", "home_team_id", "away_team_id")


def payload_rows(snapshots: DataFrame) -> DataFrame:
    """One row per entry of ``data`` in ``snapshots(fixture_id, bookmaker_id, pulled_at, raw)``: its JSON text as ``row``."""
    rows = F.posexplode(F.from_json("raw", "data array<string>")["data"]).alias("place", "row")
    return snapshots.select("fixture_id", "bookmaker_id", "pulled_at", rows)


#: Fields of an offer, each as its text.
OFFER = ", ".join(f"{c} string" for c in "market_id market_description market name label total handicap line value dp3 american latest_bookmaker_update updated_at".split())


def parsed_rows(snapshots: DataFrame) -> DataFrame:
    """Outcome columns of every payload row with a price; participants are not resolved yet."""
    row, x = F.col("row"), F.col("x")
    get = lambda name: x[name]
    price = parse_float(first_true(get("value"), get("dp3"))).cast("decimal(10,4)")
    # A generator makes the parsed rows: a filter on them that moved below a projection would parse them again.
    rows = F.transform(F.from_json("raw", "data array<string>")["data"], lambda r: F.struct(r.alias("row"), F.from_json(r, OFFER).alias("x")))
    offers = snapshots.select("fixture_id", "bookmaker_id", "pulled_at", F.posexplode(rows).alias("place", "o")).select("fixture_id", "bookmaker_id", "pulled_at", "place", "o.row", "o.x")
    offers = offers.withColumn("price_decimal", price).filter("price_decimal is not null")
    # Texts that several columns read are made once, in a projection of their own.
    texts = offers.select(
        "fixture_id", "bookmaker_id", "pulled_at", "place", "row", "x", "price_decimal", market_key(row, x).alias("market_key"),
        F.coalesce(first_true(get("name"), get("total"), get("label")), F.lit("")).alias("name"), F.coalesce(first_true(get("label"), get("total")), F.lit("")).alias("label"),
    )
    return texts.select(
        "fixture_id", "bookmaker_id", "pulled_at", "place", "market_key", slug(F.trim(F.concat("name", F.lit(" "), "label"))).alias("selection_key"), "name",
        participant_type(get("market_description"), F.col("market_key")).alias("declared_type"), parse_line(row, x).cast("decimal(10,2)").alias("line"),
        "price_decimal", safe_int(get("american")).alias("price_american"), parse_dt(first_true(get("latest_bookmaker_update"), get("updated_at"))).alias("last_updated_at"),
    )


def _aliases(*names: str) -> Column:
    """What a row's names fold to, each once."""
    return F.array_distinct(F.filter(F.array(*map(fold_name, names)), lambda x: x != "")).alias("aliases")


def _alias_rows(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.explode("aliases").alias("folded"))


def team_aliases(t: Tables) -> DataFrame:
    """``team_id, folded`` by names and short codes."""
    return _alias_rows(t.teams.select(F.col("id").alias("team_id"), _aliases("name", "short_code")), "team_id")


def team_name_map(t: Tables, fixtures: DataFrame) -> DataFrame:
    """``fixture_id, folded, team_id`` of the two teams of each fixture; the larger id where names clash."""
    sides = fixtures.select(F.col("id").alias("fixture_id"), F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    return sides.join(team_aliases(t), "team_id").groupBy("fixture_id", "folded").agg(F.max("team_id").alias("team_id"))


def fixture_player_name_map(t: Tables, fixtures: DataFrame) -> DataFrame:
    """``fixture_id, folded, player_id`` by the names of a fixture's line-ups; the smallest id where names clash."""
    ids = fixtures.select(F.col("id").alias("fixture_id"))
    own = F.col("name") if "name" in t.fixture_players.columns else F.lit(None).cast("string")
    rows = t.fixture_players.join(ids, "fixture_id", "left_semi").select("fixture_id", "player_id", own.alias("own"))
    players = t.players.select(F.col("id").alias("player_id"), _aliases("name", "common_name", "short_name").alias("known"))
    named = rows.join(players, "player_id", "left").withColumn("aliases", F.concat(F.coalesce("known", F.array().cast("array<string>")), _aliases("own")))
    # Dealt by fixture: what needs a fixture's names together finds them so.
    return _alias_rows(named, "fixture_id", "player_id").repartition("fixture_id").groupBy("fixture_id", "folded").agg(F.min("player_id").alias("player_id"))


def squad_name_map(t: Tables) -> DataFrame:
    """``team_id, folded, player_id`` by the names of each team's players; the smallest id where names clash."""
    if "team_id" not in t.players.columns:
        return t.players.select(F.lit(None).cast("int").alias("team_id"), F.lit("").alias("folded"), F.col("id").alias("player_id")).filter("false")
    named = t.players.filter("team_id is not null").select(F.col("id").alias("player_id"), "team_id", _aliases("name", "common_name", "short_name"))
    return _alias_rows(named, "team_id", "player_id").groupBy("team_id", "folded").agg(F.min("player_id").alias("player_id"))


#: Parts that the fixtures of the same teams are dealt into, so that no task gets all of them.
DEALT = 32
#: Fixtures of the same teams that each name is listed for at once.
BLOCK = 128


def fixture_squad_name_map(t: Tables, fixtures: DataFrame) -> DataFrame:
    """``fixture_id, folded, player_id`` by the names of both teams' players; the smallest id where names clash.

    Names are reduced once for each set of teams that meet; what grows with fixtures times names is the result alone.
    Its rows come by blocks of fixtures, and in a block by name, so that each column repeats itself: as Parquet they take
    a fraction of what they take fixture by fixture.
    """
    sides = fixtures.select(F.col("id").alias("fixture_id"), F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    sides = sides.groupBy("fixture_id").agg(F.array_sort(F.collect_set("team_id")).alias("teams"))
    met = sides.select("teams").distinct().select("teams", F.explode("teams").alias("team_id"))
    names = met.join(squad_name_map(t), "team_id").groupBy("teams", "folded").agg(F.min("player_id").alias("player_id"))
    copies = names.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    dealt = sides.withColumn("part", F.pmod(F.hash("fixture_id"), F.lit(DEALT)))
    place = F.row_number().over(Window.partitionBy("teams", "part").orderBy("fixture_id"))
    blocks = dealt.withColumn("block", F.floor((place - 1) / BLOCK)).groupBy("teams", "part", "block").agg(F.collect_list(F.struct("fixture_id")).alias("block_fixtures"))
    # A merge streams the blocks; a broadcast would leave the result to the few tasks that so small a table of them has.
    listed = blocks.join(copies.hint("merge"), ["teams", "part"]).select(F.explode("block_fixtures").alias("f"), "folded", "player_id")
    return listed.select("f.fixture_id", "folded", "player_id")


def as_it_is(name: str, df: DataFrame) -> DataFrame:
    return df


def named_participants(t: Tables, names: DataFrame, fixtures: DataFrame, lookup: Callable[[str, DataFrame], DataFrame] = as_it_is) -> DataFrame:
    """``names(fixture_id, name, ...)`` with ``team_id`` and ``player_id`` of those that a fixture knows by that name.

    A player is looked for in the fixture's line-ups, then among its teams' players; the smallest id where several have
    the name, the larger of two teams. Names are folded once for each player and team, and looked up by (team, name):
    no fixture is ever joined with its whole squads. ``lookup`` gets the names of teams and of squads by name and returns
    them, as to be broadcast.
    """
    sides = fixtures.select(F.col("id").alias("fixture_id"), "home_team_id", "away_team_id")
    # A fixture's line-ups are few names: they come with its teams, so that names are dealt by fixture once.
    lineup = fixture_player_name_map(t, fixtures).groupBy("fixture_id").agg(F.map_from_entries(F.collect_list(F.struct("folded", "player_id"))).alias("lineup"))
    known = sides.join(lineup, "fixture_id", "left")
    out = names.withColumn("folded", fold_name("name")).join(known, "fixture_id", "left").withColumn("lineup_id", F.try_element_at("lineup", F.col("folded"))).drop("lineup")
    teams, squads = lookup("teams", team_aliases(t).withColumn("found", F.col("team_id"))), lookup("squads", squad_name_map(t).withColumnRenamed("player_id", "found"))
    for side in ("home", "away"):
        for of, known in (("team", teams), ("squad", squads)):
            out = out.join(known.select(F.col("team_id").alias(f"{side}_team_id"), "folded", F.col("found").alias(f"{side}_{of}")), [f"{side}_team_id", "folded"], "left")
    return out.select(*names.columns, F.greatest("home_team", "away_team").alias("team_id"), F.coalesce("lineup_id", F.least("home_squad", "away_squad")).alias("player_id"))


def parse_outcomes(t: Tables, snapshots: DataFrame, fixtures: DataFrame, lookup: Callable[[str, DataFrame], DataFrame] = as_it_is) -> DataFrame:
    """Outcomes of all snapshots with participants: players by line-up, then by squad; teams by the fixture's two names."""
    named = named_participants(t, parsed_rows(snapshots), fixtures, lookup)
    kind = F.coalesce("declared_type", F.when(F.col("team_id").isNotNull(), "team"))
    who = F.when(F.col("participant_type") == "player", F.col("player_id")).when(F.col("participant_type") == "team", F.col("team_id"))
    named = named.withColumn("participant_type", kind).withColumn("participant_id", who.cast("long"))
    return named.select("fixture_id", "bookmaker_id", "market_key", "selection_key", "participant_type", "participant_id", "line", "price_decimal", "price_american", "last_updated_at", "pulled_at", "place", "name")


def unmatched_player_odds(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("participant_type = 'player' and participant_id is null").select("fixture_id", "market_key", "selection_key", "name")


OUTCOME_KEY = ["fixture_id", "bookmaker_id", "market_key", "selection_key", "line"]


def latest_in_batch(outcomes: DataFrame) -> DataFrame:
    """One row a key within a batch: of the newest pull its last row; rows without a line all stay."""
    # Both kinds in one pass: a union of the two would read and parse all payloads for each.
    newest = Window.partitionBy(*OUTCOME_KEY).orderBy(F.col("pulled_at").desc_nulls_last(), F.desc("place"))
    return outcomes.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1 or line is null").drop("__rank")


def upsert_outcomes(current: DataFrame, new: DataFrame) -> DataFrame:
    """``current`` after ``new`` (a key once): prices overwrite, participants only where the new row knows them.

    A null line equals nothing, so such rows always add.
    """
    columns = current.columns
    fresh = new.select(*OUTCOME_KEY, *(F.col(c).alias(f"__{c}") for c in columns if c not in OUTCOME_KEY), F.lit(True).alias("__new"))
    keep = {"participant_type", "participant_id"}
    both = current.join(fresh, OUTCOME_KEY, "full_outer")
    value = lambda c: F.coalesce(f"__{c}", c) if c in keep else F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c))
    return both.select(*(F.col(c) if c in OUTCOME_KEY else value(c).alias(c) for c in columns))


def odds_latest(outcomes: DataFrame) -> DataFrame:
    """The newest pulled price of each fixture, bookmaker, market and selection."""
    return latest_wins(outcomes, ["fixture_id", "bookmaker_id", "market_key", "selection_key", "line"], [F.col("pulled_at").desc_nulls_last(), F.desc("place")])


LISTED = ["fixture_id", "bookmaker_id", "market_key", "selection_key", "participant_type", "participant_id", "line", "price_decimal"]


def fixture_odds(t: Tables, *, fixture: int, bookmaker: int = 2) -> DataFrame:
    rows = t.odds_outcomes.filter((F.col("fixture_id") == fixture) & (F.col("bookmaker_id") == bookmaker))
    return rows.orderBy("market_key", "selection_key")


def player_odds_next_days(t: Tables, *, league: int, days: int, market: str, line: float | None = None, bookmaker: int = 2, as_of=None) -> DataFrame:
    now = instant(as_of)
    fx = t.fixtures.filter((F.col("league_id") == league) & (F.col("starting_at") >= now) & (F.col("starting_at") < now + F.make_dt_interval(F.lit(days))))
    rows = t.odds_outcomes.filter((F.col("bookmaker_id") == bookmaker) & (F.col("market_key") == market) & F.col("participant_id").isNotNull())
    if line is not None:
        rows = rows.filter(F.col("line") == line)
    out = rows.join(fx.select(F.col("id").alias("fixture_id"), "starting_at"), "fixture_id")
    out = out.select("fixture_id", "starting_at", F.col("participant_id").alias("player_id"), "selection_key", "line", "price_decimal")
    return out.orderBy(F.col("price_decimal").desc_nulls_last(), "fixture_id", "selection_key", "line")


def filter_players_by_odds(t: Tables, players: DataFrame, *, on: str | date, league: int, market: str, line=None, least=None, most=None, bookmaker: int | None = None, days: int = 1) -> DataFrame:
    """Best price of each of ``players(player_id)`` in a range of London days; ties go to the newest fixture id."""
    at = london_date(F.col("starting_at"))
    fx = t.fixtures.filter((F.col("league_id") == league) & (at >= day(on)) & (at < F.date_add(day(on), days))).select(F.col("id").alias("fixture_id"), "starting_at")
    rows = t.odds_outcomes.filter(F.col("market_key") == market)
    for value, condition in ((bookmaker, F.col("bookmaker_id") == bookmaker), (line, F.col("line") == line), (least, F.col("price_decimal") >= least), (most, F.col("price_decimal") <= most)):
        if value is not None:
            rows = rows.filter(condition)
    found = rows.join(fx, "fixture_id").withColumn("player_id", F.col("participant_id")).join(players.select("player_id").distinct(), "player_id", "left_semi")
    order = [F.col("price_decimal").desc_nulls_last(), F.desc("fixture_id"), "line", "selection_key", "bookmaker_id"]
    one = found.withColumn("rank", F.row_number().over(Window.partitionBy("player_id").orderBy(*order))).filter("rank = 1")
    return one.select("player_id", "fixture_id", "starting_at", "price_decimal", "line", "market_key", "selection_key", "bookmaker_id")


def odds_coverage(t: Tables, *, as_of, league: int = 8, days: int = 14, least_players: int = 20, least_pct: float = 80) -> DataFrame:
    """Distinct mapped players with a 0.5 shots-on-target line and the share of mapped player outcomes, with the gate."""
    today, at = london_date(instant(as_of)), london_date(F.col("starting_at"))
    fx = t.fixtures.filter((F.col("league_id") == league) & (at >= today) & (at < F.date_add(today, days))).select(F.col("id").alias("fixture_id"))
    rows = t.odds_outcomes.filter("participant_type = 'player'").join(fx, "fixture_id", "left_semi")
    wanted = (F.col("market_key") == "player_shots_on_target") & (F.col("line") == 0.5)
    pct = F.round(100.0 * F.count("participant_id") / F.nullif(F.count(F.lit(1)), F.lit(0)), 2)
    out = rows.agg(F.countDistinct(F.when(wanted, F.col("participant_id"))).alias("distinct_sot_05_players"), pct.alias("mapped_pct_player_outcomes"))
    enough = (F.col("distinct_sot_05_players") >= least_players) & (F.coalesce("mapped_pct_player_outcomes", F.lit(0.0)) >= least_pct)
    return out.withColumn("passed", enough)
