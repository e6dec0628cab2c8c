"""Domain tables derived from an orders/lineitem star schema, so that every operator has data to run on.

A fixture is an order, a team a nation, a player a part, an appearance a line item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Tables


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").join(_read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    league = F.col("c_nationkey") % 5
    score = lambda by, of: F.when(F.col("o_orderstatus") != "O", F.floor(F.col("o_totalprice") / by) % of).cast("int")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        league.cast("int").alias("league_id"),
        (league * 10000 + F.year("o_orderdate")).cast("int").alias("season_id"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))).alias("starting_at"),
        F.col("c_nationkey").alias("home_team_id"),
        ((F.col("c_nationkey") + 5 * (1 + F.col("o_orderkey") % 4)) % 25).cast("int").alias("away_team_id"),
        score(1, 4).alias("home_score"),
        score(10, 3).alias("away_score"),
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    fx = fixtures(spark, sf_dir)
    line, part, nation = (_read(spark, sf_dir, n) for n in ("lineitem", "part", "nation"))
    sides = fx.select(F.col("id").alias("fixture_id"), "home_team_id", "away_team_id")
    odd = lambda c: F.col(c) % 2 == 1
    grouped = line.groupBy(F.col("l_orderkey").alias("fixture_id"), F.col("l_partkey").alias("player_id")).agg(F.min("l_linenumber").alias("ln"), F.max("l_quantity").alias("q"))
    lineups = grouped.join(sides, "fixture_id").select(
        "fixture_id", "player_id", F.when(odd("ln"), F.col("home_team_id")).otherwise(F.col("away_team_id")).alias("team_id"), (F.col("ln") <= 4).alias("is_starter"), F.col("q").cast("int").alias("minutes_played")
    )
    key = [F.col("l_orderkey").alias("fixture_id"), F.col("l_partkey").alias("player_id")]
    shots = F.when(F.col("l_returnflag") != "R", F.col("l_quantity") % 5).cast("int")
    kinds = F.explode(F.array(F.struct(F.lit(42).alias("type_id"), shots.alias("value")), F.struct(F.lit(52).alias("type_id"), (F.col("l_quantity") % 3).cast("int").alias("value")))).alias("s")
    player_facts = line.select(*key, "l_returnflag", kinds).filter("s.type_id = 52 or l_returnflag <> 'R'").select("fixture_id", "player_id", "s.type_id", "s.value")
    team_lines = line.join(sides, line["l_orderkey"] == sides["fixture_id"]).withColumn("team_id", F.when(odd("l_linenumber"), F.col("home_team_id")).otherwise(F.col("away_team_id")))
    sums = team_lines.groupBy("fixture_id", "team_id").agg(
        F.sum(F.col("l_quantity") % 5).cast("int").alias("s42"),
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_tax") > 0.06)).cast("int").alias("s83"),
        F.count_if(F.col("l_returnflag") == "A").cast("int").alias("s84"),
    )
    team_facts = sums.select("fixture_id", "team_id", F.explode(F.array(*(F.struct(F.lit(k).alias("type_id"), F.col(f"s{k}").alias("value")) for k in (42, 83, 84)))).alias("s")).select("fixture_id", "team_id", "s.*")
    cents = lambda c: F.round(F.col(c) * 100).cast("int")
    price = ((100 + 20 * cents("l_discount") + 10 * cents("l_tax")) / 100).cast("decimal(10,4)")
    offers = line.select(
        F.col("l_orderkey").alias("fixture_id"), (1 + F.col("l_suppkey") % 3).cast("int").alias("bookmaker_id"),
        F.when(F.col("l_linestatus") == "F", "player_shots").otherwise("player_shots_on_target").alias("market_key"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("selection_key"),
        F.lit("player").alias("participant_type"), F.when(F.col("l_tax") != 0, F.col("l_partkey")).alias("participant_id"), (0.5 + F.col("l_linenumber") % 3).cast("decimal(10,2)").alias("line"), price.alias("price_decimal"),
    ).distinct()
    seasons = fx.select("season_id").distinct().select(
        F.col("season_id").alias("id"), F.expr("season_id div 10000").cast("int").alias("league_id"), (F.col("season_id") % 10000 == 2001).alias("is_current"),
        F.make_timestamp(F.col("season_id") % 10000, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("start_date"),
        F.make_timestamp(F.col("season_id") % 10000, F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias("end_date"),
    )
    both = F.explode(F.array(F.struct(F.col("home_team_id").alias("team_id"), F.lit("home").alias("location"), F.col("home_score").alias("score")), F.struct(F.col("away_team_id").alias("team_id"), F.lit("away").alias("location"), F.col("away_score").alias("score")))).alias("s")
    dec = price.cast("double")
    over = F.when(odd("l_linenumber"), 1.5 + F.col("l_partkey") % 4).otherwise(3.5 + F.col("l_partkey") % 6)
    market = F.when(odd("l_linenumber"), 285).otherwise(292)
    payload = F.to_json(F.struct(F.concat(F.lit("Over "), over.cast("string")).alias("total"), F.when(F.col("l_linenumber") % 4 == 1, "1").otherwise("2").alias("label")))
    latest = line.select(F.col("l_orderkey").alias("fixture_id"), F.lit(2).alias("bookmaker_id"), market.alias("market_id"), F.lit("Over").alias("selection"), F.lit(None).cast("string").alias("line"), dec.alias("decimal_odds"), payload.alias("raw"), F.col("l_shipdate").cast("timestamp").alias("pulled_at"))
    shots_json = F.to_json(F.array(F.struct(F.struct(F.lit("SHOTS_TOTAL").alias("developer_name")).alias("type"), F.struct(F.col("value").alias("value")).alias("data"))))
    details = F.to_json(F.array(F.struct(F.col("type_id"), F.struct(F.col("value").alias("value")).alias("data"))))
    names = [(42, "Shots Total", "shots-total"), (52, "Goals", "goals"), (83, "Redcards", "redcards"), (84, "Yellowcards", "yellowcards"), (85, "Yellowred Cards", "yellowred-cards"), (5304, "Expected Goals (xG)", "expected-goals")]
    return Tables(
        fixtures=fx,
        teams=nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("short_code"), F.lit(None).cast("string").alias("image_path")),
        players=part.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_brand").alias("name"), F.col("p_name").alias("common_name"), F.col("p_brand").alias("short_name"), (F.col("p_partkey") % 25).cast("int").alias("team_id")),
        fixture_players=lineups,
        fixture_player_statistics=player_facts,
        fixture_statistics=team_facts,
        fixture_participants=fx.select(F.col("id").alias("fixture_id"), both).select("fixture_id", "s.*"),
        seasons=seasons,
        types=spark.createDataFrame(names, "id int, name string, code string"),
        odds_outcomes=offers,
        odds_latest=latest,
        player_odds=line.filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("fixture_id"), F.col("l_partkey").alias("player_id"), F.lit(268).alias("market_id"), (0.5 + F.col("l_linenumber") % 3).alias("line"), dec.alias("decimal_odds")).distinct(),
        team_stats=team_facts.filter("type_id = 42").select("fixture_id", "team_id", shots_json.alias("stats")),
        player_stats=player_facts.select("fixture_id", "player_id", details.alias("stats")).join(lineups.select("fixture_id", "player_id", "team_id"), ["fixture_id", "player_id"]),
        odds_snapshots=snapshots(line, part),
    )


def snapshots(line: DataFrame, part: DataFrame) -> DataFrame:
    """Odds payloads, one for each order and ship date, with every line item as an offer on its player."""
    offer = lambda x: F.struct(
        F.when(x["l_linestatus"] == "F", 268).otherwise(267).alias("market_id"), F.concat_ws(" ", x["p_name"], x["p_brand"]).alias("name"), F.concat(F.lit("Over "), (0.5 + x["l_linenumber"] % 3).cast("string")).alias("label"),
        F.round(1 + x["l_discount"], 2).cast("string").alias("value"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
    )
    # Line items are gathered as they are, offers made after that.
    own = F.struct("l_linestatus", "p_name", "p_brand", "l_linenumber", "l_discount")
    gathered = line.join(part, line["l_partkey"] == part["p_partkey"]).groupBy("l_orderkey", "l_shipdate").agg(F.collect_list(own).alias("lines"))
    rows = gathered.select("l_orderkey", "l_shipdate", F.array_sort(F.transform("lines", offer)).alias("data"))
    return rows.select(
        F.xxhash64("l_orderkey", "l_shipdate").alias("id"), F.col("l_orderkey").alias("fixture_id"), F.lit(2).alias("bookmaker_id"), F.col("l_shipdate").cast("timestamp").alias("pulled_at"), F.to_json(F.struct("data")).alias("raw")
    )


def _landing(df: DataFrame, turn: str, item) -> DataFrame:
    """Payload rows as :func:`ingest.read_raw_payloads` gives them: ``source, line, position, item``."""
    return df.select(F.lit("derived").alias("source"), F.col(turn).alias("line"), F.lit(0).alias("position"), F.to_json(item).alias("item"))


def season_payloads(seasons: DataFrame) -> DataFrame:
    """A season's league is a number or an object, its dates have either name."""
    odd, text = F.col("id") % 2 == 1, lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    item = F.struct(
        "id", F.when(odd, F.col("league_id")).alias("league_id"), F.when(~odd, F.struct(F.col("league_id").alias("id"))).alias("league"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("name"),
        F.when(odd, text("start_date")).alias("start_date"), F.when(~odd, text("start_date")).alias("starting_at"), text("end_date").alias("end_date"), F.when(odd, F.col("is_current")).alias("is_current"), F.when(~odd, F.col("is_current")).alias("current"),
    )
    return _landing(seasons, "id", item)


def team_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams as customers name them: each of a nation's customers gives the nation another name."""
    names = _read(spark, sf_dir, "customer").join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    item = F.struct(F.col("n_nationkey").alias("id"), F.concat_ws(" ", "n_name", F.col("c_custkey").cast("string")).alias("name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("short_code"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("logo"), F.col("c_custkey").cast("string"))).alias("logo_path"))
    return _landing(names, "c_custkey", item)


def type_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("code"), F.upper("p_name").alias("developer_name"), F.col("p_type").alias("stat_group"))
    return _landing(_read(spark, sf_dir, "part"), "p_partkey", item)


LINE_ORDER = ("l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_discount", "l_tax")


def fixture_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload an order: its teams as participants, its line items as line-ups with details, their sums as statistics.

    Fields come and go by number, so that every way of finding a value is used; repeated parts of an order are line-ups
    of one player given twice.
    """
    fx, nation = fixtures(spark, sf_dir), _read(spark, sf_dir, "nation")
    named = lambda side: nation.select(F.col("n_nationkey").alias(f"{side}_team_id"), F.col("n_name").alias(f"{side}_name"))
    line = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    code = lambda c: F.struct(F.lit(c).alias("code"))
    detail = lambda type_id, type_, data, value: F.struct(F.lit(type_id).cast("int").alias("type_id"), type_.alias("type"), data.alias("data"), value.alias("value"))
    a_type = lambda i, c, name: F.struct(F.lit(i).cast("int").alias("id"), F.lit(c).cast("string").alias("code"), F.lit(name).cast("string").alias("name"))
    data = lambda v: F.struct(v.alias("value"))
    no_value = F.lit(None).cast("int")
    # Line items are gathered as they are; payloads, which are many times as large, are only made where an order's are together.
    lines = line.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct(*LINE_ORDER, "p_name", "p_brand"))).alias("lines"))
    both = fx.join(named("home"), "home_team_id").join(named("away"), "away_team_id").join(lines, "id")
    goals = lambda side, kind: F.struct(F.lit(kind).alias("type_id"), F.struct(F.lit(side).alias("participant"), F.when(F.lit(kind) == 1525, F.col(f"{side}_score")).otherwise(9).alias("goals")).alias("score"))
    listed = F.to_json(F.array(goals("home", 1), goals("home", 1525), goals("away", 1525), goals("away", 2)))
    flat = F.to_json(F.struct(F.col("home_score").cast("string").alias("localteam_score"), F.lit(7).alias("home"), F.col("away_score").alias("visitorteam_score"), F.col("away_score").alias("away")))
    third = F.col("id") % 3
    side = lambda s: F.struct(
        F.when(third != 1, F.col(f"{s}_team_id")).alias("id"), F.when(third == 1, F.col(f"{s}_team_id")).alias("team_id"), F.when(third != 0, F.concat_ws(" ", f"{s}_name", F.col("id").cast("string"))).alias("name"),
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("C"), F.col("id").cast("string"))).alias("short_code"), F.struct(F.lit(s).alias("location"), F.col(f"{s}_score").cast("string").alias("score")).alias("meta"),
    )
    odd = lambda x: x["l_linenumber"] % 2 == 1
    team = lambda x: F.when(odd(x), F.col("home_team_id")).otherwise(F.col("away_team_id"))
    sums = F.transform("lines", lambda x: F.struct(F.lit(42).alias("type_id"), a_type(42, "shots-total", "Shots Total").alias("type"), team(x).alias("participant_id"), F.when(odd(x), "Home").otherwise("Away").alias("location"), data((x["l_quantity"] % 5).cast("int")).alias("data")))

    def entry(x: Column) -> Column:
        n, q, part = x["l_linenumber"], x["l_quantity"].cast("int"), x["l_partkey"]
        details = F.array(
            detail(42, a_type(42, "shots-total", "Shots Total"), data(F.when(x["l_returnflag"] != "R", q % 5)), no_value), detail(119, a_type(119, None, "Minutes Played"), data(q), no_value),
            detail(None, a_type(52, None, "Goals"), data(no_value), q % 3),
        )
        spot = F.when(n % 4 == 1, F.struct(F.lit(24).alias("id"), F.lit("Centre Back").alias("name"), F.lit("centre-back").alias("code")))
        return F.struct(
            F.when(n % 3 != 0, part).alias("player_id"), F.struct(part.alias("id"), F.concat_ws(" ", x["p_name"], x["p_brand"]).alias("fullname"), x["p_name"].alias("common_name"), x["p_brand"].alias("short_name")).alias("player"),
            F.when(odd(x), x["p_name"]).alias("player_name"), F.when(n <= 4, 11).otherwise(12).alias("type_id"), F.when(n % 4 == 0, "Goalkeeper").when(n % 4 == 3, "Striker").alias("position"), n.alias("jersey_number"), n.cast("string").alias("formation_position"),
            F.when(odd(x), q).alias("minutes_played"), spot.alias("detailedposition"), details.alias("details"), team(x).alias("team_id"),
        )

    lineups = F.transform("lines", entry)
    even = F.col("id") % 2 == 0
    head = F.to_json(F.struct(
        "id", "league_id", "season_id", F.date_format("starting_at", "yyyy-MM-dd HH:mm:ss").alias("starting_at"), F.when(even, F.col("home_team_id")).alias("home_team_id"), F.when(even, F.col("away_team_id")).alias("away_team_id"),
        F.struct(F.lit("FT").alias("state")).alias("state"), F.array(side("home"), side("away")).alias("participants"), sums.alias("statistics"), lineups.alias("lineups"),
    ))
    # Scores are a list or an object, so they are put in as text.
    scores = F.when(third == 0, flat).otherwise(listed)
    item = F.concat(F.lit('{"scores":'), scores, F.lit(","), F.ltrim(head, F.lit("{")))
    # A generator makes the text: what reads several of its fields would otherwise make it for each.
    return both.select(F.lit("derived").alias("source"), F.col("id").alias("line"), F.lit(0).alias("position"), F.explode(F.array(item)).alias("item"))
