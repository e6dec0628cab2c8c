"""Form tables and value bets: form, opponent context and odds together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.exprs import over_line
from ..schemas import Tables
from .core import instant, last_n, latest_team, sequence, stat_value

STATS = "array<struct<type:struct<developer_name:string,name:string>,data:struct<value:string>>>"
TEAM_LINES = (8.5, 9.5, 10.5, 11.5, 12.5, 13.5)
MATCH_LINES = tuple(22.5 + i for i in range(9))


def parse_shot_stats(stats: Column, last: bool = True) -> tuple[Column, Column]:
    """Shots and shots on target of a JSON list of statistics: the last entry that matches (or the first); a null value is 0."""
    entries = F.from_json(stats, STATS)
    name = lambda s: F.lower(F.coalesce(F.nullif(s["type"]["developer_name"], F.lit("")), s["type"]["name"], F.lit("")))

    def pick(*words: str) -> Column:
        match = F.filter(entries, lambda s: name(s).contains(words[0]) | name(s).contains(words[1]))
        hit = F.try_element_at(match, F.lit(-1 if last else 1))
        return F.when(F.size(match) > 0, F.coalesce(hit["data"]["value"].try_cast("double"), F.lit(0.0)))

    return pick("shots_total", "shots total"), pick("shots_on_target", "shots on target")


def newest_games(t: Tables, asked: DataFrame, n: int) -> DataFrame:
    """``fixture_id`` of the newest ``n`` fixtures with statistics of two teams of each of ``asked(team_id)``; no statistic is read."""
    sides = t.team_stats.groupBy("fixture_id").agg(F.collect_list("team_id").alias("teams")).filter("size(teams) >= 2").select("fixture_id", F.explode("teams").alias("team_id"))
    dated = sides.join(asked.select("team_id").distinct(), "team_id", "left_semi").join(t.fixtures.filter("starting_at is not null").select(F.col("id").alias("fixture_id"), "starting_at"), "fixture_id")
    return last_n(dated, "team_id", n).select("fixture_id").distinct()


def team_shot_form(t: Tables, last: bool = True, asked: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """``fixture_id, starting_at, team_id, opponent_id, shots_for, shots_against, match_shots`` of fixtures with two teams.

    With ``asked(team_id)`` only those of their newest ``n`` games; only their statistics are parsed.
    """
    shots, _ = parse_shot_stats(F.col("stats"), last)
    fx = t.fixtures.filter("starting_at is not null").select(F.col("id").alias("fixture_id"), "starting_at", "home_team_id", "away_team_id")
    stats = t.team_stats if asked is None else t.team_stats.join(newest_games(t, asked, n), "fixture_id", "left_semi")
    rows = stats.select("fixture_id", "team_id", shots.alias("shots"))
    both = rows.groupBy("fixture_id").agg(F.collect_list(F.struct("team_id", "shots")).alias("sides")).filter("size(sides) >= 2").join(fx, "fixture_id")
    one = both.select("fixture_id", "starting_at", "home_team_id", "away_team_id", "sides", F.explode("sides").alias("s")).select("*", "s.team_id", F.col("s.shots").alias("shots_for"))
    other = F.try_element_at(F.filter("sides", lambda x: x["team_id"] != F.col("team_id")), F.lit(1))["team_id"]
    opponent = F.coalesce(F.when(F.col("team_id") == F.col("home_team_id"), F.col("away_team_id")).when(F.col("team_id") == F.col("away_team_id"), F.col("home_team_id")), other)
    one = one.withColumn("opponent_id", opponent)
    against = F.try_element_at(F.filter("sides", lambda x: x["team_id"] == F.col("opponent_id")), F.lit(1))["shots"]
    one = one.withColumn("shots_against", against)
    return one.select("fixture_id", "starting_at", "team_id", "opponent_id", "shots_for", "shots_against", (F.col("shots_for") + F.col("shots_against")).alias("match_shots"))


def shot_over_odds(odds: DataFrame, bookmaker: int = 2) -> DataFrame:
    """``fixture_id, side, line, odds``: overs of match shots (292) and team shots (285).

    Of several prices for one line the last row wins: the newest ``pulled_at``, then the largest ``place`` (of those
    columns that ``odds`` has), then the price, so that the result doesn't hang on the order of reading.
    """
    total = F.coalesce(F.nullif(F.col("x.total"), F.lit("")), F.nullif(F.col("selection"), F.lit("")), F.col("line").cast("string"))
    label = F.lower("x.label")
    side = F.when(F.col("market_id") == 292, "match").when(label == "1", "home").when(label == "2", "away")
    under = F.coalesce(F.lower("selection").contains("under"), F.lit(False)) | F.lower(total).contains("under")
    priced = odds.filter((F.col("bookmaker_id") == bookmaker) & F.col("market_id").isin(292, 285))
    # Parsed by a generator, once: filters on what was parsed stay above it.
    rows = priced.select("*", F.explode(F.array(F.from_json("raw", "total string, label string"))).alias("x")).filter(~under)
    order = F.struct(*(F.col(c) for c in ("pulled_at", "place") if c in odds.columns), F.col("decimal_odds").cast("double").alias("odds")).alias("order")
    rows = rows.select("fixture_id", side.alias("side"), over_line(total).alias("line"), order)
    return rows.filter("side is not null and line is not null").groupBy("fixture_id", "side", "line").agg(F.max("order")["odds"].alias("odds"))


def rate_over(games: DataFrame, by: list[str], value: str, line: str, least: int) -> DataFrame:
    """Share of the known values of each group at or over its line: ``pct, total, avg, seq``; groups with fewer go."""
    known = F.col(value).isNotNull()
    rates = games.filter(known).groupBy(*by).agg(
        F.avg((F.col(value) >= F.col(line)).cast("double")).alias("pct"), F.count(F.lit(1)).alias("total"), F.avg(value).alias("avg"), sequence(F.col(value).cast("int")).alias("seq")
    )
    return rates.filter(F.col("total") >= least)


def best_rate(asked: DataFrame, form: DataFrame, value: str, sizes: tuple[int, ...], least: int) -> DataFrame:
    """For each asked ``team_id, line`` the best share over the sample sizes; of equal shares the smaller sample.

    Samples are cut before unknown values are dropped.
    """
    return best_rates(asked.withColumn("metric", F.lit(value)), form, [value], sizes, least).drop("metric")


def best_rates(asked: DataFrame, form: DataFrame, values: list[str], sizes: tuple[int, ...], least: int) -> DataFrame:
    """As :func:`best_rate` for each asked ``team_id, line, metric``, a metric being one of the columns ``values``.

    Only the asked teams' games are ranked, once for all metrics.
    """
    asked = asked.select("team_id", "line", "metric").distinct()
    own = form.join(asked.select("team_id").distinct(), "team_id", "left_semi")
    newest = last_n(own, "team_id", max(sizes)).select("team_id", "rn", F.explode(F.array(*(F.struct(F.lit(v).alias("metric"), F.col(v).alias("value")) for v in values))).alias("m"))
    sampled = newest.select("team_id", "rn", "m.metric", "m.value", F.explode(F.array(*(F.lit(s) for s in sizes))).alias("size")).filter("rn <= size and value is not null")
    rates = rate_over(asked.join(sampled, ["team_id", "metric"]), ["team_id", "line", "metric", "size"], "value", "line", least)
    best = rates.groupBy("team_id", "line", "metric").agg(F.max_by(F.struct("pct", "total", "avg", "seq", "size"), F.struct("pct", (-F.col("size")).alias("less"))).alias("best"))
    return best.select("team_id", "line", "metric", "best.*")


def _joined(rows: DataFrame, rates: DataFrame, team: str, prefix: str, metric: str | None = None) -> DataFrame:
    names = {"pct": f"{prefix}_pct", "avg": f"{prefix}_avg", "total": f"{prefix}_samples", "size": f"{prefix}_sample_size", "seq": f"{prefix}_seq"}
    keys = [F.col("team_id").alias(team), "line"] + ([F.col("metric").alias(metric)] if metric else [])
    return rows.join(rates.select(*keys, *(F.col(a).alias(b) for a, b in names.items())), [team, "line"] + ([metric] if metric else []))


def team_shot_value_bets(
    t: Tables, *, as_of, require_odds: bool = True, min_pct: float = 0.8, min_samples: int = 8, lookback: int = 2, lookahead: int = 14, sizes: tuple[int, ...] = (10, 20), limit: int | None = 80
) -> DataFrame:
    """Team and match shot overs of near fixtures where both sides' recent shares reach ``min_pct``."""
    near = F.col("starting_at").between(instant(as_of) - F.make_dt_interval(F.lit(lookback)), instant(as_of) + F.make_dt_interval(F.lit(lookahead)))
    fx = t.fixtures.filter(near).select(F.col("id").alias("fixture_id"), "starting_at", "home_team_id", "away_team_id")
    sides = fx.select("*", F.explode(F.array(F.lit("home"), F.lit("away"), F.lit("match"))).alias("side"))
    lines = sides.join(shot_over_odds(t.odds_latest), ["fixture_id", "side"], "inner" if require_odds else "left")
    if not require_odds:
        usual = F.when(F.col("side") == "match", F.array(*map(F.lit, MATCH_LINES))).otherwise(F.array(*map(F.lit, TEAM_LINES)))
        lines = lines.withColumn("line", F.explode(F.when(F.col("line").isNull(), usual).otherwise(F.array("line"))))
    own = F.when(F.col("side") == "away", F.col("away_team_id")).otherwise(F.col("home_team_id"))
    other = F.when(F.col("side") == "away", F.col("home_team_id")).otherwise(F.col("away_team_id"))
    lines = lines.select("fixture_id", "starting_at", "side", "line", "odds", own.alias("team_id"), other.alias("opponent_id"))
    match = F.col("side") == "match"
    lines = lines.withColumn("market", F.when(match, "match shots").otherwise("team shots"))
    lines = lines.withColumn("own_metric", F.when(match, "match_shots").otherwise("shots_for")).withColumn("opp_metric", F.when(match, "match_shots").otherwise("shots_against"))
    asks = lambda team, metric: lines.select(F.col(team).alias("team_id"), "line", F.col(metric).alias("metric"))
    asked = asks("team_id", "own_metric").union(asks("opponent_id", "opp_metric"))
    form = team_shot_form(t, asked=fx.select(F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")), n=max(sizes))
    rates = best_rates(asked, form, ["shots_for", "shots_against", "match_shots"], sizes, min_samples)
    rows = _joined(_joined(lines, rates, "team_id", "team", "own_metric"), rates, "opponent_id", "opp", "opp_metric").drop("own_metric", "opp_metric")
    rows = rows.withColumn("least_pct", F.least("team_pct", "opp_pct")).filter(F.col("least_pct") >= min_pct)
    names = t.teams.select(F.col("id"), F.col("name"))
    rows = rows.join(names.toDF("team_id", "team"), "team_id", "left").join(names.toDF("opponent_id", "opp"), "opponent_id", "left")
    order = [F.desc("least_pct"), F.coalesce("odds", F.lit(0.0)).desc(), "line", "fixture_id", "market", "side"]
    return rows.orderBy(*order) if limit is None else rows.orderBy(*order).limit(limit)


def player_forms(t: Tables, *, sizes: tuple[int, ...] = (5, 10), type_id: int = 42, league: int | None = None) -> DataFrame:
    """``player_id, team_id, sample_size, raw_fixtures`` (newest first) of players with that many finished appearances."""
    fx = t.fixtures.filter("home_score is not null and away_score is not null")
    fx = fx if league is None else fx.filter(F.col("league_id") == league)
    apps = t.fixture_players.select("fixture_id", "player_id", "team_id").join(fx.select(F.col("id").alias("fixture_id"), "starting_at"), "fixture_id")
    games = stat_value(last_n(apps, "player_id", max(sizes)), t.fixture_player_statistics, type_id, ["fixture_id", "player_id"])
    whole = games.groupBy("player_id").agg(
        F.max_by("team_id", -F.col("rn")).alias("team_id"), F.count(F.lit(1)).alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("rn", "fixture_id", F.col("value").alias("shots")))), lambda x: F.struct(x["fixture_id"].alias("fixture_id"), x["shots"].alias("shots"))).alias("all")
    )
    sized = whole.withColumn("sample_size", F.explode(F.array(*(F.lit(s) for s in sizes)))).filter("n >= sample_size")
    return sized.select("player_id", "team_id", "sample_size", F.expr("slice(all, 1, sample_size)").alias("raw_fixtures"))


# Games looked at, and how many of them need a shot.
HIT_RATES = ((11, 9), (14, 12), (15, 13), (20, 16))


def shots_hit_rates(forms: DataFrame) -> DataFrame:
    """Each form row against each threshold it is long enough for; an unknown count is 0."""
    rules = F.explode(F.array(*(F.struct(F.lit(n).alias("sample"), F.lit(k).alias("required")) for n, k in HIT_RATES))).alias("rule")
    rows = forms.filter("raw_fixtures is not null and sample_size >= 11").select("player_id", "team_id", "sample_size", "raw_fixtures", rules).filter("size(raw_fixtures) >= rule.sample")
    shots = F.transform(F.slice("raw_fixtures", 1, F.col("rule.sample")), lambda x: F.coalesce(x["shots"].cast("int"), F.lit(0)))
    out = rows.select("player_id", "team_id", "sample_size", F.col("rule.sample").alias("sample"), F.col("rule.required").alias("required"), shots.alias("seq"))
    out = out.withColumn("hits", F.size(F.filter("seq", lambda v: v >= 1)).cast("long")).filter("hits >= required").withColumn("rate", F.col("hits") / F.col("sample"))
    return out.select("player_id", "team_id", "sample_size", "sample", "hits", "rate", "seq").orderBy(F.desc("rate"), F.desc("sample"), "player_id", "sample_size")


def player_shot_value_bets(
    t: Tables, *, as_of, odds_min: float = 1.25, player_min_pct: float = 0.8, opp_min_pct: float = 0.7, sizes: tuple[int, ...] = (5, 10), lookback: int = 2, lookahead: int = 14, limit: int | None = 50
) -> DataFrame:
    """Player shot odds of near fixtures where the player shoots often and the opponent concedes over the odds' line."""
    near = F.col("starting_at").between(instant(as_of) - F.make_dt_interval(F.lit(lookback)), instant(as_of) + F.make_dt_interval(F.lit(lookahead)))
    fx = t.fixtures.filter(near).select(F.col("id").alias("fixture_id"), "starting_at", "home_team_id", "away_team_id")
    odds = t.player_odds.filter((F.col("market_id") == 268) & (F.col("decimal_odds") >= odds_min)).select("fixture_id", "player_id", F.coalesce(F.col("line").cast("double"), F.lit(1.0)).alias("line"), F.col("decimal_odds").cast("double").alias("odds"))
    current = t.players.select(F.col("id").alias("player_id"), F.col("name").alias("player"), F.col("current_team_id").alias("team_id"))
    rows = odds.join(fx, "fixture_id").join(current, "player_id").filter("team_id in (home_team_id, away_team_id)")
    rows = rows.withColumn("opponent_id", F.when(F.col("team_id") == F.col("home_team_id"), F.col("away_team_id")).otherwise(F.col("home_team_id")))
    shots = F.filter(F.transform("raw_fixtures", lambda x: x["shots"].cast("double")), lambda v: v.isNotNull())
    forms = t.player_forms.filter(F.col("sample_size").isin(*sizes)).select("player_id", F.col("sample_size").alias("player_sample"), shots.alias("known"))
    forms = forms.filter("size(known) > 0").withColumn("player_pct", F.size(F.filter("known", lambda v: v >= 1)) / F.size("known")).withColumn("player_avg", F.aggregate("known", F.lit(0.0), lambda a, v: a + v) / F.size("known"))
    best = Window.partitionBy("player_id").orderBy(F.desc("player_pct"), "player_sample")
    forms = forms.withColumn("rank", F.row_number().over(best)).filter("rank = 1").select("player_id", "player_sample", "player_pct", "player_avg", F.transform("known", lambda v: v.cast("int")).alias("player_seq"))
    rows = rows.join(forms.filter(F.col("player_pct") >= player_min_pct), "player_id")
    form = team_shot_form(t, last=False, asked=fx.select(F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")), n=max(sizes))
    rates = best_rate(rows.select(F.col("opponent_id").alias("team_id"), "line"), form, "shots_against", sizes, 1)
    rows = _joined(rows, rates.filter(F.col("pct") >= opp_min_pct), "opponent_id", "opp").withColumn("least_pct", F.least("player_pct", "opp_pct"))
    order = [F.desc("least_pct"), F.desc("odds"), "fixture_id", "player_id", "line"]
    return rows.orderBy(*order) if limit is None else rows.orderBy(*order).limit(limit)


def outside_box_sot(t: Tables, *, words: tuple[str, ...] = ("outside", "shot", "target"), sample: int = 10, limit: int | None = 50) -> DataFrame:
    """Shots on target from outside the box in the newest ``sample`` event rows of each player, by player and team."""
    wanted = t.types
    for w in words:
        wanted = wanted.filter(F.lower("name").contains(w))
    events = F.explode(F.from_json("stats", "array<struct<type_id:int,data:struct<value:double>>>")).alias("e")
    rows = t.player_stats.select("fixture_id", "player_id", "team_id", events).select("fixture_id", "player_id", "team_id", "e.type_id", F.col("e.data.value").alias("value"))
    rows = rows.join(wanted.select(F.col("id").alias("type_id")), "type_id", "left_semi").join(t.fixtures.select(F.col("id").alias("fixture_id"), "starting_at"), "fixture_id")
    newest = Window.partitionBy("player_id").orderBy(F.desc_nulls_last("starting_at"), F.desc("fixture_id"), F.desc("type_id"), F.desc("value"))
    trimmed = rows.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= sample)
    text = F.array_join(F.transform(sequence(F.col("value").cast("int")), lambda v: v.cast("string")), "-")
    agg = trimmed.groupBy("player_id", "team_id").agg(F.sum(F.coalesce(F.col("value") >= 1, F.lit(False)).cast("long")).alias("hit_games"), F.count(F.lit(1)).alias("samples"), text.alias("seq"))
    named = agg.join(t.players.select(F.col("id").alias("player_id"), F.col("name").alias("player")), "player_id").join(t.teams.select(F.col("id").alias("team_id"), F.col("name").alias("team")), "team_id")
    order = [F.desc("hit_games"), F.desc("samples"), "player_id", "team_id"]
    out = named.select("player_id", "player", "team_id", "team", "hit_games", "samples", "seq").orderBy(*order)
    return out if limit is None else out.limit(limit)


def team_forms(t: Tables, *, n: int = 10) -> DataFrame:
    """Each team's newest ``n`` fixtures with shots: averages and sequences."""
    games = last_n(team_shot_form(t), "team_id", n)
    return games.groupBy("team_id").agg(F.count(F.lit(1)).alias("games"), F.avg("shots_for").alias("shots_for"), F.avg("shots_against").alias("shots_against"), sequence(F.col("match_shots").cast("int")).alias("match_shots"))


def player_availability(t: Tables, *, league: int, sample: int = 5) -> DataFrame:
    """Share of the current team's newest ``sample`` finished fixtures that a player appeared in."""
    fx = t.fixtures.filter((F.col("league_id") == league) & F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    sides = fx.select(F.col("id").alias("fixture_id"), "starting_at", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    games = last_n(sides, "team_id", sample).select("team_id", "fixture_id")
    size = games.groupBy("team_id").agg(F.count(F.lit(1)).alias("team_games"))
    players = latest_team(t, league).select("player_id", "team_id")
    seen = t.fixture_players.select("player_id", "team_id", "fixture_id").distinct().join(games, ["team_id", "fixture_id"], "left_semi").groupBy("player_id", "team_id").agg(F.count(F.lit(1)).alias("appearances"))
    out = players.join(size, "team_id").join(seen, ["player_id", "team_id"], "left")
    return out.select("player_id", "team_id", "team_games", F.coalesce("appearances", F.lit(0)).alias("appearances"), (F.coalesce("appearances", F.lit(0)) / F.col("team_games")).alias("availability"))
