"""Registered queries of ingest, scalar functions, name resolution, sinks and the stream, over payloads derived from the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import odds, quality, teams
from ..sources import ingest, proxy, sinks
from ..sources.folders import children, cleaned, scratch_dir, written
from ..streaming import odds_stream

AS_OF = "2001-08-02 00:00:00"


def _raw(flatten: Callable[[DataFrame], DataFrame], *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """A flattener over the fixtures' payloads. As payloads are read, an id of 0 is none."""
    return lambda spark, sf_dir: flatten(proxy.fixture_payloads(spark, sf_dir)).select(*columns)


def read_raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A league's seasons as one line of text with a list, every tenth season as a line with one object besides."""
    seasons = proxy.season_payloads(proxy.tables(spark, sf_dir).seasons)
    listed = seasons.groupBy(F.get_json_object("item", "$.end_date").alias("day")).agg(F.array_sort(F.collect_list("item")).alias("items"))
    lines = listed.select(F.concat(F.lit('{"data":['), F.array_join("items", ","), F.lit("]}")).alias("value")).unionByName(
        seasons.filter("line % 10 = 1").select(F.concat(F.lit('{"data":'), "item", F.lit("}")).alias("value"))
    )
    path = f"{scratch_dir(spark, 'landing')}/in"
    lines.write.text(path)
    raw = ingest.read_raw_payloads(spark, path)
    return raw.select(F.get_json_object("item", "$.id").cast("int").alias("id"), "position")


def flatten_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = ingest.flatten_seasons(proxy.season_payloads(proxy.tables(spark, sf_dir).seasons), [0, 1, 2])
    return flat.select("id", "league_id", "name", "start_date", "end_date", "is_current")


def flatten_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_teams(proxy.team_payloads(spark, sf_dir)).select("id", "name", "short_code", "image_path")


def flatten_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_types(proxy.type_payloads(spark, sf_dir)).select("id", "name", "code", "developer_name", "stat_group")


def derive_fixture_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ingest.stored_fixtures(proxy.fixture_payloads(spark, sf_dir), schema=ingest.SIDES, text=False)
    return ingest.derive_fixture_sides(ingest.flatten_fixtures(raw), ingest.flatten_participants(raw)).select("id", "home_team_id", "away_team_id", "home_score", "away_score")


def build_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.export_counts(ingest.build_tables(proxy.fixture_payloads(spark, sf_dir)))


def upcoming_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.upcoming_window(proxy.tables(spark, sf_dir), "2001-07-01", [0, 1]).select("id", "starting_at")


LINE = "l_orderkey, l_linenumber, l_partkey, l_quantity"


def _scalar(build: Callable[[Column, Column], Column], **kinds: str) -> Callable[[SparkSession, str], DataFrame]:
    """A scalar function over one text a line item; ``n`` is the line's number, ``q`` its quantity."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        rows = line.select(F.col("l_orderkey"), F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("q"), "l_shipdate")
        return rows.select("l_orderkey", "n", "q", build(F.col("n"), F.col("q")).alias("value"))

    return run


def _pick(n: Column, *texts: Column | str | None) -> Column:
    """The text at place ``n`` modulo their number."""
    out = F.lit(None).cast("string")
    for k, text in enumerate(texts):
        out = F.when(n % len(texts) == k, text if isinstance(text, Column) else F.lit(text).cast("string")).otherwise(out)
    return out


text = lambda c: c.cast("string")
object_ = lambda before, q, after: F.concat(F.lit(before), text(q), F.lit(after))


def _minutes(n: Column, q: Column) -> Column:
    row = lambda i, name, v: F.struct(F.lit(i).cast("int").alias("type_id"), F.lit(name).cast("string").alias("type_name"), v.alias("value"))
    nothing = F.lit(None).cast("int")
    return exprs.minutes([_pick(n, text(q), None), _pick(n, None, "x", "90")], F.array(row(42, "Shots", q), row(119, None, F.when(n % 5 != 0, q + 1)), row(None, "Minutes Played", nothing), row(None, "Minutes On", q + 2)))


def fold_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    odd = F.regexp_replace(F.regexp_replace(F.concat_ws("-", "p_name", "p_brand"), "e", "É"), "o", "ö")
    return part.select("p_partkey", exprs.fold_name(F.when(F.col("p_partkey") % 7 != 0, odd)).alias("folded"))


def participant_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("q"))
    described = _pick(F.col("n"), None, "Player Shots", "Team Total Goals", "Match Goals")
    market = _pick(F.col("q"), "goalscorers", "match_goals", "player_assists", "multi_scorers", "corners")
    return line.select("l_orderkey", "n", "q", exprs.participant_type(described, market).alias("value"))


def _some(t):
    """Line-ups lack every third player, so that some names are only known from squads."""
    return replace(t, fixture_players=t.fixture_players.filter("player_id % 3 <> 0"))


def _over_tables(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(_some(proxy.tables(spark, sf_dir)))


def _unmatched(t) -> DataFrame:
    lacking = replace(t, players=t.players.filter("id % 4 <> 0"))
    return odds.unmatched_player_odds(odds.parse_outcomes(lacking, t.odds_snapshots, t.fixtures))


def _named(t) -> DataFrame:
    """Each name that a fixture's offers and teams go by, with whom it is."""
    offered = odds.parsed_rows(t.odds_snapshots).select("fixture_id", "name").distinct()
    sides = t.fixtures.select(F.col("id").alias("fixture_id"), F.explode(F.array("home_team_id", "away_team_id")).alias("id"))
    return odds.named_participants(t, offered.union(sides.join(t.teams, "id").select("fixture_id", F.upper("name"))), t.fixtures)


def append_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, by halves of the fixtures; counts by day of what is then there."""
    rows, path = proxy.tables(spark, sf_dir).odds_snapshots, scratch_dir(spark, "snapshots")
    for half in (0, 1):
        sinks.append_snapshots(rows.filter(f"fixture_id % 2 = {half}"), path)
    return spark.read.parquet(path).groupBy(F.date_format("pulled_at", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("snapshots"))


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed over the snapshots as files, half of them a micro-batch; the outcomes it leaves."""
    t, folder = _some(proxy.tables(spark, sf_dir)), scratch_dir(spark, "stream")
    t = replace(t, **{name: written(getattr(t, name), f"{folder}/{name}") for name in ("fixtures", "fixture_players")})
    # Each task writes four files at most: however many write, there are four or more, and no rows are dealt for it.
    with cleaned(spark):
        t.odds_snapshots.withColumn("part", F.pmod(F.hash("id"), F.lit(4))).write.partitionBy("part").json(f"{folder}/in", compression="gzip")
    files = sum(len(children(spark, f"{folder}/in/{part}")) for part in children(spark, f"{folder}/in") if "=" in part)
    odds_stream.odds_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", t, files=(files + 1) // 2, once=True, every=2).awaitTermination()
    return odds_stream.current_outcomes(spark, f"{folder}/out").select("fixture_id", "market_key", "selection_key", "participant_type", "participant_id", "line", "price_decimal")


def upsert_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players loaded into a database, then upserted, as it has them then.

    The database is the one that ``spark.footform.jdbc.url`` names, else one in the memory of a local session's JVM.
    """
    players, url = proxy.tables(spark, sf_dir).players.select("id", "name", "short_name"), spark.conf.get("spark.footform.jdbc.url", None)
    table, properties = f"players_{uuid.uuid4().hex[:8]}", {} if url else {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    url = url or "jdbc:derby:memory:footform;create=true"
    sinks.write_jdbc(players.filter("id % 3 <> 0"), url, table, properties)
    try:
        sinks.upsert_jdbc(players.filter("id % 2 = 0").withColumn("name", F.upper("name")), url, table, ["id"], properties)
        return written(spark.read.jdbc(url, table, properties=properties), scratch_dir(spark, "jdbc"))
    finally:
        sinks.run_sql(spark, url, properties, f"DROP TABLE {table}")


def _golden(t) -> DataFrame:
    cards = t.fixture_statistics.groupBy("team_id", "type_id").agg(F.sum("value").alias("v")).select(F.concat_ws(" ", "type_id", "team_id").alias("check"), "team_id", text(F.col("v")).alias("values"))
    wanted = cards.select("check", F.when(F.col("team_id") % 3 == 0, F.concat("values", F.lit("x"))).otherwise(F.col("values")).alias("values"))
    return quality.golden_compare(cards.filter("team_id % 5 <> 0"), wanted)


REFRESH = {"league": 0, "recent_days": 60, "last": 3, "as_of": AS_OF}


def _known(t):
    """As ``t``, with likely players of half a year: some of them are refreshed, others are stale."""
    older = teams.likely_players(t, league=0, recent_days=200, last=9, as_of="2001-05-01 00:00:00")
    return replace(t, team_likely_players=older)


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return teams.refresh_team_likely_players(_known(proxy.tables(spark, sf_dir)), **REFRESH)


def refreshed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return teams.refreshed_count(_known(proxy.tables(spark, sf_dir)), **REFRESH)


RESOLVED = ["fixture_id", "market_key", "selection_key", "participant_type", "participant_id", "line", "price_decimal"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_raw_payloads": read_raw_payloads,
    "flatten_seasons": flatten_seasons,
    "flatten_teams": flatten_teams,
    "flatten_types": flatten_types,
    "flatten_fixtures": _raw(ingest.flatten_fixtures, "id", "league_id", "season_id", "starting_at", "status_code", "home_team_id", "away_team_id"),
    "extract_scores": _raw(ingest.flatten_fixtures, "id", "home_score", "away_score"),
    "flatten_participants": _raw(ingest.flatten_participants, "fixture_id", "team_id", "location", "score"),
    "teams_from_participants": _raw(ingest.teams_from_participants, "id", "name", "short_code"),
    "flatten_team_statistics": _raw(ingest.flatten_team_statistics, "fixture_id", "team_id", "type_id", "code", "location", "name", "value"),
    "flatten_players": _raw(ingest.flatten_players, "id", "name", "short_name", "common_name", "team_id"),
    "flatten_fixture_players": _raw(ingest.flatten_fixture_players, "fixture_id", "player_id", "team_id", "name", "position", "lineup_type", "jersey_number", "position_name", "position_abbr", "is_starter", "minutes_played", "formation_position"),
    "flatten_player_statistics": _raw(ingest.flatten_player_statistics, "fixture_id", "player_id", "type_id", "code", "team_id", "value"),
    "derive_fixture_sides": derive_fixture_sides,
    "build_tables": build_tables,
    "upcoming_window": upcoming_window,
    "parse_dt": _scalar(lambda n, q: exprs.parse_dt(_pick(n, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.date_format("l_shipdate", "yyyy-MM-dd"), "soon", None))),
    "safe_int": _scalar(lambda n, q: exprs.safe_int(_pick(n, text(q), object_("", q, ".7"), object_(" -", q, " "), "abc", "", "nan", None))),
    "stat_value": _scalar(lambda n, q: exprs.stat_value(_pick(n, object_('{"value":', q, "}"), object_('{"total":"', q, '","x":1}'), text(q), object_('{"a":"b","c":', q, "}"), object_('{"value":null,"goals":', q, "}"), "{}", None))),
    "is_starter": _scalar(lambda n, q: exprs.is_starter(_pick(q, "11", "12", "Lineup", "bench", "other", "STARTING", "sub", "1", None))),
    "minutes": _scalar(_minutes),
    "position_abbr": _scalar(lambda n, q: exprs.position_abbr(_pick(q, "goalkeeper", "Left-Back", "unknown", None), _pick(n, "an attacking-midfield", "Right-Wing", "Centre", None, "striker"))),
    "fold_name": fold_name,
    "participant_type": participant_type,
    "parse_outcomes": _over_tables(lambda t: odds.parse_outcomes(t, t.odds_snapshots, t.fixtures).select(*RESOLVED)),
    "unmatched_player_odds": _over_tables(_unmatched),
    "team_name_map": _over_tables(lambda t: odds.team_name_map(t, t.fixtures)),
    "fixture_player_name_map": _over_tables(lambda t: odds.fixture_player_name_map(t, t.fixtures)),
    "squad_name_map": _over_tables(lambda t: odds.fixture_squad_name_map(t, t.fixtures)),
    "named_participants": _over_tables(_named),
    "odds_stream": stream,
    "append_snapshots": append_snapshots,
    "upsert_jdbc": upsert_jdbc,
    "golden_compare": lambda spark, sf_dir: _golden(proxy.tables(spark, sf_dir)),
    "refresh_known_likely_players": refreshed,
    "refreshed_likely_players_count": refreshed_count,
}

DOMAIN = """
lines AS (
  SELECT l.*, p_name, p_brand, CASE WHEN l_linenumber % 2 = 1 THEN home_team_id ELSE away_team_id END AS team_id, l_linenumber AS n, l_quantity::INT AS q,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag, l_discount, l_tax) AS place FROM lineitem l JOIN fixtures ON l_orderkey = id JOIN part ON l_partkey = p_partkey
), aliases AS (SELECT id, team_id, regexp_replace(lower(unnest([name, common_name, short_name])), '[^a-z0-9]+', '', 'g') AS folded FROM players
), lineup_names AS (SELECT fixture_id, folded, min(id) AS player_id FROM fixture_players fp JOIN aliases ON id = player_id WHERE player_id % 3 <> 0 GROUP BY 1, 2
), squad_names AS (SELECT f.id AS fixture_id, folded, min(a.id) AS player_id FROM fixtures f JOIN aliases a ON a.team_id IN (home_team_id, away_team_id) GROUP BY 1, 2
), offers AS (
  SELECT l_orderkey AS fixture_id, CASE WHEN l_linestatus = 'F' THEN 'player_shots' ELSE 'player_shots_on_target' END AS market_key, trim(regexp_replace(lower(p_name || ' ' || p_brand || ' over ' || (0.5 + l_linenumber % 3)::DECIMAL(3,1)), '[^a-z0-9]+', '_', 'g'), '_') AS selection_key,
         'player' AS participant_type, p_name || ' ' || p_brand AS name, regexp_replace(lower(p_name || p_brand), '[^a-z0-9]+', '', 'g') AS folded, (0.5 + l_linenumber % 3)::DOUBLE AS line, round(1 + l_discount, 2)::DOUBLE AS price_decimal, l_shipdate FROM lines
), resolved AS (SELECT o.*, coalesce(a.player_id, b.player_id) AS participant_id FROM offers o LEFT JOIN lineup_names a USING (fixture_id, folded) LEFT JOIN squad_names b USING (fixture_id, folded)
)
"""


def landing_sql(domain: str, body: str) -> str:
    return f"WITH {domain.strip().removesuffix(')')}), {DOMAIN.strip()}\n{body.strip()}"


_TS = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
_SCALAR = lambda expr: f"SELECT l_orderkey, l_linenumber AS n, l_quantity::INT AS q, {expr} AS value FROM (SELECT *, l_linenumber AS n, l_quantity::INT AS q FROM lineitem)"
_LAST = lambda keys, source, order="place DESC": f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS best FROM {source}) WHERE best = 1)"
_PLAYED = "CASE WHEN n % 4 = 0 THEN 'Goalkeeper' WHEN n % 4 = 3 THEN 'Striker' END"
_PRICED = "fixture_id, market_key, selection_key, participant_type, participant_id, round(line, 6) AS line, round(price_decimal, 6) AS price_decimal"
_LIKELY = lambda days, last, at: f"""(SELECT team_id, player_id, confidence, starting_at, fixture_id FROM (SELECT *, row_number() OVER (PARTITION BY team_id, player_id ORDER BY starting_at DESC NULLS FIRST, confidence DESC, fixture_id DESC) AS best FROM (
    SELECT a.*, dense_rank() OVER (PARTITION BY team_id ORDER BY starting_at DESC NULLS FIRST, fixture_id DESC) AS game, CASE WHEN is_starter THEN 1.0 WHEN minutes_played > 0 THEN 0.6 END AS confidence
    FROM apps a WHERE league_id = 0 AND starting_at >= TIMESTAMP '{at}' - INTERVAL {days} DAY) WHERE game <= {last} AND confidence IS NOT NULL) WHERE best = 1)"""  # noqa: E731
_FRESH, _OLD = _LIKELY(60, 3, AS_OF), _LIKELY(200, 9, "2001-05-01 00:00:00")
ORACLES = {
    "read_raw_payloads": "SELECT id, (row_number() OVER (PARTITION BY end_date ORDER BY CASE WHEN id % 2 = 1 THEN '{\"id\":' || id || ',' ELSE '{\"id\":' || id || ',' END)) - 1 AS position FROM seasons UNION ALL SELECT id, 0 FROM seasons WHERE id % 10 = 1",
    "flatten_seasons": f"SELECT id, league_id, 'S' || id AS name, {_TS('start_date')} AS start_date, {_TS('end_date')} AS end_date, is_current FROM seasons WHERE league_id IN (0, 1, 2)",
    "flatten_teams": "SELECT n_nationkey AS id, n_name || ' ' || min(c_custkey) AS name, 'N' || n_nationkey AS short_code, CASE WHEN min(c_custkey) % 2 = 0 THEN 'logo' || min(c_custkey) END AS image_path FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name",
    "flatten_types": "SELECT p_partkey AS id, p_name AS name, p_brand AS code, upper(p_name) AS developer_name, p_type AS stat_group FROM part",
    "flatten_fixtures": f"SELECT id, league_id, season_id, {_TS('starting_at')} AS starting_at, 'FT' AS status_code, CASE WHEN id % 2 = 0 THEN home_team_id END AS home_team_id, CASE WHEN id % 2 = 0 THEN away_team_id END AS away_team_id FROM fixtures WHERE id IN (SELECT l_orderkey FROM lines)",
    "extract_scores": """SELECT id, CASE WHEN id % 3 = 0 THEN coalesce(home_score, 7) ELSE coalesce(home_score, 9) END AS home_score, CASE WHEN id % 3 = 0 THEN away_score ELSE coalesce(away_score, 9) END AS away_score
        FROM fixtures WHERE id IN (SELECT l_orderkey FROM lines)""",
    "flatten_participants": "SELECT fixture_id, team_id, location, score FROM fixture_participants WHERE team_id <> 0 AND fixture_id IN (SELECT l_orderkey FROM lines)",
    "teams_from_participants": """SELECT team_id AS id, last(n_name || ' ' || fixture_id ORDER BY fixture_id) FILTER (WHERE fixture_id % 3 <> 0) AS name, 'C' || max(fixture_id) FILTER (WHERE fixture_id % 5 = 0) AS short_code
        FROM fixture_participants JOIN nation ON n_nationkey = team_id WHERE team_id <> 0 AND fixture_id IN (SELECT l_orderkey FROM lines) GROUP BY 1""",
    "flatten_team_statistics": f"SELECT l_orderkey AS fixture_id, team_id, 42 AS type_id, 'shots-total' AS code, CASE WHEN n % 2 = 1 THEN 'home' ELSE 'away' END AS location, 'Shots Total' AS name, q % 5 AS value FROM {_LAST('l_orderkey, team_id', 'lines')} WHERE team_id <> 0",
    "flatten_players": f"SELECT l_partkey AS id, p_name || ' ' || p_brand AS name, p_brand AS short_name, p_name AS common_name, nullif(team_id, 0) AS team_id FROM {_LAST('l_partkey', 'lines', 'l_orderkey DESC, place DESC')} WHERE l_partkey <> 0",
    "flatten_fixture_players": f"""SELECT l_orderkey AS fixture_id, l_partkey AS player_id, nullif(team_id, 0) AS team_id, CASE WHEN n % 2 = 1 THEN p_name ELSE p_name || ' ' || p_brand END AS name, {_PLAYED} AS position, CASE WHEN n <= 4 THEN '11' ELSE '12' END AS lineup_type, n::VARCHAR AS jersey_number,
        {_PLAYED} AS position_name, CASE n % 4 WHEN 1 THEN 'CB' WHEN 0 THEN 'GK' WHEN 3 THEN 'ST' END AS position_abbr, n <= 4 AS is_starter, q AS minutes_played, n AS formation_position FROM {_LAST('l_orderkey, l_partkey', 'lines')} WHERE l_partkey <> 0""",
    "flatten_player_statistics": f"""SELECT l_orderkey AS fixture_id, l_partkey AS player_id, t AS type_id, CASE t WHEN 42 THEN 'shots-total' ELSE t::VARCHAR END AS code, nullif(team_id, 0) AS team_id, CASE t WHEN 42 THEN CASE WHEN l_returnflag <> 'R' THEN q % 5 END WHEN 119 THEN q ELSE q % 3 END AS value
        FROM {_LAST('l_orderkey, l_partkey', 'lines')} CROSS JOIN (SELECT unnest([42, 119, 52]) AS t) WHERE l_partkey <> 0""",
    "derive_fixture_sides": """SELECT id, CASE WHEN id % 2 = 0 THEN home_team_id ELSE nullif(home_team_id, 0) END AS home_team_id, CASE WHEN id % 2 = 0 THEN away_team_id ELSE nullif(away_team_id, 0) END AS away_team_id, CASE WHEN id % 3 = 0 THEN coalesce(home_score, 7) ELSE coalesce(home_score, 9) END AS home_score, CASE WHEN id % 3 = 0 THEN away_score ELSE coalesce(away_score, 9) END AS away_score
        FROM fixtures WHERE id IN (SELECT l_orderkey FROM lines)""",
    "build_tables": """SELECT 'fixtures' AS table_name, count(DISTINCT l_orderkey) AS rows FROM lines UNION ALL SELECT 'fixture_participants', count(*) FROM fixture_participants WHERE team_id <> 0 AND fixture_id IN (SELECT l_orderkey FROM lines)
        UNION ALL SELECT 'fixture_statistics', count(*) FROM (SELECT DISTINCT l_orderkey, team_id FROM lines WHERE team_id <> 0) UNION ALL SELECT 'players', count(DISTINCT l_partkey) FROM lines WHERE l_partkey <> 0
        UNION ALL SELECT 'fixture_players', count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lines WHERE l_partkey <> 0) UNION ALL SELECT 'fixture_player_statistics', 3 * count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lines WHERE l_partkey <> 0)
        UNION ALL SELECT 'teams', count(DISTINCT team_id) FROM fixture_participants WHERE team_id <> 0 AND fixture_id IN (SELECT l_orderkey FROM lines)""",
    "upcoming_window": f"SELECT id, {_TS('starting_at')} AS starting_at FROM fixtures WHERE league_id IN (0, 1) AND starting_at >= TIMESTAMP '2001-07-01' AND starting_at < TIMESTAMP '2001-07-16'",
    "parse_dt": _SCALAR(f"CASE WHEN n % 5 IN (0, 1) THEN {_TS('l_shipdate')} WHEN n % 5 = 2 THEN {_TS('l_shipdate::DATE::TIMESTAMP')} END"),
    "safe_int": _SCALAR("CASE n % 7 WHEN 0 THEN q WHEN 1 THEN q WHEN 2 THEN -q END"),
    "stat_value": _SCALAR("CASE WHEN n % 7 < 5 THEN q END"),
    "is_starter": _SCALAR("CASE WHEN q % 9 IN (0, 2, 5, 7) THEN TRUE WHEN q % 9 IN (1, 3, 6) THEN FALSE END"),
    "minutes": _SCALAR("CASE WHEN n % 2 = 0 THEN q WHEN n % 3 = 2 THEN 90 WHEN n % 5 <> 0 THEN q + 1 ELSE q + 2 END"),
    "position_abbr": _SCALAR("CASE WHEN q % 4 = 0 THEN 'GK' WHEN q % 4 = 1 THEN 'LB' WHEN n % 5 = 0 THEN 'AM' WHEN n % 5 = 1 THEN 'RW' WHEN n % 5 = 4 THEN 'ST' END"),
    "fold_name": "SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN regexp_replace(lower(p_name || p_brand), '[^a-z0-9]+', '', 'g') END AS folded FROM part",
    "participant_type": _SCALAR("CASE WHEN n % 4 = 1 OR q % 5 IN (0, 2, 3) THEN 'player' WHEN n % 4 = 2 THEN 'team' END"),
    "parse_outcomes": f"SELECT {_PRICED} FROM resolved",
    "unmatched_player_odds": """SELECT o.fixture_id, market_key, selection_key, name FROM offers o WHERE NOT EXISTS (SELECT 1 FROM fixture_players fp JOIN aliases a ON a.id = fp.player_id WHERE fp.fixture_id = o.fixture_id AND a.id % 3 <> 0 AND a.id % 4 <> 0 AND a.folded = o.folded)
        AND NOT EXISTS (SELECT 1 FROM fixtures f JOIN aliases a ON a.team_id IN (home_team_id, away_team_id) WHERE f.id = o.fixture_id AND a.id % 4 <> 0 AND a.folded = o.folded)""",
    "team_name_map": """SELECT fixture_id, folded, max(team_id) AS team_id FROM (SELECT fixture_id, team_id, regexp_replace(lower(unnest([name, short_code])), '[^a-z0-9]+', '', 'g') AS folded FROM fixture_participants JOIN teams t ON t.id = team_id) GROUP BY 1, 2""",
    "fixture_player_name_map": "SELECT fixture_id, folded, player_id FROM lineup_names",
    "squad_name_map": "SELECT fixture_id, folded, player_id FROM squad_names WHERE folded <> ''",
    "named_participants": """SELECT DISTINCT fixture_id, name, NULL::INT AS team_id, participant_id AS player_id FROM resolved UNION ALL SELECT fixture_id, upper(name), team_id, NULL FROM fixture_participants JOIN teams t ON t.id = team_id""",
    "odds_stream": f"SELECT {_PRICED} FROM {_LAST('fixture_id, market_key, selection_key, line', 'resolved', 'l_shipdate DESC, price_decimal DESC')}",
    "append_snapshots": "SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS snapshots FROM (SELECT DISTINCT l_orderkey, l_shipdate FROM lines) GROUP BY 1",
    "upsert_jdbc": "SELECT id, CASE WHEN id % 2 = 0 THEN upper(name) ELSE name END AS name, short_name FROM players WHERE id % 3 <> 0 OR id % 2 = 0",
    "golden_compare": "SELECT type_id || ' ' || team_id AS \"check\", team_id % 5 <> 0 AND team_id % 3 <> 0 AS ok FROM (SELECT DISTINCT type_id, team_id FROM fixture_statistics)",
    "refresh_known_likely_players": f"""SELECT team_id, player_id, coalesce(a.confidence, b.confidence)::DOUBLE AS confidence, {_TS('coalesce(a.starting_at, b.starting_at)')} AS last_seen_at, coalesce(a.fixture_id, b.fixture_id) AS source_fixture_id,
        CASE WHEN a.fixture_id IS NULL THEN '2001-05-01 00:00:00' ELSE '{AS_OF}' END AS updated_at FROM {_FRESH} a FULL JOIN {_OLD} b USING (team_id, player_id)""",
    "refreshed_likely_players_count": f"SELECT count(*) AS upserted FROM {_FRESH}",
}
