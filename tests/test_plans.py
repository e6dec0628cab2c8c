"""What queries read and how much they shuffle, as their plans and files show it."""

import json
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footform.operators import odds, players, value
from footform.plans.queries import QUERIES
from footform.schemas import SCHEMAS, Tables
from footform.sources import ingest, merge, sinks, store
from footform.sources.folders import children, remove, scratch_dir
from footform.sources.proxy import fixture_payloads, tables
from footform.streaming import odds_stream


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    path = scratch_dir(spark, "test-store")
    t = tables(spark, sf_dir)
    names = ("fixtures", "fixture_players", "fixture_player_statistics", "players", "teams", "team_stats", "odds_outcomes")
    store.write_store(Tables(**{n: getattr(t, n) for n in names}), path)
    yield store.read_store(spark, path), path
    remove(spark, path)


def partition_filters(df):
    return re.findall(r"PartitionFilters: \[(.+?)\]\n", plan(df))


def test_windows_read_their_leagues_and_months(stored):
    t, _ = stored
    for df in (ingest.recent_window(t, "2001-08-02", [0, 1]), odds.odds_target_fixtures(t, leagues=[0, 1], as_of="2001-07-01", days=14), sinks.window_ids(t, "2001-07-01", 14)):
        found = partition_filters(df)
        assert found and all("starting_month" in f and "isnotnull" in f for f in found[:1])
    assert "league_id" in partition_filters(ingest.recent_window(t, "2001-08-02", [0, 1]))[0]
    files = ingest.fixtures_in_window(t, "2001-07-01", "2001-07-31", [0]).select(F.input_file_name()).distinct().collect()
    assert files and all("league_id=0/starting_month=200107" in f[0] for f in files)


def test_a_streak_reads_one_league_of_each_fact_table(stored):
    t, _ = stored
    found = partition_filters(players.player_streak_base(t, league=0, type_id=42, n=3, threshold=2, required=2))
    assert sum("league_id" in f for f in found) >= 3


def test_facts_of_other_games_never_reach_the_aggregate(spark, sf_dir):
    t = tables(spark, sf_dir)
    text = plan(players.player_streak_base(t, league=0, type_id=42, n=3, threshold=2, required=2))
    # The statistic's maximum is taken above the join of windows and facts: below it facts are only filtered.
    tree = text.split("\n\n")[0].split("\n")
    top = next(i for i, line in enumerate(tree) if "Window" in line)
    assert sum("Aggregate" in line for line in tree[:top]) >= 2


def test_statistics_are_parsed_after_games_are_chosen(spark, sf_dir):
    t = tables(spark, sf_dir)
    path = scratch_dir(spark, "stats")
    stats = t.team_stats
    stats.write.mode("overwrite").parquet(path)
    t = Tables(**{**vars(t), "team_stats": spark.read.parquet(path)})
    text = value.team_shot_value_bets(t, as_of="2001-08-02 00:00:00", lookback=60)._jdf.queryExecution().optimizedPlan().toString()
    lines = text.split("\n")
    parse = next(i for i, line in enumerate(lines) if "from_json(StructField(type" in line or "developer_name" in line)
    depth = lambda line: re.search(r"[A-Z]", line).start()
    below = [line for line in lines[parse + 1 :] if line.strip()]
    assert any("LeftSemi" in line and depth(line) > depth(lines[parse]) for line in below)


def test_names_are_looked_up_by_team(spark, sf_dir):
    """No node makes more rows than offers and aliases together."""
    t = tables(spark, sf_dir)
    offers, aliases = odds.parsed_rows(t.odds_snapshots).count(), 3 * t.players.count() + 4 * t.fixture_players.count()
    df = odds.parse_outcomes(t, t.odds_snapshots, t.fixtures)
    df.write.format("noop").mode("overwrite").save()
    assert df.count() == offers
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text
    squads = odds.squad_name_map(t)
    assert squads.count() <= 3 * t.players.count() and offers + aliases > 0


def test_text_is_parsed_once_and_nothing_is_cached(spark, sf_dir, tmp_path):
    raw = fixture_payloads(spark, sf_dir)
    raw.write.parquet(f"{tmp_path}/raw")
    built = ingest.build_tables(spark.read.parquet(f"{tmp_path}/raw"), folder=f"{tmp_path}/parsed")
    for df in (built.fixtures, built.fixture_players, built.fixture_player_statistics, built.fixture_participants):
        assert "InMemoryRelation" not in plan(df) and "InMemoryTableScan" not in plan(df) and "/raw" not in plan(df)
    lineups = [s for s in re.findall(r"ReadSchema: (.+)", plan(built.fixture_players)) if "lineups" in s]
    assert lineups and all("statistics:" not in s and "participants:" not in s and "item:" not in s for s in lineups)


def test_only_touched_partitions_are_read_and_written(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = [(i, i % 4, f"a{i}") for i in range(40)]
    spark.createDataFrame(rows, "id int, part int, name string").write.partitionBy("part").parquet(path)
    files = lambda k: sorted(p.name for p in (tmp_path / "t" / f"part={k}").glob("*.parquet"))
    before = {k: files(k) for k in range(4)}
    for p in (tmp_path / "t" / "part=3").glob("*.parquet"):
        p.write_bytes(b"not parquet: reading this would fail")
    for crc in (tmp_path / "t" / "part=3").glob(".*.crc"):
        crc.unlink()
    updates = spark.createDataFrame([(1, 1, "new"), (100, 1, "added"), (2, 0, "moved")], "id int, part int, name string")
    gone = spark.createDataFrame([(2, 2)], "id int, part int")
    for _ in range(2):  # a merge that runs again changes nothing more
        store.merge_partitions(spark, path, updates, ["id"], ["part"], gone)
        assert files(3) == before[3] and all(files(k) != before[k] for k in (0, 1, 2))
        got = {(r.id, r.part, r.name) for k in range(3) for r in spark.read.option("basePath", path).parquet(f"{path}/part={k}").collect()}
        want = {r for r in rows if r[1] != 3 and r[0] not in (1, 2)} | {(1, 1, "new"), (100, 1, "added"), (2, 0, "moved")}
        assert got == want


def test_a_partition_that_lost_its_last_row_goes(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, None, "c")], "id int, part int, name string").write.partitionBy("part").parquet(path)
    store.merge_partitions(spark, path, spark.createDataFrame([(1, 2, "A")], "id int, part int, name string"), ["id"], ["part"], spark.createDataFrame([(1, 1), (3, None)], "id int, part int"))
    assert {(r.id, r.part, r.name) for r in spark.read.parquet(path).collect()} == {(1, 2, "A"), (2, 2, "b")}
    assert "part=1" not in children(spark, path)
    store.merge_partitions(spark, path, spark.createDataFrame([], "id int, part int, name string"), ["id"], ["part"])
    assert spark.read.parquet(path).count() == 2


def test_fifty_epochs_cost_the_live_keys(spark, tmp_path):
    """Ten keys, fifty micro-batches with a late snapshot, a repeated epoch and one without participants."""
    t0, target = datetime(2024, 1, 1), f"file://{tmp_path}/out"
    players_ = spark.createDataFrame([(9, "A", None, None, 5)], "id int, name string, common_name string, short_name string, team_id int")
    t = Tables(fixtures=spark.createDataFrame([(1, 5, 6)], "id long, home_team_id int, away_team_id int"), teams=spark.createDataFrame([], "id int, name string, short_code string"), players=players_, fixture_players=spark.createDataFrame([], "fixture_id long, player_id int"))
    unknown = Tables(**{**vars(t), "players": players_.limit(0)})

    def batch(epoch, who=t, late=0):
        data = ", ".join(f'{{"market_id": 268, "name": "A", "label": "{k}.5", "value": "{epoch + 2}.0"}}' for k in range(10))
        snapshot = [(epoch, 1, 2, t0 + timedelta(hours=epoch - late), f'{{"data": [{data}]}}')]
        odds_stream.write_epoch(spark.createDataFrame(snapshot, SCHEMAS["odds_snapshots"]), epoch, target, who, every=8)

    for epoch in range(50):
        batch(epoch, unknown if epoch % 5 == 4 else t, late=48 if epoch == 47 else 0)
    batch(49, unknown)  # the last epoch runs again
    batch(3)  # and one that a base has
    got = odds_stream.current_outcomes(spark, target).collect()
    assert len(got) == 10 and {(float(r.price_decimal), r.participant_id, r.pulled_at) for r in got} == {(51.0, 9, t0 + timedelta(hours=49))}
    bases, epochs = (children(spark, f"{target}/{k}") for k in ("bases", "epochs"))
    assert len(bases) <= 2 and len(epochs) <= 16
    read = odds_stream._rows(spark, target)
    assert read.count() <= 10 * (1 + 8)  # the live keys and the increments since the base


def test_a_late_participant_wins_over_an_older_one(spark, tmp_path):
    """What a base says of a participant keeps the time at which it was known."""
    target, t0 = f"file://{tmp_path}/out", datetime(2024, 1, 1)
    key = {"fixture_id": 1, "bookmaker_id": 2, "market_key": "m", "selection_key": "s", "line": 1.5}

    def epoch(n, hour, who):
        row = {**key, "participant_type": who and "player", "participant_id": who, "price_decimal": float(hour), "price_american": None, "last_updated_at": None, "pulled_at": t0 + timedelta(hours=hour), "place": 0}
        spark.createDataFrame([row], OUTCOMES_AS_READ).selectExpr(*(f"cast({c} as {k}) as {c}" for c, k in KINDS)).write.parquet(f"{target}/epochs/epoch={n}")

    epoch(0, 1, 7)
    epoch(1, 5, None)
    odds_stream.compact(spark, target)
    epoch(2, 3, 8)  # pulled between the two
    row = odds_stream.current_outcomes(spark, target).head()
    assert (row.participant_id, float(row.price_decimal)) == (8, 5.0)


KINDS = re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", odds_stream.OUTCOMES)
OUTCOMES_AS_READ = ", ".join(f"{c} {'double' if 'decimal' in k else k}" for c, k in KINDS)


def test_a_base_that_was_not_finished_is_none(spark, tmp_path):
    target = f"file://{tmp_path}/out"
    (tmp_path / "out" / "bases" / "upto=5").mkdir(parents=True)
    assert odds_stream.newest_base(spark, target) == -1 and odds_stream.current_outcomes(spark, target).count() == 0


def test_merge_by_key_joins_once(spark):
    one = spark.createDataFrame([(1, "a")], "id int, name string")
    assert plan(merge.merge_by_key(one, one, ["id"])).count("FullOuter") <= 2


def test_an_export_is_read_from_what_was_written(spark, sf_dir, tmp_path):
    t, path = tables(spark, sf_dir), f"file://{tmp_path}/export"
    out = sinks.write_export(t, path, as_of="2001-08-02 00:00:00")
    assert set(children(spark, path)) == {n for n in sinks.EXPORTED if getattr(out, n) is not None}
    ids = {r.id for r in out.fixtures.select("id").collect()}
    for name in ("fixture_players", "fixture_player_statistics", "fixture_statistics", "odds_outcomes", "odds_snapshots"):
        assert {r.fixture_id for r in getattr(out, name).select("fixture_id").distinct().collect()} <= ids
    assert "lineitem" not in plan(out.players)


def test_every_query_takes_stored_tables(spark, sf_dir, monkeypatch):
    """The columns that the layout adds to tables of facts clash with nothing."""
    from footform.plans import queries as Q

    t = tables(spark, sf_dir)
    empty = {n: spark.createDataFrame([], df.schema) for n, df in vars(t).items() if df is not None}
    for n in ("fixtures", *store.OF_FIXTURE):
        empty[n] = empty[n].withColumns({"league_id": F.lit(1), "starting_month": F.lit(200101)})
    monkeypatch.setattr(Q, "tables", lambda spark, sf_dir: Tables(**empty))
    derived = {name: run for name, run in Q.QUERIES.items() if run.__module__ == Q.__name__ and run.__qualname__.startswith(("_on", "_derived"))}
    assert len(derived) > 60
    assert all(run(spark, sf_dir).columns for run in derived.values())


def whole_plan(spark, df):
    """The optimized plan, no line of it cut."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


@pytest.mark.parametrize("flatten", [ingest.flatten_fixtures, ingest.flatten_participants, ingest.flatten_team_statistics, ingest.flatten_fixture_players, ingest.flatten_player_statistics])
def test_a_payload_is_made_and_read_once(spark, sf_dir, flatten):
    """No join or filter makes or reads the text besides, and nothing is parsed that the table has no use for."""
    text = whole_plan(spark, flatten(fixture_payloads(spark, sf_dir)))
    assert text.count("from_json(StructField(id,") == 1 and text.count("participants, array(") == 1
    parse = re.search(r"from_json\(StructField\(id,.*", text).group()
    others = {"participants", "statistics", "lineups"} - {{"flatten_team_statistics": "statistics", "flatten_participants": "participants", "flatten_fixtures": ""}.get(flatten.__name__, "lineups")}
    assert not any(f"StructField({c},ArrayType" in parse for c in others)


def test_line_items_are_gathered_before_payloads_are_made(spark, sf_dir):
    lines = whole_plan(spark, fixture_payloads(spark, sf_dir)).split("\n")
    gathered = next(i for i, line in enumerate(lines) if "collect_list" in line)
    assert "shots-total" not in "".join(lines[gathered:]) and "shots-total" in "".join(lines[:gathered])


def test_details_of_an_appearance_go_their_way_in_one_row(spark, sf_dir):
    lines = whole_plan(spark, ingest.flatten_player_statistics(fixture_payloads(spark, sf_dir))).split("\n")
    details, dealt, entries = (next(i for i, line in enumerate(lines) if x in line) for x in ("posexplode(details", "RepartitionByExpression [fixture_id", "posexplode(entries"))
    assert details < dealt < entries and sum("RepartitionByExpression" in line for line in lines) == 1


def test_the_last_detail_wins_across_items_of_a_fixture(spark):
    detail = lambda t, v: {"type_id": t, "type": {"code": f"c{t}"}, "data": {"value": v}}
    who = lambda p, *details: {"player_id": p, "team_id": 5, "details": list(details)}
    items = [
        {"id": 1, "statistics": "no list", "lineups": [who(7, detail(42, 1), detail(42, 2)), who(8, detail(42, 3)), who(7, detail(42, 4), detail(52, 5))]}, {"id": 1, "lineups": [who(8, detail(42, 6)), {"player_id": 9}]},
        {"id": 2, "lineups": [who(7, detail(42, 7))]}, {"lineups": [who(7, detail(42, 8))]}, {"id": 3, "lineups": None},
    ]
    raw = spark.createDataFrame([("f", n, 0, json.dumps(x)) for n, x in enumerate(items)], "source string, line long, position int, item string")
    got = ingest.flatten_player_statistics(raw).collect()
    assert {(r.fixture_id, r.player_id, r.type_id, r.code, r.team_id, r.value) for r in got} == {(1, 7, 42, "c42", 5, 4), (1, 7, 52, "c52", 5, 5), (1, 8, 42, "c42", 5, 6), (2, 7, 42, "c42", 5, 7)} and len(got) == 4


def test_sides_are_derived_from_fixtures_parsed_once(spark, sf_dir):
    """Both the fixtures and their participants come from what was parsed, of which there are neither line-ups nor text."""
    df = QUERIES["derive_fixture_sides"](spark, sf_dir)
    text = whole_plan(spark, df)
    assert "from_json(StructField(id," not in text and "collect_list" not in text and "lineups" not in text and "item" not in text


def test_parsed_fixtures_take_little_room(spark, sf_dir, tmp_path):
    """Text and columns together take an eighth of the text at most."""
    raw = fixture_payloads(spark, sf_dir)
    ingest.build_tables(raw, folder=f"file://{tmp_path}/parsed")
    taken = sum(p.stat().st_size for p in (tmp_path / "parsed").glob("*.parquet"))
    assert 8 * taken < raw.agg(F.sum(F.octet_length("item"))).head()[0]
    assert [r[0] for r in spark.read.parquet(f"file://{tmp_path}/parsed").agg(F.sum(F.xxhash64("item").cast("decimal(38,0)"))).collect()] == [r[0] for r in raw.agg(F.sum(F.xxhash64("item").cast("decimal(38,0)"))).collect()]


def test_names_of_both_squads_for_every_fixture_take_little_room(spark, tmp_path):
    """Whole whatever blocks the fixtures fall into, and a quarter of a byte a row as Parquet."""
    fixtures = spark.range(1, 9001).selectExpr("id * 7 as id", "cast(1 as int) home_team_id", "cast(if(id % 3 = 0, 3, 2) as int) away_team_id").unionByName(spark.createDataFrame([(None, 1, 2), (5, 1, None), (6, None, None), (8, 4, 1)], "id long, home_team_id int, away_team_id int"))
    folk = spark.range(600).selectExpr("cast(id as int) id", "concat('p', id % 590) name", "cast(null as string) common_name", "cast(null as string) short_name", "cast(1 + id % 3 as int) team_id")
    t = Tables(fixtures=fixtures, players=folk)
    odds.fixture_squad_name_map(t, fixtures).write.parquet(f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out")
    want = fixtures.selectExpr("id fixture_id", "explode(array_distinct(array(home_team_id, away_team_id))) team_id").join(odds.squad_name_map(t), "team_id").groupBy("fixture_id", "folded").agg(F.min("player_id").alias("player_id"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    taken = sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet"))
    assert taken < got.count() / 4, (taken, got.count())


def test_a_batch_of_the_feed_is_parsed_once_and_dealt_by_fixture_once(spark, sf_dir, tmp_path):
    t = tables(spark, sf_dir)
    stored = spark.createDataFrame(t.odds_snapshots.limit(50).collect(), t.odds_snapshots.schema)
    df = odds.latest_in_batch(odds.parse_outcomes(t, stored, t.fixtures, lambda name, names: F.broadcast(names)))
    assert whole_plan(spark, df).count("from_json(StructField(data,ArrayType") == 1
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    top = next(i for i, line in enumerate(lines) if "SortMergeJoin [fixture_id" in line or "BroadcastHashJoin [fixture_id" in line)
    assert not any("Exchange hashpartitioning" in line for line in lines[:top] if "folded" not in line) or "BroadcastHashJoin [fixture_id" in lines[top]


def test_a_batch_without_snapshots_adds_no_epoch_and_a_base_alone_is_read_as_it_is(spark, tmp_path):
    """Nor does it leave its copy of the snapshots."""
    t0, target = datetime(2024, 1, 1), f"file://{tmp_path}/out"
    folk = spark.createDataFrame([(9, "A", None, None, 5)], "id int, name string, common_name string, short_name string, team_id int")
    t = Tables(fixtures=spark.createDataFrame([(1, 5, 6)], "id long, home_team_id int, away_team_id int"), teams=spark.createDataFrame([], "id int, name string, short_code string"), players=folk, fixture_players=spark.createDataFrame([], "fixture_id long, player_id int"))
    offers = '{"data": [{"market_id": 268, "name": "A", "label": "1.5", "value": "2.0"}, {"market_id": 268, "name": "A", "label": "none", "value": "3.0"}, {"market_id": 268, "name": "A", "label": "none", "value": "4.0"}]}'
    for epoch, rows in enumerate([[(0, 1, 2, t0, offers)], [(1, 1, 2, t0 + timedelta(hours=1), offers.replace("2.0", "5.0"))], []]):
        odds_stream.write_epoch(spark.createDataFrame(rows, SCHEMAS["odds_snapshots"]), epoch, target, t, every=2)
    assert set(children(spark, f"{target}/epochs")) == {"epoch=0", "epoch=1"} and set(children(spark, f"{target}/bases")) == {"upto=1"}
    df = odds_stream.current_outcomes(spark, target)
    assert "Exchange" not in plan(df)
    got = sorted((None if r.line is None else float(r.line), float(r.price_decimal), r.participant_id) for r in df.collect() if r.line is not None)
    assert got == [(1.5, 5.0, 9)] and sorted(float(r.price_decimal) for r in df.collect() if r.line is None) == [3.0, 3.0, 4.0, 4.0]


def test_the_feed_and_its_shuffles_take_little_room(spark, sf_dir, tmp_path):
    """Files of the feed are compressed, no rows are dealt to write them, and what was written leaves no shuffle files."""
    from footform.sources.folders import CLEANUP_KEY, shared_dir, written

    before = set(children(spark, shared_dir(spark)))
    QUERIES["odds_stream"](spark, sf_dir)
    folder = next(n for n in set(children(spark, shared_dir(spark))) - before if n.startswith("stream-"))
    parts = [p for p in children(spark, f"{shared_dir(spark)}/{folder}/in") if "=" in p]
    files = [f for p in parts for f in children(spark, f"{shared_dir(spark)}/{folder}/in/{p}")]
    assert len(parts) == 4 and len(files) >= 4 and all(f.endswith(".json.gz") for f in files)
    held = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    count = held()
    written(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count(), f"file://{tmp_path}/t")
    assert held() <= count and spark.conf.get(CLEANUP_KEY, "false") == "false"
