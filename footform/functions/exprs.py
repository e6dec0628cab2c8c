"""Scalar functions as column expressions."""

from __future__ import annotations

import json
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position codes and their abbreviations.
POSITIONS = {
    "right-wing": "RW", "left-wing": "LW", "right-winger": "RW", "left-winger": "LW", "right-midfield": "RM", "left-midfield": "LM", "central-midfield": "CM", "defensive-midfield": "DM",
    "attacking-midfield": "AM", "right-back": "RB", "left-back": "LB", "centre-back": "CB", "central-defender": "CB", "goalkeeper": "GK", "striker": "ST", "centre-forward": "ST",
}
# Keys that hold a statistic's number, in this order, and the statistics that are minutes.
STAT_KEYS = ("value", "total", "goals", "shots_on_target", "shotson_target", "in", "out", "home", "away", "penalties")
MINUTES_TYPES = (119, 1584)
MARKETS = {267: "player_shots_on_target", 268: "player_shots", 331: "player_to_score", 332: "player_to_assist", 333: "player_to_score_or_assist"}
PLAYER_MARKETS = ("goalscorers", "1st_goal_scorer", "last_goal_scorer", "multi_scorers", "player_to_score", "player_to_score_or_assist", "player_shots", "player_shots_on_target")


def first_true(*columns: Column) -> Column:
    """The first column that is neither null nor empty nor zero, as text; the way ``a or b`` reads a payload."""
    texts = [c.cast("string") for c in columns]
    return F.coalesce(*(F.when(~t.isin("", "0", "0.0", "false", "{}", "[]"), t) for t in texts))


def json_true(text: Column, field: str) -> Column:
    """A field of a JSON object as text, null where it is null, an empty text, a bare zero or false; a quoted "0" counts."""
    value = F.get_json_object(text, f"$.{field}")
    quoted = F.regexp_like(text, F.lit(rf'"{field}"\s*:\s*"'))
    return F.when(quoted, F.nullif(value, F.lit(""))).otherwise(first_true(value))


def parse_dt(c: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(F.regexp_replace(c, "Z", ""), "T", " "))


def safe_int(c: Column) -> Column:
    """Whole part of a number or numeric text; null for anything else."""
    text = F.trim(c.cast("string"))
    return F.coalesce(text.try_cast("bigint"), F.when(~F.lower(text).isin("nan", "inf", "-inf", "infinity", "-infinity"), text.try_cast("double")).try_cast("bigint")).try_cast("int")


def stat_value(data: Column) -> Column:
    """A number from a scalar, or from an object: the first known key that holds one, else the first value that does."""
    entries = F.from_json(F.when(F.trim(data).startswith("{"), data), "map<string,string>")
    known = F.coalesce(*(safe_int(F.try_element_at(entries, F.lit(k))) for k in STAT_KEYS))
    parsed = F.filter(F.transform(F.map_values(entries), safe_int), lambda x: x.isNotNull())
    return F.coalesce(known, F.try_element_at(parsed, F.lit(1)), F.when(~F.trim(data).startswith("{"), safe_int(data)))


def is_starter(kind: Column) -> Column:
    low = F.lower(kind.cast("string"))
    return F.when(low.isin("11", "lineup", "starting", "starter", "1"), True).when(low.isin("12", "substitute", "sub", "bench"), False)


def minutes(direct: list[Column], details: Column) -> Column:
    """Minutes from the line-up's own fields, else from the first detail that is about minutes.

    ``details``: array of (type_id, type_name, value), values already numbers.
    """
    about = F.filter(details, lambda d: d["value"].isNotNull() & (F.coalesce(d["type_id"].isin(*MINUTES_TYPES), F.lit(False)) | F.coalesce(F.lower(d["type_name"]).contains("minute"), F.lit(False))))
    return F.coalesce(*(safe_int(c) for c in direct), F.try_element_at(about, F.lit(1))["value"])


def position_abbr(code: Column, name: Column) -> Column:
    by_code = F.try_element_at(F.create_map(*(F.lit(x) for kv in POSITIONS.items() for x in kv)), F.lower(code))
    by_name = F.coalesce(*(F.when(F.lower(name).contains(k), v) for k, v in POSITIONS.items()))
    return F.coalesce(by_code, by_name)


def slug(c: Column) -> Column:
    text = F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(text == "", "unknown").otherwise(text)


@cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """Characters that stand for one plain letter or digit, those letters and digits, and what others stand for.

    By the compatibility decomposition without its combining marks; a character that has none stands for nothing.
    """
    one, several = {}, {}
    for c in filter(unicodedata.decomposition, map(chr, range(0x80, 0x110000))):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
        plain = "".join(x for x in plain if x.isascii() and x.isalnum())
        if plain:
            (one if len(plain) == 1 else several)[c] = plain
    return "".join(one), "".join(one.values()), several


def fold_name(name: Column | str) -> Column:
    """A name without accents, in lower-case letters and digits only; null stays null."""
    name = F.col(name) if isinstance(name, str) else name
    accented, letters, several = _folds()
    plain = F.translate(name, accented, letters)
    stands_for = F.from_json(F.lit(json.dumps(several)), "map<string,string>")
    spelled = F.array_join(F.transform(F.split(plain, ""), lambda c: F.coalesce(F.try_element_at(stands_for, c), c)), "")
    known = F.when(F.octet_length(name) == F.char_length(name), name).when(F.regexp_like(plain, F.lit(f"[{''.join(several)}]")), spelled).otherwise(plain)
    return F.regexp_replace(F.lower(known), "[^a-z0-9]+", "")


def parse_float(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.regexp_replace(c, "%", "").try_cast("double"))


def parse_line(row: Column, parsed: Column | None = None, fields: tuple[str, ...] = ("label", "handicap", "line")) -> Column:
    """The first field of a JSON object that gives a line: a number as it is, a text's first unsigned number.

    ``parsed`` has the fields as texts already; the object is then only looked at where a sign makes a difference.
    """

    def one(name: str) -> Column:
        raw = F.get_json_object(row, f"$.{name}") if parsed is None else parsed[name]
        number = raw.try_cast("double")
        plain = number.isNotNull() & (F.translate(raw, "0123456789.", "") == "") & ~raw.startswith(".")
        unsigned = F.nullif(F.regexp_extract(raw, r"([0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).try_cast("double")
        quoted = F.regexp_like(row, F.lit(rf'"{name}"\s*:\s*"'))
        return F.when(plain, number).when(number.isNull() | quoted, unsigned).otherwise(number)  # branches are only read in turn

    return F.coalesce(*(one(f) for f in fields))


def market_key(row: Column, parsed: Column | None = None) -> Column:
    get = lambda name: F.get_json_object(row, f"$.{name}") if parsed is None else parsed[name]
    known = F.try_element_at(F.create_map(*(F.lit(x) for kv in MARKETS.items() for x in kv)), safe_int(get("market_id")))
    text = F.coalesce(first_true(get("market_description"), get("market")), F.lit("market"))
    return F.coalesce(known, slug(text))


def participant_type(description: Column, market: Column) -> Column:
    low = F.lower(F.coalesce(description, F.lit("")))
    return F.when(low.contains("player") | market.startswith("player_") | market.isin(*PLAYER_MARKETS), "player").when(low.contains("team"), "team")


def over_line(total: Column) -> Column:
    """The number of an over/under text such as "Over 8.5"."""
    return F.trim(F.regexp_replace(F.trim(total), r"(?i)^(over|under)", "")).try_cast("double")
