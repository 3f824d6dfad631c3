"""Registry, provided tables, and domain tables derived from them.

Derived tables exist twice: as DataFrames here, and as SQL text that a check
query gets as common table expressions. game = order, batter = part,
pitcher = supplier, plate appearance = line item.
"""

from __future__ import annotations

import re
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.operators import segments
from slatework.operators.resolve import NAME_TASK_ROWS
from slatework.operators.shape import team_rows

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

# Thirty team spellings, some of them aliases.
TEAMS = (
    "AZ,ATL,BAL,BOS,CHC,CWS,CIN,CLE,COL,DET,HOU,KCR,LAA,LAD,MIA,MIL,MIN,NYM,NYY,ATH,PHI,PIT,SDP,"
    "SEA,SFG,STL,TBR,TEX,TOR,WAS"
)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and, if given, its SQL check."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(Tables(spark, sf_dir)))

        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = with_derived(sql)
        return fn

    return register


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


# Doubles are compared at six digits. The point where rounding turns is moved a
# little off the half, so that exact decimal halves (common in sums of short
# decimals) do not depend on the order of additions.
SCALE, TURN = 1e6, 0.5001


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded to six digits, by the same arithmetic as ``r``."""
    return df.select(
        *[
            (F.floor(F.col(f"`{f.name}`") * SCALE + TURN) / SCALE).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def r(expression: str, name: str | None = None) -> str:
    """SQL: a rounded double column."""
    return f"floor(({expression}) * 1e6 + {TURN}) / 1e6 as {name or expression}"


def rs(names: list[str], prefix: str = "") -> str:
    return ", ".join(r(prefix + n, n) for n in names)


_TEAM_SQL = f"split_part('{TEAMS}', ',', cast({{}} + 1 as int))"
_HOME, _AWAY = "o_custkey % 30", "(o_custkey % 30 + 1 + o_orderkey % 29) % 30"

EVENT_SQL = (
    "case when l_quantity <= 2 then 'home_run' when l_quantity <= 3 then 'triple'"
    " when l_quantity <= 6 then 'double' when l_quantity <= 14 then 'single'"
    " when l_quantity <= 19 then 'walk' when l_quantity <= 20 then 'hit_by_pitch'"
    " when l_quantity <= 31 then 'strikeout' else 'field_out' end"
)
PA_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"

DERIVED = {
    "dt_games": f"""
select o_orderkey as game_pk, cast(o_orderdate as date) as game_date,
 cast(year(o_orderdate) as bigint) as season, o_custkey % 30 as venue_id,
 {_TEAM_SQL.format(_HOME)} as home_team, {_TEAM_SQL.format(_AWAY)} as away_team,
 case when o_orderstatus = 'P' then null else cast(floor(o_totalprice) as bigint) % 10 end as home_score,
 case when o_orderstatus = 'P' then null else cast(floor(o_totalprice / 10) as bigint) % 10 end as away_score,
 o_orderstatus as status from orders""",
    "dt_pa": f"""
select game_pk, game_date, season,
 cast(row_number() over (partition by l_orderkey order by {PA_ORDER}) as bigint) as pa_index,
 l_partkey as batter_id, concat('B', cast(l_partkey as string)) as batter_name,
 l_suppkey as pitcher_id, concat('P', cast(l_suppkey as string)) as pitcher_name,
 {EVENT_SQL} as event_type,
 case when l_quantity between 15 and 31 then null else 110.0 - l_quantity end as launch_speed,
 case when l_quantity between 15 and 31 then null else l_discount * 400 + 0.0 end as launch_angle,
 cast(l_linenumber % 3 as bigint) as outs_before_pa,
 case l_returnflag when 'A' then '' when 'R' then '1' else '13' end as base_state_before,
 cast(1 + l_partkey % 9 as bigint) as inning,
 case when l_suppkey % 2 = 0 then 'Top' else 'bottom' end as inning_topbot,
 cast(case when l_quantity <= 6 then l_linenumber % 3 else 0 end as bigint) as rbi,
 cast(l_linenumber % 2 as bigint) as runs_scored_on_pa,
 case when (game_pk + l_partkey) % 2 = 0 then home_team else away_team end as batting_team
from lineitem join dt_games on l_orderkey = game_pk""",
    "dt_flags": """
select *, true as is_pa,
 event_type in ('single', 'double', 'triple', 'home_run', 'strikeout', 'field_out') as is_ab,
 event_type in ('single', 'double', 'triple', 'home_run') as is_hit,
 event_type = 'single' as is_1b, event_type = 'double' as is_2b, event_type = 'triple' as is_3b,
 event_type = 'home_run' as is_hr, event_type = 'walk' as is_bb, event_type = 'hit_by_pitch' as is_hbp,
 event_type = 'strikeout' as is_so, rbi > 0 as is_rbi, false as is_sac_fly,
 false as is_reached_on_error from dt_pa""",
    "dt_sides": """
select game_pk, game_date, season, home_team as team, away_team as opponent, true as is_home, 1 as side from dt_games
union all
select game_pk, game_date, season, away_team as team, home_team as opponent, false as is_home, 0 as side from dt_games""",
    "dt_lineups": """
select game_pk, game_date, season, team, opponent, is_home, cast(slot as bigint) as batting_order,
 (game_pk * 18 + side * 9 + slot) % (select count(*) from part) as player_id,
 concat('B', cast((game_pk * 18 + side * 9 + slot) % (select count(*) from part) as string)) as player_name,
 case when slot = 9 and game_pk % 4 = 0 then null else 0.9 + slot * 0.03 end as lineup_weight,
 cast((game_pk * 18 + side * 9 + slot) % 997 as double) / 1000 as tie_break_noise
from (select *, unnest(range(1, 10)) as slot from dt_sides)""",
    "dt_confirmed": """
select game_pk, game_date, season, team, opponent, is_home, batting_order, player_name,
 'confirmed' as lineup_status,
 case when game_pk % 3 = 0 and batting_order = 9 then null else player_id end as player_id
from dt_lineups""",
    "dt_projected": """
select game_pk, game_date, season, team, opponent, is_home, batting_order, player_name,
 'projected' as lineup_status,
 case when game_pk % 5 = 0 and batting_order = 1 then null else player_id end as player_id
from dt_lineups""",
    "dt_starters": """
select game_pk, game_date, season, team, opponent, is_home, 'probable' as starter_status,
 case when (game_pk * 2 + side) % 17 = 0 then null else (game_pk * 2 + side) % (select count(*) from supplier) end
 as pitcher_id, concat('P', cast((game_pk * 2 + side) % (select count(*) from supplier) as string)) as pitcher_name,
 case when game_pk % 2 = 0 then 'R' else 'L' end as throws from dt_sides""",
    "dt_weather": """
select game_pk, case when game_pk % 10 = 0 then null else cast(50 + game_pk % 50 as double) end as temperature_f,
 cast(game_pk % 25 as double) as wind_mph,
 case when game_pk % 7 = 0 then null else cast(game_pk * 37 % 360 as double) end as wind_direction_deg
from dt_games""",
    "dt_parks": """
select venue_id, max(home_team) as team, concat('Park ', cast(venue_id as string)) as venue_name,
 case when venue_id % 4 = 0 then 'Retractable' when venue_id % 4 = 1 then 'Dome' else 'Open' end as roof_type,
 100.0 + cast((venue_id * 7) % 31 - 10 as double) as park_factor_hr
from dt_games group by venue_id""",
    "dt_spine": """
select g.game_pk, game_date, season, home_team, away_team,
 case when (g.game_pk * 2 + 1) % 17 = 0 then null else (g.game_pk * 2 + 1) % (select count(*) from supplier) end as home_starter_pitcher_id,
 case when (g.game_pk * 2) % 17 = 0 then null else (g.game_pk * 2) % (select count(*) from supplier) end as away_starter_pitcher_id,
 temperature_f, wind_mph,
 case when wind_direction_deg >= 315 or wind_direction_deg <= 45 then 1.0 else 0.0 end as weather_wind_out,
 case when wind_direction_deg between 135 and 225 then 1.0 else 0.0 end as weather_wind_in,
 case when wind_direction_deg is null or wind_direction_deg >= 315 or wind_direction_deg <= 45
   or wind_direction_deg between 135 and 225 then 0.0 else 1.0 end as weather_crosswind
from dt_games g join dt_weather w on g.game_pk = w.game_pk""",
    "dt_people": """
select c_custkey as person_id, c_nationkey % 5 as team_no,
 case c_custkey % 6
  when 0 then concat('José ', substr(c_name, 10), ' Jr.')
  when 1 then concat('  ANNE-MARIE  o''', substr(c_name, 10))
  when 2 then concat('Łukasz Müller ', substr(c_name, 10), ' III')
  when 3 then concat('al v ', substr(c_name, 10))
  when 4 then c_mktsegment
  else concat('Zoë ', lower(c_mktsegment), substr(c_name, 16)) end as name,
 case when c_nationkey % 5 = 4 then null else concat('t', cast(c_nationkey % 5 as string)) end as team
from customer""",
}
_LISTED = list(DERIVED)


def with_derived(sql: str) -> str:
    """Prefix the common table expressions that the text refers to."""
    needed: set[str] = set()
    queue = [sql]
    while queue:
        text = queue.pop()
        for name in set(re.findall(r"\bdt_\w+", text)) - needed:
            if name in DERIVED:
                needed.add(name)
                queue.append(DERIVED[name])
    if not needed:
        return sql
    parts = [f"{n} as ({DERIVED[n].strip()})" for n in DERIVED if n in needed]
    body = sql.strip()
    joined = ",\n".join(parts)
    if body.lower().startswith("with "):
        return f"with {joined},\n{body[5:]}"
    return f"with {joined}\n{body}"


def define(name: str, sql: str) -> None:
    """Add a derived table that only checks use."""
    DERIVED[name] = sql


# Rows of one task of the derived tables.
TASK_ROWS = segments.TASK_ROWS


class Tables:
    """Provided tables as attributes; derived ones as ``dt_`` attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        own = type(self).__dict__.get(f"make_{name}")
        if own is not None:
            frame = own(self)
        elif name in DERIVED:
            frame = self._sql(DERIVED[name])
        else:
            frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self.__dict__[name] = frame
        return frame

    def _sql(self, text: str) -> DataFrame:
        """Run SQL over provided and derived tables, passed in as arguments."""
        for name in sorted(set(re.findall(r"\b(dt_\w+|lineitem|orders|customer|part|supplier|events)\b", text))):
            if re.search(rf"\b(from|join) {name}\b", text):
                getattr(self, name).createOrReplaceTempView(name)
        return self.spark.sql(text)

    def _dealt(self, df: DataFrame, key: str, rows: int) -> DataFrame:
        """``df`` dealt by ``key`` into tasks of about ``TASK_ROWS`` of the ``rows`` that come of it."""
        return segments.dealt(df, rows, key, task_rows=TASK_ROWS)

    def make_dt_pa(self) -> DataFrame:
        # Dealt by game: numbering and game tables then need no further shuffle, and a task keeps its size.
        lines = self._dealt(self.lineitem, "l_orderkey", self.lineitem.count())
        games = self.dt_games.withColumnRenamed("game_pk", "l_orderkey")
        lines.join(games, "l_orderkey").withColumn("game_pk", F.col("l_orderkey")).createOrReplaceTempView("dt_lines")
        return self.spark.sql(DERIVED["dt_pa"].split("from lineitem join")[0] + " from dt_lines")

    def make_dt_people(self) -> DataFrame:
        # A small file, but queries make costly keys of its names.
        people = self.spark.sql(DERIVED["dt_people"].replace("from customer", "from {people}"), people=self.customer)
        return segments.dealt(people, self.customer.count(), task_rows=NAME_TASK_ROWS)

    def make_dealt_games(self) -> DataFrame:
        # The orders file has few splits; spread it before lineups make it grow eighteen-fold.
        return self._dealt(self.dt_games, "game_pk", 18 * self.orders.count())

    def deal_games(self) -> Tables:
        """Tables derived from now on are dealt by game alike, so they fold and join where they lie."""
        self.__dict__["dt_games"] = self.dealt_games
        return self

    def _sides_of(self, games: DataFrame) -> DataFrame:
        sides = team_rows(games, ["game_pk", "game_date", "season"], F.col("home_team"), F.col("away_team"))
        return sides.withColumn("side", F.col("is_home").cast("int"))

    def make_dt_sides(self) -> DataFrame:
        return self._sides_of(self.dt_games)

    def make_dt_lineups(self) -> DataFrame:
        sides = self._sides_of(self.dealt_games)
        slots = sides.select("*", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("slot"))
        text = DERIVED["dt_lineups"].split("from (select *, unnest")[0]
        slots.createOrReplaceTempView("dt_slots")
        self.part.createOrReplaceTempView("part")
        return self.spark.sql(text + " from dt_slots")
