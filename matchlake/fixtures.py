"""Bronze-shaped match rows derived from the ``lineitem`` table.

One match per line item, by integer arithmetic only, with missing, malformed and
out-of-range values mixed in so that every cast, filter and test has work to do.
Written as SQL text: 48 columns take one call instead of a thousand Column objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.schemas import BRONZE_COLUMNS, BRONZE_TEXT, LEAGUES
from matchlake.session import compiled_methods

READ = ["l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"]
# Used by many columns, so computed once per row in a step of their own.
SHARED = {
    "pk": "l_partkey",
    "ok": "l_orderkey",
    "sk": "l_suppkey",
    "day": "cast(l_shipdate AS DATE)",
    "q": "cast(l_quantity AS BIGINT)",
    "home": "cast(l_quantity AS BIGINT) % 5",
    "away": "cast(l_linenumber AS BIGINT) % 4",
    "ht_home": "least(cast(l_quantity AS BIGINT) % 5, l_suppkey % 3)",
    "ht_away": "least(cast(l_linenumber AS BIGINT) % 4, l_partkey % 2)",
    "has_half_time": "l_orderkey % 13 <> 0",
    "has_stats": "l_orderkey % 17 <> 0",
    "has_odds": "l_orderkey % 19 <> 0",
    "has_elo": "l_suppkey % 11 <> 0",
}

CODES = ", ".join(f"'{code}'" for code, _, _ in LEAGUES)

COLUMNS = {
    "Division": f"get(array({CODES}, 'ZZ9', NULL), cast(sk % 40 AS INT))",
    "MatchDate": "CASE WHEN pk % 97 = 0 THEN NULL WHEN pk % 89 = 0 THEN '31/12/1999' "
    "ELSE cast(day AS STRING) END",
    "MatchTime": "if(ok % 2 = 0, '15:00', NULL)",
    "HomeTeam": "if(ok % 101 = 0, NULL, concat('Team_', pk % 20))",
    "AwayTeam": "if(ok % 103 = 0, NULL, concat('Team_', ok % 20))",
    "HomeElo": "if(has_elo, 1200 + (pk % 8000) / 10, NULL)",
    "AwayElo": "if(has_elo, 1200 + (ok % 8000) / 10, NULL)",
    "Form3Home": "sk % 10",
    "Form5Home": "sk % 16",
    "Form3Away": "(sk + 3) % 10",
    "Form5Away": "(sk + 5) % 16",
    "FTHome": "CASE WHEN pk % 83 = 0 THEN NULL WHEN pk % 79 = 0 THEN 2.5D ELSE home END",
    "FTAway": "if(ok % 83 = 0, NULL, away)",
    "FTResult": "CASE WHEN ok % 73 = 0 THEN NULL WHEN ok % 71 = 0 THEN 'X' "
    "ELSE decode(sign(home - away), 1, 'H', -1, 'A', 'D') END",
    "HTHome": "if(has_half_time, ht_home, NULL)",
    "HTAway": "if(has_half_time, ht_away, NULL)",
    "HTResult": "if(has_half_time, decode(sign(ht_home - ht_away), 1, 'H', -1, 'A', 'D'), NULL)",
    "HandiSize": "(pk % 9 - 4) * 0.25D",
    "HandiHome": "(150 + pk % 100) / 100",
    "HandiAway": "(150 + ok % 100) / 100",
}
STAT_BOUNDS = [25, 25, 12, 12, 20, 20, 13, 13, 6, 6, 3, 3]
for _k, (_name, _bound) in enumerate(zip(BRONZE_COLUMNS[17:29], STAT_BOUNDS)):
    _odd = {"HomeShots": "WHEN pk % 211 = 0 THEN double('NaN')",
            "AwayShots": "WHEN pk % 223 = 0 THEN double('Infinity')"}.get(_name, "")
    COLUMNS[_name] = f"CASE WHEN NOT has_stats THEN NULL {_odd} ELSE (q + {_k}) % {_bound} END"
for _k, _name in enumerate(BRONZE_COLUMNS[29:39]):
    COLUMNS[_name] = f"if(has_odds, (101 + (pk + {37 * _k}) % 500) / 100, NULL)"
for _k, _name in enumerate(BRONZE_COLUMNS[42:48]):
    COLUMNS[_name] = f"((ok + {7 * _k}) % 100) / 100"


def matches_from_lineitem(lineitem: DataFrame) -> DataFrame:
    shared = lineitem.selectExpr(*[f"{sql} AS {name}" for name, sql in SHARED.items()])
    return shared.selectExpr(
        *[
            f"{COLUMNS[c]} AS {c}" if c in BRONZE_TEXT else f"cast({COLUMNS[c]} AS DOUBLE) AS {c}"
            for c in BRONZE_COLUMNS
        ]
    )


def matches(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """``spread`` deals the line items to all cores first, however few row groups they lie in;
    for rows that are derived to be written."""
    compiled_methods(spark)  # 48 derived columns are far beyond one compiled method
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if spread:
        rows = lineitem.select(*READ)
        tasks = max(spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
        lineitem = rows.repartition(tasks, *READ)
    return matches_from_lineitem(lineitem)
