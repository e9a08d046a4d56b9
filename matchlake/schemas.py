"""Declared columns, accepted values and the league dimension.

Everything here is a fixed value: names, order and spellings define the data
model, so they are listed plainly and nothing is computed from them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- bronze: fixed column names, in file order ----------------------------
BRONZE_COLUMNS = """
    Division MatchDate MatchTime HomeTeam AwayTeam
    HomeElo AwayElo Form3Home Form5Home Form3Away Form5Away
    FTHome FTAway FTResult HTHome HTAway HTResult
    HomeShots AwayShots HomeTarget AwayTarget HomeFouls AwayFouls
    HomeCorners AwayCorners HomeYellow AwayYellow HomeRed AwayRed
    OddHome OddDraw OddAway MaxHome MaxDraw MaxAway
    Over25 Under25 MaxOver25 MaxUnder25
    HandiSize HandiHome HandiAway
    C_LTH C_LTA C_VHD C_VAD C_HTB C_PHB
""".split()

BRONZE_TEXT = set("Division MatchDate MatchTime HomeTeam AwayTeam FTResult HTResult".split())

BRONZE = T.StructType(
    [
        T.StructField(name, T.StringType() if name in BRONZE_TEXT else T.DoubleType())
        for name in BRONZE_COLUMNS
    ]
)

# --- silver: fixed names, (raw column, staged column, kind) in output order --
STAGED = [
    ("Division", "division", "text"),
    ("MatchDate", "match_date", "date"),
    ("HomeTeam", "home_team", "text"),
    ("AwayTeam", "away_team", "text"),
    ("FTHome", "home_goals_ft", "int"),
    ("FTAway", "away_goals_ft", "int"),
    ("FTResult", "full_time_result", "text"),
    ("HTHome", "home_goals_ht", "int"),
    ("HTAway", "away_goals_ht", "int"),
    ("HTResult", "half_time_result", "text"),
    ("HomeElo", "home_elo", "double"),
    ("AwayElo", "away_elo", "double"),
    ("Form3Home", "form_3_home", "double"),
    ("Form5Home", "form_5_home", "double"),
    ("Form3Away", "form_3_away", "double"),
    ("Form5Away", "form_5_away", "double"),
    ("HomeShots", "home_shots", "int"),
    ("AwayShots", "away_shots", "int"),
    ("HomeTarget", "home_shots_on_target", "int"),
    ("AwayTarget", "away_shots_on_target", "int"),
    ("HomeFouls", "home_fouls", "int"),
    ("AwayFouls", "away_fouls", "int"),
    ("HomeCorners", "home_corners", "int"),
    ("AwayCorners", "away_corners", "int"),
    ("HomeYellow", "home_yellow_cards", "int"),
    ("AwayYellow", "away_yellow_cards", "int"),
    ("HomeRed", "home_red_cards", "int"),
    ("AwayRed", "away_red_cards", "int"),
    ("OddHome", "odds_home", "double"),
    ("OddDraw", "odds_draw", "double"),
    ("OddAway", "odds_away", "double"),
    ("MaxHome", "odds_max_home", "double"),
    ("MaxDraw", "odds_max_draw", "double"),
    ("MaxAway", "odds_max_away", "double"),
    ("Over25", "odds_over_25", "double"),
    ("Under25", "odds_under_25", "double"),
    ("MaxOver25", "odds_max_over_25", "double"),
    ("MaxUnder25", "odds_max_under_25", "double"),
]

KEY_COLUMNS = ["Division", "MatchDate", "HomeTeam", "AwayTeam", "FTHome", "FTAway"]
KEY_NULL_TEXT = "_dbt_utils_surrogate_key_null_"  # fixed: part of the key's definition
REQUIRED_RAW = ["MatchDate", "HomeTeam", "AwayTeam"]

SILVER_COLUMNS = (
    ["match_id"]
    + [staged for _, staged, _ in STAGED]
    + ["country", "league_name", "match_year"]
)

# --- mart: fixed names and order --------------------------------------------
MART_CARRIED = """
    match_id division country league_name match_date match_year home_team away_team
    home_goals_ft away_goals_ft home_goals_ht away_goals_ht
    full_time_result half_time_result home_shots away_shots
    home_shots_on_target away_shots_on_target home_corners away_corners
    home_yellow_cards away_yellow_cards home_red_cards away_red_cards
""".split()
MART_DERIVED = "total_goals match_result_label goal_difference goal_timing scoring_category".split()
MART_COLUMNS = MART_CARRIED + MART_DERIVED

MART_DIVISIONS = ["E0", "SP1", "I1", "D1", "F1", "B1", "P1", "E1", "DEN", "POL"]
REQUIRED_CAST = ["match_date", "home_goals_ft", "away_goals_ft"]

# --- accepted values ----------------------------------------------------------
RESULT_CODES = ["H", "A", "D"]
RESULT_LABELS = ["Home Win", "Away Win", "Draw", "Unknown"]
GOAL_TIMINGS = [
    "No Goals",
    "All Goals in First Half",
    "All Goals in Second Half",
    "Goals in Both Halves",
    "Data Unavailable",
]
SCORING_CATEGORIES = ["Goalless", "Low Scoring", "Normal", "High Scoring"]

# --- league dimension: fixed code / country / league_name rows ----------------
LEAGUE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("code", "country", "league_name")]
)
LEAGUES = [
    ("ARG", "Argentina", "Liga Profesional de Fútbol"),
    ("AUT", "Austria", "Austrian Bundesliga"),
    ("B1", "Belgium", "Pro League"),
    ("BRA", "Brazil", "Brasileirao"),
    ("CHN", "China", "Super League"),
    ("DEN", "Denmark", "Superliga"),
    ("E0", "England", "Premier League"),
    ("E1", "England", "Championship"),
    ("E2", "England", "League One"),
    ("E3", "England", "League Two"),
    ("EC", "England", "National League"),
    ("FIN", "Finland", "Veikkausliiga"),
    ("F1", "France", "Ligue 1"),
    ("F2", "France", "Ligue 2"),
    ("D1", "Germany", "Bundesliga"),
    ("D2", "Germany", "2. Bundesliga"),
    ("G1", "Greece", "Super League 1"),
    ("IRL", "Ireland", "League of Ireland Men's Premier"),
    ("I1", "Italy", "Serie A"),
    ("I2", "Italy", "Serie B"),
    ("JAP", "Japan", "J1 League"),
    ("MEX", "Mexico", "Liga MX"),
    ("N1", "Netherlands", "Eredivisie"),
    ("NOR", "Norway", "Eliteserien"),
    ("POL", "Poland", "Ekstraklasa"),
    ("P1", "Portugal", "Primeira Liga"),
    ("ROM", "Romania", "Liga I"),
    ("RUS", "Russia", "Rosískaya Futbólnaya Premier-League"),
    ("SC0", "Scotland", "Premiership"),
    ("SC1", "Scotland", "Championship"),
    ("SC2", "Scotland", "League One"),
    ("SC3", "Scotland", "League Two"),
    ("SP1", "Spain", "La Liga"),
    ("SP2", "Spain", "Segunda División"),
    ("SWE", "Sweden", "Allsvenskan"),
    ("SUI", "Switzerland", "Super League"),
    ("T1", "Turkey", "Süper Lig"),
    ("USA", "United States", "MLS"),
]
