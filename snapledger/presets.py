"""Fixed values of the yearly player workload; every operator takes them as parameters."""

from __future__ import annotations

import datetime as dt

# Old column name -> common column name.
COLUMN_TRANSLATION = {
    "player_name": "Name",
    "overall_rating": "Rating",
    "crossing": "Crossing",
    "finishing": "Finishing",
    "heading_accuracy": "Heading",
    "short_passing": "Short_Pass",
    "volleys": "Volleys",
    "dribbling": "Dribbling",
    "curve": "Curve",
    "free_kick_accuracy": "Freekick_Accuracy",
    "long_passing": "Long_Pass",
    "ball_control": "Ball_Control",
    "acceleration": "Acceleration",
    "sprint_speed": "Speed",
    "agility": "Agility",
    "reactions": "Reactions",
    "balance": "Balance",
    "shot_power": "Shot_Power",
    "jumping": "Jumping",
    "stamina": "Stamina",
    "strength": "Strength",
    "long_shots": "Long_shots",
    "aggression": "Aggression",
    "interceptions": "Interceptions",
    "positioning": "Attacking_Position",
    "vision": "Vision",
    "penalties": "penalties",
    "marking": "Marking",
    "standing_tackle": "Standing_Tackle",
    "sliding_tackle": "Sliding_Tackle",
    "gk_diving": "GK_Diving",
    "gk_handling": "GK_Handling",
    "gk_kicking": "GK_Kicking",
    "gk_positioning": "GK_Positioning",
    "gk_reflexes": "GK_Reflexes",
    "height": "Height",
    "weight": "Weight",
    "Age": "Age",
    "Work_Rate": "Work_Rate",
}

# Clubs of the season.
CLUBS = [
    "Chelsea", "Arsenal", "Manchester United", "Manchester City", "Tottenham Hotspur",
    "Liverpool", "Everton", "Stoke City", "West Ham United", "Leicester City",
    "Crystal Palace", "Watford", "Southampton", "Swansea City", "Sunderland",
    "West Bromwich Albion", "Burnley", "Middlesbrough", "Hull City", "Bournemouth",
]

# Columns of the club file that are not used.
CLUB_FILE_UNUSED = [
    "Nationality", "National_Position", "National_Kit", "Club_Position", "Club_Kit",
    "Club_Joining", "Contract_Expiry", "Preffered_Foot", "Birth_Date",
]

# Columns of the dated history that are not used.
HISTORY_UNUSED = [
    "player_api_id", "potential", "preferred_foot", "attacking_work_rate", "defensive_work_rate",
]

# Columns of the dimension that are not used after the age is known.
DIMENSION_UNUSED = ["birthday", "player_api_id", "id"]

# Useful columns of the newest file.
USEFUL_COLUMNS = [
    "ID", "age", "height_cm", "weight_kg", "overall", "pac", "sho", "pas", "dri", "def", "phy",
    "skill_moves", "weak_foot", "work_rate_att", "work_rate_def",
]

# The six predicted attributes and the score they lead to.
TARGETS = ["pac", "sho", "pas", "dri", "def", "phy"]
OVERALL = "overall"

# Closed category domain and its default.
LEVELS = ["high", "medium", "low"]
DEFAULT_LEVEL = "medium"

# Reference dates, unit factor, scale of predicted attributes.
AGE_AS_OF = dt.date(2015, 10, 1)
WINDOW_START = dt.date(2015, 8, 1)
WINDOW_END = dt.date(2016, 2, 1)
KG_TO_LB = 2.20462
PREDICTION_SCALE = 120.0

# Split and search ratios, candidate grid, histogram size.
TRAIN_TENTHS = 8
ATTRIBUTE_TRAIN_RATIO = 0.8
OVERALL_TRAIN_RATIO = 0.6
FOREST_DEPTHS = [10, 20]
FOREST_TREES = [60, 80, 100]
FOREST_BINS = 15
BOOSTED_ITERATIONS = [10, 50, 100, 150, 200]
HISTOGRAM_BINS = (100, 100)


def patch_player(key: str) -> dict:
    """The one player missing from the dimension, keyed by ``key``."""
    return {
        "id": 138985,
        "player_api_id": -1,
        "player_name": "Papy Djilobodji",
        key: 197937,
        "birthday": "1988-12-01 00:00:00",
        "height": 193,
        "weight": 181,
    }
