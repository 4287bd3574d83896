"""Message layouts, star-schema tables and their constraints.

Everything here is a fixed value: the field names, types, lengths, keys and seed
rows a user's messages and tables already have.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: fields of the four message types -------------------------------
MESSAGE_DDL = {
    "race_result": """
        event_type string, year int, gp_name string, round int, driver_id string, driver_name string,
        team string, position int, points double, status string, fastest_lap string, ingested_at string""",
    "pit_stop": """
        event_type string, year int, gp_name string, round int, driver_id string, lap_number int,
        pit_duration_sec double, compound string, tyre_life int, ingested_at string""",
    "telemetry": """
        event_type string, year int, gp_name string, driver_id string, speed_kmh double, throttle_pct double,
        brake boolean, drs int, gear int, rpm double, x double, y double, sample_no bigint, ingested_at string""",
    "weather": """
        event_type string, year int, gp_name string, air_temp_c double, track_temp_c double, humidity_pct double,
        wind_speed_ms double, rainfall boolean, sampled_at string, ingested_at string""",
}

# --- fixed values: topic and key columns of each message type ----------------------
TOPICS = {
    "race_result": "race_results",
    "pit_stop": "pit_stops",
    "telemetry": "telemetry",
    "weather": "weather",
}
MESSAGE_KEYS = {
    "race_result": ["year", "round", "driver_id"],
    "pit_stop": ["year", "round", "driver_id", "lap_number"],
    "telemetry": ["year", "gp_name", "driver_id"],
    "weather": ["year", "gp_name"],
}

# --- fixed values: columns of the star schema ---------------------------------------
TABLE_DDL = {
    "dim_driver": """
        driver_id string, driver_name string, nationality string, current_team string, date_of_birth date,
        created_at timestamp, updated_at timestamp, last_year smallint, last_round smallint""",
    "dim_circuit": """
        circuit_id bigint, year smallint, round smallint, gp_name string, circuit_name string, country string,
        city string, lat decimal(9,6), lng decimal(9,6)""",
    "dim_team": "team_id bigint, team_name string, nationality string, constructor_id string",
    "dim_tyre": "tyre_id bigint, compound string, colour_hex string",
    "fact_race_result": """
        result_id bigint, year smallint, round smallint, gp_name string, driver_id string, team string,
        position smallint, points decimal(4,1), status string, fastest_lap string, is_winner boolean,
        is_points_finish boolean, ingested_at timestamp""",
    "fact_pit_stop": """
        pit_id bigint, year smallint, round smallint, gp_name string, driver_id string, lap_number smallint,
        pit_duration_sec decimal(6,3), compound string, tyre_life smallint, ingested_at timestamp""",
    "fact_weather": """
        weather_id string, year smallint, gp_name string, air_temp_c decimal(4,1), track_temp_c decimal(4,1),
        humidity_pct decimal(4,1), wind_speed_ms decimal(4,1), rainfall boolean, sampled_at timestamp,
        ingested_at timestamp""",
    "fact_telemetry": """
        sample_id string, year smallint, gp_name string, driver_id string, sample_no bigint, speed_kmh double,
        throttle_pct double, brake boolean, drs int, gear int, rpm double, x double, y double,
        ingested_at timestamp""",
}

# --- fixed values: constraints of the star schema -----------------------------------
SURROGATE_KEY = {
    "dim_circuit": "circuit_id",
    "dim_team": "team_id",
    "dim_tyre": "tyre_id",
    "fact_race_result": "result_id",
    "fact_pit_stop": "pit_id",
}
NATURAL_KEY = {
    "dim_driver": ["driver_id"],
    "dim_circuit": ["year", "round"],
    "dim_team": ["team_name"],
    "dim_tyre": ["compound"],
    "fact_race_result": ["year", "round", "driver_id"],
    "fact_pit_stop": ["year", "round", "driver_id", "lap_number"],
    "fact_weather": ["year", "gp_name", "weather_id"],
    "fact_telemetry": ["year", "gp_name", "driver_id", "sample_id"],
}
NOT_NULL = {
    "dim_driver": ["driver_id", "driver_name"],
    "dim_circuit": ["year", "round", "gp_name"],
    "dim_team": ["team_name"],
    "dim_tyre": ["compound"],
    "fact_race_result": ["year", "round", "gp_name"],
    "fact_pit_stop": ["year", "round", "lap_number"],
    "fact_weather": ["year", "gp_name"],
    "fact_telemetry": ["year", "gp_name"],
}
MAX_LENGTH = {
    "dim_driver": {"driver_id": 10, "driver_name": 100, "nationality": 50, "current_team": 100},
    "dim_circuit": {"gp_name": 100, "circuit_name": 100, "country": 50, "city": 50},
    "dim_team": {"team_name": 100, "nationality": 50, "constructor_id": 50},
    "dim_tyre": {"compound": 20, "colour_hex": 7},
    "fact_race_result": {"gp_name": 100, "driver_id": 10, "team": 100, "status": 50},
    "fact_pit_stop": {"gp_name": 100, "driver_id": 10, "compound": 20},
    "fact_weather": {"gp_name": 100},
}
FALSE_BY_DEFAULT = {
    "fact_race_result": ["is_winner", "is_points_finish"],
    "fact_weather": ["rainfall"],
}
NOW_BY_DEFAULT = {
    "dim_driver": ["created_at", "updated_at"],
    "fact_race_result": ["ingested_at"],
    "fact_pit_stop": ["ingested_at"],
    "fact_weather": ["ingested_at"],
    "fact_telemetry": ["ingested_at"],
}

# --- fixed values: seed rows of the tyre dimension ----------------------------------
TYRES = [
    ("SOFT", "#FF0000"),
    ("MEDIUM", "#FFFF00"),
    ("HARD", "#FFFFFF"),
    ("INTERMEDIATE", "#00FF00"),
    ("WET", "#0000FF"),
]

# --- fixed values: rounds of the seasons loaded by default -----------------------------
SEASON_ROUNDS = {2023: 22, 2024: 23}

# --- fixed values: score rules ------------------------------------------------------
WINNING_POSITION = 1
LAST_POINTS_POSITION = 10
LAST_PODIUM_POSITION = 3

# Directory layout of each fact: what the served queries filter on, and what one load rewrites.
PARTITIONED_BY = {
    "fact_race_result": ["year", "round"],
    "fact_pit_stop": ["year", "round"],
    "fact_weather": ["year", "gp_name"],
    "fact_telemetry": ["year", "gp_name"],
}
SORTED_BY = {
    "fact_race_result": ["driver_id"],
    "fact_pit_stop": ["driver_id", "lap_number"],
    "fact_weather": ["sampled_at"],
    "fact_telemetry": ["driver_id", "sample_no"],
}


# columns that `plans.load.lay_out` makes files selective on, all alike
CLUSTERED_BY = {
    "fact_race_result": ["driver_id", "team"],
    "fact_pit_stop": ["driver_id", "compound"],
    "fact_telemetry": ["driver_id", "sample_no"],
}


def message_schema(event_type: str) -> T.StructType:
    return T.StructType.fromDDL(MESSAGE_DDL[event_type])


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_DDL[table])
