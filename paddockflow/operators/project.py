"""One row per packet, for the player's car."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddockflow.functions.packets import name_text, player, split_ms


def on_clock(packets: DataFrame, clock: str = "timestamp") -> DataFrame:
    """Set the event-time column.

    The default is the record's own time, which makes results independent of how the
    input is cut into batches.  ``arrival`` stamps a whole micro-batch with its time.
    """
    source = F.current_timestamp() if clock == "arrival" else F.col(clock)
    return packets.withColumn("timestamp", source)


def _common(with_car: bool = True) -> list[Column]:
    columns = [
        F.col("timestamp"),
        F.col("m_header.m_session_uid").alias("session_uid"),
        F.col("m_header.m_session_time").alias("session_time"),
    ]
    if with_car:
        columns.append(F.col("m_header.m_player_car_index").alias("car_index"))
    return columns


def _renamed(cars: str, names: dict[str, str]) -> list[Column]:
    return [player(cars, wire).alias(ours) for wire, ours in names.items()]


def telemetry_rows(packets: DataFrame, clock: str = "timestamp") -> DataFrame:
    """Speed and engine revs of the player's car."""
    return on_clock(packets, clock).select(
        *_common(with_car=False),
        *_renamed("m_car_telemetry_data", {"m_speed": "speed", "m_engine_rpm": "rpm"}),
        "traceparent",
    )


def lap_rows(packets: DataFrame, clock: str = "timestamp", frame: bool = False) -> DataFrame:
    """Lap state of the player's car; ``frame`` adds the frame number to order by."""
    cars = "m_lap_data"

    def sector(n: int) -> Column:
        minutes = player(cars, f"m_sector{n}_time_minutes_part")
        return split_ms(minutes, player(cars, f"m_sector{n}_time_ms_part"))

    return on_clock(packets, clock).select(
        *_common(),
        *([F.col("m_header.m_frame_identifier").alias("frame_identifier")] if frame else []),
        player(cars, "m_current_lap_num").alias("current_lap_num"),
        player(cars, "m_last_lap_time_in_ms").alias("last_lap_time_ms"),
        player(cars, "m_current_lap_time_in_ms").alias("current_lap_time_ms"),
        sector(1).alias("sector1_time_ms"),
        sector(2).alias("sector2_time_ms"),
        *[
            player(cars, f"m_{name}").alias(name)
            for name in (
                "car_position", "speed_trap_fastest_speed", "num_pit_stops", "penalties",
                "total_warnings", "corner_cutting_warnings", "grid_position",
            )
        ],
        "traceparent",
    )


def participant_rows(packets: DataFrame, clock: str = "timestamp") -> DataFrame:
    """Driver dimension rows."""
    cars = "m_participants"
    plain = ("ai_controlled", "driver_id", "team_id", "race_number", "nationality")
    return on_clock(packets, clock).select(
        *_common(),
        *[player(cars, f"m_{name}").alias(name) for name in plain],
        name_text(player(cars, "m_name")).alias("name"),
        player(cars, "m_platform").alias("platform"),
        "traceparent",
    )


def lobby_rows(packets: DataFrame, clock: str = "timestamp") -> DataFrame:
    """Lobby dimension rows."""
    cars = "m_lobby_players"
    return on_clock(packets, clock).select(
        *_common(),
        *[player(cars, f"m_{name}").alias(name) for name in ("ai_controlled", "team_id", "nationality")],
        name_text(player(cars, "m_name")).alias("name"),
        *[player(cars, f"m_{name}").alias(name) for name in ("car_number", "platform", "ready_status")],
        "traceparent",
    )
