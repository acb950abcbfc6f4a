"""Binary layouts of the 16 datagram kinds.

A layout is text: one line per wire type, naming the fields of that type in wire
order.  ``u16[4] name`` is an array, ``Name[22] field`` an array of a struct given
earlier.  From it come the NumPy dtype that reads the bytes and the Spark type of
the decoded value, so sizes and schemas are derived and never written twice.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
from pyspark.sql import types as T

# --- fixed values: the wire format -----------------------------------------------

CARS = 22

KINDS = (
    "motion", "session", "lap", "event", "participants", "car_setups",
    "car_telemetry", "car_status", "final_classification", "lobby_info",
    "car_damage", "session_history", "tyre_sets", "motion_ex", "time_trial",
    "lap_positions",
)  # position = packet id

PUBLISHED = ("car_telemetry", "lap", "lobby_info", "participants")

HEADER = """
u16 m_packet_format
u8 m_game_year m_game_major_version m_game_minor_version m_packet_version m_packet_id
u64 m_session_uid
f32 m_session_time
u32 m_frame_identifier m_overall_frame_identifier
u8 m_player_car_index m_secondary_player_car_index
"""

STRUCTS = {
    "CarMotion": """
f32 m_world_position_x m_world_position_y m_world_position_z
f32 m_world_velocity_x m_world_velocity_y m_world_velocity_z
i16 m_world_forward_dir_x m_world_forward_dir_y m_world_forward_dir_z
i16 m_world_right_dir_x m_world_right_dir_y m_world_right_dir_z
f32 m_g_force_lateral m_g_force_longitudinal m_g_force_vertical
f32 m_yaw m_pitch m_roll
""",
    "MarshalZone": """
f32 m_zone_start
i8 m_zone_flag
""",
    "WeatherForecastSample": """
u8 m_session_type m_time_offset m_weather
i8 m_track_temperature m_track_temperature_change
i8 m_air_temperature m_air_temperature_change
u8 m_rain_percentage
""",
    "Lap": """
u32 m_last_lap_time_in_ms m_current_lap_time_in_ms
u16 m_sector1_time_ms_part
u8 m_sector1_time_minutes_part
u16 m_sector2_time_ms_part
u8 m_sector2_time_minutes_part
u16 m_delta_to_car_in_front_ms_part
u8 m_delta_to_car_in_front_minutes_part
u16 m_delta_to_race_leader_ms_part
u8 m_delta_to_race_leader_minutes_part
f32 m_lap_distance m_total_distance m_safety_car_delta
u8 m_car_position m_current_lap_num m_pit_status m_num_pit_stops m_sector
u8 m_current_lap_invalid m_penalties m_total_warnings m_corner_cutting_warnings
u8 m_num_unserved_drive_through_pens m_num_unserved_stop_go_pens
u8 m_grid_position m_driver_status m_result_status m_pit_lane_timer_active
u16 m_pit_lane_time_in_lane_in_ms m_pit_stop_timer_in_ms
u8 m_pit_stop_should_serve_pen
f32 m_speed_trap_fastest_speed
u8 m_speed_trap_fastest_lap
""",
    "LiveryColour": """
u8 red green blue
""",
    "Participant": """
u8 m_ai_controlled m_driver_id m_network_id m_team_id m_my_team m_race_number m_nationality
u8[32] m_name
u8 m_your_telemetry m_show_online_names
u16 m_tech_level
u8 m_platform m_num_colours
LiveryColour[4] m_livery_colours
""",
    "CarSetup": """
u8 m_front_wing m_rear_wing m_on_throttle m_off_throttle
f32 m_front_camber m_rear_camber m_front_toe m_rear_toe
u8 m_front_suspension m_rear_suspension m_front_anti_roll_bar m_rear_anti_roll_bar
u8 m_front_suspension_height m_rear_suspension_height
u8 m_brake_pressure m_brake_bias m_engine_braking
f32 m_rear_left_tyre_pressure m_rear_right_tyre_pressure
f32 m_front_left_tyre_pressure m_front_right_tyre_pressure
u8 m_ballast
f32 m_fuel_load
""",
    "CarTelemetry": """
u16 m_speed
f32 m_throttle m_steer m_brake
u8 m_clutch
i8 m_gear
u16 m_engine_rpm
u8 m_drs m_rev_lights_percent
u16 m_rev_lights_bit_value
u16[4] m_brakes_temperature
u8[4] m_tyres_surface_temperature m_tyres_inner_temperature
u16 m_engine_temperature
f32[4] m_tyres_pressure
u8[4] m_surface_type
""",
    "CarStatus": """
u8 m_traction_control m_anti_lock_brakes m_fuel_mix m_front_brake_bias m_pit_limiter_status
f32 m_fuel_in_tank m_fuel_capacity m_fuel_remaining_laps
u16 m_max_rpm m_idle_rpm
u8 m_max_gears m_drs_allowed
u16 m_drs_activation_distance
u8 m_actual_tyre_compound m_visual_tyre_compound m_tyres_age_laps
i8 m_vehicle_fia_flags
f32 m_engine_power_ice m_engine_power_mguk m_ers_store_energy
u8 m_ers_deploy_mode
f32 m_ers_harvested_this_lap_mguk m_ers_harvested_this_lap_mguh m_ers_deployed_this_lap
u8 m_network_paused
""",
    "FinalClassification": """
u8 m_position m_num_laps m_grid_position m_points m_num_pit_stops m_result_status m_result_reason
u32 m_best_lap_time_in_ms
f64 m_total_race_time
u8 m_penalties_time m_num_penalties m_num_tyre_stints
u8[8] m_tyre_stints_actual m_tyre_stints_visual m_tyre_stints_end_laps
""",
    "LobbyInfo": """
u8 m_ai_controlled m_team_id m_nationality m_platform
u8[32] m_name
u8 m_car_number m_your_telemetry m_show_online_names
u16 m_tech_level
u8 m_ready_status
""",
    "CarDamage": """
f32[4] m_tyres_wear
u8[4] m_tyres_damage m_brakes_damage m_tyre_blisters
u8 m_front_left_wing_damage m_front_right_wing_damage m_rear_wing_damage
u8 m_floor_damage m_diffuser_damage m_sidepod_damage m_drs_fault m_ers_fault
u8 m_gear_box_damage m_engine_damage m_engine_mguh_wear m_engine_es_wear
u8 m_engine_ce_wear m_engine_ice_wear m_engine_mguk_wear m_engine_tc_wear
u8 m_engine_blown m_engine_seized
""",
    "LapHistory": """
u32 m_lap_time_in_ms
u16 m_sector1_time_ms_part
u8 m_sector1_time_minutes_part
u16 m_sector2_time_ms_part
u8 m_sector2_time_minutes_part
u16 m_sector3_time_ms_part
u8 m_sector3_time_minutes_part m_lap_valid_bit_flags
""",
    "TyreStintHistory": """
u8 m_end_lap m_tyre_actual_compound m_tyre_visual_compound
""",
    "TyreSet": """
u8 m_actual_tyre_compound m_visual_tyre_compound m_wear m_available
u8 m_recommended_session m_life_span m_usable_life
i16 m_lap_delta_time
u8 m_fitted
""",
    "TimeTrialSet": """
u8 m_car_idx m_team_id
u32 m_lap_time_in_ms m_sector1_time_in_ms m_sector2_time_in_ms m_sector3_time_in_ms
u8 m_traction_control m_gearbox_assist m_anti_lock_brakes
u8 m_equal_car_performance m_custom_setup m_valid
""",
}

# The body that follows the header, per kind.
BODIES = {
    "motion": "CarMotion[22] m_car_motion_data",
    "session": """
u8 m_weather
i8 m_track_temperature m_air_temperature
u8 m_total_laps
u16 m_track_length
u8 m_session_type
i8 m_track_id
u8 m_formula
u16 m_session_time_left m_session_duration
u8 m_pit_speed_limit m_game_paused m_is_spectating m_spectator_car_index
u8 m_sli_pro_native_support m_num_marshal_zones
MarshalZone[21] m_marshal_zones
u8 m_safety_car_status m_network_game m_num_weather_forecast_samples
WeatherForecastSample[64] m_weather_forecast_samples
u8 m_forecast_accuracy m_ai_difficulty
u32 m_season_link_identifier m_weekend_link_identifier m_session_link_identifier
u8 m_pit_stop_window_ideal_lap m_pit_stop_window_latest_lap m_pit_stop_rejoin_position
u8 m_steering_assist m_braking_assist m_gearbox_assist m_pit_assist m_pit_release_assist
u8 m_ers_assist m_drs_assist m_dynamic_racing_line m_dynamic_racing_line_type
u8 m_game_mode m_rule_set
u32 m_time_of_day
u8 m_session_length
u8 m_speed_units_lead_player m_temperature_units_lead_player
u8 m_speed_units_secondary_player m_temperature_units_secondary_player
u8 m_num_safety_car_periods m_num_virtual_safety_car_periods m_num_red_flag_periods
u8 m_equal_car_performance m_recovery_mode m_flashback_limit m_surface_type
u8 m_low_fuel_mode m_race_starts m_tyre_temperature m_pit_lane_tyre_sim
u8 m_car_damage m_car_damage_rate m_collisions m_collisions_off_for_first_lap_only
u8 m_mp_unsafe_pit_release m_mp_off_for_griefing m_corner_cutting_stringency
u8 m_parc_ferme_rules m_pit_stop_experience m_safety_car m_safety_car_experience
u8 m_formation_lap m_formation_lap_experience m_red_flags
u8 m_affects_licence_level_solo m_affects_licence_level_mp m_num_sessions_in_weekend
u8[12] m_weekend_structure
f32 m_sector2_lap_distance_start m_sector3_lap_distance_start
""",
    "lap": """
Lap[22] m_lap_data
u8 m_time_trial_pb_car_idx m_time_trial_rival_car_idx
""",
    "event": """
u8[4] m_event_string_code
u8[16] m_event_details
""",
    "participants": """
u8 m_num_active_cars
Participant[22] m_participants
""",
    "car_setups": """
CarSetup[22] m_car_setup_data
f32 m_next_front_wing_value
""",
    "car_telemetry": """
CarTelemetry[22] m_car_telemetry_data
u8 m_mfd_panel_index m_mfd_panel_index_secondary_player
i8 m_suggested_gear
""",
    "car_status": "CarStatus[22] m_car_status_data",
    "final_classification": """
u8 m_num_cars
FinalClassification[22] m_classification_data
""",
    "lobby_info": """
u8 m_num_players
LobbyInfo[22] m_lobby_players
""",
    "car_damage": "CarDamage[22] m_car_damage_data",
    "session_history": """
u8 m_car_idx m_num_laps m_num_tyre_stints m_best_lap_time_lap_num
u8 m_best_sector1_lap_num m_best_sector2_lap_num m_best_sector3_lap_num
LapHistory[100] m_lap_history_data
TyreStintHistory[8] m_tyre_stints_history_data
""",
    "tyre_sets": """
u8 m_car_idx
TyreSet[20] m_tyre_set_data
u8 m_fitted_idx
""",
    "motion_ex": """
f32[4] m_suspension_position m_suspension_velocity m_suspension_acceleration
f32[4] m_wheel_speed m_wheel_slip_ratio m_wheel_slip_angle m_wheel_lat_force m_wheel_long_force
f32 m_height_of_cog_above_ground m_local_velocity_x m_local_velocity_y m_local_velocity_z
f32 m_angular_velocity_x m_angular_velocity_y m_angular_velocity_z
f32 m_angular_acceleration_x m_angular_acceleration_y m_angular_acceleration_z
f32 m_front_wheels_angle
f32[4] m_wheel_vert_force
f32 m_front_aero_height m_rear_aero_height m_front_roll_angle m_rear_roll_angle
f32 m_chassis_yaw m_chassis_pitch
f32[4] m_wheel_camber m_wheel_camber_gain
""",
    "time_trial": """
TimeTrialSet m_player_session_best_data_set m_personal_best_data_set m_rival_data_set
""",
    "lap_positions": """
u8 m_num_laps m_lap_start
u8[50][22] m_position_for_vehicle_idx
""",
}

# What the 16 detail bytes of an event can hold; the datagram does not say which.
EVENT_DETAILS = {
    "fastest_lap": "u8 vehicle_idx\nf32 lap_time",
    "retirement": "u8 vehicle_idx reason",
    "drs_disabled": "u8 reason",
    "team_mate_in_pits": "u8 vehicle_idx",
    "race_winner": "u8 vehicle_idx",
    "penalty": (
        "u8 penalty_type infringement_type vehicle_idx other_vehicle_idx time lap_num places_gained"
    ),
    "speed_trap": (
        "u8 vehicle_idx\nf32 speed\n"
        "u8 is_overall_fastest_in_session is_driver_fastest_in_session "
        "fastest_vehicle_idx_in_session\n"
        "f32 fastest_speed_in_session"
    ),
    "start_lights": "u8 num_lights",
    "drive_through_penalty_served": "u8 vehicle_idx",
    "stop_go_penalty_served": "u8 vehicle_idx\nf32 stop_time",
    "flashback": "u32 flashback_frame_identifier\nf32 flashback_session_time",
    "buttons": "u32 button_status",
    "overtake": "u8 overtaking_vehicle_idx being_overtaken_vehicle_idx",
    "safety_car": "u8 safety_car_type event_type",
    "collision": "u8 vehicle1_idx vehicle2_idx",
}

# Four-letter code of an event -> what its detail bytes hold; other codes have no details.
EVENT_CODES = {
    "FTLP": "fastest_lap",
    "RTMT": "retirement",
    "DRSD": "drs_disabled",
    "TMPT": "team_mate_in_pits",
    "RCWN": "race_winner",
    "PENA": "penalty",
    "SPTP": "speed_trap",
    "STLG": "start_lights",
    "DTSV": "drive_through_penalty_served",
    "SGSV": "stop_go_penalty_served",
    "FLBK": "flashback",
    "BUTN": "buttons",
    "OVTK": "overtake",
    "SCAR": "safety_car",
    "COLL": "collision",
}

# wire type -> (NumPy little-endian code, Spark type wide enough for it)
WIRE_TYPES = {
    "u8": ("u1", T.IntegerType()),
    "i8": ("i1", T.IntegerType()),
    "u16": ("<u2", T.IntegerType()),
    "i16": ("<i2", T.IntegerType()),
    "u32": ("<u4", T.LongType()),
    "u64": ("<u8", T.LongType()),
    "f32": ("<f4", T.FloatType()),
    "f64": ("<f8", T.DoubleType()),
}

# --- end of fixed values ---------------------------------------------------------

_TYPE = re.compile(r"(\w+)((?:\[\d+\])*)")


def _fields(text: str):
    """(field, wire type or struct name, array shape) in wire order."""
    for line in text.strip().splitlines():
        type_text, *names = line.split()
        name, dims = _TYPE.fullmatch(type_text).groups()
        shape = tuple(int(d) for d in re.findall(r"\d+", dims))
        for field in names:
            yield field, name, shape


def _dtype(text: str) -> np.dtype:
    spec = []
    for field, name, shape in _fields(text):
        base = WIRE_TYPES[name][0] if name in WIRE_TYPES else _dtype(STRUCTS[name])
        spec.append((field, base, shape) if shape else (field, base))
    return np.dtype(spec)


def _spark_type(text: str) -> T.StructType:
    out = T.StructType()
    for field, name, shape in _fields(text):
        kind = WIRE_TYPES[name][1] if name in WIRE_TYPES else _spark_type(STRUCTS[name])
        for _ in shape:
            kind = T.ArrayType(kind)
        out.add(field, kind)
    return out


@cache
def packet_dtype(kind: str) -> np.dtype:
    return np.dtype([("m_header", _dtype(HEADER)), *_described(_dtype(BODIES[kind]))])


def _described(dtype: np.dtype):
    for name in dtype.names:
        sub = dtype[name]
        yield (name, sub.base, sub.shape) if sub.shape else (name, sub)


@cache
def packet_type(kind: str) -> T.StructType:
    return T.StructType(
        [T.StructField("m_header", _spark_type(HEADER)), *_spark_type(BODIES[kind]).fields]
    )


def details_dtype(variant: str) -> np.dtype:
    return _dtype(EVENT_DETAILS[variant])


def details_type(variant: str) -> T.StructType:
    return _spark_type(EVENT_DETAILS[variant])


def packet_size(kind: str) -> int:
    return packet_dtype(kind).itemsize


def packet_id(kind: str) -> int:
    return KINDS.index(kind)


def pick(kind: str, fields: list[str] | None) -> T.StructType:
    """The packet type cut down to some fields, at the top or inside the car structs.

    ``"m_speed"`` keeps that field of every car; ``"m_header"`` keeps the whole header.
    """
    full = packet_type(kind)
    if fields is None:
        return full
    wanted, known = set(fields), set()
    out = T.StructType()
    for field in full.fields:
        inner = field.dataType
        if field.name in wanted:
            known.add(field.name)
            out.add(field)
            continue
        is_array = isinstance(inner, T.ArrayType)
        struct = inner.elementType if is_array else inner
        if not isinstance(struct, T.StructType):
            continue
        kept = [sub for sub in struct.fields if sub.name in wanted]
        if kept:
            known.update(sub.name for sub in kept)
            cut = T.StructType(kept)
            out.add(field.name, T.ArrayType(cut) if is_array else cut)
    if wanted - known:
        raise ValueError(f"{kind} has no field {sorted(wanted - known)}")
    return out
