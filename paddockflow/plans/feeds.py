"""Record feeds and datagrams that Spark derives from the driver tables.

Every row of the source table becomes one record, so the work grows with the table.
``events`` plays the packet stream: its user is the session, its time the event time,
its value and its ``k`` property the measures.  Some event types stand for the bad
input a real feed has: records without trace headers, and text that is no JSON.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddockflow.functions import traces
from paddockflow.sources import layouts

TWO_63 = 2**63

#: Rows of a table that one task turns into records.
TASK_ROWS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of files.

    A file source takes a plain path for a folder, but a glob for either.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}[.]parquet")


def spread(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Use all cores, and tasks of at most about ``TASK_ROWS`` rows however large the table is.

    Records made from a row are a hundred times its size, so moving the narrow rows
    first pays off.  A table of enough splits is left where it is.  The rows are counted
    from the files' footers.
    """
    wanted = max(rows.sparkSession.sparkContext.defaultParallelism, ceil(stored.count() / TASK_ROWS))
    return rows.repartition(wanted) if stored.rdd.getNumPartitions() < wanted else rows


def state_partitions(stored: DataFrame, least: int | None = None) -> int:
    """Parts for the state of a stream over a table: at most about ``TASK_ROWS`` of its rows each.

    ``least`` holds for small tables; without it the session's own number of shuffle partitions does.
    """
    least = least or int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, ceil(stored.count() / TASK_ROWS))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event columns the feeds use, with ``k`` parsed and a time zone on the time."""
    rows = table(spark, sf_dir, "events")
    return event_columns(spread(rows, rows))


def event_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.from_json("props", "k INT")["k"].alias("k"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


# --- pieces of a record ---------------------------------------------------------------


def trace_parent(number: Column) -> Column:
    """Trace parent made from the row's number."""
    text = number.cast("string")
    return traces.make(F.md5(text), F.substring(F.md5(F.concat(F.lit("s"), text)), 1, 16))


def _unsigned_session() -> Column:
    """Sign-ups get session ids above the signed range."""
    wide = F.col("user_id").cast("decimal(20,0)")
    high = wide + F.lit(str(TWO_63)).cast("decimal(20,0)")
    return F.when(F.col("event_type") == "signup", high).otherwise(wide).cast("decimal(20,0)")


def player_index() -> Column:
    """0 to 24, so that some rows point past the 22 cars."""
    return F.floor(F.col("k") / 4).cast("int")


def _header(uid: Column, kind: str, time: Column, frame: Column, player: Column) -> Column:
    return F.struct(
        F.lit(2025).alias("m_packet_format"),
        F.lit(layouts.packet_id(kind)).alias("m_packet_id"),
        uid.alias("m_session_uid"),
        time.alias("m_session_time"),
        frame.alias("m_frame_identifier"),
        player.alias("m_player_car_index"),
    )


def _event_header(kind: str) -> Column:
    return _header(
        _unsigned_session(), kind, F.col("value").cast("float"), F.col("event_id"), player_index()
    )


def _cars(make) -> Column:
    """An array with one struct per car, from the car's number."""
    return F.transform(F.sequence(F.lit(0), F.lit(layouts.CARS - 1)), make)


def _named_cars(codes: Column, make) -> Column:
    """As :func:`_cars`, with name codes that are worked out once per row."""
    return F.transform(F.array_repeat(codes, layouts.CARS), lambda name, n: make(n, name))


def _event_headers() -> Column:
    """None for views, only a foreign header for purchases, else both."""
    foreign = F.struct(F.lit("origin").alias("key"), F.lit("pit").cast("binary").alias("value"))
    own = F.get(traces.to_headers(trace_parent(F.col("event_id"))), F.lit(0))
    return F.when(F.col("event_type") == "purchase", F.array(foreign)).when(
        F.col("event_type") != "view", F.array(foreign, own)
    )


def _event_records(rows: DataFrame, packet: Column) -> DataFrame:
    broken = (F.col("event_type") == "error") & (F.col("k") < 10)
    value = F.when(broken, F.lit("{oops")).otherwise(F.to_json(packet))
    return rows.select(
        F.concat(F.lit("session_"), _unsigned_session().cast("string")).alias("key"),
        value.cast("binary").alias("value"),
        _event_headers().alias("headers"),
        "timestamp",
    )


# --- record feeds -----------------------------------------------------------------------


def telemetry_records(rows: DataFrame) -> DataFrame:
    """Telemetry packets of :func:`event_columns` rows; car n is n faster than car 0."""
    cars = _cars(
        lambda n: F.struct(
            (F.floor("value").cast("int") + n).alias("m_speed"),
            F.lit(0.5).alias("m_throttle"),
            (F.col("k") * 100 + n * 10).alias("m_engine_rpm"),
        )
    )
    packet = F.struct(
        _event_header("car_telemetry").alias("m_header"), cars.alias("m_car_telemetry_data")
    )
    return _event_records(rows, packet)


def lap_records(rows: DataFrame) -> DataFrame:
    """Lap packets of :func:`event_columns` rows."""
    whole = F.floor("value").cast("int")
    k = F.col("k")
    cars = _cars(
        lambda n: F.struct(
            (F.lit(60_000) + F.col("event_id") % 30_000).alias("m_last_lap_time_in_ms"),
            (whole * 100 + n).alias("m_current_lap_time_in_ms"),
            (k * 600).alias("m_sector1_time_ms_part"),
            (whole % 3).alias("m_sector1_time_minutes_part"),
            (k * 500 + n).alias("m_sector2_time_ms_part"),
            (whole % 2).alias("m_sector2_time_minutes_part"),
            (n + 1).alias("m_car_position"),
            F.floor(F.col("value") / 10).cast("int").alias("m_current_lap_num"),
            (k % 4).alias("m_num_pit_stops"),
            (k % 7).alias("m_penalties"),
            (k % 5).alias("m_total_warnings"),
            (k % 3).alias("m_corner_cutting_warnings"),
            (F.lit(22) - n).alias("m_grid_position"),
            (F.lit(300.5) + k).cast("float").alias("m_speed_trap_fastest_speed"),
        )
    )
    packet = F.struct(_event_header("lap").alias("m_header"), cars.alias("m_lap_data"))
    return _event_records(rows, packet)


def _name_codes(name: Column) -> Column:
    """The UTF-8 bytes of a name, padded with NUL to 32 codes."""
    text = F.hex(F.encode(name, "UTF-8"))
    padded = F.rpad(text, 64, "0")
    return F.transform(
        F.sequence(F.lit(0), F.lit(31)),
        lambda i: F.conv(F.substring(padded, i * 2 + 1, F.lit(2)), 16, 10).cast("int"),
    )


def _keyed_rows(rows: DataFrame, number: str, session: str, kind: str, cars_name: str, cars: Column) -> DataFrame:
    """One packet per numbered row; the number gives its time, frame and player."""
    n, uid = F.col(number), F.col(session).cast("decimal(20,0)")
    header = _header(uid, kind, (n / 2).cast("float"), n, (n % 24).cast("int"))
    packet = F.struct(header.alias("m_header"), cars.alias(cars_name))
    return rows.select(
        F.concat(F.lit("session_"), uid.cast("string")).alias("key"),
        F.to_json(packet).cast("binary").alias("value"),
        traces.to_headers(trace_parent(n)).alias("headers"),
        F.timestamp_seconds(n).alias("timestamp"),
    )


def participant_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part")
    return part_records(spread(rows, rows))


def part_records(parts: DataFrame) -> DataFrame:
    """One participants packet per part; the names end in an accented letter."""
    cars = _named_cars(
        _name_codes(F.concat("p_name", F.lit(" é"))),
        lambda n, name: F.struct(
            (n % 2).alias("m_ai_controlled"),
            F.col("p_size").alias("m_driver_id"),
            (F.col("p_size") + n).alias("m_team_id"),
            (n + 1).alias("m_race_number"),
            F.lit(7).alias("m_nationality"),
            name.alias("m_name"),
            F.lit(3).alias("m_platform"),
        ),
    )
    return _keyed_rows(parts, "p_partkey", "p_size", "participants", "m_participants", cars)


def lobby_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return customer_records(spread(rows, rows))


def customer_records(customers: DataFrame) -> DataFrame:
    """One lobby packet per customer."""
    cars = _named_cars(
        _name_codes(F.col("c_name")),
        lambda n, name: F.struct(
            F.lit(0).alias("m_ai_controlled"),
            (F.col("c_nationkey") + n).alias("m_team_id"),
            F.col("c_nationkey").alias("m_nationality"),
            F.lit(1).alias("m_platform"),
            name.alias("m_name"),
            (n + 1).alias("m_car_number"),
            (n % 3).alias("m_ready_status"),
        ),
    )
    return _keyed_rows(customers, "c_custkey", "c_nationkey", "lobby_info", "m_lobby_players", cars)


def aggregate_records(rows: DataFrame, measure: str) -> DataFrame:
    """Aggregate-feed records, one per event, four in five of them spoiled.

    Clicks are sound and carry an unknown field; errors are no JSON, views lack the
    maximum, purchases have a minimum of the wrong type, sign-ups one beyond INT.
    """
    whole = F.floor("value").cast("int")
    low = F.col("k").cast("string")
    kind = F.col("event_type")
    number = (
        F.when(kind == "purchase", F.concat(F.lit('"'), low, F.lit('"')))
        .when(kind == "signup", F.lit("3000000000"))
        .otherwise(low)
    )
    start = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    fields = [
        F.concat(F.lit('{"window_start":"'), start, F.lit('","window_end":"'), start, F.lit('"')),
        F.concat(F.lit(',"session_uid":'), F.col("user_id").cast("string")),
        F.concat(F.lit(',"session_time":'), F.col("k").cast("string"), F.lit(".5")),
        F.concat(F.lit(f',"avg_{measure}":'), whole.cast("string"), F.lit(".25")),
        F.concat(F.lit(f',"min_{measure}":'), number),
        F.when(kind != "view", F.concat(F.lit(f',"max_{measure}":'), whole.cast("string"))).otherwise(F.lit("")),
        F.concat(F.lit(',"sample_count":'), F.col("event_id").cast("string")),
        F.when(kind == "click", F.lit(',"extra":1')).otherwise(F.lit("")),
        F.lit("}"),
    ]
    text = F.when(kind == "error", F.lit("oops")).otherwise(F.concat(*fields))
    return rows.select(
        F.col("user_id").cast("string").alias("key"), text.cast("binary").alias("value"), "event_id"
    )


# --- datagrams --------------------------------------------------------------------------


def datagrams(rows: DataFrame, kind: str) -> DataFrame:
    """One datagram of a kind per event.

    The header carries the event; body value number ``j``, counted over all array
    slots in wire order, is ``(event_id + j) % 100``, and a quarter of it for floats.
    """
    return datagrams_by_kind(rows, F.lit(kind), [kind])


def datagrams_by_kind(rows: DataFrame, kind: Column, kinds: list[str]) -> DataFrame:
    """One datagram per event, of the kind (one of ``kinds``) that an expression names for it."""
    source = rows.select(
        "event_id",
        "timestamp",
        "event_type",
        "k",
        "value",
        F.when(F.col("event_type") == "signup", F.lit(1)).otherwise(F.lit(0)).alias("high"),
        "user_id",
        player_index().alias("player"),
        kind.alias("kind"),
    )
    schema = T.StructType(
        [source.schema[c] for c in ("event_id", "timestamp", "event_type", "k", "value")]
        + [T.StructField("payload", T.BinaryType())]
    )
    packers = {k: _packer(layouts.packet_dtype(k), layouts.packet_id(k)) for k in kinds}

    def run(batches):
        import pyarrow.compute as pc

        for batch in batches:
            for name, pack in packers.items():
                part = batch.filter(pc.equal(batch.column("kind"), name))
                if part.num_rows:
                    yield from pack([part])

    return source.mapInArrow(run, schema)


def _packer(dtype, packet_id):
    def leaves(sub):
        import numpy as np

        if sub.names is None:
            return int(np.prod(sub.shape)) if sub.shape else 1
        return sum(leaves(sub[n].base) * int(np.prod(sub[n].shape)) for n in sub.names)

    def fill(view, kind, first):
        """Write values numbered from ``first``, which has the axes of ``view``."""
        import numpy as np

        if kind.names is None:
            value = first % 100
            view[...] = value / 4 if view.dtype.kind == "f" else value
            return
        at = 0
        for name in kind.names:
            sub = kind[name]
            each = leaves(sub.base)
            slots = np.arange(int(np.prod(sub.shape))).reshape(sub.shape) * each
            start = first.reshape(first.shape + (1,) * slots.ndim) + at + slots
            fill(view[name], sub.base, start)
            at += each * slots.size

    def pack_batches(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            values = {n: batch.column(n) for n in batch.schema.names}
            number = values["event_id"].to_numpy()
            out = np.zeros(len(number), dtype)
            header = out["m_header"]
            header["m_packet_format"] = 2025
            header["m_packet_id"] = packet_id
            header["m_session_uid"] = values["user_id"].to_numpy().astype(np.uint64) + (
                values["high"].to_numpy().astype(np.uint64) << np.uint64(63)
            )
            header["m_session_time"] = values["value"].to_numpy().astype(np.float32)
            header["m_frame_identifier"] = number
            header["m_overall_frame_identifier"] = number + 1
            header["m_player_car_index"] = values["player"].to_numpy()
            body = [n for n in dtype.names if n != "m_header"]
            fill(out[body], dtype[body], number)
            ends = pa.array(np.arange(len(number) + 1, dtype=np.int32) * dtype.itemsize)
            payload = pa.Array.from_buffers(
                pa.binary(), len(number), [None, ends.buffers()[1], pa.py_buffer(out.tobytes())]
            )
            names = ["event_id", "timestamp", "event_type", "k", "value"]
            yield pa.RecordBatch.from_arrays(
                [values[n] for n in names] + [payload], names=[*names, "payload"]
            )

    return pack_batches
