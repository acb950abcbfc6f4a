"""Datagram routing and decoding.

Routing and the length guard are native expressions, so bad rows are gone before
any byte reaches Python.  Decoding is one ``mapInArrow`` over all wanted kinds: it
views each Arrow batch as a NumPy structured array and builds the nested columns
without touching single rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from paddockflow.sources import layouts

_ID_BYTE = 7  # 1-based position of the packet id


def packet_id(payload: Column) -> Column:
    """Packet id byte; a datagram that ends before it counts as zero-filled."""
    byte = F.conv(F.hex(F.substring(payload, _ID_BYTE, 1)), 16, 10).cast("int")
    return F.when(F.length(payload) >= _ID_BYTE, byte).otherwise(F.lit(0))


def _by_id(values: Sequence, ids: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), ids)


def kind_of(ids: Column) -> Column:
    """Packet kind for an id, NULL for ids that name none."""
    return _by_id(layouts.KINDS, ids)


def route(datagrams: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``packet_id``, ``packet_kind`` and ``datagram_status``.

    Status is ``ok``, ``short`` (fewer bytes than the kind needs) or ``unknown``.
    Bytes beyond the kind's size are ignored.
    """
    sizes = _by_id([layouts.packet_size(kind) for kind in layouts.KINDS], F.col("packet_id"))
    status = (
        F.when(F.col("packet_kind").isNull(), "unknown")
        .when(F.length(payload) >= sizes, "ok")
        .otherwise("short")
    )
    return (
        datagrams.withColumn("packet_id", packet_id(F.col(payload)))
        .withColumn("packet_kind", kind_of(F.col("packet_id")))
        .withColumn("datagram_status", status)
    )


def rejects(datagrams: DataFrame, payload: str = "payload") -> DataFrame:
    """Datagrams that cannot be decoded, with the reason."""
    return route(datagrams, payload).where(F.col("datagram_status") != "ok")


def decode(
    datagrams: DataFrame,
    kinds: Sequence[str] = layouts.KINDS,
    payload: str = "payload",
    keep: Sequence[str] = (),
    fields: dict[str, list[str]] | None = None,
    nan_as_null: bool = False,
) -> DataFrame:
    """Decode the wanted kinds in one pass over the datagrams.

    The result has the ``keep`` columns, ``packet_id``, ``packet_kind`` and one
    struct column per kind, NULL but for the row's own kind.  ``fields`` names the
    fields to build per kind, where a narrow result is enough.  Session ids come out
    wrapped to signed BIGINT; with ``nan_as_null`` floats that JSON cannot carry
    become NULL.
    """
    fields = fields or {}
    carried = [*keep, "packet_id", "packet_kind"]
    sizes = _by_id([layouts.packet_size(kind) for kind in layouts.KINDS], F.col("packet_id"))
    exact = (
        route(datagrams, payload)
        .where((F.col("datagram_status") == "ok") & F.col("packet_kind").isin(*kinds))
        .select(*carried, F.substring(F.col(payload), F.lit(1), sizes).alias("_bytes"))
    )
    types = {kind: layouts.pick(kind, fields.get(kind)) for kind in kinds}
    schema = T.StructType(
        [exact.schema[name] for name in carried]
        + [T.StructField(kind, types[kind]) for kind in kinds]
    )
    arrow = to_arrow_schema(schema)
    dtypes = {kind: layouts.packet_dtype(kind) for kind in kinds}
    return exact.mapInArrow(
        _decoder(carried, dtypes, {kind: arrow.field(kind).type for kind in kinds}, nan_as_null),
        schema,
    )


def decode_kind(datagrams: DataFrame, kind: str, fields: list[str] | None = None, **options) -> DataFrame:
    """One kind, with the packet's fields as top-level columns."""
    decoded = decode(datagrams, [kind], fields={kind: fields} if fields else None, **options)
    return decoded.select(*[c for c in decoded.columns if c != kind], f"{kind}.*")


def _decoder(carried, dtypes, arrow_types, nan_as_null):
    """Batch function for ``mapInArrow``; it carries all it needs in its closure."""

    def nested(values, arrow_type, depth):
        """Arrow array from a NumPy view, whose first ``depth`` axes are the rows so far."""
        import numpy as np
        import pyarrow as pa

        if pa.types.is_struct(arrow_type):
            children = [nested(values[field.name], field.type, depth) for field in arrow_type]
            return pa.StructArray.from_arrays(children, fields=list(arrow_type))
        if pa.types.is_list(arrow_type):
            width = values.shape[depth]
            count = int(np.prod(values.shape[:depth], dtype=np.int64))
            offsets = pa.array(np.arange(count + 1, dtype=np.int32) * width)
            items = nested(values, arrow_type.value_type, depth + 1)
            return pa.ListArray.from_arrays(offsets, items, type=arrow_type)
        flat = np.ascontiguousarray(values).reshape(-1).astype(arrow_type.to_pandas_dtype())
        missing = ~np.isfinite(flat) if nan_as_null and flat.dtype.kind == "f" else None
        return pa.array(flat, type=arrow_type, mask=missing)

    def packets(raw, dtype):
        import numpy as np

        import pyarrow as pa

        wide = pa.types.is_large_binary(raw.type)
        start = np.frombuffer(raw.buffers()[1], np.int64 if wide else np.int32)[raw.offset]
        return np.frombuffer(raw.buffers()[2], dtype, count=len(raw), offset=int(start))

    def decode_batches(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        names = [*carried, *dtypes]
        for batch in batches:
            for kind, dtype in dtypes.items():
                rows = batch
                if len(dtypes) > 1:
                    rows = batch.filter(pc.equal(batch.column("packet_kind"), kind))
                if rows.num_rows == 0:
                    continue
                body = nested(packets(rows.column("_bytes"), dtype), arrow_types[kind], 1)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(name) for name in carried]
                    + [
                        body if other == kind else pa.nulls(rows.num_rows, arrow_types[other])
                        for other in dtypes
                    ],
                    names=names,
                )

    return decode_batches


def event_details(events: DataFrame, variant: str) -> DataFrame:
    """Read the detail bytes of decoded ``event`` packets as one variant.

    The datagram does not tag its variant, so the caller picks the rows by their
    ``event_code``.  Integers only need bit arithmetic, so this stays native; the
    floats of a variant are rebuilt from their sign, exponent and fraction.
    """
    dtype = layouts.details_dtype(variant)
    raw = F.col("m_event_details")
    out = []
    for field in layouts.details_type(variant).fields:
        start, width = dtype.fields[field.name][1], dtype[field.name].itemsize
        number = sum(
            (F.get(raw, F.lit(start + i)).cast("bigint") * (1 << (8 * i)) for i in range(1, width)),
            F.get(raw, F.lit(start)).cast("bigint"),
        )
        value = _float_from_bits(number) if dtype[field.name].kind == "f" else number
        out.append(value.cast(field.dataType).alias(field.name))
    return events.withColumn(variant, F.struct(*out))


def event_union(datagrams: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Event datagrams with their details as the variant that the four-letter code names.

    The result has the ``keep`` columns, ``m_header``, ``event_code``, ``variant``, ``details``
    (a struct with one struct per variant, NULL but for the row's own) and ``raw_details``: the
    16 bytes of a code that names no variant, NULL otherwise.  Codes are read as Latin-1.  All
    variants are read in one pass; other datagrams are left out.
    """
    codes = layouts.EVENT_CODES
    exact = (
        route(datagrams, payload)
        .where((F.col("datagram_status") == "ok") & (F.col("packet_kind") == "event"))
        .select(*keep, F.substring(F.col(payload), F.lit(1), F.lit(layouts.packet_size("event"))).alias("_bytes"))
    )
    header = layouts.packet_type("event")["m_header"]
    details = T.StructType([T.StructField(v, layouts.details_type(v)) for v in codes.values()])
    schema = T.StructType([
        *[exact.schema[name] for name in keep], header, T.StructField("event_code", T.StringType()),
        T.StructField("variant", T.StringType()), T.StructField("details", details),
        T.StructField("raw_details", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)
    dtypes = {variant: layouts.details_dtype(variant) for variant in codes.values()}
    return exact.mapInArrow(_union_decoder(list(keep), layouts.packet_dtype("event"), dtypes, codes, arrow), schema)


def _union_decoder(carried, packet, dtypes, codes, arrow):
    """Batch function for :func:`event_union`; each variant is a view on the same detail bytes."""

    def fields(values, arrow_type, missing):
        import pyarrow as pa

        children = [
            pa.array(values[f.name].astype(f.type.to_pandas_dtype()), f.type, mask=missing) for f in arrow_type
        ]
        mask = None if missing is None else pa.array(missing)
        return pa.StructArray.from_arrays(children, fields=list(arrow_type), mask=mask)

    def decode_batches(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            raw = batch.column("_bytes")
            events = np.frombuffer(b"".join(raw.to_pylist()), packet)
            bytes_of = np.ascontiguousarray(events["m_event_details"])
            width = bytes_of.shape[1]
            code, number = np.unique(np.ascontiguousarray(events["m_event_string_code"]), axis=0, return_inverse=True)
            text = [bytes(c).decode("latin-1") for c in code]
            named = np.array([codes.get(t, "") for t in text], dtype=object)[number.ravel()] if len(text) else np.zeros(0, object)
            variants = []
            for variant, dtype in dtypes.items():
                offsets = [dtype.fields[n][1] for n in dtype.names]
                padded = np.dtype({
                    "names": list(dtype.names), "formats": [dtype[n] for n in dtype.names], "offsets": offsets,
                    "itemsize": width,
                })
                kind = arrow.field("details").type.field(variant).type
                variants.append(fields(bytes_of.reshape(-1).view(padded), kind, named != variant))
            unknown = named == ""
            details = pa.StructArray.from_arrays(
                variants, fields=list(arrow.field("details").type), mask=pa.array(unknown)
            )
            columns = {name: batch.column(name) for name in carried}
            columns |= {
                "m_header": fields(events["m_header"], arrow.field("m_header").type, None),
                "event_code": pa.array([text[i] for i in number.ravel()], pa.string()),
                "variant": pa.array(named, pa.string(), mask=unknown),
                "details": details,
                "raw_details": pa.array([bytes(b) if u else None for b, u in zip(bytes_of, unknown)], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([columns[n] for n in arrow.names], names=arrow.names)

    return decode_batches


def _float_from_bits(bits: Column) -> Column:
    """IEEE-754 single precision from its 32 bits; exact, since DOUBLE holds it."""
    sign = F.when(F.shiftright(bits, 31) == 1, -1.0).otherwise(1.0)
    exponent = F.shiftright(bits, 23).bitwiseAND(F.lit(0xFF))
    fraction = bits.bitwiseAND(F.lit(0x7FFFFF)) / F.lit(float(1 << 23))
    return (
        F.when((exponent == 255) & (fraction != 0), F.lit(float("nan")))
        .when(exponent == 255, sign * F.lit(float("inf")))
        .when(exponent == 0, sign * fraction * F.pow(F.lit(2.0), F.lit(-126)))
        .otherwise(sign * (1 + fraction) * F.pow(F.lit(2.0), exponent - 127))
    )


def event_code(events: DataFrame) -> DataFrame:
    """Add the four-letter ``event_code`` and the raw ``event_details`` bytes."""
    codes = F.transform(F.col("m_event_string_code"), lambda c: F.chr(c))
    pairs = F.transform(F.col("m_event_details"), lambda c: F.lpad(F.hex(c), 2, "0"))
    return events.withColumn("event_code", F.array_join(codes, "")).withColumn(
        "event_details", F.unhex(F.array_join(pairs, ""))
    )
