"""Framed Avro records: decoding, contract, dead letters.

A payload is a zero byte, a schema id of four bytes (big-endian) and one Avro record. What fails goes to the dead letters with its
bytes, a code of the error and an id that depends on topic, partition and offset only, so that replays are idempotent.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The record's fields in order, and the codes of errors.
FIELDS = (
    ("event_id", "string"), ("user_id", "string"), ("content_id", "string"), ("session_id", "string"), ("event_type", "string"),
    ("position_seconds", "int"), ("watch_seconds", "int"), ("event_timestamp", "long"), ("produced_timestamp", "long"), ("payload_schema_version", "int"),
)
FRAME, SCHEMA_ID, DECODE, TRAILING, CONTRACT = "invalid_confluent_wire_format", "unexpected_schema_id", "avro_decode_failed", "trailing_payload_bytes", "contract_validation_failed"
UNEXPECTED = "unexpected_validation_error"
TYPES = ("playback_started", "playback_progressed", "playback_completed")
LIMITS = {"int": (-(1 << 31), (1 << 31) - 1), "long": (-(1 << 63), (1 << 63) - 1)}
MESSAGE_LENGTH = 1000


class Bad(ValueError):
    def __init__(self, code: str, message: str):
        super().__init__(message[:MESSAGE_LENGTH])
        self.code = code


def _number(data: bytes, at: int) -> tuple[int, int]:
    """Zigzag variable-length integer and the place after it."""
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("integer is cut off or too long")
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at


def body(data: bytes) -> dict:
    """The values of one Avro record; raises Bad."""
    values, at = {}, 0
    try:
        for name, kind in FIELDS:
            number, at = _number(data, at)
            if kind == "string":
                if number < 0 or at + number > len(data):
                    raise ValueError(f"{name} is cut off")
                values[name], at = data[at : at + number].decode(), at + number
            else:
                low, high = LIMITS[kind]
                if not low <= number <= high:
                    raise ValueError(f"{name} is out of range")
                values[name] = number
    except ValueError as e:
        raise Bad(DECODE, str(e)) from e
    if at != len(data):
        raise Bad(TRAILING, f"{len(data) - at} bytes after the record")
    return values


def encode(values: dict, schema_id: int) -> bytes:
    def number(n: int) -> bytes:
        n, out = (n << 1) ^ (n >> 63), bytearray()
        n &= (1 << 64) - 1
        while n > 0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        return bytes(out) + bytes([n])

    body = b"".join(number(len(v := str(values[n]).encode())) + v if kind == "string" else number(int(values[n])) for n, kind in FIELDS)
    return b"\0" + struct.pack(">I", schema_id) + body


def _packed(values: np.ndarray) -> list[bytes]:
    """Zigzag variable-length integers, the reverse of ``_numbers``."""
    values = values.astype(np.int64)
    groups = ((values << 1) ^ (values >> 63)).view(np.uint64)[:, None] >> np.arange(0, 70, 7, dtype=np.uint64)
    size = np.maximum((groups != 0).sum(axis=1), 1)
    place = np.arange(1, 11)
    byte = (groups & np.uint64(0x7F)).astype(np.uint8) | ((place < size[:, None]).astype(np.uint8) << np.uint8(7))
    raw, ends = byte[place <= size[:, None]].tobytes(), np.cumsum(size).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def encode_bodies(rows: pd.DataFrame) -> list[bytes]:
    """What ``encode`` gives after the frame for each row, field by field over the whole batch."""
    pieces = []
    for name, kind in FIELDS:
        if kind == "string":
            texts = [str(v).encode() for v in rows[name].tolist()]
            pieces += [_packed(np.array([len(v) for v in texts], np.int64)), texts]
        else:
            pieces.append(_packed(rows[name].to_numpy() if rows[name].dtype.kind == "i" else np.array([int(v) for v in rows[name].tolist()], np.int64)))
    return [b"".join(row) for row in zip(*pieces, strict=True)]


def fault() -> Column:
    """What is wrong with a decoded record by the contract; null if nothing is."""
    out = F.lit(None).cast("string")
    checks = [(F.length(c) == 0, f"{c} is empty") for c, kind in FIELDS if kind == "string"]
    checks += [(~F.col("event_type").isin(*TYPES), "event_type is unknown"), (F.col("payload_schema_version") != 1, "payload_schema_version is not 1")]
    checks += [(F.col(c) < 0, f"{c} is negative") for c in ("position_seconds", "watch_seconds", "event_timestamp", "produced_timestamp")]
    for bad, message in reversed(checks):
        out = F.when(bad, F.lit(message)).otherwise(out)
    return out


def framed(value: Column, schema_id: int) -> Column:
    """Code of what is wrong with a payload's frame; null if nothing is. Column expressions only."""
    bare = value.isNull() | (F.octet_length(value) < 5) | (F.hex(F.substring(value, 1, 1)) != "00")
    return F.when(bare, F.lit(FRAME)).when(F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long") != schema_id, F.lit(SCHEMA_ID))


def _numbers(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zigzag variable-length integers at the places of one record each: value, place after it, and whether it is there whole."""
    value, more, place, whole = np.zeros(len(at), np.uint64), np.ones(len(at), bool), at.copy(), np.ones(len(at), bool)
    for shift in range(0, 70, 7):
        if not more.any():
            break
        there = more & (place < end)
        whole &= ~more | there
        byte = np.where(there, data[np.where(there, place, 0)], 0)
        if shift == 63:
            # The tenth byte holds the last bit: more of it would be no long.
            whole &= ~there | (byte < 2)
        value |= np.where(there, (byte & 0x7F).astype(np.uint64) << np.uint64(shift), np.uint64(0))
        place += there
        more = there & (byte >= 0x80)
    whole &= ~more
    return (value >> np.uint64(1)).astype(np.int64) ^ -((value & np.uint64(1)).astype(np.int64)), place, whole


def bodies(payloads: list[bytes | None]) -> dict[str, list]:
    """Values, code and message of each record; null bytes have neither.

    Field by field over the whole batch; a record that is not right throughout is read once more by ``body``, which says why.
    """
    n = len(payloads)
    parts = [p or b"" for p in payloads]
    data = np.frombuffer(b"".join(parts) or b"\0", np.uint8)
    end = np.cumsum([len(p) for p in parts], dtype=np.int64) if n else np.zeros(0, np.int64)
    at = end - np.array([len(p) for p in parts], np.int64)
    good, found = np.array([p is not None for p in payloads], bool), {}
    for name, kind in FIELDS:
        value, at, whole = _numbers(data, at, end)
        good &= whole
        if kind == "string":
            good &= (value >= 0) & (value <= end - at)
            size = np.where(good, value, 0)
            found[name] = (at, at + size)
            at = at + size
        else:
            good &= (value >= LIMITS[kind][0]) & (value <= LIMITS[kind][1])
            found[name] = value
    good &= at == end
    raw, out = data.tobytes(), {}
    for name, kind in FIELDS:
        if kind == "string":
            starts, ends = (x.tolist() for x in found[name])
            column: list = []
            for k, (a, b, ok) in enumerate(zip(starts, ends, good.tolist(), strict=True)):
                try:
                    column.append(raw[a:b].decode() if ok else None)
                except UnicodeDecodeError:
                    column.append(None)
                    good[k] = False
            out[name] = column
        else:
            out[name] = found[name].tolist()
    out |= {"code": [None] * n, "message": [None] * n}
    for k in np.flatnonzero(~good).tolist():
        values, code, message = {}, None, None
        if payloads[k] is not None:
            try:
                values = body(bytes(payloads[k]))
            except Bad as e:
                code, message = e.code, str(e)
            except Exception as e:  # noqa: BLE001 - one record must never end the stream
                values, code, message = {}, UNEXPECTED, repr(e)[:MESSAGE_LENGTH]
        for name, _ in FIELDS:
            out[name][k] = values.get(name)
        out["code"][k], out["message"][k] = code, message
    return out


def _bodies(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in parts:
        out: dict = bodies(part.tolist())
        for n, kind in FIELDS:
            if kind != "string":
                out[n] = pd.array(out[n], dtype="Int32" if kind == "int" else "Int64")
        yield pd.DataFrame(out)


def fields_of(path: str | Path) -> tuple[tuple[str, str], ...]:
    """(name, kind) of the fields of a schema file's flat record, in order; logical types count as what carries them."""
    schema = json.loads(Path(path).read_text(encoding="utf-8"))
    if schema.get("type") != "record":
        raise ValueError("the schema is no record")
    out = []
    for f in schema["fields"]:
        kind = f["type"]["type"] if isinstance(f["type"], dict) else f["type"]
        if kind not in ("string", "int", "long"):
            raise ValueError(f"field {f['name']}: {kind} is not supported")
        out.append((f["name"], kind))
    return tuple(out)


def decoded(records: DataFrame, schema_id: int) -> DataFrame:
    """records (key, value, topic, partition, offset, timestamp) with the fields, error_type and error_message.

    Frames are checked by expressions; only the bytes of well-framed records go to the decoder, in Arrow batches.
    """
    fields = ", ".join(f"{n} {kind if kind != 'long' else 'bigint'}" for n, kind in FIELDS)
    # Not deterministic for the optimizer: it would push filters on the fields through, with a second decoder and all that its input takes in Python.
    decode_bodies = F.pandas_udf(_bodies, f"{fields}, code string, message string").asNondeterministic()
    df = records.withColumn("_frame", framed(F.col("value"), schema_id))
    df = df.withColumn("_body", decode_bodies(F.when(F.col("_frame").isNull(), F.expr("substring(value, 6, octet_length(value))"))))
    df = df.select(*records.columns, *[F.col(f"_body.{n}").alias(n) for n, _ in FIELDS], F.coalesce("_frame", F.col("_body.code")).alias("error_type"), F.when(F.col("_frame") == FRAME, "no magic byte and schema id").when(F.col("_frame") == SCHEMA_ID, f"schema id is not {schema_id}").otherwise(F.col("_body.message")).alias("error_message"))
    wrong = F.col("error_type").isNull() & fault().isNotNull()
    return df.withColumns({"error_message": F.when(wrong, fault()).otherwise(F.col("error_message")), "error_type": F.when(wrong, F.lit(CONTRACT)).otherwise(F.col("error_type"))})


def valid(df: DataFrame) -> DataFrame:
    """Accepted events; timestamps from epoch milliseconds, with the record's own time as source_timestamp."""
    fields = [F.timestamp_millis(n).alias(n) if n.endswith("timestamp") else F.col(n) for n, _ in FIELDS]
    return df.where("error_type is null").select(*fields, F.col("timestamp").alias("source_timestamp"))


def dlq_id(topic: Column, partition: Column, offset: Column) -> Column:
    return F.sha2(F.concat_ws(":", topic.cast("string"), partition.cast("string"), offset.cast("string")), 256)


def dead_letters(df: DataFrame) -> DataFrame:
    return df.where("error_type is not null").select(
        dlq_id(F.col("topic"), F.col("partition"), F.col("offset")).alias("dlq_id"), F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"),
        F.col("timestamp").alias("source_timestamp"), F.col("key").alias("original_key"), F.col("value").alias("original_payload"), "error_type", F.substring("error_message", 1, MESSAGE_LENGTH).alias("error_message"),
        F.current_timestamp().alias("detected_timestamp"), F.lit(0).alias("replay_count"))
