"""Reading and decoding change feeds. Every function takes batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.images import image_map, typed_fields
from tidelog.operators.changes import latest_per_key
from tidelog.schemas import ENVELOPE, EVENT_ORDER, LOG


def read_feed(
    spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Landed events, one JSON envelope per line, as a `value` column."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelope fields of the JSON text; images keep their text, nulls included.

    `inline` rather than `struct.*`: a filter on a field stays above it, where it would
    otherwise be moved below the parsing and parse the text a second time.
    """
    event = F.from_json(F.col(value).cast("string"), ENVELOPE)
    return df.select(F.inline(F.array(event)))


def topic_route(topic: Column) -> tuple[Column, Column]:
    """Database and table of a `server.db.table` topic."""
    parts = F.split(topic, r"\.")
    return F.get(parts, F.lit(1)).alias("db"), F.get(parts, F.lit(2)).alias("tb")


def event_id(*parts: Column) -> Column:
    """Id computed from what identifies the event, so a redelivered event keeps its id."""
    # A missing part is told from an empty one.
    texts = [F.coalesce(p.cast("string"), F.lit("\x02")) for p in parts]
    return F.sha2(F.concat_ws("\x01", *texts), 256)


def _key_text(keys: Sequence[str]) -> Column:
    """Key JSON cut out of the image, for feeds whose events carry no key part."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    picked = F.map_filter(image_map(image), lambda k, _: k.isin(*keys))
    return F.to_json(picked)


def decode(df: DataFrame, keys: Sequence[str] = ("id",), value: str = "value") -> DataFrame:
    """Events as flat log rows. A missing image becomes the empty object."""
    e = envelope(df, value)
    topic_db, topic_tb = topic_route(F.col("topic"))
    flat = e.select(
        F.coalesce("source.db", topic_db).alias("db"),
        F.coalesce("source.table", topic_tb).alias("tb"),
        F.col("source.server_id").cast("string").alias("server_id"),
        F.col("source.file").alias("file"),
        F.col("source.pos").alias("pos"),
        F.col("source.row").alias("row"),
        F.coalesce("before", F.lit("{}")).alias("before"),
        F.coalesce("after", F.lit("{}")).alias("after"),
        "op",
        "ts_ms",
        F.coalesce(F.col("key"), _key_text(keys)).alias("primary_key_data"),
    )
    # The images are part of it: snapshot rows without a key share all the rest.
    names = ("db", "tb", "file", "pos", "row", "primary_key_data", "op", "ts_ms", "before", "after")
    return flat.withColumn("id", event_id(*[F.col(n) for n in names])).select(*LOG.names)


def decode_with(
    df: DataFrame, decoder: Callable[[DataFrame], DataFrame], schema: T.StructType
) -> DataFrame:
    """Run a caller's decoder and hold it to the result type it declares."""
    out = decoder(df)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def parse_stock(df: DataFrame, value: str = "value") -> DataFrame:
    """Older nine-column log rows: `source` and `transaction` stay JSON, missing images "null"."""
    text = F.col(value).cast("string")
    e = F.from_json(text, ENVELOPE)
    return df.select(
        e.getField("ts_ms").alias("id"),
        F.coalesce(e.getField("before"), F.lit("null")).alias("before"),
        F.coalesce(e.getField("after"), F.lit("null")).alias("after"),
        F.get_json_object(text, "$.source").alias("source"),
        e.getField("op").alias("op"),
        e.getField("ts_ms").alias("ts_ms"),
        F.coalesce(e.getField("transaction"), F.lit("null")).alias("transaction"),
        e.getField("source").getField("db").alias("db"),
        e.getField("source").getField("table").alias("tb"),
    )


def json_to_record(df: DataFrame, schema: T.StructType = LOG, value: str = "value") -> DataFrame:
    """JSON lines as typed rows of the given schema."""
    return df.select(F.from_json(F.col(value), schema).alias("r")).select("r.*")


def select_table(log: DataFrame, db: str, tb: str) -> DataFrame:
    """One table's events. `db` and `tb` are directories of the log, so others are not read."""
    return log.where((F.col("db") == db) & (F.col("tb") == tb))


def table_filter(log: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Events of tables whose whole `db.table` name matches one of the patterns."""
    either = "|".join(f"(?:{p})" for p in patterns)
    return log.where(F.concat_ws(".", "db", "tb").rlike(f"^(?:{either})$"))


def end_position(log: DataFrame) -> Row | None:
    """Greatest event position present now: one row, combined before the shuffle."""
    return log.agg(F.max(F.struct(*EVENT_ORDER)).alias("p")).first()["p"]


def start_from(
    log: DataFrame,
    mode: str = "initial",
    file: str | None = None,
    pos: int | None = None,
    ts_ms: int | None = None,
    after: Row | None = None,
) -> DataFrame:
    """Events from a start position on.

    initial: snapshot and changes. earliest: changes only. offset: changes from (file, pos).
    timestamp: events at or after ts_ms. latest: events after position `after`, which is
    `end_position` of what was there at the start.
    """
    if mode == "initial":
        return log
    if mode == "earliest":
        return log.where("op <> 'r'")
    if mode == "offset":
        f, p = F.col("file"), F.col("pos")
        return log.where((f > file) | ((f == file) & (p >= pos)))
    if mode == "timestamp":
        return log.where(F.col("ts_ms") >= ts_ms)
    if mode == "latest":
        if after is None:
            return log
        return log.where(
            F.struct(*EVENT_ORDER)
            > F.struct(*[F.lit(after[c]).cast(LOG[c].dataType).alias(c) for c in EVENT_ORDER])
        )
    raise ValueError(f"unknown start mode {mode!r}")


def typed_changes(log: DataFrame, schema: T.StructType, *more: Column) -> DataFrame:
    """Log rows of one table as typed rows with `op` and the event order.

    A delete has no after-image, so its columns come from the before-image, filled up with the
    key, which is all a delete needs to carry. `more` are further columns of the log to keep.
    """
    gone = F.col("op") == "d"
    no_before = F.col("before").isin("{}", "null")
    image = F.when(gone & no_before, F.col("primary_key_data")).when(gone, F.col("before"))
    return (
        log.withColumn("__fields", image_map(image.otherwise(F.col("after"))))
        .select(*typed_fields(F.col("__fields"), schema), "op", *EVENT_ORDER, *more)
    )


def changelog_table(log: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """A captured table as its current rows."""
    changes = typed_changes(log, schema)
    return latest_per_key(changes, keys, EVENT_ORDER).where("op <> 'd'").select(*schema.names)
