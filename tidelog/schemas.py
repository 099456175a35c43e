"""Fixed schemas of the change feed, the log and the business tables."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIMESTAMP = T.TimestampType()


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# Where an event comes from.
SOURCE = schema(
    version=STRING, connector=STRING, name=STRING, ts_ms=LONG, snapshot=STRING, db=STRING,
    sequence=STRING, table=STRING, server_id=LONG, gtid=STRING, file=STRING, pos=LONG,
    row=INT, thread=LONG, query=STRING,
)

# Envelope of one change event. The images and the key stay JSON text: only the target
# table's schema can type them.
ENVELOPE = schema(
    topic=STRING, key=STRING, before=STRING, after=STRING, source=SOURCE, op=STRING,
    ts_ms=LONG, transaction=STRING,
)

# One row of the flat change log.
LOG = schema(
    id=STRING, server_id=STRING, file=STRING, pos=LONG, row=INT, before=STRING, after=STRING,
    op=STRING, ts_ms=LONG, primary_key_data=STRING, db=STRING, tb=STRING,
)

# The older log row, still accepted as an input.
LOG_STOCK = schema(
    id=LONG, before=STRING, after=STRING, source=STRING, op=STRING, ts_ms=LONG,
    transaction=STRING, db=STRING, tb=STRING,
)

# Order of events: snapshot rows carry an empty file name and so come first within a
# millisecond. One position holds an event for each row its statement changed.
EVENT_ORDER = ("ts_ms", "file", "pos", "row")

KNOWN_OPS = ("r", "c", "u", "d")


@dataclass(frozen=True)
class TableSpec:
    """What makes a table keyed.

    keys: record key columns, unique over the whole table, partitions included.
    order_by: of two versions of a key the one greater in these columns wins; the commit
        breaks ties.
    partition_by: hive-style directory columns.
    kind: "mor" appends changes and merges on read, "cow" rewrites touched buckets on write.
    buckets: number of key buckets of a "cow" table.
    """

    keys: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    kind: str = "mor"
    buckets: int = 16

    def __post_init__(self):
        if not self.keys:
            raise ValueError("a keyed table needs at least one key column")
        if self.kind not in ("mor", "cow"):
            raise ValueError(f"unknown table kind {self.kind!r}")

    def to_dict(self) -> dict:
        return asdict(self)

    @staticmethod
    def from_dict(d: dict) -> "TableSpec":
        return TableSpec(
            tuple(d["keys"]), tuple(d["order_by"]), tuple(d["partition_by"]),
            d["kind"], d["buckets"],
        )


# Target tables by `ods_<db>_<tb>`: image columns and key.
REGISTRY: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "ods_test_student": (
        schema(id=INT, name=STRING, sex=STRING, birthday=STRING, create_time=TIMESTAMP),
        ("id",),
    ),
    "ods_test_test4": (
        schema(id=INT, data=STRING, data2=STRING, data3=STRING, cnt=DOUBLE),
        ("id",),
    ),
}


def register(db: str, tb: str, columns: T.StructType, keys: tuple[str, ...]) -> None:
    REGISTRY[f"ods_{db}_{tb}"] = (columns, keys)


def lookup(db: str, tb: str) -> tuple[T.StructType, tuple[str, ...]]:
    """Schema and key of the target of one captured table."""
    name = f"ods_{db}_{tb}"
    if name not in REGISTRY:
        raise KeyError(f"no target registered as {name}")
    return REGISTRY[name]
