"""JDBC tables as source and as upsert sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidelog.operators.changes import latest_per_key
from tidelog.session import is_local
from tidelog.streaming.apply import Batch

URL_CONF = "spark.tidelog.jdbc.url"
DRIVER_CONF = "spark.tidelog.jdbc.driver"
LOCAL_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def connection(spark: SparkSession, name: str) -> dict[str, str]:
    """Connection options named by the session.

    Only a local session may go without them: it gets an in-memory database, which just its
    own process can see and which therefore is of no use to the executors of a cluster, those
    of `local-cluster` included.
    """
    url = spark.conf.get(URL_CONF, None)
    if url:
        driver = spark.conf.get(DRIVER_CONF, None)
        return {"url": url, **({"driver": driver} if driver else {})}
    if not is_local(spark) or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError(f"set {URL_CONF} to a database all executors can reach")
    return {"url": f"jdbc:derby:memory:{name};create=true", "driver": LOCAL_DRIVER}


def read_table(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Table scan. With a partition column the ranges are read by as many tasks; the bounds
    only shape the ranges, rows outside them are read too."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
            numPartitions=partitions,
        )
    return reader.load()


def write_table(
    df: DataFrame, options: dict[str, str], table: str, connections: int = 8,
    types: str | None = None,
) -> None:
    """Replace a table, with a bounded number of connections."""
    writer = df.write.format("jdbc").options(**options).option("dbtable", table)
    writer = writer.option("numPartitions", connections)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.mode("overwrite").save()


def merge_text(
    target: str, staging: str, columns: Sequence[str], keys: Sequence[str], dialect: str
) -> str:
    """One statement that moves a staging table into the target by key."""
    q = "`" if dialect == "mysql" else '"'
    names = [f"{q}{c}{q}" for c in columns]
    rest = [f"{q}{c}{q}" for c in columns if c not in keys]
    if dialect == "mysql":
        listed = ", ".join(names)
        text = f"insert into {target} ({listed}) select {listed} from {staging} s"
        sets = ", ".join(f"{c} = s.{c}" for c in rest or names[:1])
        return f"{text} on duplicate key update {sets}"
    on = " and ".join(f"t.{q}{k}{q} = s.{q}{k}{q}" for k in keys)
    text = f"merge into {target} t using {staging} s on {on}"
    if rest:
        text += " when matched then update set " + ", ".join(f"{c} = s.{c}" for c in rest)
    values = ", ".join(f"s.{c}" for c in names)
    return f"{text} when not matched then insert ({', '.join(names)}) values ({values})"


def delete_text(target: str, staging: str, keys: Sequence[str], dialect: str) -> str:
    q = "`" if dialect == "mysql" else '"'
    match = " and ".join(f"s.{q}{k}{q} = {target}.{q}{k}{q}" for k in keys)
    return f"delete from {target} where exists (select 1 from {staging} s where {match})"


def execute(spark: SparkSession, options: dict[str, str], statements: Sequence[str]) -> None:
    """Run statements in one transaction."""
    jvm = spark._jvm
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    props = jvm.java.util.Properties()
    for k, v in options.items():
        if k not in ("url", "driver"):
            props.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(options["url"], props)
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        for s in statements:
            st.executeUpdate(s)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def upsert_table(
    df: DataFrame,
    options: dict[str, str],
    target: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    dialect: str = "merge",
    types: str | None = None,
) -> None:
    """Upsert rows by primary key: the executors fill a staging table, then the database moves
    it over in one transaction. Running it again changes nothing.

    Rows with op 'd', where there is an `op` column, delete.
    """
    spark = df.sparkSession
    rows = latest_per_key(df, keys, order) if order else df
    columns = [c for c in df.columns if c != "op"]
    staging, gone = f"{target}_staging", f"{target}_gone"
    statements = [merge_text(target, staging, columns, keys, dialect)]
    live = rows
    if "op" in df.columns:
        live = rows.where("op <> 'd'").drop("op")
        write_table(rows.where("op = 'd'").select(*keys), options, gone)
        statements.append(delete_text(target, gone, keys, dialect))
    write_table(live, options, staging, types=types)
    execute(spark, options, statements)


def upsert_batch(
    options: dict[str, str], target: str, keys: Sequence[str], order: Sequence[str] = (),
    dialect: str = "merge", types: str | None = None,
) -> Batch:
    """The same as a streaming sink; a replayed batch upserts the same rows again."""

    def each(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, options, target, keys, order, dialect, types)

    return each
