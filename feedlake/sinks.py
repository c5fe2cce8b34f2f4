"""Where tables go: files, catalogue tables, external stores."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from feedlake.operators.naming import align_by_name, rename_columns


@lru_cache(maxsize=1)
def path_class(jvm):
    """Hadoop's paths; looking the class up takes several calls to the JVM, and loads ask for paths some thousand times."""
    return jvm.org.apache.hadoop.fs.Path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; a store that can't be asked is an error, not an absence."""
    p = path_class(spark._jvm)(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write(df: DataFrame, target: str, mode: str = "append", widen: bool = False) -> None:
    """Parquet at a path; an append is aligned by name to what is there, and rewrites nothing.

    Columns that the target lacks are an error, or with `widen` they are added: files
    written before don't have them, and readers see them by `mergeSchema`.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    if mode == "append" and path_exists(df.sparkSession, target):
        there = df.sparkSession.read.option("mergeSchema", widen).parquet(target).schema
        if widen:
            have = {f.name.lower() for f in there}
            there = StructType(list(there) + [f for f in df.schema if f.name.lower() not in have])
        df = align_by_name(df, there)
    df.write.mode(mode).parquet(target)


def write_table(df: DataFrame, name: str, mode: str = "append") -> None:
    """A catalogue table, replaced or appended to by name; the table is made on first use."""
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name):
        align_by_name(df, spark.table(name).schema).write.mode("append").insertInto(name)
    else:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)


def external_writer(df: DataFrame, fmt: str, options: dict[str, str], mode: str = "append"):
    """A configured writer for any Spark data source (jdbc, a lake format, a warehouse connector); call save() on it."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    return df.write.format(fmt).options(**options).mode(mode)


def stage(df: DataFrame, folder: str, batch: str) -> str:
    """The batch's rows as Parquet below a staging folder, written once: what a run before has finished is taken as it is."""
    path = f"{folder.rstrip('/')}/{batch}"
    if not path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return path


def load_database(spark: SparkSession, staged: str, url: str, table: str, batch: str, mode: str = "append", properties: dict[str, str] | None = None) -> bool:
    """Load staged Parquet into a database table as one transaction; False where the table has the batch already.

    Tasks write the rows to a table of the batch's own, which a repeated run starts anew. Then
    one transaction moves them (by name, case-insensitive; with `truncate` behind a DELETE
    of all rows) and notes the batch in FEEDLAKE_LOADS. The
    target is made on first use; columns that it lacks are an error.
    """
    if mode not in ("append", "truncate"):
        raise ValueError("mode must be 'append' or 'truncate'")
    if not re.match(r"[A-Za-z][A-Za-z0-9_]*\Z", table) or not re.match(r"[A-Za-z0-9_]+\Z", batch):
        raise ValueError("tables and batches are named by letters, digits and _")
    rows, options = rename_columns(spark.read.parquet(staged), "upper"), {"url": url, **(properties or {})}
    loads, own = "FEEDLAKE_LOADS", f"{table}_{batch}".upper()
    known = spark.createDataFrame([], "TABLE_NAME string, BATCH string")
    keys = {"createTableColumnTypes": "TABLE_NAME VARCHAR(128), BATCH VARCHAR(128)"}
    columns = ", ".join(f'"{c}"' for c in rows.columns)
    settings = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        settings.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        tables = connection.getMetaData()
        there = lambda name: tables.getTables(None, None, name, None).next()
        if not there(loads):
            known.write.format("jdbc").options(**options, **keys, dbtable=loads).mode("append").save()
        connection.setAutoCommit(False)
        run = connection.createStatement()
        seen = run.executeQuery(f"SELECT COUNT(*) FROM {loads} WHERE TABLE_NAME = '{table.upper()}' AND BATCH = '{batch}'")
        seen.next()
        done, first = seen.getInt(1) > 0, not there(table.upper())
        connection.commit()
        if not done:
            if first:
                rows.limit(0).write.format("jdbc").options(**options, dbtable=table.upper()).mode("append").save()
            rows.write.format("jdbc").options(**options, dbtable=own).mode("overwrite").save()
            if mode == "truncate":
                run.executeUpdate(f"DELETE FROM {table.upper()}")
            run.executeUpdate(f"INSERT INTO {table.upper()} ({columns}) SELECT {columns} FROM {own}")
            run.executeUpdate(f"INSERT INTO {loads} VALUES ('{table.upper()}', '{batch}')")
            connection.commit()
        if there(own):
            run.executeUpdate(f"DROP TABLE {own}")
            connection.commit()
        return not done
    finally:
        if not connection.getAutoCommit():
            connection.rollback()
        connection.close()


def remote_conf(scheme: str, **secrets: str) -> dict[str, str]:
    """Hadoop settings of a remote store by its scheme, to be passed when a session is made."""
    if scheme == "s3":
        conf = {"fs.s3a.access.key": secrets.get("key"), "fs.s3a.secret.key": secrets.get("secret"), "fs.s3a.endpoint.region": secrets.get("region"), "fs.s3a.connection.timeout": "300000", "fs.s3a.attempts.maximum": "3"}
    elif scheme in ("az", "azure", "abfss"):
        conf = {f"fs.azure.account.key.{secrets['account']}.dfs.core.windows.net": secrets.get("key")}
    elif scheme == "gs":
        conf = {"fs.gs.auth.type": "SERVICE_ACCOUNT_JSON_KEYFILE", "fs.gs.auth.service.account.json.keyfile": secrets.get("keyfile")}
    else:
        raise ValueError(f"no settings for {scheme}")
    return {f"spark.hadoop.{k}": v for k, v in conf.items() if v}
