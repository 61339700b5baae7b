"""Tables and files that results go to (K1-K8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callsift import fixed_values as fv
from callsift import schemas
from callsift.operators.calls import ID
from callsift.session import delete_path, stage, unstage

_MERGE_FORMATS = {"delta", "iceberg", "hudi"}


# parts of a table, by the hash of a row's key; a column of its own at the end of the table
BUCKET = "key_bucket"
# buckets of a new table, and the property that tells how many there are
BUCKETS = 64
BUCKETS_PROPERTY = "callsift.buckets"
# rows of a bucket on average, beyond which each bucket is split in two
ROWS_OF_BUCKET = 200_000


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    fmt: str = "parquet",
    location: str | None = None,
    comment: str = "",
) -> None:
    """K1, K2: create the table, with its comments, unless it exists.

    Formats without row-level changes are partitioned by a bucket of the key.
    """
    columns = []
    for f in schema.fields:
        said = _quoted((f.metadata or {}).get("comment", ""))
        columns.append(
            f"`{f.name}` {f.dataType.simpleString()}"
            + ("" if f.nullable else " NOT NULL")
            + (f" COMMENT {said}" if said != "''" else "")
        )
    parts = ""
    if fmt not in _MERGE_FORMATS:
        columns.append(f"`{BUCKET}` int COMMENT 'bucket of the key'")
        parts = f" PARTITIONED BY (`{BUCKET}`) TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{BUCKETS}')"
    place = f" LOCATION '{location}'" if location else ""
    note = f" COMMENT {_quoted(comment)}" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {fmt}{parts}{place}{note}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stored(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table without its bucket."""
    return spark.table(name).drop(BUCKET)


def checked(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows in the table's types; a null or an overlong value that the table
    forbids fails the job."""
    out = []
    for f in schema.fields:
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            value = F.when(value.isNotNull(), value).otherwise(
                F.raise_error(F.lit(f"{f.name} is null")).cast(f.dataType)
            )
        limit = schemas.MAX_LENGTHS.get(f.name)
        if limit:
            value = F.when(
                F.length(value) > limit,
                F.raise_error(F.lit(f"{f.name} is longer than {limit}")).cast(f.dataType),
            ).otherwise(value)
        out.append(value.alias(f.name))
    return df.select(*out)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Two source rows for one key leave the outcome open, so they are an error."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"several source rows for the key {repeated[0].asDict()}")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K3, K4: the target after the upsert; source rows replace those of their key."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def upsert_table(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str]) -> None:
    """K3, K4 on a stored table; an empty source changes nothing.

    Row-level formats take one MERGE.  Others are partitioned by a bucket of
    the key.  Of what is stored, only the keys of the touched buckets are read
    to find those in which a key of the source stands already: these buckets
    are written anew, next to the old files, and the last step of the job puts
    them in their place.  All other rows are added to their buckets.  If a
    load is stopped between the two steps, loading it again completes it.
    Buckets are split as the table grows, and a bucket is written by as many
    tasks as its size asks for.
    """
    columns = [c for c in spark.table(name).columns if c != BUCKET]
    source = stage(source.select(*columns))
    if source.isEmpty():
        unstage(source)
        return
    require_unique(source, keys)
    if _format_of(spark, name) in _MERGE_FORMATS:
        on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
        spark.sql(
            f"MERGE INTO {name} t USING {{source}} s ON {on} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
            source=source,
        )
        unstage(source)
        return
    buckets = _grown(spark, name, source, keys)
    bucketed = stage(source.withColumn(BUCKET, key_bucket(keys, buckets)))
    touched = [r[BUCKET] for r in bucketed.select(BUCKET).distinct().collect()]  # a number for each bucket
    target = spark.table(name).filter(F.col(BUCKET).isin(touched))
    known = target.select(*keys, BUCKET).join(bucketed.select(*keys, BUCKET), [*keys, BUCKET], "left_semi")
    changed = [r[BUCKET] for r in known.select(BUCKET).distinct().collect()]
    if changed:
        anew = F.col(BUCKET).isin(changed)
        _put(merged(target.filter(anew), bucketed.filter(anew), keys).select(*columns, BUCKET), name, overwrite=True)
    if len(changed) < len(touched):
        _put(bucketed.filter(~F.col(BUCKET).isin(changed)).select(*columns, BUCKET), name, overwrite=False)
    for used in (source, bucketed):
        unstage(used)


def _put(rows: DataFrame, name: str, overwrite: bool) -> None:
    """Write rows into their buckets; with ``overwrite`` in place of what these held.

    Rows of a bucket go together, and a large bucket over several tasks
    (adaptive execution cuts it by size).  Rows that take the place of others
    are staged first, as they are made from what they replace; they are put
    there by a session of its own, whose settings nobody else sees.
    """
    dealt = rows.hint("rebalance", F.col(BUCKET))
    if not overwrite:
        dealt.write.insertInto(name)
        return
    held = stage(dealt)
    other = rows.sparkSession.newSession()
    other.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    files = sorted({f.rpartition("/")[0] for f in held.inputFiles()})
    other.read.schema(held.schema).parquet(*files).hint("rebalance", F.col(BUCKET)).write.insertInto(name, overwrite=True)
    rows.sparkSession.catalog.refreshTable(name)
    unstage(held)


def bucket_count(spark: SparkSession, name: str) -> int:
    """Buckets of a table, as its properties tell."""
    told = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return int(told.get(BUCKETS_PROPERTY, BUCKETS))


def _grown(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str]) -> int:
    """The table's number of buckets, after it is doubled as often as the rows to come ask for.

    The rows of bucket b stay there or go to b + n, so a table is split by
    writing each bucket once; that happens once for each doubling of the table.
    """
    now = bucket_count(spark, name)
    wanted, rows = now, spark.table(name).count() + source.count()
    while rows > wanted * ROWS_OF_BUCKET:
        wanted *= 2
    if wanted > now:
        columns = [c for c in spark.table(name).columns if c != BUCKET]
        before = {r[0] for r in spark.table(name).select(BUCKET).distinct().collect()}
        # a split that was stopped may have left a row in both places
        whole = stage(spark.table(name).dropDuplicates(list(keys)).withColumn(BUCKET, key_bucket(keys, wanted)).select(*columns, BUCKET))
        _put(whole, name, overwrite=True)
        # buckets that all rows have left are not written, so they go by name
        place = _described(spark, name, "Location").rstrip("/")
        for left in sorted(before - {r[0] for r in whole.select(BUCKET).distinct().collect()}):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{BUCKET}` = {left})")
            delete_path(spark, f"{place}/{BUCKET}={left}")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{wanted}')")
        spark.catalog.refreshTable(name)
        unstage(whole)
    return wanted


def key_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _described(spark: SparkSession, name: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == what).collect()
    return rows[0]["data_type"] if rows else ""


def _format_of(spark: SparkSession, name: str) -> str:
    return _described(spark, name, "Provider").lower()


def _typed_id(column: Column, kind: str) -> Column:
    if kind == "str":
        text = column.cast("string")
        return F.when(text != "", text)
    number = column.cast("bigint")
    return F.when(number != 0, number)


DETECTION_NAMES = {
    "bus_bacct_num": "ban",
    "bus_bacct_num_src_id": "src_id",
    "telephone": "telephone",
}


def detection_rows(
    detected: DataFrame,
    refresh_date: Column | None = None,
    other_ids: Sequence[Mapping[str, str]] = fv.OTHER_ID_COLUMNS,
) -> DataFrame:
    """K5: rows of the detection table; empty and zero ids become null."""
    today = refresh_date if refresh_date is not None else F.current_date()
    return detected.select(
        F.col("conv_id").alias("convrstn_id"),
        F.col("call_convrstn_date").alias("call_date"),
        today.alias("gcp_refresh_date"),
        *[
            _typed_id(F.col(d["name"]), d["type"]).alias(DETECTION_NAMES.get(d["name"], d["name"]))
            for d in other_ids
        ],
        F.lit(fv.DETECTION_TOPIC).alias("topic"),
        F.bround("detection_score", 3).alias("detection_score"),
    )


def example_rows(matches: DataFrame) -> DataFrame:
    """K6"""
    return matches.select(ID, F.col("chunk_id").cast("bigint").alias("chunk_id"), "text")


def one_per_conversation(rows: DataFrame) -> DataFrame:
    """One detection row for each conversation id.

    An id that several calls share has several rows; the one of the latest
    call stays, among those of one day the one with the least source, account
    number and telephone (a missing one comes last).
    """
    order = [F.desc_nulls_last("call_date"), *map(F.asc_nulls_last, ("src_id", "ban", "telephone"))]
    place = F.row_number().over(Window.partitionBy("convrstn_id").orderBy(*order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def one_per_place(rows: DataFrame) -> DataFrame:
    """One example for each conversation and position, the least text where several stand there."""
    return rows.groupBy(ID, "chunk_id").agg(F.min("text").alias("text"))


def load_detections(spark: SparkSession, name: str, rows: DataFrame, location: str | None = None) -> None:
    """K1 and K3: rows of ``detection_rows`` into the detection table."""
    ensure_table(spark, name, schemas.DETECTIONS, location=location, comment=schemas.TABLE_COMMENTS["DETECTIONS"])
    upsert_table(spark, name, checked(rows, schemas.DETECTIONS), ["convrstn_id"])


def load_examples(spark: SparkSession, name: str, examples: DataFrame, location: str | None = None) -> None:
    """K2, K4 and K6 in turn."""
    ensure_table(spark, name, schemas.EXAMPLES, location=location, comment=schemas.TABLE_COMMENTS["EXAMPLES"])
    rows = checked(example_rows(examples), schemas.EXAMPLES)
    upsert_table(spark, name, rows, [ID, "chunk_id"])


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """K7: delimited files, as many as the job has tasks."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option(
        "quote", '"'
    ).option("escape", '"').csv(path)


def export_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def save_model(model, path: str) -> None:
    """K8: a fitted Spark ML model."""
    model.write().overwrite().save(path)


def load_model(model_class, path: str):
    return model_class.load(path)


def save_data(train: DataFrame, test: DataFrame, path: str) -> None:
    """K8: the rows that a model was fitted and tested on, by part."""
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    both.write.mode("overwrite").partitionBy("part").parquet(path)


def save_log(log: DataFrame, path: str) -> None:
    """K8: the accuracies of a grid search, one row for each fit."""
    log.coalesce(1).write.mode("overwrite").json(path)
