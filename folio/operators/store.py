"""Record store: first-writer-wins dedup, insert-if-absent, upsert, scans.

The store is a Parquet folder keyed by ``_id`` (= ``version_hash``).  A batch
is deduplicated by a keyed top-1 (Catalyst plans it as a partial
WindowGroupLimit before the exchange, so a hot key is cut down map-side) and
then anti-joined against the store's ``_id`` column only.

A bucketed store is the same as a catalog table whose files are dealt by the hash of ``_id`` into a fixed number of
buckets, sorted by ``_id`` and written with a Bloom filter on it: a batch is dealt alike and meets the store bucket by bucket, so that
the store is never shuffled, and a look-up of single ids skips row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

def first_wins(records: DataFrame, key: str = "version_hash",
               order: tuple = ("source_page_url", "row_pos")) -> DataFrame:
    """Keep the first record per key in a fixed order (page URL, row position)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return records.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def with_store_keys(records: DataFrame, key: str = "version_hash") -> DataFrame:
    """Add the store columns: ``_id`` = fingerprint, ``_needs_download`` = true."""
    return records.select(F.col(key).alias("_id"), F.lit(True).alias("_needs_download"), "*")


def new_records(batch: DataFrame, store_ids: DataFrame | None, key: str = "_id") -> DataFrame:
    """Records of ``batch`` whose key is absent from the store (lazy; no write)."""
    if store_ids is None:
        return batch
    return batch.join(store_ids.select(key), key, "left_anti")


def existing_ids(store: DataFrame, batch_ids: DataFrame, key: str = "_id") -> DataFrame:
    """Ids of the batch already in the store: a semi-join that reads the store's key column only.

    Spark broadcasts the batch ids when they are below its own threshold, so that the store is not shuffled."""
    return store.select(key).join(batch_ids.select(key), key, "left_semi").distinct()


def insert_if_absent(spark: SparkSession, records: DataFrame, store_path: str,
                     key: str = "version_hash") -> int:
    """Append to ``store_path`` the first record of every fingerprint not already stored.

    The batch and then its new rows are checkpointed (in the shared checkpoint folder), so each is computed
    once.  Returns the number of inserted rows.
    """
    batch = first_wins(with_store_keys(records, key), key="_id").checkpoint(eager=True)
    store = read_store(spark, store_path)
    if store is not None:
        batch = new_records(batch, existing_ids(store, batch)).checkpoint(eager=True)
    batch.write.mode("append").parquet(store_path)
    return batch.count()


def open_bucketed(spark: SparkSession, table: str, path: str, schema: str, buckets: int, key: str = "_id") -> DataFrame:
    """Register the bucketed store under ``path`` as a catalog table (a new store if the folder is empty)."""
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet "
              f"OPTIONS ('parquet.bloom.filter.enabled#{key}' 'true', 'parquet.bloom.filter.adaptive.enabled' 'true') "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(table)


def _bucket_spec(spark: SparkSession, table: str) -> tuple[int, str]:
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(rows["Num Buckets"]), rows["Bucket Columns"].strip("[]`")


def new_in_bucketed(spark: SparkSession, records: DataFrame, table: str, key: str = "version_hash") -> DataFrame:
    """First record of every fingerprint that the bucketed store lacks: the batch is dealt by the store's buckets once, for the
    choice of the first writer and for the anti-join; the store side has no exchange."""
    buckets, id_col = _bucket_spec(spark, table)
    batch = with_store_keys(records, key).repartition(buckets, id_col)
    return new_records(first_wins(batch, key=id_col), spark.table(table), id_col)


def insert_bucketed(spark: SparkSession, records: DataFrame, table: str, key: str = "version_hash") -> int:
    """Append the first record of every fingerprint not already stored in the bucketed ``table``; returns their number."""
    buckets, id_col = _bucket_spec(spark, table)
    new = new_in_bucketed(spark, records, table, key).select(*spark.table(table).columns).checkpoint(eager=True)
    (new.repartition(buckets, id_col).write.mode("append").format("parquet").bucketBy(buckets, id_col).sortBy(id_col)
     .option(f"parquet.bloom.filter.enabled#{id_col}", "true").option("parquet.bloom.filter.adaptive.enabled", "true").saveAsTable(table))
    spark.catalog.refreshTable(table)
    return new.count()


def find_ids(store: DataFrame, ids: list[str], key: str = "_id") -> DataFrame:
    """Rows of a short list of ids: the equalities reach the scan, where sorted files and Bloom filters skip row groups."""
    wanted = F.lit(False)
    for i in ids:
        wanted = wanted | (F.col(key) == i)
    return store.where(wanted)


def read_store(spark: SparkSession, store_path: str) -> DataFrame | None:
    """The store, or None if its folder holds no data yet; any failure to read it is raised."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(store_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path) or not any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(path)):
        return None
    return spark.read.parquet(store_path)


def scan_store(store: DataFrame, size: int = 10, key: str = "_id") -> DataFrame:
    """Match-all page of ``size`` hits (ordered by key for determinism)."""
    return store.orderBy(key).limit(size)


def project_hits(hits: DataFrame, fields: list[str]) -> DataFrame:
    """Only the chosen fields of each hit, in the order asked for."""
    return hits.select(*fields)


def pending_count(store: DataFrame) -> DataFrame:
    return store.where(F.col("_needs_download")).agg(F.count(F.lit(1)).alias("count"))


def download_worklist(store: DataFrame) -> DataFrame:
    """One row per pending downloadable item."""
    return store.where(F.col("_needs_download")).select(
        "_id", F.inline_outer("downloadable_items"))


def list_sources(store: DataFrame) -> DataFrame:
    return store.select(F.col("crawler_used").alias("name")).distinct()


def source_exists(requests: DataFrame, sources: DataFrame, on: str = "name") -> DataFrame:
    """Requests whose name is a known source (membership test as a semi-join)."""
    return requests.join(sources, on, "left_semi")


def upsert_by_id(old: DataFrame, new: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key, whole; of new rows with one key the last by
    ``order`` stays (without it, the greatest row)."""
    row = F.struct(*[F.col(c) for c in new.columns])
    last = new.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, F.struct(F.col(order), row) if order else row).alias("_row"))
    return old.join(new.select(key), key, "left_anti").unionByName(last.select("_row.*"))


def write_snapshot(df: DataFrame, root: str, version: int) -> str:
    """Write a new store snapshot (never overwrite the folder being read)."""
    path = f"{root.rstrip('/')}/v={version:08d}"
    df.write.mode("errorifexists").parquet(path)
    return path


def drop_store(spark: SparkSession, path_or_table: str) -> None:
    """Delete a whole store: a catalog table by name, or a folder by path."""
    if "/" not in path_or_table:
        spark.sql(f"DROP TABLE IF EXISTS {path_or_table}")
        return
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path_or_table)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
