"""Static tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def fs_path(spark: SparkSession, path: str):
    """A path's file system and the path in it."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


class Tables:
    """Reader of `<folder>/<name>.parquet`. A file's schema is looked up once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.schemas = spark, folder, {}

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if name not in self.schemas:
            df = self.spark.read.parquet(path)
            self.schemas[name] = df.schema
            return df
        return self.spark.read.schema(self.schemas[name]).parquet(path)

    def spread(self, name: str) -> DataFrame:
        """The table with its rows dealt out to all cores, for heavy work per row,
        where its files come to fewer tasks than there are cores."""
        df, cores = self(name), self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def parquet_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder)


def jdbc_query(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
               bounds: tuple | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """Any select of a JDBC store as a DataFrame, read in parallel when split bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    low, high = bounds
    return (reader.option("dbtable", f"({query}) q")
            .option("partitionColumn", partition_column)
            .option("lowerBound", low).option("upperBound", high)
            .option("numPartitions", partitions).load())


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 100, writers: int = 4,
                **options: str) -> None:
    """Append with a bounded number of connections and no transaction isolation."""
    (df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
     .option("batchsize", batch_rows).option("isolationLevel", "NONE")
     .option("numPartitions", writers).options(**options).save())
