"""Session settings and the shared folder used to cut lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app="quire", master=None, shuffle_partitions=None, **conf):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Where the setting is missing a local session makes its own temporary
    folder; on a cluster that would not be shared, so it is an error there.
    """
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("quire.shared.folder", None)
    )
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("quire.shared.folder", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/quire/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store `df` in the shared folder and go on from the stored copy."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write `df` as a table in the shared folder; the table and its path."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
