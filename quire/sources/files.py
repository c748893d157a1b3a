"""Reading split files and named datasets."""

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ordering import with_global_index
from ..operators.sentences import SPLIT_ORDER

FORMATS = {"json": "json", "csv": "csv", "txt": "text", "text": "text"}  # Fixed values


def check_source(dataset_dir=None, train_file=None, eval_file=None, file_type=None) -> str:
    """Which kind of source the settings name; a directory wins."""
    if dataset_dir:
        return "dataset"
    if train_file and eval_file and file_type:
        if file_type not in FORMATS:
            raise ValueError(f"file type must be one of {sorted(FORMATS)}")
        return "files"
    raise ValueError("name a dataset directory, or a train file, an eval file and their type")


#: Names that a split's files may begin with.
SPLIT_NAMES = {
    "train": ("train", "training"),
    "validation": ("validation", "valid", "val", "dev", "eval"),
    "test": ("test",),
}
#: Where a row stands in its files: the key of file order. `entry` is the
#: place of its path in the list that was given.
FILE_ORDER = ("entry", "file", "block", "line")


def read_splits(
    spark: SparkSession, files: dict[str, str | list[str]], fmt: str, schema=None,
    multi_line: bool = False, file_order: bool = False,
) -> DataFrame:
    """Files of one format, one entry per split, as one table with `split`.

    Give a `schema` for large inputs: without one, json and csv are read twice.
    csv values that hold line breaks need `multi_line=True`; each such file is
    then read by one task, while others are cut up. With `file_order` rows also
    get the columns of `FILE_ORDER`, which sort them as they stand in the files:
    a list of paths in the order given, files of one path by name. `with_row_ids`
    numbers them.
    """
    if fmt not in FORMATS:
        raise ValueError(f"file type must be one of {sorted(FORMATS)}")
    parts = [
        _read(spark, path, FORMATS[fmt], schema, multi_line, file_order).withColumn("split", F.lit(name))
        for name, path in files.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read(spark, path, source, schema, multi_line, file_order):
    reader = spark.read.schema(schema) if schema and source != "text" else spark.read
    if source == "text":
        rows = reader.text(path).withColumnRenamed("value", "text")
    elif source == "csv":
        rows = reader.csv(path, header=True, multiLine=multi_line, escape='"')
    else:
        rows = reader.json(path)
    if not file_order:
        return rows
    # A task reads its blocks one after the other, so the running number is in
    # order inside each block.
    place = F.monotonically_increasing_id()
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        place.alias("line"),
    )
    given = [path] if isinstance(path, str) else list(path)
    if len(given) == 1:
        return placed.withColumn("entry", F.lit(0))
    # The reader lists these files too; their names are all that is sent.
    entries: dict = {}
    for number, one in enumerate(given):
        for name, _, _ in file_state(spark, [one]):
            uri = spark._jvm.org.apache.hadoop.fs.Path(name).toUri().toString()
            entries.setdefault(_bare(uri), number)
    known = spark.createDataFrame(list(entries.items()), "_bare string, _entry int")
    bare = F.regexp_replace("file", r"^(\w+):/+", "$1:/")
    unknown = F.raise_error(F.concat(F.lit("a file that was not listed: "), "file")).cast("int")
    found = placed.withColumn("_bare", bare).join(F.broadcast(known), "_bare", "left")
    return found.withColumn("entry", F.coalesce("_entry", unknown)).drop("_bare", "_entry")


def _bare(path: str) -> str:
    """A path with one slash behind its scheme, however it is written."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Rows read with `file_order`, numbered through splits and files in order."""
    order = F.lit(len(SPLIT_ORDER))
    for i, split in enumerate(SPLIT_ORDER):
        order = F.when(F.col("split") == split, i).otherwise(order)
    keys = ["_split", "split", *FILE_ORDER]
    return with_global_index(df.withColumn("_split", order), keys, name=name).drop("_split", *FILE_ORDER)


def _split_of(name: str, names: dict) -> str | None:
    """The split that a file or folder name begins with, as a whole part."""
    part = re.split(r"[^A-Za-z0-9]", name)[0].lower()
    return next((split for split, known in names.items() if part in known), None)


def read_dataset(spark: SparkSession, directory: str, subset: str | None, fmt: str = "json",
                 splits: dict[str, str | list[str]] | None = None, schema=None,
                 multi_line: bool = False, file_order: bool = False) -> DataFrame:
    """A dataset directory, or a named subset of it: every split file it holds.

    `splits` gives a file pattern for each split. Without it a file belongs to
    the split that its name begins with, up to the first character that is no
    letter or digit: `train_x.json`, `valid.json`, `dev-00001.json`. A file that
    belongs to none is an error, so nothing is left out silently; a split
    without files is not.
    """
    base = f"{directory}/{subset}" if subset else directory
    if splits:
        files = {s: [f"{base}/{p}" for p in ([given] if isinstance(given, str) else given)]
                 for s, given in splits.items()}
        missing = [p for paths in files.values() for p in paths if not _exists(spark, p)]
        if missing:
            raise ValueError(f"no files match {missing}")
        return read_splits(spark, files, fmt, schema, multi_line, file_order)
    files, others = {}, []
    for path in _listed(spark, base):
        name = path.rsplit("/", 1)[-1]
        if name[0] in "._":
            continue
        split = _split_of(name, SPLIT_NAMES)
        files.setdefault(split, []).append(path) if split else others.append(name)
    if not files:
        raise ValueError(f"no split files under {base}")
    if others:
        raise ValueError(f"files of no split under {base}: {sorted(others)}; name the splits' patterns")
    ordered = {s: sorted(files[s]) for s in SPLIT_NAMES if s in files}
    return read_splits(spark, ordered, fmt, schema, multi_line, file_order)


def _file_system(spark, pattern):
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _exists(spark, pattern) -> bool:
    """Whether a path pattern matches, on whatever file system it names."""
    system, path = _file_system(spark, pattern)
    found = system.globStatus(path)
    return found is not None and len(found) > 0


def _listed(spark, folder) -> list[str]:
    """Paths of the files and folders in a folder; none if it doesn't exist."""
    system, path = _file_system(spark, folder)
    return [f.getPath().toString() for f in system.listStatus(path)] if system.exists(path) else []


def file_state(spark: SparkSession, patterns: list[str]) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of every file that the patterns name."""
    found = []
    for pattern in patterns:
        system, path = _file_system(spark, pattern)
        for top in system.globStatus(path) or []:
            if top.isFile():
                found.append((top.getPath().toString(), top.getLen(), top.getModificationTime()))
                continue
            files = system.listFiles(top.getPath(), True)
            while files.hasNext():
                f = files.next()
                found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def load_source(spark, dataset_dir=None, subset=None, train_file=None, eval_file=None,
                file_type=None, schema=None, multi_line=False, file_order=False) -> DataFrame:
    """Validate the settings, then read whichever source they name."""
    if check_source(dataset_dir, train_file, eval_file, file_type) == "dataset":
        return read_dataset(spark, dataset_dir, subset, file_type or "json", schema=schema,
                            multi_line=multi_line, file_order=file_order)
    files = {"train": train_file, "validation": eval_file}
    return read_splits(spark, files, file_type, schema, multi_line, file_order)


def write_lines(df: DataFrame, path: str, col: str = "sentence") -> None:
    """One value per line, one file per partition."""
    df.select(F.col(col).cast("string")).write.text(path)
