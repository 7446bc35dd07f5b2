"""Folder-level operations on whatever file system a path lives on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs_and_path(spark, source)
    _, q = _fs_and_path(spark, target)
    if not fs.rename(p, q):
        raise OSError(f"could not rename {source} to {target}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder, if it exists."""
    fs, p = _fs_and_path(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(p)) if fs.exists(p) else []


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy one file, whatever file systems the two are on."""
    fs, p = _fs_and_path(spark, source)
    other, q = _fs_and_path(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, other, q, False, True, spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.mkdirs(p)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first-level partition column, from the folder names alone."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    names = [status.getPath().getName() for status in fs.listStatus(p) if status.isDirectory()]
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def holds_data(spark: SparkSession, path: str) -> bool:
    """True once a table has been written at ``path``."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return False
    return any(
        not status.getPath().getName().startswith(("_", "."))
        for status in fs.listStatus(p)
    )


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of the files below a folder, by full path; hidden ones left out."""
    fs, p = _fs_and_path(spark, path)
    found, walk = {}, fs.listFiles(p, True) if fs.exists(p) else None
    while walk is not None and walk.hasNext():
        status = walk.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found[status.getPath().toString()] = status.getLen()
    return found


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, draft = _fs_and_path(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename(spark, f"{path}.draft", path)


def read_note(spark: SparkSession, path: str) -> str:
    fs, p = _fs_and_path(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
