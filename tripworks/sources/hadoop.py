"""Small file-system calls through Hadoop, so the same code works on local disks and object stores."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def touch(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.create(hadoop_path, True).close()


def delete_file(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, False)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def size(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of all these files."""
    total = 0
    for path in paths:
        fs, hadoop_path = _fs(spark, path)
        total += fs.getFileStatus(hadoop_path).getLen()
    return total


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file so that it is there as a whole or not at all."""
    fs, hadoop_path = _fs(spark, path)
    _, part = _fs(spark, f"{path}.part")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(part, hadoop_path):
        raise OSError(f"cannot write {path}")


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each data file under a folder, by its path in it; names that begin with a dot or underscore are none."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return {}
    top = fs.getFileStatus(hadoop_path).getPath().toString().rstrip("/")
    found, files = {}, fs.listFiles(hadoop_path, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString()[len(top) + 1 :]
        if not any(part.startswith((".", "_")) for part in name.split("/")):
            found[name] = status.getLen()
    return found
