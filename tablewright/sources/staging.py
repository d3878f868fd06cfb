"""Writing so that a run that was stopped can be run again: hidden folders first, then a move.

Files under a name that begins with an underscore are read by nobody. On file
systems that rename in one step (local ones, HDFS and their like) a folder is
there as a whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def hidden_folder(path: str, name: str) -> str:
    """Where a run stages what it writes to ``path``; the same for the same name."""
    return f"{path.rstrip('/')}/_staging/{name.strip('-')}"


def _data_files(fs, folder) -> list:
    if not fs.exists(folder):
        return []
    return [s.getPath() for s in fs.listStatus(folder) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def add_files(spark: SparkSession, staged: str, path: str, prefix: str) -> None:
    """Move the data files of ``staged`` to ``path``, under names with ``prefix``; files there that have it go first."""
    source, fs = _at(spark, staged)
    target, _ = _at(spark, path)
    fs.mkdirs(target)
    for old in _data_files(fs, target):
        if old.getName().startswith(prefix):
            fs.delete(old, False)
    for file in _data_files(fs, source):
        to = spark._jvm.org.apache.hadoop.fs.Path(target, prefix + file.getName())
        if not fs.rename(file, to):
            raise OSError(f"could not move {file} to {to}")
    fs.delete(source, True)


def add_folders(spark: SparkSession, staged: str, path: str) -> list[str]:
    """Move the folders of ``staged`` to ``path``, each in one step; returns the names of those moved.

    A folder that is there already was moved by an earlier run, and stays.
    """
    source, fs = _at(spark, staged)
    target, _ = _at(spark, path)
    fs.mkdirs(target)
    moved = []
    for status in fs.listStatus(source) if fs.exists(source) else []:
        name = status.getPath().getName()
        to = spark._jvm.org.apache.hadoop.fs.Path(target, name)
        if status.isDirectory() and not name.startswith(("_", ".")) and not fs.exists(to):
            if not fs.rename(status.getPath(), to):
                raise OSError(f"could not move {status.getPath()} to {to}")
            moved.append(name)
    fs.delete(source, True)
    return moved


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders that have been moved to ``path``."""
    folder, fs = _at(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, put in place of the one before by a move."""
    to, fs = _at(spark, path)
    fresh, _ = _at(spark, path + ".new")
    stream = fs.create(fresh, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(to, False)
    if not fs.rename(fresh, to):
        raise OSError(f"could not write {path}")


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a note; of one that was about to replace it, if the move was cut short; None without either."""
    for name in (path, path + ".new"):
        at, fs = _at(spark, name)
        if fs.exists(at):
            stream = fs.open(at)
            text = bytes(stream.readAllBytes()).decode()
            stream.close()
            return text
    return None
