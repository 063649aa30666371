"""Safe replacement of a written folder (K1, K2): the old rows stay readable until the new ones are complete.

A run adds its files beside those of the run before, then records which files are
its own in a numbered manifest, and only then removes the others.  Spark names
all files of one write after that write, so the manifest is one token.  Readers
go by the newest manifest: a run that ends early, at whatever point, leaves the
rows of the run before; what it left behind is removed by the next run.  The
manifest carries the run's attributes as well, so rows and attributes change
together.

After a run the folder holds its files only, so that any Parquet reader can open
it; while a run is under way, read it through ``read_dataset`` or the readers of
``writers``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Folder of the manifests below the data; readers of Parquet skip names that start with an underscore.
RUNS_DIR = "_runs"
# Fixed value: Spark's part files carry the id of the write between the part number and the file number.
_TOKEN = re.compile(r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


def _path(spark: SparkSession, path: str):
    """A path and the cluster's file system for it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below a folder; none if it does not exist."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    base, found, files = fs.makeQualified(p).toString(), [], fs.listFiles(p, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in name.removeprefix(base).strip("/").split("/")):
            found.append(name)
    return found


def token_of(name: str) -> str | None:
    """The write that a part file belongs to."""
    found = _TOKEN.match(name.rsplit("/", 1)[-1])
    return found.group(1) if found else None


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, p = _path(spark, f"{path.rstrip('/')}/{RUNS_DIR}")
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest of a folder: ``files`` (a token, None for a run without a file) and ``attrs``."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    fs, p = _path(spark, f"{path.rstrip('/')}/{RUNS_DIR}/{numbers[-1]:08d}.json")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def switch(spark: SparkSession, path: str, content: dict) -> None:
    """Record a manifest as the newest: written under another name, then renamed in one step."""
    numbers = _numbers(spark, path)
    target = f"{path.rstrip('/')}/{RUNS_DIR}/{(numbers[-1] if numbers else 0) + 1:08d}.json"
    fs, draft = _path(spark, f"{target}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(content, default=str).encode()))
    stream.close()
    if not fs.rename(draft, _path(spark, target)[1]):
        raise OSError(f"the manifest {target} could not be put in place")


def replace(spark: SparkSession, path: str, write: Callable[[], None], attrs: dict | None = None) -> None:
    """Replace the rows of ``path`` by what ``write`` appends to it; the old ones count until that is complete."""
    before = set(data_files(spark, path))
    write()
    after = data_files(spark, path)
    tokens = {token_of(f) for f in after if f not in before}
    if len(tokens) > 1 or None in tokens:
        raise ValueError(f"{path} got files of {len(tokens)} writes at once")
    own = next(iter(tokens), None)
    switch(spark, path, {"files": own, "attrs": attrs or {}})
    fs, _ = _path(spark, path)
    emptied = set()
    for f in after:
        if token_of(f) != own or own is None:
            p = _path(spark, f)[1]
            fs.delete(p, False)
            emptied.add(p.getParent().toString())
    base = fs.makeQualified(_path(spark, path)[1]).toString()
    for folder in emptied:  # partitions that the new run does not have
        while len(folder) > len(base) and not fs.listStatus(_path(spark, folder)[1]):
            fs.delete(_path(spark, folder)[1], False)
            folder = folder.rsplit("/", 1)[0]
    for n in _numbers(spark, path)[:-2]:
        fs.delete(_path(spark, f"{path.rstrip('/')}/{RUNS_DIR}/{n:08d}.json")[1], False)


def read_folders(spark: SparkSession, paths: Sequence[str], base: str | None = None) -> DataFrame:
    """The current rows of folders that have the same columns; folders without a manifest are read whole."""
    known = {p: manifest(spark, p) for p in paths}
    tokens = [m["files"] for m in known.values() if m]
    parts = []
    for group, names in (([p for p in paths if known[p]], tokens), ([p for p in paths if not known[p]], None)):
        if group:
            reader = spark.read.option("basePath", base) if base else spark.read
            if names is not None:
                reader = reader.option("pathGlobFilter", "*{" + ",".join(str(n) for n in names) + "}*")
            parts.append(reader.parquet(*group))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of one written folder."""
    return read_folders(spark, [path])
