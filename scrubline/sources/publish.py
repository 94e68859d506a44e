"""Publishing the outputs of a run as a whole.

A run writes its tables into a folder of its own, ``runs/<run>``, and becomes the published
one by a single step: its manifest (which table is where, in which format and with which
columns) is written beside ``_manifests`` and renamed to the next number there, which
fails if another run took that number.  Readers follow the newest manifest, so they see
all tables of one run or all of the former; a run that fails or is killed leaves only an unlisted
folder.  Nothing that a manifest names is changed; ``expire`` removes what old ones name.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .csv import read_export

MANIFESTS = "_manifests"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def new_run(out_dir: str) -> tuple[str, str]:
    """(name, folder) of a run; names sort by their time."""
    name = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    return name, os.path.join(out_dir, "runs", name)


def numbers(spark: SparkSession, out_dir: str) -> list[int]:
    """Numbers of the manifests, in order (a listing)."""
    fs, p = _fs(spark, os.path.join(out_dir, MANIFESTS, "*.json"))
    names = [f.getPath().getName().removesuffix(".json") for f in fs.globStatus(p) or []]
    return sorted(int(n) for n in names if n.isdigit())


def manifest(spark: SparkSession, out_dir: str, number: int | None = None) -> dict:
    """The newest manifest, or the one of that number."""
    found = numbers(spark, out_dir)
    if not found or (number is not None and number not in found):
        raise FileNotFoundError(f"nothing published in {out_dir}" if number is None else f"no manifest {number} in {out_dir}")
    number = found[-1] if number is None else number
    fs, p = _fs(spark, os.path.join(out_dir, MANIFESTS, f"{number}.json"))
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, out_dir: str, run: str, tables: dict[str, tuple[str, str, T.StructType]], expected: int | None = None) -> int:
    """Publish a run: ``tables`` maps names to (path below ``out_dir``, format, schema).  Returns the manifest's number.

    With ``expected``, raises ``FileExistsError`` if another run was published after that number; without, goes
    to the next free one.
    """
    fs, _ = _fs(spark, out_dir)
    jvm = spark.sparkContext._jvm
    folder = os.path.join(out_dir, MANIFESTS)
    fs.mkdirs(_fs(spark, folder)[1])
    content = {"run": run, "tables": {n: {"path": p, "format": f, "schema": json.loads(s.json())} for n, (p, f, s) in tables.items()}}
    draft = _fs(spark, os.path.join(out_dir, "runs", f".manifest-{uuid.uuid4().hex}"))[1]
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(content, ensure_ascii=False).encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else fs.getUri(),
                                                                  spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    never_over = spark.sparkContext._gateway.new_array(rename, 1)
    never_over[0] = rename.NONE
    while True:
        number = (numbers(spark, out_dir) or [0])[-1] + 1
        if expected is not None and number != expected + 1:
            fs.delete(draft, False)
            raise FileExistsError(f"{out_dir}: run {number - 1} was published in the meantime")
        try:
            context.rename(draft, _fs(spark, os.path.join(folder, f"{number}.json"))[1], never_over)
            return number
        except Exception as e:  # another run took the number: look again
            if "FileAlreadyExistsException" not in str(e):
                raise


def read(spark: SparkSession, out_dir: str, name: str, number: int | None = None) -> DataFrame:
    """A published table, of the newest run or of manifest ``number``."""
    held = manifest(spark, out_dir, number)["tables"]
    if name not in held:
        raise KeyError(f"{name} is not published; there are {sorted(held)}")
    t = held[name]
    path, schema = os.path.join(out_dir, t["path"]), T.StructType.fromJson(t["schema"])
    return read_export(spark, path, schema) if t["format"] == "csv" else spark.read.schema(schema).format(t["format"]).load(path)


def register(spark: SparkSession, out_dir: str, prefix: str = "") -> list[str]:
    """Temporary views of all tables of the newest run."""
    names = sorted(manifest(spark, out_dir)["tables"])
    for n in names:
        read(spark, out_dir, n).createOrReplaceTempView(prefix + n)
    return [prefix + n for n in names]


def save_tables(spark: SparkSession, out_dir: str, database: str = "default") -> list[str]:
    """The newest run in the catalog: each table is saved under a name of its run with ``saveAsTable``, then the view of its
    plain name is replaced, so that catalog readers change over table by table and never miss one."""
    found = manifest(spark, out_dir)
    suffix = found["run"].replace("-", "_").lower()
    for n in sorted(found["tables"]):
        real = f"`{database}`.`{n}__{suffix}`"
        if not spark.catalog.tableExists(real.replace("`", "")):
            read(spark, out_dir, n).write.format("parquet").saveAsTable(real)
        spark.sql(f"create or replace view `{database}`.`{n}` as select * from {real}")
    return [f"{database}.{n}" for n in sorted(found["tables"])]


def expire(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Remove all manifests but the newest ``keep`` and the run folders that only they name.

    Folders that no manifest names may belong to a run that goes on, and stay.
    """
    found = numbers(spark, out_dir)
    old, new = found[:-keep] if keep else found, found[-keep:] if keep else []
    runs = {n: manifest(spark, out_dir, n)["run"] for n in found}
    kept = {runs[n] for n in new}
    for n in old:
        fs, p = _fs(spark, os.path.join(out_dir, MANIFESTS, f"{n}.json"))
        fs.delete(p, False)
    gone = sorted({runs[n] for n in old} - kept)
    for run in gone:
        fs, p = _fs(spark, os.path.join(out_dir, "runs", run))
        fs.delete(p, True)
    return gone
