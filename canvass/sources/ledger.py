"""Stored editions that are kept up to date: versions of tables, and a ledger that says which ones count.

Under a root, `tables/<table>/<version>/edition=<year>` holds one table of one
edition and is never changed once written.  `ledger/<number>.json` lists, for every edition, the
fingerprint of the files it was made of and the folders of its tables; the highest
number counts.  A refresh reads only editions whose fingerprint changed, writes new versions, and then puts the next
ledger in place by one rename: until then readers see the state before, and a refresh that dies
leaves nothing but folders no ledger names.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LedgerConflict(RuntimeError):
    """Another refresh put its ledger in place first."""


class Ledger:
    """The ledgers under a root, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def files(self, folder: str) -> list:
        """Status of the files and folders in a folder; none if it is absent."""
        path = self.path(folder)
        system = path.getFileSystem(self.conf)
        return list(system.listStatus(path)) if system.exists(path) else []

    def newest(self) -> tuple[int, dict]:
        """Number and content of the ledger that counts."""
        names = [s.getPath().getName() for s in self.files(f"{self.root}/ledger")]
        numbers = [int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()]
        if not numbers:
            return 0, {"editions": {}, "schemas": {}}
        path = self.path(f"{self.root}/ledger/{max(numbers)}.json")
        stream = path.getFileSystem(self.conf).open(path)
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return max(numbers), json.loads(text)

    def put(self, number: int, content: dict) -> None:
        """Ledger `number`, all at once; it is an error if there is one already."""
        target, draft = self.path(f"{self.root}/ledger/{number}.json"), self.path(f"{self.root}/ledger/_{uuid.uuid4().hex}")
        system = target.getFileSystem(self.conf)
        stream = system.create(draft, False)
        try:
            stream.write(json.dumps(content, sort_keys=True).encode("utf-8"))
        finally:
            stream.close()
        if system.exists(target) or not system.rename(draft, target):
            system.delete(draft, False)
            raise LedgerConflict(f"ledger {number} of {self.root} is there already")

    def fingerprint(self, folder: str) -> str:
        """Names, sizes and times of all data files below a folder."""
        told, open_ = [], [folder]
        while open_:
            for s in self.files(open_.pop()):
                name = s.getPath().getName()
                if name.startswith(("_", ".")):
                    continue
                if s.isDirectory():
                    open_.append(s.getPath().toString())
                else:
                    told.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
        return hashlib.sha256(json.dumps(sorted(told)).encode()).hexdigest()

    def forgotten(self) -> list[str]:
        """Version folders that the newest ledger does not name, such as those of refreshes that died."""
        _, content = self.newest()
        used = {p.rsplit("/", 1)[0] for e in content["editions"].values() for p in e["tables"].values()}
        found = [s.getPath().toString() for t in self.files(f"{self.root}/tables") for s in self.files(t.getPath().toString())]
        return sorted(p for p in found if not any(p.endswith(u.removeprefix(self.root)) for u in used))


Make = Callable[[Callable[[str], DataFrame], DataFrame], DataFrame]


def refresh(
    spark: SparkSession,
    root: str,
    landed: Mapping[int, str],
    read: Callable[[Sequence[str]], DataFrame],
    tables: Mapping[str, Make],
    version: str = "1",
    year: str = "year",
) -> list[int]:
    """Bring the stored tables up to date with the landed folders; returns the editions that were made anew.

    `landed` maps an edition to its folder, and `read` gives the submissions of some folders.  A
    table is made by a function of (stored table by name, submissions), so a later
    table can start from an earlier one, as it was just written.  All changed editions are made
    in one pass for each table.  `version` names the rules: with another one everything is made
    anew.  Editions that are not landed any more leave the ledger.
    """
    ledger = Ledger(spark, root)
    number, before = ledger.newest()
    prints = {str(y): ledger.fingerprint(folder) + version for y, folder in landed.items()}

    def stands(y: str) -> bool:
        known = before["editions"].get(y)
        return bool(known) and known["inputs"] == prints[y] and set(known["tables"]) == set(tables)

    kept = {y: before["editions"][y] for y in prints if stands(y)}
    changed = sorted(int(y) for y in prints if y not in kept)
    if not changed and len(kept) == len(before["editions"]):
        return []
    schemas = dict(before["schemas"]) if kept else {}
    made: dict[str, DataFrame] = {}
    folders: dict[str, str] = {}
    if changed:
        submissions = read([landed[y] for y in changed])
        for name, make in tables.items():
            df = make(made.__getitem__, submissions)
            told = df.schema.json()
            if schemas.setdefault(name, told) != told and kept:
                raise ValueError(f"table {name} has other columns than in the editions that are kept; use another version")
            schemas[name] = told
            folders[name] = f"{ledger.root}/tables/{name}/{uuid.uuid4().hex}"
            df.withColumn("edition", F.col(year)).write.partitionBy("edition").parquet(folders[name])
            there = _existing(ledger, folders[name], changed)
            made[name] = spark.read.schema(df.schema).parquet(*there) if there else spark.createDataFrame([], df.schema)
    for y in changed:
        kept[str(y)] = {
            "inputs": prints[str(y)], "tables": {name: f"{folder}/edition={y}" for name, folder in folders.items()},
        }
    ledger.put(number + 1, {"editions": kept, "schemas": schemas})
    return changed


def _existing(ledger: Ledger, folder: str, years: Iterable[int]) -> list[str]:
    """Folders of the editions that have rows."""
    there = {s.getPath().getName() for s in ledger.files(folder)}
    return [f"{folder}/edition={y}" for y in years if f"edition={y}" in there]


def kept_table(spark: SparkSession, root: str, name: str, years: Sequence[int] | None = None) -> DataFrame:
    """A stored table as the newest ledger names it; only the files of the wanted editions are looked at."""
    ledger = Ledger(spark, root)
    number, content = ledger.newest()
    if name not in content["schemas"]:
        raise LookupError(f"no table {name!r} in ledger {number} of {root}")
    schema = T.StructType.fromJson(json.loads(content["schemas"][name]))
    wanted = [y for y in sorted(map(int, content["editions"])) if years is None or y in years]
    folders = [content["editions"][str(y)]["tables"][name] for y in wanted]
    there = [f for f in folders if ledger.path(f).getFileSystem(ledger.conf).exists(ledger.path(f))]
    return spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    # a local session without that setting, as in tests
    return tempfile.mkdtemp(prefix="run-")
