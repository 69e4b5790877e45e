"""Tables of committed folders, for layers that streams append to and compaction rewrites.

``data/tier=batch/entry=<key>/`` holds what one micro-batch or load wrote, ``data/tier=packed/entry=<key>/`` what a compaction
made of many such entries, ``versions/<n>.json`` the entries that version n consists of. A writer puts its files into
``staging/``, moves the finished folder in place and writes the next version last. So

* a reader sees whole commits only, and one that has begun keeps its files while newer versions appear;
* a key that is committed already is not written again, which makes a rerun micro-batch count once;
* streams follow ``tier=batch`` and never meet rows a second time because they were packed;
* writers that meet try again on top of the other's version.

Moving a folder has to be one step, as it is on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Entry = dict
FILE_BYTES = 128 << 20


def _numbered(key: str) -> tuple[str, int]:
    """A key as its stem and number; a key without a number is a stem with number 0."""
    stem, _, number = key.rpartition("-")
    return (stem, int(number)) if stem and number.isdigit() else (key, 0)


class Folder:
    """A folder of any file system that Spark's readers can open."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        context = spark.sparkContext
        self._fs = context._jvm.org.apache.hadoop.fs
        self._conf = context._jsc.hadoopConfiguration()
        self._gateway = context._gateway
        self._jvm = context._jvm

    def _at(self, name: str = ""):
        path = self._fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self._conf)

    def exists(self, name: str = "") -> bool:
        path, fs = self._at(name)
        return fs.exists(path)

    def names(self, name: str = "") -> list[str]:
        path, fs = self._at(name)
        return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []

    def files(self, name: str = "") -> list[tuple[str, int]]:
        """Data files below, as paths relative to ``name``, with their sizes."""
        path, fs = self._at(name)
        if not fs.exists(path):
            return []
        found, out = fs.listFiles(path, True), []
        prefix = fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"
        while found.hasNext():
            one = found.next()
            if not one.getPath().getName().startswith(("_", ".")):
                out.append((one.getPath().toUri().getPath()[len(prefix) :], one.getLen()))
        return sorted(out)

    def delete(self, name: str = "") -> None:
        path, fs = self._at(name)
        fs.delete(path, True)

    def move(self, name: str, to: str) -> None:
        """Move a folder or file; fails if there is something already."""
        source, target = self._at(name)[0], self._at(to)[0]
        target.getFileSystem(self._conf).mkdirs(target.getParent())
        rename = getattr(self._fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._fs.FileContext.getFileContext(source.getFileSystem(self._conf).getUri(), self._conf)
        context.rename(context.makeQualified(source), context.makeQualified(target), options)

    def read(self, name: str) -> str:
        path, fs = self._at(name)
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write a file in full under another name first; fails if ``name`` exists."""
        hidden = f".{uuid.uuid4().hex}"
        path, fs = self._at(hidden)
        stream = fs.create(path, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            self.move(hidden, name)
        finally:
            fs.delete(path, False)


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | str, partitions: tuple[str, ...] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = Folder(spark, self.root)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.partitions = tuple(partitions)

    # Versions
    def versions(self) -> list[int]:
        return [int(x.split(".")[0]) for x in self.folder.names("versions") if x.endswith(".json") and not x.startswith(".")]

    def entries(self, version: int | None = None) -> list[Entry]:
        """What a version (the last one) consists of: key, tier, files, bytes and what the writer added."""
        known = self.versions()
        if not known:
            return []
        return json.loads(self.folder.read(f"versions/{known[-1] if version is None else version:012d}.json"))

    def _publish(self, change: Callable[[list[Entry]], list[Entry]]) -> int:
        """Write the version after the last one; another writer's version in between is taken into account."""
        while True:
            known = self.versions()
            last = known[-1] if known else 0
            entries = change(self.entries(last) if known else [])
            try:
                self.folder.write(f"versions/{last + 1:012d}.json", json.dumps(entries))
                return last + 1
            except Exception as error:
                if "FileAlreadyExists" not in str(error):
                    raise

    # Reading
    def _paths(self, entries: Iterable[Entry]) -> list[str]:
        return [f"{self.root}/data/tier={x['tier']}/entry={x['key']}" for x in entries]

    def _stored(self) -> T.StructType:
        return T.StructType(self.schema.fields + [T.StructField("tier", T.StringType()), T.StructField("entry", T.StringType())])

    def read(self, version: int | None = None, only: Callable[[Entry], bool] | None = None) -> DataFrame:
        """Rows of a version, or of those of its entries that ``only`` accepts."""
        entries = [x for x in self.entries(version) if x["files"] and (only is None or only(x))]
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self._stored()).option("basePath", f"{self.root}/data")
        return reader.parquet(*self._paths(entries)).select(*self.schema.fieldNames())

    def stream(self, max_files: int = 1000) -> DataFrame:
        """Rows as they are appended; packed folders are not part of it."""
        path = self._fs_dir("data/tier=batch")
        # A file stream takes its own path as the place where partition folders begin.
        stored = T.StructType([x for x in self._stored() if x.name != "tier"])
        reader = self.spark.readStream.schema(stored).option("maxFilesPerTrigger", max_files)
        return reader.parquet(path).select(*self.schema.fieldNames())

    def _fs_dir(self, name: str) -> str:
        path, fs = self.folder._at(name)
        fs.mkdirs(path)
        return f"{self.root}/{name}"

    # Writing
    def committed(self, key: str) -> bool:
        """Whether a key is part of the table, itself or packed. Keys that end in a number come in that order."""
        stem, number = _numbered(key)
        for entry in self.entries():
            if entry["key"] == key or entry.get("covers", {}).get(stem, -1) >= number:
                return True
        return False

    def stage(self, df: DataFrame, key: str, spread: bool = True, sort: tuple[str, ...] = ()) -> None:
        """Write the rows of an entry where nobody sees them yet."""
        rows = df.select(*self.schema.fieldNames())
        if spread:
            # Gathers what each partition value has in all tasks, and splits a value with far more rows than others.
            rows = rows.hint("rebalance", *[F.col(x) for x in self.partitions])
        if self.partitions or sort:
            rows = rows.sortWithinPartitions(*self.partitions, *sort)
        rows.write.mode("overwrite").partitionBy(*self.partitions).parquet(f"{self.root}/staging/{key}")

    def commit(self, key: str, tier: str = "batch", replaces: Iterable[str] = (), **more) -> int:
        """Make a staged entry part of the table, in place of ``replaces``."""
        place = f"data/tier={tier}/entry={key}"
        # An earlier attempt may have got as far as moving the folder, which is then complete.
        if not self.folder.exists(place):
            self.folder.move(f"staging/{key}", place)
        files = self.folder.files(place)
        entry = {"key": key, "tier": tier, "files": len(files), "bytes": sum(n for _, n in files), **more}
        gone = set(replaces)

        def change(entries: list[Entry]) -> list[Entry]:
            missing = gone - {x["key"] for x in entries}
            if missing:
                raise ValueError(f"another writer has replaced {sorted(missing)}")
            return [x for x in entries if x["key"] not in gone | {key}] + [entry]

        return self._publish(change)

    def append(self, df: DataFrame, key: str, sort: tuple[str, ...] = (), spread: bool = True, **more) -> bool:
        """Stage and commit; False if the key was committed before, in which case nothing is written."""
        if self.committed(key):
            return False
        if not self.folder.exists(f"data/tier=batch/entry={key}"):
            self.stage(df, key, spread, sort)
        self.commit(key, **more)
        return True

    # Upkeep
    def _values(self, entry: Entry) -> dict[str, int]:
        """Bytes per partition folder of an entry."""
        out: dict[str, int] = {}
        for name, size in self.folder.files(f"data/tier={entry['tier']}/entry={entry['key']}"):
            out[name.rpartition("/")[0]] = out.get(name.rpartition("/")[0], 0) + size
        return out

    def compact(
        self, target: int = FILE_BYTES, least: int = 2, sort: tuple[str, ...] = (), only: Callable[[Entry], bool] | None = None
    ) -> str | None:
        """Rewrite entries of small files as one, with files of about ``target`` bytes; returns its key.

        A partition value with b bytes gets the next whole number of b / target files, so the number of files follows
        from the data and not from how often it was written to. Entries whose files are large enough stay as they are.
        """
        small = [x for x in self.entries() if x["files"] and x["bytes"] < x["files"] * target // 2 and (only is None or only(x))]
        if len(small) < least and sum(x["files"] for x in small) < 2:
            return None
        sizes: dict[str, int] = {}
        for entry in small:
            for value, size in self._values(entry).items():
                sizes[value] = sizes.get(value, 0) + size
        bins = {value: -(-size // target) for value, size in sizes.items()}
        if sum(x["files"] for x in small) <= sum(bins.values()):
            return None
        keys = {x["key"] for x in small}
        rows = self.read(only=lambda x: x["key"] in keys)
        if self.partitions:
            # The few values that need several files get tasks of their own; any other value goes whole to one task.
            place = F.concat_ws("/", *[F.concat(F.lit(f"{x}="), F.col(x).cast("string")) for x in self.partitions])
            total, first = sum(bins.values()), 0
            task = F.pmod(F.xxhash64(*self.partitions), F.lit(total))
            for value, n in bins.items():
                if n > 1:
                    within = F.pmod(F.xxhash64(*self._hashable(rows)), F.lit(n))
                    task = F.when(place == value, first + within).otherwise(task)
                first += n
            rows = rows.repartitionById(total, task.cast("int"))
        else:
            rows = rows.repartition(sum(bins.values()))
        return self.replace(small, rows, sort)

    def replace(self, entries: list[Entry], rows: DataFrame, sort: tuple[str, ...] = (), **more) -> str:
        """Put rows, as they are partitioned, in the place of entries; returns the key of the new entry."""
        key = f"packed-{uuid.uuid4().hex}"
        self.stage(rows, key, spread=False, sort=sort)
        # Entries without files only say that their key is done.
        entries = entries + [x for x in self.entries() if not x["files"]]
        # Of numbered keys only the last one is remembered, so this does not grow with the age of the table.
        covers: dict[str, int] = {}
        for entry in entries:
            for stem, number in entry.get("covers", dict([_numbered(entry["key"])])).items():
                covers[stem] = max(number, covers.get(stem, -1))
        self.commit(key, "packed", {x["key"] for x in entries}, covers=covers, **more)
        return key

    @staticmethod
    def _hashable(rows: DataFrame) -> list[Column]:
        return [F.map_entries(name) if kind.startswith("map") else F.col(name) for name, kind in rows.dtypes]

    def vacuum(self, keep: int = 2) -> int:
        """Delete folders and versions that none of the last ``keep`` versions needs; returns how many folders went.

        Run it when no reader is on an older version and streams have taken up what it removes.
        """
        known = self.versions()
        needed = {(x["tier"], x["key"]) for v in known[-keep:] for x in self.entries(v)}
        gone = 0
        for tier in ("batch", "packed"):
            for name in self.folder.names(f"data/tier={tier}"):
                key = name.removeprefix("entry=")
                # A folder that is in no version yet may be about to be committed.
                if (tier, key) not in needed and any((tier, key) == (x["tier"], x["key"]) for v in known[:-keep] for x in self.entries(v)):
                    self.folder.delete(f"data/tier={tier}/{name}")
                    gone += 1
        for version in known[:-keep]:
            self.folder.delete(f"versions/{version:012d}.json")
        return gone
