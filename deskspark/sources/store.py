"""Published tables: folders of Parquet files, and numbered pointer files of which the last one counts.

A pointer names the version that readers get. It is created whole under the next free number or not
at all, so a reader sees the old version or the new one, and of two writers that start from the same
version only one publishes. Pointers are never changed; `vacuum` removes those nobody needs any more
and the folders that only they reached.

A version may be bucketed by its key. Written whole, it is read as a table over its folder, which
tells Spark the layout, and a join on the key shuffles only the other side. A version may also
rewrite some buckets and take over the others: its pointer says under `held_in` which folder holds
which buckets. The files of untouched buckets are neither read nor written, and the whole is still
read as one bucketed table.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Collection

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTERS = "_pointers"
#: The single pointer file of stores written before pointers had numbers.
POINTER = "CURRENT"
#: What a version's folder is named by.
VERSION = "v"
ANY = "*"
#: How bucketed intermediate results are written: Parquet's second format stores ids and strings by their differences.
STAGED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
GRACE_SECONDS = 7 * 24 * 3600
_BUCKET = re.compile(r"_(\d+)(?:\..*)?$")


class PublishConflict(RuntimeError):
    """Another version was published since the one that the new version was made from."""


def bucket_of(key: str, buckets: int):
    """The bucket that Spark's bucketed writer puts a key in."""
    return F.pmod(F.hash(key), F.lit(buckets))


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self, name: str, schema: T.StructType) -> DataFrame:
        """The published version, or an empty table before the first one."""
        entry = self.pointer(name)
        return self.spark.createDataFrame([], schema) if entry is None else self.read(name, entry, schema)

    def read(self, name: str, entry: dict, schema: T.StructType, buckets: Collection[int] | None = None) -> DataFrame:
        """The version that `entry` (a pointer's content) describes, or only some of its buckets."""
        if buckets is not None:
            files = self.files(name, entry, buckets)
            return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        folder = self.folder(name, entry["version"])
        if not entry.get("buckets"):
            return self.spark.read.schema(schema).parquet(folder)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        layout = f"CLUSTERED BY ({entry['key']}) SORTED BY ({entry['key']}) INTO {entry['buckets']} BUCKETS"
        if not entry.get("held_in"):
            table = self._table(folder)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout} LOCATION '{folder}'")
            return self.spark.table(table).select(*schema.names)
        # The folders are partitions of one bucketed table; files of rewritten buckets are left out by name, before the scan.
        table = self._table(folder + json.dumps(entry["held_in"], sort_keys=True))
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {VERSION} STRING) USING parquet "
                       f"PARTITIONED BY ({VERSION}) {layout} LOCATION '{self.root}/{name}'")
        partitions = " ".join(f"PARTITION ({VERSION} = '{v}')" for v in entry["held_in"])
        self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partitions}")
        files = [f.rsplit("/", 1)[1] for f in self.files(name, entry)]
        live = F.col(VERSION).isin(*entry["held_in"]) & F.col("_metadata.file_name").isin(*files)
        return self.spark.table(table).filter(live).select(*schema.names)

    def files(self, name: str, entry: dict, buckets: Collection[int] | None = None) -> list[str]:
        """The files of a bucketed version, or those of some of its buckets."""
        wanted = None if buckets is None else set(buckets)
        found = []
        for version, held in self._held_in(entry).items():
            own = set(held) if wanted is None else set(held) & wanted
            if own:
                names = (s.getPath() for s in self._list(f"{name}/{VERSION}={version}"))
                found += [p.toString() for p in names if (m := _BUCKET.search(p.getName())) and int(m[1]) in own]
        return sorted(found)

    def changed_buckets(self, name: str, before: dict, now: dict) -> list[int] | None:
        """The buckets that version `now` holds in another folder than `before`. None if that is all of them, if the
        two cannot be compared, or if a folder with what those buckets held before is gone."""
        if not now.get("buckets") or any(before.get(k) != now.get(k) for k in ("buckets", "key")):
            return None
        then, since = ({b: v for v, own in self._held_in(e).items() for b in own} for e in (before, now))
        changed = sorted(b for b in since if then.get(b) != since[b])
        lost = any(not self._list(f"{name}/{VERSION}={v}") for v in {then[b] for b in changed if b in then})
        return None if lost or len(changed) == now["buckets"] else changed

    def write(self, name: str, df: DataFrame, version: str | None = None,
              buckets: int | None = None, key: str | None = None, codec: str | None = None) -> str:
        """Write a version nobody sees yet. A half-written folder of the same name is replaced. `codec` names a
        compression other than the session's."""
        version = version or uuid.uuid4().hex[:12]
        entry = self.pointer(name)
        if entry and version in {entry["version"], *self._held_in(entry), *entry.get("also", ())}:
            raise ValueError(f"{name}: version {version} is already published")
        folder = self.folder(name, version)
        writer = df.write.mode("overwrite").format("parquet")
        if codec:
            writer.option("compression", codec)
        if buckets:
            writer.option("path", folder).bucketBy(buckets, key).sortBy(key).saveAsTable(self._table(folder))
        else:
            writer.save(folder)
        return version

    def write_buckets(self, name: str, df: DataFrame, before: dict, touched: Collection[int], version: str | None = None,
                      codec: str | None = None) -> tuple[str, dict]:
        """Write the whole content of the buckets `touched`; the rest stays where the version `before` has it.

        Returns the version and the facts to publish it with.
        """
        version = self.write(name, df, version, before["buckets"], before["key"], codec)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(self.folder(name, version))}")  # the folder alone is not the table
        gone = set(touched)
        held = {v: sorted(set(own) - gone) for v, own in self._held_in(before).items()}
        held = {v: own for v, own in held.items() if own} | {version: sorted(gone)}
        return version, {"buckets": before["buckets"], "key": before["key"], "held_in": held}

    def publish(self, name: str, version: str, expected: str | None = ANY, **facts) -> None:
        """Make a written version the current one by creating the next pointer. Facts stand beside it; `also`
        lists further versions that belong to it.

        `expected` is the version that the new one was made from (None: there was none). If another
        was published meanwhile, nothing changes and this raises.
        """
        text = json.dumps({"version": version, **facts})
        while True:
            number = self._last_number(name)
            found = (self.pointer(name, number) or {}).get("version")
            if expected is not ANY and expected != found:
                raise PublishConflict(f"{name}: made from version {expected}, but {found} was published meanwhile")
            if self._create(f"{name}/{POINTERS}/{number + 1:012d}.json", text):
                return

    def pointer(self, name: str, number: int | None = None) -> dict | None:
        """What was published last, or under a number."""
        number = self._last_number(name) if number is None else number
        path = self._path(f"{name}/{POINTERS}/{number:012d}.json" if number else f"{name}/{POINTER}")
        fs = self._fs(path)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate result and read it back, which cuts its lineage."""
        path = f"{self.root}/_staging/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stage_buckets(self, name: str, df: DataFrame, key: str, buckets: int) -> tuple[DataFrame, str]:
        """Write an intermediate result into buckets by `key` and read it back as a bucketed table; also its folder.

        Each task writes its rows straight into the files of their buckets, by columns and compressed, which takes a
        fraction of a shuffle's disk. Joins and groupings by the key then shuffle nothing.
        """
        folder = f"{self.root}/_staging/{name}-{uuid.uuid4().hex[:12]}"
        writer = df.write.format("parquet").options(**STAGED).option("path", folder)
        writer.bucketBy(buckets, key).saveAsTable(self._table(folder))
        return self.spark.table(self._table(folder)), folder

    def drop_staged(self, folder: str) -> None:
        """Remove a bucketed intermediate result that no plan still to be run reads."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(folder)}")
        self._remove(folder[len(self.root) + 1:])

    def vacuum(self, name: str, keep: int = 1, grace_seconds: float = GRACE_SECONDS, now: float | None = None) -> list[str]:
        """Remove versions that no reader can still want; returns the removed folders.

        The last `keep` pointers stay, and so does any that was replaced less than the grace time ago,
        as readers and loads that began with it may still run. A folder goes if no pointer that stays
        reaches it and it is older than the grace time itself, as it may be a version being written.
        """
        limit = (time.time() if now is None else now) - grace_seconds
        pointers = sorted((int(s.getPath().getName().split(".")[0]), s.getModificationTime() / 1000)
                          for s in self._list(f"{name}/{POINTERS}") if s.getPath().getName().endswith(".json"))
        replaced = dict(zip((n for n, _ in pointers), [t for _, t in pointers[1:]] + [float("inf")]))
        last = {n for n, _ in pointers[-max(1, keep):]}
        staying = {n for n, _ in pointers if n in last or replaced[n] > limit}
        entries = [self.pointer(name, n) for n in sorted(staying)] or [e for e in [self.pointer(name)] if e]
        reached = {v for e in entries if e for v in (e["version"], *self._held_in(e), *e.get("also", ()))}
        for n, _ in pointers:
            if n not in staying:
                self._remove(f"{name}/{POINTERS}/{n:012d}.json")
        removed = []
        for status in self._list(name):
            folder = status.getPath().getName()
            if folder.startswith(f"{VERSION}=") and folder[2:] not in reached and status.getModificationTime() / 1000 <= limit:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(self.folder(name, folder[2:]))}")
                self._remove(f"{name}/{folder}")
                removed.append(folder)
        return sorted(removed)

    def vacuum_staging(self, grace_seconds: float = GRACE_SECONDS, now: float | None = None) -> list[str]:
        """Remove intermediate results older than the grace time, which has to exceed the longest run."""
        limit = (time.time() if now is None else now) - grace_seconds
        old = [s.getPath().getName() for s in self._list("_staging") if s.getModificationTime() / 1000 <= limit]
        for folder in old:
            self._remove(f"_staging/{folder}")
        return sorted(old)

    @staticmethod
    def _held_in(entry: dict) -> dict[str, list[int]]:
        """Which folder's version holds which buckets."""
        return entry.get("held_in") or {entry["version"]: list(range(entry.get("buckets") or 0))}

    def _last_number(self, name: str) -> int:
        """The number of the last pointer, 0 if there is none."""
        names = (s.getPath().getName() for s in self._list(f"{name}/{POINTERS}"))
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json")), default=0)

    def _create(self, relative: str, text: str) -> bool:
        """Create a file with its whole content; False if there is one of this name already."""
        jvm = self.spark._jvm
        final = self._path(relative)
        fs = self._fs(final)
        fs.mkdirs(final.getParent())
        draft = self._path(f"{relative.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.draft")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            if fs.getUri().getScheme() == "file":  # a rename would replace the file, a link does not
                local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(local(final), local(draft))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._hadoop_conf())
                context.rename(draft, final, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            fs.delete(draft, False)

    def _list(self, relative: str) -> list:
        path = self._path(relative)
        fs = self._fs(path)
        return list(fs.listStatus(path)) if fs.exists(path) else []

    def _remove(self, relative: str) -> None:
        path = self._path(relative)
        self._fs(path).delete(path, True)

    def _path(self, relative: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}")

    def _fs(self, path):
        return path.getFileSystem(self._hadoop_conf())

    def _table(self, folder: str) -> str:
        return f"deskspark_{hashlib.md5(folder.encode()).hexdigest()}"

    def folder(self, name: str, version: str) -> str:
        return f"{self.root}/{name}/{VERSION}={version}"

    def _hadoop_conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()
