"""Where documents, lists and late fields lie: versioned tables of plain parquet.

A table is a set of *loads*, each a folder that is written once under a name of
its own, dealt into buckets by repository (``bucket=…`` folders, so a run about
some repositories reads only their buckets). A *version* is a small note that
lists the loads that count, in order. Versions are numbered and each number can
be taken once: who finds it taken looks at what the other writer has added and
tries the next one. So a load counts whole or not at all, a crash leaves
nothing that is read, and of two runs at once none loses rows.

Rows of lists and late fields replace older ones of their parent: the keys
replaced are noted beside the load and hide the older rows. What is loaded
again unchanged is not kept. ``compact`` rewrites a table without hidden rows,
``vacuum`` deletes the folders that no longer count.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from prflow import schemas
from prflow.operators import project
from prflow.operators.flatten import PAGES_PER_SEGMENT
from prflow.operators.joins import fits_broadcast, lookup_join
from prflow.plans.files import Files
from prflow.plans.loads import default_deleted
from prflow.sinks import keyed
from prflow.sources.pages import PLACE, landed_files, landed_schema, parse_files, with_place

BUCKETS = 64
# a version note that stays unreadable for so long was left by a crash: void
VOID_SECONDS = 10
COMPACT_FROM = 32


class Version(NamedTuple):
    number: int
    last: int  # highest number taken, void notes included
    loads: tuple[str, ...]
    replacing: tuple[str, ...]  # the loads with notes about older rows
    content: int  # grows with every change, not with compaction


def _with_notes(schema: StructType) -> StructType:
    """What is stored of rows that can be replaced: beside them a digest, which
    tells whether they have changed, and the number of their items."""
    notes = [StructField("digest", StringType())]
    notes += [StructField("n_items", IntegerType())] if "items" in schema.names else []
    return StructType([*schema.fields, *notes])


def _notes(schema: StructType, key: str) -> dict[str, Column]:
    values = [c for c in schema.names if c != key]
    notes = {"digest": F.concat_ws("-", F.xxhash64(*values), F.xxhash64(F.lit(1), *values))}
    if "items" in schema.names:
        notes["n_items"] = F.size("items")
    return notes


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        self.seen: dict[str, Version] = {}  # versions this store has read
        self.read: set[str] = set()  # tables read and written since forget()
        self.wrote: set[str] = set()

    def forget(self) -> None:
        self.read, self.wrote = set(), set()

    # -- versions

    def _note(self, name: str, number: int) -> str:
        return f"{self.root}/{name}/versions/{number:08d}.json"

    def version(self, name: str) -> Version:
        """The newest version of a table."""
        notes = self.files.names(f"{self.root}/{name}/versions")
        numbers = [int(note.split(".")[0]) for note in notes]
        for number in reversed(numbers):
            until = time.monotonic() + VOID_SECONDS
            while (found := self.files.read(self._note(name, number))) is None and time.monotonic() < until:
                time.sleep(0.1)
            if found is not None:
                return Version(number, numbers[-1], tuple(found["loads"]), tuple(found["replacing"]), found["content"])
        return Version(0, max(numbers, default=0), (), (), 0)

    def _pinned(self, name: str) -> Version:
        """The newest version, kept in mind as what later writes build on."""
        self.read.add(name)
        self.seen[name] = self.version(name)
        return self.seen[name]

    def _take(self, name: str, base: Version, loads: Sequence[str], replacing: Sequence[str], content: int) -> bool:
        """Make the version after ``base``; False if there is another one."""
        newest = self.version(name)
        if newest.number != base.number:
            return False
        state = {"loads": list(loads), "replacing": list(replacing), "content": content}
        if not self.files.create(self._note(name, newest.last + 1), state):
            return False
        self.seen[name] = Version(newest.last + 1, newest.last + 1, tuple(loads), tuple(replacing), content)
        return True

    # -- loads

    def _folder(self, name: str, load: str) -> str:
        return f"{self.root}/{name}/rows/load={load}"

    def _write(self, name: str, rows: DataFrame, key: Column | None, notes: dict[str, Column] | None = None) -> str:
        """Rows as a new load, dealt by bucket; large buckets are split. The
        ``notes`` are added where the rows arrive, not carried there."""
        load = uuid.uuid4().hex
        if key is None:
            rows.write.parquet(self._folder(name, load))
            return load
        dealt = rows.withColumn("bucket", bucket_of(key)).hint("rebalance", "bucket").withColumns(notes or {})
        order = [c for c in ("repository_id", "parent_id", "id") if c in rows.columns]
        dealt.sortWithinPartitions("bucket", *order).write.partitionBy("bucket").parquet(self._folder(name, load))
        return load

    def _load_rows(self, name: str, schema: StructType, loads: Sequence[str]) -> DataFrame:
        """Rows of the loads, with ``load`` and ``bucket``."""
        whole = StructType([*schema.fields, StructField("load", StringType()), StructField("bucket", IntegerType())])
        if not loads:
            return self.spark.createDataFrame([], whole)
        reader = self.spark.read.schema(whole).option("basePath", f"{self.root}/{name}/rows")
        return reader.parquet(*[self._folder(name, load) for load in loads])

    def _rows(self, name: str, schema: StructType, key: str | None, version: Version) -> DataFrame:
        """Rows that count in a version."""
        rows = self._load_rows(name, schema, version.loads)
        if key is None or not version.replacing:
            return rows
        notes = self.spark.read.schema(f"{key} string, load string").parquet(
            *[f"{self.root}/{name}/replaced/{load}" for load in version.replacing]
        )
        return keyed.without_replaced(rows, notes, [key, "load"])

    def _current(self, name: str, schema: StructType, key: str | None, buckets: Sequence[int] | None) -> DataFrame:
        rows = self._rows(name, schema, key, self._pinned(name))
        if buckets is not None and len(buckets) < BUCKETS:
            rows = rows.filter(F.col("bucket").isin(*buckets) if buckets else F.lit(False))
        return rows.select(*schema.names)

    def _is_empty(self, name: str, load: str) -> bool:
        """A load without a bucket has no rows."""
        return not any(part.startswith("bucket=") for part in self.files.names(self._folder(name, load)))

    def _drop(self, name: str, *loads: str) -> None:
        """Folders that never counted, or no longer do."""
        for load in loads:
            self.files.delete(self._folder(name, load))
            self.files.delete(f"{self.root}/{name}/replaced/{load}")

    # -- tables that only grow

    def _append(
        self, name: str, schema: StructType, rows: DataFrame, bucket_key: Column | None, key: str = "id"
    ) -> None:
        """Add rows whose keys are new in the version they were computed from.
        If another writer was faster, those it has added are left out."""
        self.wrote.add(name)
        base = self.seen.get(name) or self.version(name)
        load = self._write(name, rows.select(*schema.names), bucket_key)
        while True:
            if bucket_key is not None and self._is_empty(name, load):
                return self._drop(name, load)
            if self._take(name, base, [*base.loads, load], base.replacing, base.content + 1):
                return
            newest = self.version(name)
            added = [one for one in newest.loads if one not in base.loads]
            known = self._load_rows(name, schema, added).select(key)
            fewer = self._load_rows(name, schema, [load]).select(*schema.names).join(known, key, "left_anti")
            again = self._write(name, fewer, bucket_key)
            self._drop(name, load)
            base, load = newest, again

    # -- tables whose rows replace older ones of their key

    def _put(
        self, name: str, schema: StructType, key: str, new: DataFrame, bucket_key: Column, ready: bool = False
    ) -> None:
        """Keys in ``new`` get these rows and no others. Keys whose rows are
        the same as before are left as they are.

        Rows that are compared first cross no exchange for that: they are set
        aside as they come (unless ``ready``: they lie in files already, and can
        be read again), and only those that differ are dealt by bucket."""
        self.wrote.add(name)
        kept, notes = _with_notes(schema), _notes(schema, key)
        new = new.select(*schema.names)
        load, aside = None, []
        if not self.version(name).loads:
            load = self._write(name, new, bucket_key, notes)
        elif ready:
            rows = new
        else:
            aside.append(uuid.uuid4().hex)
            new.write.parquet(self._folder(name, aside[0]))
            rows = self._load_rows(name, schema, aside).select(*schema.names)
        while True:
            if load is not None and self._is_empty(name, load):
                return self._drop(name, load, *aside)
            base = self.version(name)
            if base.loads:
                if load is None:
                    older = self._beside(name, kept, key, base, rows, bucket_key)
                else:
                    rows = self._load_rows(name, schema, [load]).select(*schema.names)
                    older = self._same_buckets(name, kept, key, base, load)
                aside.append(uuid.uuid4().hex)
                self._changed(rows.withColumns(notes), older, key).write.parquet(self._folder(name, aside[-1]))
                changed = self._load_rows(name, StructType([schema[key]]), aside[-1:]).select(key)
                if changed.isEmpty():
                    return self._drop(name, *([load] if load else []), *aside)
                again = self._write(name, rows.join(changed, key, "left_semi").select(*schema.names), bucket_key, notes)
                hidden = older.select(key, "load").join(changed, key, "left_semi").distinct()
                hidden.write.parquet(f"{self.root}/{name}/replaced/{again}")
                self._drop(name, *([load] if load else []), *aside)
                load, aside = again, []
            if self._take(name, base, [*base.loads, load], [*base.replacing, *([load] if base.loads else [])], base.content + 1):
                return

    def _same_buckets(self, name: str, schema: StructType, key: str, version: Version, load: str) -> DataFrame:
        """Rows of a version in the buckets a load has rows in: its folders."""
        parts = self.files.names(self._folder(name, load))
        numbers = [int(part.split("=")[1]) for part in parts if part.startswith("bucket=")]
        return self._rows(name, schema, key, version).filter(F.col("bucket").isin(*numbers))

    def _beside(
        self, name: str, schema: StructType, key: str, version: Version, rows: DataFrame, bucket_key: Column
    ) -> DataFrame:
        """The same for rows that are not dealt yet: at most BUCKETS numbers."""
        numbers = [row.bucket for row in rows.select(bucket_of(bucket_key).alias("bucket")).distinct().collect()]
        return self._rows(name, schema, key, version).filter(F.col("bucket").isin(*numbers) if numbers else F.lit(False))

    def put_first(self, name: str, rows: DataFrame, order: Sequence[str], key: str = "id") -> None:
        """Of each key the row that is first in ``order`` is stored, also if a
        later one was stored before; whoever calls it in whatever portions gets
        the same table. Only buckets with keys of ``rows`` are read."""
        schema = rows.schema
        first = keyed.first_versions(rows, [key], [*order, F.xxhash64(*schema.names)])
        numbers = sorted(r.b for r in first.select(bucket_of(F.col(key)).alias("b")).distinct().collect())
        if not numbers:
            return
        stored = self._rows(name, schema, key, self.version(name)).filter(F.col("bucket").isin(*numbers))
        place = F.struct(*order)
        older = stored.select(key, place.alias("_older"))
        better = first.join(older, key, "left").filter(F.col("_older").isNull() | (place < F.col("_older")))
        self._put(name, schema, key, better.drop("_older"), F.col(key))

    @staticmethod
    def _changed(new: DataFrame, older: DataFrame, key: str) -> DataFrame:
        """Keys of ``new`` whose rows differ: only keys and digests are read.
        What is compared is, of each key, the number of rows and the sums of
        three 32-bit hashes of their digests, which add up before the one
        exchange. A small load is broadcast to the older rows."""
        if fits_broadcast(new.select(key)):
            older = older.join(new.select(key).distinct(), key, "left_semi")
        digest = F.xxhash64("digest")
        parts = {
            "one": F.lit(1), "low": digest.bitwiseAND(F.lit(0xFFFF_FFFF)), "high": F.shiftright(digest, 32),
            "other": F.xxhash64(F.lit(1), "digest").bitwiseAND(F.lit(0xFFFF_FFFF)),
        }

        def side(rows: DataFrame, sign: int) -> DataFrame:
            numbers = [(F.lit(sign) * part).cast("long").alias(c) for c, part in parts.items()]
            return rows.filter(F.col(key).isNotNull()).select(key, *numbers, F.lit(sign).alias("side"))

        sums = side(new, 1).unionByName(side(older, -1)).groupBy(key).agg(
            *[F.sum(c).alias(c) for c in parts], F.max("side").alias("side")
        )
        return sums.filter("side = 1 and (one <> 0 or low <> 0 or high <> 0 or other <> 0)").select(key)

    # -- documents

    def documents(self, object_type: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """Documents without their lists and late fields, of some buckets."""
        schema = schemas.document_schema(object_type)
        return self._current(f"documents/{object_type}", schema, None, buckets)

    def buckets_of(self, repositories: DataFrame) -> list[int]:
        """Buckets that hold rows of the repositories (id): at most BUCKETS numbers."""
        found = repositories.select(bucket_of(F.col("id")).alias("bucket")).distinct().collect()
        return sorted(row.bucket for row in found)

    def append(self, object_type: str, documents: DataFrame) -> None:
        schema = schemas.document_schema(object_type)
        owner = F.coalesce("repository_id", "id") if "repository_id" in schema.names else F.col("id")
        self._append(f"documents/{object_type}", schema, documents, owner)

    def replace_repositories(self, make: Callable[[DataFrame], DataFrame]) -> None:
        """Repositories become ``make(stored)``, made again if another writer
        was faster."""
        name, schema = "documents/REPOSITORY", schemas.document_schema("REPOSITORY")
        self.wrote.add(name)
        while True:
            base = self.version(name)
            stored = self._rows(name, schema, None, base).select(*schema.names)
            load = self._write(name, make(stored).select(*schema.names), F.col("id"))
            rows = self._load_rows(name, schema, [load]).select(*schema.names)
            if base.loads and rows.exceptAll(stored).isEmpty() and stored.exceptAll(rows).isEmpty():
                return self._drop(name, load)
            if self._take(name, base, [load], [], base.content + 1):
                return
            self._drop(name, load)

    # -- lists and late fields

    def lists(self, object_type: str, field: str, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = schemas.list_schema(object_type, field)
        return self._current(f"lists/{object_type}.{field}", schema, "parent_id", buckets)

    def list_sizes(self, object_type: str, field: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """The lists without their items: (repository_id, parent_id, segment, n_items)."""
        keys = ["repository_id", "parent_id", "segment"]
        schema = schemas.list_schema(object_type, field)
        narrow = StructType([*[schema[k] for k in keys], StructField("n_items", IntegerType())])
        return self._current(f"lists/{object_type}.{field}", narrow, "parent_id", buckets)

    def put_lists(self, object_type: str, field: str, new: DataFrame, ready: bool = False) -> None:
        """Lists of the parents in ``new`` are replaced whole, all others kept.
        ``ready`` says that ``new`` lies in files and is cheap to read again."""
        schema = schemas.list_schema(object_type, field)
        owner = F.coalesce("repository_id", "parent_id")
        self._put(f"lists/{object_type}.{field}", schema, "parent_id", new, owner, ready)

    def late(self, object_type: str, field: str) -> DataFrame:
        """(id, field) of the documents that were evaluated."""
        if field == "is_deleted":
            return project.deleted_parents(self.lists(object_type, "edits"))
        schema = schemas.late_schema(object_type, field)
        return self._current(f"late/{object_type}.{field}", schema, "id", None)

    def put_late(self, object_type: str, field: str, new: DataFrame) -> None:
        schema = schemas.late_schema(object_type, field)
        self._put(f"late/{object_type}.{field}", schema, "id", new, F.col("id"))

    # -- landed pages, parsed once

    def convert_pages(self, landing: str, shape: str) -> None:
        """Parse the landed files of a shape that were not parsed before. They
        are kept here, failed pages too, with the file they came from."""
        name, schema = f"pages/{shape}", landed_schema(shape)
        self._pinned(name)
        landed = landed_files(self.spark, landing, shape)
        known = self._load_rows(name, schema, self.seen[name].loads).select(F.col("landed_file").alias("path"))
        new = [row.path for row in landed.join(known.distinct(), "path", "left_anti").collect()]  # names only
        if new:
            self._append(name, schema, parse_files(self.spark, shape, new), None, "landed_file")

    def landed_pages(self, shape: str) -> DataFrame:
        """All parsed pages of a shape with their outcome, and where they lie."""
        name, schema = f"pages/{shape}", landed_schema(shape)
        version = self.version(name)
        if not version.loads:
            kinds = zip(PLACE, ("string", "long"))
            return self.spark.createDataFrame([], schema).withColumns({c: F.lit(None).cast(t) for c, t in kinds})
        return with_place(self._load_rows(name, schema, version.loads)).select(*schema.names, *PLACE)

    def page_shapes(self) -> list[str]:
        return self.files.names(f"{self.root}/pages")

    # -- upkeep

    def _tables(self) -> list[tuple[str, StructType, str | None, Column]]:
        tables = []
        for kind in schemas.OBJECT_TYPES:
            schema = schemas.document_schema(kind)
            owner = F.coalesce("repository_id", "id") if "repository_id" in schema.names else F.col("id")
            tables.append((f"documents/{kind}", schema, None, owner))
            for field in schemas.LIST_FIELDS.get(kind, {}):
                schema = schemas.list_schema(kind, field)
                tables.append((f"lists/{kind}.{field}", schema, "parent_id", F.coalesce("repository_id", "parent_id")))
            for field in set(schemas.LATE_FIELDS.get(kind, {})) - {"is_deleted"}:
                tables.append((f"late/{kind}.{field}", schemas.late_schema(kind, field), "id", F.col("id")))
        return tables

    def compact(self, from_loads: int = COMPACT_FROM) -> list[str]:
        """Tables of so many loads become one load without hidden rows. Names
        the tables; one that is being written meanwhile waits for next time."""
        done = []
        for name, schema, key, owner in self._tables():
            base = self.version(name)
            if len(base.loads) < max(2, from_loads):
                continue
            rows = self._rows(name, schema, key, base).select(*schema.names)
            load = self._write(name, rows, owner, _notes(schema, key) if key else None)
            if self._take(name, base, [load], [], base.content):
                done.append(name)
            else:
                self._drop(name, load)
        return done

    def vacuum(self) -> int:
        """Delete loads and notes of versions that no longer count. Not to be
        run while something reads an older version."""
        gone = 0
        for name, *_ in self._tables():
            newest = self.version(name)
            once = set()
            for note in self.files.names(f"{self.root}/{name}/versions"):
                if int(note.split(".")[0]) < newest.number:
                    once |= set((self.files.read(f"{self.root}/{name}/versions/{note}") or {"loads": []})["loads"])
                    self.files.delete(f"{self.root}/{name}/versions/{note}")
            old = sorted(once - set(newest.loads))
            self._drop(name, *old)
            gone += len(old)
        return gone

    # -- whole documents

    def with_late(self, object_type: str) -> DataFrame:
        """Documents with their late fields; NULL where never evaluated."""
        documents = self.documents(object_type)
        for field in schemas.LATE_FIELDS.get(object_type, {}):
            documents = keyed.set_fields(documents, self.late(object_type, field), [field])
        return default_deleted(documents, object_type)

    def _in_segments(self, object_type: str, field: str) -> DataFrame:
        """(id, segment, list) with segments of the same pages for every field:
        edits are stored page by page."""
        rows = self.lists(object_type, field).withColumnRenamed("parent_id", "id")
        if field == "edits":
            page = F.struct("segment", "items")
            rows = rows.groupBy("id", F.floor(F.col("segment") / PAGES_PER_SEGMENT).alias("part")).agg(
                F.array_sort(F.collect_list(page)).alias("pages")
            ).select("id", F.col("part").alias("segment"), F.flatten(F.col("pages")["items"]).alias("items"))
        return rows.select("id", "segment", F.col("items").alias(field))

    def whole(self, object_type: str) -> DataFrame:
        """Documents with late fields and lists: one row per document and
        segment. Nearly every document is one row with ``segment`` 0; a list
        longer than a segment continues in further rows."""
        documents = self.with_late(object_type)
        fields = schemas.LIST_FIELDS.get(object_type, {})
        if not fields:
            return documents.withColumn("segment", F.lit(0).cast("bigint"))
        spine = documents.select("id", F.lit(0).cast("bigint").alias("segment"))
        lists = {field: self._in_segments(object_type, field) for field in fields}
        for table in lists.values():
            spine = spine.unionByName(table.filter(F.col("segment") > 0).select("id", "segment"))
        whole = spine.distinct()
        for field, table in lists.items():
            whole = whole.join(table, ["id", "segment"], "left").withColumn(
                field, F.coalesce(field, F.array().cast(table.schema[field].dataType))
            )
        return lookup_join(whole, documents, ["id"], spread=["segment"], how="inner")
