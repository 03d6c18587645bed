"""Upsert by key on plain Parquet.

With an ACID catalog at hand use ``MERGE INTO``. Without one, rows live in hash buckets of their
key, each write goes to folders of its own, and a small list of the folders that count makes it
visible. A reader sees the state before or after a write, never a mix, and a write that dies is
simply not listed. One writer at a time.

The list holds the range of keys of each folder. An upsert writes its batch, reads the key columns of
folders whose range meets the batch's, and whole rows only of those that hold a key of it. Keys and
fingerprints say which stored rows stay: a bucket in which none does takes the batch's folder as it was
written, another gets the rows that are new, and only folders with a row that really changes are
rewritten. Which rows those are is known by their place in their file, as bitmaps, so whole rows are never
shuffled for it. ``changes`` gives the rows before and after, and ``rows_of``
reads only folders that hold some keys. ``compact`` joins the folders of a bucket.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hireflow.session import WRITERS, delete_paths, folder_names, path_exists, unsorted_writes

_LISTED = T.StructType(
    [
        T.StructField("kind", T.StringType()),  # whole, live, after, before
        T.StructField("step", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("part", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("text", T.StringType()),  # of the whole: schema, note, and if all was replaced
    ]
)
_PLACE_TYPE = T.StructType(
    [
        T.StructField("_v", T.LongType()),
        T.StructField("_step", T.StringType()),
        T.StructField("_part", T.StringType()),
        T.StructField("_bucket", T.IntegerType()),
    ]
)
_WHOLE, _LIVE, _AFTER, _BEFORE = "whole", "live", "after", "before"
_NEW, _CHANGED, _MATCHED, _KEPT, _WAS = "new", "changed", "matched", "kept", "was"

#: Codec of data files: hashes as hex text take half the bytes they take with the default.
CODEC = "zstd"


def write_options(*differing: str) -> dict[str, str]:
    """How data files are written. Of columns that differ from row to row a dictionary only costs time."""
    return {"compression": CODEC, **{f"parquet.enable.dictionary#{n}": "false" for n in differing}}


#: Keys that are looked for first, to see cheaply that a folder holds some.
PROBED = 10_000

#: Rows of a file that one bitmap stands for, and bitmaps that are broadcast (4 kB each).
BITMAP_ROWS, FEW_BITMAPS = 32_768, 8_192


@dataclass(frozen=True)
class Folder:
    """Rows of one write in one bucket, and the least and greatest text of their first bucket key."""

    step: str
    version: int
    part: str
    bucket: int
    low: str | None = None
    high: str | None = None
    rows: int = 0

    @property
    def path(self) -> str:
        return f"data/_v={self.version}/_step={self.step}/_part={self.part}/_bucket={self.bucket}"

    @property
    def place(self) -> tuple:
        return self.version, self.step, self.part, self.bucket

    def meets(self, other: "Folder") -> bool:
        known = None not in (self.low, self.high, other.low, other.high)
        return self.bucket == other.bucket and known and self.low <= other.high and other.low <= self.high


@dataclass(frozen=True)
class State:
    """What one version of the table consists of and what its write changed."""

    version: int
    schema: T.StructType
    live: list[Folder]
    replaced: bool = False  # everything was written anew
    note: dict = field(default_factory=dict)
    after: list[Folder] = field(default_factory=list)
    before: list[Folder] = field(default_factory=list)
    arrived: int = 0  # rows of the batch


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        bucket_by: list[str] | None = None,
        buckets: int = 64,
    ):
        """``bucket_by`` must depend on the key alone (for an event: its application)."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = keys
        self.bucket_by = bucket_by or keys
        self.buckets = buckets
        self._now: State | None = None
        self._lists: dict[int, State] = {}  # of the newest versions, as far as they were read or written

    # -- state ---------------------------------------------------------------------------------

    def _state(self) -> State | None:
        """The newest version; only its own list is read, once per object."""
        if self._now is None:
            versions = self._versions()
            self._now = self._listed(max(versions)) if versions else None
        return self._now

    def _versions(self) -> list[int]:
        """Versions whose list is complete."""
        names = folder_names(self.spark, f"{self.path}/commits", having="part-")
        return [int(name.removeprefix("_version=")) for name in names]

    def _listed(self, version: int) -> State:
        if version not in self._lists:
            self._lists[version] = self._read_list(version)
        return self._lists[version]

    def _read_list(self, version: int) -> State:
        rows = self.spark.read.schema(_LISTED).json(f"{self.path}/commits/_version={version}").collect()
        folders: dict[str, list[Folder]] = {_LIVE: [], _AFTER: [], _BEFORE: []}
        about: dict = {}
        for r in rows:
            if r.kind == _WHOLE:
                about = json.loads(r.text)
            else:
                place = (r.step, r.version, r.part, r.bucket)
                folders[r.kind].append(Folder(*place, r.low, r.high, r.rows))
        return State(
            version, T.StructType.fromJson(about["schema"]), folders[_LIVE], about["replaced"],
            about["note"], folders[_AFTER], folders[_BEFORE], about["arrived"],
        )

    def refresh(self) -> None:
        """Look at the folder again, after another session wrote to it."""
        self._now, self._lists = None, {}

    def exists(self) -> bool:
        return self._state() is not None

    def version(self) -> int:
        state = self._state()
        return 0 if state is None else state.version

    def note(self) -> dict:
        """What the writer of the newest version left with it."""
        state = self._state()
        return {} if state is None else dict(state.note)

    def counts(self, since: int = 0) -> dict[str, int]:
        """Rows the table has, and that arrived, came and went in versions after ``since``.

        From the lists alone; no data is read. A version that replaced everything counts what it wrote.
        """
        now = self._known()
        later = [self._listed(v) if v != now.version else now for v in self._versions() if v > since]
        return {
            "rows_total": _rows(now.live),
            "rows_arrived": sum(s.arrived for s in later),
            "rows_written": sum(_rows(s.live if s.replaced else s.after) for s in later),
            "rows_replaced": sum(_rows(s.before) for s in later),
        }

    def _known(self) -> State:
        state = self._state()
        if state is None:
            raise ValueError(f"no table at {self.path}")
        return state

    # -- reads ---------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        state = self._known()
        return self._read_folders(state.live, state.schema).select(*state.schema.names)

    def ranges_of(self, keys: DataFrame) -> list[Folder]:
        """Least and greatest of some keys by bucket; the same for tables bucketed alike."""
        asked = keys.withColumns({"_bucket": self._bucket(), "_part": F.lit("")})
        return [folder for folder, _ in self._described(asked, "", 0)]

    def rows_of(
        self, keys: DataFrame, column: str, ranges: list[Folder] | None = None
    ) -> DataFrame:
        """At least all rows whose ``column`` is among the keys, from folders that hold any of them.

        Only the column is read of the others whose range of keys meets that of ``keys``. ``column``
        must be what the table is bucketed by. ``ranges`` are those of the keys, if known.
        """
        if self.bucket_by != [column]:
            raise ValueError(f"{self.path} is not bucketed by {column}")
        state = self._known()
        asked = keys.select(column)
        ranges = self.ranges_of(asked) if ranges is None else ranges
        held = self._holding(_near(state.live, ranges), state.schema, asked, [column], _rows(ranges))
        return self._read_folders(held, state.schema).select(*state.schema.names)

    def changes(self, since: int) -> DataFrame | None:
        """Rows that came (``_change`` is 1) and went (-1) after a version.

        None if all were replaced, or if some of them are deleted (see ``clear``).
        """
        now = self._known()
        later = [self._listed(v) if v != now.version else now for v in self._versions() if v > since]
        if since > now.version or any(s.replaced for s in later):
            return None
        moved = [f for s in later for f in (*s.after, *s.before)]
        if not all(path_exists(self.spark, f"{self.path}/{f.path}") for f in moved):
            return None
        frames = [
            self._read_folders([f for s in later for f in getattr(s, kind)], now.schema).select(
                *now.schema.names, F.lit(sign).alias("_change")
            )
            for kind, sign in ((_AFTER, 1), (_BEFORE, -1))
        ]
        return frames[0].unionByName(frames[1])

    def _read_folders(self, folders: list[Folder], schema: T.StructType) -> DataFrame:
        stored = T.StructType([*schema.fields, *_PLACE_TYPE.fields])
        if not folders:
            return self.spark.createDataFrame([], stored)
        return (
            self.spark.read.schema(stored)
            .option("basePath", f"{self.path}/data")
            .parquet(*[f"{self.path}/{f.path}" for f in folders])
        )

    def _holding(
        self, folders: list[Folder], schema: T.StructType, keys: DataFrame, columns: list[str], count: int
    ) -> list[Folder]:
        """The folders that hold any of the ``count`` keys. Of the folders only the key columns are read.

        Most folders hold one of a few keys already, which need no shuffle; all keys are looked up in the others.
        """
        places, hit = list(_PLACE_TYPE.names), set()
        keys = keys.select(*columns).dropna()
        one_of = max(1, count // PROBED)
        few = F.broadcast(keys.filter(F.pmod(F.xxhash64(*columns, F.lit("probe")), F.lit(one_of)) == 0))
        for asked in [few] if one_of == 1 else [few, keys]:
            left = [f for f in folders if f.place not in hit]
            if left:
                stored = self._read_folders(left, schema).select(*columns, *places)
                found = stored.join(asked, columns, "left_semi").select(*places).distinct()
                hit |= {tuple(row) for row in found.collect()}
        return [f for f in folders if f.place in hit]

    # -- writes --------------------------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def _described(self, rows: DataFrame, step: str, version: int, *more: Column) -> list[tuple]:
        """By part and bucket the range of the first bucket key, with other aggregates.

        A row for each bucket, two after a rewrite.
        """
        key = F.col(self.bucket_by[0]).cast("string")
        each = [F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")]
        found = rows.groupBy("_part", "_bucket").agg(*each, *more).collect()
        return [(Folder(step, version, r._part, r._bucket, r.low, r.high, r.n), r) for r in found]

    def _write(self, df: DataFrame, version: int, step: str, spread: bool | None = None) -> list[tuple]:
        """Write rows by ``_part`` and ``_bucket``; returns the folders that got rows, and aggregates.

        Rows that come from folders without a shuffle lie together already: no need to ``spread`` them.
        Where a task can write to all buckets at once, they are not shuffled only to lie together.
        """
        target = f"{self.path}/data/_v={version}/_step={step}"
        spread = self.buckets > WRITERS if spread is None else spread
        placed = df.hint("rebalance", "_part", "_bucket") if spread else df
        differing = [n for n in (*self.keys, "_record_hash") if n not in self.bucket_by]
        with unsorted_writes(self.spark):
            placed.write.partitionBy("_part", "_bucket").mode("overwrite").options(
                **write_options(*differing)
            ).parquet(target)
        # Some input may be empty, so ask what was written; only the columns asked for are read.
        places = {"_part": T.StringType(), "_bucket": T.IntegerType()}
        schema = [T.StructField(f.name, places.get(f.name, f.dataType)) for f in df.schema]
        written = self.spark.read.schema(T.StructType(schema)).parquet(target)
        return self._described(written, step, version)

    def _commit(self, state: State) -> None:
        """One task writes one file, which appears as a whole."""
        whole = {"schema": state.schema.jsonValue(), "replaced": state.replaced, "note": state.note,
                 "arrived": state.arrived}
        rows = [{"kind": _WHOLE, "text": json.dumps(whole)}] + [
            asdict(folder) | {"kind": kind}
            for kind, folders in ((_LIVE, state.live), (_AFTER, state.after), (_BEFORE, state.before))
            for folder in folders
        ]
        parsed = F.from_json(F.lit(json.dumps(rows)), T.ArrayType(_LISTED))
        self.spark.range(0, 1, 1, 1).select(F.inline(parsed)).write.mode("overwrite").json(
            f"{self.path}/commits/_version={state.version}"
        )
        self._now = state
        self._lists = {v: s for v, s in self._lists.items() if v >= state.version - 2} | {state.version: state}

    def overwrite(self, df: DataFrame, note: dict | None = None) -> None:
        """Replace everything."""
        version = self.version() + 1
        rows = df.withColumns({"_part": F.lit(_NEW), "_bucket": self._bucket()})
        live = [folder for folder, _ in self._write(rows, version, _NEW)]
        note = self.note() if note is None else note
        state = State(version, _nullable(df.schema), live, True, note, arrived=_rows(live))
        self._commit(state)

    def upsert(
        self,
        batch: DataFrame,
        ignore: tuple[str, ...] = (),
        newer_by: str | None = None,
        note: dict | None = None,
    ) -> None:
        """Rows whose key is in the batch are replaced, other keys stay, new keys are added.

        A stored row is kept when it differs in nothing but the columns to ignore, and when its
        ``newer_by`` is above that of the batch's row. Keys must be unique in the batch; a NULL key
        matches nothing. The batch is computed once.
        """
        state = self._state()
        if state is None:
            return self.overwrite(batch, note)
        version, schema = state.version + 1, _nullable(batch.schema)
        rows = batch.withColumns({"_part": F.lit(_NEW), "_bucket": self._bucket()})
        arrived = [folder for folder, _ in self._write(rows, version, _NEW)]
        note = state.note if note is None else note
        if not arrived:
            if note != state.note:
                self._commit(State(version, state.schema, state.live, False, note))
            return
        incoming = self._read_folders(arrived, schema)
        held = self._holding(_near(state.live, arrived), schema, incoming, self.keys, _rows(arrived))
        gained, was, kept, gone = arrived, [], [], set()
        if held:
            matched = self._matched(incoming, held, schema, ignore, newer_by, version)
            by_file = matched.groupBy("was_file").agg(
                F.count_if("stays").alias("stays"), F.count_if(~F.col("stays")).alias("goes")
            ).collect()
            place_of = self._places(held, schema)
            stays: dict[int, int] = {}
            for r in by_file:
                bucket = place_of[r.was_file][-1]
                stays[bucket] = stays.get(bucket, 0) + r.stays
            gained = [f for f in arrived if not stays.get(f.bucket)]
            mixed = [f for f in arrived if 0 < stays.get(f.bucket, 0) < f.rows]
            if mixed:
                same = matched.filter("stays").select(F.col("is_file").alias("file"), F.col("is_row").alias("row"))
                rest, few = self._marked(mixed, schema, same)
                rest = rest.filter(~F.col("_marked")).select(*schema.names, "_bucket", F.lit(_NEW).alias("_part"))
                gained += [folder for folder, _ in self._write(rest, version, _CHANGED, spread=False if few else None)]
            hit = {place_of[r.was_file] for r in by_file if r.goes}
            gone = {f for f in held if f.place in hit}
            if gone:
                going = matched.filter("not stays").select(F.col("was_file").alias("file"), F.col("was_row").alias("row"))
                split, few = self._marked([f for f in held if f in gone], schema, going)
                part = F.when(F.col("_marked"), _WAS).otherwise(_KEPT)
                split = split.select(*schema.names, "_bucket", part.alias("_part"))
                left = [folder for folder, _ in self._write(split, version, _KEPT, spread=False if few else None)]
                kept, was = [f for f in left if f.part == _KEPT], [f for f in left if f.part == _WAS]
        live = [f for f in state.live if f not in gone] + gained + kept
        self._commit(State(version, schema, live, False, note, gained, was, _rows(arrived)))
        # only this write knew of the batch's folders whose rows it wrote again or found stored
        used = set(gained)
        delete_paths(self.spark, [f"{self.path}/{f.path}" for f in arrived if f not in used])

    def _matched(
        self, incoming: DataFrame, held: list[Folder], schema: T.StructType, ignore: tuple[str, ...],
        newer_by: str | None, version: int,
    ) -> DataFrame:
        """Incoming keys that are stored: where both rows are, and whether the stored row stays.

        Written, as it is asked often.
        """
        compared = [f for f in schema if f.name not in (*self.keys, *ignore)]

        def narrow(rows: DataFrame, name: str) -> DataFrame:
            about = {f"{name}_file": _file(), f"{name}_row": F.col("_metadata.row_index"), **{
                f"{name}_{half}": hashed for half, hashed in _fingerprint(compared).items()}}
            if newer_by:
                about[f"{name}_at"] = F.col(newer_by)
            return rows.select(*self.keys, *[value.alias(column) for column, value in about.items()])

        known, asked = narrow(self._read_folders(held, schema), "was"), narrow(incoming, "is")
        stays = (F.col("is_low") == F.col("was_low")) & (F.col("is_high") == F.col("was_high"))
        if newer_by:
            # a row received before the stored one does not replace it
            stays = stays | F.coalesce(F.col("is_at") < F.col("was_at"), F.lit(False))
        matched = asked.join(known, self.keys).select(
            stays.alias("stays"), "is_file", "is_row", "was_file", "was_row"
        )
        path = f"{self.path}/data/_v={version}/_step={_MATCHED}"
        with unsorted_writes(self.spark):
            matched.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(matched.schema).parquet(path)

    def _marked(
        self, folders: list[Folder], schema: T.StructType, rows: DataFrame
    ) -> tuple[DataFrame, bool]:
        """Rows of some folders, with ``_marked`` for those at the given places (``file``, ``row``).

        The places become bitmaps, which are broadcast unless they are very many; then the flag of the
        answer is false, and rows may have been shuffled to them.
        """
        chunk = F.floor(F.col("row") / F.lit(BITMAP_ROWS)).cast("bigint")
        maps = rows.groupBy("file", chunk.alias("chunk")).agg(
            F.bitmap_construct_agg(F.col("row") % F.lit(BITMAP_ROWS)).alias("bits")
        ).select(F.col("file").alias("_file"), F.col("chunk").alias("_chunk"), _words(F.col("bits")).alias("_words"))
        stored, at = self._read_folders(folders, schema), F.col("_metadata.row_index")
        few = _rows(folders) // BITMAP_ROWS + len(stored.inputFiles()) <= FEW_BITMAPS
        placed = stored.select(
            *schema.names, "_bucket", _file().alias("_file"),
            F.floor(at / F.lit(BITMAP_ROWS)).cast("bigint").alias("_chunk"),
            (at % F.lit(BITMAP_ROWS)).cast("int").alias("_bit"),
        )
        joined = placed.join(F.broadcast(maps) if few else maps, ["_file", "_chunk"], "left")
        marked = F.expr("shiftright(get(_words, shiftright(_bit, 5)), 24 - (_bit & 24) + (_bit & 7)) & 1") != 0
        return joined.select(
            *schema.names, "_bucket", F.coalesce(marked, F.lit(False)).alias("_marked")
        ), few

    def _places(self, folders: list[Folder], schema: T.StructType) -> dict[int, tuple]:
        """The folder that each file lies in, by its number; no column is read."""
        files = self._read_folders(folders, schema).select(_file().alias("file"), *_PLACE_TYPE.names)
        return {r.file: tuple(r)[1:] for r in files.distinct().collect()}

    def clear(self, since: int | None = None) -> None:
        """Delete folders that neither of the newest two versions reads, and what writes left aside.

        For after each write: older lists than those of the newest three versions, or ``since``, are not
        looked at. A reader of the version before the newest goes on. Changes after ``since`` stay, by
        default those of the newest version. All lists stay, so figures of all versions do.
        """
        state = self._state()
        if state is None:
            return
        since = state.version - 1 if since is None else since
        versions = [v for v in self._versions() if v >= min(state.version - 2, since) and v < state.version]
        listed = [*map(self._listed, sorted(versions)), state]
        kept = {f.place for s in listed[-2:] for f in s.live}
        kept |= {f.place for s in listed if s.version > since for f in (*s.after, *s.before)}
        gone = {f.path for s in listed for f in (*s.live, *s.after, *s.before) if f.place not in kept}
        aside = [f"data/_v={s.version}/_step={_MATCHED}" for s in listed]
        delete_paths(self.spark, [f"{self.path}/{path}" for path in [*sorted(gone), *aside]])

    def compact(self, max_folders: int = 1) -> int:
        """Rewrite buckets spread over more than ``max_folders`` folders; returns how many."""
        state = self._state()
        by_bucket: dict[int, list[Folder]] = {}
        for folder in state.live if state else []:
            by_bucket.setdefault(folder.bucket, []).append(folder)
        scattered = [f for group in by_bucket.values() if len(group) > max_folders for f in group]
        if not scattered:
            return 0
        rows = self._read_folders(scattered, state.schema).select(
            *state.schema.names, "_bucket", F.lit(_NEW).alias("_part")
        )
        joined = [folder for folder, _ in self._write(rows, state.version + 1, _NEW, spread=True)]
        gone = set(scattered)
        live = [f for f in state.live if f not in gone] + joined
        self._commit(State(state.version + 1, state.schema, live, False, state.note))
        return len(joined)


def _rows(folders: list[Folder]) -> int:
    return sum(f.rows for f in folders)


def _file() -> Column:
    """A number for the file of a row; two among many thousand files share one with a chance of 1e-10."""
    return F.xxhash64("_metadata.file_path")


def _words(bits: Column) -> Column:
    """A bitmap as numbers of four bytes, the first byte the highest; single ones are read without a copy."""

    def word(i: Column) -> Column:
        number = F.conv(F.hex(F.substring(bits, i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
        return (number - F.when(number >= 1 << 31, F.lit(1 << 32)).otherwise(F.lit(0))).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(BITMAP_ROWS // 32 - 1)), word)


def _near(folders: list[Folder], ranges: list[Folder]) -> list[Folder]:
    """Folders whose range of keys meets one in the same bucket."""
    by_bucket: dict[int, list[Folder]] = {}
    for r in ranges:
        by_bucket.setdefault(r.bucket, []).append(r)
    return [f for f in folders if any(f.meets(r) for r in by_bucket.get(f.bucket, []))]


def _fingerprint(fields: list[T.StructField]) -> dict[str, Column]:
    """128 bits of the values, in halves: microseconds count, and NULL equals NULL only."""
    parts: list[Column] = [F.lit(0)]
    for f in fields:
        col = F.col(f.name)
        parts.append(col.isNull())
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.AtomicType):
            parts.append(F.size(col))
            col = F.transform(col, lambda x: F.struct(x.isNull(), x))
        elif not isinstance(f.dataType, T.AtomicType):
            col = F.to_json(F.struct(col), {"ignoreNullFields": "false"})
        parts.append(col)
    return {half: F.xxhash64(F.lit(seed), *parts) for seed, half in enumerate(("low", "high"), 1)}


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
