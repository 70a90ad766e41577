"""Recordings as SQLite bag files (tables topics, messages and, in later versions, message_definitions; CDR payloads), as a
data source that reads and writes them.

    register(spark)
    spark.read.format("bags").option("topics", "/chassis").load(folder)  ->  file, topic, timestamp, message

Planning: the files below the folder (three folders deep at most, hidden ones left out) are listed, and with topics or times given, by
options or by filters that Spark pushes down, each file's topic table and time range are looked at; a file that can't hold
a row is no partition. The others are a partition each, which reads by its own SQL only the messages that are asked for. Columns
that are asked for reach the reader as a schema: without ``message`` payloads are neither read nor decoded.

Decoding: the definition that the file embeds (or the option ``definition``) becomes a layout. Messages of fixed size are
decoded together by one structured numpy type; only those with texts or lists are walked through one by one.

The folder must be mounted on all machines under one path (SQLite needs files).

Edge cases: an empty file, one that isn't SQLite, one without the tables and one whose messages can't be read are *damaged*:
``report`` lists them with the reason; reading fails with the file's name, or leaves them out with option("damaged", "skip").
Topics of the same name but another type than the first one's are an error. No files give an empty table if a schema is given.
"""

from __future__ import annotations

import os
import re
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_type

#: The primitive types of message definitions with their numpy and Spark types.
PRIMITIVES = {
    "bool": ("?", "boolean"), "byte": ("u1", "smallint"), "char": ("u1", "smallint"), "int8": ("i1", "tinyint"), "uint8": ("u1", "smallint"), "int16": ("<i2", "smallint"), "uint16": ("<u2", "int"),
    "int32": ("<i4", "int"), "uint32": ("<u4", "bigint"), "int64": ("<i8", "bigint"), "uint64": ("<u8", "decimal(20,0)"), "float32": ("<f4", "float"), "float64": ("<f8", "double"),
}
MAGIC = b"SQLite format 3\x00"
DEEPEST, BATCH = 3, 10_000


@dataclass
class Field:
    """A field of a message: its type's name, its own fields if that is a message, and whether it is a list (-1: of any
    length, else of so many items)."""

    name: str
    kind: str
    fields: list[Field] | None
    items: int | None

    def spark_type(self) -> str:
        own = "string" if self.kind == "string" else PRIMITIVES[self.kind][1] if self.fields is None else struct_type(self.fields)
        return own if self.items is None else f"array<{own}>"


def struct_type(fields: list[Field]) -> str:
    return f"struct<{', '.join(f'{f.name}: {f.spark_type()}' for f in fields)}>"


def parse_definition(text: str, kind: str) -> list[Field]:
    """The fields of a message type from its definition, which lists the types that it uses below lines of '='."""
    parts = re.split(r"^=+\s*$", text, flags=re.M)
    known = {kind: parts[0]}
    for part in parts[1:]:
        head, _, body = part.strip().partition("\n")
        known[head.removeprefix("MSG:").strip()] = body
    short = {re.sub(r"^(\w+)/(?:msg/)?(\w+)$", r"\1/\2", k): v for k, v in known.items()}

    def fields(of: str, package: str) -> list[Field]:
        out = []
        for line in short[of].splitlines():
            found = re.match(r"\s*([\w/]+)(?:<=\d+)?(\[(?:<=)?(\d*)\])?\s+(\w+)\s*(?!\s*=)(?:[^=]*)$", line.split("#")[0].rstrip())
            if not found:
                continue  # blank lines and constants
            name, listed, size, own = found.groups()
            items = None if not listed else int(size) if size and "<=" not in listed else -1
            name = re.sub(r"/msg/", "/", name)
            if name in PRIMITIVES or name == "string":
                out.append(Field(own, name, None, items))
            else:
                full = name if "/" in name else f"{package}/{name}"
                out.append(Field(own, full, fields(full, full.split("/")[0]), items))
        return out

    root = re.sub(r"^(\w+)/(?:msg/)?(\w+)$", r"\1/\2", kind)
    return fields(root, root.split("/")[0])


def fixed_layout(fields: list[Field]) -> tuple[np.dtype, list] | None:
    """A structured type of messages of fixed size (offsets from the end of the header; values are aligned to their
    size) and the tree of names, or None if some field has no fixed size."""
    names, formats, offsets, at = [], [], [], 0

    def walk(own: list[Field], prefix: str):
        nonlocal at
        tree = []
        for f in own:
            if f.kind == "string" or f.items is not None:
                return None
            if f.fields is not None:
                inner = walk(f.fields, f"{prefix}{f.name}.")
                if inner is None:
                    return None
                tree.append((f.name, inner))
                continue
            kind = np.dtype(PRIMITIVES[f.kind][0])
            at = -(-at // kind.itemsize) * kind.itemsize
            names.append(prefix + f.name)
            formats.append(kind)
            offsets.append(at)
            at += kind.itemsize
            tree.append((f.name, prefix + f.name))
        return tree

    tree = walk(fields, "")
    return (np.dtype({"names": names, "formats": formats, "offsets": offsets, "itemsize": at}), tree) if tree else None


def decode_one(fields: list[Field], data: bytes) -> dict:
    """A message as a dict, for layouts without a fixed size."""
    at = 4

    def primitive(kind: str, n: int | None):
        nonlocal at
        own = np.dtype(PRIMITIVES[kind][0])
        if n != 0:
            at += -(at - 4) % own.itemsize
        out = np.frombuffer(data, own, 1 if n is None else n, at)
        at += out.nbytes
        return out[0].item() if n is None else out.tolist()

    def value(f: Field):
        nonlocal at
        if f.kind == "string":
            size = primitive("uint32", None)
            at += size
            return data[at - size : at - 1].decode("utf-8", "replace")
        return {g.name: field(g) for g in f.fields}

    def field(f: Field):
        if f.items is None:
            return primitive(f.kind, None) if f.fields is None and f.kind != "string" else value(f)
        n = primitive("uint32", None) if f.items < 0 else f.items
        return primitive(f.kind, n) if f.fields is None and f.kind != "string" else [value(f) for _ in range(n)]

    return {f.name: field(f) for f in fields}


def decode(fields: list[Field], blobs: list[bytes], kind: pa.DataType) -> pa.Array:
    layout = fixed_layout(fields)
    if layout is None or any(b[1] != 1 for b in blobs):  # big-endian messages are not what any recorder here writes
        if any(b[1] != 1 for b in blobs):
            raise ValueError("big-endian payload")
        return pa.array([decode_one(fields, b) for b in blobs], kind)
    own, tree = layout
    rows = np.frombuffer(b"".join(b[4 : 4 + own.itemsize].ljust(own.itemsize, b"\0") for b in blobs), own)

    def build(node, to: pa.DataType) -> pa.Array:
        if isinstance(node, str):
            return pa.array(np.ascontiguousarray(rows[node])).cast(to)
        return pa.StructArray.from_arrays([build(inner, to.field(i).type) for i, (_, inner) in enumerate(node)], fields=list(to))

    return build(tree, kind)


def encode(fields: list[T.StructField], row) -> bytes:
    """A row of texts and numbers as a payload; null is an empty text or zero."""
    out = bytearray(b"\0\1\0\0")
    for f, v in zip(fields, row):
        if isinstance(f.dataType, T.StringType):
            raw = (v or "").encode() + b"\0"
            out += b"\0" * (-(len(out) - 4) % 4) + len(raw).to_bytes(4, "little") + raw
        else:
            own = np.dtype(PRIMITIVES[WRITTEN[f.dataType.simpleString()]][0])
            out += b"\0" * (-(len(out) - 4) % own.itemsize) + np.array([v or 0], own).tobytes()
    return bytes(out)


WRITTEN = {"boolean": "bool", "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64", "string": "string"}


def files_below(folder: str) -> list[str]:
    """The bag files of a folder, or the file itself."""
    folder = re.sub(r"^file:/*(?=/)", "", folder)
    if os.path.isfile(folder):
        return [folder]
    found = []
    for where, folders, names in os.walk(folder):
        deep = os.path.relpath(where, folder).count(os.sep) + (where != folder)
        folders[:] = sorted(f for f in folders if not f.startswith(".")) if deep < DEEPEST else []
        found += [os.path.join(where, n) for n in sorted(names) if n.endswith(".db3") and not n.startswith(".")]
    return found


class Damaged(ValueError):
    pass


def opened(path: str) -> sqlite3.Connection:
    """The file, read-only and untouched (no lock or journal beside it)."""
    if not os.path.getsize(path):
        raise Damaged(f"{path}: empty")
    with open(path, "rb") as f:
        if f.read(16) != MAGIC:
            raise Damaged(f"{path}: no SQLite file")
    con = sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)
    try:
        tables = {r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}
        if not {"topics", "messages"} <= tables:
            raise Damaged(f"{path}: no tables of topics and messages")
    except sqlite3.DatabaseError as broken:
        raise Damaged(f"{path}: {broken}") from broken
    return con


@dataclass
class Topic:
    id: int
    name: str
    kind: str
    definition: str | None


def topics_of(con: sqlite3.Connection) -> list[Topic]:
    """All versions have a topic's id, name, type and format; definitions came later."""
    rows = con.execute("SELECT id, name, type, serialization_format FROM topics").fetchall()
    tables = {r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}
    known = dict(con.execute("SELECT topic_type, encoded_message_definition FROM message_definitions WHERE encoding IN ('ros2msg', '')")) if "message_definitions" in tables else {}
    return [Topic(i, name, kind, known.get(kind)) for i, name, kind, form in rows if (form or "cdr") == "cdr"]


@dataclass
class BagFile(InputPartition):
    path: str


class BagReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.files, self.skip = schema, files_below(options["path"]), options.get("damaged", "fail") == "skip"
        self.definition = options.get("definition")
        self.topics = {t.strip() for t in options["topics"].split(",")} if options.get("topics") else None
        self.first, self.last = (int(options[k]) if options.get(k) else None for k in ("from", "to"))

    def pushFilters(self, filters):  # noqa: N802
        """Topics and times; others are left to Spark."""
        for f in filters:
            name = f.attribute if hasattr(f, "attribute") else ()
            value = getattr(f, "value", None)
            if name == ("topic",) and isinstance(f, (EqualTo, In)):
                asked = {value} if isinstance(f, EqualTo) else set(value)
                self.topics = asked if self.topics is None else self.topics & asked
            elif name == ("timestamp",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.first = max(x for x in (self.first, value + isinstance(f, GreaterThan)) if x is not None)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.last = min(x for x in (self.last, value - isinstance(f, LessThan)) if x is not None)
            else:
                yield f

    def _asked(self, con: sqlite3.Connection) -> list[Topic]:
        return [t for t in topics_of(con) if self.topics is None or t.name in self.topics]

    def _may_hold(self, path: str) -> bool:
        try:
            con = opened(path)
        except Damaged:
            return True  # the task that reads it says so, or leaves it out
        if not self._asked(con):
            return False
        least, most = con.execute("SELECT min(timestamp), max(timestamp) FROM messages").fetchone()
        return least is not None and (self.last is None or least <= self.last) and (self.first is None or most >= self.first)

    def partitions(self) -> list[BagFile]:
        bounded = self.topics is not None or self.first is not None or self.last is not None
        return [BagFile(p) for p in self.files if not bounded or self._may_hold(p)] or [BagFile("")]

    def read(self, partition: BagFile) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        try:
            yield from self._messages(partition.path)
        except (Damaged, sqlite3.DatabaseError) as broken:
            if not self.skip:
                raise Damaged(f"{partition.path}: {broken}") from broken

    def _messages(self, path: str) -> Iterator[pa.RecordBatch]:
        con, names = opened(path), self.schema.fieldNames()
        whole = "message" in names
        kind = to_arrow_type(self.schema["message"].dataType) if whole else None
        for topic in self._asked(con):
            fields = None
            if whole:
                definition = topic.definition or self.definition
                if definition is None:
                    raise Damaged(f"no definition of {topic.kind}; give one by option")
                fields = parse_definition(definition, topic.kind)
                if re.sub(r"([:,]) ", r"\1", struct_type(fields)) != self.schema["message"].dataType.simpleString():
                    raise ValueError(f"{path}: {topic.name} has another type than the table: {struct_type(fields)}")
            where, values = "topic_id = ?", [topic.id]
            for sign, bound in ((">=", self.first), ("<=", self.last)):
                if bound is not None:
                    where += f" AND timestamp {sign} ?"
                    values.append(bound)
            cursor = con.execute(f"SELECT timestamp{', data' if whole else ''} FROM messages WHERE {where} ORDER BY timestamp, id", values)
            while rows := cursor.fetchmany(BATCH):
                made = {"file": pa.array([path] * len(rows)), "topic": pa.array([topic.name] * len(rows)), "timestamp": pa.array([r[0] for r in rows], pa.int64())}
                if whole:
                    made["message"] = decode(fields, [r[1] for r in rows], kind)
                yield pa.RecordBatch.from_arrays([made[n] for n in names], names=names)


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class BagWriter(DataSourceWriter):
    """A file for each task, under a hidden name until all tasks are done."""

    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.schema, self.overwrite = schema, overwrite
        self.folder = re.sub(r"^file:/*(?=/)", "", options["path"])
        self.kind = options.get("type", "recorded/msg/Row")
        if schema.fieldNames() != ["topic", "timestamp", "message"]:
            raise ValueError("bags are written from topic, timestamp and message")

    def write(self, rows) -> Written:
        fields = self.schema["message"].dataType.fields
        os.makedirs(self.folder, exist_ok=True)
        path = os.path.join(self.folder, f".{uuid.uuid4().hex}.db3")
        con, known, n = sqlite3.connect(path), {}, 0
        try:
            con.execute("PRAGMA journal_mode = OFF")
            con.execute("CREATE TABLE topics(id INTEGER PRIMARY KEY, name TEXT NOT NULL, type TEXT NOT NULL, serialization_format TEXT NOT NULL, offered_qos_profiles TEXT NOT NULL)")
            con.execute("CREATE TABLE messages(id INTEGER PRIMARY KEY, topic_id INTEGER NOT NULL, timestamp INTEGER NOT NULL, data BLOB NOT NULL)")
            con.execute("CREATE TABLE message_definitions(id INTEGER PRIMARY KEY, topic_type TEXT, encoding TEXT, encoded_message_definition TEXT)")
            text = "\n".join(f"{WRITTEN[f.dataType.simpleString()]} {f.name}" for f in fields)
            con.execute("INSERT INTO message_definitions VALUES (1, ?, 'ros2msg', ?)", (self.kind, text))

            def numbered():
                nonlocal n
                for r in rows:
                    if r.topic not in known:
                        known[r.topic] = len(known) + 1
                    n += 1
                    yield known[r.topic], r.timestamp, encode(fields, r.message)

            con.executemany("INSERT INTO messages(topic_id, timestamp, data) VALUES (?, ?, ?)", numbered())
            con.executemany("INSERT INTO topics VALUES (?, ?, ?, 'cdr', '')", [(i, t, self.kind) for t, i in known.items()])
            con.execute("CREATE INDEX timestamp_idx ON messages(timestamp)")
            con.commit()
            con.close()
        except BaseException:
            con.close()
            os.unlink(path)
            raise
        if n:
            return Written(path)
        os.unlink(path)
        return Written(None)

    def commit(self, messages) -> None:
        old = files_below(self.folder) if self.overwrite else []
        for m in messages:
            if m and m.path:
                os.rename(m.path, os.path.join(self.folder, os.path.basename(m.path)[1:]))
        for path in old:
            os.unlink(path)

    def abort(self, messages) -> None:
        for m in messages:
            if m and m.path and os.path.exists(m.path):
                os.unlink(m.path)


class Bags(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bags"

    def schema(self) -> str:
        """The type of the first file's first topic that is asked for."""
        reader = BagReader(T.StructType(), self.options)
        for path in reader.files:
            try:
                for topic in reader._asked(opened(path)):
                    text = topic.definition or self.options.get("definition")
                    if text:
                        return f"file string, topic string, timestamp bigint, message {struct_type(parse_definition(text, topic.kind))}"
            except Damaged:
                continue
        raise ValueError(f"no topic of these in {self.options['path']}; give a schema")

    def reader(self, schema: T.StructType) -> BagReader:
        return BagReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> BagWriter:
        return BagWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and have Spark push filters down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Bags)


def report(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each file: file, bytes, problem (null if it can be read), topics, messages, first and last timestamp."""
    schema = "file string, bytes bigint, problem string, topics array<string>, messages bigint, first bigint, last bigint"
    columns = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in T.StructType.fromDDL(schema)])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                row = {"file": path, "bytes": os.path.getsize(path), "problem": None, "topics": [], "messages": 0, "first": None, "last": None}
                try:
                    con = opened(path)
                    row["messages"], row["first"], row["last"] = con.execute("SELECT count(*), min(timestamp), max(timestamp) FROM messages").fetchone()
                    row["topics"] = sorted(t.name for t in topics_of(con))
                except (Damaged, sqlite3.DatabaseError) as broken:
                    row["problem"] = str(broken).removeprefix(f"{path}: ")
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=columns)

    paths = [(p,) for p in files_below(folder)]
    return spark.createDataFrame(paths, "file string").repartition(max(1, len(paths) // 64)).mapInArrow(look, schema)
