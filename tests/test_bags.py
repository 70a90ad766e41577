"""The bag source against files that are written here, byte by byte and by the source itself."""

import os
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from roadmetrics.sources import bags
from roadmetrics.sources.bags import BagReader, decode_one, files_below, fixed_layout, parse_definition, register, report, struct_type

DEFINITION = """# a comment
int32 LIMIT=5
pkg/Header header
float64 speed
bool is_auto
Point[] path
uint8[3] marks
string<=20 note
================
MSG: pkg/Header
uint32 seq
string frame
================
MSG: pkg/Point
float32 x
float64 y
"""


def payload(seq, frame, speed, is_auto, path, marks, note):
    out = bytearray()

    def put(form, *v):
        size = struct.calcsize("<" + form[-1])
        out.extend(b"\0" * (-len(out) % size))
        out.extend(struct.pack("<" + form, *v))

    def text(s):
        raw = s.encode() + b"\0"
        put("I", len(raw))
        out.extend(raw)

    put("I", seq), text(frame), put("d", speed), put("?", is_auto), put("I", len(path))
    for x, y in path:
        put("f", x), put("d", y)
    out.extend(bytes(marks)), text(note)
    return b"\0\1\0\0" + bytes(out)


def write(path, rows, version=4, kind="pkg/msg/State", topic="/state", definition=DEFINITION):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE topics(id INTEGER PRIMARY KEY, name TEXT, type TEXT, serialization_format TEXT" + (", offered_qos_profiles TEXT)" if version > 1 else ")"))
    con.execute("CREATE TABLE messages(id INTEGER PRIMARY KEY, topic_id INTEGER, timestamp INTEGER, data BLOB)")
    if version >= 4:
        con.execute("CREATE TABLE message_definitions(id INTEGER PRIMARY KEY, topic_type TEXT, encoding TEXT, encoded_message_definition TEXT)")
        con.execute("INSERT INTO message_definitions VALUES (1, ?, 'ros2msg', ?)", (kind, definition))
    con.execute(f"INSERT INTO topics VALUES (1, ?, ?, 'cdr'{', ?' if version > 1 else ''})", (topic, kind, *([""] if version > 1 else [])))
    con.executemany("INSERT INTO messages(topic_id, timestamp, data) VALUES (1, ?, ?)", rows)
    con.commit()
    con.close()


ROWS = [(10 * i, payload(i, "map" * (i % 3), i / 2, i % 2 == 0, [(k, k * 0.5) for k in range(i % 4)], (1, 2, i % 200), "é" * (i % 5))) for i in range(50)]


def test_definitions_and_layouts():
    fields = parse_definition(DEFINITION, "pkg/msg/State")
    assert struct_type(fields) == "struct<header: struct<seq: bigint, frame: string>, speed: double, is_auto: boolean, path: array<struct<x: float, y: double>>, marks: array<smallint>, note: string>"
    assert fixed_layout(fields) is None
    got = decode_one(fields, ROWS[7][1])
    assert got == {"header": {"seq": 7, "frame": "map"}, "speed": 3.5, "is_auto": False, "path": [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.5}, {"x": 2.0, "y": 1.0}], "marks": [1, 2, 7], "note": "éé"}
    own, _ = fixed_layout(parse_definition("bool a\nfloat64 b\nint16 c\nfloat32 d", "p/msg/T"))
    assert own.fields["b"][1] == 8 and own.fields["c"][1] == 16 and own.fields["d"][1] == 20


@pytest.fixture
def folder(tmp_path):
    write(f"{tmp_path}/one/a.db3", ROWS[:20])
    write(f"{tmp_path}/one/deeper/b.db3", ROWS[20:])
    write(f"{tmp_path}/two/c.db3", [(5, payload(1, "x", 1.0, True, [], (0, 0, 0), ""))], topic="/other")
    write(f"{tmp_path}/.hidden/d.db3", ROWS)
    write(f"{tmp_path}/1/2/3/4/e.db3", ROWS)
    return str(tmp_path)


def test_reading_listing_and_pruning(spark, folder):
    register(spark)
    assert [os.path.basename(f) for f in files_below(folder)] == ["a.db3", "b.db3", "c.db3"]
    got = spark.read.format("bags").option("topics", "/state").load(folder)
    rows = got.orderBy("timestamp").collect()
    fields = parse_definition(DEFINITION, "pkg/msg/State")
    assert [r.timestamp for r in rows] == [t for t, _ in ROWS]
    assert [r.message.asDict(True) for r in rows] == [decode_one(fields, data) for _, data in ROWS]
    asked = got.filter((F.col("timestamp") >= 210) & (F.col("timestamp") < 230)).select("timestamp")
    assert sorted(r.timestamp for r in asked.collect()) == [210, 220] and asked.rdd.getNumPartitions() == 1
    none = spark.read.format("bags").load(folder).filter("topic = '/none'")
    assert none.count() == 0


def test_files_that_cannot_hold_a_row_are_no_partitions(folder):
    planned = lambda **o: [os.path.basename(p.path) for p in BagReader(None, {"path": folder, **{k.rstrip("_"): v for k, v in o.items()}}).partitions()]
    assert planned() == ["a.db3", "b.db3", "c.db3"]
    assert planned(topics="/other") == ["c.db3"] and planned(topics="/state", from_="195") == ["b.db3"]
    assert planned(to="7") == ["a.db3", "c.db3"] and planned(from_="10000") == [""]


def test_older_files_need_a_definition(spark, tmp_path):
    register(spark)
    write(f"{tmp_path}/old.db3", ROWS[:5], version=1)
    with pytest.raises(Exception, match="give a schema"):
        spark.read.format("bags").load(str(tmp_path)).count()
    assert spark.read.format("bags").option("definition", DEFINITION).load(str(tmp_path)).filter("message.speed >= 1").count() == 3


def test_damaged_files_are_reported_and_left_out(spark, folder):
    register(spark)
    open(f"{folder}/empty.db3", "w").close()
    with open(f"{folder}/text.db3", "w") as f:
        f.write("no database at all, but long enough")
    sqlite3.connect(f"{folder}/bare.db3").execute("CREATE TABLE t(x)")
    with open(f"{folder}/one/a.db3", "rb") as f:
        whole = f.read()
    with open(f"{folder}/torn.db3", "wb") as f:
        f.write(whole[: len(whole) // 2])
    problems = {os.path.basename(r.file): r.problem for r in report(spark, folder).collect()}
    assert problems["a.db3"] is None and problems["empty.db3"] == "empty" and "SQLite" in problems["text.db3"] and "tables" in problems["bare.db3"] and problems["torn.db3"]
    read = lambda how: spark.read.format("bags").option("topics", "/state").option("damaged", how).load(folder)
    assert read("skip").filter("timestamp < 200").select("timestamp").distinct().count() == 20
    with pytest.raises(Exception, match="Damaged"):
        read("fail").select("timestamp").collect()


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    register(spark)
    rows = spark.range(100).select(F.lit("/t").alias("topic"), F.col("id").alias("timestamp"), F.struct((F.col("id") * 0.5).alias("x"), F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.lit("é")).cast("string").alias("y")).alias("message"))
    with pytest.raises(Exception, match="broken|aborted|failed"):
        rows.repartition(4).write.format("bags").mode("append").save(f"{tmp_path}/out")
    assert not os.path.isdir(f"{tmp_path}/out") or not os.listdir(f"{tmp_path}/out")
    good = rows.filter("timestamp < 77")
    for mode, times in (("append", 1), ("append", 2), ("overwrite", 1)):
        good.write.format("bags").mode(mode).save(f"{tmp_path}/out")
        back = spark.read.format("bags").load(f"{tmp_path}/out")
        assert back.count() == 77 * times and back.agg(F.sum("message.x")).first()[0] == times * sum(range(77)) / 2
    assert bags.PRIMITIVES["float64"] == ("<f8", "double")
