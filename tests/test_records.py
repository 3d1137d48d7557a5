import os
import struct
import tempfile

import oracle_check
import pytest

from panelwright.plans.catalogue import load
from panelwright.sources import records

SF = "/root/testdata/sf0.001"


def write_file(path, examples):
    with open(path, "wb") as out:
        for ex in examples:
            out.write(records.frame(records.encode_example(ex)))


def test_crc32c_known_value():
    assert records.crc32c(b"123456789") == 0xE3069283


def test_example_round_trip():
    ex = {"id": "a-1", "img": b"\x00\xffjpeg", "label": -7, "big": 2**62, "score": 0.5, "tags": ["x", "y"], "ints": [1, -2, 3]}
    got = records.decode_example(records.encode_example(ex))
    assert got["id"] == ("bytes", [b"a-1"]) and got["img"] == ("bytes", [b"\x00\xffjpeg"])
    assert got["label"] == ("int64", [-7]) and got["big"] == ("int64", [2**62]) and got["score"] == ("float", [0.5])
    assert got["tags"] == ("bytes", [b"x", b"y"]) and got["ints"] == ("int64", [1, -2, 3])


def test_shards_with_different_schemas_read_into_one_table(spark):
    folder = tempfile.mkdtemp(prefix="records-")
    write_file(f"{folder}/train-00.rec", [{"id": "t1", "img": b"abc", "label": 3}, {"id": "t2", "img": b"", "image": b"zz", "label": 1}])
    write_file(f"{folder}/test-00.rec", [{"id": "q1", "image": b"qq"}, {}])
    write_file(f"{folder}/empty.rec", [])
    df = records.read_records(spark, f"{folder}/*.rec", "id string, img binary, image binary, label long, _file string, _offset long, _corrupt string")
    rows = sorted(((r.id, r.img, r.image, r.label, os.path.basename(r._file), r._offset, r._corrupt) for r in df.collect()), key=repr)
    assert df.rdd.getNumPartitions() == 3
    second = lambda ex: len(records.frame(records.encode_example(ex)))
    assert rows == sorted([
        ("t1", b"abc", None, 3, "train-00.rec", 0, None), ("t2", b"", b"zz", 1, "train-00.rec", second({"id": "t1", "img": b"abc", "label": 3}), None),
        ("q1", None, b"qq", None, "test-00.rec", 0, None), (None, None, None, None, "test-00.rec", second({"id": "q1", "image": b"qq"}), None)], key=repr)


def test_corrupt_frames_raise_or_are_counted(spark):
    folder = tempfile.mkdtemp(prefix="records-")
    good = records.frame(records.encode_example({"id": "ok"}))
    bad = bytearray(records.frame(records.encode_example({"id": "bad"})))
    bad[-6] ^= 0xFF  # a data byte: the data checksum no longer holds
    with open(f"{folder}/a.rec", "wb") as out:
        out.write(good + bytes(bad) + good)
    with open(f"{folder}/b.rec", "wb") as out:
        out.write(good + good[:7])  # cut header
    schema = "id string, _corrupt string"
    kept = records.read_records(spark, folder, schema, mode="PERMISSIVE").collect()
    assert sorted(r.id for r in kept if r._corrupt is None) == ["ok", "ok"]
    assert sorted(r._corrupt.split(" at ")[0] for r in kept if r._corrupt) == ["bad data checksum", "cut header"]
    with pytest.raises(Exception, match="checksum|cut"):
        records.read_records(spark, folder, schema).collect()


def test_write_then_read_equals_the_table(spark):
    query, sql = load()[0]["a5_record_files"], load()[1]["a5_record_files"]
    assert oracle_check.compare(query(spark, SF), oracle_check.duck(SF), sql) is None
