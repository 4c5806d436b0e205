"""PLY and OBJ files: round trips, byte ranges, text and both byte orders,
and files that must raise."""

import struct

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sitelens.operators.cloud import TRI
from sitelens.sources import meshfiles as M

PTS = [(i, float(np.sin(i)), i / 7, -1e6 + i) for i in range(1000)]


def cloud(spark):
    return spark.createDataFrame(PTS, "pt_id long, x double, y double, z double")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_ply_round_trip_in_ranges(spark, tmp_path):
    M.write_ply(cloud(spark).repartition(3), str(tmp_path / "c"))
    assert len(list((tmp_path / "c").glob("*.ply"))) == 3 and not list((tmp_path / "c").glob("_temp*"))
    for size in (M.RANGE_BYTES, 100, 1):
        df = M.read_ply(spark, str(tmp_path / "c"), size)
        assert rows(df, "pt_id", "x", "y", "z") == PTS
    assert df.rdd.getNumPartitions() == 1000


def _text(n, lines, extra=""):
    return f"ply\nformat ascii 1.0\ncomment made here\nelement vertex {n}\nproperty float x\nproperty float y\nproperty float z\n{extra}end_header\n" + lines


def test_text_and_big_endian(spark, tmp_path):
    lines = "".join(f"{i} {i * .5} -{i}\n" for i in range(300))
    (tmp_path / "a.ply").write_text(_text(300, lines))
    want = [(i, float(i), i * .5, -float(i)) for i in range(300)]
    for size in (1 << 20, 64, 7):
        assert rows(M.read_ply(spark, str(tmp_path / "a.ply"), size), "pt_id", "x", "y", "z") == want
    faces = _text(4, "0 0 0\n1 0 0\n\n1 1 0\n0 1 0\n4 0 1 2 3\n", "element face 1\nproperty list uchar int vertex_indices\n")
    (tmp_path / "f.ply").write_text(faces)
    assert M.read_ply(spark, str(tmp_path / "f.ply"), 8).count() == 4
    head = "ply\nformat binary_big_endian 1.0\nelement vertex 3\nproperty short x\nproperty float y\nproperty double z\nend_header\n"
    (tmp_path / "b.ply").write_bytes(head.encode() + b"".join(struct.pack(">hfd", i, i + .5, i * 2.0) for i in range(3)))
    assert rows(M.read_ply(spark, str(tmp_path / "b.ply")), "pt_id", "x", "y", "z") == [(i, float(i), i + .5, i * 2.0) for i in range(3)]


@pytest.mark.parametrize("name,data", [
    ("cut", b"ply\nformat binary_little_endian 1.0\nelement vertex 5\nproperty float x\nend_header\n" + b"\0" * 12),
    ("headless", b"x y z\n1 2 3\n"), ("odd", b"ply\nformat binary_little_endian 1.0\nelement vertex 1\nproperty quad x\nend_header\n\0\0\0\0"),
    ("short", _text(3, "1 2 3\n4 5 6\n").encode()), ("words", _text(2, "1 2 3\n4 5\n").encode())])
def test_odd_files_raise(spark, tmp_path, name, data):
    (tmp_path / f"{name}.ply").write_bytes(data)
    with pytest.raises((PySparkException, ValueError)):
        M.read_ply(spark, str(tmp_path / f"{name}.ply")).count()


def test_obj_round_trip_and_fans(spark, tmp_path):
    g = np.random.default_rng(1)
    tris = [(i, *map(float, g.normal(size=9))) for i in range(200)]
    df = spark.createDataFrame(tris, "tri_id long, " + ", ".join(f"{c} double" for c in TRI))
    M.write_obj(df.repartitionByRange(3, "tri_id"), str(tmp_path / "m"))
    for size in (1 << 20, 50):
        assert rows(M.read_obj(spark, str(tmp_path / "m"), size), *TRI) == sorted(t[1:] for t in tris)
    (tmp_path / "q.obj").write_text("# square\no one\nv 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\nvn 0 0 1\nf 1//1 2//1 3//1 4//1\n")
    fan = M.read_obj(spark, str(tmp_path / "q.obj"))
    assert rows(fan, "tri_id", *TRI) == [(0, 0., 0., 0., 1., 0., 0., 1., 1., 0.), (1, 0., 0., 0., 1., 1., 0., 0., 1., 0.)]
    for bad in ("v 1 2\n", "v 0 0 0\nv 1 0 0\nf 1 2\n", "v 0 0 0\nv 1 0 0\nf 1 2 3\n"):
        (tmp_path / "bad.obj").write_text(bad)
        with pytest.raises(PySparkException):
            M.read_obj(spark, str(tmp_path / "bad.obj")).collect()
