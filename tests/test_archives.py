"""Archives of filings: their directories, contents by members, renaming, what is to be moved."""

import zipfile

import pytest
from pyspark.sql import functions as F

from lotloom.sources import archives


@pytest.fixture()
def folder(tmp_path):
    def put(name, **files):
        where = tmp_path / "in" / name
        where.parent.mkdir(parents=True, exist_ok=True)
        with zipfile.ZipFile(where, "w", zipfile.ZIP_DEFLATED) as z:
            for member, content in files.items():
                z.writestr(member.replace("__", "/").replace("_dot_", "."), content)

    put("a/CML7.zip", a__CML7_dot_pdf="one", SHP_AB_dot_pdf="two", notes_dot_txt="no", CML8_dot_pdf="other circular")
    put("cml12.ZIP", cml12_dot_PDF="old", x__CML12_dot_pdf="new", SHP_X_dot_pdf="first", y__SHP_Z_dot_pdf="second")
    put("CML3.zip", CML3_dot_pdf="no pattern")
    put("CML4.zip", SHP_Q_dot_pdf="no annexure")
    put("else.zip", CML5_dot_pdf="x")
    (tmp_path / "in" / "CML9.zip").write_bytes(b"no archive")
    return str(tmp_path / "in")


def test_members_and_contents(spark, folder):
    found = archives.members(spark, folder, "*.{zip,ZIP}")
    rows = {(r["archive"].rsplit("/", 1)[-1], r["kind"]): r for r in found.collect()}
    assert {k: r["target"] for k, r in rows.items() if r["kind"]} == {("CML7.zip", "lockin"): "AB-CML7.pdf", ("CML7.zip", "shp"): "SHP-AB.pdf", ("cml12.ZIP", "lockin"): "X-CML12.pdf", ("cml12.ZIP", "shp"): "SHP-X.pdf"}
    assert {k[0] for k, r in rows.items() if r["error"]} == {"CML3.zip", "CML4.zip", "else.zip", "CML9.zip"}
    read = archives.contents(found, task_bytes=3)
    assert read.rdd.getNumPartitions() > 1  # members of one archive may be several tasks' work
    assert {r["target"]: bytes(r["content"]) for r in read.where("kind is not null").collect()} == {"AB-CML7.pdf": b"one", "SHP-AB.pdf": b"two", "X-CML12.pdf": b"new", "SHP-X.pdf": b"first"}
    done = archives.finished(read, spark.createDataFrame([(f"file:{folder}/a/{archives.DONE}/CML7.zip",)], "path string"), F.lit("2026-01-02 03:04:05").cast("timestamp_ntz"))
    assert sorted(r["moved"].removeprefix(f"file:{folder}") for r in done.collect()) == [f"/a/{archives.DONE}/CML7_20260102_030405.zip", f"/{archives.DONE}/cml12.ZIP"]


def test_only_members_are_read(spark, tmp_path):
    """What else an archive holds isn't read, however much it is; a member whose bytes are damaged says so."""
    big = tmp_path / "CML1.zip"
    with zipfile.ZipFile(big, "w", zipfile.ZIP_STORED) as z:
        z.writestr("filler.bin", b"\0" * (32 << 20))
        z.writestr("CML1.pdf", b"lock" * 1000)
        z.writestr("SHP-ONE.pdf", b"hold" * 1000)
    found = archives.members(spark, str(tmp_path))
    assert found.agg(F.sum("packed")).first()[0] == 8000
    data = bytearray(big.read_bytes())
    at = data.index(b"lock" * 10)
    data[at : at + 4] = b"xxxx"
    big.write_bytes(data)
    got = {r["kind"]: r["error"] for r in archives.contents(found).collect()}
    assert "CRC" in got["lockin"] and got["shp"] is None
    assert archives.finished(archives.contents(found), spark.createDataFrame([], "path string"), F.current_timestamp()).count() == 0


def test_no_archives(spark, tmp_path):
    found = archives.members(spark, str(tmp_path))
    assert found.count() == 0 and archives.contents(found).count() == 0
