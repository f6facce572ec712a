"""Landing bytes once."""

import hashlib

import pytest

from strata.sources.files import read_csv_explicit
from strata.sources.landing import land_once, landed_files, landing_tally, read_manifest

FILES = {
    "latin.csv": "id,name\n1,Dún Laoghaire €\n".replace("€", "\x80").encode("latin-1"),
    "cr.csv": b"id,name\r1,one\r2,two\r",
    "crlf.csv": b"id,name\r\n1,one\r\n",
    "no_end.csv": b"id,name\n1,one",
    "binary.bin": bytes(range(256)) * 3,
    "high_end.bin": b"abc\xe9",
    "nul_end.bin": b"abc\x00",
    "lines.txt": b"\n\n\n",
    "one.txt": b"x",
    "bad_utf8.txt": b"\xff\xfe\xc3(\n",
}


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    for name, body in FILES.items():
        (folder / name).write_bytes(body)
    return folder


def bodies(spark, root, dataset="d"):
    return sorted(bytes(r["content"]) for r in landed_files(spark, root, dataset).collect())


def test_bytes_are_kept_and_named_by_hash(spark, drop, tmp_path):
    root = str(tmp_path / "bronze")
    rows = land_once(spark, str(drop), root, "d", "2024-06-01 00:00:00").collect()
    assert {r["source_path"].rsplit("/", 1)[1]: (r["sha256"], r["length"], r["status"]) for r in rows} == {
        n: (hashlib.sha256(b).hexdigest(), len(b), "stored") for n, b in FILES.items()}
    assert bodies(spark, root) == sorted(FILES.values())
    for r in landed_files(spark, root, "d").collect():
        assert hashlib.sha256(bytes(r["content"])).hexdigest() == r["sha256"]


def test_a_file_landed_again_is_noted_not_stored(spark, drop, tmp_path):
    root = str(tmp_path / "bronze")
    land_once(spark, str(drop), root, "d", "2024-06-01 00:00:00")
    (drop / "copy_of_cr.csv").write_bytes(FILES["cr.csv"])
    (drop / "new_a.csv").write_bytes(b"new\n")
    (drop / "new_b.csv").write_bytes(b"new\n")
    second = {r["source_path"].rsplit("/", 1)[1]: r["status"] for r in land_once(spark, str(drop), root, "d", "2024-07-01 00:00:00").collect()}
    assert {n for n, s in second.items() if s == "stored"} == {"new_a.csv"} and len(second) == len(FILES) + 3
    assert bodies(spark, root) == sorted([*FILES.values(), b"new\n"])
    tally = {(r["dataset"], r["status"]): r["n_files"] for r in landing_tally(read_manifest(spark, root)).collect()}
    assert tally == {("d", "stored"): len(FILES) + 1, ("d", "duplicate"): len(FILES) + 2}


def test_datasets_are_apart_and_files_can_be_read(spark, drop, tmp_path):
    root = str(tmp_path / "bronze")
    land_once(spark, str(drop), root, "d", "2024-06-01 00:00:00", glob="latin.csv")
    land_once(spark, str(drop), root, "e", "2024-06-01 00:00:00", glob="latin.csv")
    assert bodies(spark, root) == bodies(spark, root, "e") == [FILES["latin.csv"]]
    path = landed_files(spark, root, "d").first()["path"]
    assert read_csv_explicit(spark, path, encoding="ISO-8859-1").first()["name"] == "Dún Laoghaire \x80"
