"""Streamed file hashes against hashlib: chunks, cut files, marks, line ends at the end."""

import hashlib
import os

import pytest

from strata.sources import filehash
from strata.sources.filehash import hash_files

CASES = {
    "empty": b"",
    "newline": b"\n",
    "newlines": b"\n\n\n",
    "one": b"x",
    "closed": b"a\nb\n",
    "open": b"a\n\nb",
    "returns": b"a\r\nb\r\r\n\x00\xff\xfe",
    "mark": b"\xef\xbb\xbfhead\nrow\n",
    "mark only": b"\xef\xbb\xbf",
    "long line": b"z" * 300_000 + b"\n" + b"y" * 70_000,
    "random": os.urandom(400_000),
}


@pytest.mark.parametrize("whole", ["35184372088832", "20000", "700"])
def test_matches_hashlib(spark, tmp_path, whole, monkeypatch):
    monkeypatch.setattr(filehash, "_WHOLE", whole)  # small: files are cut into blocks of that size
    monkeypatch.setattr(filehash, "UPDATE_BYTES", 1000)
    for name, data in CASES.items():
        (tmp_path / f"{name}.bin").write_bytes(data)
    got = {os.path.basename(r.path).replace("%20", " "): (r.byte_size, r.sha256) for r in hash_files(spark, str(tmp_path), "*.bin").collect()}
    assert got == {f"{n}.bin": (len(d), hashlib.sha256(d).hexdigest()) for n, d in CASES.items() if d not in (b"", b"\xef\xbb\xbf")}


def test_parquet_files_and_nested_folders(spark, tmp_path):
    spark.range(20_000).selectExpr("id", "md5(string(id)) AS m", "id % 3 AS k").write.partitionBy("k").parquet(str(tmp_path / "t"))
    got = {r.path.split("/t/")[1]: r.sha256 for r in hash_files(spark, str(tmp_path / "t")).collect()}
    want = {
        os.path.relpath(os.path.join(d, f), tmp_path / "t"): hashlib.sha256(open(os.path.join(d, f), "rb").read()).hexdigest()
        for d, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")
    }
    assert got == want and len(got) >= 3


def test_content_is_not_read_as_one_value(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    plan = filehash._chunks(spark, str(tmp_path / "t"), "*.parquet")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "binaryFile" not in plan


def test_packed_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="packed"):
        hash_files(spark, str(tmp_path), "*.gz")


@pytest.mark.parametrize("block", [20_000, 150_000])
def test_large_files_go_from_task_to_task(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr(filehash, "TASK_BYTES", block)
    read, after = {}, filehash._after

    def watched(blocks, states):
        found = after(blocks, states)
        for path, size, state in states.values():
            seen = [filehash._File.resumed(path, size, s).seen for s in (state, found[path])]
            read.setdefault(os.path.basename(path), []).append(seen[1] - seen[0])
        return found

    monkeypatch.setattr(filehash, "_after", watched)
    cases = CASES | {
        "lines": b"".join(b"%d\n" % i for i in range(70_000)),
        "marked lines": b"\xef\xbb\xbf" + b"\r\n".join(b"%d" % i for i in range(50_000)),
        "one line": b"w" * 400_000,
    }
    for folder, end in (("a", "bin"), ("b", "bin.parquet")):  # names that end so have no byte order mark
        (tmp_path / folder).mkdir()
        for name, data in cases.items():
            if end == "bin" or not data.startswith(b"\xef"):
                (tmp_path / folder / f"{name}.{end}").write_bytes(data)
    got = {os.path.basename(r.path).replace("%20", " "): (r.byte_size, r.sha256) for r in hash_files(spark, str(tmp_path), "*.bin*").collect()}
    want = {p.name: p.read_bytes() for p in tmp_path.glob("*/*")}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in want.items() if d not in (b"", b"\xef\xbb\xbf")}
    for name in ("lines.bin", "random.bin", "random.bin.parquet"):
        size = len(want[name])
        assert len(read[name]) == -(-size // block) and max(read[name]) < block + 10_000
    alone = hash_files(spark, str(tmp_path / "a" / "lines.bin"), "*.bin").collect()
    assert [r.sha256 for r in alone] == [hashlib.sha256(want["lines.bin"]).hexdigest()]


def test_a_hash_goes_on_from_its_state():
    data = os.urandom(1000)
    for cut in (0, 1, 63, 64, 500):
        second = filehash._Sha256(state=filehash._Sha256(data[:cut]).state)
        second.update(data[cut:])
        assert second.hexdigest() == hashlib.sha256(data).hexdigest()


def test_blocks_out_of_order_are_refused():
    ((path, state),) = filehash._gone_on({0: ("f.parquet", 9, None)})(0, iter([(5, b"abc")]))
    with pytest.raises(ValueError, match="came after"):
        list(filehash._gone_on({1: (path, 9, state)})(1, iter([(5, b"abc")])))


def test_without_the_library_large_files_are_read_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filehash, "TASK_BYTES", 20_000)
    monkeypatch.setattr(filehash, "_can_pass_on", lambda: False)
    monkeypatch.setattr(filehash, "_pass_on", lambda *a: pytest.fail("states"))
    (tmp_path / "a.bin").write_bytes(CASES["random"])
    assert hash_files(spark, str(tmp_path), "*.bin").first().sha256 == hashlib.sha256(CASES["random"]).hexdigest()
