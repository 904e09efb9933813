"""Digests of files of any size."""

import hashlib

from evenledger.sources.scan import scan_file_digests


def test_small_and_large_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name, data in {"a/x y%20.bin": b"abc", "b.bin": bytes(range(256)) * 5000}.items():
        (tmp_path / name).write_bytes(data)
    want = {str(p.relative_to(tmp_path)): (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in tmp_path.rglob("*") if p.is_file()}
    for bound in (1, 1000, 1 << 40):
        got = {r.path: (r.size, r.sha256) for r in scan_file_digests(spark, str(tmp_path), bound).collect()}
        assert got == want, bound


def test_a_file_larger_than_a_row(spark, tmp_path):
    size = (2 << 30) + 12345
    with open(tmp_path / "large.bin", "wb") as out:
        out.truncate(size)  # a sparse file of zeros
    zeros, made = bytes(1 << 24), hashlib.sha256()
    for at in range(0, size, 1 << 24):
        made.update(zeros[: min(1 << 24, size - at)])
    row = scan_file_digests(spark, str(tmp_path)).first()
    assert (row.path, row.size, row.sha256) == ("large.bin", size, made.hexdigest())
