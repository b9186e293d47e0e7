"""Growing log files, gzip members, and publishers at the same time."""

import gzip
import io
import os
import random
import threading
import zlib

import pytest
from pyspark.sql import functions as F

from loglens.sources import files, gzip_members, kafka, tail
from loglens.streaming import runner, sinks


def _lines(rng, n, long=0.02):
    return [("é" if rng.random() < 0.1 else "x") * (rng.randrange(3000) if rng.random() < long else rng.randrange(40)) + str(i) for i in range(n)]


def _taken(spark, base, **options):
    source = tail.growing_log_files(spark, f"{base}/logs", "*.log", **options)
    runner.run_available(spark, lambda: sinks.parquet_append(source, f"{base}/out", f"{base}/ck", runner.AVAILABLE_NOW), state_partitions=1)
    return sorted((r.file_name, r.position, r.value) for r in spark.read.parquet(f"{base}/out").collect())


def _want(folder):
    out = []
    for name in os.listdir(folder):
        if name.endswith(".log"):
            raw, at = open(f"{folder}/{name}", "rb").read(), 0
            for piece in raw.split(b"\n")[:-1]:
                out.append((name, at, piece.removesuffix(b"\r").decode()))
                at += len(piece) + 1
    return sorted(out)


def test_appended_lines_are_read_once_each(spark, tmp_path):
    """Files grow between batches, also in the middle of a line and of a character."""
    rng, base = random.Random(3), str(tmp_path)
    os.mkdir(f"{base}/logs")
    content = {f"{k}.log": ("\n".join(_lines(rng, 120)) + "\n").encode() for k in "ab"} | {"c.log": b"one\r\ntwo\r\n\r\nthree\n", "d.txt": b"no\n", "e.log": b""}
    for cut in (0.3, 0.31, 0.8, 1.0):
        for name, raw in content.items():
            with open(f"{base}/logs/{name}", "wb" if cut == 0.3 else "ab") as f:
                f.write(raw[f.tell():int(len(raw) * cut)])
        got = _taken(spark, base, split_bytes=777)
        assert got == _want(f"{base}/logs"), cut
    assert len(got) == 244
    assert _taken(spark, base, split_bytes=100) == got       # nothing new
    with open(f"{base}/logs/a.log", "wb") as f:               # replaced by a shorter file
        f.write(b"new start\n")
    more = _taken(spark, base)
    assert len(more) == len(got) + 1 and ("a.log", 0, "new start") in more


@pytest.mark.parametrize("split", [1, 2, 7, 100, 10 ** 6])
def test_ranges_yield_every_line_once(split):
    rng = random.Random(split)
    raw = ("\n".join(_lines(rng, 60 if split < 100 else 400, 0.05)) + "\n").encode()
    if split == 1:
        raw = raw[:raw.index(b"\n", 300) + 1]
    got = []
    for a in range(0, len(raw), split):
        part = tail.Range("x", a, min(a + split, len(raw)), a == 0)
        got += [x for lines, _ in tail.lines_of(io.BytesIO(raw), part) for x in lines]
    assert got == raw.decode().split("\n")[:-1]
    assert tail.last_line_end(io.BytesIO(raw + b"unfinished"), 0, len(raw) + 10) == len(raw)
    assert tail.last_line_end(io.BytesIO(b"abc"), 0, 3) == 0


def _members(rng, raw, size):
    out, at = b"", 0
    while at < len(raw):
        n = rng.randrange(1, size)
        out += gzip.compress(raw[at:at + n], rng.choice([0, 1, 6]))
        at += n
    return out


@pytest.mark.parametrize("size,split", [(300, 1000), (5000, 700), (40, 5000), (3000, 3000), (10 ** 6, 100)])
def test_members_yield_the_lines_of_the_plain_reader(spark, tmp_path, size, split):
    """Lines run over members and ranges; members are larger and smaller than ranges; headers stand in the data."""
    rng = random.Random(size)
    total = 0
    for k, n in enumerate((400, 90, 1, 0)):
        raw = "\n".join(_lines(rng, n)).encode() + (b"\n" if k % 2 else b"")
        raw = raw.replace(b"7\n", b"\n", 3)
        (tmp_path / f"f{k}.gz").write_bytes(_members(rng, raw, size) if raw else gzip.compress(b""))
    plain = files.log_files(spark, str(tmp_path), "*.gz").select("value", "file_name")
    lines = gzip_members.gzip_log_lines(spark, str(tmp_path), "*.gz", split)
    key = lambda df: sorted((r.file_name, r.value) for r in df.collect())
    got = key(lines)
    assert got == key(plain)
    total = lines.select(F.spark_partition_id().alias("p"), "file_name").where("file_name = 'f0.gz'").distinct().count()
    assert total > 1 if size < 10 ** 5 else total == 1


def test_bytes_that_look_like_a_header_are_no_start():
    rng = random.Random(1)
    raw = b"".join(gzip_members.MAGIC + bytes([rng.choice([0, 8])]) + rng.randbytes(30) for _ in range(200))
    data = gzip.compress(raw, 0) + gzip.compress(b"tail\n")
    second = len(gzip.compress(raw, 0))
    assert gzip_members.first_member(io.BytesIO(data), 1, len(data)) == second


def test_a_broken_member_fails():
    good = [gzip.compress(f"line {i}\n".encode() * 50) for i in range(4)]
    data = bytearray(b"".join(good))
    data[len(good[0]) + len(good[1]) + 20] ^= 0xFF
    size, cut = len(data), len(good[0]) + 5
    with pytest.raises(zlib.error):
        for begin in range(0, size, cut):
            list(gzip_members.range_lines(io.BytesIO(bytes(data)), size, begin, min(begin + cut, size)))


def test_publishers_at_the_same_time_never_share_an_offset(spark, scratch):
    base = scratch("publish")
    spark.range(300).select(F.concat(F.lit("line "), "id").alias("value")).repartition(3).write.text(f"{base}/logs")
    sinks.publish_lines(spark, f"{base}/logs", f"{base}/topic", glob="part-*")
    # A table of before the markers goes on behind its largest offset.
    store = sinks.tables._Store(spark, base)
    store.delete(f"{base}/topic/{sinks.OFFSETS}")
    errors = []

    def publish():
        try:
            sinks.publish_lines(spark, f"{base}/logs", f"{base}/topic", glob="part-*")
        except Exception as e:  # noqa: BLE001 - shown below
            errors.append(e)

    threads = [threading.Thread(target=publish) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    env = kafka.envelope_batch(spark, f"{base}/topic")
    assert env.count() == 1500 == env.select("offset").distinct().count()
    assert len([n for n in store.names(f"{base}/topic/{sinks.OFFSETS}") if n.endswith(".json")]) == 4


def test_claimed_blocks_are_disjoint(spark, scratch):
    target, got = scratch("claims"), []
    threads = [threading.Thread(target=lambda: got.append(sinks.claim_offsets(spark, target, 10))) for _ in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(0, 120, 10))
