"""Packets are made, and read, once."""

import numpy as np
from pyspark.sql import functions as F

from prismcube import queries as Q
from prismcube.sources import files, store


def counted(df, path):
    """df, whose rows are counted in a file whenever they are worked out."""

    def run(batches):
        for b in batches:
            with open(path, "a") as f:
                f.write(f"{b.num_rows}\n")
            yield b

    return df.mapInArrow(run, df.schema)


def total(path):
    return sum(map(int, path.read_text().split()))


def test_event_packets_are_made_once_for_the_four_files(spark, sf, tmp_path, monkeypatch):
    seen, made = tmp_path / "n", Q._event_packets
    monkeypatch.setattr(Q, "_event_packets", lambda spark, sf: counted(made(spark, sf), str(seen)))
    n = Q.QUERIES["s7_packets"](spark, sf).count()
    assert total(seen) == spark.read.parquet(f"{sf}/events.parquet").count() == n // 3


def test_decode_reads_packets_once_and_the_end_of_lines(spark, tmp_path):
    data = b"".join(files.packet(4, 0, 0, i, b"\0" * 6) + b"".join(files.packet(n, 7, b, i, files.pack12(np.arange(n) + i)) for b in range(2)) for i in range(20) for n in (8 + i % 3 * 4,))
    (tmp_path / "a.dat").write_bytes(data)
    packets = files.read_packets(spark, str(tmp_path / "*.dat"), part=100)
    every = {(r.b, r.y, r.x): r.v for r in files.decode(counted(packets, str(tmp_path / "n"))).collect()}
    assert total(tmp_path / "n") == 60 and len(every) == 2 * sum(8 + i % 3 * 4 for i in range(20))
    last = {(r.b, r.y, r.x): r.v for r in files.decode(packets, last=8).collect()}
    assert len(last) == 2 * 20 * 8 and last == {k: v for k, v in every.items() if (k[0], k[1], k[2] + 8) not in every}


def test_decode_query_sorts_no_samples(spark, sf):
    assert "max(x" not in Q.QUERIES["c6_decode"](spark, sf)._jdf.queryExecution().toString()


def test_small_ranges_share_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    assert store.tasks(spark, 10_000, 10_000 << 18) == max(4 * cores, 79) and store.tasks(spark, 3, 3 << 26) == 3 and store.tasks(spark, 0, 0) == 1
    (tmp_path / "a").write_bytes(b"x" * 5000)
    ranges = store.ranges(spark, str(tmp_path / "a"), 10)
    assert ranges.rdd.getNumPartitions() == 4 * cores and ranges.agg(F.sum(F.col("end") - F.col("start"))).first()[0] == 5000
