"""Files that many tasks parse or write by ranges, against the plain scan in order."""

import numpy as np
import pytest

from prismcube.sources import files, packets

TOKEN = packets.TOKEN


def stream(seed, n=60):
    """Packets with junk between, tokens inside payloads, headers that begin like tokens, and a cut end."""
    rng, out = np.random.default_rng(seed), b"junk\x09\x15"
    for i in range(n):
        kind = int(rng.choice([0x00, 0x07, 0x17]))
        samples = int(rng.choice([0, 2, 20, 64]))
        size = samples * 3 // 2
        payload = bytearray(rng.integers(0, 256, size, dtype=np.uint8).tobytes())
        for _ in range(int(rng.integers(0, 3))):  # tokens that are none, some with whole headers
            if size > 20:
                at = int(rng.integers(0, size - 12))
                payload[at : at + 12] = TOKEN + bytes([0, int(rng.integers(0, 90)), 7, 0, 1, 0, 0, i % 256])
        out += files.packet(samples, kind, int(rng.integers(0, 4)), i, bytes(payload)) + bytes(int(rng.choice([0, 0, 1, 5])))
        out += TOKEN[: int(rng.integers(0, 4))] if rng.random() < 0.2 else b""
    return out + files.packet(500, 0x07, 0, n, b"cut off")


@pytest.mark.parametrize("seed", range(6))
def test_maps_compose_to_the_scan(seed):
    data = stream(seed)
    size, want = len(data), []
    for p in files.packets_of(data):
        want.append(p["frame"])
    for part in (3, 17, 64, 500, size):
        maps, tokens = [], []
        for start in range(0, size, part):
            end = min(start + part, size)
            t = packets.tokens_in(data[start : min(end + 11, size)], start, end, size, TOKEN, True)
            tokens.append(t)
            maps.append((*packets.steps_of(t[0], t[1], end), end))
        # the composed map gives, for any entry, what the ranges give one after another
        whole = packets.composed(maps)
        for entry in range(0, size, 7):
            at = entry
            for steps, leaves, end in maps:
                at = packets.leave(steps, leaves, end, at)
            assert packets.leave(*whole, entry) == at
        at, found = 0, []
        for (places, after, _), (steps, leaves, end) in zip(tokens, maps, strict=True):
            found += [places[k] for k in packets.followed(places, after, at)]
            at = packets.leave(steps, leaves, end, at)
        assert [int.from_bytes(data[p + 9 : p + 12], "big") for p in found] == want


@pytest.mark.parametrize("part,fan", [(1 << 20, 256), (150, 3), (40, 4)])
def test_packets_by_ranges_equal_the_scan(spark, tmp_path, part, fan):
    want = []
    for seed in range(3):
        data = stream(seed, 40)
        (tmp_path / f"{seed}.dat").write_bytes(data)
        want += [(str(seed), p["ord"], p["line"], p["image_type"], p["data_type"], p["band"], p["frame"], p["n_bytes"], p["payload"]) for p in files.packets_of(data)]
    (tmp_path / "empty.dat").write_bytes(b"")
    (tmp_path / "none.dat").write_bytes(b"nothing here" * 50)
    got = files.read_packets(spark, str(tmp_path / "*.dat"), part=part, fan=fan).collect()
    rows = [(r.file.rsplit("/", 1)[1][:-4], r.ord, r.line, r.image_type, r.data_type, r.band, r.frame, r.n_bytes, bytes(r.payload)) for r in got]
    assert sorted(rows) == sorted(want)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_lines_written_at_offsets(spark, tmp_path, n):
    rng = np.random.default_rng(n)
    texts = [None if i % 97 == 5 else f"é{i}\t" + "x" * int(rng.integers(0, 40)) for i in range(n)]
    df = spark.createDataFrame([(int(i % 7), i, texts[i]) for i in rng.permutation(n).tolist()], "k int, ord int, text string").repartition(6)
    want = "".join((texts[i] or "") + "\n" for _, i in sorted((i % 7, i) for i in range(n))).encode()
    assert files.write_lines(df, str(tmp_path / "sub" / "o.txt"), "k", "ord") == len(want)
    assert (tmp_path / "sub" / "o.txt").read_bytes() == want
    files.write_lines(df.limit(0), str(tmp_path / "sub" / "o.txt"), "k")  # a longer file that was there is gone
    assert (tmp_path / "sub" / "o.txt").read_bytes() == b""


def test_a_file_in_place_needs_a_shared_folder(tmp_path):
    from types import SimpleNamespace

    from prismcube.sources import ordered

    rows = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(master="spark://h:1")))
    with pytest.raises(ValueError, match="shared=True"):
        ordered.write_bytes(rows, str(tmp_path / "x"), "k")


@pytest.mark.parametrize("part", [1 << 24, 40, 7])
def test_matrices_by_ranges(spark, tmp_path, part):
    rng = np.random.default_rng(part)
    m = np.round(rng.normal(size=(60, 4)) * 1000, 3)
    lines = []
    for i, row in enumerate(m):
        lines.append(" ; ".join(repr(float(x)) for x in row) if i % 3 else "\t" .join(repr(float(x)) for x in row) + " ")
        lines += [["", "  ", "3 4", "\t"][i % 4]] if i % 5 == 0 else []
    for end in ("\n", "\r\n"):
        (tmp_path / "m.txt").write_bytes(end.join(lines).encode() + (end.encode() if part == 40 else b""))
        marks = lines.count("3 4")
        got = sorted(map(tuple, files.read_matrix(spark, str(tmp_path / "m.txt"), 4, part).collect()))
        assert got == sorted([(r, c, m[r, c]) for r, c in np.ndindex(m.shape)] + [(2, 3, 1.0)] * marks)
        (tmp_path / "c.txt").write_bytes(end.join(x for x in lines if x != "3 4").encode())
        got = sorted(map(tuple, files.read_coefficients(spark, str(tmp_path / "c.txt"), 6, part).collect()))
        assert got == [(i // 6, i % 6, v) for i, v in enumerate(m.ravel())]
        got = sorted(map(tuple, files.read_text_lines(spark, str(tmp_path / "m.txt"), part).collect()))
        assert got == [(i, x) for i, x in enumerate(lines) if x.strip(" ")]
    (tmp_path / "bad.txt").write_text("1 2 3 4\n1 2 3\n")
    with pytest.raises(Exception, match="not a matrix row"):
        files.read_matrix(spark, str(tmp_path / "bad.txt"), 4, part).collect()
    (tmp_path / "none.txt").write_text("")
    assert files.read_matrix(spark, str(tmp_path / "none.txt"), 4, part).collect() == [] and files.read_coefficients(spark, str(tmp_path / "none.txt"), 4).collect() == []
