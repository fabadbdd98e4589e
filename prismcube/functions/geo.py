"""Positions: text records, UTM, cameras and rational polynomials, as column expressions where these can say it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources import store


def parse_mark(text: Column) -> Column:
    """MARK1PVAA record: struct of week, time, lon, lat, h, velocities and angles (radians; the first two angles swapped)."""
    parts = F.split(F.element_at(F.split(text, ";"), -1), ",")
    n = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    return F.struct(
        n(0).cast("int").alias("week"), n(1).alias("time"), n(3).alias("lon"), n(2).alias("lat"), n(4).alias("h"),
        F.array(n(5), n(6), n(7)).alias("vx"), F.array(F.radians(n(9)), F.radians(n(8)), F.radians(n(10))).alias("a"),
    )


def parse_posa(text: Column) -> Column:
    """MARKPOSA record: lat, lon and h after SINGLE."""
    parts = F.split(F.element_at(F.split(text, "SINGLE,?"), -1), ",")
    n = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    return F.struct(n(1).alias("lon"), n(0).alias("lat"), n(2).alias("h"))


def utm_zone(lon: Column, lat: Column) -> Column:
    """Zone of a longitude (wrapped to [-180, 180)) with the exceptions of south-west Norway and Svalbard."""
    x = lon + 180 - F.floor((lon + 180) / 360) * 360 - 180
    zone = F.floor((x + 180) / 6).cast("int") + 1
    zone = F.when((lat >= 56) & (lat < 64) & (x >= 3) & (x < 12), 32).otherwise(zone)
    north = (lat >= 72) & (lat < 84)
    for a, b, z in ((0, 9, 31), (9, 21, 33), (21, 33, 35), (33, 42, 37)):
        zone = F.when(north & (x >= a) & (x < b), z).otherwise(zone)
    return zone


def utm_letter(lat: Column) -> Column:
    """Band letter: eight degrees each from C at -80, X to 84, Z outside."""
    letters = "CDEFGHJKLMNPQRSTUVWX"
    i = F.least(F.floor((lat + 80) / 8).cast("int"), F.lit(len(letters) - 1))
    return F.when((lat >= -80) & (lat <= 84), F.substring(F.lit(letters), i + 1, F.lit(1))).otherwise("Z")


#: WGS 84 and the UTM scale.
WGS_A, WGS_F, UTM_K0 = 6378137.0, 1 / 298.257223563, 0.9996


#: The third flattening, the rectifying radius, and the Krueger series of order 4: forward, inverse, and of the latitude.
_N = WGS_F / (2 - WGS_F)
_RADIUS = WGS_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3 + 41 / 180 * _N**4, 13 / 48 * _N**2 - 3 / 5 * _N**3 + 557 / 1440 * _N**4, 61 / 240 * _N**3 - 103 / 140 * _N**4, 49561 / 161280 * _N**4)
_BETA = (_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3 - 1 / 360 * _N**4, 1 / 48 * _N**2 + 1 / 15 * _N**3 - 437 / 1440 * _N**4, 17 / 480 * _N**3 - 37 / 840 * _N**4, 4397 / 161280 * _N**4)
_DELTA = (2 * _N - 2 / 3 * _N**2 - 2 * _N**3 + 116 / 45 * _N**4, 7 / 3 * _N**2 - 8 / 5 * _N**3 - 227 / 45 * _N**4, 56 / 15 * _N**3 - 136 / 35 * _N**4, 4279 / 630 * _N**4)


def to_utm(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing (south of the equator without the false ten million) by the Krueger series of order 4."""
    e = float(2 * np.sqrt(_N) / (1 + _N))
    phi, d = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    atanh = lambda x: F.log((1 + x) / (1 - x)) / 2
    s = F.sin(phi)
    t = F.sinh(atanh(s) - e * atanh(e * s))
    xi, eta = F.atan2(t, F.cos(d)), atanh(F.sin(d) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + float(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + float(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000.0 + UTM_K0 * float(_RADIUS) * x, UTM_K0 * float(_RADIUS) * y


def from_utm(easting: Column, northing: Column, zone: Column) -> tuple[Column, Column]:
    """Longitude and latitude of to_utm()'s easting and northing."""
    xi, eta = northing / (UTM_K0 * float(_RADIUS)), (easting - 500000.0) / (UTM_K0 * float(_RADIUS))
    u, w = xi, eta
    for j, b in enumerate(_BETA, 1):
        u = u - float(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        w = w - float(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(w))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + float(d) * F.sin(2 * j * chi)
    return zone * 6 - 183 + F.degrees(F.atan2(F.sinh(w), F.cos(u))), F.degrees(lat)


def to_local(track: DataFrame) -> DataFrame:
    """track (part, ord, lon, lat, h) with x, y, z in metres from each part's first record, in the plain zone of that record.

    A part's first record comes from one aggregate (a row a part), not from a window over the track.
    """
    first = track.groupBy("part").agg(F.min_by(F.struct("lon", "lat", "h"), "ord").alias("o"))
    zone = (F.floor((F.col("o.lon") + 180) / 6) + 1).cast("int")
    x0, y0 = to_utm(F.col("o.lon"), F.col("o.lat"), zone)
    first = first.select("part", zone.alias("zone"), x0.alias("x0"), y0.alias("y0"), F.col("o.h").alias("h0"))
    x, y = to_utm(F.col("lon"), F.col("lat"), F.col("zone"))
    out = track.join(first, "part")
    return out.select(*track.columns, (x - F.col("x0")).alias("x"), (y - F.col("y0")).alias("y"), (F.col("h") - F.col("h0")).alias("z"), "zone", "x0", "y0", "h0")


def from_local(points: DataFrame) -> DataFrame:
    """points (x, y, z and to_local()'s zone, x0, y0, h0) with lon, lat, h."""
    lon, lat = from_utm(F.col("x") + F.col("x0"), F.col("y") + F.col("y0"), F.col("zone"))
    return points.withColumn("lon", lon).withColumn("lat", lat).withColumn("h", F.col("z") + F.col("h0"))


def interpolate_track(records: DataFrame, lines: DataFrame) -> DataFrame:
    """(part, line, x, a) of lines (part, line) from records (part, ord, time, x, vx, a; arrays of three).

    Positions by cubic pieces with the velocities as slopes (times a line's time, from the second to the third record), or,
    where any record of the part stands still, with those of a monotone interpolation, as for angles. Slopes come
    from the records beside; a line takes the piece that begins last before it. Lines outside of the records, and parts
    of fewer than three, give null.
    """
    o = W.partitionBy("part").orderBy("ord")
    r = records.withColumn("n", F.row_number().over(o)).withColumn("many", F.count(F.lit(1)).over(W.partitionBy("part")))
    still = F.forall("vx", lambda v: F.abs(v) < 1e-4)
    every = W.partitionBy("part")
    at = lambda c, i: F.max(F.when(F.col("n") == i, F.col(c))).over(every)
    r = r.withColumn("moves", ~F.coalesce(F.bool_or(still).over(every), F.lit(True)))
    r = r.withColumn("step", (at("time", 3) - at("time", 2)) / (at("ord", 3) - at("ord", 2)))
    r = r.withColumn("h0", F.col("ord") - F.lag("ord").over(o)).withColumn("h1", F.lead("ord").over(o) - F.col("ord"))
    channels = [(c, i) for c in ("x", "a") for i in range(3)]
    for c, i in channels:
        y = F.get(c, F.lit(i))
        r = r.withColumn(f"{c}{i}", y)
        before, after = (F.col(f"{c}{i}") - F.lag(f"{c}{i}").over(o)) / F.col("h0"), (F.lead(f"{c}{i}").over(o) - F.col(f"{c}{i}")) / F.col("h1")
        w0, w1 = 2 * F.col("h1") + F.col("h0"), F.col("h1") + 2 * F.col("h0")
        slope = F.when(before.isNull(), after).when(after.isNull(), before).when(before * after > 0, (w0 + w1) / (w0 / before + w1 / after)).otherwise(0.0)
        if c == "x":
            slope = F.when(F.col("moves"), F.get("vx", F.lit(i)) * F.col("step")).otherwise(slope)
        r = r.withColumn(f"d{c}{i}", slope)
    fields = [F.col("ord").cast("double").alias("o0"), F.lead("ord").over(o).cast("double").alias("o1")]
    for c, i in channels:
        fields += [F.col(f"{c}{i}").alias(f"{c}{i}"), F.lead(f"{c}{i}").over(o).alias(f"n{c}{i}"), F.col(f"d{c}{i}").alias(f"d{c}{i}"), F.lead(f"d{c}{i}").over(o).alias(f"m{c}{i}")]
    piece = F.when(F.col("h1").isNotNull() & (F.col("many") >= 3), F.struct(*fields))
    pieces = r.select("part", F.col("ord").cast("double").alias("at"), F.lit(0).alias("kind"), piece.alias("p"))
    wanted = lines.select("part", F.col("line").cast("double").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(pieces.schema["p"].dataType).alias("p"))
    back = W.partitionBy("part").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    found = pieces.unionByName(wanted).withColumn("p", F.last("p", ignorenulls=True).over(back)).filter("kind = 1")
    h, inside = F.col("p.o1") - F.col("p.o0"), F.col("at") <= F.col("p.o1")
    t = (F.col("at") - F.col("p.o0")) / h

    def value(c: str, i: int) -> Column:
        y0, y1, d0, d1 = (F.col(f"p.{k}{c}{i}") for k in ("", "n", "d", "m"))
        cubic = (1 + 2 * t) * (1 - t) * (1 - t) * y0 + t * (1 - t) * (1 - t) * h * d0 + t * t * (3 - 2 * t) * y1 + t * t * (t - 1) * h * d1
        return F.when(inside, cubic)

    return found.select("part", F.col("at").alias("line"), *(F.array(*(value(c, i) for i in range(3))).alias(c) for c in ("x", "a")))


def velocity_check(track: DataFrame) -> DataFrame:
    """Cosine and length ratio of the displacement and of the velocity integrated over it: track has part, ord, time, x, y, vx, vy."""
    o = W.partitionBy("part").orderBy("ord")
    d = lambda c: F.col(c) - F.lag(c).over(o)
    mid = lambda c: (F.col(c) + F.lag(c).over(o)) / 2 * d("time")
    t = track.withColumn("dx", d("x")).withColumn("dy", d("y")).withColumn("ix", mid("vx")).withColumn("iy", mid("vy")).filter("dx IS NOT NULL")
    size = lambda a, b: F.sqrt(F.col(a) * F.col(a) + F.col(b) * F.col(b))
    dot = F.col("dx") * F.col("ix") + F.col("dy") * F.col("iy")
    return t.select("part", "ord", F.try_divide(dot, size("dx", "dy") * size("ix", "iy")).alias("cosine"), F.try_divide(size("ix", "iy"), size("dx", "dy")).alias("ratio"))


def track_affine(p: tuple[float, float], q: tuple[float, float], u: tuple[float, float], w: tuple[float, float]) -> tuple[float, float, float, float]:
    """a, b, c, d of the similarity (x, y) to (a x - b y + c, b x + a y + d) that takes p to u and q to w."""
    m = np.array([[p[0], -p[1], 1, 0], [p[1], p[0], 0, 1], [q[0], -q[1], 1, 0], [q[1], q[0], 0, 1]], float)
    return tuple(np.linalg.solve(m, np.array([*u, *w], float)).tolist())


def rotation(angles: tuple[float, float, float]) -> np.ndarray:
    """Rz Rx Ry of three angles (x, y, z)."""
    (sx, sy, sz), (cx, cy, cz) = np.sin(angles), np.cos(angles)
    rx, ry, rz = np.array([[1, 0, 0], [0, cx, -sx], [0, sx, cx]]), np.array([[cy, 0, sy], [0, 1, 0], [-sy, 0, cy]]), np.array([[cz, -sz, 0], [sz, cz, 0], [0, 0, 1]])
    return rz @ rx @ ry


def to_quaternion(m: np.ndarray) -> np.ndarray:
    """w, x, y, z of a rotation matrix."""
    w = np.sqrt(max(0, 1 + m[0, 0] + m[1, 1] + m[2, 2])) / 2
    if w > 1e-8:
        return np.array([w, (m[2, 1] - m[1, 2]) / (4 * w), (m[0, 2] - m[2, 0]) / (4 * w), (m[1, 0] - m[0, 1]) / (4 * w)])
    values, vectors = np.linalg.eigh((m + m.T) / 2)
    return np.array([0.0, *vectors[:, np.argmax(values)]])


def camera_matrix(intrinsic: np.ndarray, own: np.ndarray, own_shift: np.ndarray, pose: np.ndarray, place: np.ndarray) -> np.ndarray:
    """3 by 4 projection of ground to image: intrinsics, axes turned by diag(-1, 1, -1), the camera's mount, then the pose."""
    r = own @ pose.T
    t = own_shift - r @ place
    return intrinsic @ np.diag([-1.0, 1.0, -1.0]) @ np.column_stack([r, t])


def to_plane(projection: np.ndarray, pixel: tuple[float, float], height: float) -> np.ndarray:
    """Ground point of a pixel on the plane z = height."""
    h = np.column_stack([projection[:, 0], projection[:, 1], projection[:, 2] * height + projection[:, 3]])
    p = np.linalg.inv(h) @ np.array([*pixel, 1.0])
    return np.array([p[0] / p[2], p[1] / p[2], height])


def gcp_grid(spark, model, samples: int, lines: int, height: float) -> DataFrame:
    """Nine control points: three samples and three lines at one height; model gives lon and lat of (sample, line, height)."""
    rows = [(float(s), float(y), *map(float, model(s, y, height)), float(height)) for y in np.linspace(0, lines - 1, 3) for s in np.linspace(0, samples - 1, 3)]
    return spark.createDataFrame(rows, "sample double, line double, lon double, lat double, h double")


#: The twenty terms of a rational polynomial in normalised P (latitude), L (longitude), H.
RPC_TERMS = ("1", "L", "P", "H", "L*P", "L*H", "P*H", "L*L", "P*P", "H*H", "P*L*H", "L*L*L", "L*P*P", "L*H*H", "L*L*P", "P*P*P", "P*H*H", "L*L*H", "P*P*H", "H*H*H")


def rpc_terms(p, q, h) -> list:
    """The terms' values for P = p, L = q, H = h: columns, numbers or arrays."""
    names, out = {"P": p, "L": q, "H": h}, []
    for term in RPC_TERMS:
        value = None
        for f in term.split("*"):
            value = (q * 0 + 1.0 if f == "1" else names[f]) if value is None else value * names[f]
        out.append(value)
    return out


def rpc_forward(rpc: dict, lon, lat, h):
    """line and sample of a ground point; rpc: offsets and scales by name, line_num, line_den, samp_num, samp_den (twenty each). For columns, numbers and arrays alike."""
    n = lambda v, name: (v - rpc[f"{name}_off"]) / rpc[f"{name}_scale"]
    t = rpc_terms(n(lat, "lat"), n(lon, "long"), n(h, "height"))

    def dot(c):
        total = None
        for a, x in zip(c, t, strict=True):
            total = x * float(a) if total is None else total + x * float(a)
        return total

    line = dot(rpc["line_num"]) / dot(rpc["line_den"]) * rpc["line_scale"] + rpc["line_off"]
    return line, dot(rpc["samp_num"]) / dot(rpc["samp_den"]) * rpc["samp_scale"] + rpc["samp_off"]


def rpc_inverse(rpc: dict, line: np.ndarray, sample: np.ndarray, h: np.ndarray, most: int = 21, close: float = 0.005) -> tuple[np.ndarray, np.ndarray]:
    """lon and lat at a height: Newton steps with differences of 1e-6 degrees. Each point stops by itself, when it is within `close` pixels."""
    lon, lat = np.full(len(line), float(rpc["long_off"])), np.full(len(line), float(rpc["lat_off"]))
    todo = np.arange(len(line))
    for _ in range(most):
        y, x = rpc_forward(rpc, lon[todo], lat[todo], h[todo])
        ey, ex = line[todo] - y, sample[todo] - x
        on = ~(np.hypot(ey, ex) < close)
        todo, y, x, ey, ex = todo[on], y[on], x[on], ey[on], ex[on]
        if not len(todo):
            break
        p, q, z = lon[todo], lat[todo], h[todo]
        (ya, xa), (yb, xb) = rpc_forward(rpc, p + 1e-6, q, z), rpc_forward(rpc, p, q + 1e-6, z)
        a, b, c, d = (ya - y) / 1e-6, (yb - y) / 1e-6, (xa - x) / 1e-6, (xb - x) / 1e-6
        det = a * d - b * c
        lon[todo], lat[todo] = p + (d * ey - b * ex) / det, q + (a * ex - c * ey) / det
    return lon, lat


def grid_shift(grid: dict, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """dx and dy of places by bilinear interpolation of a correction grid; 0 outside of it."""
    rows, cols = grid["dx"].shape
    u, v = np.asarray(x, float) / grid["step"][0], np.asarray(y, float) / grid["step"][1]
    i, j = np.trunc(v).astype(int), np.trunc(u).astype(int)
    inside = (i >= 0) & (i < rows - 1) & (j >= 0) & (j < cols - 1)
    i, j = np.where(inside, i, 0), np.where(inside, j, 0)
    fy, fx = v - i, u - j
    out = []
    for z in (grid["dx"], grid["dy"]):
        top, low = z[i, j] + fx * (z[i, j + 1] - z[i, j]), z[i + 1, j] + fx * (z[i + 1, j + 1] - z[i + 1, j])
        out.append(np.where(inside, top + fy * (low - top), 0.0))
    return out[0], out[1]


def image_of_photo(x, y, ab) -> tuple:
    """Image place of a photo place by the affine correction (six numbers: of the line, then of the sample)."""
    return x + ab[3] + ab[4] * x + ab[5] * y, y + ab[0] + ab[1] * x + ab[2] * y


def photo_of_image(x, y, ab) -> tuple:
    """The inverse of image_of_photo()."""
    t = (1 + ab[4]) * (1 + ab[2]) - ab[5] * ab[1]
    u, v = x - ab[3], y - ab[0]
    return ((1 + ab[2]) * u - ab[5] * v) / t, ((1 + ab[4]) * v - ab[1] * u) / t


def ground_to_photo(rpc: dict, lon: np.ndarray, lat: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """line and sample, the grid's correction added; places count from the centre of the first pixel."""
    line, sample = rpc_forward(rpc, lon, lat, h)
    if "grid" in rpc:
        dx, dy = grid_shift(rpc["grid"], sample, line)
        line, sample = line + dy, sample + dx
    return line, sample


def photo_to_ground(rpc: dict, line: np.ndarray, sample: np.ndarray, h: np.ndarray, image: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """lon and lat at a height; image: places are of the image, and the affine correction is taken off first. The grid's is taken off next."""
    if image and "affine" in rpc:
        sample, line = photo_of_image(sample, line, rpc["affine"])
    if "grid" in rpc:
        dx, dy = grid_shift(rpc["grid"], sample, line)
        line, sample = line - dy, sample - dx
    return rpc_inverse(rpc, line, sample, h)


def _frame(points: DataFrame, inputs: tuple[str, ...], outputs: tuple[str, ...], f) -> DataFrame:
    """points with columns of doubles from arrays of others."""
    from pyspark.sql.types import DoubleType, StructType

    names = points.columns

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = f(*(b.column(names.index(c)).to_numpy(zero_copy_only=False).astype(float) for c in inputs))
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, out)], names=[*names, *outputs])

    schema = StructType(list(points.schema.fields))
    for c in outputs:
        schema = schema.add(c, DoubleType())
    return points.mapInArrow(run, schema)


def rpc_inverse_frame(points: DataFrame, rpc: dict) -> DataFrame:
    """points (line, sample, h) with lon and lat."""
    return _frame(points, ("line", "sample", "h"), ("lon", "lat"), lambda y, x, h: rpc_inverse(rpc, y, x, h))


def ground_to_photo_frame(points: DataFrame, rpc: dict) -> DataFrame:
    """points (lon, lat, h) with line and sample, corrected by the grid."""
    return _frame(points, ("lon", "lat", "h"), ("line", "sample"), lambda *p: ground_to_photo(rpc, *p))


def photo_to_ground_frame(points: DataFrame, rpc: dict, image: bool = False) -> DataFrame:
    """points (line, sample, h) with lon and lat, corrected by the grid, and by the affine first if they are of the image."""
    return _frame(points, ("line", "sample", "h"), ("lon", "lat"), lambda *p: photo_to_ground(rpc, *p, image=image))


def rpc_fit(points: DataFrame, rounds: int = 25, ridge: float = 1e-6) -> dict:
    """A rational polynomial fitted to points (lon, lat, h, line, sample).

    Normal equations are sums over points (78 by 78, one partial sum a task), re-weighted by the denominators of
    the round before; offsets are means, scales half ranges, but the whole range for the height. The points' five numbers are
    written once, so that rounds do not work out their plan again.
    """
    names = {"long": "lon", "lat": "lat", "height": "h", "line": "line", "samp": "sample"}
    points = store.Kept(points.sparkSession)(points.select(*names.values()), "points")
    agg = points.agg(*(f(c).alias(f"{n}_{k}") for n, c in names.items() for k, f in (("off", F.avg), ("min", F.min), ("max", F.max)))).first()
    rpc = {}
    for n in names:
        rpc[f"{n}_off"] = agg[f"{n}_off"]
        rpc[f"{n}_scale"] = ((agg[f"{n}_max"] - agg[f"{n}_min"]) / (1 if n == "height" else 2)) or 1.0
    unit = np.array([1.0] + [0.0] * 19)
    rpc |= {"line_num": unit * 0, "line_den": unit, "samp_num": unit * 0, "samp_den": unit}
    best, best_rms = dict(rpc), np.inf
    for _ in range(rounds):
        now = dict(rpc)

        def run(batches, now=now):
            import pyarrow as pa

            total = {k: np.zeros((39, 40)) for k in ("line", "samp")}
            error, n = 0.0, 0
            for b in batches:
                lon, lat, h, line, sample = (b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("lon", "lat", "h", "line", "sample"))
                y, x = rpc_forward(now, lon, lat, h)
                error, n = error + float(((y - line) ** 2 + (x - sample) ** 2).sum()), n + len(line)
                norm = lambda v, k: (v - now[f"{k}_off"]) / now[f"{k}_scale"]
                t = np.stack(rpc_terms(norm(lat, "lat"), norm(lon, "long"), norm(h, "height")), 1)
                for k, v in (("line", norm(line, "line")), ("samp", norm(sample, "samp"))):
                    w = 1 / (t @ now[f"{k}_den"])
                    m = np.column_stack([t, -v[:, None] * t[:, 1:]]) * w[:, None]
                    total[k] += np.column_stack([m.T @ m, m.T @ (v * w)])
            yield pa.RecordBatch.from_pydict({"m": [np.concatenate([total["line"].ravel(), total["samp"].ravel(), [error, n]]).tobytes()]})

        sums = sum(np.frombuffer(r.m, float) for r in points.select(*names.values()).mapInArrow(run, "m binary").collect())  # one row a task
        rms = np.sqrt(sums[-2] / max(sums[-1], 1))
        if rms >= best_rms * (1 - 1e-9) and best_rms < np.inf:
            break
        best, best_rms = now, rms
        for i, k in enumerate(("line", "samp")):
            m = sums[i * 1560 : (i + 1) * 1560].reshape(39, 40)
            c = np.linalg.solve(m[:, :39] + ridge * np.eye(39), m[:, 39])
            rpc[f"{k}_num"], rpc[f"{k}_den"] = c[:20], np.concatenate([[1.0], c[20:]])
    return best | {"rms": float(best_rms)}


def intersect(images: list[tuple[dict, float, float]], start: tuple[float, float, float], most: int = 25) -> tuple[float, float, float]:
    """Ground point seen at (line, sample) in two or more images, by Gauss-Newton."""
    p, scale = np.array(start, float), np.array([1e-6, 1e-6, 1e-2])
    f = lambda q: np.concatenate([np.array(rpc_forward(r, *q)) - (y, x) for r, y, x in images])
    for _ in range(most):
        e = f(p)
        j = np.stack([(f(p + scale * u) - e) / scale[i] for i, u in enumerate(np.eye(3))], 1)
        d = np.linalg.lstsq(j * scale, -e, rcond=None)[0] * scale
        p = p + d
        if np.abs(d[:2]).max() < 1e-12 and abs(d[2]) < 1e-10:
            break
    return tuple(p.tolist())


def intersect_frame(seen: DataFrame, rpcs: dict[str, dict], image: bool = False, most: int = 25) -> DataFrame:
    """(id, lon, lat, h, images, rms) of points that are seen (id, image, line, sample) in two images or more, by Gauss-Newton; null for fewer.

    A point's sightings are one row; points are solved in batches, those with the same images together. image: the affine
    correction is taken off first.
    """
    import pyarrow as pa

    at = F.array_sort(F.collect_list(F.struct("image", F.col("line").cast("double").alias("line"), F.col("sample").cast("double").alias("sample"))))
    rows = seen.filter(F.col("image").isin(*rpcs)).groupBy("id").agg(at.alias("s"))

    def solve(names, y, x):
        n = y.shape[0]
        for k, name in enumerate(names):
            if image and "affine" in rpcs[name]:
                x[:, k], y[:, k] = photo_of_image(x[:, k], y[:, k], rpcs[name]["affine"])
        first, step = rpcs[names[0]], np.array([1e-6, 1e-6, 1e-2])
        p = np.tile([first["long_off"], first["lat_off"], first["height_off"]], (n, 1)).astype(float)
        f = lambda q: np.concatenate([np.stack([a - y[:, k], b - x[:, k]], 1) for k, r in enumerate(names) for a, b in [rpc_forward(rpcs[r], *q.T)]], axis=1)
        going = np.ones(n, bool)
        for _ in range(most):
            e = f(p)
            j = np.stack([(f(p + step * u) - e) for u in np.eye(3)], 2)  # in units of step
            normal = np.einsum("nij,nik->njk", j, j)
            d = np.linalg.solve(normal + 1e-18 * np.trace(normal, axis1=1, axis2=2)[:, None, None] * np.eye(3), -np.einsum("nij,ni->nj", j, e)[..., None])[..., 0] * step
            p = p + np.where(going[:, None], d, 0.0)
            going &= (np.abs(d[:, :2]).max(axis=1) >= 1e-12) | (np.abs(d[:, 2]) >= 1e-10)
            if not going.any():
                break
        return p, np.sqrt((f(p) ** 2).mean(axis=1))

    def run(batches):
        for b in batches:
            lists = b.column(1).to_pylist()
            out, rms = np.full((len(lists), 3), np.nan), np.full(len(lists), np.nan)
            groups = {}
            for i, s in enumerate(lists):
                groups.setdefault(tuple(q["image"] for q in s), []).append(i)
            for names, own in groups.items():
                if len(names) > 1:
                    y, x = (np.array([[q[c] for q in lists[i]] for i in own]) for c in ("line", "sample"))
                    out[own], rms[own] = solve(names, y, x)
            few = np.isnan(rms)
            columns = [pa.array(v, mask=few) for v in (*out.T, rms)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns[:3], pa.array([len(s) for s in lists], pa.int32()), columns[3]], names=["id", "lon", "lat", "h", "images", "rms"])

    kind = seen.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lon double, lat double, h double, images int, rms double")


def to_plane_frame(points: DataFrame, projection: np.ndarray) -> DataFrame:
    """points (u, v, h) with x, y: where the pixels' rays meet the planes z = h."""

    def f(u, v, h):
        m = np.stack([np.broadcast_to(projection[:, 0], (len(h), 3)), np.broadcast_to(projection[:, 1], (len(h), 3)), projection[:, 2] * h[:, None] + projection[:, 3]], 2)
        p = np.linalg.solve(m, np.stack([u, v, np.ones(len(u))], 1)[..., None])[..., 0]
        return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]

    return _frame(points, ("u", "v", "h"), ("x", "y"), f)


def rotation_columns(a: Column) -> list[list[Column]]:
    """rotation() of a column of three angles."""
    (sx, cx), (sy, cy), (sz, cz) = ((F.sin(F.get(a, F.lit(i))), F.cos(F.get(a, F.lit(i)))) for i in range(3))
    first, second = (cy, F.lit(0.0), sy), (sx * sy, cx, -sx * cy)
    return [[cz * f - sz * g for f, g in zip(first, second, strict=True)], [sz * f + cz * g for f, g in zip(first, second, strict=True)], [-cx * sy, sx, cx * cy]]


def quaternion_column(a: Column) -> Column:
    """w, x, y, z of the rotation by a column of three angles, w not negative; null where it is a half turn, whose sign is free."""
    m = rotation_columns(a)
    w = F.sqrt(F.greatest(F.lit(0.0), 1 + m[0][0] + m[1][1] + m[2][2])) / 2
    return F.when(w > 1e-8, F.array(w, *((m[i][j] - m[j][i]) / (4 * w) for i, j in ((2, 1), (0, 2), (1, 0)))))


def pixels_to_plane(pixels: DataFrame, intrinsic: np.ndarray, own: np.ndarray, own_shift: np.ndarray) -> DataFrame:
    """pixels (u, v, h; place and a: arrays of three, the platform's position and angles) with x, y: where rays meet the planes z = h.

    Each pixel has the pose of its own line, so a track's lines are columns and no matrix is built for any. The same as
    to_plane(camera_matrix(..)); null where a number is missing or a ray runs along the plane.
    """
    back = own.T @ np.diag([-1.0, 1.0, -1.0]) @ np.linalg.inv(intrinsic)
    shift = own.T @ own_shift
    u, v = F.col("u"), F.col("v")
    ray = [float(r[0]) * u + float(r[1]) * v + float(r[2]) for r in back]
    m = rotation_columns(F.col("a"))
    turned = lambda row, x: m[row][0] * x[0] + m[row][1] * x[1] + m[row][2] * x[2]
    at = lambda i: F.get("place", F.lit(i)) - turned(i, [F.lit(float(x)) for x in shift])
    along = F.try_divide(F.col("h") - at(2), turned(2, ray))
    return pixels.withColumns({"x": at(0) + along * turned(0, ray), "y": at(1) + along * turned(1, ray)})


def track_similarity(pairs: DataFrame) -> DataFrame:
    """pairs (px, py, qx, qy, ux, uy, wx, wy) with a, b, c, d of the similarity that takes p to u and q to w, as track_affine()."""
    dx, dy = F.col("qx") - F.col("px"), F.col("qy") - F.col("py")
    eu, ev = F.col("wx") - F.col("ux"), F.col("wy") - F.col("uy")
    n = dx * dx + dy * dy
    out = pairs.withColumn("a", F.try_divide(dx * eu + dy * ev, n)).withColumn("b", F.try_divide(dx * ev - dy * eu, n))
    return out.withColumn("c", F.col("ux") - F.col("a") * F.col("px") + F.col("b") * F.col("py")).withColumn("d", F.col("uy") - F.col("b") * F.col("px") - F.col("a") * F.col("py"))


def affine(x: Column, y: Column, m: tuple[float, ...]) -> tuple[Column, Column]:
    """m: a0 + a1 x + a2 y, b0 + b1 x + b2 y."""
    return m[0] + m[1] * x + m[2] * y, m[3] + m[4] * x + m[5] * y


def affine_inverse(x: Column, y: Column, m: tuple[float, ...]) -> tuple[Column, Column]:
    det = m[1] * m[5] - m[2] * m[4]
    u, v = x - m[0], y - m[3]
    return (m[5] * u - m[2] * v) / det, (m[1] * v - m[4] * u) / det
