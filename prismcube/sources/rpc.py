"""Rational polynomials in files: both text forms, the affine correction after them, and the grid beside them."""

from __future__ import annotations

import re
import struct

import numpy as np

from . import store, tiff

#: Names of the offsets and scales in a rational polynomial's text.
NAMES = ("line_off", "samp_off", "lat_off", "long_off", "height_off", "line_scale", "samp_scale", "lat_scale", "long_scale", "height_scale")
PARTS = ("line_num", "line_den", "samp_num", "samp_den")
#: The names of the group form, in the order of NAMES and PARTS, as two vendors write them.
GROUP_NAMES = ("lineOffset", "sampOffset", "latOffset", "longOffset", "heightOffset", "lineScale", "sampScale", "latScale", "longScale", "heightScale")
GROUP_PARTS = ("lineNumCoef", "lineDenCoef", "sampNumCoef", "sampDenCoef")
OTHER_NAMES = ("lineOffset", "pixelOffset", "latitudeOffset", "longitudeOffset", "heightOffset", "lineScale", "pixelScale", "latitudeScale", "longitudeScale", "heightScale")
OTHER_PARTS = ("lineNumeratorCoefficients", "lineDenominatorCoefficients", "pixelNumeratorCoefficients", "pixelDenominatorCoefficients")
AFFINE = "RFM_CORRECTION_PARAMETERS"
_NUMBER = r"[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?"


def parse(text: str) -> dict:
    """Offsets, scales, the four times twenty coefficients, and affine (six numbers), of `NAME: value [unit]` lines or of a group of `name = value;` and `name = (...);`."""
    out: dict = {}
    if re.search(r"^\s*LINE_OFF\s*:", text, re.M | re.I):
        for name in NAMES:
            if found := re.search(rf"^\s*{name}\s*:\s*({_NUMBER})", text, re.M | re.I):
                out[name] = float(found[1])
        for part in PARTS:
            found = re.findall(rf"^\s*{part}_coeff_(\d+)\s*:\s*({_NUMBER})", text, re.M | re.I)
            out[part] = np.array([float(v) for _, v in sorted(found, key=lambda x: int(x[0]))])
    else:
        for names, parts in ((GROUP_NAMES, GROUP_PARTS), (OTHER_NAMES, OTHER_PARTS)):
            for name, own in zip(NAMES, names, strict=True):
                if found := re.search(rf"^\s*{own}\s*=\s*({_NUMBER})", text, re.M | re.I):
                    out.setdefault(name, float(found[1]))
            for part, own in zip(PARTS, parts, strict=True):
                if found := re.search(rf"^\s*{own}\s*=\s*\(([^)]*)\)", text, re.M | re.I):
                    out.setdefault(part, np.array([float(x) for x in re.findall(_NUMBER, found[1])]))
    missing = [n for n in (*NAMES, *PARTS) if n not in out or n in PARTS and len(out[n]) != 20]
    if missing:
        raise ValueError(f"no rational polynomial: {', '.join(missing)} missing")
    if at := re.search(AFFINE, text, re.I):
        after = re.findall(rf"^\s*\S+\s+({_NUMBER})\s*$", text[at.end() :], re.M)
        if len(after) >= 6:
            out["affine"] = tuple(float(x) for x in after[:6])
    return out


def _affine_text(rpc: dict) -> str:
    names = ("R0", "R1", "R2", "C0", "C1", "C2")
    return f"{AFFINE}:\n" + "".join(f"{n}:  {v:.9E}\n" for n, v in zip(names, rpc.get("affine", (0.0,) * 6), strict=True))


def text(rpc: dict) -> str:
    """The line form, and the affine correction."""
    units = ("pixels", "pixels", "degrees", "degrees", "meters") * 2
    lines = [f"{n.upper()}: {float(rpc[n])!r} {u}\n" for n, u in zip(NAMES, units, strict=True)]
    lines += [f"{p.upper()}_COEFF_{i}: {float(v):.15E}\n" for p in PARTS for i, v in enumerate(rpc[p], 1)]
    return "".join(lines) + _affine_text(rpc)


def group_text(rpc: dict) -> str:
    """The group form, and the affine correction."""
    lines = ['satId = "XXX";\nbandId = "XXX";\nSpecId = "XXX";\nBEGIN_GROUP = IMAGE\n   errBias =   1.0;\n   errRand =   0.0;\n']
    lines += [f"   {own} = {float(rpc[n]):.15f};\n" for n, own in zip(NAMES, GROUP_NAMES, strict=True)]
    for part, own in zip(PARTS, GROUP_PARTS, strict=True):
        lines.append(f"   {own} = (\n" + ",\n".join(f"\t\t\t{float(v):.15e}" for v in rpc[part]) + ");\n")
    return "".join(lines) + "END_GROUP = IMAGE\nEND;\n" + _affine_text(rpc)


def grid_bytes(grid: dict) -> bytes:
    """columns, rows and steps as int32, then dx, dy of each point as int16 thousandths."""
    shift = np.round(np.stack([grid["dx"], grid["dy"]], -1) * 1000).astype("<i2")
    return struct.pack("<4i", shift.shape[1], shift.shape[0], grid["step"][0], grid["step"][1]) + shift.tobytes()


def parse_grid(data: bytes) -> dict:
    """dx, dy (rows, columns; pixels) and step (x, y)."""
    cols, rows, sx, sy = struct.unpack_from("<4i", data)
    shift = np.frombuffer(data, "<i2", offset=16, count=2 * cols * rows).reshape(rows, cols, 2) / 1000
    return {"dx": shift[..., 0], "dy": shift[..., 1], "step": (sx, sy)}


def load(path: str) -> dict:
    """A file's polynomial (of its tags, if it is a TIFF), with the grid of path.grd where there is one."""
    out = tiff.rpc_of(tiff.read_directory(path).tags) if path.lower().endswith((".tif", ".tiff")) else parse(store.read_text(path))
    if store.exists(path + ".grd"):
        with store.open_read(path + ".grd") as f:
            out["grid"] = parse_grid(f.read())
    return out


def save(path: str, rpc: dict, residuals: dict | None = None) -> None:
    """Writes .rpb as a group, all else as lines; the grid and the residuals of a fit go beside it."""
    store.write_text(path, group_text(rpc) if path.lower().endswith(".rpb") else text(rpc))
    if "grid" in rpc:
        with store.open_write(path + ".grd") as f:
            f.write(grid_bytes(rpc["grid"]))
    if residuals:
        store.write_text(path + ".res", "RPC Cal Result:\nsgma: {sx:.6f} \t  {sy:.6f}\nmax : {mx:.6f} \t  {my:.6f}\n".format(**residuals))
