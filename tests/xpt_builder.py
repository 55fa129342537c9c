"""Build tiny SAS transport (version 5) files for tests.

Layout from the public SAS technical note TS-140: 80-byte header records,
140-byte variable descriptors, observations of 8-byte IBM floats.
"""

from __future__ import annotations

import math
import struct


def _rec(text: str) -> bytes:
    b = text.encode("ascii")
    assert len(b) <= 80
    return b.ljust(80, b" ")


def _hdr(kind: str, tail: str = "0" * 30) -> bytes:
    return _rec(f"HEADER RECORD*******{kind:<8}HEADER RECORD!!!!!!!{tail}")


def ibm_float(x: float | None) -> bytes:
    """8-byte IBM hexadecimal float; None is the missing value '.'."""
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return b"." + b"\x00" * 7
    if x == 0:
        return b"\x00" * 8
    sign = 0x80 if x < 0 else 0
    x = abs(x)
    exp = 0
    while x >= 1:
        x /= 16.0
        exp += 1
    while x < 1 / 16.0:
        x *= 16.0
        exp -= 1
    mant = int(round(x * (1 << 56)))
    if mant >= 1 << 56:
        mant >>= 4
        exp += 1
    return bytes([sign | (exp + 64)]) + mant.to_bytes(7, "big")


def build_xpt(columns: list[str], rows: list[tuple], name: str = "DATA") -> bytes:
    date = "01JAN24:00:00:00"
    out = bytearray()
    out += _hdr("LIBRARY")
    out += _rec(f"{'SAS':<8}{'SAS':<8}{'SASLIB':<8}{'9.4':<8}{'X64_7PRO':<8}{'':<24}{date}")
    out += _rec(date)
    out += _hdr("MEMBER", "000000000000000001600000000140")
    out += _hdr("DSCRPTR")
    out += _rec(f"{'SAS':<8}{name:<8}{'SASDATA':<8}{'9.4':<8}{'X64_7PRO':<8}{'':<24}{date}")
    out += _rec(f"{date}{'':<16}{'':<40}{'':<8}")
    out += _hdr("NAMESTR", f"000000{len(columns):04d}" + "0" * 20)
    desc = bytearray()
    for i, col in enumerate(columns):
        desc += struct.pack(">hhhh8s40s8shhh2s8shhl52s", 1, 0, 8, i + 1, col.encode().ljust(8),
                            b"".ljust(40), b"".ljust(8), 0, 0, 0, b"  ", b"".ljust(8), 0, 0, i * 8, b"\x00" * 52)
    if len(desc) % 80:
        desc += b" " * (80 - len(desc) % 80)
    out += desc
    out += _hdr("OBS")
    data = bytearray()
    for r in rows:
        for v in r:
            data += ibm_float(v)
    if len(data) % 80:
        data += b" " * (80 - len(data) % 80)
    out += data
    return bytes(out)
