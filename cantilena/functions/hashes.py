"""Spark's xxhash64 in plain Python, for helpers that must agree with it inside tasks."""

from __future__ import annotations

_M = (1 << 64) - 1
_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def _turned(x: int, by: int) -> int:
    x &= _M
    return (x << by | x >> 64 - by) & _M


def _lane(acc: int, k: int) -> int:
    return _turned(acc + k * _P2, 31) * _P1 & _M


def xxhash64(*values: int | str) -> int:
    """The signed hash of longs and strings."""
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & _M).to_bytes(8, "little")
        n, at = len(data), 0
        word = lambda i, size=8: int.from_bytes(data[i : i + size], "little")  # noqa: B023, E731
        if n >= 32:
            lanes = [h + _P1 + _P2, h + _P2, h, h - _P1]
            while at + 32 <= n:
                lanes, at = [_lane(x, word(at + 8 * i)) for i, x in enumerate(lanes)], at + 32
            h = sum(_turned(x, by) for x, by in zip(lanes, (1, 7, 12, 18), strict=True)) & _M
            for x in lanes:
                h = ((h ^ _lane(0, x)) * _P1 + _P4) & _M
        else:
            h = h + _P5 & _M
        h = h + n & _M
        while at + 8 <= n:
            h, at = (_turned(h ^ _lane(0, word(at)), 27) * _P1 + _P4) & _M, at + 8
        if at + 4 <= n:
            h, at = (_turned(h ^ word(at, 4) * _P1 & _M, 23) * _P2 + _P3) & _M, at + 4
        for b in data[at:]:
            h = _turned(h ^ b * _P5 & _M, 11) * _P1 & _M
        h = (h ^ h >> 33) * _P2 & _M
        h = (h ^ h >> 29) * _P3 & _M
        h ^= h >> 32
    return h - (1 << 64) if h >> 63 else h
