"""Small helper that runs inside tasks of ``remove_mbc``."""

from __future__ import annotations


def cutter(prefixes):
    """A function over a pandas Series of bytes that cuts at each prefix until none is left."""

    def cut(series):
        return series.map(lambda raw: None if raw is None else cut_all(bytes(raw), prefixes))

    return cut


def cut_all(raw, prefixes):
    for prefix, length in prefixes:
        raw = _cut(raw, prefix, length)
    return raw


def _cut(raw, prefix, length):
    """One pass from left to right.

    Far from a cut the next prefix is searched in ``raw``.  Where a cut has joined two ends, bytes go to ``out``
    one by one, first those that the cut left over (``back``, last first), and a prefix is seen at its last byte.
    """
    size, out, back, at = len(prefix), bytearray(), bytearray(), 0
    while True:
        begin = raw.find(prefix, at)
        if begin < 0:
            return bytes(out + raw[at:])
        out += raw[at:begin]
        at, taken = begin + length, 0
        while back or taken < size - 1 and at + taken < len(raw):
            if back:
                out.append(back.pop())
            else:
                out.append(raw[at + taken])
                taken += 1
            if out.endswith(prefix):
                at, taken = at + taken, 0
                del out[-size:]
                back += prefix[length:][::-1]
                skip = max(0, length - size)
                gone = min(skip, len(back))
                del back[len(back) - gone:]
                at += skip - gone
        if taken:
            del out[-taken:]
