"""Small BSON writer for tests, independent of the package."""

import struct
import zlib


class Raw(bytes):
    """A ready value: first byte is the type code."""


def raw(kind, payload=b""):
    return Raw(bytes((kind,)) + payload)


def int64(v):
    return raw(0x12, struct.pack("<q", v))


def date(ms):
    return raw(0x09, struct.pack("<q", ms))


def timestamp(t, i):
    return raw(0x11, struct.pack("<II", i, t))


def binary(b, subtype=0):
    return raw(0x05, struct.pack("<iB", len(b), subtype) + b)


def value(v):
    if isinstance(v, Raw):
        return v[0], bytes(v[1:])
    if isinstance(v, bool):
        return 0x08, bytes((v,))
    if isinstance(v, int):
        return 0x10, struct.pack("<i", v)
    if isinstance(v, float):
        return 0x01, struct.pack("<d", v)
    if isinstance(v, str):
        b = v.encode()
        return 0x02, struct.pack("<i", len(b) + 1) + b + b"\0"
    if isinstance(v, dict):
        return 0x03, doc(v.items())
    if isinstance(v, list):
        return 0x04, doc((str(i), x) for i, x in enumerate(v))
    if v is None:
        return 0x0A, b""
    raise TypeError(v)


def doc(items):
    body = b""
    for k, v in items.items() if isinstance(items, dict) else items:
        kind, payload = value(v)
        body += bytes((kind,)) + k.encode() + b"\0" + payload
    return struct.pack("<i", len(body) + 5) + body + b"\0"


def varint(n):
    n &= 2**64 - 1
    out = b""
    while True:
        byte, n = n & 0x7F, n >> 7
        out += bytes((byte | (0x80 if n else 0),))
        if not n:
            return out


def chunk_payload(reference, n_keys, n_deltas, tokens, tail=b""):
    return doc(reference) + struct.pack("<II", n_keys, n_deltas) + b"".join(map(varint, tokens)) + tail


def packed(plain, declared=None):
    return struct.pack("<I", len(plain) if declared is None else declared) + zlib.compress(plain)


def metric(reference, n_keys, n_deltas, tokens, id_ms=0, tail=b"", declared=None):
    data = packed(chunk_payload(reference, n_keys, n_deltas, tokens, tail), declared)
    return doc({"_id": date(id_ms), "type": 1, "data": binary(data)})


def sequential_deltas(tokens, cells):
    """Deltas of a token stream, one token at a time; (deltas, error)."""
    it, out, run = iter(tokens), [], 0
    try:
        while len(out) < cells:
            if run:
                run -= 1
                out.append(0)
                continue
            t = next(it)
            if t == 0:
                run = next(it)
            out.append(t)
    except StopIteration:
        return out, "bad_varint"
    if run:
        return out, "zero_run_left"
    return out, "tokens_left" if next(it, None) is not None else None
