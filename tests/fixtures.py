"""Small generated fixtures: PNG / BMP images (valid, junk, truncated) and a pair tree."""

import os
import struct
import zlib


def png_bytes(w: int, h: int, color=(200, 10, 10)) -> bytes:
    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + bytes(color) * w for _ in range(h))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def bmp_bytes(w: int, h: int, color=(10, 200, 10)) -> bytes:
    row = bytes(color[::-1]) * w
    row += b"\x00" * ((4 - len(row) % 4) % 4)
    pixels = row * h
    header = b"BM" + struct.pack("<IHHI", 54 + len(pixels), 0, 0, 54)
    dib = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(pixels), 2835, 2835, 0, 0)
    return header + dib + pixels


def write(path: str, data) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data.encode() if isinstance(data, str) else data)


def pair_tree(root: str) -> str:
    """Folder tree with the edge cases of a dataset folder (see FIXTURES F9)."""
    a, b = os.path.join(root, "w00000"), os.path.join(root, "w00001")
    write(f"{a}/000000000.txt", "a small red square")
    write(f"{a}/000000000.png", png_bytes(4, 3))
    write(f"{a}/000000000.json", '{"b": 1, "a": [1, 2]}')
    write(f"{a}/000000001.txt", "abc")                      # short text
    write(f"{a}/000000001.bmp", bmp_bytes(5, 2))
    write(f"{a}/000000002.txt", "text without image")       # incomplete
    write(f"{a}/000000003.png", png_bytes(2, 2))            # incomplete
    write(f"{b}/000000004.txt", "caption of a junk file")
    write(f"{b}/000000004.jpeg", b"this is not an image")   # corrupt
    write(f"{b}/000000004.json", '{"broken": ')              # corrupt sidecar
    write(f"{b}/000000005.txt", "caption of a truncated png")
    write(f"{b}/000000005.png", png_bytes(8, 8)[:40])       # truncated
    write(f"{b}/000000000.txt", "same stem, other folder")
    write(f"{b}/000000000.png", png_bytes(3, 3))
    return root


# --- TFRecord files -------------------------------------------------------------------------

def _varint(v: int) -> bytes:
    v &= (1 << 64) - 1
    out = bytearray()
    while v > 0x7F:
        out.append(v & 0x7F | 0x80)
        v >>= 7
    return bytes([*out, v])


def _sized(num: int, payload: bytes) -> bytes:
    return _varint((num << 3) | 2) + _varint(len(payload)) + payload


def example(features: dict) -> bytes:
    """``{name: bytes | str | int | float | list}`` as a serialized ``Example``."""
    entries = b""
    for name, value in features.items():
        vals = value if isinstance(value, list) else [value]
        if all(isinstance(v, (bytes, str)) for v in vals):
            feature = _sized(1, b"".join(_sized(1, v.encode() if isinstance(v, str) else v) for v in vals))
        elif all(isinstance(v, int) for v in vals):
            feature = _sized(3, _sized(1, b"".join(map(_varint, vals))))
        else:
            feature = _sized(2, _sized(1, struct.pack(f"<{len(vals)}f", *vals)))
        entries += _sized(1, _sized(1, name.encode()) + _sized(2, feature))
    return _sized(1, entries)


def framed(payload: bytes) -> bytes:
    """A record with its two checksums."""
    from capset.sources.tfrecord import masked_crc

    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def records(path: str, examples) -> None:
    write(path, b"".join(framed(example(e)) for e in examples))
