"""Tensor files: a zip of raw number arrays and a pickle that says how they are laid out.

Only the few names that such a pickle needs are resolved, so a file cannot run code.
"""

from __future__ import annotations

import collections
import io
import pickle
import struct
import zipfile

import numpy as np

NAMES = ("points", "xyz", "pos")  # of a map, the first there is

#: Storage classes of the format and their numbers.
STORAGES = {"FloatStorage": "f4", "DoubleStorage": "f8", "HalfStorage": "f2", "LongStorage": "i8", "IntStorage": "i4", "ShortStorage": "i2", "CharStorage": "i1", "ByteStorage": "u1", "BoolStorage": "?"}


class _Reader(pickle.Unpickler):
    def __init__(self, data: bytes, archive: zipfile.ZipFile, root: str, order: str):
        super().__init__(io.BytesIO(data))
        self.archive, self.root, self.order = archive, root, order

    def find_class(self, module: str, name: str):
        if module == "torch" and name in STORAGES:
            return STORAGES[name]
        if (module, name) == ("torch._utils", "_rebuild_tensor_v2"):
            return _strided
        if (module, name) == ("collections", "OrderedDict"):
            return collections.OrderedDict
        raise pickle.UnpicklingError(f"{module}.{name} has no place in a tensor file")

    def persistent_load(self, pid: tuple) -> np.ndarray:
        _, kind, key, _, count = pid
        return np.frombuffer(self.archive.read(f"{self.root}data/{key}"), np.dtype(kind).newbyteorder(self.order), count)


def _strided(storage: np.ndarray, offset: int, size: tuple, stride: tuple, *_) -> np.ndarray:
    last = offset + sum((n - 1) * s for n, s in zip(size, stride, strict=True)) if all(size) else 0
    if min((offset, *size, *stride)) < 0 or all(size) and last >= len(storage):
        raise ValueError("a tensor reaches beyond its storage")
    return np.lib.stride_tricks.as_strided(storage[offset:], size, [s * storage.itemsize for s in stride]).copy()


def load(content: bytes):
    """What a tensor file holds, with tensors as arrays."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        head = next(n for n in archive.namelist() if n.endswith("data.pkl"))
        root = head.removesuffix("data.pkl")
        order = ">" if f"{root}byteorder" in archive.namelist() and archive.read(f"{root}byteorder") == b"big" else "<"
        return _Reader(archive.read(head), archive, root, order).load()


def points(content: bytes) -> np.ndarray:
    """The points of a file that holds a tensor, or a map with one under one of NAMES."""
    held = load(content)
    while isinstance(held, dict):
        held = next((held[k] for k in NAMES if k in held), None)
    if held is None:
        raise ValueError(f"none of {', '.join(NAMES)} in the file")
    return held


def dump(array: np.ndarray) -> bytes:
    """A tensor file of one array of single-precision numbers."""
    array = np.ascontiguousarray(array, "<f4")

    def text(value: str) -> bytes:
        return b"X" + struct.pack("<I", len(value.encode())) + value.encode()

    def number(value: int) -> bytes:
        return b"J" + struct.pack("<i", value) if value < 1 << 31 else b"\x8a\x08" + struct.pack("<q", value)

    def numbers(values: tuple[int, ...]) -> bytes:
        return b"(" + b"".join(map(number, values)) + b"t"

    storage = b"(" + text("storage") + b"ctorch\nFloatStorage\n" + text("0") + text("cpu") + number(array.size) + b"tQ"
    strides = tuple(s // 4 for s in array.strides)
    layout = b"(" + storage + number(0) + numbers(array.shape) + numbers(strides) + b"\x89ccollections\nOrderedDict\n)Rt"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for name, data in (("data.pkl", b"\x80\x02ctorch._utils\n_rebuild_tensor_v2\n" + layout + b"R."), ("byteorder", b"little"), ("data/0", array.tobytes()), ("version", b"3\n")):
            archive.writestr(zipfile.ZipInfo(f"archive/{name}"), data)
    return out.getvalue()
