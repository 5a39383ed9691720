"""Sorted hash arrays in a folder that all workers can reach, written once and memory-mapped.

A file holds named arrays behind one header. Files are written under a temporary name and moved into place, so a
task that is repeated or lost leaves whole files only, and the same ones.

Two kinds of keys are used. ``Sorted`` keeps whole 64-bit hashes. ``Compact`` cuts a hash in two: the upper bits are
told by the bucket (two to four hashes share one), the next 32 bits are stored. Hashes are even, so a bucket begins near
its share of them and only the difference is stored, in two bytes. An absent hash is then taken for a
present one about once in 500 million lookups, however many hashes there are, in half the space.
"""

from __future__ import annotations

import json
import mmap
import os
import uuid

import numpy as np

ALIGN = 64
BUCKET = 4


def local_path(folder: str) -> str:
    """The folder as workers open it. The shared folder has to be mounted: only a file can be memory-mapped."""
    scheme, colon, rest = folder.partition(":")
    if colon and scheme == "file":
        return "/" + rest.lstrip("/")
    if not folder.startswith("/"):
        raise ValueError(f"memory-mapped models need a mounted shared folder, not {folder}")
    return folder


def write_arrays(path: str, **arrays: np.ndarray) -> None:
    """Write ``arrays`` to a file, whole or not at all."""
    held = {name: np.ascontiguousarray(a) for name, a in arrays.items()}
    at, header = 0, {}
    for name, a in held.items():
        header[name] = (a.dtype.str, a.size, at)
        at += -(-a.nbytes // ALIGN) * ALIGN
    head = json.dumps(header).encode()
    head += b" " * (-(len(head) + 8) % ALIGN)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    passing = f"{path}.{uuid.uuid4().hex}"
    with open(passing, "wb") as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for a in held.values():
            out.write(a.tobytes())
            out.write(b"\0" * (-a.nbytes % ALIGN))
    os.replace(passing, path)


def map_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped."""
    with open(path, "rb") as file:
        raw = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    header = json.loads(raw[8 : 8 + size].tobytes())
    found = {}
    for name, (kind, n, at) in header.items():
        begin = 8 + size + at
        found[name] = raw[begin : begin + n * np.dtype(kind).itemsize].view(kind)
    return found


def mixed(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each tuple of ids (the finalizer of splitmix64 over a running value)."""
    x = np.zeros(len(parts[0]), np.uint64)
    for number, part in enumerate(parts):
        x ^= part.astype(np.int64, copy=False).view(np.uint64)
        x += np.uint64(0x9E3779B97F4A7C15 * (number + 1) & (1 << 64) - 1)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def find_sorted(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions of ``wanted`` among sorted ``keys``, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def compact(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, low)`` of sorted ``hashes``: how far from its share each bucket of upper bits begins, and the 32 bits below them."""
    bits = max(1, (len(hashes) // BUCKET).bit_length())
    top = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    buckets = np.arange((1 << bits) + 1)
    starts = np.searchsorted(top, buckets) - (buckets * len(hashes) >> bits)
    small = not len(hashes) or np.abs(starts).max() < 1 << 15
    return starts.astype(np.int16 if small else np.int64), (hashes >> np.uint64(32 - bits)).astype(np.uint32)


def find_compact(starts: np.ndarray, low: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions of ``wanted`` hashes among those that ``compact`` was given, -1 where absent."""
    return find_dealt([(starts, low)], np.array([0, len(wanted)]), wanted)


def find_dealt(files: list[tuple[np.ndarray, np.ndarray]], cuts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``find_compact`` in several files: ``wanted[cuts[i] : cuts[i + 1]]`` are looked for in the file ``i``.

    Files are only read where they are asked; all else is done at once, as a file may get few hashes.
    """
    own = np.diff(cuts)
    bits = np.repeat(np.array([(len(starts) - 1).bit_length() - 1 for starts, _ in files], np.uint64), own)
    top = (wanted >> np.uint64(64) - bits).astype(np.int64)
    low_bits = (wanted >> np.uint64(32) - bits).astype(np.uint32)
    bits = bits.astype(np.int64)
    size = np.repeat(np.array([len(low) for _, low in files], np.int64), own)
    first, last = top * size >> bits, (top + 1) * size >> bits
    del bits, size
    spans = [(at, slice(begin, end)) for at, (begin, end) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if begin < end]
    for at, span in spans:
        starts, place = files[at][0], top[span]
        first[span] += starts[place]
        place += 1
        last[span] += starts[place]
    # All entries of the buckets, next to each other.
    last -= first
    ends = np.cumsum(last)
    query = np.repeat(np.arange(len(wanted)), last)
    first -= ends - last
    place = np.repeat(first, last)
    place += np.arange(len(query))
    held, bounds = np.empty(len(place), np.uint32), np.concatenate([[0], ends])[cuts].tolist()
    for at, _ in spans:
        span = slice(bounds[at], bounds[at + 1])
        held[span] = files[at][1][place[span]]
    same = np.flatnonzero(held == low_bits[query])
    found = np.full(len(wanted), -1, np.int64)
    found[query[same]] = place[same]
    return found
