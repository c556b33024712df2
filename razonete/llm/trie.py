"""Compact memory-mapped levels of an n-gram trie: Elias-Fano sequences in segment files.

A level is cut into segments by ranges of its sorted keys. Tasks write a segment
each, into storage that all executors share, and readers map the files, so that
no task holds a level in its own memory.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.fs

HEADER = 4096
GUESSES = 4  # of the place of a number, before the numbers left are halved
READ = 1 << 12  # numbers between the bounds of all queries, that are read instead


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> str:
    """Write arrays to one file below a folder (a path or URI), whole or not at all; its place."""
    files, path = pa.fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    places, at = {}, HEADER
    for key, array in arrays.items():
        places[key] = (array.dtype.str, at, len(array))
        at += -(-array.nbytes // 64) * 64
    header = json.dumps(places).encode()
    if len(header) > HEADER:
        raise ValueError("too many arrays for one file")
    part = f"{path}/{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(header.ljust(HEADER))
        for array in arrays.values():
            out.write(np.ascontiguousarray(array).tobytes().ljust(-(-array.nbytes // 64) * 64, b"\0"))
    files.move(part, f"{path}/{name}")
    return f"{folder}/{name}"


def read_arrays(place: str) -> dict[str, np.ndarray]:
    """Arrays of a file: mapped where it is a local path, else read."""
    files, path = pa.fs.FileSystem.from_uri(place)
    source = pa.memory_map(path) if isinstance(files, pa.fs.LocalFileSystem) else files.open_input_file(path)
    buffer = source.read_buffer()
    places = json.loads(buffer[:HEADER].to_pybytes())
    return {key: np.frombuffer(buffer, kind, n, at) for key, (kind, at, n) in places.items()}


def pack(bits: np.ndarray) -> np.ndarray:
    """Bits, in 64-bit words with two words to spare."""
    data = np.packbits(bits, bitorder="little")
    return np.pad(data, (0, -len(data) % 8 + 16)).view("<u8")


MORE = np.uint16(1 << 15)  # marks a unit that is not the last one of its number


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in units of 15 bits, low ones first, each as many as it needs; and where each number's units end."""
    size = np.ones(len(values), np.int64)
    for shift in (15, 30, 45, 60):
        longer = values >> np.uint64(shift) > 0
        if not longer.any():
            break
        size += longer
    end = np.cumsum(size)
    out, begin = np.zeros(end[-1] if len(end) else 0, np.uint16), end - size
    for k in range(size.max(initial=0)):
        at = np.flatnonzero(size > k) if k else slice(None)
        unit = (values[at] >> np.uint64(15 * k) & np.uint64(0x7FFF)).astype(np.uint16)
        out[begin[at] + k] = unit | np.where(size[at] > k + 1, MORE, np.uint16(0))
    return out, end


def unpack_numbers(units: np.ndarray) -> np.ndarray:
    end = np.flatnonzero(units < MORE) + 1
    begin = np.append(0, end[:-1])[:len(end)]
    size, values = end - begin, np.zeros(len(end), np.uint64)
    for k in range(size.max(initial=0)):
        at = np.flatnonzero(size > k) if k else slice(None)
        values[at] |= (units[begin[at] + k] & ~MORE).astype(np.uint64) << np.uint64(15 * k)
    return values


def pack_counts(keys: np.ndarray, counts: np.ndarray, first: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Blocks of different keys in order (not negative, below 2^62) with their counts, each from `first[i]` on.

    Keys are differences with a bit that says whether the count is more than one; such counts follow in the second array.
    """
    steps = np.diff(keys, prepend=0)
    steps[first] = keys[first]
    often = counts > 1
    units, end = pack_numbers(steps.astype(np.uint64) << np.uint64(1) | often.astype(np.uint64))
    more, more_end = pack_numbers(counts[often].astype(np.uint64))

    def blocks(units: np.ndarray, end: np.ndarray, numbers: np.ndarray) -> pa.Array:
        offsets = np.append(0, end)[numbers].astype(np.int32) * np.int32(2)
        return pa.Array.from_buffers(pa.binary(), len(numbers) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(units.astype("<u2"))])

    bounds = np.append(first, len(keys))
    return blocks(units, end, bounds), blocks(more, more_end, np.append(0, np.cumsum(often))[bounds])


def unpack_counts(keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All keys of some blocks, in order and each once, and their counts added up."""
    units = np.frombuffer(b"".join(keys), "<u2")
    steps = unpack_numbers(units)
    often = (steps & np.uint64(1)).astype(bool)
    steps = (steps >> np.uint64(1)).astype(np.int64)
    begin = np.cumsum([0, *(len(block) // 2 for block in keys)])[:-1]
    first = np.cumsum(units < MORE)[begin - 1]  # numbers before each block
    first[begin == 0] = 0
    sums = np.cumsum(steps)
    found = sums - np.repeat(sums[first] - steps[first], np.diff(first, append=len(steps)))
    n = np.ones(len(found), np.int64)
    n[often] = unpack_numbers(np.frombuffer(b"".join(counts), "<u2")).astype(np.int64)
    order = np.argsort(found, kind="stable")  # blocks are in order already
    found, n = found[order], n[order]
    new = np.flatnonzero(np.append(True, found[1:] != found[:-1])[:len(found)])
    return found[new], np.add.reduceat(n, new) if len(new) else n


ONES, TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
# Place of the set bit number r (from 0) in each byte.
IN_BYTE = np.array([[*(i for i in range(8) if b >> i & 1), *[0] * 8][:8] for b in range(256)], np.uint8)


def select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the set bit number `rank` (from 1, at most as many as there are) in each word."""
    rank = rank.astype(np.uint64)
    count = words - (words >> np.uint64(1) & np.uint64(0x5555555555555555))
    count = (count & np.uint64(0x3333333333333333)) + (count >> np.uint64(2) & np.uint64(0x3333333333333333))
    upto = ((count + (count >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * ONES  # set bits up to each byte's end
    before = np.uint64(8) * (np.uint64(8) - np.bitwise_count(((upto | TOPS) - rank * ONES) & TOPS))
    before = np.minimum(before, np.uint64(56))
    left = rank - ((upto << np.uint64(8)) >> before & np.uint64(255))
    byte = words >> before & np.uint64(255)
    return before.astype(np.int64) + IN_BYTE[byte, (left - np.uint64(1)) & np.uint64(7)]


class EliasFano:
    """A monotone sequence of n numbers: their lower bits packed, their upper bits as counts in unary.

    `ones` has the set bits before each word of the upper part.
    """

    def __init__(self, n: int, width: int, distinct: bool, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.width, self.distinct, self.low, self.high, self.ones = n, width, distinct, low, high, ones
        self.mask = np.uint64((1 << width) - 1)

    @staticmethod
    def encode(values: np.ndarray) -> dict[str, np.ndarray]:
        """The arrays of a sorted sequence, `size` (n, lower bits, whether all differ) among them."""
        values = values.astype(np.uint64)
        n, most = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (most // n).bit_length() - 1) if n else 0
        lower = [((values[at:at + 65536, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
                 for at in range(0, n, 65536)]
        upper = np.zeros(n + (most >> width) + 2, np.uint8)
        upper[(values >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1
        high = pack(upper)
        ones = np.cumsum(np.bitwise_count(high), dtype=np.uint32)
        return {"size": np.array([n, width, (values[1:] > values[:-1]).all()], np.int64),
                "low": pack(np.concatenate([np.zeros(0, np.uint8), *lower])),
                "high": high, "ones": np.concatenate([np.zeros(1, np.uint32), ones[:-1]])}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], prefix: str = "") -> EliasFano:
        n, width, distinct = map(int, arrays[f"{prefix}size"])
        return cls(n, width, bool(distinct), arrays[f"{prefix}low"], arrays[f"{prefix}high"], arrays[f"{prefix}ones"])

    @cached_property
    def zeros(self) -> np.ndarray:
        """The unset bits before each word of the upper part."""
        return (64 * np.arange(len(self.ones)) - self.ones).astype(np.uint32)

    @cached_property
    def last(self) -> int:
        return int(self.get(np.array([self.n - 1]))[0])

    def lower(self, i: np.ndarray) -> np.ndarray:
        at = i * self.width
        word, shift = at >> 6, (at & 63).view(np.uint64)
        over = (self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return (self.low[word] >> shift | over) & self.mask

    def get(self, i: np.ndarray) -> np.ndarray:
        """Number i of the sequence, for each i from 0 to n - 1."""
        word = np.searchsorted(self.ones, i.astype(np.uint32), side="right") - 1
        place = 64 * word + select(self.high[word], i - self.ones[word] + 1)
        return (place - i).astype(np.uint64) << np.uint64(self.width) | self.lower(i)

    def all(self) -> np.ndarray:
        """All numbers."""
        place = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        i = np.arange(self.n)
        return (place - i).astype(np.uint64) << np.uint64(self.width) | self.lower(i)

    def _before(self, upper: np.ndarray) -> np.ndarray:
        """How many numbers have smaller upper bits."""
        word = np.maximum(np.searchsorted(self.zeros, upper.astype(np.uint32)) - 1, 0)
        place = 64 * word + select(~self.high[word], np.maximum(upper - self.zeros[word], 1))
        return np.where(upper > 0, place - upper + 1, 0)

    def _bucket(self, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first number with each upper part, and the one after the last: set bits in a row."""
        begin = self._before(upper)
        bit = begin + upper
        word, shift = bit >> 6, (bit & 63).view(np.uint64)
        run = self.high[word] >> shift | (self.high[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        size = np.bitwise_count(run & ~(run + np.uint64(1)))
        end = begin + size
        long = np.flatnonzero(size == 64)
        if len(long):
            end[long] = self._before(upper[long] + 1)
        return begin, end

    def _read(self, begin: np.ndarray, width: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`successor` among so many numbers (one at least) from `begin` on, by their lower bits."""
        first = np.cumsum(width) - width
        off = self.lower(np.arange(first[-1] + width[-1]) + np.repeat(begin - first, width)).view(np.int64) - np.repeat(lower, width)
        return begin + np.add.reduceat(off < 0, first, dtype=np.int64), np.logical_or.reduceat(off == 0, first)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first number not below each x (n if there is none), and whether it equals x.

        Numbers with the same upper part are taken to lie evenly: a place is guessed by the lower part, and corrected a few
        times by what is found there; after that, what is left between the bounds is halved. When that is little, all of it
        is read, as each round has a price of its own.
        """
        at, same = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        left = np.flatnonzero(x <= np.uint64(self.last)) if self.n else np.zeros(0, np.int64)
        if len(left) < len(x):
            x = x[left]
        begin, end = self._bucket((x >> np.uint64(self.width)).view(np.int64))
        lower = (x & self.mask).view(np.int64)
        at[left] = begin
        some = np.flatnonzero(begin < end)
        left, begin, end, lower = left[some], begin[some], end[some], lower[some]
        size = end - begin
        guess = begin + (size * lower >> self.width)
        step = 0
        while len(left):
            width = end - begin
            if width.sum() <= READ:
                at[left], same[left] = self._read(begin, width, lower)
                break
            off = lower - self.lower(guess).view(np.int64)
            less, equal = off > 0, off == 0
            begin, end = np.where(less, guess + 1, begin), np.where(less, end, guess)
            if self.distinct:
                begin = np.where(equal, guess, begin)  # and so is the end: it is found
            at[left] = begin
            same[left[equal]] = True
            some = np.flatnonzero(begin < end)
            left, begin, end, lower = left[some], begin[some], end[some], lower[some]
            step += 1
            if step < GUESSES:
                size, off, guess = size[some], off[some], guess[some]
                guess = np.clip(guess + (size * off >> self.width), begin, end - 1)
            else:
                guess = begin + end >> 1
        return at, same


def unique_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different key, by key, and the number of each key among them.

    Non-negative keys that leave room are sorted together with their places, which is faster than an indirect sort; so are
    keys of all 64 bits, with places instead of their last bits, unless keys differ in those alone and come out of order.
    """
    bits = max(1, int(len(keys)).bit_length())
    places = (1 << bits) - 1
    if len(keys) and 0 <= int(keys.min()) and int(keys.max()) < 1 << 63 - bits:
        both = np.sort(keys << bits | np.arange(len(keys)))
        order, ordered = both & places, both >> bits
    else:
        order = np.sort(keys & ~places | np.arange(len(keys))) & places
        ordered = keys[order]
        if (ordered[1:] < ordered[:-1]).any():
            order = np.argsort(keys)
            ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(first) - 1
    return order[first], number


def bounds_of(first: np.ndarray, queries: list[np.ndarray]) -> np.ndarray:
    """Where the queries of each segment begin, given its first key (a row); queries are sorted by (key, minor key)."""
    major, minor = queries
    out, end = (np.searchsorted(major, first[:, 0], side) for side in ("left", "right"))
    for i in np.flatnonzero(out < end):
        out[i] += np.searchsorted(minor[out[i]:end[i]], first[i, 1])
    return np.append(out, len(major))


class Level:
    """Segments of a level, opened where they are first needed."""

    def __init__(self, segments: list[tuple], opened: Callable[[dict[str, np.ndarray]], object]) -> None:
        """Segments (first major key, first minor key, rows before, place or places), in order."""
        self.segments, self.opened = segments, opened
        self.first = np.array([s[:2] for s in segments], np.int64).reshape(-1, 2)
        self.before = np.array([s[2] for s in segments], np.int64)
        self.open: dict[int, object] = {}

    def segment(self, i: int):
        if i not in self.open:
            self.open[i] = self.opened({k: v for place in self.segments[i][3:] for k, v in read_arrays(place).items()})
        return self.open[i]

    def parts(self, major: np.ndarray, minor: np.ndarray):
        """Segments with their rows before and the slice of the sorted queries that belongs to each."""
        bounds = bounds_of(self.first, [major, minor])
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                yield self.segment(i), self.before[i], slice(a, b)

    def rows(self, number: np.ndarray):
        """Segments, and which of the sorted row numbers each has, counted within it."""
        bounds = np.append(np.searchsorted(number, self.before), len(number))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                yield self.segment(i), number[a:b] - self.before[i], slice(a, b)
