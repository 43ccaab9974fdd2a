"""What tasks do with the pieces of `blocks`: arrays of whole batches, no text becomes a Python object.

A task gets the pieces of a block one after the other, so it needs no order and no exchange to know how a reader
comes to each of them; it holds one batch and the record it is amid. A piece's text ends with the separator, so
the text of a record is a slice of its batch. Functions go to the executors by value: those need no copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Effects of pieces: left inside if entered outside, if entered inside; added to the depth in these cases.
Effects = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts, and the last one ends, among the bytes of all."""
    _, at, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(at, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64), np.frombuffer(data, np.uint8)


def given(batch: pa.RecordBatch, at: np.ndarray, data: np.ndarray) -> Effects:
    """Effects that come as columns `_out` and `_in`; there is no depth."""
    none = np.zeros(batch.num_rows, np.int64)
    return batch.column("_out").to_numpy(zero_copy_only=False), batch.column("_in").to_numpy(zero_copy_only=False), none, none


def of_json(batch: pa.RecordBatch, at: np.ndarray, data: np.ndarray) -> Effects:
    """Effects of JSON text. A quote behind an odd number of backslashes leaves a reader inside; any other one turns it."""
    data, at, n = data[at[0]:at[-1]], at - at[0], batch.num_rows
    quotes, slashes = np.flatnonzero(data == 34), np.flatnonzero(data == 92)
    held = np.zeros(len(quotes), bool)
    if len(slashes):
        last = np.flatnonzero(np.append(np.diff(slashes) != 1, True))  # of each run of backslashes
        behind = np.zeros(len(data) + 1, bool)
        behind[slashes[last[np.diff(last, prepend=-1) % 2 == 1]] + 1] = True
        held = behind[quotes]
    first = np.searchsorted(quotes, at)
    own = np.repeat(first[:-1], np.diff(first))  # the first quote of each quote's piece
    turns = np.append(0, np.cumsum(~held))
    set_by = np.maximum.accumulate(np.where(held, np.arange(len(quotes)), -1))
    known = set_by >= own
    odd = (turns[1:] - turns[np.where(known, set_by + 1, own)]) % 2 == 1
    out, into = np.append(odd ^ known, False), np.append(~odd, True)  # behind each quote; the last ones stand for none
    low = data | 32
    marks = np.flatnonzero((low == 123) | (low == 125))
    piece, quote = np.searchsorted(at, marks, "right") - 1, np.searchsorted(quotes, marks) - 1
    quote = np.where(quote >= first[piece], quote, -1)
    adds = np.where(low[marks] == 123, 1, -1)
    total = lambda inside: np.bincount(piece, np.where(inside[quote], 0, adds), n).astype(np.int64)
    ends = np.where(np.diff(first) > 0, first[1:] - 1, -1)
    return out[ends], into[ends], total(out), total(into)


def states(out: np.ndarray, into: np.ndarray, entered: bool) -> np.ndarray:
    """Whether a reader that comes to the first piece inside (`entered`) comes to each piece inside, and leaves the last.

    A piece either leaves the state, turns it, or sets it whatever it was; so the state is what was set last,
    turned as often as pieces turned it since.
    """
    turns = np.append(0, np.cumsum(out & ~into))
    last = np.append(0, np.maximum.accumulate(np.where(out == into, np.arange(1, len(out) + 1), 0)))
    return np.append(entered, out)[last] ^ ((turns - turns[last]) % 2 == 1)


def runs(batch: pa.RecordBatch) -> list[tuple[tuple[str, int], int, int]]:
    """Block (file and start) and first and last row (exclusive) of its pieces; those of a block follow one another."""
    files, blocks, n = batch.column("_file"), batch.column("_block"), batch.num_rows
    key, found, start = lambda i: (files[i].as_py(), blocks[i].as_py()), [], 0
    while start < n:
        low, high, own = start, n - 1, key(start)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if key(mid) == own else (low, mid - 1)
        found.append((own, start, low + 1))
        start = low + 1
    return found


def block_effects(effects: Callable) -> Callable:
    """Rows `_file, _block, _length, _out, _in, _sum_out, _sum_in`: what each block does to a reader and adds to the depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, length, state, total = None, 0, [], []
        row = lambda: pa.RecordBatch.from_pylist([dict(zip(
            ("_file", "_block", "_length", "_out", "_in", "_sum_out", "_sum_in"), (*block, length, *map(bool, state), *map(int, total))))])
        for batch in batches:
            if not batch.num_rows:
                continue
            found = effects(batch, *texts(batch.column("value")))
            for own, a, b in runs(batch):
                if own != block:
                    if block:
                        yield row()
                    block, length, state, total = own, batch.column("_length")[a].as_py(), [False, True], [0, 0]
                out, into, d_out, d_in = (x[a:b] for x in found)
                for k in (0, 1):
                    inside = states(out, into, state[k])
                    state[k], total[k] = inside[-1], total[k] + np.where(inside[:-1], d_in, d_out).sum()
        if block:
            yield row()
    return run


def records(effects: Callable, whole: bool) -> Callable:
    """Rows `value, _file, _block, _at, _head, _end` of pieces with `_entry`, `_base` and `_final` of their block.

    With `whole`, the records that end before the last one of their block begins. Otherwise the rest: the last one as far
    as the block has it, and, without `_at`, what lies ahead of the first one.
    """
    names = ["value", "_file", "_block", "_at", "_head", "_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, begun, head, final, state, depth, blank = None, [], None, False, False, False, 0, True

        def one(kind: pa.DataType, end: bool) -> pa.RecordBatch:
            text = b"".join(held)
            at = np.array([0, len(text)], np.int64 if pa.types.is_large_string(kind) else np.int32)
            value = pa.Array.from_buffers(kind, 1, [None, pa.py_buffer(at), pa.py_buffer(text)])
            return pa.RecordBatch.from_arrays([
                value, pa.array([block[0]], kind), pa.array([block[1]], pa.int64()), pa.array([begun], pa.int64()),
                pa.array([head]), pa.array([end])], names=names)

        kind = pa.string()
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.column("value").type
            offsets, data = texts(batch.column("value"))
            found, place = effects(batch, offsets, data), batch.column("_at").to_numpy()
            for own, a, b in runs(batch):
                if own != block:
                    if held and not whole:
                        yield one(kind, final)
                    block, held, begun, head, blank = own, [], None, False, own[1] == 0
                    state, depth, final = (batch.column(c)[a].as_py() for c in ("_entry", "_base", "_final"))
                out, into, d_out, d_in = (x[a:b] for x in found)
                inside = states(out, into, state)
                added = np.where(inside[:-1], d_in, d_out)
                start = a + np.flatnonzero(~inside[:-1] & (depth + np.cumsum(added) - added <= 1))
                state, depth = inside[-1], depth + added.sum()
                full = np.flatnonzero(np.diff(offsets[a:b + 1]) > 1) if blank else []
                top, blank = (a + full[0], False) if len(full) else (-1, blank)
                # What was begun before goes on to the first start, or to the end.
                cut = start[0] if len(start) else b
                if cut > a:
                    held.append(data[offsets[a]:offsets[cut]].tobytes())
                    head |= a <= top < cut
                if not len(start):
                    continue
                if held and whole == (begun is not None):
                    yield one(kind, False)
                if whole and len(start) > 1:
                    at, many = offsets[start], len(start) - 1
                    bounds = (at - at[0]).astype(np.int64 if pa.types.is_large_string(kind) else np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.Array.from_buffers(kind, many, [None, pa.py_buffer(bounds), pa.py_buffer(data[at[0]:at[-1]])]),
                        batch.column("_file").slice(a, many), batch.column("_block").slice(a, many), pa.array(place[start[:-1]]),
                        pa.array((start[:-1] <= top) & (top < start[1:])), pa.array(np.zeros(many, bool))], names=names)
                held, begun, head = [data[offsets[start[-1]]:offsets[b]].tobytes()], place[start[-1]], start[-1] <= top
        if held and not whole:
            yield one(kind, final)
    return run
