"""Which hashes of a chunk occur elsewhere: questions and answers for ``exchange``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from . import exchange as ex


def questions(hashes: np.ndarray, n: int, beside: list[np.ndarray], first: int = 0) -> Iterator[tuple[int, bytes]]:
    """One question per bucket, counted from ``first``: sorted hashes and the arrays beside them."""
    cuts = ex.split(hashes, n)
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[b], cuts[b + 1])
        yield first + b, ex.frame([ex.pack_sorted(hashes[own]), *(ex.pack(x[own]) for x in beside)])


def repeated(asked: list[bytes]) -> list[bytes]:
    """A bit per asked hash: does it occur twice or more? (hashes, twice in the chunk)"""
    parts = [ex.unframe(q) for q in asked]
    hashes = [ex.unpack_sorted(p[0]) for p in parts]
    twice = np.concatenate([ex.unpack(p[1]) for p in parts]).astype(bool)
    known, inverse, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    many = n > 1
    many[inverse[twice]] = True
    return [np.packbits(f).tobytes() for f in np.split(many[inverse], np.cumsum([len(h) for h in hashes])[:-1])]


def bits(answers: list[bytes], hashes: np.ndarray, n: int, each: int = 1) -> np.ndarray:
    """The answers for a chunk's sorted hashes: a row per hash of ``each`` bits."""
    out = [np.unpackbits(np.frombuffer(a, np.uint8), count=each * size)
           for a, size in zip(answers, sizes(hashes, n), strict=True)]
    return (np.concatenate(out) if out else np.empty(0, np.uint8)).astype(bool).reshape(-1, each)


def sizes(hashes: np.ndarray, n: int) -> list[int]:
    """How many hashes each question of the chunk held."""
    sizes = np.diff(ex.split(hashes, n))
    return sizes[sizes > 0].tolist()


def labels(answers: list[bytes], hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Source of each distinct edge; start -1 where it occurs only once."""
    ids, starts, done = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1, np.int64), 0
    for answer, size in zip(answers, sizes(hashes, n), strict=True):
        flags, source, start = ex.unframe(answer)
        f = np.flatnonzero(np.unpackbits(np.frombuffer(flags, np.uint8), count=size)) + done
        ids[f], starts[f] = ex.unpack(source), ex.unpack(start).astype(np.int64)
        done += size
    return ids, starts


def sources(asked: list[bytes]) -> list[bytes]:
    """For each asked edge its source (doc_id, start), if it occurs elsewhere too; else nothing."""
    parts = [ex.unframe(q) for q in asked]
    hashes = [ex.unpack_sorted(p[0]) for p in parts]
    ids, at, twice = ([ex.unpack(p[i]) for p in parts] for i in (1, 2, 3))
    every, doc = np.concatenate(hashes), np.concatenate(ids)
    start, many = np.concatenate(at).astype(np.int64), np.concatenate(twice).astype(bool)
    order = np.lexsort((start, doc, every))
    head = np.flatnonzero(np.concatenate(([True], np.diff(every[order]) != 0)))
    group = np.zeros(len(every), np.int64)
    group[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(every))))
    again = np.bincount(group, minlength=len(head)) > 1
    again[group[many]] = True
    flags = again[group]
    source_doc, source_start = doc[order][head], start[order][head]
    out, done = [], 0
    for h in hashes:
        own = slice(done, done + len(h))
        f = flags[own]
        g = group[own][f]
        out.append(ex.frame([np.packbits(f).tobytes(), ex.pack(source_doc[g]), ex.pack(ex.narrow(source_start[g]))]))
        done += len(h)
    return out
