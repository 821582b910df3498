"""Exact repeated-substring removal by a depth-limited radix sort of suffixes.

Two suffixes matter to each other only through their first WINDOW bytes, so suffixes are sorted by
that many bytes and no further, in most-significant-digit passes; a group of one is dropped after
each pass, and groups that are left at full depth are exactly the repeated windows.

Sorting every suffix of the corpus in one place would move fifty times the corpus, so the first
digit is chosen from the content: the smallest hashed ANCHOR-byte gram inside a window (its anchor).
Equal windows have equal anchors at equal places, a run of neighbouring windows shares one, and only
about one byte in sixteen starts one. The passes over a corpus are then:

1. Texts are packed into bundles with the runs of their anchors, written compressed to the scratch
   folder.
2. Every bundle sends its distinct anchors, 4 bytes each, to the part of the anchor space they fall
   in; the part answers which of them other bundles have too. Other windows are unique.
3. For repeated anchors, bundles sort their contexts (the bytes that an anchor's windows cover, 80 at
   most) and send a 128-bit digest of each distinct one with the smallest doc_id that has it. Where an
   anchor has one context everywhere, as inside copies, the smallest doc_id for all its windows is
   known at once.
4. Contexts of the other anchors, at the edges of copies, are sent as bytes. Parts sort them and their
   windows by anchor, place and then digit by digit, and answer with the smallest doc_id by window.
5. Bundles mark the bytes of windows that a smaller doc_id has.

Digests are multilinear over 32-bit words with keys drawn anew for each run, four of 32 bits: two different
contexts agree with probability 2**-128, whatever the texts are, as nobody knows the keys before. Other
hashes only route and preselect. An
anchor in more than HOT_BUNDLES bundles sends its windows one by one to parts by their content, so a
passage that a third of all documents share is spread. A bundle sends one entry for each distinct
context, however many of its documents hold it.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table
from .textvec import U, constants, mix, slices, utf8

WINDOW, ANCHOR = 50, 20
SPAN = WINDOW - ANCHOR + 1
#: Longest context: SPAN windows in a row.
CONTEXT = WINDOW + SPAN - 1
BUNDLE_BYTES, SLICE, PART_BYTES = 4 << 20, 1 << 20, 6 << 20
HOT_BUNDLES = 64
_C = constants(50, 3)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every run of width values, in about log2(width) steps."""
    done = 1
    out = x
    while done * 2 <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = pick(out[: len(out) - (width - done)], out[width - done :])
    return out


def _anchor_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text row, first and last window start, place of the anchor."""
    n = len(data)
    none = (np.zeros(0, np.int64),) * 4
    if n < WINDOW:
        return none
    l1 = data.astype(U)
    l2 = l1[:-1] | l1[1:] << U(8)
    l4 = l2[:-2] | l2[2:] << U(16)
    l8 = l4[:-4] | l4[4:] << U(32)
    grams = n - ANCHOR + 1
    h = mix(l8[:grams] * _C[0] + l8[8 : 8 + grams] * _C[1] + l8[12 : 12 + grams] * _C[2])
    low = _slide(h, SPAN, np.minimum)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(low)]
    inside = np.arange(len(low)) + WINDOW <= offsets[row + 1]
    reach = np.zeros(SPAN - 1 + grams, U)
    reach[SPAN - 1 : SPAN - 1 + len(low)] = np.where(inside, low, U(0))
    is_anchor = (_slide(reach, SPAN, np.maximum) == h) & (h > 0)
    at = np.flatnonzero(is_anchor)
    p = np.flatnonzero(inside)
    if not len(p):
        return none
    # The leftmost anchor in the window that has the window's smallest hash.
    own = (np.cumsum(is_anchor) - is_anchor)[p]
    wrong = np.flatnonzero(h[at[own]] != low[p])
    while len(wrong):
        own[wrong] += 1
        wrong = wrong[h[at[own[wrong]]] != low[p[wrong]]]
    fresh = np.ones(len(p), bool)
    fresh[1:] = (own[1:] != own[:-1]) | (row[p[1:]] != row[p[:-1]])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(p)) - 1
    return row[p[first]], p[first], p[last], at[own[first]]


def packed_runs(data: np.ndarray, offsets: np.ndarray) -> bytes:
    """Anchor runs of whole texts, slice by slice. Runs follow each other inside a text, so their lengths (a byte
    each), the place of each anchor after its last window (a byte) and their number by text say all."""
    count, length, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in slices(offsets, SLICE):
        base = offsets[a]
        row, first, last, at = _anchor_runs(data[base : offsets[b]], offsets[a : b + 1] - base)
        count.append(np.bincount(row, minlength=b - a))
        length.append(last - first + 1)
        place.append(at - last)
    raw = [np.concatenate(count).astype(np.int32), np.concatenate(length).astype(np.uint8), np.concatenate(place).astype(np.uint8)]
    return zstandard.compress(b"".join(x.tobytes() for x in raw), 3)


def unpacked_runs(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    raw, n = zstandard.decompress(raw), len(offsets) - 1
    count = np.frombuffer(raw, np.int32, n)
    m = int(count.sum())
    length, place = (np.frombuffer(raw, np.uint8, m, 4 * n + k * m).astype(np.int64) for k in (0, 1))
    row = np.repeat(np.arange(n), count)
    before = np.cumsum(length) - length
    starts = np.cumsum(count) - count
    first = offsets[row] + before - np.repeat(before[np.minimum(starts, max(0, m - 1))] if m else starts, count)
    last = first + length - 1
    return row, first, last, last + place


def _radix_order(group: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """Rows in order of (group, digit): counting sorts of 16 bits, the least significant first."""
    order = np.arange(len(digit))
    for value, bits in ((digit, 64), (group.astype(U), int(group.max()).bit_length() if len(group) else 0)):
        for shift in range(0, bits, 16):
            piece = (value >> U(shift)).astype(np.uint16)
            if len(piece) and (piece != piece[0]).any():
                # numpy sorts 16-bit integers by their digits when the sort is to be stable.
                order = order[np.argsort(piece[order], kind="stable")]
    return order


def radix_classes(digits: np.ndarray) -> np.ndarray:
    """For rows of 8-byte digits (most significant first) the first row that equals each.

    One stable pass for each digit; rows that are alone in their group leave after it.
    """
    n = len(digits)
    out, rows, group = np.arange(n), np.arange(n), np.zeros(n, np.int64)
    for k in range(digits.shape[1]):
        d = digits[rows, k]
        order = _radix_order(group, d)
        rows, group, d = rows[order], group[order], d[order]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (d[1:] != d[:-1])
        number = np.cumsum(fresh) - 1
        many = np.bincount(number, minlength=1)[number] > 1 if len(number) else np.zeros(0, bool)
        rows, group = rows[many], number[many]
        if not len(rows):
            return out
    fresh = np.ones(len(rows), bool)
    fresh[1:] = group[1:] != group[:-1]
    out[rows] = rows[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    return out


def _digits(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Rows of big-endian 8-byte digits of data[start : start + length], zeros after it; the last digit is the length."""
    columns = -(-width // 8)
    padded = np.concatenate([data, np.zeros(columns * 8, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, columns * 8)[start]
    rows = np.where(np.arange(columns * 8) < length[:, None], rows, 0).astype(np.uint8)
    return np.concatenate([rows.view(">u8").astype(U).reshape(len(start), columns), length[:, None].astype(U)], 1)


class Bundle:
    """The texts of one bundle, their anchors by part, and the contexts of those that are repeated."""

    def __init__(self, ids: bytes, known: bytes, lengths: bytes, text: bytes, runs: bytes, parts: int, secret: np.ndarray):
        self.secret = secret
        self.ids, self.known = np.frombuffer(ids, np.int64), np.frombuffer(known, bool)
        self.offsets = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, np.int64))]).astype(np.int64)
        self.data = np.frombuffer(zstandard.decompress(text, max_output_size=max(1, int(self.offsets[-1]))), np.uint8)
        row, first, last, at = unpacked_runs(runs, self.offsets)
        kept = self.known[row]
        self.row, self.first, self.last, self.anchor = row[kept], first[kept], last[kept], at[kept]
        self.parts = parts
        digits = _digits(self.data, self.anchor, np.full(len(self.anchor), ANCHOR), ANCHOR)
        h = mix((digits * constants(52, digits.shape[1])).sum(1, dtype=U))
        key = (h >> U(32)) % U(parts) << U(32) | h & U(0xFFFFFFFF)
        self.keys, self.key = np.unique(key, return_inverse=True)
        self.bounds = np.searchsorted(self.keys, np.arange(parts + 1, dtype=U) << U(32))

    def anchors(self) -> Iterator[tuple[int, bytes]]:
        """(part, its sorted anchors)."""
        for part in np.flatnonzero(np.diff(self.bounds)):
            yield int(part), self.keys[self.bounds[part] : self.bounds[part + 1]].astype(np.uint32).tobytes()

    def contexts(self, answers: dict[int, bytes]) -> None:
        """Find distinct contexts of anchors that other bundles or several own documents have."""
        shared, hot = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        for part, bits in answers.items():
            a, b = self.bounds[part], self.bounds[part + 1]
            both = np.unpackbits(np.frombuffer(bits, np.uint8))[: 2 * (b - a)].astype(bool)
            shared[a:b], hot[a:b] = both[: b - a], both[b - a :]
        pair = np.unique(self.key * len(self.ids) + self.row) // max(1, len(self.ids))
        shared |= np.bincount(pair, minlength=len(self.keys)) > 1
        alive = np.flatnonzero(shared[self.key])
        warm, burning = alive[~hot[self.key[alive]]], alive[hot[self.key[alive]]]
        count = self.last[burning] - self.first[burning] + 1
        spread = np.repeat(burning, count)
        within = np.arange(len(spread)) - np.repeat(np.cumsum(count) - count, count)
        self.at = np.concatenate([self.first[warm], self.first[spread] + within])
        self.size = np.concatenate([self.last[warm] - self.first[warm] + WINDOW, np.full(len(spread), WINDOW)])
        self.doc = self.row[np.concatenate([warm, spread])]
        #: Place of the anchor in a context; equal windows have it at equal places.
        place = np.concatenate([self.anchor[warm] - self.first[warm], np.zeros(len(spread), np.int64)])
        label = self.keys[self.key[np.concatenate([warm, spread])]]
        digits = _digits(self.data, self.at, self.size, CONTEXT)
        class_of = radix_classes(digits)
        self.unique = np.unique(class_of)
        self.entry = np.searchsorted(self.unique, class_of)
        self.smallest = np.full(len(self.unique), np.iinfo(np.int64).max)
        np.minimum.at(self.smallest, self.entry, self.ids[self.doc])
        # Hot windows are dealt by their content, contexts by their anchor.
        burnt = self.unique >= len(warm)
        content = mix((digits[self.unique] * constants(51, digits.shape[1])).sum(1, dtype=U))
        self.part = np.where(burnt, content % U(self.parts), label[self.unique] >> U(32)).astype(np.int64)
        self.label = np.where(burnt, content >> U(32), label[self.unique] & U(0xFFFFFFFF)).astype(np.uint32)
        self.place = place[self.unique].astype(np.uint8)
        self.order = np.argsort(self.part, kind="stable")
        self.part_bounds = np.searchsorted(self.part[self.order], np.arange(self.parts + 1))

    def digests(self) -> Iterator[tuple[int, bytes]]:
        """(part, packed digests of its contexts): count, labels, both halves, smallest ids."""
        high, low = strong_digests(_digits(self.data, self.at[self.unique], self.size[self.unique], CONTEXT), self.secret)
        for part in np.flatnonzero(np.diff(self.part_bounds)):
            own = self.order[self.part_bounds[part] : self.part_bounds[part + 1]]
            yield int(part), _pack(self.label[own], high[own], low[own], self.smallest[own])

    def asked(self, answers: dict[int, bytes]) -> Iterator[tuple[int, bytes]]:
        """(part, packed contexts that it asks for): count, places in the part's list, sizes, anchor places, labels, smallest ids, bytes."""
        for part, raw in answers.items():
            _, mixed = _opened(raw)
            if not len(mixed):
                continue
            own = self.order[self.part_bounds[part] + mixed.astype(np.int64)]
            start, size = self.at[self.unique[own]], self.size[self.unique[own]]
            flat = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
            yield int(part), _pack(mixed, size.astype(np.uint8), self.place[own], self.label[own], self.smallest[own], self.data[flat], head=len(own))

    def marks(self, answers: list[tuple[int, bytes]]) -> np.ndarray:
        """True for every byte that a window with a smaller doc_id covers. answers: (part, runs)."""
        n = len(self.data)
        edge = np.zeros(n + 1, np.int64)
        ids = self.ids[self.doc]
        whole = self.smallest[self.entry] < ids
        edge += np.bincount(self.at[whole], minlength=n + 1) - np.bincount(self.at[whole] + self.size[whole], minlength=n + 1)
        entries, runs = [np.zeros(0, np.int64)], [np.zeros(0, _RUN)]
        for part, raw in answers:
            found, _ = _opened(raw)
            entries.append(self.order[self.part_bounds[part] + found["entry"].astype(np.int64)])
            runs.append(found)
        entry, run = np.concatenate(entries), np.concatenate(runs)
        order = np.argsort(entry, kind="stable")
        entry, run = entry[order], run[order]
        # Occurrences meet the runs of their entry.
        rest = np.flatnonzero(~whole)
        low, high = np.searchsorted(entry, self.entry[rest]), np.searchsorted(entry, self.entry[rest], "right")
        count = high - low
        occurrence = np.repeat(rest, count)
        which = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        hit = run["smallest"][which] < ids[occurrence]
        occurrence, which = occurrence[hit], which[hit]
        start = self.at[occurrence] + run["first"][which]
        end = self.at[occurrence] + np.minimum(run["last"][which].astype(np.int64) + WINDOW, self.size[occurrence])
        edge += np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
        return np.cumsum(edge[:-1]) > 0


def _pack(*arrays: np.ndarray, head: int | None = None) -> bytes:
    return zstandard.compress(b"".join([np.int64(len(arrays[0]) if head is None else head).tobytes(), *(a.tobytes() for a in arrays)]), 3)


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    """Arrays of the packed length and kinds, and what is left as bytes."""
    raw = zstandard.decompress(blob)
    m, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in map(np.dtype, kinds):
        out.append(np.frombuffer(raw, kind, m, at))
        at += m * kind.itemsize
    return [*out, np.frombuffer(raw, np.uint8, -1, at)]


def strong_digests(digits: np.ndarray, secret: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of 128 bits for rows of 8-byte digits. secret: 4 x (1 + 2 * digits) random 64-bit numbers."""
    words = np.concatenate([digits >> U(32), digits & U(0xFFFFFFFF)], 1)
    h = [(key[0] + (words * key[1:]).sum(1, dtype=U)) >> U(32) for key in secret]
    return h[0] << U(32) | h[1], h[2] << U(32) | h[3]


def new_secret() -> np.ndarray:
    digits = -(-CONTEXT // 8) + 1
    return np.frombuffer(secrets.token_bytes(4 * (1 + 2 * digits) * 8), U).reshape(4, -1)


def _answer(runs: np.ndarray, mixed: np.ndarray) -> bytes:
    return zstandard.compress(np.int64(len(runs)).tobytes() + runs.tobytes() + mixed.astype(np.uint32).tobytes(), 3)


def _opened(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(runs, places of contexts that are asked for)."""
    raw = zstandard.decompress(raw)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    return np.frombuffer(raw, _RUN, n, 8), np.frombuffer(raw, np.uint32, -1, 8 + n * _RUN.itemsize)


#: An answer: windows first to last of a context are in a document with this smaller id.
_RUN = np.dtype([("entry", np.uint32), ("first", np.uint8), ("last", np.uint8), ("smallest", np.int64)])


def settle_anchors(blobs: list[bytes]) -> list[bytes]:
    """For each bundle's sorted anchors two bits: other bundles have it; more than HOT_BUNDLES do."""
    blobs = [np.frombuffer(b, np.uint32) for b in blobs]
    sizes = np.array([len(b) for b in blobs])
    every = np.concatenate(blobs)
    order = np.argsort(every, kind="stable")
    fresh = np.ones(len(every), bool)
    fresh[1:] = every[order][1:] != every[order][:-1]
    number = np.cumsum(fresh) - 1
    count = np.empty(len(every), np.int64)
    count[order] = np.bincount(number)[number]
    ends = np.cumsum(sizes)
    return [np.packbits(np.concatenate([count[a:b] > 1, count[a:b] > HOT_BUNDLES])).tobytes() for a, b in zip(ends - sizes, ends, strict=True)]


def settle_digests(blobs: list[bytes]) -> list[bytes | None]:
    """For each bundle's digests: runs for contexts of anchors with one context, and which contexts to send as bytes."""
    parts = [_unpack(b, np.uint32, U, U, np.int64) for b in blobs]
    counts = np.array([len(p[0]) for p in parts])
    label, high, low, smallest = (np.concatenate([p[k] for p in parts]) for k in range(4))
    order = np.lexsort((low, high, label))
    fresh_label, fresh = np.ones(len(order), bool), np.ones(len(order), bool)
    fresh_label[1:] = label[order][1:] != label[order][:-1]
    fresh[1:] = fresh_label[1:] | (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    group, context = np.cumsum(fresh_label) - 1, np.cumsum(fresh) - 1
    distinct = np.bincount(group[fresh])
    least = np.minimum.reduceat(smallest[order], np.flatnonzero(fresh))
    mixed, best = np.empty(len(order), bool), np.empty(len(order), np.int64)
    mixed[order], best[order] = distinct[group] > 1, least[context]
    news = ~mixed & (best < smallest)
    out = []
    ends = np.cumsum(counts)
    for a, b in zip(ends - counts, ends, strict=True):
        told, asked = np.flatnonzero(news[a:b]), np.flatnonzero(mixed[a:b])
        runs = np.empty(len(told), _RUN)
        runs["entry"], runs["first"], runs["last"], runs["smallest"] = told, 0, 255, best[a:b][told]
        out.append(_answer(runs, asked) if len(told) or len(asked) else None)
    return out


def settle_contexts(blobs: list[bytes]) -> list[bytes | None]:
    """For each bundle's contexts the runs of windows for which another bundle or context has a smaller doc_id."""
    parts = [_unpack(b, np.uint32, np.uint8, np.uint8, np.uint32, np.int64) for b in blobs]
    counts = np.array([len(p[0]) for p in parts])
    spot, size, place, label, smallest, data = (np.concatenate([p[k] for p in parts]) for k in range(6))
    del parts
    size = size.astype(np.int64)
    start = np.cumsum(size) - size
    class_of = radix_classes(np.concatenate([label[:, None].astype(U), _digits(data, start, size, CONTEXT)], 1))
    least = np.full(len(size), np.iinfo(np.int64).max)
    np.minimum.at(least, class_of, smallest)
    reps = np.unique(class_of)
    reps = reps[np.argsort(label[reps], kind="stable")]
    # Where an anchor has one context, all its windows have that context's smallest id: one run.
    alone = np.ones(len(reps), bool)
    same_label = label[reps][1:] == label[reps][:-1]
    alone[1:] &= ~same_label
    alone[:-1] &= ~same_label
    runs = [(reps[alone], np.zeros(alone.sum(), np.int64), size[reps[alone]] - WINDOW, least[reps[alone]])]
    runs += _settled_windows(data, start, size, place.astype(np.int64), label, least, reps[~alone])
    run_rep, run_first, run_last, run_low = (np.concatenate(x) for x in zip(*runs, strict=True))
    order = np.argsort(run_rep, kind="stable")
    run_rep, run_first, run_last, run_low = run_rep[order], run_first[order], run_last[order], run_low[order]
    left, right = np.searchsorted(run_rep, class_of), np.searchsorted(run_rep, class_of, "right")
    count = right - left
    entry = np.repeat(np.arange(len(size)), count)
    which = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(left, count)
    news = run_low[which] < smallest[entry]
    entry, which = entry[news], which[news]
    ends = np.cumsum(counts)
    out = []
    for a, b in zip(ends - counts, ends, strict=True):
        lo, hi = np.searchsorted(entry, [a, b])
        told, w = np.empty(hi - lo, _RUN), which[lo:hi]
        told["entry"], told["first"], told["last"], told["smallest"] = spot[entry[lo:hi]], run_first[w], run_last[w], run_low[w]
        out.append(_answer(told, np.zeros(0, np.uint32)) if hi > lo else None)
    return out


#: Windows of contexts that are sorted at a time, whole anchors each.
WINDOWS_AT_ONCE = 1 << 19


def _settled_windows(data: np.ndarray, start: np.ndarray, size: np.ndarray, place: np.ndarray, label: np.ndarray, least: np.ndarray, reps: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Runs (context, first, last, smallest id) of the windows of contexts, which are sorted by label."""
    out = []
    windows = size[reps] - WINDOW + 1
    upto = np.concatenate([[0], np.cumsum(windows)])
    heads = np.flatnonzero(np.append(True, label[reps][1:] != label[reps][:-1])) if len(reps) else np.zeros(0, np.int64)
    a = 0
    while a < len(reps):
        # As many whole labels as fit, one at least.
        reach = np.searchsorted(upto, upto[a] + WINDOWS_AT_ONCE, "right") - 1
        later = heads[heads > a]
        ends = np.append(later, len(reps))
        b = int(ends[max(0, np.searchsorted(ends, reach, "right") - 1)])
        own, n = reps[a:b], windows[a:b]
        rep = np.repeat(own, n)
        offset = np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
        at = start[rep] + offset
        # Equal windows have their anchor at the same place, so that is a digit after the label; most windows are alone then.
        first_digit = label[rep].astype(U) << U(8) | (place[rep] - offset + WINDOW).astype(U)
        _, kind, many = np.unique(first_digit, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(many[kind] > 1)
        low = least[rep]
        if len(shared):
            same = radix_classes(np.concatenate([first_digit[shared, None], _digits(data, at[shared], np.full(len(shared), WINDOW), WINDOW)[:, :-1]], 1))
            best = np.full(len(shared), np.iinfo(np.int64).max)
            np.minimum.at(best, same, low[shared])
            low[shared] = best[same]
        fresh = np.ones(len(rep), bool)
        fresh[1:] = (rep[1:] != rep[:-1]) | (low[1:] != low[:-1])
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(rep)) - 1
        out.append((rep[first], offset[first], offset[last], low[first]))
        a = b
    return out


def bundles(docs: DataFrame) -> DataFrame:
    """bundle, raw_bytes, ids, known, lengths, text, runs: texts packed BUNDLE_BYTES at a time. A longer text is alone in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in slices(offsets, BUNDLE_BYTES):
                own = ids.slice(a, b - a)
                known = own.is_valid().to_numpy(zero_copy_only=False)
                plain = data[offsets[a] : offsets[b]]
                row = [
                    [number], [len(plain)], [own.fill_null(0).to_numpy().tobytes()], [known.tobytes()], [np.diff(offsets[a : b + 1]).tobytes()],
                    [zstandard.compress(plain.tobytes(), 3)], [packed_runs(plain, offsets[a : b + 1] - offsets[a])],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, [pa.int64(), pa.int64(), *[pa.binary()] * 5], strict=True)], ["bundle", "raw_bytes", "ids", "known", "lengths", "text", "runs"])
                number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "bundle long, raw_bytes long, ids binary, known binary, lengths binary, text binary, runs binary")


_ROW = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("bundle", pa.int64()), ("blob", pa.binary())])
ANCHORS, DIGESTS, CONTEXTS = 1, 2, 3
_ROW_DDL = "kind int, part int, bundle long, blob binary"
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def remove_repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Remove every byte covered by a WINDOW-byte string that also starts in a document with a smaller doc_id.

    docs: doc_id, text; other columns are ignored. Texts count as UTF-8 bytes, null as empty; matches never
    cross documents; what repeats inside one document only, or in rows with one doc_id only, stays. A row with a
    null doc_id loses nothing and takes nothing from others. Shorter texts than WINDOW stay whole. No rows: no
    rows out. Memory of a task follows a bundle or the longest text, and the part sizes of PART_BYTES.

    Returns doc_id, n_bytes, n_removed, spans (byte ranges removed, end exclusive), kept (remaining bytes).
    """
    packed = scratch.table(bundles(docs), "bundles")
    total = packed.agg(F.coalesce(F.sum("raw_bytes"), F.lit(0))).first()[0]
    parts, secret = max(16, -(-total // PART_BYTES)), new_secret()

    def rows_of(found: list[tuple[int, int, int, bytes]]) -> pa.Table:
        return pa.table(list(map(pa.array, zip(*found, strict=True), _ROW.types)) if found else [pa.array([], t) for t in _ROW.types], _ROW.names).cast(_ROW)

    def opened(row: dict) -> Bundle:
        return Bundle(row["ids"], row["known"], row["lengths"], row["text"], row["runs"], parts, secret)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                yield from rows_of([(0, p, row["bundle"], blob) for p, blob in opened(row).anchors()]).to_batches()

    def answered(settle, kind: int):
        def answer(table: pa.Table) -> pa.Table:
            found = settle(table["blob"].to_pylist())
            return rows_of([(kind, p, b, f) for p, b, f in zip(table["part"].to_pylist(), table["bundle"].to_pylist(), found, strict=True) if f is not None])

        return answer

    def by_kind(table: pa.Table) -> dict[int, list[tuple[int, bytes]]]:
        out: dict[int, list] = {ANCHORS: [], DIGESTS: [], CONTEXTS: []}
        for kind, part, blob in zip(*(table[c].to_pylist() for c in ("kind", "part", "blob")), strict=True):
            out[kind].append((part, blob))
        return out

    def digests(left: pa.Table, right: pa.Table) -> pa.Table:
        out, known = [], by_kind(right)
        for row in left.to_pylist():
            own = opened(row)
            own.contexts(dict(known[ANCHORS]))
            out += [(0, p, row["bundle"], blob) for p, blob in own.digests()]
        return rows_of(out)

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        out, known = [], by_kind(right)
        for row in left.to_pylist():
            own = opened(row)
            own.contexts(dict(known[ANCHORS]))
            out += [(0, p, row["bundle"], blob) for p, blob in own.asked(dict(known[DIGESTS]))]
        return rows_of(out)

    result = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def removal(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        known = by_kind(right)
        for row in left.to_pylist():
            own = opened(row)
            own.contexts(dict(known[ANCHORS]))
            gone = own.marks(known[DIGESTS] + known[CONTEXTS])
            n = len(own.ids)
            begins = np.zeros(len(gone) + 1, bool)
            begins[own.offsets] = True
            change = np.flatnonzero(np.concatenate([gone[:1], (gone[1:] & ~gone[:-1]) | (gone[1:] & begins[1:-1])])) if len(gone) else np.zeros(0, np.int64)
            close = np.flatnonzero(gone & np.append(~gone[1:] | begins[1:-1], True)) + 1 if len(gone) else np.zeros(0, np.int64)
            bounds = np.searchsorted(change, own.offsets)
            base = own.offsets[np.searchsorted(own.offsets, change, "right") - 1]
            spans = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(change - base), pa.array(close - base)], ["start", "end"]))
            total_gone = np.concatenate([[0], np.cumsum(gone)])
            kept = own.data[~gone]
            cut = (own.offsets - total_gone[own.offsets]).astype(np.int32)
            bytes_kept = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(kept.tobytes())])
            tables.append(pa.table([pa.array(own.ids, mask=~own.known), pa.array(np.diff(own.offsets)), pa.array(np.diff(total_gone[own.offsets])), spans, bytes_kept], result.names).cast(result))
        return pa.concat_tables(tables) if tables else result.empty_table()

    def settled(sent: DataFrame, settle, kind: int) -> DataFrame:
        return scratch.table(sent.groupBy("part").applyInArrow(answered(settle, kind), _ROW_DDL), f"answers{kind}")

    def told(send, answers: DataFrame, ddl: str) -> DataFrame:
        return packed.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(send, ddl)

    first = settled(packed.mapInArrow(anchors, _ROW_DDL), settle_anchors, ANCHORS)
    second = settled(told(digests, first, _ROW_DDL), settle_digests, DIGESTS)
    third = settled(told(contexts, first.union(second), _ROW_DDL), settle_contexts, CONTEXTS)
    return told(removal, first.union(second).union(third), RESULT)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(read_table(spark, sf_dir, "documents"), Scratch(spark, "op8"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS MATERIALIZED (SELECT doc_id, unnest(range(len(x) // 2)) AS i, x, len(x) // 2 AS n FROM d),
w AS MATERIALIZED (SELECT doc_id, i, n, md5(substr(x, 2 * i + 1, 100)) AS h, substr(x, 2 * i + 1, 2) AS c FROM b),
m AS MATERIALIZED (SELECT h, min(doc_id) AS first FROM w WHERE i + 50 <= n GROUP BY h),
f AS (SELECT doc_id, i, c, n, coalesce(max(CASE WHEN i + 50 <= n AND first < doc_id THEN i END) OVER (PARTITION BY doc_id ORDER BY i), -99) + 50 > i AS gone FROM w LEFT JOIN m USING (h)),
g AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM f),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, sha256(unhex(coalesce(string_agg(c, '' ORDER BY i) FILTER (NOT gone), ''))) AS kept_sha256 FROM g GROUP BY doc_id)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
