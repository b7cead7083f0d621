"""SentencePiece encoding and decoding with a public model file; nothing is trained.

Texts are cut into units, a run of spaces and what follows it up to the next space; no piece crosses
such a cut (the model is checked for that). Each distinct unit of a slice of rows is segmented once.
Units of equal length (long ones: of about equal length) advance together, a column of characters at a time:

* hashes of all substrings come from prefix hashes, and are looked up in the sorted keys of the pieces;
* at each position the best last piece of every unit is a maximum over the piece lengths, taken for all
  units at once and stored as a backpointer.

For a unigram model the maximum is of summed scores (Viterbi). A byte-pair model has no summed score: its
segmentation is the one that merging leaves. There a path may go from one piece to the next only if
merging the two pieces' text gives these two again; exactly one path satisfies that at each
position, so the same recursion finds it. Whether two pieces stay apart follows from how each was
merged: they do not if a part at the end of the first and one at the start of the second exist at the same
time and together are a piece that merges before either grows on.

A very long unit (a text without spaces) is cut into blocks that advance side by side, each from a start of its
own some characters before the block. What comes next depends on the last few positions only, as many
as the longest piece has characters; where those agree with the block before, all that follows is what one
pass over the whole unit gives. A block that does not agree is tried from other starts (text with a period),
and at last in one go with the block before it.

A character without a piece becomes its bytes (or the unknown id, if the model has no byte pieces).

Defined cases: a null text gives null ids, an empty one an empty list; null ids give a null text; the
character U+2581 is the model's own sign for a space and is decoded as a space; repeated rows give equal ids; an empty table gives an empty result. Only the columns
asked for are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyloom.llm.common import bytes_of, filled, merged, slices

SLICE = 6 << 20
SPACE_SIGN = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
UNIGRAM, BPE = 1, 2  # model types of the model format
FACTOR = np.uint64(0x100000001B3)
WIDE = 1 << 22  # substrings looked up at once
HINT_BITS = 18  # leading bits of a hash that tell most substrings from pieces before any search
EQUAL = 32  # units up to this length advance with units of the same length only
LONG = 4096  # longer units are cut into blocks
BLOCK, WARM = 1024, 128  # characters of a block, and before it where its own start has no effect any more
SIDE_BY_SIDE = 512  # blocks that advance together
PARTS = 1 << 18  # pairs of parts of pieces that are looked at together
RUNS = 1 << 16  # runs that are copied at once: bounds the index of every copied value
NO_CHARACTER = 0x110000  # fills up rows; part of no piece


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol buffer message: numbers, fixed values as bytes, and byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at:at + size]
            at += size


@dataclass
class Model:
    pieces: list[str]
    scores: np.ndarray
    types: np.ndarray
    kind: int
    dummy_prefix: bool

    @classmethod
    def read(cls, path: str) -> Model:
        with open(path, "rb") as file:
            return cls.parse(file.read())

    @classmethod
    def parse(cls, data: bytes) -> Model:
        pieces, scores, types = [], [], []
        kind, dummy_prefix, trims, escapes, table = UNIGRAM, True, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append(own.get(1, b"").decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                types.append(own.get(3, NORMAL))
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                own = dict(_fields(value))
                table = own.get(2, b"")
                dummy_prefix, trims, escapes = (bool(own.get(k, 1)) for k in (3, 4, 5))
        if kind not in (UNIGRAM, BPE) or table or trims or not escapes:
            raise ValueError("only unigram and byte-pair models that keep the text as it is are read")
        if any(SPACE_SIGN in p.lstrip(SPACE_SIGN) for p, t in zip(pieces, types) if t in (NORMAL, USER)):
            raise ValueError("a piece holds a space after a letter")
        return cls(pieces, np.array(scores), np.array(types), kind, dummy_prefix)


def _hashes(chars: np.ndarray) -> np.ndarray:
    """Prefix hashes of each row of code points: column k is the hash of the first k."""
    out = np.zeros((chars.shape[0], chars.shape[1] + 1), np.uint64)
    spread = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(chars.shape[1]):
        out[:, k + 1] = out[:, k] * FACTOR + (spread[:, k] ^ (spread[:, k] >> np.uint64(29)))
    return out


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Codec:
    """Tables of a model, ready to segment; made once per task."""

    def __init__(self, model: Model):
        self.model = model
        usable = [i for i, t in enumerate(model.types) if t in (NORMAL, USER)]
        self.longest = max((len(model.pieces[i]) for i in usable), default=1)
        self.powers = np.array([pow(int(FACTOR), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.by_length, by_size = {}, {}
        for i in usable:
            by_size.setdefault(len(model.pieces[i]), []).append(i)
        for size, ids in by_size.items():
            chars = np.array([[ord(c) for c in model.pieces[i]] for i in ids], np.uint32).reshape(len(ids), size)
            keys = _hashes(chars)[:, size]
            order = np.argsort(keys)
            hint = np.zeros(1 << HINT_BITS, bool)
            hint[keys >> np.uint64(64 - HINT_BITS)] = True
            self.by_length[size] = (keys[order], np.array(ids, np.int64)[order], chars[order], hint)
        self.ids = {model.pieces[i]: i for i in usable}
        self.bytes = np.full(256, -1, np.int64)
        for i, t in enumerate(model.types):
            if t == BYTE:
                self.bytes[int(model.pieces[i][1:-1], 16)] = i
        self.unknown = next((i for i, t in enumerate(model.types) if t == UNKNOWN), 0)
        lowest = model.scores[usable].min() if usable else 0.0
        self.scores = np.append(model.scores, lowest - 10)  # the last one: a character without a piece
        if model.kind == BPE:
            self._merge_tables(usable)
        surfaces = [b"" if t == CONTROL else bytes([int(p[1:-1], 16)]) if t == BYTE
                    else " ⁇ ".encode() if t == UNKNOWN else p.replace(SPACE_SIGN, " ").encode()
                    for p, t in zip(model.pieces, model.types)]
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_at = np.concatenate(([0], np.cumsum([len(s) for s in surfaces])))

    def _piece(self, chars: np.ndarray, hashes: np.ndarray, size: int, end: int) -> np.ndarray:
        """For each unit the piece that its ``size`` characters before ``end`` are, or -1."""
        if size not in self.by_length:
            return np.full(len(chars), -1, np.int64)
        keys, ids, texts, hint = self.by_length[size]
        wanted = hashes[:, end] - hashes[:, end - size] * self.powers[size]
        rows = np.flatnonzero(hint[wanted >> np.uint64(64 - HINT_BITS)])
        at = np.minimum(np.searchsorted(keys, wanted[rows]), len(keys) - 1)
        hit = keys[at] == wanted[rows]
        rows, at = rows[hit], at[hit]
        same = (texts[at] == chars[rows, end - size:end]).all(axis=1)  # a hash is no proof
        piece = np.full(len(chars), -1, np.int64)
        piece[rows[same]] = ids[at[same]]
        return piece

    def _last_merge(self, piece: int) -> tuple[int, int] | None:
        """The two pieces that merging joins last to give this one; None if merging ends elsewhere."""
        parts = list(self.model.pieces[piece])
        joined = None
        while len(parts) > 1:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and self.scores[i] > best:
                    best, at = self.scores[i], k
            if at < 0:
                return None
            joined = parts[at], parts[at + 1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return (self.ids.get(joined[0], -1), self.ids.get(joined[1], -1)) if joined else (-1, -1)

    def _merge_tables(self, usable: list[int]) -> None:
        """How every piece came about: the parts along its left and its right edge, with the time at
        which each part exists and the time at which it grows on."""
        count = len(self.model.pieces)
        rank = np.empty(count, np.int64)
        rank[np.argsort(-self.model.scores, kind="stable")] = np.arange(count)
        rank[[i for i in usable if len(self.model.pieces[i]) == 1]] = -1  # there from the start
        splits = {i: self._last_merge(i) for i in usable}
        born = rank.copy()
        for i in sorted(usable, key=lambda i: len(self.model.pieces[i])):
            parts = splits[i]
            if parts and parts[0] >= 0:
                born[i] = max(rank[i], born[parts[0]], born[parts[1]])
        self.whole = np.zeros(count, bool)
        self.whole[[i for i in usable if splits[i] is not None]] = True
        never = np.iinfo(np.int64).max

        def edge(side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            parts = np.full((count, self.longest), -1, np.int64)
            grows = np.full((count, self.longest), never, np.int64)
            for i in usable:
                part, until = i, never
                for depth in range(self.longest):
                    parts[i, depth], grows[i, depth] = part, until
                    below = splits.get(part)
                    if not below or below[side] < 0:
                        break
                    part, until = below[side], born[part]
            depths = (parts >= 0).sum(axis=1)
            return parts[:, :depths.max()], grows[:, :depths.max()], depths

        self.rank, self.born = rank, born
        self.left_edge, self.right_edge = edge(0), edge(1)
        joins = {}
        for i in usable:
            text = self.model.pieces[i]
            for k in range(1, len(text)):
                a, b = self.ids.get(text[:k]), self.ids.get(text[k:])
                if a is not None and b is not None:
                    joins[a * count + b] = i
        self.join_keys = np.array(sorted(joins), np.int64)
        self.join_ids = np.array([joins[k] for k in self.join_keys.tolist()], np.int64)

    def _clash(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging joins a part at the end of the first piece with one that starts the second."""
        deep, wide = self.right_edge[2], self.left_edge[2]
        upto = np.cumsum(deep[first] * wide[second])
        cuts = np.searchsorted(upto, np.arange(0, upto[-1], PARTS)[1:]) + 1 if len(upto) else []
        return np.concatenate([self._some_clash(a, b) for a, b in zip(np.split(first, cuts), np.split(second, cuts))])

    def _some_clash(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        (ends, end_grows, deep), (starts, start_grows, wide) = self.right_edge, self.left_edge
        number = deep[first] * wide[second]
        pair = np.repeat(np.arange(len(first)), number)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(number) - number, number)
        a, b = first[pair], second[pair]
        k, m = nth // wide[b], nth % wide[b]
        x, y = ends[a, k], starts[b, m]
        keys = x * len(self.model.pieces) + y
        at = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
        use = np.flatnonzero(self.join_keys[at] == keys)
        joint = self.join_ids[at[use]]
        when = np.maximum(self.rank[joint], np.maximum(self.born[x[use]], self.born[y[use]]))
        # Of equals the leftmost merges first: the first piece's own growth, or else the joint.
        early = (when < end_grows[a[use], k[use]]) & (when <= start_grows[b[use], m[use]])
        clash = np.zeros(len(first), bool)
        clash[pair[use[early]]] = True
        return clash

    def _stay_apart(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether merging leaves piece after piece; -1 before stands for no piece to merge with."""
        count = len(self.model.pieces)
        good = self.whole[piece]
        rows = np.flatnonzero(good & (before >= 0))
        if len(rows) and len(self.join_keys):
            pairs, back = np.unique(before[rows] * count + piece[rows], return_inverse=True)
            good[rows] = ~self._clash(pairs // count, pairs % count)[back]
        return good

    def _forward(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For rows of characters, at each end: the last piece (-1: none to merge with), its size, the score."""
        count, length = chars.shape
        hashes = _hashes(chars)
        score = np.zeros((length + 1, count if self.model.kind == UNIGRAM else 0))
        last = np.full((length + 1, count), -1, np.int32)
        size_at = np.zeros((length + 1, count), np.uint8 if self.longest < 256 else np.int32)
        every = np.arange(count)
        for end in range(1, length + 1):
            sizes = range(min(end, self.longest), 0, -1)  # of equals the longest
            worth = np.full((len(sizes), count), -np.inf)
            piece = np.full((len(sizes), count), -1, np.int64)
            for k, size in enumerate(sizes):
                piece[k] = self._piece(chars, hashes, size, end)
                rows = np.flatnonzero(piece[k] >= 0)
                if self.model.kind == UNIGRAM:
                    worth[k, rows] = score[end - size, rows] + self.scores[piece[k, rows]]
                elif len(rows):
                    good = self._stay_apart(last[end - size, rows].astype(np.int64), piece[k, rows])
                    worth[k, rows[good]] = 0.0
            bare = piece[-1] < 0
            worth[-1, bare] = score[end - 1, bare] + self.scores[-1] if self.model.kind == UNIGRAM else 0.0
            best = worth.argmax(axis=0)
            if self.model.kind == UNIGRAM:
                score[end] = worth[best, every]
            last[end] = piece[best, every]
            size_at[end] = len(sizes) - best
        return last, size_at, score

    def _segment(self, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units, a row each, filled up with NO_CHARACTER: (unit, id) of all pieces in order.

        The id of a character without a piece is minus its code point, minus one.
        """
        last, size_at, _ = self._forward(chars)
        taken, at = [], lengths.copy()
        while (at > 0).any():
            rows = np.flatnonzero(at > 0)
            here = at[rows]
            ids = last[here, rows].astype(np.int64)
            taken.append((rows, np.where(ids >= 0, ids, -1 - chars[rows, here - 1].astype(np.int64))))
            at[rows] -= size_at[here, rows]
        if not taken:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = np.concatenate([r for r, _ in reversed(taken)])
        ids = np.concatenate([i for _, i in reversed(taken)])
        order = np.argsort(rows, kind="stable")
        return rows[order], ids[order]

    def _segment_long(self, chars: np.ndarray) -> np.ndarray:
        """Ids of one long unit, as ``_segment`` gives them, from blocks that advance side by side."""
        length, reach = len(chars), self.longest
        wide = BLOCK + max(WARM, 4 * reach)
        padded = np.concatenate((chars, np.full(wide + reach, NO_CHARACTER, np.uint32)))
        windows = np.lib.stride_tricks.sliding_window_view(padded, wide + reach)
        starts = np.arange(0, max(length - wide, 0) + BLOCK, BLOCK)
        last, size_at = np.full(length + 1, -1, np.int32), np.zeros(length + 1, np.int32)
        score = np.zeros(length + 1)
        known, anchor = 0, 0  # the ends up to here are right, and a pass from the anchor gives them

        def take(run, column: int, start: int, end: int) -> None:
            """The ends after ``known`` up to ``end`` from a column of a run that began at ``start``."""
            nonlocal known, anchor
            mine = slice(known + 1 - start, end + 1 - start)
            last[known + 1:end + 1], size_at[known + 1:end + 1] = run[0][mine, column], run[1][mine, column]
            if self.model.kind == UNIGRAM:
                score[known + 1:end + 1] = run[2][mine, column] + (score[known] - run[2][known - start, column])
            known, anchor = end, start

        def agrees(run, column: int, start: int) -> bool:
            mine, theirs = slice(known + 1 - reach - start, known + 1 - start), slice(known + 1 - reach, known + 1)
            if not (np.array_equal(run[0][mine, column], last[theirs]) and np.array_equal(run[1][mine, column], size_at[theirs])):
                return False
            return self.model.kind != UNIGRAM or np.ptp(run[2][mine, column] - score[theirs]) < 1e-6

        for low in range(0, len(starts), SIDE_BY_SIDE):
            group = starts[low:low + SIDE_BY_SIDE]
            runs: dict[int, tuple] = {0: self._forward(windows[group])}
            for column, start in enumerate(group.tolist()):
                end = min(start + wide, length)
                if start == 0:
                    take(runs[0], column, 0, end)
                    continue
                for shift in range(reach):
                    if shift not in runs:
                        runs[shift] = self._forward(windows[np.maximum(group - shift, 0)])
                    if agrees(runs[shift], column, start - shift):
                        take(runs[shift], column, start - shift, end)
                        break
                else:
                    take(self._forward(chars[None, anchor:end]), 0, anchor, end)
        ids, at = [], length
        while at > 0:
            ids.append(int(last[at]) if last[at] >= 0 else -1 - int(chars[at - 1]))
            at -= int(size_at[at])
        return np.array(ids[::-1], np.int64)

    def units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one after the other, and where each unit's begin."""
        lengths = np.array([len(u) for u in units], np.int64)
        owners, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(lengths > LONG).tolist():
            found.append(self._segment_long(_code_points(units[i])))
            owners.append(np.full(len(found[-1]), i))
        room = lengths.copy()
        long = lengths > EQUAL
        grain = 1 << np.maximum(np.log2(np.maximum(lengths, 1)).astype(np.int64) - 2, 0)  # a quarter more at most
        room[long] = (-(-lengths // grain) * grain)[long]
        for width in np.unique(room[(lengths > 0) & (lengths <= LONG)]).tolist():
            chosen = np.flatnonzero((room == width) & (lengths <= LONG))
            step = max(1, WIDE // (width * min(width, self.longest)))
            for low in range(0, len(chosen), step):
                group = chosen[low:low + step]
                text = "".join([units[i] for i in group.tolist()])
                chars = np.full((len(group), width), NO_CHARACTER, np.uint32)
                chars[np.arange(width) < lengths[group][:, None]] = _code_points(text)
                rows, ids = self._segment(chars, lengths[group])
                owners.append(group[rows])
                found.append(ids)
        owner, ids = np.concatenate(owners), np.concatenate(found)
        order = np.argsort(owner, kind="stable")
        owner, ids = owner[order], ids[order]
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            spelt = [[int(self.bytes[b]) for b in chr(-1 - c).encode()] if (self.bytes >= 0).all() else [self.unknown]
                     for c in ids[bare].tolist()]
            extra = np.ones(len(ids), np.int64)
            extra[bare] = [len(s) for s in spelt]
            owner = np.repeat(owner, extra)
            ids = np.repeat(ids, extra)
            ids[ids < 0] = np.concatenate(spelt)
        return ids.astype(np.int32), np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(units)))))

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin."""
        texts = filled(pc.replace_substring(texts, SPACE_SIGN, " "))
        data, at = bytes_of(texts)
        full = np.diff(at) > 0
        if self.model.dummy_prefix:
            data = np.insert(data, at[:-1][full], 32)
            at = np.concatenate(([0], np.cumsum(np.diff(at) + full)))
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        space = data == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[at[:-1][full]] = True
        first = np.flatnonzero(begins)
        coded = pa.Array.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(np.append(first, len(data)).astype(np.int32)),
                                      pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = [u.decode().replace(" ", SPACE_SIGN) for u in coded.dictionary.to_pylist()]
        unit_ids, unit_at = self.units(distinct)
        code = coded.indices.to_numpy(zero_copy_only=False)
        ids = _gathered(unit_ids, unit_at, code)
        sizes = np.concatenate(([0], np.cumsum(np.diff(unit_at)[code])))
        return ids, sizes[np.searchsorted(first, at)]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts, one after the other, and where each text's begin."""
        data = _gathered(self.surface, self.surface_at, ids)
        upto = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.diff(self.surface_at)[ids], out=upto[1:])
        ends = upto[at]
        if self.model.dummy_prefix and len(data):
            begins = ends[:-1]
            leads = np.diff(ends) > 0
            leads[leads] = data[begins[leads]] == 32
            data = np.delete(data, begins[leads])
            ends = ends - np.concatenate(([0], np.cumsum(leads)))
        return data, ends


def _gathered(values: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen runs of values, one after the other; a bounded number of runs at once."""
    sizes = np.diff(at)[chosen]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(ends[-1], values.dtype)
    for low in range(0, len(chosen), RUNS):
        part = slice(low, low + RUNS)
        first, after = ends[low], ends[min(low + RUNS, len(chosen))]
        shift = np.repeat(at[:-1][chosen[part]] - (ends[:-1][part] - first), sizes[part])
        out[first:after] = values[shift + np.arange(after - first)]
    return out


def encode(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ids, and round_trip: whether decoding the ids gives the text again, byte for byte.

    The model's tables, whose size depends on the model only, are made once and sent to the tasks.
    """
    codec = Codec(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merged(batches, SLICE):
            source = batch.column(batch.num_columns - 1)
            texts = filled(source)
            for low, high in slices(texts, SLICE):
                part = filled(texts.slice(low, high - low))
                ids, at = codec.encode(part)
                back, ends = codec.decode(ids, at)
                data, begins = bytes_of(part)
                missing = pc.is_null(source.slice(low, high - low))
                same = [ends[i + 1] - ends[i] == begins[i + 1] - begins[i]
                        and np.array_equal(back[ends[i]:ends[i + 1]], data[begins[i]:begins[i + 1]])
                        for i in range(len(part))]
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(low, high - low) for i in range(len(keep))),
                     pc.if_else(missing, pa.scalar(None, lists.type), lists),
                     pc.if_else(missing, pa.scalar(None, pa.bool_()), pa.array(same, pa.bool_()))],
                    names=[*keep, "ids", "round_trip"])

    read = docs.select(*keep, docs[text].alias("_text"))
    return read.mapInArrow(work, T.StructType([
        *read.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("round_trip", T.BooleanType())]))


def decode(rows: DataFrame, model: Model, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` and the text that the ids stand for; bytes that are no UTF-8 become U+FFFD."""
    codec = Codec(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for row in range(0, len(lists), 64):  # bounds the bytes in memory
                part = pa.concat_arrays([lists.slice(row, 64)])
                flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                data, ends = codec.decode(flat, np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))))
                raw = data.tobytes()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(row, 64) for i in range(len(keep))),
                     pc.if_else(pc.is_null(part), pa.scalar(None, pa.string()), pa.array(texts, pa.string()))],
                    names=[*keep, "text"])

    read = rows.select(*keep, rows[ids].alias("_ids"))
    return read.mapInArrow(work, T.StructType([*read.schema.fields[:-1], T.StructField("text", T.StringType())]))
