"""Packing tokenised documents into sequences of bounded length.

Only documents longer than a sequence are cut. Lengths (not ids) are packed:
pieces are dealt evenly over partitions of bounded size, and each partition
packs its own pieces, so the loss against packing all at once is below one
sequence a partition. A partition starts from best-fit decreasing and is
improved by local search: documents move, or are exchanged one for one or two
for one, between underfull bins whenever that raises the sum of squared fills,
which drains the emptiest bins until they can be dropped.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import rows, slices, table, texts_as_bytes
from tickrisk.llm.words import word_encoder
from tickrisk.plans.materialize import materialize


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices: each item, longest first, goes where least room is left."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []                                    # room sizes in use, sorted
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(rooms, lengths[i])
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= lengths[i]
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(b)
    return bins


class LocalSearch:
    """Bins under improvement, in passes over all underfull bins, the emptiest first. A bin
    tries to give its items to others by a move, a one-for-one exchange (a longer item
    against a shorter one) or a two-for-one exchange (two items against a shorter one).
    Each step raises the sum of squared fills. A bin that nothing helps goes back among
    the others and is tried again in the next pass, as exchanges elsewhere change what
    fits; the search ends with a pass that changes nothing, or when no packing can have
    fewer bins.

    Only the distinct lengths in a bin matter (at most 63 of them sum to less than 2048), so
    bins of any number of items take part on both sides."""

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[dict[int, list[int]]] = []          # bin -> length -> indices
        for b in bins:
            held: dict[int, list[int]] = {}
            for i in b:
                held.setdefault(lengths[i], []).append(i)
            self.items.append(held)
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.left = sum(1 for f in self.fill if f)
        self.bound = -(-sum(self.fill) // capacity)
        self.rooms = [set() for _ in range(capacity + 1)]    # room -> bins
        # (room + length of one item) -> bins: what one longer item would make full
        self.full_if: dict[int, set[int]] = {}
        for b in range(len(bins)):
            self._enter(b)

    def _enter(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        if 0 < room < self.capacity:
            self.rooms[room].add(b)
            for length in self.items[b]:
                self.full_if.setdefault(room + length, set()).add(b)

    def _leave(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        self.rooms[room].discard(b)
        for length in self.items[b]:
            self.full_if.get(room + length, set()).discard(b)

    def _give(self, donor: int, b: int, length: int) -> None:
        held = self.items[donor][length]
        self.items[b].setdefault(length, []).append(held.pop())
        if not held:
            del self.items[donor][length]
        self.fill[donor] -= length
        self.fill[b] += length

    def _move(self, donor: int) -> bool:
        """An item goes to the bin where it leaves the least room."""
        for length in sorted(self.items[donor], reverse=True):
            # squared fill rises as long as the other bin ends fuller than this one was
            for room in range(length, min(self.capacity, self.capacity + length - self.fill[donor])):
                if self.rooms[room]:
                    b = min(self.rooms[room])
                    self._leave(b)
                    self._give(donor, b, length)
                    self._enter(b)
                    return True
        return False

    def _swap(self, donor: int) -> bool:
        """One or two items against a shorter one, so that the other bin is left with the
        least room; it must end fuller than this one was, which raises squared fill."""
        own = sorted(self.items[donor], reverse=True)
        offers = {length: (length,) for length in own}
        for k, x in enumerate(own):
            for y in own[k:]:
                if x != y or len(self.items[donor][x]) > 1:
                    offers.setdefault(x + y, (x, y))
        order = sorted(offers, reverse=True)
        for left in range(self.capacity - self.fill[donor]):
            for length in order:
                for b in self.full_if.get(length + left, ()):
                    room = self.capacity - self.fill[b]
                    if room > left:                           # the item taken is shorter
                        self._leave(b)
                        self._give(b, donor, length + left - room)
                        for x in offers[length]:
                            self._give(donor, b, x)
                        self._enter(b)
                        return True
        return False

    def run(self) -> list[list[int]]:
        changed = True
        while changed and self.left > self.bound:
            changed = False
            for donor in sorted((b for held in self.rooms for b in held), key=lambda b: (self.fill[b], b)):
                self._leave(donor)
                while 0 < self.fill[donor] < self.capacity and (self._move(donor) or self._swap(donor)):
                    changed = True
                self._enter(donor)
                if not self.fill[donor]:
                    self.left -= 1
                    if self.left == self.bound:
                        break
        return [[i for held in b.values() for i in held] for b in self.items if b]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of indices) of at most ``capacity`` each: best fit, longest first, then
    the local search over all underfull bins, unless best fit already needs no more bins
    than the sum of lengths does."""
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def tokenise_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
                    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ``ids`` on request).
    A null or empty text is one piece that holds the end id alone."""
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        encoder = word_encoder(tokenizer)
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int64()), ("ids_crc32", pa.int64())]
                           + [("ids", pa.list_(pa.int32()))] * keep_ids)
        for batch in slices(batches):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1))):
                data = encoder(text) + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    cut = data[at:at + 4 * capacity]
                    row = (doc, piece, at // 4, len(cut) // 4, zlib.crc32(cut))
                    out.append(row + (np.frombuffer(cut, "<u4").tolist(),) if keep_ids else row)
            if out:
                yield rows(schema, *zip(*out))

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long"
                        + (", ids array<int>" if keep_ids else "")))


def pack_pieces(pieces: DataFrame, capacity: int, per_partition: int = 1 << 16) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity``.

    Rows are dealt evenly (round robin, whatever their ids) over partitions of about
    ``per_partition`` pieces; a sequence never spans partitions. Sequences are gapless
    from offset 0; their numbers are unique but not consecutive."""
    n = max(1, -(-pieces.count() // per_partition))

    def pack(frames):
        from pyspark import TaskContext
        held = [f for f in frames if len(f)]
        if not held:
            return
        frame = pd.concat(held, ignore_index=True)
        lengths = frame["length"].tolist()
        sequence, offset = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
        for s, items in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = s, at
                at += lengths[i]
        yield frame.assign(sequence_id=sequence + (TaskContext.get().partitionId() << 32), offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return pieces.repartition(n).mapInPandas(pack, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text", per_partition: int = 1 << 16) -> DataFrame:
    """Pieces of all documents with their place. The pieces are written once (a few
    numbers each), then counted and packed. Repeated rows are documents of their own."""
    pieces = materialize(tokenise_pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    return pack_pieces(pieces, capacity, per_partition)


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All texts of ``documents`` in sequences of at most 2048 ids (word vocabulary, end id 0)."""
    import public_tokenizers
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
