"""Byte-level BPE encoding and decoding.

A pre-token is merged by a priority queue of (merge rank, position) over a
doubly linked list of symbols; an entry whose symbols have changed since it
was queued is stale and skipped. Distinct pre-tokens and space-separated
pieces of text are merged once per worker. Decoding concatenates the
vocabulary strings of the ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import per_worker, rows, slices

# Unicode white space, as the library's pattern engine reads \s (fixed values)
SPACE = r"\t-\r \x85\xa0  -     　"
# the byte-level pre-tokenizer's pattern (fixed value), with its classes written out
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
           + SPACE + "]+(?![^" + SPACE + "])|[" + SPACE + "]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file:
    printable Latin-1 characters stand for themselves, the other bytes take the code
    points from 256 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Merger:
    """ids of one pre-token's bytes."""

    def __init__(self, byte_ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]):
        self.byte_ids, self.merges = byte_ids, merges

    def __call__(self, data: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in data]
        n, merges = len(ids), self.merges
        if n < 2:
            return ids
        before = list(range(-1, n - 1))           # doubly linked list of live symbols
        after = [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            if (m := merges.get((ids[i], ids[i + 1]))) is not None:
                queue.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue                           # stale: one of the two was merged meanwhile
            k = after[j]
            ids[i], ids[j], after[i] = made, -1, k
            if k >= 0:
                before[k] = i
                if (m := merges.get((made, ids[k]))) is not None:
                    heapq.heappush(queue, (m[0], i, made, ids[k], m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], made))) is not None:
                heapq.heappush(queue, (m[0], h, ids[h], made, m[1]))
        return [x for x in ids if x >= 0]


class Kept(dict):
    """text -> ids as little-endian unsigned 32-bit integers, made when missing."""

    def __init__(self, make, most: int, prefix: str = ""):
        super().__init__()
        self.make, self.most, self.prefix = make, most, prefix

    def __missing__(self, part: str) -> bytes:
        ids = self.make(self.prefix + part)
        if len(part) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[part] = ids
        return ids


class ByteBPE:
    """Encoder and decoder of a byte-level vocabulary file of the tokenizers library.
    Special tokens of the file are matched as written, as the library does."""

    def __init__(self, path: str, most_pieces: int = 500_000):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merges[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])
        self.merge = Merger([vocabulary[c] for c in alphabet], merges)
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        strings = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, i in vocabulary.items():
            strings[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            strings[i] = token.encode()
        self.strings = strings
        self.pieces = regex.compile(PATTERN)
        # white space but single spaces and line feeds
        self.mixed = regex.compile("[" + SPACE.replace(" ", "").replace(r"\t-\r", r"\t\x0b-\r") + "]|  ").search
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pretoken = Kept(self._merged, most_pieces)
        self.at_start = Kept(self._split, most_pieces)
        self.after_space = Kept(self._split, most_pieces, " ")
        self.newline = self._split("\n")

    def _merged(self, pretoken: str) -> bytes:
        return np.array(self.merge(pretoken.encode()), "<u4").tobytes()

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.pretoken.__getitem__, self.pieces.findall(text)))

    def _plain(self, text: str) -> bytes:
        """Text without special tokens. A single space between two other characters
        always begins a pre-token, and a line feed between two is one; so most texts fall
        apart into words that are kept whole. Texts with other white space are split by
        the pattern."""
        if self.mixed(text):
            return self._split(text)
        out = []
        for k, line in enumerate(text.split("\n")):
            if not line or line[0] == " " or line[-1] == " ":
                return self._split(text)
            if k:
                out.append(self.newline)
            first, *others = line.split(" ")
            out.append(self.at_start[first])
            out += map(self.after_space.__getitem__, others)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.specials is None or not any(s in text for s in self.special):
            return self._plain(text)
        out = []
        for k, part in enumerate(self.specials.split(text)):
            if k % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out.append(self._plain(part))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings one after another; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   keep_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256
    and, on request, ``ids`` (array). A null text counts as empty; repeated rows give
    repeated results; other columns are ignored."""
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def work(batches):
        bpe = per_worker(("byte-bpe", path), lambda: ByteBPE(path))
        columns = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                   ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * keep_ids
        schema = pa.schema(columns)
        for batch in slices(batches):
            out = []
            for text in batch.column(1).to_pylist():
                data = bpe.encode(text or "")
                ids = np.frombuffer(data, "<u4").tolist()
                decoded = bpe.decode(ids).encode()
                row = (len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded).hexdigest())
                out.append(row + (ids,) if keep_ids else row)
            yield rows(schema, batch.column(0), *zip(*out))

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(work, fields + (", ids array<int>" if keep_ids else "")))


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded with the byte vocabulary."""
    import public_tokenizers

    from tickrisk.llm.common import table
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
