"""Best-fit packing of tokenised documents into sequences, planned on the histogram of lengths.

Only ``capacity`` lengths exist, so the plan is made on counts by length, whose size does not depend on the corpus:

* Pieces above a third of the capacity fit at most two to a sequence. From the longest on, each length is matched
  greedily with the longest other one that still fits.
* Shorter pieces, longest first, go where they leave the least room (best fit), many equal sequences at a time.

The plan is a table of segments (length, ranks, sequences, offset). Each piece gets its rank among pieces of its
length from a range-sorted table and reads its place off the segments.

Defined results: null and empty texts have the single id 0; a document longer than the capacity is cut into full pieces, with the
rest in front; ties and repeated rows are pieces of their own; an empty table gives an empty result; other columns are ignored.
Strings of special tokens inside texts are ordinary text.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import Lean, materialize, ranked

CAPACITY = 2048
END_ID = 0
#: The byte-pair encoder fails on a run of a million blanks; texts longer than this are cut into pieces for it, and a longer piece goes to the tokenizer.
USUAL_CHARS = 500_000
#: Pieces of the byte-level BPE (fixed value of the public GPT-2 vocabulary), and the same for texts of usual characters.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where no two blanks meet, the first are the same without their lookahead, which takes less time.
PLAIN_PIECES = PIECES.replace(r"\s+(?!\S)|", "")
USUAL_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Outside these characters, engines may differ in what a letter, a number or a space is; such texts go to the tokenizer whole.
UNUSUAL = r"[^\t\n\r\x20-\x7E¡-©«-±´-¸»¿-ſ‐-‧]"


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the rest follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Text -> its ids as little-endian unsigned 32-bit bytes.

    Texts of usual characters go to a byte-pair encoder made from the same vocabulary, whose ids are the ranks of its merges, since that
    takes less time; others to the tokenizer. Nothing is remembered from text to text.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.pieces, self.unusual = re.compile(USUAL_PIECES).findall, re.compile(UNUSUAL).search
        letters = _byte_letters()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(letters[c] for c in token): i for token, i in self.tokenizer.get_vocab().items() if token not in special}
        self.usual_ids, self.plain_ids = (tiktoken.Encoding("pieces", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for p in (PIECES, PLAIN_PIECES))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def usual(self, text: str) -> bytes:
        # tabs and carriage returns are rare, and usual characters have no other blanks
        runs = "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\t" in text or "\r" in text
        return array("I", (self.usual_ids if runs else self.plain_ids)(text)).tobytes()

    def encode(self, text: str) -> bytes:
        if self.unusual(text):
            return self.whole(text)
        if len(text) <= USUAL_CHARS:
            return self.usual(text)
        return b"".join(self.usual(p) if len(p) <= USUAL_CHARS else self.whole(p) for p in self.pieces(text))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, the shorter rest in front."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _tokenized(batches: Iterator[pa.RecordBatch], path: str, capacity: int, ids: bool) -> Iterator[pa.RecordBatch]:
    if sys.byteorder != "little":
        raise RuntimeError("ids are written in the machine's byte order, which must be little-endian")
    encoder = Encoder(path)
    end = np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = encoder.encode(text or "") + end
            for k, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                part = data[4 * start : 4 * (start + length)]
                for column, value in zip(out, (doc, k, start, length, zlib.crc32(part), part if ids else None), strict=True):
                    column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked, the ids as bytes."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    out = slim.mapInArrow(Lean(_tokenized, path=path, capacity=capacity, ids=ids), schema)
    return out if ids else out.drop("ids")


class _Bins:
    """Groups of equal sequences, found by the room they have left."""

    def __init__(self):
        self.rooms: list[int] = []
        self.by: dict[int, list] = {}
        self.full: list = []

    def add(self, room: int, items: tuple, n: int) -> None:
        if not n:
            return
        if not room:
            self.full.append((items, n))
            return
        if room not in self.by:
            insort(self.rooms, room)
            self.by[room] = []
        self.by[room].append((items, n))

    def tightest(self, size: int):
        """Take out a group with the least room that holds ``size``."""
        i = bisect_left(self.rooms, size)
        if i == len(self.rooms):
            return None
        room = self.rooms[i]
        items, n = self.by[room].pop()
        if not self.by[room]:
            del self.by[room], self.rooms[i]
        return room, items, n

    def groups(self) -> list:
        return self.full + [g for room in self.rooms for g in self.by[room]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """Groups (((length, how many), ...), number of sequences) that hold all pieces counted by length."""
    left = {s: n for s, n in counts.items() if n}
    bins = _Bins()
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        mates = [b for b in large[: bisect_left(large, capacity - a + 1)] if b != a or left[a] > 1]
        if mates:
            b = mates[-1]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            bins.add(capacity - a - b, ((a, 2),) if a == b else ((a, 1), (b, 1)), n)
            left[a] -= n
            left[b] -= n
        else:
            bins.add(capacity - a, ((a, 1),), left[a])
            left[a] = 0
        large = [s for s in large if left[s]]
    for s in sorted((s for s in left if left[s]), reverse=True):
        n = left[s]
        while n:
            room, items, k = bins.tightest(s) or (capacity, (), n)
            each = room // s
            whole = min(k, n // each)
            bins.add(room - each * s, (*items, (s, each)), whole)
            n -= whole * each
            if whole < k:
                if n and n < each:
                    bins.add(room - n * s, (*items, (s, n)), 1)
                    n, whole = 0, whole + 1
                if items:
                    bins.add(room, items, k - whole)
    return bins.groups()


def segments(groups: list[tuple[tuple, int]]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks: where they start, their first sequence, offset and pieces a sequence."""
    rows, taken, base = [], {}, 0
    for items, n in groups:
        offset = 0
        for s, each in items:
            rows.append((s, taken.get(s, 0), base, offset, each))
            taken[s] = taken.get(s, 0) + each * n
            offset += s * each
        base += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "offset", "each"), columns, strict=True))


def _placed(batches: Iterator[pa.RecordBatch], seg: dict[str, np.ndarray], first: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = int(seg["rank"].max(initial=0)) + 1
    keys = seg["length"] * width + seg["rank"]
    for batch in batches:
        at = {n: batch.schema.get_field_index(n) for n in ("length", "rank")}
        length, rank = batch.column(at["length"]).to_numpy(), batch.column(at["rank"]).to_numpy()
        own = rank - first[length]
        i = np.searchsorted(keys, length * width + np.minimum(own, width - 1), side="right") - 1
        local, each = own - seg["rank"][i], seg["each"][i]
        sequence, offset = seg["sequence"][i] + local // each, seg["offset"][i] + local % each * length
        keep = [k for k in range(batch.num_columns) if k not in (at["rank"], batch.schema.get_field_index("total"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in keep] + [pa.array(sequence), pa.array(offset)], [batch.schema.names[k] for k in keep] + ["sequence_id", "offset"]
        )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece with its sequence_id and offset (and its ids, if asked)."""
    pieces = materialize(tokenize(docs, path, capacity, ids, doc_id, text), "pieces")
    # at most ``capacity`` rows come to the driver
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    seg = segments(plan(counts, capacity))
    first = np.zeros(capacity + 2, np.int64)
    for s in range(capacity + 1):
        first[s + 1] = first[s] + counts.get(s, 0)
    placed = ranked(pieces, [F.col("length"), F.col("ids_crc32"), F.col("doc_id"), F.col("piece")], "rank", "total", "packed")
    out = [c for c in placed.columns if c not in ("rank", "total")]
    schema = ", ".join(f"{c} {t}" for c, t in placed.select(*out).dtypes) + ", sequence_id bigint, offset bigint"
    return placed.mapInArrow(Lean(_placed, seg=seg, first=first), schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves; each has ``capacity`` ids at most."""
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
