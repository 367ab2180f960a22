"""Harmonic packing of token ids into training sequences."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .words import LOWER, fresh, slices, small_batches, texts_of, words

#: Letters that normalisation at most lower-cases, then marks that are a piece of their own.
PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:;=-@\[-`{-~]*)")
MARKS = frozenset(bytes([b]) for b in range(33, 127) if PLAIN.fullmatch(b"a" + bytes([b])) and not bytes([b]).isalpha())
CAPITAL = re.compile(rb"\xc3[\x80-\x96\x98-\x9e]")
#: Bytes of such letters, and a table that marks a word's last byte by a byte that no such letter has.
WITHIN = bytes(range(97, 123)) + bytes(range(0x80, 0xC0)) + b"\xc3"
LASTS = bytes(range(97, 123)) + bytes(range(0x80, 0xC0))
LAST = bytes.maketrans(LASTS, bytes(range(65, 91)) + bytes(range(64)))
SHARED: dict[str, "Ids"] = {}


def by_rank(spec: str, spelled: dict[int, int]) -> Callable[[bytes], list[int]] | None:
    """Ids of a letters-only word whose last byte went through LAST, several times faster than the model itself.

    For models with word ends whose ids follow the order of their merges, each merge giving a token of its own; None for others."""
    import tiktoken

    model = json.loads(spec)["model"]
    vocabulary = model["vocab"]
    made = [vocabulary.get("".join(m)) if isinstance(m, list) else vocabulary.get(m.replace(" ", "")) for m in model["merges"]]
    if model.get("end_of_word_suffix") != "</w>" or None in made or any(a >= b for a, b in zip(made[:-1], made[1:])):
        return None
    unspelled, ranks, letters = {chr(c): b for b, c in spelled.items()}, {}, set(WITHIN)
    for token, i in vocabulary.items():
        base, ends = token.removesuffix("</w>"), token.endswith("</w>")
        if base and all(c in unspelled for c in base) and letters.issuperset(raw := bytes(unspelled[c] for c in base)) and (not ends or raw[-1] in LASTS):
            ranks[raw[:-1] + raw[-1:].translate(LAST) if ends else raw] = i
    spare = iter(range(len(vocabulary) + 1, len(vocabulary) + 300))
    for b in range(256):
        ranks.setdefault(bytes([b]), next(spare))
    return tiktoken.Encoding("pieces", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class Ids(dict):
    """White-space-delimited word to its ids as bytes (little-endian, 32 bits), by a tokenizer that drops white space.

    The last `most` to twice as many words are remembered."""

    def __init__(self, spec: str, most: int = 250_000):
        from tokenizers import Tokenizer

        self.full, self.most, self.before = Tokenizer.from_str(spec), most, {}
        self.model = self.full.model
        # byte-level models spell the bytes 0xA1 to 0xAC and 0xAE to 0xFF as themselves and the other 68 by letters from U+0100
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.spelled = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}
        self.piece = by_rank(spec, self.spelled)

    def slow(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.spelled))]

    def letters(self, word: bytes) -> bytes:
        return array("I", self.piece(word[:-1] + word[-1:].translate(LAST)) if self.piece else self.slow(word)).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        if (ids := self.before.get(word)) is not None:
            pass
        elif word.isalpha() and word.islower():  # letters from a to z, most words: no pattern is needed
            ids = self.letters(word)
        elif word[-1:] in MARKS and word[:-1].isalpha() and word.islower():
            ids = self[word[:-1]] + (self.get(word[-1:]) or self.whole(word[-1:].decode()))
        elif not (m := PLAIN.fullmatch(word)):
            ids = self.whole(word.decode("utf-8", "replace"))
        elif CAPITAL.search(word):
            ids = self[word.decode().lower().encode()]
        elif m[2]:
            ids = self[m[1]] + (self.get(m[2]) or self.whole(m[2].decode()))
        else:
            ids = self.letters(word)
        self[word] = ids
        return ids

    def encode(self, text: bytes, end: bytes) -> bytes:
        # a special token's string counts only as written, so such texts keep their case
        table = None if b"<|" in text else LOWER
        return b"".join([b"".join(map(self.__getitem__, ws)) for ws in words(text, table)]) + end


def cuts(n: int, capacity: int, whole: int) -> Iterator[int]:
    """Lengths of the pieces of a document: as long as more than `whole` ids are left, the largest capacity // k that fits, then the rest."""
    while n > whole:
        k = -(-capacity // n) if n < capacity else 1
        while capacity // k > n:
            k += 1
        yield capacity // k
        n -= capacity // k
    if n:
        yield n


def pack(docs: DataFrame, spec: str, *, capacity: int = 2048, whole: int = 128, end_id: int = 1, text: str = "text", keep: list[str] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """One row for each piece of a document: `keep`, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, padding and (with_ids) ids.

    spec: the tokenizer's JSON. A piece of n ids is of class k = capacity // n, and k pieces of the class fill a sequence; documents are
    cut at capacity // k, so that pieces lie at the tops of their classes. Each task packs its own rows. What its open sequences hold at
    its end is strung together into full sequences and at last into sequences of powers of two, which need no padding.
    Padding is counted to `capacity`, or none at a power of two. A task holds one open sequence for each class, whatever its rows.
    A null or empty text is one piece, the end id. Repeated rows are packed each for itself. No rows: no sequences.
    Texts are packed whole, however long. Columns of `keep` that bear a new column's name are dropped, others may have any name."""
    small_batches(docs.sparkSession)
    fields = [T.StructField(n, T.LongType(), False) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padding")]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)] * with_ids
    kept = [c for c in keep if c not in {f.name for f in fields}]
    schema = T.StructType([*(docs.schema[c] for c in kept), *fields])
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 33
        types, done, left, n_seq = to_arrow_schema(schema), [], {}, 0
        if spec not in SHARED:
            SHARED.clear()
            SHARED[spec] = Ids(spec)
        ids = SHARED[spec]

        def close(pieces: list[tuple], total: int) -> None:
            nonlocal n_seq
            at, pad = 0, 0 if total & (total - 1) == 0 else capacity - total
            for row, start, data, doc in pieces:
                done.append((row, start, len(data) // 4, zlib.crc32(data), doc, first + n_seq, at, total, pad, data))
                at += len(data) // 4
            n_seq += 1

        def put(row: tuple, data: bytes) -> None:
            doc, start = len(data) // 4, 0
            for n in cuts(doc, capacity, whole):
                pieces = left.setdefault(k := capacity // n, [])
                pieces.append((row, start, data[4 * start : 4 * (start + n)], doc))
                start += n
                if len(pieces) == k:
                    close(left.pop(k), sum(len(x[2]) // 4 for x in pieces))

        def flush() -> Iterator[pa.RecordBatch]:
            for a in range(0, len(done), 5000):
                rows = done[a : a + 5000]
                columns = [pa.array([x[0][i] for x in rows], type=types.field(i).type) for i in range(len(kept))]
                columns += [pa.array([x[1 + i] for x in rows], type=pa.int64()) for i in range(8)]
                if with_ids:
                    ends = np.cumsum([0, *(x[2] for x in rows)])
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(x[9] for x in rows), "<i4"))).cast(types.field(len(kept) + 8).type))
                yield pa.RecordBatch.from_arrays(columns, schema=types)
            done.clear()

        for batch in batches:
            column = batch.column(len(kept))
            for a, b in slices(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()):
                part = batch.slice(a, b - a)
                rows = list(zip(*(part.column(i).to_pylist() for i in range(len(kept))))) if kept else [()] * (b - a)
                for row, t in zip(rows, texts_of(part.column(len(kept)))):
                    put(row, ids.encode(t, end))
                yield from flush()
        rest = [p for k in sorted(left) for p in left[k]]
        total, i, at = sum(len(x[2]) // 4 for x in rest), 0, 0
        while total:
            size = capacity if total >= capacity else 1 << (total.bit_length() - 1)
            pieces, room = [], size
            while room:
                row, start, data, doc = rest[i]
                n = min(room, len(data) // 4 - at)
                pieces.append((row, start + at, data[4 * at : 4 * (at + n)], doc))
                room, at = room - n, at + n
                if at == len(data) // 4:
                    i, at = i + 1, 0
            close(pieces, size)
            total -= size
        yield from flush()

    return docs.select(*(docs[c] for c in kept), docs[text].alias(*fresh(docs, "text"))).mapInArrow(run, schema)


def tokenizer_spec(path: str) -> str:
    """A tokenizer's JSON, read where the plan is built and sent along with the tasks (a few MB, whatever the input)."""
    return Path(path).read_text(encoding="utf-8")
