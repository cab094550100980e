"""Problem 8: encoding the corpus with a public byte-level BPE tokenizer, by prefix dynamic programming."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread, table
from .arrow import lists, map_batches

#: Folder of the public vocabularies; a parameter of every function that loads one.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Pieces longer than this many characters are encoded without being remembered.
REMEMBER = 48
#: At most this many pieces are remembered by a worker; beyond it pieces are encoded again.
MEMORY = 400_000


class PrefixEncoding:
    """The encoding of every prefix of a byte string, as the last token of each.

    In byte-level BPE each prefix has exactly one token that can end its encoding: the one whose
    bytes end the prefix and which stays as it is next to the last token of what comes before. So
    ``last[i]`` (the token that ends prefix i) describes the encoding of all prefixes at once, an
    append continues where the array ends, and an edit invalidates only what lies behind it.
    """

    def __init__(self, vocabulary: "Vocabulary", data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> "PrefixEncoding":
        """Extend by ``data``; equals encoding the whole string again."""
        v = self.vocabulary
        begin, last, ranks, fits, longest = len(self.data), self.last, v.ranks, v.fits, v.longest
        self.data += data
        base = max(0, begin - longest)  # no token reaches farther back
        near = bytes(self.data[base:])
        for end in range(begin + 1, len(self.data) + 1):
            for start in range(max(0, end - longest), end):
                token = ranks.get(near[start - base : end - base])
                if token is not None and (not start or fits(last[start - 1], token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return self

    def replace(self, begin: int, end: int, data: bytes) -> "PrefixEncoding":
        """Replace bytes ``begin`` to ``end``; prefixes up to ``begin`` are kept.

        Behind the edit, work stops as soon as the stored tokens of one longest token's length come out
        the same again: from there on nothing can differ.
        """
        old, tail = self.last, self.data[end:]
        self.data, self.last = self.data[:begin], self.last[:begin]
        self.append(data)
        same = 0
        for k in range(len(tail)):
            self.append(tail[k : k + 1])
            same = same + 1 if self.last[-1] == old[end + k] else 0
            if same > self.vocabulary.longest:
                self.data += tail[k + 1 :]
                self.last += old[end + k + 1 :]
                break
        return self

    def ids(self, end: int | None = None) -> list[int]:
        """The tokens of the prefix of ``end`` bytes, the whole string by default."""
        at = len(self.data) if end is None else end
        out = []
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class Vocabulary:
    """Ranks of a byte-level BPE, the test whether two tokens may stand next to each other, and pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.bytes = {n: b for b, n in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pattern = pattern
        self._fits: dict[tuple[int, int], bool] = {}
        self._known: dict[str, bytes] = {}
        self._split = None

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens ends in just these two."""
        found = self._fits.get((left, right))
        if found is None:
            if len(self._fits) >= MEMORY:
                self._fits.clear()
            found = self._fits[left, right] = self.merge(self.bytes[left] + self.bytes[right]) == [left, right]
        return found

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE of a few bytes, lowest rank first; the definition that ``fits`` rests on."""
        parts = [bytes(data[k : k + 1]) for k in range(len(data))]
        while len(parts) > 1:
            best, at = min(((self.ranks.get(parts[k] + parts[k + 1], 1 << 30), k) for k in range(len(parts) - 1)))
            if best == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def pieces(self, text: str) -> list[str]:
        """The pieces that merges never cross."""
        if self._split is None:
            self._split = _splitter(self.pattern)
        return self._split(text)

    def iterate(self, text: str, at: int) -> Iterator[str]:
        """The pieces from a piece's beginning on, one by one."""
        import regex

        return (m.group() for m in regex.compile(self.pattern).finditer(text, at))

    def piece(self, piece: str) -> bytes:
        """Ids of one piece as 32-bit integers; short pieces are remembered."""
        found = self._known.get(piece)
        if found is None:
            found = np.array(PrefixEncoding(self, piece.encode("utf-8", "surrogatepass")).ids(), dtype=np.int32).tobytes()
            if len(piece) <= REMEMBER and len(self._known) < MEMORY:
                self._known[piece] = found
        return found

    def encode_bytes(self, text: str) -> bytes:
        known, piece = self._known, self.piece
        return b"".join([known.get(p) or piece(p) for p in self.pieces(text)])

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null and empty give none."""
        return np.frombuffer(self.encode_bytes(text), dtype=np.int32).tolist() if text else []


def _splitter(pattern: str):
    """The pattern's split function.

    The standard library's engine takes half the time of ``regex`` but has no Unicode classes; its
    ``\\w``, ``\\d`` and ``\\s`` differ from ``\\p{L}``, ``\\p{N}`` and White_Space only in the
    characters gathered in ``odd`` and beyond the first plane. Texts without any of these go the fast way.
    """
    import regex

    exact = regex.compile(pattern)
    quick = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
    letter, number, space = (regex.compile(c) for c in (r"\p{L}", r"\p{N}", r"\s"))
    fast = (re.compile(r"[^\W\d_]"), re.compile(r"\d"), re.compile(r"\s"))
    odd = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF and any(bool(a.match(chr(c))) != bool(b.match(chr(c))) for a, b in zip((letter, number, space), fast))]
    # A class within the first plane compiles to a table; single characters beyond it would be tried one by one.
    rare = re.compile("[" + "".join(map(re.escape, odd)) + "\U00010000-\U0010ffff]")

    def split(text: str) -> list[str]:
        return exact.findall(text) if rare.search(text) else quick.findall(text)

    return split


class TextEncoding:
    """The encoding of a text, piece by piece, for exact appends and edits.

    Pieces are found from left to right, and a piece looks at most one character beyond its end. So pieces that
    end two or more before an edit stay, pieces are found anew from there, and as soon as one begins where an old
    piece began behind the edit, all later ones stay too.
    """

    def __init__(self, v: "Vocabulary", text: str, ids: list[int] | None = None) -> None:
        self.vocabulary, self.text = v, text
        self.parts = v.pieces(text)
        if ids is None:
            self.coded = [v.piece(p) for p in self.parts]
        else:  # the ids are known: they are dealt out to the pieces by the bytes they stand for
            data, at = np.array(ids, dtype=np.int32).tobytes(), 0
            sizes = [len(v.bytes[k]) for k in ids]
            self.coded, k = [], 0
            for p in self.parts:
                left = len(p.encode("utf-8", "surrogatepass"))
                at = k
                while left > 0:
                    left -= sizes[k]
                    k += 1
                self.coded.append(data[4 * at : 4 * k])

    def replace(self, begin: int, end: int, new: str) -> "TextEncoding":
        """Replace characters ``begin`` to ``end``; only the pieces near them are encoded."""
        v, parts, coded = self.vocabulary, self.parts, self.coded
        text = self.text[:begin] + new + self.text[end:]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        keep = max(0, int(np.searchsorted(starts, begin, "right")) - 2)
        shift = len(new) - (end - begin)
        old = {int(x) + shift: k for k, x in enumerate(starts[:-1]) if x >= end + 1}
        at, fresh, rest = int(starts[keep]), [], len(parts)
        for p in v.iterate(text, at):
            if at in old and at > begin + len(new):
                rest = old[at]
                break
            fresh.append(p)
            at += len(p)
        self.text, self.parts = text, parts[:keep] + fresh + parts[rest:]
        self.coded = coded[:keep] + [v.piece(p) for p in fresh] + coded[rest:]
        return self

    def append(self, new: str) -> "TextEncoding":
        return self.replace(len(self.text), len(self.text), new)

    def ids(self) -> list[int]:
        return np.frombuffer(b"".join(self.coded), dtype=np.int32).tolist()


_LOADED: dict[str, Vocabulary] = {}
#: Split pattern of the rank files, as published with them.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A rank file may have this many bytes to be sent to executors (the public ones have 1 to 4 MB).
LARGEST_FILE = 64_000_000


def _ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def vocabulary(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Vocabulary:
    """The vocabulary of ``folder/name.tiktoken``, loaded once per process."""
    key = f"{folder}/{name}"
    if key not in _LOADED:
        with open(f"{key}.tiktoken", "rb") as file:
            _LOADED[key] = Vocabulary(_ranks(file.read()), PATTERN)
    return _LOADED[key]


def _shipped(spark: SparkSession, name: str, folder: str):
    """A function that gives the vocabulary in a worker. The driver's file is broadcast, so executors need none; each
    worker reads it once."""
    with open(f"{folder}/{name}.tiktoken", "rb") as file:
        data = file.read(LARGEST_FILE + 1)
    if len(data) > LARGEST_FILE:
        raise ValueError(f"a rank file of more than {LARGEST_FILE} bytes")
    sent, key = spark.sparkContext.broadcast(data), f"sent:{folder}/{name}"

    def load() -> Vocabulary:
        if key not in _LOADED:
            _LOADED[key] = Vocabulary(_ranks(sent.value), PATTERN)
        return _LOADED[key]

    return load


def encode(documents: DataFrame, text: str = "text", output: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Replace ``text`` by its token ids.

    Strings of special tokens are ordinary text. Null and empty texts give an empty list. A text is
    split into the pieces that merges can't cross; each distinct piece is encoded once per worker by
    ``PrefixEncoding``, in time linear in its length. No shuffle, no order; all other columns are kept, but one already named
    as the output, which is replaced. Repeated rows give repeated rows, an empty table an empty one.
    """
    keep = [c for c in documents.columns if c not in (text, output)]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name in keep]

    load = _shipped(documents.sparkSession, name, folder)

    def run(batch: pa.RecordBatch) -> dict:
        v = load()
        coded = [v.encode_bytes(t) if t else b"" for t in batch.column(text).to_pylist()]
        ids = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
        return {c: batch.column(c) for c in keep} | {output: lists(ids, [len(c) // 4 for c in coded])}

    return map_batches(documents, run, ", ".join([*fields, f"`{output}` array<int>"]))


def token_counts(documents: DataFrame, text: str = "text", output: str = "n_tokens", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Replace ``text`` by its number of tokens; null and empty count 0; a column named as the output is replaced."""
    keep = [c for c in documents.columns if c not in (text, output)]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name in keep]

    load = _shipped(documents.sparkSession, name, folder)

    def run(batch: pa.RecordBatch) -> dict:
        v = load()
        return {c: batch.column(c) for c in keep} | {output: [len(v.encode_bytes(t)) // 4 if t else 0 for t in batch.column(text).to_pylist()]}

    return map_batches(documents, run, ", ".join([*fields, f"`{output}` bigint"]))


def encode_edited(documents: DataFrame, key: str = "doc_id", text: str = "text", ids: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, ids) of edited texts from the ids they had before, encoding only what lies near the edits.

    ``documents``: key, ``text`` and ``ids`` before the edit, ``begin`` and ``end`` (characters to replace, counted in
    code points and cut to the text), ``new`` (what comes there). Null texts count as empty, null bounds as the text's
    end (so an append needs neither), a null ``new`` as nothing. The result equals encoding the edited text.
    """
    kind = documents.schema[key].dataType.simpleString()
    load = _shipped(documents.sparkSession, name, folder)

    def run(batch: pa.RecordBatch) -> dict:
        v, out = load(), []
        for value, known, begin, end, new in zip(*(batch.column(c).to_pylist() for c in (text, ids, "begin", "end", "new"))):
            value = value or ""
            begin = len(value) if begin is None else min(max(begin, 0), len(value))
            end = len(value) if end is None else min(max(end, begin), len(value))
            out.append(b"".join(TextEncoding(v, value, known or []).replace(begin, end, new or "").coded))
        coded = pa.array(np.frombuffer(b"".join(out), dtype=np.int32))
        return {key: batch.column(key), "ids": lists(coded, [len(c) // 4 for c in out])}

    return map_batches(documents.select(key, text, ids, "begin", "end", "new"), run, f"`{key}` {kind}, ids array<int>")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids) of every document by byte_bpe_50k."""
    return encode(spread(table(spark, folder, "documents").select("doc_id", "text")))


def p8_edited(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids) of every document with its middle character replaced, from its ids and the edit."""
    rows = spread(table(spark, folder, "documents").select("doc_id", "text"))
    known = encode(rows.withColumn("kept", F.col("text"))).withColumnRenamed("kept", "text")
    middle = F.floor(F.length(F.coalesce("text", F.lit(""))) / 2).cast("int")
    return encode_edited(known.select("doc_id", "text", "ids", middle.alias("begin"), (middle + 1).alias("end"), F.lit(" ñu, ").alias("new")))


QUERIES = {"p8_ids": p8_ids, "p8_edited": p8_edited}
SQL: dict[str, str] = {}
