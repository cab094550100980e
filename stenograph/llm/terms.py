"""Folded words of texts in Arrow batches.

Folding needs canonical decomposition, which Spark SQL lacks; over the speech corpus this path took
about a fifth of the CPU time of the regular-expression functions of the JVM (see README), so the
corpus-wide word operators use it. It gives the words ``functions.text.words`` gives.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold_text
from ..sources.tables import spread, table
from .arrow import lists, map_batches


_WORD = re.compile(r"[^\W_]+")
_CLUSTER = re.compile("[^\u0300-\u036f][\u0300-\u036f]+")


def composed(text: str) -> tuple[str, list[int] | None]:
    """The text with letters and their marks composed, and the offset in ``text`` of each of its characters and of
    its end; null if nothing changes."""
    if text.isascii() or unicodedata.is_normalized("NFC", text):
        return text, None
    out, offsets, at = [], [], 0
    for m in _CLUSTER.finditer(text):
        whole = unicodedata.normalize("NFC", m.group())
        out += [text[at : m.start()], whole]
        offsets += range(at, m.start())
        offsets += [m.start()] * len(whole)
        at = m.end()
    out.append(text[at:])
    offsets += range(at, len(text) + 1)
    return "".join(out), offsets


def content_words(text: str | None, least: int = 4) -> list[str]:
    """The folded words of ``least`` or more characters that are all letters, in order."""
    if not text:
        return []
    return [w for w in _WORD.findall(fold_text(text)) if len(w) >= least and w.isalpha()]


def speech_rows(spark, folder: str, columns: list[str]) -> DataFrame:
    """Speech rows of interventions, copies included."""
    return spread(table(spark, folder, "interventions").where(F.col("dm_speech") == 1).select("id_int", *columns))


def with_counts(df: DataFrame, text: str = "text", least: int = 4) -> DataFrame:
    """Replace ``text`` by ``length`` (content words) and ``terms`` (array of word, tf); columns so named before are replaced."""
    keep = [c for c in df.columns if c not in (text, "length", "terms")]
    inner = "array<struct<word:string,tf:int>>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep), "length int", f"terms {inner}"])

    def run(batch: pa.RecordBatch) -> dict:
        words, counts, sizes, lengths = [], [], [], []
        for value in batch.column(text).to_pylist():
            found = content_words(value, least)
            counted = Counter(found)
            words.extend(counted)
            counts.extend(counted.values())
            sizes.append(len(counted))
            lengths.append(len(found))
        flat = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int32())], ["word", "tf"])
        return {c: batch.column(c) for c in keep} | {"length": lengths, "terms": lists(flat, sizes)}

    return map_batches(df, run, schema)


def with_distinct(df: DataFrame, text: str = "text", least: int = 4) -> DataFrame:
    """Replace ``text`` by ``words``, the distinct content words in order of first use; a column so named before is replaced."""
    keep = [c for c in df.columns if c not in (text, "words")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep), "words array<string>"])

    def run(batch: pa.RecordBatch) -> dict:
        words, sizes = [], []
        for value in batch.column(text).to_pylist():
            found = dict.fromkeys(content_words(value, least))
            words.extend(found)
            sizes.append(len(found))
        return {c: batch.column(c) for c in keep} | {"words": lists(pa.array(words, pa.string()), sizes)}

    return map_batches(df, run, schema)
