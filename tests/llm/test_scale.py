"""Texts of ten million characters, and plans that hold when nothing is small."""

from __future__ import annotations

import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stenograph.llm import pieces, scans, sentences

SIZE, SMALL = 10_000_000, 3_000_000
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def stretched(part: str) -> str:
    """Ordinary text at full size, odd texts somewhat shorter to keep the tests quick."""
    size = SIZE if len(part) > 12 else SMALL
    return (part * (size // len(part) + 1))[:size]


@pytest.mark.parametrize(
    "part", ["Fin. El señor GIL SANZ: No, eh, digo. (Aplausos.) ", "(", "(a [b {c <d *e ", "Gil, Sanz, Toro, ", "GIL SANZ\n", "A. B. ", "12 34 ", "A – ", " ", "[10:00:05] "]
)
def test_pieces_of_ten_million_characters(part):
    text = stretched(part)
    began = time.perf_counter()
    pieces.strip_pieces(text, pieces.pieces(text))
    assert time.perf_counter() - began < 60  # linear: about 10 s on a slow machine; a quadratic pass takes hours


@pytest.mark.parametrize("part", ["La ley sigue. ", "(", "([«", '"a. B" ', ". — ", "x", "ฝ่าย 12 ", "12 34 ", ". "])
def test_sentences_of_ten_million_characters(part):
    text = stretched(part)
    began = time.perf_counter()
    sentences.boundaries(text)
    assert time.perf_counter() - began < 60


@pytest.mark.parametrize("part", ["la funda-\nción sigue\n", "— 12 —\n", "x-", "\n     ", " ", "DIARIO DE SESIONES / 45\n", "La ley sigue en pie. "])
def test_scans_of_ten_million_characters(part):
    text = stretched(part)
    began = time.perf_counter()
    lines = scans.lines_of(text, scans.Headers(["diariodesesiones"]))
    found = [{"start_char": a, "end_char": a + len(c), "kind": "hyphen", "repaired": w} for a, w, c, _ in scans.words_of(lines) if c]
    scans.repair(text, found)
    assert time.perf_counter() - began < 60


def test_frequent_and_double_misreadings_are_mended(spark):
    rows = [(f"a{k}", "El general viene con el parlamentario.") for k in range(600)] + [(f"b{k}", "El gcneral viene.") for k in range(25)] + [("c", "El parlamcntaiio viene.")]
    found = scans.faults(spark.createDataFrame(rows, "id_int string, text string"))
    assert {(r["kind"], r["repaired"]): r["n"] for r in found.groupBy("kind", "repaired").agg(F.count("*").alias("n")).collect()} == {("char", "general"): 25, ("char", "parlamentario"): 1}


def test_wide_page_lines_and_long_headers():
    name = "Diario de Sesiones de las Honorables Cámaras Reunidas de la República y de su Comisión Permanente Bicameral"
    assert scans.header_like(f"{name} — 45") and scans.header_like("DSCD — 45")
    text = "uno dos\n" + " " * 40 + "— 345 —" + " " * 40 + "\ntres cuatro"
    assert [k for *_, k in scans.lines_of(text, scans.Headers([]))] == [None, "page", None]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are missing")
@pytest.mark.parametrize("query", ["p1_found", "p2_found", "p4_found", "p5_found"])
def test_rows_are_the_same_when_nothing_small_is_broadcast(spark, query):
    """Only sides of a proven bound are hinted; the rest is broadcast below Spark's threshold alone, and needn't be."""
    from stenograph.llm import registry

    run = lambda: sorted(map(tuple, registry.queries()[query](spark, FOLDER).collect()))
    want = run()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        assert run() == want and want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_no_text_is_shuffled(spark):
    """Texts of unique rows don't pass an exchange on the way to counts and pieces."""
    rows = spark.createDataFrame([(str(k), k, "uno dos tres", None, None) for k in range(50)], "id_int string, row_n bigint, text string, party string, sex string")
    from stenograph.sources.tables import one_per_key

    copied = rows.unionByName(rows.limit(1).withColumn("row_n", F.lit(99).cast("bigint")))
    one = one_per_key(copied, "id_int", "row_n", ["id_int", "text"], payload=True)
    assert one.count() == 50
    plan = one._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "Aggregate" not in plan
