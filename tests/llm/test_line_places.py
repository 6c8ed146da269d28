"""Which line comes first doesn't depend on how the rows are stored."""

import pytest

from playmart.llm import line_dedup
from playmart.llm.common import importable

A = "one two three four five six seven eight nine ten"
B = A + " eleven"


@pytest.mark.parametrize("rows,gone", [
    ([(5, A), (3, A), (4, B)], {3: [], 4: [0], 5: [0]}),
    ([(9, "w " * 1_200_000), (5, A), (4, B), (8, "v " * 1_200_000), (3, A)], {3: [], 4: [0], 5: [0], 8: [], 9: []}),
    ([(4, B), (5, A), (None, A)], {None: [], 4: [0], 5: [0]}),
])
def test_places_of_rows_out_of_order(spark, rows, gone):
    importable(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r.doc_id: r.removed_lines for r in line_dedup.report(docs).collect()} == gone


def test_places_of_several_texts_under_one_id(spark):
    importable(spark)
    rows = [(7, "x y z\nq r s\n" + A), (7, A), (7, "k l m\n" + B)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((r.n_lines, r.removed_lines) for r in line_dedup.report(docs).collect())
    assert got == [(1, []), (2, [1]), (3, [2])]
