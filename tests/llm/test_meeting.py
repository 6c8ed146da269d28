"""The second round of the line dedup takes postings from the lists of lines."""

import numpy as np

from playmart.llm import line_dedup
from playmart.llm.common import importable


def test_postings_that_meet_wanted_lines_are_of_their_size(spark):
    """A wanted line meets lines of its size under a token; the longer ones that share the token don't come."""
    importable(spark)
    text = ["a b c d e f g h i j", "a b c d e f g h i k", " ".join(["a", *[f"x{i}" for i in range(60)]])]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    counters = np.zeros(line_dedup.COUNTERS, np.int64)
    lines = line_dedup.lines_of(docs, counters, 80)
    by_id = {r.doc_id: r for r in lines.collect()}
    same = by_id[1].prefix[:1]
    rows = [(True, i, 0, 0, by_id[i].rep, by_id[i].n, 1, 2, same + [77 + i]) for i in range(3)]
    df = spark.createDataFrame(rows, line_dedup.LINES.format(id="doc_id long"))
    wanted = spark.createDataFrame([(by_id[1].rep,)], "rep long")
    got = line_dedup.meeting(df, counters, wanted, 80).collect()
    assert {(r.key, r.rep, r.place) for r in got} == {(same[0], by_id[0].rep, 0), (same[0], by_id[1].rep, 0),
                                                      (78, by_id[1].rep, 1)}
    assert all((r.n, r.s0, r.s1, r.o2) == (10, 1, 2, 0) for r in got)
