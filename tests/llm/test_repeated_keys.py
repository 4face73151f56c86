"""A key that is repeated with other texts loses no group."""

import pytest

from ledgerloom.llm import near_copies, simhash


@pytest.mark.parametrize("keep_one", [simhash.keep_one, near_copies.keep_one])
def test_each_group_keeps_a_row(spark, keep_one):
    a, b = (" ".join(f"{x}{i}" for i in range(400)) for x in "ab")
    rows = [(5, a), (5, a), (5, b), (7, b + " end"), (9, "alone")]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(5, a), (5, b), (9, "alone")]
