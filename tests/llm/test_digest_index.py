"""The digest index against plain grouping, over several batches and sessions."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm import op11_digest_index as op11
from clickloom.sources import scratch

SCHEMA = "doc_id long, text string, digest string, chars int, known boolean, keep_id string, n_rows double"
TEXTS = [(5, "a b\tc"), (3, "abc"), (9, "a  bc"), (4, "a b c"), (1, None), (2, ""), (7, " \n\x0b\x0c\r"), (8, "a bc"), (10, "Abc"), (11, "x" * 300_000), (12, " ".join("x" * 300_000)), (13, "éé"), (13, "éé"), (None, "é é"), (None, "n"), (None, "n")]


def table(spark, texts):
    """Extra columns have the names that the operator uses itself."""
    return spark.createDataFrame([(i, t, "d", 1, True, "k", 0.5) for i, t in texts], SCHEMA).repartition(3)


def plain(texts):
    """Every row's answer, by grouping in memory."""
    groups = defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)[2] if None not in {m[2] for m in members} else min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        out += [(m[2], keep, len(members), m[2] == keep, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(map(str, out))


def answers(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_one_batch_equals_plain_grouping(spark):
    with op11.DigestIndex(spark, scratch.path(spark, "index")) as index:
        assert answers(op11.deduplicate(table(spark, TEXTS), index)) == plain(TEXTS)


def test_empty_table_appends_nothing(spark):
    with op11.DigestIndex(spark, scratch.path(spark, "index")) as index:
        assert op11.deduplicate(table(spark, []), index).count() == 0
        assert index.known().count() == 0


def test_later_batches_meet_the_index(spark):
    at = scratch.path(spark, "index")
    with op11.DigestIndex(spark, at, 3) as index:
        op11.deduplicate(table(spark, [(1, "one"), (2, "two"), (3, "t w o")]), index).count()
    with op11.DigestIndex(spark, at, 3) as index:  # opened again from its folder alone
        second = [(20, "two"), (21, "o n e longer once spaced"), (22, "new"), (23, "ne w"), (24, "o n e")]
        found = {r.doc_id: r for r in op11.deduplicate(table(spark, second), index).collect()}
        assert [found[k].kept for k in (20, 21, 22, 23, 24)] == [False, True, False, True, False]
        assert (found[20].keep_id, found[22].keep_id, found[24].keep_id) == (3, 23, 1)
        assert found[20].known and found[24].known and not found[22].known and found[22].group_size == 2
        again = {r.doc_id: r for r in op11.deduplicate(table(spark, second), index).collect()}  # the same batch after a failure
        assert {k: (r.keep_id, r.kept) for k, r in again.items()} == {k: (r.keep_id, r.kept) for k, r in found.items()}
        assert index.known().count() == 4 and index.known().select("digest").distinct().count() == 4


def test_index_is_read_by_its_buckets(spark):
    """The anti-join shuffles the batch, not the index, and runs no Python."""
    with op11.DigestIndex(spark, scratch.path(spark, "index"), 8) as index:
        op11.deduplicate(table(spark, TEXTS), index)
        groups = op11.first_of_equals(spark.createDataFrame([], "doc_id long, chars int, digest binary"))
        plan = groups.join(index.known().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
        scan = plan[plan.index("SortMergeJoin") :]
        assert "SortMergeJoin" in plan and "Bucketed: true" in scan and "Python" not in plan and "Arrow" not in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("clickloom_digests")]


@pytest.mark.parametrize("blank", list(op11.BLANKS))
def test_every_blank_goes(spark, blank):
    df = spark.createDataFrame([(f"a{blank}b{blank * 3}",), ("ab",)], "t string").select(op11.digest(F.col("t")).alias("d"))
    assert df.distinct().count() == 1
