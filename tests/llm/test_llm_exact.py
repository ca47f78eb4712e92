from collections import defaultdict

import pytest
from lakehist.llm.exact import exact_groups


def expected(rows, largest):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    out = []
    for r in rows:
        ids = groups[r["text"] or ""]
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        out.append((r["doc_id"], keep, len(ids), r["doc_id"] == keep))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_of_equal_texts(odd_docs, keep):
    found = exact_groups(odd_docs, keep=keep, fan=2, rounds=3).collect()
    assert sorted((tuple(r)[:4] for r in found), key=str) == expected(odd_docs.collect(), keep == "largest")


def test_one_round_and_a_large_group(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', CAST(id AS STRING)) AS text", "id AS kept", "id AS run")
    found = exact_groups(docs, fan=4, rounds=1)
    assert found.where("kept").count() == 5000 - 1666
    assert {r["group_size"] for r in found.collect()} == {1, 1667}


def test_empty(no_docs):
    assert exact_groups(no_docs).collect() == []


def test_unknown_rule(no_docs):
    with pytest.raises(ValueError):
        exact_groups(no_docs, keep="any")


def test_identifiers_that_are_no_numbers_are_refused(odd_docs):
    with pytest.raises(TypeError, match="doc_id"):
        exact_groups(odd_docs.withColumn("doc_id", odd_docs.lang))
    assert exact_groups(odd_docs.withColumn("doc_id", odd_docs.doc_id.cast("int"))).count() == odd_docs.count()
