import itertools
import math
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from lakehist.llm.sharding import hilbert_index, hilbert_shards, laid_out, quantised
from pyspark.sql import functions as F


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 1), (2, 3), (3, 2), (3, 4)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(spark, dimensions, bits):
    cells = list(itertools.product(range(2**bits), repeat=dimensions))
    frame = spark.createDataFrame([(list(c),) for c in cells], "x array<int>")
    found = {r["h"]: r["x"] for r in frame.select("x", hilbert_index(F.col("x"), dimensions, bits).alias("h")).collect()}
    assert sorted(found) == list(range(len(cells)))
    for h in range(1, len(cells)):
        assert sum(abs(a - b) for a, b in zip(found[h], found[h - 1])) == 1


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_the_law_holds(odd_docs, law):
    found = hilbert_shards(odd_docs, 4, law=law).collect()
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        assert r["law"] == law and r["grown_shard"] is None and 0 <= r["shard"] < 4
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = sorted((len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in odd_docs.collect())
    assert sorted((r["size"], r["text_crc32"]) for r in found) == texts
    if law == "rows":
        counts = [len(s) for s in slots.values()]
        assert max(counts) - min(counts) <= 1 and len(counts) == 4


def test_bytes_are_near_equal(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('x', CAST(id % 90 AS INT)) AS text", "'s' AS source", "'en' AS lang", "1 AS _at", "2 AS shard")
    sizes = [r[1] for r in hilbert_shards(docs, 8, law="bytes").groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * 98


def test_rows_of_one_range_lie_together(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text", "CONCAT('s', id % 30) AS source", "CONCAT('l', id % 3) AS lang")
    found = hilbert_shards(docs, 10, carry=("source",))
    per_shard = found.groupBy("shard").agg(F.countDistinct("source").alias("n")).agg(F.avg("n")).first()[0]
    assert per_shard < 20  # of 30; a random order has all of them in each


def test_repeats_and_reruns(odd_docs, no_docs):
    first, again = (sorted(map(tuple, hilbert_shards(d, 3).collect()), key=str) for d in (odd_docs, odd_docs.repartition(5)))
    assert first == again
    assert hilbert_shards(no_docs, 3).collect() == []


def brute_places(spark, docs, shards):
    """``(doc_id, crc, shard, slot)`` by sorting all rows in one list; hashes and curve indexes are Spark's."""
    rows = docs.selectExpr("doc_id", "text", "source", "lang", "xxhash64(coalesce(text, '')) AS t", "xxhash64(doc_id, coalesce(text, '')) AS i").collect()

    def levels(values, numbers):
        known = sorted(v for v in values if v is not None)
        if numbers:
            splits = [known[max(math.ceil(k / 15 * len(known)) - 1, 0)] for k in range(1, 15)] if known else []
            return [0 if v is None else 1 + sum(v > s for s in splits) for v in values]
        middle = {v: known.index(v) + known.count(v) / 2 for v in set(known)}
        kinds = sorted({int(m / len(known) * 15) for m in middle.values()})
        return [0 if v is None else 1 + kinds.index(int(middle[v] / len(known) * 15)) for v in values]

    sizes = [math.log2(len((r["text"] or "").encode()) + 8) for r in rows]
    cells = list(zip(levels([r["source"] for r in rows], False), levels([r["lang"] for r in rows], False), levels(sizes, True)))
    frame = spark.createDataFrame([(list(c),) for c in set(cells)], "x array<int>")
    h = {tuple(r["x"]): r["h"] for r in frame.select("x", hilbert_index(F.col("x"), 3, 4).alias("h")).collect()}
    home, own = {}, {}
    for r, c in zip(rows, cells):
        home[r["t"]] = min(home.get(r["t"], c), c)
        own[r] = c
    unsigned = lambda x: x % 2**64
    order = sorted(rows, key=lambda r: (h[home[r["t"]]], unsigned(r["t"]) >> 56, r["t"], own[r], unsigned(r["i"]) >> 56, r["i"], r["doc_id"] is not None, r["doc_id"]))
    out, used = [], Counter()
    for at, r in enumerate(order):
        shard = at * shards // len(rows)
        out.append((r["doc_id"], zlib.crc32((r["text"] or "").encode()), shard, used[shard]))
        used[shard] += 1
    return out


def test_shards_and_slots_against_brute_force(spark, sf_dir, odd_docs):
    for docs in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        found = [(r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in hilbert_shards(docs, 7).collect()]
        assert sorted(found, key=str) == sorted(brute_places(spark, docs, 7), key=str)


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_equal_texts_share_a_shard(spark, law):
    """Copies with other metadata too; a cut of the law divides one text at most."""
    docs = spark.range(2000).selectExpr(
        "id AS doc_id", "CONCAT('text ', IF(id % 3 = 0, id % 90, IF(id % 3 = 1, -1, id))) AS text", "CONCAT('s', id % 30) AS source", "CONCAT('l', id % 3) AS lang")
    shards = defaultdict(Counter)
    for r in hilbert_shards(docs, 12, law=law, carry=("text",)).collect():
        shards[r["text"]][r["shard"]] += 1
    divided = {t: s for t, s in shards.items() if len(s) > 1}
    assert sum(len(s) - 1 for s in divided.values()) <= 11 and len(divided) <= 8
    assert all(max(s) - min(s) == len(s) - 1 for s in divided.values())


def test_long_common_prefixes_do_not_hide_a_dimension(spark):
    plain = spark.range(3200).selectExpr("id AS doc_id", "CONCAT('t', id) AS text", "'en' AS lang", "CHAR(97 + id % 16) AS source")
    long = plain.withColumn("source", F.concat(F.lit("https://www.example.org/"), "source"))
    sources = [
        {r["shard"]: r["n"] for r in hilbert_shards(d, 24, carry=("source",)).groupBy("shard").agg(F.countDistinct("source").alias("n")).collect()}
        for d in (plain, long)
    ]
    assert sources[0] == sources[1] and max(sources[1].values()) <= 4


def test_levels_of_strings_follow_the_shares_of_the_rows(spark):
    rows = spark.range(1000).selectExpr("IF(id % 4 = 0, NULL, IF(id % 4 = 1, 'hot', CONCAT('common_crawl_', LPAD(id, 4, '0')))) AS d")
    levels = dict(quantised(rows, ["d"], 3).groupBy("d").count().collect())
    assert levels[0] == 250 and sum(levels.values()) == 1000
    shared = [n for level, n in levels.items() if level and n != 250]
    assert len(shared) >= 4 and max(shared) - min(shared) < 60


def test_files_are_runs_of_the_curve(spark, tmp_path):
    """Statistics of the files: shards do not overlap, and a source is in few files."""
    docs = spark.range(6000).selectExpr("id AS doc_id", "CONCAT('t', id) AS text", "CONCAT('https://host', LPAD(id % 20, 2, '0')) AS source", "CONCAT('l', id % 3) AS lang")
    laid_out(hilbert_shards(docs, 12, carry=("source", "lang")), 24).write.parquet(str(tmp_path / "out"))
    ranges, rows = [], 0
    for file in Path(tmp_path / "out").glob("*.parquet"):
        table = pq.read_table(file)
        pairs = list(zip(table["shard"].to_pylist(), table["slot"].to_pylist()))
        assert pairs == sorted(pairs)
        group = pq.ParquetFile(file).metadata.row_group(0)
        found = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        ranges.append((pairs[0], pairs[-1], found["source"].min, found["source"].max))
        rows += len(pairs)
    ranges.sort()
    assert rows == 6000 and len(ranges) >= 12
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    wanted = [sum(r[2] <= f"https://host{i:02}" <= r[3] for r in ranges) for i in range(20)]
    assert sum(wanted) / len(wanted) < len(ranges) / 3  # unsorted files would all have every source


def test_carried_columns_of_clashing_names(odd_docs):
    docs = odd_docs.withColumnsRenamed({"n_chars": "Shard"}).withColumn("_shard", F.lit("own"))
    found = hilbert_shards(docs, 3, carry=("Shard", "_shard", "lang"))
    assert found.columns[-3:] == ["_Shard", "__shard", "lang"]
    assert found.select("`_Shard`").count() == docs.count()
