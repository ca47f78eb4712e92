"""Near duplicates by ProbMinHash over weighted word shingles, banding and exact verification.

**Shingles** are ``shingle`` consecutive lower-cased words, weighted by how often they occur in the text; a shorter text is
one shingle. Two texts are *linked* when the Jaccard similarity of their shingle sets is ``similarity`` or more.
Classes are the connected components of the links.

**Signatures.** Every shingle is a Poisson process: its arrivals, at a rate of its weight, and the component each
arrival goes to come from a hash of the shingle. A component of the signature is the shingle that arrives
there first. Two texts agree in a component with the probability Jaccard similarity of their weights; a shingle stops
arriving once it is later than the latest first arrival of its text, which is what keeps long texts cheap. Where
weights differ from 1, the signature with all weights 1 is taken as well (there the agreement is the plain
Jaccard similarity that links are defined by), and the text goes by both.

**Banding.** ``bands`` groups of ``rows`` components hash to buckets. With 40 bands of 7 a pair of similarity 0.8 shares
no bucket with probability 8e-5, one of 0.9 with 5e-12.

**Verification** does not list the pairs of a bucket. Equal texts are one node from the start. Then

1. each bucket takes as its centre the member whose buckets are the fullest (in a group of edited copies, the
   original), and every member is compared with it: links and components;
2. where what meets a centre still is of several components, those apart from the centre (strays) may be linked with others that
   meet it. Linked sets share one of their rarest shingles: of ``n``, the first ``n - ceil(0.8 n) + 1`` in one order of all
   shingles, whatever it is. So members come together by those shingles. Up to ``SMALL`` that share one are paired;
   whoever shares one with more is compared in its family, in blocks of ``BLOCK``. Pages that have no more in common than
   their frame share no rare shingle, and are not compared at all.

Pairs are ruled out by signature first, then compared by their sets.

The Jaccard distance obeys the triangle inequality: a stray cannot be linked to a member of the centre's component that is
nearer to the centre by more than a link is long. So clusters that are merely near each other are not taken up again, while
a component that reaches far from its centre, link by link, is compared with strays as far out.
Signatures rule out pairs that agree in fewer than ``MAYBE`` of their components, four standard deviations
below 0.8. Sets are moved for the pairs that remain, dealt by centre and salted by the number of its pairs.

* Null text counts as empty. Texts without words are in a class with equal texts only.
* The class is named by its smallest identifier, null if it has none. Repeated rows are in one class.
* An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakehist.llm.common import checkpointed, fresh, quoted, scratch, slices, text_or_empty
from lakehist.llm.words import mixed, words

#: Signatures that agree less than ``MAYBE`` are of texts less similar than 0.8; of two texts that are linked, one agrees
#: with a third text at most ``REACH`` less than the other does: 0.2 for the link, the rest for what signatures miss.
MAYBE, REACH = 0.70, 0.35
#: Pairs of one centre and members of one bucket that are compared in one place, text that is hashed at a time.
PAIRS_PER_SALT, BLOCK, SLICE_BYTES = 512, 512, 4 << 20
#: Members that share a rare shingle and are paired, and buckets in which shingles are counted to tell the rare ones.
SMALL, SKETCH = 16, 1 << 18
#: Digests that a task remembers, so that it signs copies once.
REMEMBERED = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of every text: number of the text, hash, occurrences. In no order."""
    split = words(texts)
    counts = split.counts
    text = split.text_of_word()
    left = split.bounds[1:][text] - np.arange(len(text))  # words from here to the end of the text
    # A shingle begins where as many words are left, and in a shorter text at its first word.
    begin = np.flatnonzero((left >= length) | ((counts[text] < length) & (left == counts[text])))
    hashes = np.zeros(len(begin), np.uint64)
    for k in range(length):
        there = left[begin] > k
        word = split.hashes[np.minimum(begin + k, max(len(split.hashes) - 1, 0))] if len(begin) else hashes
        hashes = np.where(there, mixed(hashes * _STEP + word), hashes)
    of = text[begin]
    # Equal shingles of one text come together under a hash that the number of the text is part of.
    both = hashes ^ mixed(of.astype(np.uint64) + np.uint64(1))
    order = np.argsort(both)
    both = both[order]
    starts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else order
    weights = np.diff(np.concatenate([starts, [len(both)]]))
    return of[order[starts]], hashes[order[starts]], weights


def prob_minhash(text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, size: int) -> np.ndarray:
    """For every text the elements that arrive first at each of ``size`` components, 0 where there is no element."""
    first = np.full(texts * size, np.inf)
    winner = np.zeros(texts * size, np.uint64)
    stop = np.full(texts, np.inf)
    at, state, rate, time = text, element, 1.0 / weight, np.zeros(len(text))
    draw, offset = 0, np.zeros(1, np.uint64)
    while len(at):
        draw, offset = draw + 1, offset + _STEP
        random = mixed(state + offset)
        time = time - np.log(((random >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40) * rate
        alive = time < stop[at]
        if not alive.all():
            at, state, rate, time, random = at[alive], state[alive], rate[alive], time[alive], random[alive]
        component = ((random & np.uint64(0xFFFFFF)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
        cell = at * size + component
        np.minimum.at(first, cell, time)
        won = first[cell] == time
        winner[cell[won]] = state[won]
        open_texts = np.unique(at) if draw > 8 else np.arange(texts)
        stop[open_texts] = first.reshape(texts, size)[open_texts].max(axis=1)
    return winner.reshape(texts, size)


def _buckets(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash for every band of every signature."""
    parts = signatures.reshape(len(signatures), bands, rows)
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(signatures), 1))
    for k in range(rows):
        out = mixed(out * _STEP + parts[:, :, k])
    return out


def _signed(texts: pa.Array, shingle: int, bands: int, rows: int) -> list[pa.Array]:
    n, size = len(texts), bands * rows
    of, element, weight = shingles(texts, shingle)
    weighted = prob_minhash(of, element, weight.astype(np.float64), n, size)
    some = np.zeros(n, bool)
    some[of] = True
    repeats = np.zeros(n, bool)
    repeats[of[weight > 1]] = True
    number = np.cumsum(repeats) - 1
    own = repeats[of]
    plain = weighted.copy()
    if own.any():
        plain[repeats] = prob_minhash(number[of[own]], element[own], np.ones(own.sum()), int(repeats.sum()), size)
    per_text = np.where(some, np.where(repeats, 2 * bands, bands), 0)
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    out = np.zeros(bounds[-1], np.uint64)
    out[bounds[:-1][some, None] + np.arange(bands)] = _buckets(plain[some], bands, rows)
    out[bounds[:-1][repeats, None] + bands + np.arange(bands)] = _buckets(weighted[repeats], bands, rows)
    signature = (plain & np.uint64(0xFFFF)).astype(np.uint16)
    return [
        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(out.view(np.int64))),
        pa.array([s.tobytes() for s in signature], pa.binary()),
    ]


def _sets(texts: pa.Array, shingle: int) -> pa.Array:
    of, element, _ = shingles(texts, shingle)
    element = element.view(np.int64)
    order = np.lexsort((element, of))
    bounds = np.searchsorted(of[order], np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(element[order]))


def _agreement(one: pa.Array, other: pa.Array) -> np.ndarray:
    """The share of components in which signatures agree."""
    if not len(one):
        return np.zeros(0)
    a = np.frombuffer(b"".join(one.to_pylist()), np.uint16).reshape(len(one), -1)
    b = np.frombuffer(b"".join(other.to_pylist()), np.uint16).reshape(len(one), -1)
    return (a == b).mean(axis=1)


def _jaccard(one: np.ndarray, other: np.ndarray) -> float:
    """Of two sorted sets."""
    if not len(one) or not len(other):
        return 0.0
    at = np.minimum(np.searchsorted(other, one), len(other) - 1)
    common = int((other[at] == one).sum())
    return common / (len(one) + len(other) - common)


class NearDuplicates:
    """One run over one table; the steps share the nodes, the sets and the links found so far."""

    def __init__(
        self, docs: DataFrame, id_column: str, text_column: str, shingle: int, similarity: float, bands: int, rows: int
    ) -> None:
        self.spark, self.shingle, self.similarity = docs.sparkSession, shingle, similarity
        self.bands, self.rows = bands, rows
        text = text_or_empty(text_column)
        self.docs = docs.select(F.col(quoted(id_column)).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
        self.nodes = self._nodes()
        self.links: DataFrame | None = None
        self.labels = self.spark.createDataFrame([], "node long, label long")

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        """Written to the shared folder and read back: the lineage ends here."""
        path = scratch(self.spark, f"near-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _nodes(self) -> DataFrame:
        """One row per distinct text: digest, number, smallest identifier, buckets, signature."""
        shingle, bands, rows = self.shingle, self.bands, self.rows

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[bytes] = set()
            for batch in batches:
                for part in slices(batch, 2, SLICE_BYTES):
                    # Copies within a task are signed once; the group takes what any of its rows has.
                    digests = part.column(1).to_pylist()
                    new = np.array([d not in seen and not seen.add(d) for d in digests], bool)
                    place = pa.array(np.cumsum(new) - 1, mask=~new)
                    signed = [a.take(place) for a in _signed(part.column(2).filter(pa.array(new)), shingle, bands, rows)]
                    if len(seen) > REMEMBERED:
                        seen.clear()
                    yield pa.record_batch([part.column(0), part.column(1), *signed], names=["doc_id", "digest", "buckets", "signature"])

        kind = dict(self.docs.dtypes)["doc_id"]
        signed = self.docs.mapInArrow(sign, f"doc_id {kind}, digest binary, buckets array<long>, signature binary")
        nodes = signed.groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("buckets", ignorenulls=True).alias("buckets"),
            F.first("signature", ignorenulls=True).alias("signature"),
        )
        return self._stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    def _members(self) -> DataFrame:
        """``bucket, node, total``: buckets of two or more nodes, and how many nodes all buckets of the node hold."""
        members = self.nodes.select("node", F.explode(F.array_distinct("buckets")).alias("bucket"))
        sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        shared = members.join(sizes, "bucket")
        totals = shared.groupBy("node").agg(F.sum("size").alias("total"))
        return self._stored(shared.drop("size").join(totals, "node"), "members")

    def _shingle_sets(self, members: DataFrame) -> DataFrame:
        """The shingle set of every node that shares a bucket, dealt by node and kept that way."""
        shingle = self.shingle

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, 1, SLICE_BYTES):
                    yield pa.record_batch([part.column(0), _sets(part.column(1), shingle)], names=["node", "shingles"])

        wanted = self.nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "digest", "doc_id")
        same = (F.col("d.digest") == F.col("w.digest")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
        texts = self.docs.alias("d").join(wanted.alias("w"), same).select("w.node", "d.text")
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        found = texts.mapInArrow(sets, "node long, shingles array<long>").dropDuplicates(["node"])
        return checkpointed(found.repartition(partitions, "node"))

    def _agreed(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (``node``, ``centre``) with the agreement of their signatures."""
        signatures = self.nodes.select("node", "signature")
        both = pairs.join(signatures, "node").join(
            signatures.withColumnsRenamed({"node": "centre", "signature": "other"}), "centre"
        )

        def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                agreement = _agreement(batch.column(2), batch.column(3))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(agreement)], names=["node", "centre", "agreement"])

        found = both.select("node", "centre", "signature", "other").mapInArrow(agree, "node long, centre long, agreement double")
        return self._stored(found, "agreed")

    def _verified(self, likely: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs ``likely`` whose sets are similar enough."""
        # A centre's set is copied once for so many of its pairs, and the pairs are spread over the copies.
        salts = likely.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_SALT).cast("int").alias("salts"))
        centres = sets.withColumnsRenamed({"node": "centre", "shingles": "others"}).join(salts, "centre")
        centres = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        salted = likely.join(salts, "centre").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
        met = salted.drop("salts").join(sets, "node").join(centres, ["centre", "salt"])
        common = F.size(F.array_intersect("shingles", "others"))
        jaccard = common / (F.size("shingles") + F.size("others") - common)
        return self._stored(met.where(jaccard >= self.similarity).select("node", "centre"), "links")

    def _link(self, found: DataFrame) -> None:
        """Take the links up into the components."""
        if self.links is not None and found.isEmpty():
            return
        self.links = found if self.links is None else self.links.unionByName(found)
        self.labels = components(self.links)

    def _labelled(self, rows: DataFrame, node: str, label: str) -> DataFrame:
        named = self.labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
        return rows.join(named, node, "left").withColumn(label, F.coalesce("_label", node)).drop("_label")

    def run(self) -> DataFrame:
        """``doc_id, digest, class_id, class_size`` for every row."""
        members = self._members()
        sets = self._shingle_sets(members)

        best = members.groupBy("bucket").agg(F.max_by("node", F.struct("total", -F.col("node"))).alias("centre"))
        met = members.join(best, "bucket").where("node <> centre")
        agreed = self._agreed(met.select("node", "centre").distinct())
        self._link(self._verified(agreed.where(F.col("agreement") >= MAYBE).select("node", "centre"), sets))

        # Families: all that meets a centre. Strays are those that are not in its component.
        rows = agreed.unionByName(agreed.select(F.col("centre").alias("node"), "centre", F.lit(1.0).alias("agreement")).distinct())
        rows = self._labelled(self._labelled(rows, "node", "label"), "centre", "home")
        rows = rows.withColumn("stray", F.col("label") != F.col("home"))
        mixed = rows.groupBy("centre").agg(
            F.max(F.when(F.col("stray"), F.col("agreement"))).alias("nearest"),
            F.min(F.when(~F.col("stray"), F.col("agreement"))).alias("farthest"),
            F.sum(F.col("stray").cast("long")).alias("strays"),
            F.count(F.lit(1)).alias("all"),
        )
        # Members linked with the centre itself may agree as little as 0.8, whatever has been seen of them.
        near = F.col("nearest") >= F.least(F.lit(self.similarity), F.col("farthest")) - REACH
        # With one stray and the centre alone, everything has been compared.
        mixed = mixed.where("all > 2").where(near | (F.col("strays") > 1)).select("centre", near.alias("near"))
        left = rows.join(mixed, "centre").where(F.col("stray") | (F.col("near") & (F.col("node") != F.col("centre"))))
        left = self._stored(left.select("centre", "node", "label", "stray"), "left")
        if not left.isEmpty():
            self._link(self._strays(left, sets))
        return self._classes()

    def _rarest(self, left: DataFrame, sets: DataFrame) -> DataFrame:
        """``shingle, node, label, asks, size``: of each set the shingles one of which it shares with every set linked to it, where
        another component has the shingle too and a stray is among those that have it."""
        similarity = self.similarity
        members = left.groupBy("node").agg(F.first("label").alias("label"), F.max("stray").alias("asks")).join(sets, "node")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(SKETCH, np.int64)
            for batch in batches:
                seen += np.bincount(batch.column(3).flatten().to_numpy() & (SKETCH - 1), minlength=SKETCH)
            at = np.flatnonzero(seen)
            yield pa.record_batch([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

        counted = members.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
        sketch = np.zeros(SKETCH, np.int64)
        sketch[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
        held = self.spark.sparkContext.broadcast(sketch)

        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                size = np.diff(batch.column(3).offsets.to_numpy())
                owner, shingle = np.repeat(np.arange(len(size)), size), batch.column(3).flatten().to_numpy()
                order = np.lexsort((shingle, held.value[shingle & (SKETCH - 1)], owner))
                nth = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size)
                some = order[nth < (size - np.ceil(similarity * size - 1e-9) + 1)[owner]]
                own = pa.array(owner[some])
                yield pa.record_batch([pa.array(shingle[some]), *(batch.column(c).take(own) for c in range(3))], names=["shingle", "node", "label", "asks"])

        rarest = members.select("node", "label", "asks", "shingles").mapInArrow(first, "shingle long, node long, label long, asks boolean")
        rarest = self._stored(rarest, "rarest")
        shared = rarest.groupBy("shingle").agg(
            F.count(F.lit(1)).alias("size"), F.max("asks").alias("asked"), (F.min("label") != F.max("label")).alias("apart")
        )
        return self._stored(rarest.join(shared.where("asked AND apart").select("shingle", "size"), "shingle"), "shared")

    def _asked(self, left: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs of a stray and another that share a rare shingle with few, and the members of ``left`` that share one with many."""
        rarest = self._rarest(left, sets)
        few = rarest.where(F.col("size") <= SMALL)
        pairs = few.where("asks").select("shingle", F.col("node").alias("a"), "label").join(
            few.select("shingle", F.col("node").alias("b"), F.col("label").alias("other")), "shingle"
        ).where("label <> other")
        pairs = pairs.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("centre")).distinct()
        many = rarest.where(F.col("size") > SMALL).select("node").distinct()
        return self._stored(pairs, "pairs"), self._stored(left.join(many, "node", "left_semi"), "many")

    def _strays(self, left: DataFrame, sets: DataFrame) -> DataFrame:
        """Links of a stray with another member of its family, across components."""
        pairs, many = self._asked(left, sets)
        found = self.spark.createDataFrame([], "node long, centre long")
        if not pairs.isEmpty():
            agreed = self._agreed(pairs).where(F.col("agreement") >= MAYBE)
            found = found.unionByName(self._verified(agreed.select("node", "centre"), sets))
        return found if many.isEmpty() else found.unionByName(self._in_blocks(many, sets))

    def _in_blocks(self, left: DataFrame, sets: DataFrame) -> DataFrame:
        """Links of strays, each compared with all of its family that are in another component, once each."""
        similarity = self.similarity
        blocks = left.groupBy("centre").agg(
            F.ceil(F.sum(F.col("stray").cast("long")) / BLOCK).cast("int").alias("stray_blocks"),
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("all_blocks"),
        )
        left = left.join(blocks.where("stray_blocks > 0"), "centre")
        own = F.pmod(F.xxhash64("node"), F.col("stray_blocks")).cast("int")
        other = F.pmod(F.xxhash64("node"), F.col("all_blocks")).cast("int")
        every = F.sequence(F.lit(0), F.col("all_blocks") - 1)
        asked = left.where("stray").select("centre", "node", "label", own.alias("i"), F.explode(every).alias("j"), F.lit(True).alias("asks"))
        every = F.sequence(F.lit(0), F.col("stray_blocks") - 1)
        asked_of = left.select("centre", "node", "label", F.explode(every).alias("i"), other.alias("j"), F.lit(False).alias("asks"))
        cells = asked.unionByName(asked_of).join(self.nodes.select("node", "signature"), "node").join(sets, "node")

        def compare(table: pa.Table) -> pa.Table:
            node, label = table["node"].to_numpy(), table["label"].to_numpy()
            asks, held = table["asks"].to_numpy(), table["shingles"]
            signature = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(len(node), -1)
            theirs, found = np.flatnonzero(~asks), set()
            for i in np.flatnonzero(asks):
                there = theirs[label[theirs] != label[i]]
                there = there[(signature[there] == signature[i]).mean(axis=1) >= MAYBE]
                mine = held[int(i)].values.to_numpy() if len(there) else None
                for j in there.tolist():
                    pair = min(node[i], node[j]), max(node[i], node[j])
                    if pair not in found and _jaccard(mine, held[j].values.to_numpy()) >= similarity:
                        found.add(pair)
            return pa.table({"node": pa.array([a for a, _ in found], pa.int64()), "centre": pa.array([b for _, b in found], pa.int64())})

        found = cells.groupBy("centre", "i", "j").applyInArrow(compare, "node long, centre long")
        return self._stored(found.distinct(), "strays")

    def _classes(self) -> DataFrame:
        nodes = self._labelled(self.nodes.select("digest", "node", "doc_id", "copies"), "node", "label")
        classes = nodes.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
        named = nodes.join(classes, "label").select("digest", "class_id", "class_size")
        return self.docs.select("doc_id", "digest").join(named, "digest")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node that has a link: the smallest node of its connected component.

    Alternating stars: every node points its larger neighbours to the smallest node it knows, then its smaller ones and
    itself, until each component is one star. Rounds follow the logarithm of a component's diameter.
    """
    edges = links.select(F.greatest("node", "centre").alias("u"), F.least("node", "centre").alias("v")).where("u <> v").distinct()
    edges, before = checkpointed(edges), None
    while True:
        ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = ends.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(edges.join(least, "u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.where("u <> v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = edges.groupBy("u").agg(F.min("v").alias("label"))
    return checkpointed(
        stars.select(F.col("u").alias("node"), "label").unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    bands: int = 40,
    rows: int = 7,
) -> DataFrame:
    """``doc_id, class_id, class_size, kept``: ``kept`` is true for the document that names its class."""
    classes = NearDuplicates(docs, id_column, text_column, shingle, similarity, bands, rows).run()
    return classes.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One document of each class, the one with the smallest identifier, in the columns of ``docs``."""
    run = NearDuplicates(
        docs,
        id_column,
        text_column,
        settings.get("shingle", 5),
        settings.get("similarity", 0.8),
        settings.get("bands", 40),
        settings.get("rows", 7),
    )
    digest, row = fresh(docs, "_digest"), fresh(docs, "_row")
    kept = run.run().where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id", "digest").distinct()
    keyed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(row),
        F.unhex(F.sha2(text_or_empty(text_column), 256)).alias(digest),
        F.col(quoted(id_column)).alias("_id"),
    )
    same = (F.col(f"a.{digest}") == F.col("b.digest")) & F.col("a._id").eqNullSafe(F.col("b.doc_id"))
    stays = keyed.alias("a").join(kept.alias("b"), same).select(f"a.{row}", f"a.{digest}", "a._id")
    # Rows that repeat identifier and text: one of them.
    one = stays.withColumn("_nth", F.row_number().over(Window.partitionBy(digest, "_id").orderBy(digest))).where("_nth = 1")
    return one.select(*[F.col(f"{row}.{quoted(c)}").alias(c) for c in docs.columns])
