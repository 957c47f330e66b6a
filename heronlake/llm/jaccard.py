"""N-gram Jaccard join: grouped prefix join, verified exactly, with connected components.

A document's set holds the 64-bit hashes of its distinct word shingles. All sets are put in one order: shingles that more
than `frequent` of the documents hold come last, the others first, each by hash. Two sets of the wanted similarity share one
of their first n - ceil(t n) + 1 shingles (their prefixes).

1. Equal sets are one node. Nodes with the same prefix and size are one group.
2. Groups meet by shingle of their prefixes; a bucket is cut where sizes are too far apart to link, and buckets with the
   same members are one bucket. A group of several nodes is a bucket as well.
3. Buckets are expanded to nodes with a bitmap of each set. The bits of one set that the other lacks bound the overlap from
   above; the components of the pairs within the bound go on, nodes without such a pair fall off. They meet once more with
   bitmaps in proportion to their sets, so that long texts, whose small bitmaps are full, are told apart as well.
4. The texts of the nodes that are left are brought together by component and the pairs verified exactly. Two nodes that
   are connected already need no further comparison, so a group of many near copies costs about one comparison each.
5. Components of the verified links give every document its class.

Buckets with more than `CHUNK` members, and components with more than `CHUNK_SHINGLES` shingles, are dealt out as pairs
of chunks, so no task holds more than two chunks. Frequent
shingles are few by their definition (at most average set size / frequent); only their list is sent to all tasks.

Defined cases: null text is the empty text; texts without words have size 0 and are a class each; equal texts are one
class; of rows with the same id each has its own set, and the id joins nothing; a null id is ignored in the least id of a
class (null if there is no other); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heronlake.llm.common import groups, scramble
from heronlake.llm.components import components
from heronlake.session import settle

#: Members of a bucket whose bitmaps stand in one chunk, and shingles of those whose texts do.
CHUNK, CHUNK_SHINGLES = 2_048, 500_000
BITS = 2_048
MIX = 0x9E3779B97F4A7C15
MIX_INVERSE = pow(MIX, -1, 1 << 64)


@dataclass(frozen=True)
class Settings:
    """Shingles of `words` words; a link needs den * intersection >= num * union. frequent: share of the documents from
    which a shingle counts as frequent and comes last in the order."""

    words: int = 3
    num: int = 90
    den: int = 100
    frequent: float = 0.005


#: Near duplicates elsewhere in the package: five words, four fifths.
NEAR = Settings(words=5, num=80)


def prefix_size(n: int, s: Settings) -> int:
    return n - -(-n * s.num // s.den) + 1


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        _powers[base] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]))
    return _powers[base][:n]


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    if not texts:
        return []
    body = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    body = np.where((body >= 65) & (body <= 90), body + np.uint8(32), body)
    blank = (body == 32) | ((body >= 9) & (body <= 13))
    start = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    up_to = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body + np.uint64(1)) * _power(MIX, len(body)), out=up_to[1:])
    word = scramble((up_to[end] - up_to[start]) * _power(MIX_INVERSE, len(body))[start] + (end - start).astype(np.uint64))
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    count = np.bincount(owner, minlength=len(texts))
    if len(word) >= words:
        gram = word[:len(word) - words + 1]
        for i in range(1, words):
            gram = scramble(gram * np.uint64(MIX) + word[i:len(word) - words + 1 + i])
        gram_owner = owner[:len(gram)]
        inside = gram_owner == owner[words - 1:]
        gram, gram_owner = gram[inside], gram_owner[inside]
    else:
        gram, gram_owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    cuts = np.searchsorted(gram_owner, np.arange(len(texts) + 1))
    first = np.concatenate([[0], np.cumsum(count)])
    out = []
    for i in range(len(texts)):
        if count[i] >= words:
            out.append(np.unique(gram[cuts[i]:cuts[i + 1]]))
        elif count[i]:  # fewer words than a shingle: the whole sequence, told from others by its number of words
            h = np.uint64(count[i])
            for w in word[first[i]:first[i + 1]]:
                h = scramble(np.array([h * np.uint64(MIX) + w], np.uint64))[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
    with np.errstate(over="ignore"):
        for part in groups(texts):
            yield from shingle_sets(texts[part], words)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def frequent_shingles(documents: DataFrame, s: Settings) -> np.ndarray:
    """Shingles in more than s.frequent of the documents and, in some task, of the task's documents, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, n = [], 0
        for batch in batches:
            for x in text_sets(batch.column(0), s.words):
                sets.append(x)
                n += 1
            if sum(map(len, sets)) > 4_000_000:
                yield counted(sets, n)
                sets, n = [], 0
        if n:
            yield counted(sets, n)

    def counted(sets: list[np.ndarray], n: int) -> pa.RecordBatch:
        value, times = np.unique(np.concatenate(sets), return_counts=True)
        keep = times >= max(4, s.frequent * n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(signed(value[keep]), 0)), pa.array(np.append(times[keep], n)),
             pa.array(np.append(np.zeros(int(keep.sum()), bool), True))], ["shingle", "times", "total"])

    rows = documents.select("text").mapInArrow(run, "shingle long, times long, total boolean")
    sums = settle(rows.groupBy("shingle", "total").agg(F.sum("times").alias("times")), "jaccard-frequent")
    total = sums.filter("total").agg(F.sum("times").alias("n")).first()["n"] or 0
    found = sums.filter(~F.col("total") & (F.col("times") > max(4.0, s.frequent * total))).select("shingle").collect()
    return np.sort(np.array([r["shingle"] for r in found], np.int64).view(np.uint64))


def bitmap(tokens: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bytes of a bitmap with a bit for the hash of each shingle; bits is a power of two, so that halves can be folded."""
    out = np.zeros(bits, np.uint8)
    out[(tokens >> np.uint64(20)) & np.uint64(bits - 1)] = 1
    return np.packbits(out)


def wide(n: int) -> int:
    """Bits for a set of n shingles so that about a fifth is set: BITS is enough up to BITS / 4 shingles."""
    return max(BITS, 1 << (4 * n - 1).bit_length())


class Bitmaps:
    """Bitmaps of members in order of set size, so of growing width; a wider one is folded to meet a narrower one."""

    def __init__(self, bits: list[np.ndarray]) -> None:
        words = np.array([len(b) for b in bits])
        self.cuts = [0, *(np.flatnonzero(np.diff(words)) + 1).tolist(), len(bits)]
        self.rows = [np.stack(bits[a:b]) for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def common(self, row: int, to: int) -> tuple[int, np.ndarray, np.ndarray]:
        """(bits set in row, bits set in each of row + 1 .. to - 1, bits common to both)."""
        at = int(np.searchsorted(self.cuts, row, side="right")) - 1
        own = self.rows[at][row - self.cuts[at]]
        filled, both = [], []
        while self.cuts[at] < to:
            first, last = max(row + 1, self.cuts[at]), min(to, self.cuts[at + 1])
            others = self.rows[at][first - self.cuts[at]:last - self.cuts[at]]
            while others.shape[1] > len(own):
                others = others[:, :others.shape[1] // 2] | others[:, others.shape[1] // 2:]
            filled.append(np.bitwise_count(others).sum(axis=1, dtype=np.int64))
            both.append(np.bitwise_count(others & own).sum(axis=1, dtype=np.int64))
            at += 1
        return int(np.bitwise_count(own).sum()), np.concatenate(filled), np.concatenate(both)


def name_of(tokens: np.ndarray) -> int:
    """A set's node: a hash of its shingles."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


NODES = "doc_id long, text_hash long, n long, node long, grp long, prefix binary, bitmap binary, wide binary"


def node_rows(documents: DataFrame, frequent: np.ndarray, s: Settings) -> DataFrame:
    """One row per document; prefix and bitmap only where a task meets a set for the first time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            n, node, grp, prefix, bits, more = [], [], [], [], [], []
            for tokens in text_sets(batch.column(1), s.words):
                n.append(len(tokens))
                name = name_of(tokens)
                node.append(name)
                if name in met or not len(tokens):
                    grp.append(None)
                    prefix.append(None)
                    bits.append(None)
                    more.append(None)
                    continue
                met.add(name)
                last = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens \
                    if len(frequent) else np.zeros(len(tokens), bool)
                lead = np.concatenate([tokens[~last], tokens[last]])[:prefix_size(len(tokens), s)]
                grp.append(xxhash.xxh3_64_intdigest(lead.tobytes(), seed=len(tokens)) - (1 << 63))
                prefix.append(lead.tobytes())
                bits.append(bitmap(tokens).tobytes())
                more.append(bitmap(tokens, wide(len(tokens))).tobytes() if wide(len(tokens)) > BITS else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(grp, pa.int64()),
                 pa.array(prefix, pa.binary()), pa.array(bits, pa.binary()), pa.array(more, pa.binary())], [x.split()[0] for x in NODES.split(", ")])

    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, NODES)


def token_rows(nodes: DataFrame) -> DataFrame:
    """(token, n, grp) for every shingle of every group's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = [np.frombuffer(p, np.int64) for p in batch.column("prefix").to_pylist()]
            if not lead:
                continue
            times = [len(x) for x in lead]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(lead)), pa.array(np.repeat(batch.column("n").to_numpy(), times)),
                 pa.array(np.repeat(batch.column("grp").to_numpy(), times))], ["token", "n", "grp"])

    return nodes.filter("prefix IS NOT NULL").select("n", "grp", "prefix").mapInArrow(run, "token long, n long, grp long")


def group_buckets(tokens: DataFrame, s: Settings) -> DataFrame:
    """(bucket, grp): groups that share a shingle and are near in size; buckets named by their members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            if not len(held[0]):
                continue
            done = int(np.searchsorted(held[0], held[0][-1]))  # the last shingle may go on in the next batch
            yield from bucketed([h[:done] for h in held])
            held = [h[done:] for h in held]
        yield from bucketed(held)

    def bucketed(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, n, grp = rows
        if not len(token):
            return
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (grp[1:] != grp[:-1])])
        token, n, grp = token[new], n[new], grp[new]
        start = np.concatenate([[True], (token[1:] != token[:-1]) | (s.den * n[:-1] < s.num * n[1:])])
        first = np.flatnonzero(start)
        size = np.diff(np.append(first, len(token)))
        with np.errstate(over="ignore"):
            name = scramble(np.add.reduceat(scramble(grp.view(np.uint64)), first) + size.astype(np.uint64))
        many = np.repeat(size > 1, size)
        yield pa.RecordBatch.from_arrays([pa.array(signed(np.repeat(name, size)[many])), pa.array(grp[many])], ["bucket", "grp"])

    ordered = tokens.repartition("token").sortWithinPartitions("token", "n", "grp")
    return ordered.mapInArrow(run, "bucket long, grp long").distinct()


def units(members: DataFrame, weight: Column, limit: int) -> DataFrame:
    """Deals the members of a bucket (bucket, node, n) out to units (bucket, i, j) of at most two chunks, a chunk being
    members of about `limit` in weight: every pair of members meets in one unit. Adds `side` (0: chunk i, 1: chunk j)."""
    upto = F.sum(weight).over(Window.partitionBy("bucket").orderBy("n", "node").rowsBetween(Window.unboundedPreceding, 0))
    dealt = members.withColumn("chunk", F.floor((upto - weight) / limit).cast("int"))
    last = (members.groupBy("bucket").agg(F.sum(weight).alias("total"))
            .select(F.col("bucket").alias("c_bucket"), F.floor((F.col("total") - 1) / limit).cast("int").alias("last")))
    every = F.sequence(F.lit(0), F.greatest("last", "chunk"))
    pairs = F.transform(every, lambda k: F.struct(
        F.least("chunk", k).alias("i"), F.greatest("chunk", k).alias("j"), (k < F.col("chunk")).cast("int").alias("side")))
    return (dealt.join(last, F.col("bucket") == F.col("c_bucket")).withColumn("unit", F.explode(pairs))
            .select("bucket", "unit.i", "unit.j", "unit.side", "node", "n"))


def near_pairs(n: np.ndarray, bits: Bitmaps, row: int, s: Settings) -> np.ndarray:
    """Members after `row` (n ascending) that may link with it, judged by sizes and bitmaps: a set has at least as many
    shingles that the other lacks as its bitmap has bits that the other lacks."""
    to = int(np.searchsorted(n, n[row] * s.den // s.num, side="right"))
    if to <= row + 1:
        return np.zeros(0, np.int64)
    own, filled, common = bits.common(row, to)
    most = np.minimum(n[row] - own + common, n[row + 1:to] - filled + common)
    return np.flatnonzero(most * (s.den + s.num) >= s.num * (n[row] + n[row + 1:to])) + row + 1


def labels_of(n: np.ndarray, side: np.ndarray, cross: bool, bits: Bitmaps, s: Settings, links) -> np.ndarray:
    """Component of each member; links(row, other) says which of the others really link. Others that are in the
    component of the row already are not asked."""
    label = np.arange(len(n))
    for row in range(len(n)):
        near = near_pairs(n, bits, row, s)
        if cross:
            near = near[side[near] != side[row]]
        while len(near := near[label[near] != label[row]]):
            other, near = near[0], near[1:]
            if links(row, int(other)):
                label[label == label[other]] = label[row]
    return label


LINKS = "a long, b long"


def spanning(node: np.ndarray, n: np.ndarray, side: np.ndarray, bits: Bitmaps, cross: bool, s: Settings, same) -> pa.Table:
    """Links (a, b) between members of a unit for which same(row, other) holds, as many as connect all that belong together."""
    found: list[tuple[int, int]] = []

    def links(row: int, other: int) -> bool:
        if not same(row, other):
            return False
        found.append((int(node[row]), int(node[other])))
        return True

    labels_of(n, side, cross, bits, s, links)
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def likely_links(expanded: DataFrame, s: Settings) -> DataFrame:
    """(a, b): pairs of a unit whose sizes and bitmaps allow a link, as many as connect all that may belong together."""

    def run(table: pa.Table) -> pa.Table:
        node, n, side = (table.column(c).to_numpy() for c in ("node", "n", "side"))
        bits = [np.frombuffer(b, np.uint64) for b in table.column("bitmap").to_pylist()]
        order = np.lexsort((node, n))
        cross = table.column("i")[0] != table.column("j")[0]
        return spanning(node[order], n[order], side[order], Bitmaps([bits[i] for i in order]), cross, s, lambda row, other: True)

    return expanded.groupBy("bucket", "i", "j").applyInArrow(run, LINKS)


def verified_links(expanded: DataFrame, s: Settings) -> DataFrame:
    """(a, b): links of a unit (bucket, i, j, side, node, text), as many as connect all that belong together."""

    def run(table: pa.Table) -> pa.Table:
        want, side = table.column("node").to_pylist(), table.column("side").to_numpy()
        sets: dict[int, tuple[int, np.ndarray]] = {}
        for i, tokens in enumerate(text_sets(table.column("text").combine_chunks(), s.words)):
            if name_of(tokens) == want[i]:  # else another text with the same id
                sets[want[i]] = (i, tokens)
        kept = sorted(sets.items(), key=lambda x: (len(x[1][1]), x[0]))
        if len(kept) < 2:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        node = np.array([k for k, _ in kept], np.int64)
        tokens = [t for _, (_, t) in kept]
        n = np.array([len(t) for t in tokens], np.int64)

        def same(row: int, other: int) -> bool:
            small, large = (row, other) if n[row] <= n[other] else (other, row)
            at = np.minimum(np.searchsorted(tokens[large], tokens[small]), n[large] - 1)
            common = int((tokens[large][at] == tokens[small]).sum())
            return common * (s.den + s.num) >= s.num * int(n[row] + n[other])

        bits = Bitmaps([bitmap(t, wide(len(t))).view(np.uint64) for t in tokens])
        cross = table.column("i")[0] != table.column("j")[0]
        return spanning(node, n, side[[i for _, (i, _) in kept]], bits, cross, s, same)

    return expanded.groupBy("bucket", "i", "j").applyInArrow(run, LINKS)


def placed(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, text_hash, n, root) of every document: root names its class, documents with n = 0 being none's."""
    documents = documents.select("doc_id", "text")
    nodes = settle(node_rows(documents, frequent_shingles(documents, s), s), "jaccard-nodes")
    bitmaps = nodes.filter("bitmap IS NOT NULL").select("grp", "node", "n", "bitmap").dropDuplicates(["node"])
    crowded = (bitmaps.groupBy("grp").agg(F.min("node").alias("low"), F.max("node").alias("high"))
               .filter("low < high").select(F.col("grp").alias("bucket"), "grp"))
    met = group_buckets(token_rows(nodes), s).unionByName(crowded)
    expanded = settle(met.withColumnRenamed("grp", "b_grp").join(bitmaps.drop("bitmap"), F.col("b_grp") == F.col("grp"))
                      .select("bucket", "node", "n"), "jaccard-buckets")
    # bitmaps of one size first, as a node stands in many buckets; then, once per node, bitmaps as wide as its set asks for
    bits = bitmaps.select(F.col("node").alias("m_node"), "bitmap")
    dealt = units(expanded, F.lit(1), CHUNK).join(bits, F.col("node") == F.col("m_node"))
    met_again = settle(components(likely_links(dealt, s)), "jaccard-met").select("node", F.col("root").alias("bucket"))
    sized = settle(nodes.filter("bitmap IS NOT NULL").join(met_again.withColumnRenamed("node", "m_node"), F.col("node") == F.col("m_node"))
                   .groupBy("bucket", "node", "n").agg(F.first(F.coalesce("wide", "bitmap")).alias("bitmap")), "jaccard-wide")
    dealt = (units(sized.select("bucket", "node", "n"), F.col("n"), 8 * CHUNK_SHINGLES)
             .join(sized.select(F.col("node").alias("m_node"), "bitmap"), F.col("node") == F.col("m_node")))
    likely = settle(components(likely_links(dealt, s)), "jaccard-likely").select(F.col("node").alias("l_node"), F.col("root").alias("bucket"))
    # one document of each node that may link with another, its text moved once (or once per pair of chunks)
    owners = nodes.filter("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"), F.max("n").alias("n"))
    owners = settle(owners.join(likely, F.col("node") == F.col("l_node"))
                    .select("bucket", "node", "n", "one.doc_id", "one.text_hash"), "jaccard-owners")
    names = owners.select(F.col("node").alias("o_node"), F.col("doc_id").alias("o_doc_id"), F.col("text_hash").alias("o_hash"))
    placed_in = units(owners, F.col("n"), CHUNK_SHINGLES).join(names, F.col("node") == F.col("o_node"))
    texts = documents.select(F.col("doc_id").cast("long").alias("t_id"), "text", F.xxhash64("text").alias("t_hash"))
    same = F.col("t_id").eqNullSafe(F.col("o_doc_id")) & (F.col("t_hash") == F.col("o_hash"))  # an id may stand for many texts
    links = verified_links(texts.join(placed_in, same)
                           .select("bucket", "i", "j", "side", "node", "text"), s)
    roots = settle(components(links), "jaccard-roots").select(F.col("node").alias("r_node"), "root")
    return (nodes.select("doc_id", "text_hash", "n", "node").join(roots, F.col("node") == F.col("r_node"), "left")
            .select("doc_id", "text_hash", "n", F.coalesce("root", "node").alias("root")))


def classes(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    rows = placed(documents, s)
    least = rows.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")).withColumnRenamed("root", "l_root")
    return (rows.join(least, (F.col("n") > 0) & (F.col("root") == F.col("l_root")), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(documents: DataFrame, s: Settings = NEAR) -> DataFrame:
    """The documents less all but one of each class: the one with the least id stays (of rows with one id and different texts
    the one with the least text hash). Documents without words stay."""
    rows = placed(documents, s)
    order = F.struct(F.col("doc_id").isNull().alias("_no_id"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    stay = (rows.filter("n > 0").groupBy("root").agg(F.min(order).alias("first"))
            .select("first._id", "first._hash", F.lit(True).alias("_one")))
    empty = rows.filter("n = 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.lit(False).alias("_one"))
    wanted = stay.unionByName(empty).groupBy("_id", "_hash").agg(F.first("_one").alias("_one"))
    columns = documents.columns
    kept = (documents.withColumn("_doc", F.struct(*columns)).select("_doc", F.xxhash64("text").alias("_text_hash"))
            .join(wanted, F.col("_doc.doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))))
    copy = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash"))
    return kept.withColumn("_copy", copy).filter(~F.col("_one") | (F.col("_copy") == 1)).select("_doc.*")
