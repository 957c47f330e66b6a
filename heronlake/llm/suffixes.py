"""Removal of repeated passages with a sparse suffix array.

A byte is removed if it lies in a string of `length` (50) bytes that also starts in a document with a smaller id.

1. Documents are written once as compressed blocks of a few megabytes (`blocks`); exact copies are found by a 128-bit hash.
2. Suffixes are taken at synchronizing positions only: in every string of 50 bytes the seed (25 bytes) with the least
   hash starts a suffix. Equal strings choose equal positions, so no repeat is missed; about one suffix in 13 is left.
3. A sieve keeps suffixes whose seed occurs in two documents: the blocks send sorted seed hashes by hash range, with their
   counts, and get two bits for each back. A hash met by chance costs time but changes nothing.
4. A block keeps the places of the suffixes that are left and sends each distinct context (25 bytes before the suffix, 50
   from it on) once, with the least id that has it. Contexts go to buckets by sampled splitters on their seeds, equal
   seeds to one bucket; there are as many buckets as the number of suffixes left asks for. A bucket sorts them by a
   multikey sort of 8-byte words; neighbours with equal seeds are runs, and as borders never part equal seeds, no run goes
   on in the next bucket. Within the runs every string of 50 bytes around a seed is compared, byte by byte, and the least
   document that holds it is found. Runs are taken in pieces.
5. Seeds with more than `HOT` occurrences go to no bucket: every distinct string of 50 bytes around them is a row per block
   of an aggregation that finds its least id, so neither their documents nor their contexts meet in one task.
6. A block gets for each context how far to remove before and after the suffix, finds the same contexts again, and hashes
   the rest of each document.

A passage that a third of all documents share is one row per block and string, not per document; the same holds for exact
copies. Nothing is collected but the splitters (a bounded sample) and totals.

Defined cases: null text is the empty text; texts shorter than 50 bytes lose nothing; a null id counts as larger than all
others and is returned as null; rows with the same id do not remove from each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.common import groups, scramble
from heronlake.session import settle

LENGTH = 50
SEED = 25
BLOCK_BYTES = 4 << 20
#: Contexts that are gathered at a time.
PIECE = 16_384
#: Seeds per part of the sieve, suffixes per bucket, and contexts that a bucket compares at a time.
SIEVE_SEEDS, BUCKET_SUFFIXES, RUNS_PIECE = 1 << 21, 1 << 19, 1 << 16
#: A seed with more occurrences than this is settled string by string instead of in a bucket.
HOT = 1 << 16
#: Blocks and seeds per block that the splitters are sampled from.
SAMPLE_BLOCKS, SAMPLE_SEEDS = 64, 1_000
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
NULL_ID = (1 << 63) - 1

BLOCKS = "block long, ids binary, nulls binary, keys binary, sizes binary, body binary"


def blocks(documents: DataFrame) -> DataFrame:
    """Documents packed into blocks: ids, 16-byte content hashes, sizes, and the compressed bytes of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        bodies: list[bytes] = []

        def close() -> pa.RecordBatch:
            keys = b"".join(xxhash.xxh3_128_digest(b) for b in bodies)
            sizes = np.array([len(b) for b in bodies], np.int64)
            known = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            row = [(part << 24) | number, known.tobytes(), np.array([i is None for i in ids], np.uint8).tobytes(), keys,
                   sizes.tobytes(), pack.compress(b"".join(bodies))]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], [x.split()[0] for x in BLOCKS.split(", ")])

        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                text = text or b""
                if ids and held + len(text) > BLOCK_BYTES:
                    yield close()
                    number, held = number + 1, 0
                    ids.clear()
                    bodies.clear()
                ids.append(doc_id)
                bodies.append(text)
                held += len(text)
        if ids:
            yield close()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCKS)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one by one, so that only one block is copied at a time."""
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


class Block:
    """One unpacked block."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], np.uint8)
        keys = row["keys"]
        self.keys = [keys[16 * i:16 * i + 16] for i in range(len(self.ids))]
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.body = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=int(self.sizes.sum()) or 1), np.uint8) \
            if row.get("body") is not None else None
        first: dict[bytes, int] = {}
        for i in np.argsort(self.ids, kind="stable").tolist():
            first.setdefault(self.keys[i], i)
        #: Of equal texts in the block the one with the least id stands for all.
        self.stand_in = np.array([first[k] for k in self.keys], np.int64)

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, place in the body, seed hash) of the synchronizing suffixes of documents that stand for others."""
        own = np.flatnonzero((self.stand_in == np.arange(len(self.ids))) & (self.sizes >= LENGTH))
        texts = [self.body[self.starts[i]:self.ends[i]] for i in own]
        out = []
        for part in groups(texts):
            docs = own[part]
            sizes = self.sizes[docs]
            place, seed = synchronizing(np.concatenate(texts[part]), np.cumsum(sizes))
            doc = np.searchsorted(np.cumsum(sizes), place, side="right")
            out.append((docs[doc], place - (np.cumsum(sizes) - sizes)[doc] + self.starts[docs[doc]], seed))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*out))


    def passed(self, replies: dict[int, bytes], sieve: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, seed hash, hot) of the suffixes that passed the sieve."""
        doc, place, seed = self.suffixes()
        distinct, back = np.unique(sieve_key(seed, sieve), return_inverse=True)
        part = (distinct >> np.uint64(32)).astype(np.int64)
        bits = np.zeros((2, len(distinct)), bool)
        for p, payload in replies.items():
            if p >= 0:
                a, b = np.searchsorted(part, [p, p + 1])
                both = np.frombuffer(payload, np.uint8).reshape(2, -1)
                bits[:, a:b] = np.unpackbits(both, axis=1, count=b - a)
        keep = bits[0][back]
        return doc[keep], place[keep], seed[keep], bits[1][back][keep]


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    if base not in _powers or len(_powers[base]) < n:
        _powers[base] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]))
    return _powers[base][:n]


def synchronizing(body: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a seed has the least hash in some string of LENGTH bytes inside one document, and the hashes."""
    n, width = len(body), LENGTH - SEED + 1
    up_to = np.zeros(n + 1, np.uint64)
    np.cumsum(body * powers(BASE, n), out=up_to[1:])
    seed = scramble((up_to[SEED:] - up_to[:-SEED]) * powers(BASE_INVERSE, n)[:n - SEED + 1])
    inside = np.ones(n, bool)  # starts of strings of LENGTH bytes that end in the same document
    for end in ends:
        inside[max(0, end - LENGTH + 1):end] = False
    inside = inside[:n - LENGTH + 1]
    low, span = seed, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:len(inside)], low[width - span:width - span + len(inside)])
    low = np.where(inside, low, np.uint64(0))
    high = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    span = 1
    while span * 2 <= width:
        high = np.maximum(high[:-span], high[span:])
        span *= 2
    high = np.maximum(high[:len(seed)], high[width - span:width - span + len(seed)])
    place = np.flatnonzero(high == seed)
    return place, seed[place]


def sieve_key(seed: np.ndarray, parts: int) -> np.ndarray:
    """(part of the sieve, 32 hash bits) in one word."""
    return ((seed >> np.uint64(40)) % np.uint64(parts) << np.uint64(32)) | (seed & np.uint64(0xFFFFFFFF))


def seed_rows(made: DataFrame, parts: int) -> DataFrame:
    """(part, block, hashes, shared, counts): the distinct seed hashes of a block in a part of the sieve, in order, a bit for
    each that says whether two documents of the block have it, and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                block = Block(row)
                doc, _, seed = block.suffixes()
                if not len(seed):
                    continue
                key = sieve_key(seed, parts)
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                shared = np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start)
                key, count = key[start], np.diff(np.append(start, len(key))).astype(np.uint32)
                part = (key >> np.uint64(32)).astype(np.int64)
                cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
                rows = [[], [], [], [], []]
                for a, b in zip(cut[:-1], cut[1:]):
                    value = (key[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    step = np.diff(value, prepend=np.uint32(0))
                    rows[0].append(int(part[a]))
                    rows[1].append(block.number)
                    rows[2].append(step.view(np.uint8).reshape(-1, 4).T.tobytes())  # by byte planes, which compress
                    rows[3].append(np.packbits(shared[a:b]).tobytes())
                    rows[4].append(count[a:b].view(np.uint8).reshape(-1, 4).T.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()),
                                                  pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.binary()),
                                                  pa.array(rows[4], pa.binary())],
                                                 ["part", "block", "hashes", "shared", "counts"])

    return made.mapInArrow(run, "part int, block long, hashes binary, shared binary, counts binary")


def from_planes(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()


def shared_bits(rows: DataFrame, hot: int) -> DataFrame:
    """(block, part, payload, n, n_hot): for each hash a block sent, whether two documents have it, and whether it occurs more
    than `hot` times; the number of the block's suffixes with such hashes, by seeds that are not hot and that are."""

    def run(table: pa.Table) -> pa.Table:
        values, counts, inside, times = [], [], [], []
        for planes, bits, occur in zip(*(table.column(c).to_pylist() for c in ("hashes", "shared", "counts"))):
            step = from_planes(planes)
            times.append(from_planes(occur))
            values.append(np.cumsum(step, dtype=np.uint32))
            counts.append(len(step))
            inside.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(step)).astype(bool))
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(every), bool)
        twice[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        twice |= np.concatenate(inside)
        times = np.concatenate(times)
        start = np.flatnonzero(np.concatenate([[True], ~same]))
        often = np.empty(len(every), bool)
        often[order] = np.repeat(np.add.reduceat(times[order].astype(np.int64), start) > hot, np.diff(np.append(start, len(every))))
        often &= twice
        cuts = np.cumsum([0, *counts])
        keep = [i for i in range(len(counts)) if twice[cuts[i]:cuts[i + 1]].any()]
        return pa.table({
            "block": table.column("block").take(pa.array(keep, pa.int64())),
            "part": table.column("part").take(pa.array(keep, pa.int64())),
            "payload": pa.array([np.packbits(twice[cuts[i]:cuts[i + 1]]).tobytes()
                                 + np.packbits(often[cuts[i]:cuts[i + 1]]).tobytes() for i in keep], pa.binary()),
            **{name: pa.array([int(times[cuts[i]:cuts[i + 1]][which[cuts[i]:cuts[i + 1]]].sum()) for i in keep], pa.int64())
               for name, which in (("n", twice & ~often), ("n_hot", often))}})

    return rows.groupBy("part").applyInArrow(run, "block long, part int, payload binary, n long, n_hot long")


#: Marks replies that tell of exact copies, of strings around hot seeds, and (less the bucket) of contexts in a bucket.
COPIES, STRINGS, BUCKETS = -1, -2, -3


def copy_replies(made: DataFrame) -> DataFrame:
    """(block, part, payload): 16-byte key and least id of texts whose least id is smaller than an id in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                ids, keys = np.frombuffer(row["ids"], np.int64).tolist(), row["keys"]
                least: dict[bytes, int] = {}
                most: dict[bytes, int] = {}
                for i, doc_id in enumerate(ids):
                    key = keys[16 * i:16 * i + 16]
                    least[key] = min(doc_id, least.get(key, doc_id))
                    most[key] = max(doc_id, most.get(key, doc_id))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(least), pa.int64()), pa.array(list(least), pa.binary()),
                     pa.array(list(least.values()), pa.int64()), pa.array([most[k] for k in least], pa.int64())],
                    ["block", "key", "least", "most"])

    mine = settle(made.select("block", "ids", "keys").mapInArrow(run, "block long, key binary, least long, most long"),
                  "suffix-copies")
    all_ = mine.groupBy("key").agg(F.min("least").alias("first"), F.max("most").alias("last")).filter("first < last")
    found = (mine.join(all_.select(F.col("key").alias("a_key"), "first"), F.col("key") == F.col("a_key"))
             .filter(F.col("most") > F.col("first")))
    eight = F.unhex(F.lpad(F.hex(F.col("first")), 16, "0"))
    return (found.groupBy("block").agg(F.collect_list(F.concat("key", eight)).alias("payloads"))
            .select("block", F.lit(COPIES).alias("part"), F.concat_ws("", F.transform("payloads", lambda b: F.hex(b))).alias("h"))
            .select("block", "part", F.unhex("h").alias("payload")))


def first_ids(payload: bytes) -> dict[bytes, int]:
    return {payload[i:i + 16]: int.from_bytes(payload[i + 16:i + 24], "big", signed=True) for i in range(0, len(payload), 24)}


def with_replies(made: DataFrame, replies: DataFrame) -> DataFrame:
    lists = replies.groupBy("block").agg(F.collect_list(F.struct("part", "payload")).alias("replies"))
    return made.join(lists.withColumnRenamed("block", "r_block"), F.col("block") == F.col("r_block"), "left").drop("r_block")


def sampled_splitters(joined: DataFrame, sieve: int, parts: int) -> np.ndarray:
    """Borders between buckets: quantiles of the seeds of a bounded sample of the suffixes that passed the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                block = Block(row)
                replies = {r["part"]: r["payload"] for r in row["replies"] or []}
                _, place, seed, often = block.passed(replies, sieve)
                place, seed = place[~often], seed[~often]
                place = place[np.argsort(scramble(seed + np.uint64(block.number)), kind="stable")[:SAMPLE_SEEDS]]
                lead = block.body[place[:, None] + np.arange(SEED)]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in lead], pa.binary())], ["lead"])

    some = joined.orderBy(F.xxhash64("block")).select("block").limit(SAMPLE_BLOCKS)
    rows = joined.join(F.broadcast(some.withColumnRenamed("block", "s_block")), F.col("block") == F.col("s_block"), "left_semi")
    lead = sorted(r["lead"] for r in rows.mapInArrow(run, "lead binary").collect())  # SAMPLE_BLOCKS * SAMPLE_SEEDS at most
    return np.array([lead[i * len(lead) // parts] for i in range(1, parts)] if lead else [], f"S{SEED}")


CONTEXT = LENGTH - SEED  # bytes before a suffix that may belong to the same string
WIDTH = CONTEXT + LENGTH


class Contexts:
    """The distinct contexts of the suffixes of a block that passed the sieve, by bucket (-1: hot), and where they stand.
    Made twice, to send the contexts and to use the answers, with the same result."""

    def __init__(self, block: Block, replies: dict[int, bytes], sieve: int, splitters: np.ndarray) -> None:
        firsts = first_ids(replies.get(COPIES, b""))
        doc, place, _, often = block.passed(replies, sieve)
        original = np.array([firsts.get(k, i) >= i for k, i in zip(block.keys, block.ids.tolist())], bool)
        keep = original[doc]  # exact copies of earlier texts go as a whole
        doc, place, often = doc[keep], place[keep], often[keep]
        padded = np.concatenate([np.zeros(CONTEXT, np.uint8), block.body, np.zeros(LENGTH, np.uint8)])
        whole = np.empty((len(place), WIDTH + 2), np.uint8)
        column = np.arange(WIDTH)
        for i in range(0, len(place), PIECE):  # the places of all bytes at once would take eight times the bytes
            at, of = place[i:i + PIECE], doc[i:i + PIECE]
            context = padded[at[:, None] + column]
            before = np.minimum(at - block.starts[of], CONTEXT)
            after = np.minimum(block.ends[of] - at, LENGTH)
            context[(column < CONTEXT - before[:, None]) | (column >= CONTEXT + after[:, None])] = 0
            whole[i:i + PIECE, :WIDTH], whole[i:i + PIECE, WIDTH], whole[i:i + PIECE, WIDTH + 1] = context, before, after
        lead = np.ascontiguousarray(whole[:, CONTEXT:CONTEXT + SEED]).view(f"S{SEED}").ravel()
        bucket = np.searchsorted(splitters, lead, side="right") if len(splitters) else np.zeros(len(doc), np.int64)
        bucket = np.where(often, -1, bucket)
        name = whole.view(f"V{WIDTH + 2}").ravel()
        order = np.lexsort((block.ids[doc], hash_rows(whole), bucket))
        name, bucket = name[order], bucket[order]
        new = np.concatenate([[True], (name[1:] != name[:-1]) | (bucket[1:] != bucket[:-1])]) if len(order) else np.zeros(0, bool)
        #: Of every occurrence, in order of context and id.
        self.doc, self.place, self.of = doc[order], place[order], np.cumsum(new) - 1
        #: Of every context: bytes, bytes inside the document before and after the suffix, least id, bucket.
        self.whole, self.bucket, self.owner = whole[order[new]], bucket[new], block.ids[self.doc[new]]
        self.before, self.after = self.whole[:, WIDTH].astype(np.int64), self.whole[:, WIDTH + 1].astype(np.int64)

    def cuts(self) -> Iterator[tuple[int, slice]]:
        """The contexts of each bucket."""
        cut = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1], [True]])) if len(self.bucket) else []
        for a, b in zip(cut[:-1], cut[1:]):
            yield int(self.bucket[a]), slice(a, b)

    def strings(self, hot: slice) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(o, contexts, strings): the strings of LENGTH bytes that start o bytes before the suffix."""
        for o in range(CONTEXT + 1):
            ok = np.flatnonzero((self.before[hot] >= o) & (self.after[hot] >= LENGTH - o)) + hot.start
            if len(ok):
                yield o, ok, np.ascontiguousarray(self.whole[ok, CONTEXT - o:CONTEXT - o + LENGTH]).view(f"S{LENGTH}").ravel()

    def removals(self, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes (before, after) the suffix to remove where its context's least id stands; the first is -1 where none are."""
        left, right = np.full(len(self.bucket), -1, np.int64), np.zeros(len(self.bucket), np.int64)
        for bucket, at in self.cuts():
            if bucket < 0:
                known = np.frombuffer(replies.get(STRINGS, b""), np.dtype([("text", f"S{LENGTH}"), ("first", ">i8")]))
                known = known[np.argsort(known["text"], kind="stable")]
                for o, ok, text in self.strings(at) if len(known) else ():
                    found = np.minimum(np.searchsorted(known["text"], text), len(known) - 1)
                    hit = ok[(known["text"][found] == text) & (known["first"][found] < self.owner[ok])]
                    right[hit] = np.where(left[hit] < 0, LENGTH - o, right[hit])
                    left[hit] = o
            elif BUCKETS - bucket in replies:
                both = np.frombuffer(replies[BUCKETS - bucket], np.int8).reshape(2, -1)
                left[at], right[at] = both[0], both[1]
        return left, right


def suffix_rows(joined: DataFrame, sieve: int, splitters: np.ndarray) -> DataFrame:
    """(bucket, block, payload): the distinct contexts of a block in a bucket, each with its least id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row in rows_of(batch):
                replies = {r["part"]: r["payload"] for r in row["replies"] or []}
                if not any(part >= 0 for part in replies):
                    continue
                block = Block(row)
                mine = Contexts(block, replies, sieve, splitters)
                rows = [(bucket, block.number, pack.compress(mine.whole[at].tobytes() + mine.owner[at].tobytes()))
                        for bucket, at in mine.cuts() if bucket >= 0]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))],
                                                     ["bucket", "block", "payload"])

    return joined.mapInArrow(run, "bucket int, block long, payload binary")


def string_replies(joined: DataFrame, sieve: int, splitters: np.ndarray) -> DataFrame:
    """(block, part, payload): strings around hot seeds whose least id is smaller than an owner's in the block, and that id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                block = Block(row)
                mine = Contexts(block, {r["part"]: r["payload"] for r in row["replies"] or []}, sieve, splitters)
                for _, at in (c for c in mine.cuts() if c[0] < 0):
                    for _, ok, text in mine.strings(at):
                        order = np.lexsort((mine.owner[ok], text))
                        text, owner = text[order], mine.owner[ok][order]
                        start = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
                        last = np.append(start[1:], len(text)) - 1
                        raw = text[start].tobytes()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(start), block.number)),
                             pa.array([raw[i:i + LENGTH] for i in range(0, len(raw), LENGTH)], pa.binary()),
                             pa.array(owner[start]), pa.array(owner[last])], ["block", "text", "least", "most"])

    mine = settle(joined.mapInArrow(run, "block long, text binary, least long, most long")
                  .groupBy("block", "text").agg(F.min("least").alias("least"), F.max("most").alias("most")), "suffix-strings")
    every = mine.groupBy("text").agg(F.min("least").alias("first"), F.max("most").alias("last")).filter("first < last")
    found = (mine.join(every.select(F.col("text").alias("e_text"), "first"), F.col("text") == F.col("e_text"))
             .filter(F.col("most") > F.col("first")))
    eight = F.unhex(F.lpad(F.hex(F.col("first")), 16, "0"))
    return (found.groupBy("block").agg(F.collect_list(F.hex(F.concat("text", eight))).alias("payloads"))
            .select("block", F.lit(STRINGS).alias("part"), F.unhex(F.concat_ws("", "payloads")).alias("payload")))


def hash_rows(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    total = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        total = total * np.uint64(BASE) + column + np.uint64(1)
    return scramble(total)


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of rows of bytes: sorted by the first word of eight bytes, then only ties by the next, and so on."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    rank = np.cumsum(np.concatenate([[0], words[order[1:], 0] != words[order[:-1], 0]])) if n else np.zeros(0, np.int64)
    for w in range(1, words.shape[1]):
        tied = np.concatenate([[False], rank[1:] == rank[:-1]])
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        key = words[order[at], w]
        inner = np.lexsort((key, rank[at]))
        order[at], key = order[at][inner], key[inner]
        split = np.zeros(n, np.int64)
        split[at[1:]] = (key[1:] != key[:-1]) & (rank[at][1:] == rank[at][:-1])
        rank = rank + np.cumsum(split)
    return order


def least_owner(strings: np.ndarray, rolled: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For every row of `strings` the least owner among equal rows; rolled is a hash of the rows."""
    order = np.lexsort((owner, rolled))
    new = np.concatenate([[True], rolled[order[1:]] != rolled[order[:-1]]])
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    if not np.array_equal(strings[order], strings[head]):  # two strings with one hash: compare the bytes themselves
        order = np.lexsort((owner, *np.ascontiguousarray(strings).T[::-1]))
        new = np.concatenate([[True], (strings[order[1:]] != strings[order[:-1]]).any(axis=1)])
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    out = np.empty(len(owner), np.int64)
    out[order] = owner[head]
    return out


def repeated(context: np.ndarray, before: np.ndarray, after: np.ndarray, owner: np.ndarray, piece: int = RUNS_PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (before, after) each suffix to remove because some string of LENGTH bytes around it has a smaller owner; the
    first is -1 where there is none. owner is the least document with that context."""
    n = len(owner)
    left, right = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    order = multikey_order(context[:, CONTEXT:])
    seeds = context[order, CONTEXT:CONTEXT + SEED]
    new = np.concatenate([[True], (seeds[1:] != seeds[:-1]).any(axis=1)])
    run = np.cumsum(new) - 1
    many = np.zeros(n, bool)
    many[order] = (np.bincount(run)[run] > 1) if n else False
    at = order[many[order]]
    size = np.bincount(run)[run[many[order]]]
    start = np.flatnonzero(np.concatenate([[True], np.diff(run[many[order]]) > 0])) if len(at) else np.zeros(0, np.int64)
    label = (np.cumsum(size[start]) - size[start]) // piece
    cut = np.append(start[np.flatnonzero(np.diff(label, prepend=-1))], len(at))
    for a, b in zip(cut[:-1], cut[1:]):  # whole runs, about `piece` contexts at a time
        compare_runs(context, before, after, owner, at[a:b], left, right)
    return left, right


def compare_runs(context: np.ndarray, before: np.ndarray, after: np.ndarray, owner: np.ndarray, at: np.ndarray,
                 left: np.ndarray, right: np.ndarray) -> None:
    """Sets left and right of the contexts `at`, which are whole runs of equal seeds."""
    rows, ends_before, ends_after, owner = context[at], before[at].astype(np.int64), after[at].astype(np.int64), owner[at]
    up_to = np.zeros((len(at), WIDTH + 1), np.uint64)
    np.cumsum(rows * powers(BASE, WIDTH), axis=1, out=up_to[:, 1:])
    for o in range(CONTEXT + 1):  # strings that start o bytes before the suffix
        ok = np.flatnonzero((ends_before >= o) & (ends_after >= LENGTH - o))
        if not len(ok):
            continue
        a = CONTEXT - o
        rolled = scramble(up_to[ok, a + LENGTH] - up_to[ok, a])
        hit = ok[least_owner(rows[ok, a:a + LENGTH], rolled, owner[ok]) < owner[ok]]
        right[at[hit]] = np.where(left[at[hit]] < 0, LENGTH - o, right[at[hit]])
        left[at[hit]] = o


def intervals(rows: DataFrame) -> DataFrame:
    """(block, part, payload): for each context a block sent to a bucket, the bytes before and after the suffix to remove."""

    def run(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        contexts, owners, counts = [], [], []
        for payload in table.column("payload"):
            raw = unpack.decompress(payload.as_py())
            m = len(raw) // (WIDTH + 10)
            contexts.append(np.frombuffer(raw, np.uint8, m * (WIDTH + 2)).reshape(m, WIDTH + 2))
            owners.append(np.frombuffer(raw, np.int64, m, m * (WIDTH + 2)))
            counts.append(m)
        context, owner = np.concatenate(contexts), np.concatenate(owners)
        left, right = repeated(context[:, :WIDTH], context[:, WIDTH], context[:, WIDTH + 1], owner, RUNS_PIECE)
        both = np.stack([left, right]).astype(np.int8)
        cuts = np.cumsum([0, *counts])
        keep = [i for i in range(len(counts)) if (both[0, cuts[i]:cuts[i + 1]] >= 0).any()]
        part = BUCKETS - table.column("bucket")[0].as_py()
        return pa.table({
            "block": table.column("block").take(pa.array(keep, pa.int64())), "part": pa.array([part] * len(keep), pa.int32()),
            "payload": pa.array([np.ascontiguousarray(both[:, cuts[i]:cuts[i + 1]]).tobytes() for i in keep], pa.binary())})

    return rows.groupBy("bucket").applyInArrow(run, "block long, part int, payload binary")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def kept(joined: DataFrame, sieve: int, splitters: np.ndarray) -> DataFrame:
    """The result row of every document from its block and the answers for its contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                block = Block(row)
                replies = {r["part"]: r["payload"] for r in row["replies"] or []}
                firsts = first_ids(replies.get(COPIES, b""))
                gone = np.zeros(len(block.body) + 1, np.int32)
                if any(part >= 0 for part in replies):
                    mine = Contexts(block, replies, sieve, splitters)
                    left, right = mine.removals(replies)
                    later = (block.ids[mine.doc] > mine.owner[mine.of]) & ((mine.before + mine.after)[mine.of] >= LENGTH)
                    start = np.where(later, mine.before[mine.of], left[mine.of])
                    stop = np.where(later, mine.after[mine.of], right[mine.of])
                    hit = start >= 0
                    np.add.at(gone, (mine.place - start)[hit], 1)
                    np.add.at(gone, (mine.place + stop)[hit], -1)
                    del mine
                gone = np.cumsum(gone)[:-1] > 0
                out = []
                for i, doc_id in enumerate(block.ids.tolist()):
                    size, at = int(block.sizes[i]), int(block.starts[block.stand_in[i]])
                    mask = gone[at:at + size]
                    if size >= LENGTH and firsts.get(block.keys[i], doc_id) < doc_id:
                        mask = np.ones(size, bool)
                    text = block.body[at:at + size]
                    spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                    rest = text[~mask] if spans else text
                    out.append((None if block.nulls[i] else doc_id, size, size - len(rest), spans,
                                hashlib.sha256(rest.tobytes()).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], NAMES)

    return joined.mapInArrow(run, RESULT)


NAMES = [x.split()[0] for x in RESULT.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def dedup(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    fewest = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = settle(blocks(documents), "suffix-blocks")
    copies = settle(copy_replies(made), "suffix-copy-replies")
    sieve = max(fewest, -(-made.count() * BLOCK_BYTES // (13 * SIEVE_SEEDS)))
    shared = settle(shared_bits(seed_rows(made, sieve), HOT), "suffix-shared")
    total = shared.agg(F.sum("n").alias("n"), F.sum("n_hot").alias("n_hot")).first()
    told = shared.select("block", "part", "payload").unionByName(copies)
    joined = with_replies(made, told)
    splitters = sampled_splitters(joined, sieve, max(fewest, -(-(total["n"] or 0) // BUCKET_SUFFIXES)))
    answers = told.unionByName(intervals(suffix_rows(joined, sieve, splitters)))
    if total["n_hot"]:
        hot = shared.filter("n_hot > 0").select(F.col("block").alias("h_block"))
        answers = answers.unionByName(string_replies(joined.join(hot, F.col("block") == F.col("h_block"), "left_semi"), sieve, splitters))
    return kept(with_replies(made, answers), sieve, splitters)
