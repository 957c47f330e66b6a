"""Spelling variants: words one edit apart, and the far more frequent form that a rare word probably stands for.

Words are counted with a partial aggregate in front of the only shuffle of the corpus; from there on the vocabulary (words
of at least `min_length` letters that occur at least `min_count` times) is all that moves. Its words are dealt to shards by
length (lengths from `LONG` on share one) and by hash slices of about `SHARD_WORDS` words, and each shard becomes one
blocked Bloom filter: a block of 512 bits per word's hash, six bits in it. Shards are taken in rounds of at most
`ROUND_BYTES` of filters, which is what is broadcast, however large the vocabulary is.

A task holds a round's filters and generates the neighbourhoods of its words as hashes, not as texts: a word's hash is a sum
over its letters, so the hash of an edited word comes from the word's by one addition and one product. Deletions are probed
in the shard of the next lower length, replacements by later letters in the word's own; insertions are the deletions of the
other word, replacements by earlier letters are found from the other side. Only the edits that a filter knows are spelt out
and shuffled to a join with the vocabulary, which drops what the filters let through in error. Nothing is lost, as a filter
never denies a word it holds and equal texts have equal hashes. A word has at most 90 times its length of neighbours.

Variants: `form` is the near word with the largest count (ties: smallest in code-point order) if that is at least `ratio`
times the word's own. Counts grow tenfold from form to form, so the roots are found by doubling in a few rounds, each
stored.

Defined cases: null and empty texts have no words; a null id counts as an empty text in the checksum that decides which
runs are edited (`counted_runs`); repeated rows count repeatedly; words of any length take part, long ones in pieces; no word
or an empty table gives no rows; all columns but doc_id and text are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.common import scramble
from heronlake.session import settle

# What a letter is, least length and count, ratio of a form's count, and the rule of edited runs.
LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
EDITED = 31

#: Words of so many letters and more share a length shard.
LONG = 64
#: About so many words per filter, 16 bits each, and bytes of filters per round.
SHARD_WORDS, BITS, ROUND_BYTES = 1 << 14, 16, 32 << 20
#: About so many words are probed by a task.
TASK_WORDS = 1 << 15
PROBES = 6
#: Edits whose hashes are held at a time.
EDITS = 1 << 19

with np.errstate(over="ignore"):
    #: A random word per letter and the powers of an odd base, all modulo 2^64.
    CODES = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)


# --- words

def counted_runs(documents: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word) once per occurrence: runs of letters in lower case; where 31 divides the checksum of `id:run`, the run
    without the letter that the checksum points at. Runs too short to count are left out."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{min_length},}}"), 0)).alias("run"))
    sums = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % EDITED == 0, shorter).otherwise(F.col("run"))
    return sums.select(word.alias("word")).filter(F.length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of words that occur at least min_count times."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# --- hashes

def powers(length: int) -> np.ndarray:
    out = np.ones(length + 1, np.uint64)
    out[1:] = np.uint64(BASE)
    return np.multiply.accumulate(out)


def by_length(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places of the words of one length, and their letters as a matrix; few enough at a time."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    start = 0
    while start < len(order):
        length = len(words[order[start]])
        stop, most = start, max(1, EDITS // (8 * length))
        while stop < len(order) and stop - start < most and len(words[order[stop]]) == length:
            stop += 1
        chosen = order[start:stop]
        letters = np.frombuffer("".join(words[i] for i in chosen).encode("latin-1"), np.uint8)
        yield chosen, letters.reshape(len(chosen), length)
        start = stop


def hashes(words: list[str]) -> np.ndarray:
    out = np.empty(len(words), np.uint64)
    for chosen, letters in by_length(words):
        length = letters.shape[1]
        out[chosen] = finished((CODES[letters] * powers(length)[:length]).sum(axis=1, dtype=np.uint64), length)
    return out


def finished(sums: np.ndarray, length: int) -> np.ndarray:
    return scramble(sums + np.uint64(length * 0x9E3779B97F4A7C15 % (1 << 64)))


# --- filters

def build_filter(found: np.ndarray) -> np.ndarray:
    """A blocked Bloom filter of the hashes: eight 64-bit words per block."""
    blocks = max(1, -(-len(found) * BITS // 512))
    bits = np.zeros(blocks * 8, np.uint64)
    block = ((found >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    for places, mask in probes(found, block):
        np.bitwise_or.at(bits, places, mask)
    return bits


def probes(found: np.ndarray, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place and mask of each of the bits of a hash; whoever asks may stop early."""
    inner = scramble(found ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    for k in range(PROBES):
        bit = (inner >> np.uint64(9 * k)) & np.uint64(511)
        yield (block * np.uint64(8) + (bit >> np.uint64(6))).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


class Filters:
    """The filters of a round, one after the other in one array: for a length, the slices that are here."""

    def __init__(self, rows: list, slices: dict[int, int]) -> None:
        arrays, self.first, self.blocks, at = [np.zeros(0, np.uint64)], {}, {}, 0
        for r in rows:
            bits = np.frombuffer(r["bits"], np.uint64)
            first = self.first.setdefault(r["size"], np.zeros(slices[r["size"]], np.uint64))
            blocks = self.blocks.setdefault(r["size"], np.zeros(slices[r["size"]], np.uint64))
            first[r["slice"]], blocks[r["slice"]] = at // 8, len(bits) // 8
            arrays.append(bits)
            at += len(bits)
        self.bits = np.concatenate(arrays)

    def known(self, size: int, found: np.ndarray) -> np.ndarray:
        """Places of the hashes that the filters of a length class may hold."""
        if size not in self.blocks:
            return np.zeros(0, np.int64)
        first, blocks = self.first[size], self.blocks[size]
        if len(blocks) == 1:
            here = np.arange(len(found))
            block = first[0] + (((found >> np.uint64(32)) * blocks[0]) >> np.uint64(32))
        else:
            cut = (found % np.uint64(len(blocks))).astype(np.int64)
            here = np.flatnonzero(blocks[cut])
            found, cut = found[here], cut[here]
            block = first[cut] + (((found >> np.uint64(32)) * blocks[cut]) >> np.uint64(32))
        # one bit after the other, each asked only of what is left
        inner = scramble(found ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        block = block * np.uint64(8)
        for k in range(PROBES):
            bit = (inner >> np.uint64(9 * k)) & np.uint64(511)
            word = self.bits[(block + (bit >> np.uint64(6))).astype(np.int64)]
            left = np.flatnonzero((word >> (bit & np.uint64(63))) & np.uint64(1))
            here, inner, block = here[left], inner[left], block[left]
        return here


def size_class(length: int) -> int:
    return min(length, LONG)


def filter_table(words: DataFrame, slices: dict[int, int]) -> DataFrame:
    """(size, slice, bits): the filter of every shard; a shard is one group of about SHARD_WORDS hashes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = hashes(texts)
            sizes = np.array([size_class(len(t)) for t in texts], np.int32)
            count = np.array([slices[s] for s in sizes.tolist()], np.uint64)
            cut = (found % count).astype(np.int32) if len(texts) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(cut), pa.array(found.view(np.int64))], ["size", "slice", "h"])

    def build(table: pa.Table) -> pa.Table:
        bits = build_filter(table.column("h").combine_chunks().to_numpy().view(np.uint64))
        return pa.table({"size": table.column("size").slice(0, 1), "slice": table.column("slice").slice(0, 1),
                         "bits": pa.array([bits.tobytes()], pa.binary())})

    return (words.select("word").mapInArrow(hashed, "size int, slice int, h long")
            .groupBy("size", "slice").applyInArrow(build, "size int, slice int, bits binary"))


def rounds_of(slices: dict[int, int], counts: dict[int, int], limit: int) -> list[list[tuple[int, int]]]:
    """Shards (size, slice) in rounds of at most `limit` bytes of filters, one shard at least."""
    out: list[list[tuple[int, int]]] = []
    held = limit + 1
    for size in sorted(slices):
        weight = counts[size] * BITS // 8 // slices[size] + 64
        for cut in range(slices[size]):
            if held + weight > limit:
                out.append([])
                held = 0
            out[-1].append((size, cut))
            held += weight
    return out


# --- neighbourhoods

def probed(letters: np.ndarray, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[int, int, int]]:
    """(row, place, letter) of the edits that the filters know; letter -1 is a deletion."""
    rows, length = letters.shape
    power = powers(length)
    parts = CODES[letters] * power[:length]
    sums = parts.sum(axis=1, dtype=np.uint64)
    if size_class(length - 1) in filters.blocks:
        upto = np.cumsum(parts, axis=1, dtype=np.uint64)
        without = (upto - parts) + (sums[:, None] - upto) * np.uint64(INVERSE)
        first = np.ones(letters.shape, bool)  # deleting any letter of a run of one letter gives the same word
        first[:, 1:] = letters[:, 1:] != letters[:, :-1]
        row, place = np.nonzero(first)
        for i in filters.known(size_class(length - 1), finished(without[row, place], length - 1)).tolist():
            yield int(row[i]), int(place[i]), -1
    if size_class(length) in filters.blocks and len(alphabet):
        step = max(1, EDITS // (rows * len(alphabet)))
        for low in range(0, length, step):
            some = letters[:, low:low + step]
            change = (CODES[alphabet] - CODES[some][:, :, None]) * power[low:low + some.shape[1], None]
            row, place, a = np.nonzero(alphabet > some[:, :, None])
            found = finished((sums[:, None, None] + change)[row, place, a], length)
            for i in filters.known(size_class(length), found).tolist():
                yield int(row[i]), low + int(place[i]), int(alphabet[a[i]])


def candidates(words: DataFrame, limit: int = ROUND_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n, edit): edits of the words that the filters know, each pair of near words from one side."""
    spark = words.sparkSession
    size = F.least(F.length("word"), F.lit(LONG))
    counts = {r["size"]: r["n"] for r in words.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = {s: -(-n // shard_words) for s, n in counts.items()}
    shape = "word string, n long, edit string"
    if not counts:
        return spark.createDataFrame([], shape)
    known = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in known.collect()), np.uint8)  # 90 letters at most
    filters = settle(filter_table(words, slices), "spelling-filters")
    out = []
    for shards in rounds_of(slices, counts, limit):
        wanted = F.lit(False)
        for s in sorted({s for s, _ in shards}):
            cuts = [c for t, c in shards if t == s]
            wanted = wanted | ((F.col("size") == s) & F.col("slice").between(cuts[0], cuts[-1]))
        here = spark.sparkContext.broadcast(Filters(filters.filter(wanted).collect(), slices))

        def run(batches: Iterator[pa.RecordBatch], here=here) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for chosen, letters in by_length(texts):
                    word, count, edit = [], [], []
                    for row, place, letter in probed(letters, alphabet, here.value):
                        text = texts[chosen[row]]
                        word.append(text)
                        count.append(n[chosen[row]])
                        edit.append(text[:place] + (chr(letter) if letter >= 0 else "") + text[place + 1:])
                    if word:
                        yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(count, pa.int64()),
                                                          pa.array(edit, pa.string())], ["word", "n", "edit"])

        sizes = sorted({s for s, _ in shards})
        near = words.filter(size.isin(sizes) | F.least(F.length("word") - 1, F.lit(LONG)).isin(sizes))
        tasks = -(-sum(n for s, n in counts.items() if s in sizes or min(s - 1, LONG) in sizes) // TASK_WORDS)
        out.append(settle(near.select("word", "n").repartition(tasks, "word").mapInArrow(run, shape), "spelling-edits"))
        here.unpersist()
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def near_words(words: DataFrame, limit: int = ROUND_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, from both sides."""
    names = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = candidates(words, limit, shard_words).join(names, F.col("edit") == F.col("near")).select("word", "n", "near", "near_n")
    both = F.array(F.struct(F.col("word"), F.col("near"), F.col("near_n")),
                   F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last one, twice as far each round."""
    now = settle(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        following = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        after = settle(now.join(following, F.col("root") == F.col("at"), "left")
                       .select("word", F.coalesce("further", "root").alias("root"), F.col("at").isNotNull().alias("moved")), "spelling-roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO, limit: int = ROUND_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of a vocabulary (word, n)."""
    words = settle(words, "spelling-words")
    best = near_words(words, limit, shard_words).groupBy(F.col("word").alias("of")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    known = settle(known.select("word", F.col("best.near").alias("form"), "n", "n_near", (-F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(known.filter("form is not null")).withColumnRenamed("word", "of")
    return known.join(ends, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(documents: DataFrame) -> DataFrame:
    return variants(vocabulary(counted_runs(documents)))


#: CRC-32 (bits fed one by one) of a text, for engines that have none.
def crc_sql(text: str) -> str:
    bits = (f"flatten(list_transform(range(0, strlen({text})), lambda i: "
            f"[CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INT), 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))")
    step = "xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, b: {step}), 4294967295)"


SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                   '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
long_runs AS (SELECT id, run, count(*) AS c FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY id, run),
keyed AS (SELECT id || ':' || run AS key, run, c FROM long_runs),
sums AS (SELECT run, c, {crc_sql('key')} AS h FROM keyed),
edited AS (
  SELECT CASE WHEN h % {EDITED} = 0
              THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM sums),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n, length(word) AS len FROM edited WHERE length(word) >= {MIN_LENGTH}
  GROUP BY word HAVING sum(c) >= {MIN_COUNT}),
cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut
  FROM (SELECT word, n, unnest(range(0, len)) AS i FROM words)),
replaced AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word),
removed AS (SELECT DISTINCT c.word, c.n, w.word AS near, w.n AS near_n FROM cuts c JOIN words w ON c.cut = w.word),
pairs AS (
  SELECT * FROM replaced UNION ALL SELECT word, near, near_n FROM removed
  UNION ALL SELECT near, word, n FROM removed),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {RATIO} * n THEN near END AS form,
         CASE WHEN near_n >= {RATIO} * n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
up AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL SELECT u.word, u.next, f.form FROM up u JOIN forms f ON u.next = f.word WHERE u.next IS NOT NULL)
SELECT f.word, form, up.at AS root, n, n_near, form_n FROM forms f JOIN up ON f.word = up.word AND up.next IS NULL
"""
