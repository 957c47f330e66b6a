"""A Merkle tree over the rows of a dataset, kept as an append log in postorder, and proofs read from it by position.

Every row is a leaf, the digest of its fields. Per language the leaves stand in order of id; every `FANOUT` consecutive nodes
have a parent until one is left, the language's subroot, and the subroots have a tree of their own above them.

Leaves get their numbers without a window over a language: rows are sorted by ranges, a row's place in its range comes with
the sort, and only counts per (language, range) are summed. Builders are aligned: each takes `FANOUT ** LEVELS` leaves of a
tree that share an ancestor, and writes nodes in the order in which they are complete, a node right after its last child. The
position of a node in this log is known without looking: before node (level, i), whose last leaf is e - 1, stand the nodes
that e - 1 leaves complete, the sum of the sizes (e - 1) div FANOUT^m over all m, and `level` nodes that its last leaf
completes below it. So builders need not wait for each other; the nodes above the blocks are built by the same function
from the blocks' roots, a factor of 4,096 fewer each time.

A proof lists the siblings on the way to the root. Their positions follow from the leaf's number and the size of the tree.
A block's own nodes are one stretch of the log and are read once for all its leaves; the few siblings above it are looked
up among the upper nodes by position. A task holds one block's leaves, nodes and upper siblings, whatever the size of
a language. Texts are read once, hashed where they lie and never moved.

Defined cases: a null field is `-`; a null id comes before all others and is never tampered with; rows of one id are ordered by
their leaf, and equal rows stand side by side, in any order; a null language is a tree of its own and the first; a single
row is its own subroot, and root where there is no other language, with a proof of nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heronlake.llm.spelling import crc_sql
from heronlake.session import settle

FANOUT = 8
#: Levels that a builder adds to the nodes it is given.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- the shape of a tree of n leaves, in closed form

def width(n: int, level: int) -> int:
    """Nodes of a level."""
    return -(-n // FANOUT ** level)


def depth(n: int) -> int:
    """The level of the root: the first with one node."""
    level = 0
    while FANOUT ** level < n:
        level += 1
    return level


def position(n: int, level: int, i: int) -> int:
    """Place of node (level, i) in the log of its tree."""
    last = min(n, (i + 1) * FANOUT ** level) - 1
    before = 0
    while last >= 1:
        before += last
        last //= FANOUT
    return before + level


def run_of(n: int, level: int, i: int) -> range:
    """The nodes that share a parent with node (level, i), itself included."""
    first = i - i % FANOUT
    return range(first, min(first + FANOUT, width(n, level)))


def sibling_places(n: int, level: int, i: int) -> list[int]:
    """Positions of the siblings of node (level, i) and of its ancestors."""
    out = []
    for here in range(level, depth(n)):
        out += [position(n, here, j) for j in run_of(n, here, i) if j != i]
        i //= FANOUT
    return out


def complete(n: int, level: int, first: int, digests: Sequence[str], levels: int = LEVELS) -> Iterator[tuple[int, int, int, str]]:
    """(position, level, index, digest) of nodes in order of completion: the given consecutive nodes of a level, which start at a
    multiple of FANOUT ** levels, and all that they complete up to so many levels above."""
    top = min(level + levels, depth(n))
    unfinished: list[list[str]] = [[] for _ in range(levels + 1)]
    for at, text in enumerate(digests):
        here, i = level, first + at
        while True:
            yield position(n, here, i), here, i, text
            if here == top:
                break
            children = unfinished[here - level]
            children.append(text)
            if len(children) < FANOUT and i + 1 < width(n, here):
                break
            text = digest("".join(children))
            children.clear()
            here, i = here + 1, i // FANOUT


# --- leaves

def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(text if c == "text" else F.col(c)) for c in FIELDS]), 256)


def leaf_rows(documents: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, shown): the leaf of every row, and the one that a checker is shown, where every third row's text is
    in lower case."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = documents.select(*FIELDS).select("lang", "doc_id", "text", "source", "n_chars", _leaf(F.col("text")).alias("leaf"))
    return rows.select("lang", "doc_id", "leaf", F.when(tampered, _leaf(lower)).otherwise(F.col("leaf")).alias("shown"))


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Adds the 0-based number of each row inside its key, in ascending order (nulls first). Equal rows may be cut apart."""
    rows = settle(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-rows")
    by = [*keys, *order, "_row"]
    dealt = settle(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("_at", 33)
    spans = dealt.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*[F.col(k).alias(f"_{k}") for k in keys], "_part", "_first",
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = part == F.col("_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (dealt.join(spans, same).withColumn(out, (F.col("_at") - F.col("_first") + F.col("_before")).cast("long"))
            .select(*keys, *[c for c in rows.columns if c not in (*keys, "_row")], out))


# --- the log

NODE = "tree long, n long, block long, level int, idx long, pos long, digest string"
NAMES = [c.split()[0] for c in NODE.split(", ")]


def _block(levels: int) -> Column:
    return F.floor(F.col("idx") / FANOUT ** levels).cast("long").alias("block")


def _build(level: int, levels: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        tree, n, block = (table.column(c)[0].as_py() for c in ("tree", "n", "block"))
        rows = [(tree, n, block, here, i, at, text)
                for at, here, i, text in complete(n, level, block * FANOUT ** levels, table.column("digest").to_pylist(), levels)
                if here > level or not level]  # the nodes given are in the log already, but for leaves
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], NAMES)
    return run


def append_log(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The nodes (tree, n, block, level, idx, pos, digest) over leaves (tree, n, idx, digest); block is the builder's number
    among those that started on its level."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    given, level, parts = leaves, 0, []
    while True:
        blocks = given.select("tree", "n", _block(levels), "idx", "digest")
        log = settle(blocks.groupBy("tree", "block").applyInArrow(_build(level, levels), NODE), "merkle-log")
        parts.append(log)
        level += levels
        if FANOUT ** level >= largest:
            break
        given = log.filter((F.col("level") == level) & (F.col("n") > FANOUT ** level))
    log = parts[0]
    for more in parts[1:]:
        log = log.unionByName(more)
    return log


def roots(log: DataFrame) -> DataFrame:
    """(tree, root) of every tree: the last node of its log."""
    last = F.max(F.struct("pos", "digest"))
    return log.filter("level = 0 and n = 1 or level > 0").groupBy("tree").agg(last.alias("last")).select("tree", F.col("last.digest").alias("root"))


# --- proofs

def _upper_siblings(log: DataFrame, levels: int) -> DataFrame:
    """(tree, block, pos, digest): for every block of leaves the nodes that its proofs need from above it."""
    blocks = log.filter(f"level = {levels} and n > {FANOUT ** levels}").select("tree", "n", F.col("idx").alias("block"))
    above = F.udf(lambda n, i: sibling_places(n, levels, i), "array<long>")
    wanted = blocks.select("tree", "block", F.explode(above("n", "block")).alias("at"))
    upper = log.filter(f"level >= {levels}").select(F.col("tree").alias("of"), "pos", "digest")
    return wanted.join(upper, (F.col("tree") == F.col("of")) & (F.col("at") == F.col("pos"))).select("tree", "block", "pos", "digest")


def _climb(n: int, i: int, known: dict[int, str], runs: dict[tuple[int, int], list[str]]) -> Iterator[tuple[list[str], int]]:
    """Level by level the digests of the run and the place of the node in it; known: digests by position."""
    for level in range(depth(n)):
        key = (level, i // FANOUT)
        if key not in runs:
            runs[key] = [known.get(position(n, level, j), "") for j in run_of(n, level, i)]
        yield runs[key], i % FANOUT
        i //= FANOUT


PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proofs(leaves: DataFrame, log: DataFrame, top: DataFrame, trees: int, root: str, levels: int = LEVELS) -> DataFrame:
    """The proof of every leaf (tree, n, idx, doc_id, leaf, shown), folded from the leaf shown; top: log of the tree of subroots."""
    own = log.filter(f"level < {levels}").select("tree", "block", "pos", "digest")
    near = own.unionByName(_upper_siblings(log, levels)).withColumn("of_top", F.lit(False))
    # the siblings of a subroot go to every block of its tree
    subroots = roots(log)
    blocks = leaves.select("tree", _block(levels)).distinct()
    above = _top_siblings(top, trees).unionByName(subroots.select("tree", F.lit(-1).cast("long").alias("pos"), F.col("root").alias("digest")))
    far = (blocks.join(above.withColumnRenamed("tree", "of"), F.col("tree") == F.col("of"))
           .select("tree", "block", "pos", "digest", F.lit(True).alias("of_top")))

    def run(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        known: dict[int, str] = {}
        upper: dict[int, str] = {}
        for at, text, of_top in zip(*[nodes.column(c).to_pylist() for c in ("pos", "digest", "of_top")]):
            (upper if of_top else known)[at] = text
        out = []
        runs: dict[tuple[int, int], list[str]] = {}
        top_runs: dict[tuple[int, int], list[str]] = {}
        for tree, n, i, doc_id, leaf, shown in zip(*[rows.column(c).to_pylist() for c in ("tree", "n", "idx", "doc_id", "leaf", "shown")]):
            proof, now = hashlib.sha256(), shown
            for steps in (_climb(n, i, known, runs), _climb(trees, tree, upper, top_runs)):
                for run, place in steps:
                    proof.update("".join(run[:place] + run[place + 1:]).encode())
                    now = digest("".join([*run[:place], now, *run[place + 1:]]))
            out.append((doc_id, leaf, upper[-1], root, proof.hexdigest(), now, now == root))
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                        [c.split()[0] for c in PROVED.split(", ")])

    dealt = leaves.select("tree", _block(levels), "n", "idx", "doc_id", "leaf", "shown")
    return dealt.groupBy("tree", "block").cogroup(near.unionByName(far).groupBy("tree", "block")).applyInArrow(run, PROVED)


def _top_siblings(top: DataFrame, trees: int) -> DataFrame:
    """(tree, pos, digest): for every tree the siblings between its subroot and the root."""
    places = F.udf(lambda i: sibling_places(trees, 0, i), "array<long>")
    wanted = top.filter("level = 0").select(F.col("idx").alias("tree"), F.explode(places("idx")).alias("at"))
    nodes = top.select("pos", "digest")
    return wanted.join(nodes, F.col("at") == F.col("pos")).select("tree", "pos", "digest")


def manifest(documents: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame, DataFrame, int, str | None]:
    """Leaves (tree, n, idx, doc_id, leaf, shown, lang), the log of all languages' trees, the log of the tree of subroots, the
    number of languages and the root (None for no rows)."""
    rows = numbered(leaf_rows(documents), ["lang"], ["doc_id", "leaf"], "idx")
    sizes = numbered(rows.groupBy("lang").agg(F.max(F.col("idx") + 1).alias("n")), [], ["lang"], "tree")
    sizes = settle(sizes.withColumnRenamed("lang", "of"), "merkle-trees")
    leaves = settle(rows.join(sizes, F.col("lang").eqNullSafe(F.col("of"))).drop("of"), "merkle-leaves")
    log = append_log(leaves.select("tree", "n", "idx", F.col("leaf").alias("digest")), levels)
    trees = sizes.count()
    top = append_log(roots(log).select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"),
                                       F.col("tree").alias("idx"), F.col("root").alias("digest")), levels)
    last = roots(top).first()
    return leaves, log, top, trees, last["root"] if last else None


def prove(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document."""
    leaves, log, top, trees, root = manifest(documents, levels)
    if root is None:
        return documents.sparkSession.createDataFrame([], PROVED)
    return proofs(leaves, log, top, trees, root, levels)


def _field_sql(column: str, value: str | None = None) -> str:
    text = f"CAST({value or column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c, text if c == "text" else None) for c in FIELDS) + ")"


def _fold_sql(cur: str, runs: str) -> str:
    return (f"sha256(array_to_string(list_concat(list_concat({runs}[:i % {FANOUT}], [{cur}]), {runs}[i % {FANOUT} + 2:]), ''))")


_REST = f"array_to_string(list_concat(ds[:i % {FANOUT}], ds[i % {FANOUT} + 2:]), '')"
SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM (SELECT doc_id, lang, {_leaf_sql('text')} AS leaf, row_number() OVER () AS uid,
               CASE WHEN {crc_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0
                    THEN {_leaf_sql(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")}
                    ELSE {_leaf_sql('text')} END AS shown
        FROM documents)),
nodes AS (
  SELECT tree, 0 AS level, i, leaf AS d, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // {FANOUT}, sha256(string_agg(d, '' ORDER BY i)), any_value((n + {FANOUT - 1}) // {FANOUT})
  FROM nodes WHERE n > 1 GROUP BY tree, level, i // {FANOUT}),
subroots AS (SELECT tree, d FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, tree AS i, d, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // {FANOUT}, sha256(string_agg(d, '' ORDER BY i)), any_value((n + {FANOUT - 1}) // {FANOUT})
  FROM tops WHERE n > 1 GROUP BY level, i // {FANOUT}),
runs AS (SELECT tree, level, i // {FANOUT} AS run, list(d ORDER BY i) AS ds FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, i // {FANOUT} AS run, list(d ORDER BY i) AS ds FROM tops WHERE n > 1 GROUP BY ALL),
up AS (
  SELECT uid, tree, 0 AS level, i, shown AS cur, '' AS proof FROM leaves
  UNION ALL
  SELECT uid, tree, level + 1, i // {FANOUT}, {_fold_sql('cur', 'ds')}, proof || {_REST}
  FROM up JOIN runs USING (tree, level) WHERE run = i // {FANOUT}),
reached AS (SELECT uid, tree, cur, proof FROM up QUALIFY row_number() OVER (PARTITION BY uid ORDER BY level DESC) = 1),
further AS (
  SELECT uid, 0 AS level, tree AS i, cur, proof FROM reached
  UNION ALL
  SELECT uid, level + 1, i // {FANOUT}, {_fold_sql('cur', 'ds')}, proof || {_REST}
  FROM further JOIN top_runs USING (level) WHERE run = i // {FANOUT}),
ended AS (SELECT uid, cur, proof FROM further QUALIFY row_number() OVER (PARTITION BY uid ORDER BY level DESC) = 1),
root AS (SELECT d FROM tops WHERE n = 1)
SELECT doc_id, leaf, s.d AS subroot, r.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.d AS verified
FROM leaves l JOIN ended e ON l.uid = e.uid JOIN subroots s ON l.tree = s.tree CROSS JOIN root r
"""
