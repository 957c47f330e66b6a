"""Secrets in texts, all rules in one pass over the bytes.

The rules' regular expressions become one minimal deterministic automaton (`automaton`), built once per call on the driver
from the rules alone and shipped as arrays. A task joins the texts of a batch, about a megabyte at a time, by line feeds,
which no rule may contain, and cuts the bytes into pieces that numpy moves through the automaton side by side, one byte of
every piece per step. A piece begins in the start state; where the piece before it ended elsewhere, its first bytes are
walked again until both walks meet. Every byte's state says which rules' matches end there. From each end of a match the
rule's reversed automaton walks back and finds its starts; leftmost matches that do not overlap stay, per rule.

Rules end in a run of one class or in literal bytes, so a match ends where its rule's bit goes out. `group` and `least` ask
a matched group for a number of characters after the matches are settled: a match that fails is dropped, not replaced. (A
count inside the automaton costs a state for every set of counts at hand; only runs that cannot begin inside themselves,
such as hex digits, are counted there. States multiply over rules whose texts may overlap, so rules are few.)

Nothing is shuffled, and a task holds one batch of texts and the arrays of about a megabyte of them; a longer text is read
in windows that hand on their state. Defined cases: null and empty text have no spans; rows with a null id, one id or equal
texts are scanned one by one; an empty table gives no rows; all other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.automaton import Automaton, Positions, determinize, parse
from heronlake.llm.common import groups, strings


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    ignore_case: bool = False
    #: this group of a match (0: all of it) has at least so many characters
    group: int = 0
    least: int = 0


# The kinds and patterns of the base rules.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),  # a run of 16 or more; its shorter runs would fail anyway
)
#: Public token formats beyond the base.
FORMATS = (
    Rule("github", r"gh[opsur]_[0-9A-Za-z]+", least=40),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]+", least=15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", least=39),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)
RULES = BASE + FORMATS
#: Pieces walked side by side, and bytes of a piece.
PIECES, PIECE = 2_048, 512
JOINT = b"\n"


class Scanner:
    """The automata of some rules, ready to scan."""

    def __init__(self, rules: Sequence[Rule] = RULES) -> None:
        if not 0 < len(rules) <= 16:
            raise ValueError("1 to 16 rules")
        self.rules = list(rules)
        forward = [Positions(_searched(r)) for r in rules]
        if any(p.nullable or any(JOINT[0] in s for s in p.sets) for p in forward):
            raise ValueError("a rule must not match nothing or a line feed")
        self.forward: Automaton = determinize(forward, restart=True)
        backward = [determinize([p.reverse()], restart=False) for p in forward]
        self.back = [(a.table[:, a.classes].tolist(), a.accepts.astype(bool).tolist(), a.dead) for a in backward]
        self.exact = [re.compile(r.pattern.encode(), re.IGNORECASE if r.ignore_case else 0) for r in rules]
        width = self.forward.table.shape[1]
        # states are kept as offsets of their rows
        self.steps = (self.forward.table * width).ravel()
        self.bits = np.repeat(self.forward.accepts, width)
        self.rows = (self.forward.table[:, self.forward.classes] * width).tolist()
        self.width = width

    def walk(self, body: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """The accepting bits after every byte, and the last state."""
        pieces = min(PIECES, max(1, len(body) // 64))
        length = -(-len(body) // pieces)
        pieces = -(-len(body) // length)
        columns = np.zeros(pieces * length, np.uint8)
        columns[:len(body)] = self.forward.classes[body]
        columns = np.ascontiguousarray(columns.reshape(pieces, length).T)
        states = np.empty((length, pieces), np.int32)
        now = np.zeros(pieces, np.int64)
        now[0] = state
        for j in range(length):
            np.add(now, columns[j], out=now)
            now = self.steps.take(now)
            states[j] = now
        for k in range(1, pieces):
            at = int(states[-1, k - 1])
            if not at:
                continue
            for j, b in enumerate(body[k * length:(k + 1) * length].tolist()):
                at = self.rows[at // self.width][b]
                if at == states[j, k]:
                    break
                states[j, k] = at
        flat = states.T.reshape(-1)[:len(body)]
        return self.bits.take(flat), int(flat[-1])

    def ends(self, body: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place of the last byte, bits of the rules) of all matches that cannot go on."""
        size = PIECES * PIECE
        state, held = 0, np.zeros(1, np.uint16)
        for start in range(0, len(body), size):
            bits, state = self.walk(body[start:start + size], state)
            joined = np.concatenate([held, bits])  # the last byte of the window before comes first
            places = np.flatnonzero(joined[:-1])
            out = joined[places] & ~joined[places + 1]
            for i in np.flatnonzero(out).tolist():
                yield start - 1 + int(places[i]), int(out[i])
            held = bits[-1:]
        if held[0]:
            yield len(body) - 1, int(held[0])

    def spans(self, body: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes: leftmost matches that do not overlap, per rule, in order of start."""
        found: list[list[tuple[int, int]]] = [[] for _ in self.rules]
        for last, bits in self.ends(np.frombuffer(body, np.uint8)):
            for r, (rows, accepts, dead) in enumerate(self.back):
                if not bits >> r & 1:
                    continue
                state = 0
                for q in range(last, -1, -1):
                    state = rows[state][body[q]]
                    if state == dead:
                        break
                    if accepts[state]:
                        found[r].append((q, -last - 1))
        out = []
        for r, (rule, matches) in enumerate(zip(self.rules, found)):
            free = 0
            for start, minus in sorted(matches):
                if start < free:
                    continue
                free = -minus
                if rule.least and (m := self.exact[r].fullmatch(body, start, free)) is not None:
                    low, high = m.span(rule.group)
                    if high - low < rule.least:
                        continue
                out.append((start, r, free))
        return sorted(out)

    def texts(self, texts: Sequence[str]) -> list[list[tuple[str, int, int]]]:
        """Spans (kind, start, end) in code points of each text."""
        bodies = [t.encode("utf-8", "surrogatepass") for t in texts]
        starts = np.cumsum([0] + [len(b) + 1 for b in bodies]).tolist()
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        points: np.ndarray | None = None
        held = -1
        for start, r, end in self.spans(JOINT.join(bodies)) if bodies else ():
            i = bisect_right(starts, start) - 1
            low, high = start - starts[i], end - starts[i]
            if len(texts[i]) != len(bodies[i]):
                if held != i:  # code points before each byte
                    first = (np.frombuffer(bodies[i], np.uint8) & 0xC0) != 0x80
                    points, held = np.concatenate([[0], np.cumsum(first)]), i
                low, high = int(points[low]), int(points[high])
            out[i].append((self.rules[r].kind, low, high))
        return out


def _searched(rule: Rule) -> tuple:
    return parse(rule.pattern, rule.ignore_case)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id and spans (array of kind, start, end in code points, end exclusive; by start, then rule) of every document."""
    scanner = Scanner(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch.column(1))
            for part in groups(texts):
                spans = [[dict(zip(("kind", "start", "end"), s)) for s in row] for row in scanner.texts(texts[part])]
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(spans, pa.list_(SPAN))], ["doc_id", "spans"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def digest(found: DataFrame, base: Sequence[Rule] = BASE) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as one text."""
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = [r.kind for r in base]
    return found.select(
        "doc_id",
        *[number(k) for k in kinds],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))


def _kind_sql(place: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    if rule.ignore_case:
        pattern = f"(?i){pattern}"
    size = f"list_transform(regexp_extract_all(t, '{pattern}', {rule.group}), lambda x: length(x))"
    gaps = f"list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x))"
    whole = f"list_transform(regexp_extract_all(t, '{pattern}'), lambda x: length(x))"
    return (f"SELECT doc_id, uid, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least, "
            f"unnest({gaps}[:-2]) AS gap, unnest({whole}) AS len, unnest({size}) AS held, generate_subscripts({whole}, 1) AS no FROM texts")


SQL = """
WITH texts AS (SELECT doc_id, row_number() OVER () AS uid, coalesce(text, '') AS t FROM documents),
matches AS (""" + "\nUNION ALL ".join(_kind_sql(i, r) for i, r in enumerate(RULES)) + """),
placed AS (
  SELECT *, sum(gap + len) OVER (PARTITION BY uid, place ORDER BY no) AS stop FROM matches),
spans AS (
  SELECT uid, place, kind, stop - len AS start, kind || ':' || CAST(stop - len AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span
  FROM placed WHERE held >= least),
per AS (
  SELECT uid, count(*) FILTER (WHERE place = 0) AS n_assign, count(*) FILTER (WHERE place = 1) AS n_access,
         count(*) FILTER (WHERE place = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, place) FILTER (WHERE place < 3) AS base,
         string_agg(span, ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY uid)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN per USING (uid)
"""
