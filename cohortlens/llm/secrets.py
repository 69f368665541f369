"""Secret scans over an inverted trigram index.

From each rule's pattern a Boolean query over trigrams is derived: any text that matches has the trigrams of at least
one of its clauses. Texts are indexed in segments, each a run of documents within a task: a posting list for every
trigram that a rule names. Posting lists are intersected within a clause and united over clauses; only the candidates
are searched with the pattern. A pattern that names no trigram is searched for in every text.

``find_secrets`` builds, asks and drops the index of one segment after the other, so texts are read once and nothing
is shuffled. ``build_index`` keeps the index as a table, for rules that are asked again, and ``candidates`` asks it.
"""

from __future__ import annotations

import re
import re._constants as op
import re._parser as regex_tree
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import whole_text

SEGMENT_DOCS = 1024
SEGMENT_BYTES = 8 << 20  # of text in a segment, unless a single text is longer
MAX_STRINGS = 64  # alternatives followed through a pattern before it is cut into parts

# The patterns and least lengths of the three base kinds.
BASE_PATTERNS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
# Public formats of other secrets.
MORE_PATTERNS = (
    ("github", r"gh[opsur]_[A-Za-z0-9]+", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)


@dataclass(frozen=True)
class Rule:
    """Matches whose group has ``least`` characters or more; ``base`` is False for kinds added to the base ones."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True

    @cached_property
    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)

    @cached_property
    def clauses(self) -> list[frozenset[bytes]] | None:
        return trigram_query(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost non-overlapping matches; those too short are dropped afterwards."""
        return [m.span() for m in self.compiled.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


RULES = (*(Rule(*r) for r in BASE_PATTERNS), *(Rule(*r, base=False) for r in MORE_PATTERNS))

# --- from a pattern to a query: a list of clauses, or None where any text may match ---------------


def trigram_query(pattern: str) -> list[frozenset[bytes]] | None:
    """Clauses of lower-case trigrams, of which a matching text has all of at least one."""
    strings, query = walk(regex_tree.parse(pattern))
    return either_or_both(query, query_of(strings))


def query_of(strings: set[str]) -> list[frozenset[bytes]] | None:
    """What texts with one of the strings have; None if one is too short to say."""
    if any(len(s.encode()) < 3 for s in strings):
        return None
    return [frozenset(b[i : i + 3] for i in range(len(b) - 2)) for b in (s.encode() for s in sorted(strings))]


def either_or_both(one: list | None, other: list | None) -> list | None:
    """Both queries hold; the one with fewer clauses suffices where their product is long."""
    if one is None or other is None:
        return one if other is None else other
    if len(one) * len(other) > MAX_STRINGS:
        return min(one, other, key=len)
    return [a | b for a in one for b in other]


def walk(nodes) -> tuple[set[str], list | None]:
    """The strings in which a match of the nodes can end as a whole since the last cut, and the query so far."""
    strings, query = {""}, None
    for node, given in nodes:
        exact, inner = node_strings(node, given)
        if exact is not None and len(exact) * len(strings) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in exact}
            continue
        query = either_or_both(either_or_both(query, query_of(strings)), inner)
        if exact is not None:
            query = either_or_both(query, query_of(exact))
        strings = {""}
    return strings, query


def node_strings(node, given) -> tuple[set[str] | None, list | None]:
    """All strings that a node matches, in lower case, or None and the query of what it matches."""
    if node is op.LITERAL:
        return {chr(given).lower()}, None
    if node is op.IN and len(given) <= 8 and all(kind is op.LITERAL for kind, _ in given):
        return {chr(c).lower() for _, c in given}, None
    if node is op.AT:
        return {""}, None
    if node is op.SUBPATTERN:
        return part_strings(given[-1])
    if node is op.BRANCH:
        parts = [part_strings(branch) for branch in given[1]]
        if all(exact is not None for exact, _ in parts):
            union = set().union(*(exact for exact, _ in parts))
            return (union, None) if len(union) <= MAX_STRINGS else (None, query_of(union))
        queries = [inner if exact is None else query_of(exact) for exact, inner in parts]
        return None, None if None in queries else sum(queries, [])
    if node in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, body = given
        exact, inner = part_strings(body)
        if exact is not None and most == 1:
            return (exact | {""} if least == 0 else exact), None
        if exact is not None and least == most and len(exact) ** least <= MAX_STRINGS:
            return reduce(lambda a, b: {x + y for x in a for y in b}, [exact] * least, {""}), None
        return None, None if least == 0 else inner if exact is None else query_of(exact)
    return None, None  # any other node says nothing about the text


def part_strings(nodes) -> tuple[set[str] | None, list | None]:
    strings, query = walk(nodes)
    cut = query is not None or any(node_strings(*n)[0] is None for n in nodes)
    return (None, either_or_both(query, query_of(strings))) if cut else (strings, None)


# --- the index of a segment -------------------------------------------------------------------------


class Trigrams:
    """Finds where the trigrams that rules name occur in a run of texts."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.names = sorted({t for rule in rules for clause in rule.clauses or () for t in clause})
        self.number = np.full(1 << 24, -1, np.int16)
        for i, t in enumerate(self.names):
            self.number[t[0] << 16 | t[1] << 8 | t[2]] = i
        self.lower = np.arange(256, dtype=np.uint32)
        self.lower[65:91] += 32

    def postings(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        """Trigram -> the places in ``texts`` of those that have it, in order."""
        run = self.lower[np.frombuffer(b"\0".join(texts), np.uint8)]  # no rule's trigram has a null character
        if len(run) < 3:
            return {}
        found = self.number[run[:-2] << 16 | run[1:-1] << 8 | run[2:]]
        at = np.flatnonzero(found >= 0)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        docs = np.searchsorted(starts, at, side="right") - 1
        pairs = np.unique(found[at].astype(np.int64) * len(texts) + docs)
        numbers, docs = np.divmod(pairs, len(texts))
        cuts = np.searchsorted(numbers, np.arange(len(self.names) + 1))
        return {t: docs[cuts[i] : cuts[i + 1]] for i, t in enumerate(self.names) if cuts[i] < cuts[i + 1]}


NONE = np.empty(0, np.int64)


def matching(clauses: list[frozenset[bytes]] | None, index: dict[bytes, np.ndarray], docs: int) -> np.ndarray:
    """Places of the texts that satisfy a query."""
    if clauses is None:
        return np.arange(docs)
    found = []
    for clause in clauses:
        lists = sorted((index.get(t, NONE) for t in clause), key=len)
        found.append(reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), lists))
    return reduce(np.union1d, found, NONE)


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Runs of doc_ids and texts of a bounded size."""
    for batch in batches:
        texts, at, size = batch.column("text").to_pylist(), 0, 0
        for i, text in enumerate(texts, 1):
            size += len(text)
            if i == len(texts) or i - at >= SEGMENT_DOCS or size >= SEGMENT_BYTES:
                yield batch.column("doc_id").slice(at, i - at), texts[at:i]
                at, size = i, 0


def utf8(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.encode(whole_text(), "UTF-8").alias("text"))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row for each row of docs: doc_id, found (kind, start, end in code points, end exclusive, base), sorted by start,
    then in the order of the rules.

    A null or empty text has none; rows that repeat each get theirs; no rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, found array<struct<kind: string, start: bigint, `end`: bigint, base: boolean>>"
    found_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams = Trigrams(rules)
        for doc_ids, texts in segments(batches):
            index = trigrams.postings(texts)
            found: list[list[tuple]] = [[] for _ in texts]
            decoded: dict[int, str] = {}
            for order, rule in enumerate(rules):
                for place in matching(rule.clauses, index, len(texts)).tolist():
                    if place not in decoded:
                        decoded[place] = texts[place].decode()
                    found[place] += [(start, order, end) for start, end in rule.spans(decoded[place])]
            rows = [
                [
                    {"kind": rules[o].kind, "start": start, "end": end, "base": rules[o].base}
                    for start, o, end in sorted(spans)
                ]
                for spans in found
            ]
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(rows, found_type)], ["doc_id", "found"])

    return utf8(docs).mapInArrow(work, schema)


# --- the index as a table ---------------------------------------------------------------------------


def build_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of trigram (binary) and doc_ids (the documents of one segment that have it), for the rules' trigrams."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams = Trigrams(rules)
        for doc_ids, texts in segments(batches):
            index = trigrams.postings(texts)
            lists = [doc_ids.take(pa.array(places)) for places in index.values()]
            ends = pa.array(np.cumsum([0] + [len(x) for x in lists]), pa.int32())
            flat = pa.concat_arrays(lists) if lists else doc_ids.slice(0, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(index), pa.binary()), pa.ListArray.from_arrays(ends, flat)], ["trigram", "doc_ids"]
            )

    return utf8(docs).mapInArrow(work, f"trigram binary, doc_ids array<{kind}>")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(kind, doc_id) of the documents that satisfy a rule's query, for the rules that have one."""
    named = [
        (rule.kind, number, len(clause), bytearray(trigram))
        for rule in rules
        for number, clause in enumerate(rule.clauses or ())
        for trigram in clause
    ]
    wanted = index.sparkSession.createDataFrame(named, "kind string, clause int, needed int, trigram binary")
    return (
        index.join(F.broadcast(wanted), "trigram")  # as many rows as the patterns have trigrams
        .select("kind", "clause", "needed", F.explode("doc_ids").alias("doc_id"))
        .groupBy("kind", "clause", "needed", "doc_id")
        .agg(F.count(F.lit(1)).alias("present"))
        .where("present >= needed")
        .select("kind", "doc_id")
        .distinct()
    )
