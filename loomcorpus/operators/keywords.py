"""Keyword rules by an Aho-Corasick automaton in arrays, scanned over Arrow batches.

All keywords are one trie over the bytes of UTF-8 with suffix links; a text is read once, whatever their number. The
states are numbered by depth: the shallow ones, in which a scan is nearly always, have a full row of transitions, the
deeper ones only their edges, in a hash table. A batch of texts is cut into pieces that overlap by the longest
keyword, and all pieces take their next byte together, so each step of the scan is a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType

#: Bytes of keywords in one automaton; longer lists are dealt into several, each of which scans the texts.
MAX_BYTES = 8 << 20
#: Rules whose values are broadcast at most; more are joined by a shuffle.
MAX_SENT = 500_000
#: States with a full row of transitions.
DENSE = 4096
#: Bytes of a piece of text, without the overlap.
PIECE = 512
_MIX = 0x9E3779B97F4A7C15


class Automaton:
    """Finds every keyword of a list in texts; keywords are known by their place in it."""

    def __init__(self, keywords: list[bytes]) -> None:
        if any(not k for k in keywords):
            raise ValueError("a keyword must not be empty")
        self.longest = max(map(len, keywords), default=0)
        nodes: list[dict[int, int]] = [{}]
        ends: dict[int, list[int]] = {}
        for place, word in enumerate(keywords):
            at = 0
            for byte in word:
                if byte not in nodes[at]:
                    nodes[at][byte] = len(nodes)
                    nodes.append({})
                at = nodes[at][byte]
            ends.setdefault(at, []).append(place)
        # Breadth first, so that a state's number rises with its depth.
        order, depth = [0], [0]
        for at in order:
            order.extend(nodes[at].values())
        number = np.empty(len(nodes), np.int64)
        number[order] = np.arange(len(nodes))
        self.states = len(nodes)
        self.fail = np.zeros(self.states, np.int32)
        #: The next state on the way of suffix links that ends a keyword, 0 for none.
        self.shorter = np.zeros(self.states, np.int32)
        self.ending = np.zeros(self.states, bool)
        self.words: dict[int, list[int]] = {int(number[at]): places for at, places in ends.items()}
        self.ending[list(self.words)] = True
        edges = [sorted((byte, int(number[child])) for byte, child in nodes[at].items()) for at in order]
        dense = min(DENSE, self.states)
        self.dense = np.zeros((dense, 256), np.int32)
        known = [dict(e) for e in edges]
        del nodes, depth
        for state in range(self.states):
            if state < dense:
                if state:
                    self.dense[state] = self.dense[self.fail[state]]
                for byte, child in edges[state]:
                    self.dense[state, byte] = child
            for byte, child in edges[state]:
                if state:
                    back = int(self.fail[state])
                    while back >= dense and byte not in known[back]:
                        back = int(self.fail[back])
                    self.fail[child] = known[back].get(byte, 0) if back >= dense else self.dense[back, byte]
                link = int(self.fail[child])
                self.shorter[child] = link if self.ending[link] else self.shorter[link]
        deep = [(state << 8 | byte, child) for state in range(dense, self.states) for byte, child in edges[state]]
        size = 1 << max(4, (2 * len(deep)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.children = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        if deep:
            keys, children = (np.array(x, np.int64) for x in zip(*deep, strict=True))
            slots = self._slot(keys)
            while len(keys):  # open addressing: those that find their slot taken try the next
                free = self.keys[slots] < 0
                taken, first = np.unique(slots[free], return_index=True)
                self.keys[taken], self.children[taken] = keys[free][first], children[free][first]
                left = np.ones(len(keys), bool)
                left[np.flatnonzero(free)[first]] = False
                keys, children, slots = keys[left], children[left], (slots[left] + 1) & int(self.mask)

    @property
    def bytes(self) -> int:
        """What is sent to the tasks."""
        return sum(x.nbytes for x in (self.fail, self.shorter, self.ending, self.dense, self.keys, self.children)) + 16 * len(self.words)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(_MIX)
        return ((x ^ (x >> np.uint64(29))) & self.mask).astype(np.int64)

    def _step(self, states: np.ndarray, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(states), np.int32)
        shallow = states < len(self.dense)
        out[shallow] = self.dense[states[shallow], data[shallow]]
        todo = np.flatnonzero(~shallow)
        at = states[todo].astype(np.int64)
        while len(todo):
            keys = at << 8 | data[todo]
            slots, place = self._slot(keys), np.arange(len(keys))
            child = np.full(len(keys), -1, np.int64)
            while len(place):
                held = self.keys[slots[place]]
                hit = held == keys[place]
                child[place[hit]] = self.children[slots[place[hit]]]
                place = place[~hit & (held >= 0)]
                slots[place] = (slots[place] + 1) & int(self.mask)
            met = child >= 0
            out[todo[met]] = child[met]
            todo, at = todo[~met], self.fail[at[~met]].astype(np.int64)
            shallow = at < len(self.dense)
            out[todo[shallow]] = self.dense[at[shallow], data[todo[shallow]]]
            todo, at = todo[~shallow], at[~shallow]
        return out

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(row, state)`` pairs, each once, of the states in which a keyword ends."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if len(texts) and texts.buffers()[2] else np.empty(0, np.uint8)
        sizes = np.diff(offsets)
        pieces = -(-sizes // PIECE)
        rows = np.repeat(np.arange(len(sizes)), pieces)
        first = np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = (np.arange(len(rows)) - first) * PIECE
        end = np.minimum(sizes[rows], begin + PIECE + max(0, self.longest - 1))
        length = end - begin
        order = np.argsort(-length, kind="stable")
        rows, at, length = rows[order], (offsets[rows] + begin)[order], length[order]
        state, found = np.zeros(len(rows), np.int32), []
        for k in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -k, "left"))  # pieces longer than k
            state[:n] = self._step(state[:n], data[at[:n] + k])
            hit = np.flatnonzero(self.ending[state[:n]] | (self.shorter[state[:n]] > 0))
            if len(hit):
                found.append(rows[hit] << 32 | state[hit])
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int64)

    def places(self, state: int) -> list[int]:
        """The keywords that end in a state."""
        out = []
        while state:
            out.extend(self.words.get(state, ()))
            state = int(self.shorter[state])
        return out


def _dealt(rules: list) -> list[list]:
    """The rules in lists of at most ``MAX_BYTES`` of keywords."""
    out: list[list] = [[]]
    size = 0
    for r in rules:
        n = len(r.keyword.encode())
        if out[-1] and size + n > MAX_BYTES:
            out.append([])
            size = 0
        out[-1].append(r)
        size += n
    return [x for x in out if x]


def _found(rows: DataFrame, rules: DataFrame, text: str, lower: bool, least: bool) -> DataFrame:
    """``(row, rules)``: each row as a struct with the sorted numbers of the rules that occur in its text, or the least one.
    The rows are only mapped, once for each automaton."""
    spark = rows.sparkSession
    known = rules.select("rule_no", "keyword").where("rule_no is not null and keyword is not null").distinct()
    number = ArrayType(known.schema["rule_no"].dataType)
    kind = to_arrow_type(number)
    low = F.lower(F.col(f"`{text}`")) if lower else F.col(f"`{text}`")
    # An empty keyword is in every text.
    always = sorted(r.rule_no for r in known.where("keyword = ''").select("rule_no").distinct().collect())
    start = F.when(low.isNotNull(), F.array(*[F.lit(n) for n in always])).otherwise(F.array())
    out = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), low.alias("low"), start.cast(number).alias("rules"))
    for part in _dealt(known.where("keyword <> ''").orderBy("rule_no", "keyword").collect()):
        sent = spark.sparkContext.broadcast((Automaton([r.keyword.encode() for r in part]), [r.rule_no for r in part]))

        def scanned(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            automaton, numbers = sent.value
            listed: dict[int, list] = {}
            for batch in batches:
                own, states = automaton.scan(batch.column("low").fill_null(""))
                met = batch.column("rules").to_pylist()
                for row, state in zip(own.tolist(), states.tolist(), strict=True):
                    if state not in listed:
                        listed[state] = [numbers[p] for p in automaton.places(state)]
                    met[row].extend(listed[state])
                met = [[min(m)] if m and least else sorted(set(m)) for m in met]
                yield pa.record_batch([batch.column("row"), batch.column("low"), pa.array(met, kind)], names=["row", "low", "rules"])

        out = out.mapInArrow(scanned, out.schema)
    return out.select("row", F.array_min("rules").alias("rule_no") if least else "rules")


def matches(rows: DataFrame, rules: DataFrame, text: str, lower: bool = True) -> DataFrame:
    """All columns of ``rows`` with ``rules``, the sorted numbers of the rules (rule_no, keyword) that occur in the text (in
    place of a column of this name).

    Texts are lower-cased (unless ``lower`` is false), keywords are taken as they are. A null text has no matches;
    a rule without a keyword or number has none either, and an empty keyword occurs in every text. The rules go to
    the driver, ``MAX_BYTES`` of keywords to an automaton, which is sent to the tasks as one broadcast.
    """
    return _found(rows, rules, text, lower, False).select(*[F.col(f"row.`{c}`") for c in rows.columns if c != "rules"], "rules")


def first_rule(rows: DataFrame, rules: DataFrame, text: str, value: str = "value") -> DataFrame:
    """All columns of ``rows`` with ``value``, that of the least-numbered rule whose keyword the text contains, whatever its case; else null.

    ``rules`` are (rule_no, keyword, value); of rules of one number the greatest value counts.
    """
    found = _found(rows, rules, text, True, True)
    values = rules.where("rule_no is not null").groupBy("rule_no").agg(F.max("value").alias("_value"))
    few = values.limit(MAX_SENT + 1).count() <= MAX_SENT
    out = found.join(F.broadcast(values) if few else values, "rule_no", "left")
    return out.select(*[F.col(f"row.`{c}`") for c in rows.columns if c != value], F.col("_value").alias(value))
