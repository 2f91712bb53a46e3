"""Secrets in texts, found by one automaton for all rules (``automaton.py``).

A rule is a regex over bytes and a least length. The combined automaton marks where some rule ends;
only the segments around those places are walked again, by the rule's own automaton from each place
on, which gives the leftmost, longest, non-overlapping matches. A match that is too short is dropped
and not tried again.

Kinds: ``assign, access, hex`` (the base) and ``github, pem``. For ``hex`` the length
stands in the rule, since every shorter run would end it; runs are maximal either way.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crawlframe.llm.automaton import Automaton
from crawlframe.llm.common import map_arrow

# Kind, rule, group whose length counts, least length.
RULES = [
    ("assign", rb"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8),
    ("access", rb"AKIA[A-Z0-9]+", 0, 16),
    ("hex", rb"[0-9a-f]{32,}", 0, 32),
    ("github", rb"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
]
BASE = 3
#: Bytes scanned together; texts are whole, a longer one is scanned alone.
CHUNK = 8_000_000


def compiled_rules() -> tuple[Automaton, list[Automaton]]:
    """The combined automaton and each rule's own; a query builds them once, on the driver."""
    return Automaton([rule for _, rule, _, _ in RULES]), [Automaton([rule], anywhere=False) for _, rule, _, _ in RULES]


def _matches(kind: int, data: bytes, start: int, stop: int, own: Automaton) -> list[tuple[int, int]]:
    _, rule, group, least = RULES[kind]
    found, at = [], start
    first = own.table[0] != own.dead
    while at < stop:
        end = own.longest(data, at, stop) if first[data[at]] else -1
        if end < 0:
            at += 1
            continue
        size = len(re.fullmatch(rule, data[at:end])[group]) if group else end - at
        if size >= least:
            found.append((at, end))
        at = end
    return found


def find_secrets(texts: list[str | None], rules: tuple[Automaton, list[Automaton]]) -> list[list[tuple[int, int, int]]]:
    """``(start, kind, end)`` of the secrets of each text, in order, in code points."""
    combined, own = rules
    out: list[list] = [[] for _ in texts]
    encoded = [(t or "").encode("utf-8", "replace") for t in texts]
    at = 0
    while at < len(encoded):
        stop, size = at, 0
        while stop < len(encoded) and (stop == at or size + len(encoded[stop]) <= CHUNK):
            size += len(encoded[stop]) + 1
            stop += 1
        # A line feed resets every rule, so texts joined by it stay apart.
        joined = b"\n".join(encoded[at:stop]) + b"\n"
        _scan_joined(joined, np.cumsum([0, *(len(e) + 1 for e in encoded[at:stop])]), out, at, combined, own)
        at = stop
    return [sorted(spans) for spans in out]


def _scan_joined(joined: bytes, begins: np.ndarray, out: list[list], first: int, combined: Automaton, own: list[Automaton]) -> None:
    data = np.frombuffer(joined, np.uint8)
    ends, masks = combined.scan(data)
    if not len(ends):
        return
    cuts = np.flatnonzero(combined.resets[data])
    segment = np.searchsorted(cuts, ends - 1)
    letter = (data & 0xC0) != 0x80
    for seg in np.unique(segment):
        mask = int(np.bitwise_or.reduce(masks[np.searchsorted(segment, seg) : np.searchsorted(segment, seg, "right")]))
        lo, hi = int(cuts[seg - 1]) + 1 if seg else 0, int(cuts[seg])
        doc = int(np.searchsorted(begins, lo, "right")) - 1
        begin = int(begins[doc])
        for kind in range(len(RULES)):
            if mask >> kind & 1:
                for a, b in _matches(kind, joined, lo, hi, own[kind]):
                    out[first + doc].append((int(letter[begin:a].sum()), kind, int(letter[begin:b].sum())))


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, a row for each row of ``docs``.

    Null texts count as empty: no spans, the digest of no bytes. Repeated rows each count; an empty table
    gives no rows; other columns are not read.
    """
    names = [k for k, *_ in RULES]
    # Its size follows the rules alone.
    rules = docs.sparkSession.sparkContext.broadcast(compiled_rules())

    def find(rows: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for doc_id, spans in zip(rows["doc_id"], find_secrets(rows["text"], rules.value), strict=True):
            said = [(f"{names[k]}:{a}:{b}", k) for a, k, b in spans]
            out["doc_id"].append(doc_id)
            for k in range(BASE):
                out[f"n_{names[k]}"].append(sum(kind == k for _, kind in said))
            out["base_sha256"].append(hashlib.sha256(",".join(s for s, k in said if k < BASE).encode()).hexdigest())
            out["spans"].append(",".join(s for s, _ in said))
        return out

    columns = {"doc_id": pa.int64(), "n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(), "spans": pa.string()}
    return map_arrow(docs.select("doc_id", "text"), find, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", columns)
