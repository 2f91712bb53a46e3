"""SentencePiece encoding by sampling from the piece lattice, and lossless decoding.

The vocabulary is that of a SentencePiece model file; its path is a parameter. A text gets a blank in
front, blanks become the marker, and the lattice of all ways to cover it with pieces is summed from
the left (forward filtering); a segmentation is then drawn from the right in proportion to its
weight (backward sampling). A character without a piece of its own, and the marker where the text
itself has it, becomes bytes, so decoding gives back every text exactly.

Pieces never reach over the start of a word (marker after another character), so the lattice falls
into one part per word. The forward pass runs once for each distinct word of a batch; drawing goes
over all words of the batch at once, one piece per round, each word at its own place.

Random numbers are a hash of seed, row key, place of the word and round. They do not depend on
partitions, batches or retries: the same key and text always give the same pieces.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from crawlframe.llm.common import map_arrow

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Words: blanks and what follows them, or blanks at the end.
WORD = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
#: Characters of text drawn together; a longer text is drawn alone.
CHUNK = 500_000
#: A character written as bytes weighs this much less than the lightest piece (natural logarithm).
BYTE_PENALTY = 10.0
#: Shares of a node's arcs are whole parts of this.
UNIT = 1 << 40
#: Stands for a marker in the text itself; no piece has it. Unpaired surrogates never occur in a table's texts.
OWN_MARK = "\udc00"


class Vocabulary:
    """Pieces of a model with log weights.

    A unigram model's scores are log weights; those of a merge model are ranks, whose weight is taken
    as 1 / (rank + 1), the usual decay of frequencies.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.byte_ids) < 256:
            raise ValueError("lossless decoding needs a model with byte pieces")
        scores = {i: model.get_score(i) for i in plain}
        if min(scores.values()) < -1000:
            scores = {i: -float(np.log1p(-s)) for i, s in scores.items()}
        self.scores = np.zeros(size)
        self.scores[list(scores)] = list(scores.values())
        self.lightest = min(scores.values())
        self._tree({self.pieces[i]: i for i in plain})
        crossing = [self.pieces[i] for i in plain if MARK in self.pieces[i].lstrip(MARK)]
        if crossing:
            raise ValueError("pieces reach over word starts")

    def _tree(self, pieces: dict[str, int]) -> None:
        """The pieces as a tree: from the root by character, further down by the class of a character.

        Characters never found inside a piece share class 0, which leads nowhere (-1).
        """
        inner = sorted({c for p in pieces for c in p[1:]})
        self.kind = np.zeros(0x110000, np.int16)
        self.kind[[ord(c) for c in inner]] = np.arange(1, len(inner) + 1)
        prefixes = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)})
        number = {p: k for k, p in enumerate(prefixes)}
        self.root = np.full(0x110000, -1, np.int32)
        self.next = np.full((len(prefixes), len(inner) + 1), -1, np.int32)
        for p, k in number.items():
            if len(p) == 1:
                self.root[ord(p)] = k
            else:
                self.next[number[p[:-1]], self.kind[ord(p[-1])]] = k
        self.piece_at = np.array([pieces.get(p, -1) for p in prefixes], np.int64)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices:
    """Forward-filtered lattices of distinct words.

    A word has a node for each place after one of its characters; ``last[w]`` is the node of its end.
    The arcs into a node stand together, with cumulative shares that end at UNIT, the piece of each
    (-1: bytes) and the character where it starts.
    """

    def __init__(self, words: list[str], vocab: Vocabulary, alpha: float) -> None:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        stops = np.repeat(np.cumsum(sizes), sizes)
        self.first = np.cumsum(sizes) - sizes
        self.last = self.first + sizes - 1
        local = np.arange(len(chars)) - np.repeat(self.first, sizes)
        starts, nodes, pieces = self._arcs(chars, stops, vocab)
        single = np.zeros(len(chars), bool)
        single[starts[starts == nodes]] = True
        spelled = np.flatnonzero(~single)
        starts, nodes = np.concatenate([starts, spelled]), np.concatenate([nodes, spelled])
        pieces = np.concatenate([pieces, np.full(len(spelled), -1)])
        scores = alpha * np.where(pieces < 0, vocab.lightest - BYTE_PENALTY, vocab.scores[pieces])
        # Arcs by how far into its word they end, so that each step needs only earlier ones; longest first.
        order = np.argsort(local[nodes] * len(chars) + nodes, kind="stable")
        starts, nodes, scores = starts[order], nodes[order], scores[order]
        forward, entries = np.zeros(len(chars)), np.empty(len(nodes), np.int64)
        depth = np.searchsorted(local[nodes], np.arange(int(sizes.max()) + 1))
        for lo, hi in zip(depth[:-1].tolist(), depth[1:].tolist(), strict=True):
            here, begin = nodes[lo:hi], starts[lo:hi]
            weight = scores[lo:hi] + np.where(local[begin] > 0, forward[begin - 1], 0.0)
            heads = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
            spread = np.diff(np.append(heads, len(here)))
            top = np.maximum.reduceat(weight, heads)
            weight = np.exp(weight - np.repeat(top, spread))
            # Sums arc by arc within a node: rounding must not depend on the other words of the batch.
            total, sums = weight[heads], weight.copy()
            for k in range(1, int(spread.max())):
                deep = np.flatnonzero(spread > k)
                total[deep] += weight[heads[deep] + k]
                sums[heads[deep] + k] = total[deep]
            forward[here[heads]] = top + np.log(total)
            share = (sums / np.repeat(total, spread) * UNIT).astype(np.int64)
            share[heads + spread - 1] = UNIT
            entries[lo:hi] = share
        back = np.argsort(nodes, kind="stable")
        self.entries, self.pieces, self.starts = entries[back], pieces[order][back], starts[back]
        self.heads = np.searchsorted(nodes[back], np.arange(len(chars)))

    @staticmethod
    def _arcs(chars: np.ndarray, stops: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last character and piece of every piece in the words, by a walk down the tree of pieces; longest first."""
        kinds, live, size, found = vocab.kind[chars], np.arange(len(chars)), 1, []
        state = vocab.root[chars]
        while len(live):
            kept = state >= 0
            live, state = live[kept], state[kept]
            piece = vocab.piece_at[state]
            ends = piece >= 0
            found.append((live[ends], live[ends] + size - 1, piece[ends]))
            inside = live + size < stops[live]
            live, state = live[inside], state[inside]
            state = vocab.next[state, kinds[live + size]]
            size += 1
        return tuple(np.concatenate(part[::-1]) for part in zip(*found, strict=True))

    def draw(self, node: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """The arc into each node that its chance (0 up to UNIT) falls on."""
        arc = self.heads[node]
        over = np.flatnonzero(self.entries[arc] <= chance)
        while len(over):
            arc[over] += 1
            over = over[self.entries[arc[over]] <= chance[over]]
        return arc


def chances(keys: np.ndarray, round_: int) -> np.ndarray:
    """Whole numbers from 0 up to UNIT from 64-bit keys and a round (SplitMix64's finisher)."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64(0x9E3779B97F4A7C15) * np.uint64(round_ + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(24)).astype(np.int64)


def marked(text: str) -> str:
    return MARK + text.replace(MARK, OWN_MARK).replace(" ", MARK)


def row_key(key: object, seed: int) -> int:
    return xxhash.xxh64_intdigest(repr(key).encode(), seed & (2**64 - 1))


def draw(words: list[str], keys: np.ndarray, vocab: Vocabulary, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of all words, in order: word number, piece (or -1) and the piece's first character in its word."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    lattices = Lattices(list(number), vocab, alpha)
    which = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    first, at = lattices.first[which], lattices.last[which].copy()
    live, rounds, round_ = np.arange(len(words)), [], 0
    while len(live):
        arc = lattices.draw(at[live], chances(keys[live], round_))
        start = lattices.starts[arc]
        rounds.append((live, lattices.pieces[arc], start - first[live]))
        at[live] = start - 1
        live = live[start > first[live]]
        round_ += 1
    word, piece, start = (np.concatenate(part) for part in zip(*rounds, strict=True))
    order = np.argsort(word * (int(start.max()) + 1) + start)
    return word[order], piece[order], start[order]


def encode(texts: list[str | None], keys: list, vocab: Vocabulary, alpha: float = 1.0, seed: int = 0) -> list[list[int] | None]:
    """Sampled piece numbers of each text; a null text has none (null), an empty one an empty list."""
    out: list[list[int] | None] = [None if t is None else [] for t in texts]
    at = 0
    while at < len(texts):
        rows, words, counts, size = [], [], [], 0
        while at < len(texts) and (not rows or size + len(texts[at] or "") <= CHUNK):
            if texts[at]:
                own = WORD.findall(marked(texts[at]))
                rows.append(at)
                words += own
                counts.append(len(own))
                size += len(texts[at])
            at += 1
        if rows:
            _encode_part(rows, words, np.array(counts), keys, vocab, alpha, seed, out)
    return out


def _encode_part(rows: list[int], words: list[str], counts: np.ndarray, keys: list, vocab: Vocabulary, alpha: float, seed: int, out: list) -> None:
    begins = np.cumsum(counts) - counts
    place = np.arange(len(words)) - np.repeat(begins, counts)
    own = np.repeat(np.array([row_key(keys[r], seed) for r in rows], np.uint64), counts)
    with np.errstate(over="ignore"):
        mixed = own ^ ((place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    word, piece, start = draw(words, mixed, vocab, alpha)
    lost = np.flatnonzero(piece < 0)
    if len(lost):
        byte_ids = vocab.byte_ids
        chars = [words[w][s] for w, s in zip(word[lost].tolist(), start[lost].tolist(), strict=True)]
        spelled = [[byte_ids[b] for b in (MARK if c == OWN_MARK else c).encode("utf-8", "surrogatepass")] for c in chars]
        sizes = np.ones(len(piece), np.int64)
        sizes[lost] = [len(s) for s in spelled]
        ends = np.cumsum(sizes)
        piece, word = np.repeat(piece, sizes), np.repeat(word, sizes)
        for k, s in zip(lost.tolist(), spelled, strict=True):
            piece[ends[k] - len(s) : ends[k]] = s
    stops = np.searchsorted(word, np.append(begins[1:], len(words)))
    done = 0
    for r, stop in zip(rows, stops.tolist(), strict=True):
        out[r] = piece[done:stop].tolist()
        done = stop


def decode(ids: list[int] | None, vocab: Vocabulary) -> str | None:
    """The text of piece numbers; null gives null, none the empty text."""
    if ids is None:
        return None
    spelled = _spelling(vocab)
    text = b"".join([spelled[i] for i in ids])
    return text[1:].decode("utf-8", "surrogatepass") if text else ""


def _spelling(vocab: Vocabulary) -> list[bytes]:
    if not hasattr(vocab, "spelled"):
        vocab.spelled = [p.replace(MARK, " ").encode() for p in vocab.pieces]
        for byte, i in vocab.byte_ids.items():
            vocab.spelled[i] = bytes([byte])
    return vocab.spelled


def _local(name: str, path: str) -> str:
    return path if os.path.exists(path) else SparkFiles.get(name)


def sample_pieces(docs: DataFrame, model: str = MODEL, alpha: float = 1.0, seed: int = 0, key: str = "doc_id", verify: bool = True) -> DataFrame:
    """``docs`` columns ``key`` and text as pieces: ``key, n_pieces, ids, decoded``.

    ``alpha`` sharpens (over 1) or flattens (under 1) the weights. ``decoded`` is the text decoded from
    ``ids`` (null if not ``verify``). Null text: null ids, null count and null decoded; empty text: no
    pieces. Rows that repeat key and text get equal pieces; a null key is a key. Other columns are not
    read. The model file must lie at ``model`` on every worker, or be sent with ``addFile``.
    """
    name = model.rsplit("/", 1)[-1]

    def run(rows: dict) -> dict:
        vocab = vocabulary(_local(name, model))
        ids = encode(rows["text"], rows[key], vocab, alpha, seed)
        decoded = [decode(x, vocab) if verify else None for x in ids]
        return {key: rows[key], "n_pieces": [None if x is None else len(x) for x in ids], "ids": ids, "decoded": decoded}

    kind = docs.schema[key].dataType
    columns = {key: pa.string() if kind.typeName() == "string" else pa.int64(), "n_pieces": pa.int32(), "ids": pa.list_(pa.int32()), "decoded": pa.string()}
    return map_arrow(docs.select(key, "text"), run, f"{key} {kind.simpleString()}, n_pieces int, ids array<int>, decoded string", columns, rows=512)
