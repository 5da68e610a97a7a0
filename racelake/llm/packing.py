"""Packing of token sequences by a configuration linear program.

Only the histogram of piece lengths (at most `capacity` numbers, whatever the input) reaches the driver.  The covering program over
configurations (multisets of lengths that fit one sequence) asks for the least number of sequences whose configurations cover every
length as often as it occurs.  It is solved by multiplicative weights: the price of a length is its size times exp(-rate * how far it is
covered); a knapsack dynamic program over the capacity prices the configurations; a round adds those whose value is nearly the
best, within a budget for each length, and the prices of what they cover fall.  Any prices give a dual bound, the value of all pieces
over the value of the best configuration; the best bound of all rounds is reported.  The multiplicities are rounded to whole numbers,
the pieces that rounding leaves form a smaller program of the same kind, and the last few are placed best fit.

The plan is a bounded table of rank ranges by length; ranking the pieces and placing them is done by Spark, without gathering the
pieces of one length in a task.

Ids are those of the `tokenizers` file.  Its vocabulary and merges are read into the byte-pair encoder of `tiktoken`, which gives the same
ids several times faster; files of another kind, texts that hold a special token, and texts that it refuses go to `tokenizers` itself.

Defined cases: a null or empty text is one piece holding the end id; null ids stay; repeated rows are packed one by one; an empty table
gives an empty result; a text of any length is cut, none is dropped; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import json
import logging
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._scratch import Scratch
from ._text import released

CAPACITY = 2048
_LOG = logging.getLogger(__name__)
#: Fixed value: the pattern by which byte-level BPE of this kind splits a text.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, U+0100 and on for the rest."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Ids:
    """Ids of texts by a `tokenizers` file, without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._encoder(json.loads(self.tokenizer.to_str()))

    def _encoder(self, made: dict):
        """A tiktoken encoder of equal ids, or None for a file of another kind: plain byte-level BPE whose merges have rising ids."""
        model, first = made["model"], made.get("pre_tokenizer") or {}
        plain = made.get("normalizer") is None and first.get("type") == "ByteLevel" and not first.get("add_prefix_space") and first.get("use_regex", True)
        if not plain or model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            return None
        letters, vocab = _byte_letters(), model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [vocab[a + b] for a, b in pairs]
        if any(x >= y for x, y in zip(ids[:-1], ids[1:], strict=True)) or len(vocab) != 256 + len(set(ids)) + sum(w in self.special for w in vocab):
            return None
        import tiktoken

        ranks = {bytes(letters[c] for c in w): i for w, i in vocab.items() if w not in self.special}
        return tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except BaseException as e:  # the encoder's own panic is no Exception; what it refuses goes the slow way
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


_LOADED: dict[str, Ids] = {}


def tokens(path: str) -> Ids:
    """The ids of a tokenizer file, loaded once in a worker."""
    if path not in _LOADED:
        _LOADED[path] = Ids(path)
    return _LOADED[path]


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32, with the task (part) and the number of earlier pieces of that length in the task (seen)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, part, seen = tokens(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, out = [], []
            for j in range(batch.num_rows):
                packed = memoryview(ids.of(batch.column(1)[j].as_py() or "").astype("<u4", copy=False).tobytes() + end)
                n, at, piece = len(packed) // 4, 0, 0
                while at < n:
                    size = (n - 1) % capacity + 1 if piece == 0 else capacity
                    rows.append(j)
                    out.append((piece, at, size, zlib.crc32(packed[4 * at : 4 * (at + size)]), part, seen[size]))
                    seen[size] += 1
                    at, piece = at + size, piece + 1
            columns = np.array(out, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(columns[:, k]) for k in range(6))], ["doc_id", *_PIECE])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(released(scan), f"doc_id {kind}, piece long, start long, length long, ids_crc32 long, part long, seen long")


_PIECE = ["piece", "start", "length", "ids_crc32", "part", "seen"]


def best_fill(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room the value of the best multiset of lengths that fits, and its first length (0: leave one token empty): an unbounded knapsack by dynamic programming. value[l] is that of length l, 0 where it is not wanted."""
    lengths = np.flatnonzero(value > 0)
    gain = value[lengths]
    ends = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        k = ends[room]
        if k:
            got = best[room - lengths[:k]] + gain[:k]
            i = int(got.argmax())
            if got[i] > best[room - 1]:
                best[room], choice[room] = got[i], lengths[i]
                continue
        best[room] = best[room - 1]
    return best, choice


def configuration(first: int, choice: list[int], capacity: int) -> tuple[tuple[int, int], ...]:
    """One piece of length `first` and the fill of most value of the room beside it, as sorted pairs of length and count."""
    counts, room = {first: 1}, capacity - first
    while room:
        length = choice[room]
        if length:
            counts[length] = counts.get(length, 0) + 1
        room -= length or 1
    return tuple(sorted(counts.items()))


Configuration = tuple[tuple[int, int], ...]


def fractional(wanted: np.ndarray, capacity: int, rounds: int = 96, budget: float = 0.25, rate: float = 0.5, slack: float = 0.1, narrow: int = 32) -> tuple[dict[Configuration, float], float]:
    """Multiplicities of configurations that cover the `wanted` pieces of each length, and a lower bound on the number of sequences, by multiplicative weights.

    A round may cover each length by `budget` of its pieces; it takes the best configuration that holds each length, where its value is
    within `slack` of the best of all.  `narrow` more rounds of a tenth of both move the prices alone, for the bound.  Multiplicities are scaled so that together they have the size of all pieces."""
    used = np.flatnonzero(wanted)
    if not len(used):
        return {}, 0.0
    sizes, pieces = np.arange(capacity + 1) / capacity, np.maximum(wanted, 1).astype(float)
    covered, plan, bound, held = np.zeros(capacity + 1), {}, 0.0, 0.0
    for k in range(rounds + narrow):
        late = k >= rounds
        share = covered / pieces
        price = np.where(wanted > 0, sizes * np.exp(-rate * (share - share[used].min())), 0.0)
        best, choice = best_fill(price, capacity)
        bound = max(bound, float(wanted @ price) / best[capacity])
        most = budget * wanted / (10 if late else 1)
        left, fill = most.copy(), choice.tolist()
        values = price[used] + best[capacity - used]
        # longest first: short pieces fill what is left beside them
        for first in used[values >= (1 - slack / (10 if late else 1)) * best[capacity]][::-1].tolist():
            if left[first] <= 0:
                continue
            config = configuration(first, fill, capacity)
            times = min(left[length] / n for length, n in config)
            if times > 0:
                if not late:
                    plan[config] = plan.get(config, 0.0) + times
                for length, n in config:
                    left[length] -= n * times
        covered += most - left
        if not late:
            held = float(covered @ sizes)
    scale = float(wanted @ sizes) / held
    return {config: times * scale for config, times in plan.items()}, bound


def _whole(plan: dict[Configuration, float]) -> list[tuple[Configuration, int]]:
    """Whole multiplicities: what one configuration loses, the next of the same longest length gets."""
    out, carry, longest = [], 0.0, 0
    for config, times in sorted(plan.items(), key=lambda x: (-x[0][-1][0], -x[1], x[0])):
        if config[-1][0] != longest:
            carry, longest = 0.0, config[-1][0]
        carry += times
        if n := int(carry + 1e-9):
            out.append((config, n))
            carry -= n
    return out


def rounded(wanted: np.ndarray, capacity: int, passes: int = 5) -> tuple[list[tuple[Configuration, int]], float, int]:
    """Configurations with whole multiplicities that use each piece once; the program's lower bound; and how many pieces best fit placed.

    Each pass solves the program for the pieces that are left and rounds it; a pass that places under a tenth of them is the last.  Where
    lengths have few pieces each, more passes can use up the short pieces that fill gaps; so what best fit makes of the rest of the first pass is
    tried too, and stays if it needs over a hundredth fewer sequences."""
    left, plan, bound, best = wanted.copy(), {}, 0.0, None
    for k in range(passes):
        before = int(left.sum())
        if before:
            shares, dual = fractional(left, capacity) if k == 0 else fractional(left, capacity, slack=0.02, narrow=0)
            bound = bound if k else dual
            for config, times in _whole(shares):
                if n := min(times, *(int(left[length]) // copies for length, copies in config)):
                    plan[config] = plan.get(config, 0) + n
                    for length, copies in config:
                        left[length] -= copies * n
        last = k == passes - 1 or before - int(left.sum()) < 0.1 * before or not left.any()
        if k == 0 or last:
            filled = _best_fit(plan, left, capacity)
            used = sum(n for _, n in filled)
            if best is None or 0.99 * used <= best[0]:
                best = used, filled, int(left.sum())
        if last:
            break
    return best[1], bound, best[2]


def _best_fit(plan: dict[Configuration, int], left: np.ndarray, capacity: int) -> list[tuple[Configuration, int]]:
    """The plan with the pieces that are left put, longest first, into the least room they fit, else into new sequences; equal sequences are handled together."""
    rooms: dict[int, list[list]] = {}
    for config, times in plan.items():
        rooms.setdefault(capacity - sum(length * n for length, n in config), []).append([dict(config), times])
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            room = min((r for r in rooms if r >= length and rooms[r]), default=0)
            counts, times = rooms[room].pop() if room else ({}, n)
            take = min(n, times)
            if take < times:
                rooms[room].append([counts, times - take])
            more = dict(counts)
            more[length] = more.get(length, 0) + 1
            rooms.setdefault((room or capacity) - length, []).append([more, take])
            n -= take
    return [(tuple(sorted(counts.items())), times) for groups in rooms.values() for counts, times in groups]


def ranges(plan: list[tuple[Configuration, int]], capacity: int) -> np.ndarray:
    """Rows (length, from rank, first sequence, copies of the length in a sequence, offset of the first copy), by length and rank."""
    rows, taken, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for config, times in plan:
        offset = 0
        for length, copies in reversed(config):
            rows.append((length, taken[length], sequence, copies, offset))
            taken[length] += copies * times
            offset += length * copies
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placing(table: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """table: rows of ranges(); a piece of a length and rank finds its row by binary search."""
    step = int(table[:, 1].max()) + 1 if len(table) else 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0].astype(object) * step + table[:, 1].astype(object)
        small = len(keys) == 0 or keys[-1] < 2**62
        keys = keys.astype(np.int64) if small else keys
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            # ranks beyond the last start of any length still sort before the next length
            key = length * step + np.minimum(rank, step - 1) if small else length.astype(object) * step + np.minimum(rank, step - 1)
            row = table[np.searchsorted(keys, key, side="right") - 1]
            nth = rank - row[:, 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            kept[1] = kept[1].cast(pa.int32())
            yield pa.RecordBatch.from_arrays([*kept, pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)], [*names, "sequence_id", "offset"])

    return place


def pack(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece. The driver logs the number of sequences and the program's lower bound."""
    scratch = Scratch(spark, "packing")
    pieces = scratch.put(cut(docs, path, capacity, end_id), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    wanted = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        wanted[r["length"]] = r["n"]
    plan, bound, rest = rounded(wanted, capacity)
    _LOG.info("%d sequences, at least %.1f are needed; best fit placed %d of %d pieces", sum(n for _, n in plan), bound, rest, int(wanted.sum()))
    table = ranges(plan, capacity)
    # the rank of a piece: those of its length in earlier tasks, then in its own
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("seen"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return scratch.result(ranked.mapInArrow(_placing(table), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
