"""Operator 2: exact byte-level BPE token counts with a compiled finite-state transducer.

The pre-tokenizer is a finite-state segmenter over character classes; it marks
the bytes at which a new piece starts.  Inside a piece a deterministic
transducer reads bytes and emits, on every transition, by how much the token
count of the prefix read so far changes.  It rests on this property of BPE: the
encoding of a prefix ends in exactly one token t such that t may follow the last
token of the prefix before t.  A state is the set of token beginnings that are
open at this byte, each with its place in the vocabulary's trie, the token it
would follow and the count there; it forgets everything else, so long pieces
share states.  Transitions are determinised when first met and kept in a table
of fixed size, which is emptied when full.

A slice of texts is cut into chunks of equal length that run in lockstep.  The
state map of a chunk with a piece start is constant, since the start resets the
state; a prefix scan over the chunks composes the maps and gives every chunk the
state it is entered in, with which the bytes before its first piece start run.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings
inside a text are one token each, as the library's default has it; repeated rows
are counted each; a very long text is counted whole by one task, and a piece of it
without any blank lane by lane; only id and text are read, so further columns clash
with nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import buffers, slices

LIMIT = 1024
CHUNK = 256
#: Slots of the transition table (a power of two); it is emptied when half full.
SLOTS = 1 << 21
OTHER, LETTER, NUMBER, BLANK, SPACE = range(5)
#: The characters with the property White_Space.
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters and numbers of Unicode 16.0, which the library knows and Python's tables may not; first and last code point.
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
               (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
               (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: The endings that the pre-tokenizer splits off behind an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
START, IDLE = 0, 1


def char_classes() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for lo, hi in ranges:
            out[lo:hi + 1] = kind
    out[WHITE] = BLANK
    out[32] = SPACE
    return out


def visible_bytes() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 stands for itself, the rest is moved up from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}


def compile_tokenizer(path: str) -> dict:
    """Tables of a byte-level BPE tokenizer file: trie, merge ranks and the halves of every token."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    wanted = (model["type"], pre["type"], pre["use_regex"], pre["add_prefix_space"], spec["normalizer"], model["ignore_merges"], model["dropout"])
    if wanted != ("BPE", "ByteLevel", True, False, None, False, None):
        raise ValueError(f"only plain byte-level BPE is compiled, the file has {wanted}")
    byte = visible_bytes()
    ids, rank, halves, made = {}, {}, {}, {}
    spelled = {tuple(byte[c] for c in name): i for name, i in model["vocab"].items() if all(c in byte for c in name)}
    for b in range(256):
        ids[spelled[(b,)]] = (b,)
    for r, pair in enumerate(model["merges"]):
        left, right = (tuple(byte[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
        whole, key = spelled[left + right], (spelled[left], spelled[right])
        rank[key] = r
        if whole not in made and key[0] in ids and key[1] in ids and _may_follow(*key, rank, halves, made, r):
            made[whole], halves[whole], ids[whole] = r, key, left + right
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for i, spelling in ids.items():
        node = 0
        for b in spelling:
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][b]
        ends[node] = i
    specials = [t["content"] for t in spec["added_tokens"]]
    if any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError("added tokens that strip or need word boundaries are not compiled")
    return {"children": children, "ends": ends, "rank": rank, "halves": halves, "made": made, "classes": char_classes(), "specials": specials}


def _may_follow(left, right, rank, halves, made, before=1 << 60) -> bool:
    """Whether two tokens stay as they are side by side: no merge of rank under ``before`` joins them across the border.

    The symbols at the border over time are the right halves within ``left`` and
    the left halves within ``right``; one is there until the merge that makes its parent.
    """
    x, x_until = left, before
    while True:
        y, y_until = right, before
        while True:
            r = rank.get((x, y))
            # of two equal merges the left one comes first
            if r is not None and r < x_until and (r <= y_until if y_until != before else r < before):
                return False
            if y not in halves:
                break
            y_until, y = made[y], halves[y][0]
        if x not in halves:
            return True
        x_until, x = made[x], halves[x][1]


class Transducer:
    """The transducer's states and transitions met so far."""

    def __init__(self, tables: dict, slots: int = SLOTS):
        self.t, self.slots = tables, slots
        self.pairs: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self):
        self.states: dict[tuple, int] = {}
        self.open: list[tuple] = []
        self.keys = np.full(self.slots, -1, np.int64)
        self.next = np.zeros(self.slots, np.int32)
        self.emit = np.zeros(self.slots, np.int8)
        self.used = 0
        assert self._state(((0, -1, 0),)) == START
        assert self._state(()) == IDLE

    def _state(self, open_):
        if open_ not in self.states:
            self.states[open_] = len(self.open)
            self.open.append(open_)
        return self.states[open_]

    def _follows(self, last, token):
        key = (last, token)
        if key not in self.pairs:
            if len(self.pairs) >= self.slots:
                self.pairs.clear()
            self.pairs[key] = _may_follow(last, token, self.t["rank"], self.t["halves"], self.t["made"])
        return self.pairs[key]

    def _step(self, open_, byte):
        """Open beginnings behind ``byte`` and the change of the count."""
        ends, children, on, last, emit = self.t["ends"], self.t["children"], [], None, 0
        for node, before, count in open_:
            node = children[node].get(byte)
            if node is None:
                continue
            if last is None and ends[node] >= 0 and (before < 0 or self._follows(before, ends[node])):
                last, emit = ends[node], count + 1
            if children[node]:
                on.append((node, before, count))
        return (*((node, before, count - emit) for node, before, count in on), (0, last, 0)), emit

    def _learn(self, keys):
        for key, slot in zip(keys.tolist(), self._slots(keys).tolist(), strict=True):
            open_, emit = self._step(self.open[key >> 8], key & 255)
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (self.slots - 1)
            self.keys[slot], self.next[slot], self.emit[slot] = key, self._state(open_), emit
            self.used += 1

    def _slots(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (self.slots - 1)

    def read(self, states, byte):
        """One byte for each of many states: next states and emitted counts.  IDLE stays idle."""
        keys = (states.astype(np.int64) << 8) | byte
        at = self._slots(keys)
        off = np.flatnonzero((self.keys[at] != keys) & (states != IDLE))
        while len(off):
            missing = off[self.keys[at[off]] < 0]
            if len(missing):  # learn them and look from the first slot again
                self._learn(np.unique(keys[missing]))
                at[missing] = self._slots(keys[missing])
            else:
                at[off] = (at[off] + 1) & (self.slots - 1)
            off = off[self.keys[at[off]] != keys[off]]
        to, emit = self.next[at], self.emit[at]
        idle = states == IDLE
        if idle.any():
            to, emit = np.where(idle, IDLE, to), np.where(idle, 0, emit)
        return to, emit


def piece_starts(data: np.ndarray, breaks: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Per byte, whether a piece starts there.  ``breaks``: where a text starts, ascending."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    kind = classes[:128][data[lead] & 127]
    wide = np.flatnonzero(data[lead] >= 128)
    if len(wide):
        at = lead[wide]
        size = 2 + (data[at] >= 0xE0) + (data[at] >= 0xF0)
        point = data[at].astype(np.int64) & (0x7F >> size)
        for i in range(1, 4):
            more = size > i
            point[more] = (point[more] << 6) | (data[at[more] + i] & 0x3F)
        kind[wide] = classes[point]
    n = len(lead)
    first = np.zeros(n, bool)
    first[np.searchsorted(lead, breaks)] = True
    last = np.append(first[1:], True)
    white = kind >= BLANK
    before = np.concatenate([[OTHER], kind[:-1]]).astype(np.uint8)
    before[first] = BLANK
    after_white = before >= BLANK
    next_solid = np.append(~white[1:], False) & ~last
    starts = np.where(white, ~after_white | next_solid, (before != kind) & (before != SPACE)) | first
    # endings behind an apostrophe that starts a piece
    chars = data[lead]
    for end in ENDINGS:
        size = len(end)
        at = np.flatnonzero((chars[:n - size] == 39) & starts[:n - size] & (before[:n - size] != SPACE)) if n > size else np.zeros(0, np.int64)
        for i, c in enumerate(end, 1):
            at = at[(chars[at + i] == ord(c)) & ~first[at + i]]
        starts[at + 1] = False
        rest = at + size + 1
        starts[rest[rest < n]] = True
    out = np.zeros(len(data), bool)
    out[lead[starts]] = True
    return out


def _specials(data, offsets, specials):
    """Byte spans of special strings, leftmost first, none across texts."""
    raw, spans = data.tobytes(), []
    for s in (x.encode() for x in specials):
        at = raw.find(s)
        while at >= 0:
            whole = np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + len(s) - 1, "right")
            if whole:
                spans.append((at, at + len(s)))
            at = raw.find(s, at + (len(s) if whole else 1))
    return spans


def emitted(machine: Transducer, data: np.ndarray, starts: np.ndarray, quiet: np.ndarray | None, chunk: int = CHUNK) -> np.ndarray:
    """Per byte, the change of the token count.  ``quiet``: bytes that emit nothing."""
    lanes = -(-len(data) // chunk)
    def grid(x, fill):
        return np.ascontiguousarray(np.concatenate([x, np.full(lanes * chunk - len(x), fill, x.dtype)]).reshape(lanes, chunk).T)
    byte, reset = grid(data, 0), grid(starts, True)
    off = grid(quiet, False) if quiet is not None else None
    out = np.zeros((chunk, lanes), np.int8)
    state = np.full(lanes, IDLE, np.int32)

    def one(i, state, lane):
        if off is not None:
            state = np.where(off[i, lane], IDLE, state)
        return machine.read(state, byte[i, lane].astype(np.int64))

    for i in range(chunk):
        state, out[i] = one(i, np.where(reset[i], START, state), slice(None))
    # compose the chunks' maps: a chunk with a reset is constant, so the state
    # before any chunk comes from the last constant one, through those without a reset
    constant = reset.any(0)
    head = np.where(constant, reset.argmax(0), chunk)
    source = np.maximum.accumulate(np.where(constant, np.arange(lanes), -1))
    hop = np.arange(lanes) - 1
    depth = hop - source[np.maximum(hop, 0)]  # chunks without a reset in between
    depth[0] = -1
    for level in range(int(depth.max()) + 1):
        lane = np.flatnonzero((depth == level) & (head > 0))
        now = state[lane - 1].copy()
        for i in range(int(head[lane].max(initial=0))):
            going = head[lane] > i
            if not going.all():
                state[lane[~going & ~constant[lane]]] = now[~going & ~constant[lane]]
                lane, now = lane[going], now[going]
            now, out[i, lane] = one(i, now, lane)
        open_ = ~constant[lane]
        state[lane[open_]] = now[open_]
    return out.T.ravel()[:len(data)]


def count_tokens(machine: Transducer, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text of a slice."""
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    if machine.used * 2 > machine.slots:
        machine.clear()
    breaks, quiet = offsets[:-1][np.diff(offsets) > 0], None
    spans = _specials(data, offsets, machine.t["specials"])
    if spans:
        quiet = np.zeros(len(data), bool)
        for lo, hi in spans:
            quiet[lo:hi] = True
        breaks = np.unique(np.concatenate([breaks, np.array(spans).ravel()]))
        breaks = breaks[breaks < len(data)]
    emits = emitted(machine, data, piece_starts(data, breaks, machine.t["classes"]), quiet)
    sums = np.concatenate([[0], np.cumsum(emits, dtype=np.int64)])
    out = sums[offsets[1:]] - sums[offsets[:-1]]
    for lo, _ in spans:
        out[np.searchsorted(offsets, lo, "right") - 1] += 1
    return out


def _machine(tables, key) -> Transducer:
    """One transducer per Python worker: tasks that follow one another share what is determinised."""
    shelf = sys.modules.setdefault("_gridloom_machines", types.ModuleType("_gridloom_machines"))
    if getattr(shelf, "key", None) != key:
        shelf.key, shelf.machine = key, Transducer(tables.value)
    return shelf.machine


def token_counts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of every text as the tokenizer file counts them: id, ``n_bytes``, ``n_tokens``."""
    tables = docs.sparkSession.sparkContext.broadcast(compile_tokenizer(tokenizer))  # as large as the vocabulary

    def count(batches):
        machine = _machine(tables, tokenizer)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            counts = [count_tokens(machine, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]) for lo, hi in slices(offsets, 1 << 20)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(np.concatenate(counts or [np.zeros(0, np.int64)]), pa.int64())],
                                             [id, "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id), F.col(text).cast("string"))
    return rows.mapInArrow(count, f"`{id}` {rows.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long")
