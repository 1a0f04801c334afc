"""Byte-pair encoding by a deterministic automaton over tokens, and back by the labels of its arcs.

The automaton begins as one state with an arc for every byte. Each merge (a, b) -> ab adds a gadget, in the order of the merges:
an arc ab from every state that has a to where b leads, and b is taken away behind a. All arcs of one token lead to the same state, so
the arcs are a table of bits, states by symbols: a token's state says what may follow it, its symbol behind what it may stand. A new
token shares the state of b and the symbol of a; taking the arc away splits off a state for a and a symbol for b where others
share them. What the automaton accepts is exactly what the merges produce, one token path for every byte string.

A word is read byte by byte. At each place the state of the prefix's last token is known; the tokens that begin there are walked in
a tree of the vocabulary, and one of them is taken for its end if the table has the arc. Each place is reached by one token, so the
path from the end back to the start is the encoding. All distinct words of a slice take each step together.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, binary_array, distinct_spans, ranges, slices, table, text_bytes, text_slices

CACHED_WORDS = 200_000
CACHED_BYTES = 64
#: Longer words are read one at a time, place by place.
LONG_WORD = 512
SLICE_IDS = 1 << 19

OTHER, LETTER, NUMBER, SPACE = range(4)


# --- The automaton -----------------------------------------------------------------------------------------------------


def byte_of_letter() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the other 68 as U+0100 and on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in sorted(plain)} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Arcs:
    """Bits of states by symbols, which grow as either are split off."""

    def __init__(self, symbols: int) -> None:
        self.bits = np.zeros((64, 64), np.uint8)
        self.state_users, self.symbol_users = [0], [0] * symbols
        while symbols > self.bits.shape[1] * 8:
            self.bits = np.concatenate([self.bits, np.zeros_like(self.bits)], axis=1)
        self.bits[0, : symbols // 8] = 255
        for symbol in range(symbols // 8 * 8, symbols):
            self.bits[0, symbol >> 3] |= np.uint8(1 << (symbol & 7))

    def has(self, state: int, symbol: int) -> bool:
        return bool(self.bits[state, symbol >> 3] >> (symbol & 7) & 1)

    def own_state(self, state: int) -> int:
        """The state itself if one token only leads to it, else a copy."""
        if self.state_users[state] == 1:
            return state
        self.state_users[state] -= 1
        new = len(self.state_users)
        self.state_users.append(1)
        if new == len(self.bits):
            self.bits = np.concatenate([self.bits, np.zeros_like(self.bits)])
        self.bits[new] = self.bits[state]
        return new

    def own_symbol(self, symbol: int) -> int:
        if self.symbol_users[symbol] == 1:
            return symbol
        self.symbol_users[symbol] -= 1
        new = len(self.symbol_users)
        self.symbol_users.append(1)
        if new == self.bits.shape[1] * 8:
            self.bits = np.concatenate([self.bits, np.zeros_like(self.bits)], axis=1)
        column = self.bits[:, symbol >> 3] >> np.uint8(symbol & 7) & np.uint8(1)
        self.bits[:, new >> 3] |= column << np.uint8(new & 7)
        return new

    def cut(self, state: int, symbol: int) -> None:
        self.bits[state, symbol >> 3] &= np.uint8(~(1 << (symbol & 7)) & 255)

    def whole(self) -> np.ndarray:
        return np.ascontiguousarray(self.bits[: len(self.state_users), : (len(self.symbol_users) + 7) // 8])


class MergeAutomaton:
    """Tables of a byte-level vocabulary: `labels` are the bytes of each token id, `merges` ids (a, b, ab) in order of rank,
    `special` the ids of strings that are taken out of a text before it is split into words."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]], special: dict[bytes, int]) -> None:
        n = max([*labels, *special.values()], default=-1) + 1
        self.state, self.symbol = np.zeros(n, np.int32), np.full(n, -1, np.int32)
        base = [t for t, label in labels.items() if len(label) == 1]
        if len({labels[t] for t in base}) != 256:
            raise ValueError("every byte must be a token")
        arcs = _Arcs(len(base))
        arcs.state_users[0] = len(base) + 1  # the start shares it
        for k, t in enumerate(base):
            self.symbol[t], arcs.symbol_users[k] = k, 1
        for a, b, ab in merges:
            if self.symbol[a] < 0 or self.symbol[b] < 0 or self.symbol[ab] >= 0:
                raise ValueError("a merge must follow those of its parts and make a new token")
            if not arcs.has(self.state[a], self.symbol[b]):
                raise ValueError("a merge whose parts never meet")
            self.state[ab] = self.state[b]
            arcs.state_users[self.state[b]] += 1
            if a != b:
                self.symbol[ab] = self.symbol[a]
                arcs.symbol_users[self.symbol[a]] += 1
            self.state[a] = arcs.own_state(self.state[a])
            self.symbol[b] = arcs.own_symbol(self.symbol[b])
            arcs.cut(self.state[a], self.symbol[b])
            if a == b:  # the leftmost pair of a run is merged, so a may not stand before aa either
                self.symbol[ab] = self.symbol[a]
                arcs.symbol_users[self.symbol[a]] += 1
        self.arcs = arcs.whole()
        self.special = dict(special)
        self._label_tables({**labels, **{t: s for s, t in special.items()}}, n)
        self._tree({label: t for t, label in labels.items() if self.symbol[t] >= 0})
        self.classes = character_classes()

    @classmethod
    def from_file(cls, path: str) -> MergeAutomaton:
        """From a tokenizers file: byte-level pairs, the usual pattern for words, no normaliser, plain added tokens."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        fits = (
            model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and not spec.get("normalizer")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        if not fits:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        letters = byte_of_letter()
        special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        labels = {t: bytes(letters[c] for c in token) for token, t in vocab.items() if token.encode() not in special}
        merges = []
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            merges.append((vocab[a], vocab[b], vocab[a + b]))
        return cls(labels, merges, special)

    def _label_tables(self, labels: dict[int, bytes], n: int) -> None:
        each = [labels.get(t, b"") for t in range(n)]
        self.label_lengths = np.array([len(x) for x in each], np.int64)
        self.label_starts = np.concatenate([[0], np.cumsum(self.label_lengths)[:-1]]).astype(np.int64)
        self.label_bytes = np.frombuffer(b"".join(each), np.uint8)

    def _tree(self, tokens: dict[bytes, int]) -> None:
        """The vocabulary as a tree: arcs as sorted numbers node * 256 + byte, and the token that ends at a node."""
        level, keys, ends = [(label, t, 0) for label, t in sorted(tokens.items())], [], {}
        nodes, depth = 1, 0
        while level:
            below, last = [], None
            for label, t, node in level:
                key = node << 8 | label[depth]
                if key != last:
                    keys.append(key)
                    last, child, nodes = key, nodes, nodes + 1
                if len(label) == depth + 1:
                    ends[child] = t
                else:
                    below.append((label, t, child))
            level, depth = below, depth + 1
        # Children are numbered as their arcs are found: level by level, in the order of the labels, so keys ascend.
        self.tree_keys = np.array(keys, np.int64)
        self.tree_tokens = np.full(nodes, -1, np.int32)
        self.tree_tokens[list(ends)] = list(ends.values())

    # --- Words ---

    def encode_words(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids, all ids) of byte spans that are encoded each on its own."""
        long = np.flatnonzero(lengths > LONG_WORD)
        if len(long):
            short = np.flatnonzero(lengths <= LONG_WORD)
            counts, ids = np.zeros(len(starts), np.int64), [np.zeros(0, np.int32)] * len(starts)
            n, flat = self.encode_words(data, starts[short], lengths[short])
            cuts = np.cumsum(n)[:-1]
            for w, part in zip(short.tolist(), np.split(flat, cuts) if len(short) else [], strict=True):
                ids[w] = part
            for w in long.tolist():
                ids[w] = self._encode_long(bytes(data[starts[w] : starts[w] + lengths[w]]))
            counts[:] = [len(x) for x in ids]
            return counts, np.concatenate(ids)
        places = np.concatenate([[0], np.cumsum(lengths + 1)])
        base = places[:-1]
        token, state = np.full(places[-1], -1, np.int32), np.zeros(places[-1], np.int32)
        by_length = np.argsort(-lengths, kind="stable")
        shorter = np.searchsorted(-lengths[by_length], -np.arange(int(lengths.max(initial=0)) + 1), "left")
        for begin in range(len(shorter) - 1):
            active = by_length[: shorter[begin]]  # words longer than `begin`
            here, node, end = state[base[active] + begin], np.zeros(len(active), np.int64), begin
            while len(active):
                key = node << 8 | data[starts[active] + end]
                at = np.minimum(np.searchsorted(self.tree_keys, key), len(self.tree_keys) - 1)
                known = self.tree_keys[at] == key
                active, here, node, end = active[known], here[known], at[known] + 1, end + 1
                found = self.tree_tokens[node]
                symbol = self.symbol[found]
                may = (found >= 0) & (self.arcs[here, symbol >> 3] >> (symbol & 7) & 1).astype(bool)
                to = base[active[may]] + end
                token[to], state[to] = found[may], self.state[found[may]]
                more = lengths[active] > end
                active, here, node = active[more], here[more], node[more]
        return self._walk_back(token, base, lengths)

    def _walk_back(self, token: np.ndarray, base: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, left, steps = np.flatnonzero(lengths > 0), lengths.copy(), []
        counts = np.zeros(len(lengths), np.int64)
        while len(words):
            found = token[base[words] + left[words]]
            steps.append((words, found))
            counts[words] += 1
            left[words] -= self.label_lengths[found]
            words = words[left[words] > 0]
        ends, ids = np.cumsum(counts), np.zeros(int(counts.sum()), np.int32)
        for back, (words, found) in enumerate(steps):
            ids[ends[words] - 1 - back] = found
        return counts, ids

    @cached_property
    def _scalar(self) -> tuple[dict[int, int], list[int], list[int], list[int], list[bytes]]:
        children = {k: i + 1 for i, k in enumerate(self.tree_keys.tolist())}
        return children, self.tree_tokens.tolist(), self.symbol.tolist(), self.state.tolist(), [r.tobytes() for r in self.arcs]

    def _encode_long(self, word: bytes) -> np.ndarray:
        children, ends, symbols, states, arcs = self._scalar
        n = len(word)
        token, state = [-1] * (n + 1), [0] * (n + 1)
        for begin in range(n):
            row, node, end = arcs[state[begin]], 0, begin
            while end < n and (node := children.get(node << 8 | word[end])):
                end += 1
                found = ends[node]
                if found >= 0 and row[symbols[found] >> 3] >> (symbols[found] & 7) & 1:
                    token[end], state[end] = found, states[found]
        ids, lengths, end = [], self.label_lengths, n
        while end:
            ids.append(token[end])
            end -= int(lengths[token[end]])
        return np.array(ids[::-1], np.int32)

    # --- Texts ---

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, lengths, special id or -1) of the words of all rows, in order: together they are all bytes."""
        raw = data.tobytes()
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        marks = []
        if self.special:
            pattern = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)))
            row_of = offsets[1:]
            at = 0
            while found := pattern.search(raw, at):
                row_end = int(row_of[np.searchsorted(row_of, found.start(), "right")])
                if found.end() <= row_end:
                    marks.append((found.start(), found.end(), self.special[found.group()]))
                    cut[[found.start(), found.end()]] = True
                    at = found.end()
                else:
                    at = found.start() + 1
        if len(data) and data.max() < 0x80:
            code, lead = data.astype(np.uint32), None
        else:
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            code = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4")
        starts = np.flatnonzero(word_starts(code, self.classes[code], cut[:-1] if lead is None else cut[lead]))
        if lead is not None:
            starts = lead[starts]
        special = np.full(len(starts), -1, np.int64)
        if marks:
            low, high, ids = map(np.array, zip(*marks, strict=True))
            keep = np.ones(len(starts), bool)
            keep[ranges(np.searchsorted(starts, low) + 1, np.searchsorted(starts, high) - np.searchsorted(starts, low) - 1)] = False
            special[np.searchsorted(starts, low)] = ids
            starts, special = starts[keep], special[keep]
        return starts, np.diff(np.append(starts, len(data))), special

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and row offsets of the arc labels of rows of ids. An id that no arc has is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.label_lengths)):
            raise ValueError("an id outside the vocabulary")
        lengths = self.label_lengths[ids]
        return self.label_bytes[ranges(self.label_starts[ids], lengths)], np.concatenate([[0], np.cumsum(lengths)])[offsets]


@cache
def character_classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point, as the tokenizers library has them: characters that its Unicode
    tables may be too old for are tried out, whether they join a letter or a digit beside them."""
    import regex
    from tokenizers.pre_tokenizers import ByteLevel

    everything = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, everything):
            classes[found.start() : found.end()] = kind
    classes[0xD800:0xE000] = OTHER
    recent = [c for c in np.flatnonzero(classes != OTHER).tolist() if unicodedata.category(chr(c)) == "Cn"]
    splitter = ByteLevel(add_prefix_space=False)
    for low in range(0, len(recent), 4000):
        some = np.array(recent[low : low + 4000])
        starts = [a for _, (a, _) in splitter.pre_tokenize_str("".join(f"a{chr(c)}0{chr(c)}\n" for c in some.tolist()))]
        own_word = np.zeros(5 * len(some), bool)
        own_word[starts] = True
        classes[some] = np.where(~own_word[1::5], LETTER, np.where(~own_word[3::5], NUMBER, OTHER))
    return classes


def word_starts(code: np.ndarray, kind: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Where words begin, as the pattern '(?:[sdmt]|ll|ve|re)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ finds them.

    A run of one class is a word; the last space before another run belongs to that run, and any other last white space is a
    word of its own; a contraction ends the run of its apostrophe and begins a new run of letters behind it.
    """
    n = len(code)
    start = cut.copy()
    if not n:
        return start
    start[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~cut[1:]) + 1
    start[after - 1] = True
    start[after] = code[after - 1] != 0x20
    marks = np.flatnonzero((code == 0x27) & start)
    if len(marks):
        far = np.concatenate([code, np.zeros(3, np.uint32)])
        ends = np.concatenate([cut, np.ones(3, bool)])
        one, two = far[marks + 1], far[marks + 2]
        short = ~ends[marks + 1] & np.isin(one, [ord(c) for c in "sdmt"])
        pair = ((one == ord("l")) & (two == ord("l"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("r")) & (two == ord("e")))
        long = ~ends[marks + 1] & ~ends[marks + 2] & pair
        start[marks[short | long] + 1] = False
        begin = np.concatenate([marks[short] + 2, marks[long] + 3])
        start[begin[begin < n]] = True
    return start


class TextEncoder:
    """Whole texts through the automaton; short words are remembered between slices."""

    def __init__(self, automaton: MergeAutomaton) -> None:
        self.automaton, self.known = automaton, {}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each row, all ids)."""
        starts, lengths, special = self.automaton.words(data, offsets)
        first, group = distinct_spans(data, starts, lengths)
        counts, ids = self._encode_distinct(data, starts[first], lengths[first])
        at = np.cumsum(counts) - counts
        marked = np.flatnonzero(special >= 0)
        if len(marked):
            group = group.copy()
            group[marked] = len(counts) + np.arange(len(marked))
            at = np.concatenate([at, len(ids) + np.arange(len(marked))])
            counts = np.concatenate([counts, np.ones(len(marked), np.int64)])
            ids = np.concatenate([ids, special[marked].astype(np.int32)])
        each = counts[group]
        total = np.concatenate([[0], np.cumsum(each)])
        return np.diff(total[np.searchsorted(starts, offsets)]), ids[ranges(at[group], each)]

    def _encode_distinct(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), (starts + lengths).tolist(), strict=True)]
        new = np.array([i for i, w in enumerate(words) if w not in self.known], np.int64)
        local = {}
        if len(new):
            counts, ids = self.automaton.encode_words(data, starts[new], lengths[new])
            ends = 4 * np.cumsum(counts)
            flat = ids.astype("<i4").tobytes()
            local = {words[i]: flat[b - 4 * c : b] for i, b, c in zip(new.tolist(), ends.tolist(), counts.tolist(), strict=True)}
            self.known.update((w, x) for w, x in local.items() if len(w) <= CACHED_BYTES)
        found = [local[w] if w in local else self.known[w] for w in words]
        return np.array([len(x) // 4 for x in found], np.int64), np.frombuffer(b"".join(found), "<i4")


# --- Spark -------------------------------------------------------------------------------------------------------------


def encode(docs: DataFrame, tokenizer: str | MergeAutomaton, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `carried` columns and `ids` array<int>, the tokens of the whole `text`. A null or empty text has none; every row gives a row,
    repeated ones too. `tokenizer` is a path that the driver has; its tables, fixed by the vocabulary, are broadcast."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer if isinstance(tokenizer, MergeAutomaton) else MergeAutomaton.from_file(tokenizer))
    rows = docs.select(*carried, "text")
    names = [*carried, "ids"]

    def make():
        encoder = TextEncoder(shared.value)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, offsets in text_slices(batch):
                counts, ids = encoder.encode(data, offsets)
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(carried))] + [lists], names)

        return step

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*carried).schema)
    return arrow_map(rows, make, f"{kept}, ids array<int>")


def _id_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of at most SLICE_IDS ids (or one row) with the ids and offsets of their rows."""
    column = batch.column("ids")
    at = column.offsets.to_numpy().astype(np.int64)
    ids = column.values.to_numpy(zero_copy_only=False)
    for low, high in slices(at, SLICE_IDS):
        yield batch.slice(low, high - low), ids[at[low] : at[high]], at[low : high + 1] - at[low]


def decode(rows: DataFrame, tokenizer: str | MergeAutomaton, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `carried` columns and `text`, the labels of `ids`. What is no UTF-8 becomes U+FFFD; null ids are none; an id that the vocabulary
    lacks is an error."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer if isinstance(tokenizer, MergeAutomaton) else MergeAutomaton.from_file(tokenizer))
    rows = rows.selectExpr(*(f"`{c}`" for c in carried), "coalesce(ids, array()) ids")

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, ids, offsets in _id_slices(batch):
                texts = valid_texts(*shared.value.decode(ids, offsets))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(carried))] + [texts], [*carried, "text"])

        return step

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*carried).schema)
    return arrow_map(rows, make, f"{kept}, text string")


def valid_texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes as strings, with U+FFFD for what is no UTF-8."""
    raw = data.tobytes()
    try:
        raw.decode("utf-8")
        lead = np.append((data & 0xC0) != 0x80, True)
        if lead[offsets].all():
            return binary_array(data, offsets, pa.string())
    except UnicodeDecodeError:
        pass
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.string())


def _sha256(rows: np.ndarray, offsets: np.ndarray) -> pa.Array:
    raw = memoryview(rows).cast("B") if rows.size else b""
    return pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])


def digests(encoded: DataFrame, automaton: MergeAutomaton) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of little-endian u32) and decoded_sha256 of rows with ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(automaton)
    doc_type = encoded.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, ids, offsets in _id_slices(batch):
                data, at = text_bytes(valid_texts(*shared.value.decode(ids, offsets)))
                columns = [part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), _sha256(np.ascontiguousarray(ids, "<u4"), 4 * offsets), _sha256(data, at)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    return arrow_map(encoded, make, f"doc_id {doc_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_merge_automaton(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    automaton = MergeAutomaton.from_file(tokenizer)
    return digests(encode(table(spark, sf_dir, "documents"), automaton), automaton)
