"""Token counts by compiled finite-state transducers.

Two transducers are run one after the other. The first splits a text into words: eight states over
eight symbols, where a symbol is a character's class together with what its next characters decide.
Texts are cut into chunks of fixed length; each chunk is a map from entry state to exit state, the maps
are composed by a parallel prefix scan, and with its entry state known each chunk emits its word starts.

The second runs over the bytes of a word and emits, on each transition, by how much the number of
tokens changes. Its state holds the places from which a vocabulary entry may still be continued: the
place in the vocabulary's prefix tree, the last token before it, and the token count there. A token may
follow another if the pair encodes to itself, and exactly one token ends at each place, so the states
are deterministic. They are compiled as they are met and kept, up to ``MAX_STATES``.

Defined results: a null text counts as empty and has 0 tokens; the file's special strings inside a text
are one token each; repeated rows are counted each; an empty table gives no rows; further columns are
kept by ``with_token_counts``, except one with the name of the count.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .packing import byte_letters, unassigned

CHUNK = 512
BLOCK_CHARS = 1 << 21
MAX_STATES = 250_000

# White space, and the endings that follow an apostrophe as one word.
WHITE = "\t\n\x0b\f\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
SHORT_ENDINGS = ["s", "t", "m", "d"]
LONG_ENDINGS = ["re", "ve", "ll"]

# Symbols of the word transducer, then its states.
LETTER, NUMBER, OTHER, SHORT, LONG, LEADING, SINGLE, BLANK, END = range(9)
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_BLANKS, ONE_LEFT, TWO_LEFT, CLOSED = range(8)


def word_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a word starts, by symbol and state."""
    to, starts = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for symbol, own in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        to[symbol] = own
        starts[symbol, [own, AFTER_SPACE]] = False
    to[LETTER, ONE_LEFT], to[LETTER, TWO_LEFT] = CLOSED, ONE_LEFT
    starts[LETTER, [ONE_LEFT, TWO_LEFT]] = False
    for symbol, own in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
        to[symbol] = own
        to[symbol, [IN_OTHERS, AFTER_SPACE]] = IN_OTHERS
        starts[symbol, [IN_OTHERS, AFTER_SPACE]] = False
    to[LEADING], to[SINGLE], to[BLANK], to[END] = AFTER_SPACE, CLOSED, IN_BLANKS, CLOSED
    starts[BLANK, IN_BLANKS] = False
    starts[END] = False
    return to, starts


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or BLANK of every code point; those that Python does not know are asked of the library,
    whose tables may be newer."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[[ord(c) for c in WHITE]] = BLANK
    unknown = np.array(unassigned())
    for at in range(0, len(unknown), 20_000):
        out[unknown[at : at + 20_000]] = asked(unknown[at : at + 20_000])
    return out


def asked(codes: np.ndarray) -> np.ndarray:
    """Classes of code points by the words that the library cuts around them."""
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    found = cut.pre_tokenize_str("".join(f"a{chr(c)}1{chr(c)}!" for c in codes))
    begins = np.zeros(5 * len(codes), bool)
    begins[[start for _, (start, _) in found]] = True
    _, to_letter, _, to_number, from_other = begins.reshape(-1, 5).T
    return np.select([~to_letter, ~to_number, ~from_other], [LETTER, NUMBER, OTHER], BLANK).astype(np.uint8)


def symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of the code points of texts, each followed by one place at ``ends``."""
    out = classes()[codes]
    out[ends] = END
    padded = np.r_[out, END, END]
    blank = out == BLANK
    last = blank & (padded[1:-1] != BLANK) & (padded[1:-1] != END)
    space = codes == ord(" ")
    out[last & space], out[last & ~space] = LEADING, SINGLE
    quotes = np.flatnonzero((codes == ord("'")) & (out == OTHER))
    following = np.r_[codes, 0, 0]
    following[ends] = 0
    first, second = following[quotes + 1], following[quotes + 2]
    out[quotes[np.isin(first, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
    for a, b in LONG_ENDINGS:
        out[quotes[(first == ord(a)) & (second == ord(b))]] = LONG
    return out


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Compositions of the state maps up to each row, the row included, in log2(rows) steps."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


def word_starts(symbol: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Whether a word starts at each place."""
    to, starts = word_transducer()
    n, rows = len(symbol), -(-len(symbol) // chunk)
    table = np.full(rows * chunk, END, np.uint8)
    table[:n] = symbol
    table = np.ascontiguousarray(table.reshape(rows, chunk).T)
    maps = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in table:
        maps = to[column[:, None], maps]
    state = np.r_[np.uint8(CLOSED), prefix_scan(maps)[:-1, CLOSED]]
    out = np.empty(table.shape, bool)
    for t, column in enumerate(table):
        out[t] = starts[column, state]
        state = to[column, state]
    return out.T.reshape(-1)[:n]


class ByteTransducer:
    """Token counts of words, by states compiled when first met."""

    BIAS = 512

    def __init__(self, path: str, max_states: int = MAX_STATES):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.size = max(vocab.values()) + 1
        self.single = {b: vocab[c] for c, b in letters.items()}
        self.merges = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges[vocab[a] * self.size + vocab[b]] = (rank, vocab[a + b])
        self.text: dict[int, bytes] = {}
        self.children: list[dict[int, int]] = [{}]  # prefix tree
        self.token: list[int] = [-1]
        for word, token in vocab.items():
            if word in self.special:
                continue
            raw, node = bytes(letters[c] for c in word), 0
            self.text[token] = raw
            for byte in raw:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][byte]
            self.token[node] = token
        self.pairs: dict[int, bool] = {}
        self.max_states = max_states
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [(self.place(0, -1, 0),)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.moves: dict[int, int] = {}

    def place(self, node: int, before: int, tokens: int) -> int:
        """A place from which an entry may be continued, as one number; tokens count from the end."""
        return (node * (self.size + 1) + before + 1) * 2 * self.BIAS + tokens + self.BIAS

    def encode(self, raw: bytes) -> list[int]:
        """Plain merging, lowest rank first: used on the bytes of one or two tokens."""
        ids, size, merges = [self.single[b] for b in raw], self.size, self.merges
        while len(ids) > 1:
            best = min(((merges[k][0], i) for i in range(len(ids) - 1) if (k := ids[i] * size + ids[i + 1]) in merges), default=None)
            if best is None:
                break
            a, b = ids[best[1]], ids[best[1] + 1]
            merged, out, i = merges[a * size + b][1], [], 0
            while i < len(ids):
                if i + 1 < len(ids) and ids[i] == a and ids[i + 1] == b:
                    out.append(merged)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def follows(self, a: int, b: int) -> bool:
        key = (a + 1) * self.size + b
        known = self.pairs.get(key)
        if known is None:
            known = self.encode(self.text[b]) == [b] if a < 0 else self.encode(self.text[a] + self.text[b]) == [a, b]
            if len(self.pairs) > 4 * self.max_states:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def compile(self, state: int, byte: int) -> int:
        """The move from a state on a byte: the next state and the change of the token count."""
        open_, last, count = [], -1, 0
        for place in self.states[state]:
            place, tokens = divmod(place, 2 * self.BIAS)
            node, before = divmod(place, self.size + 1)
            before, tokens = before - 1, tokens - self.BIAS
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.token[child]
            if token >= 0 and last < 0 and self.follows(before, token):
                last, count = token, tokens + 1
            if self.children[child]:
                open_.append((child, before, tokens))
        if last < 0:
            raise ValueError("no token ends here; the vocabulary lacks a byte")
        key = (*(self.place(node, before, tokens - count) for node, before, tokens in open_), self.place(0, last, 0))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        move = to * 2 * self.BIAS + count + self.BIAS
        self.moves[state * 256 + byte] = move
        return move

    def count(self, word: bytes) -> int:
        moves, state, n, width, bias = self.moves, 0, 0, 2 * self.BIAS, self.BIAS
        for byte in word:
            move = moves.get(state * 256 + byte)
            if move is None:
                move = self.compile(state, byte)
            state, change = divmod(move, width)
            n += change - bias
        if len(self.states) > self.max_states:
            self.reset()
        return n

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        parts, owner, size = [], [], 0
        for i, text in enumerate(texts):
            pieces = [text or ""]
            for special in self.special:
                split = [p.split(special) for p in pieces]
                out[i] += sum(len(p) - 1 for p in split)
                pieces = [x for p in split for x in p]
            for piece in pieces:
                if piece:
                    parts.append(piece)
                    owner.append(i)
                    size += len(piece) + 1
            if size > BLOCK_CHARS:
                self._add(parts, owner, out)
                parts, owner, size = [], [], 0
        if parts:
            self._add(parts, owner, out)
        return out

    def _add(self, parts: list[str], owner: list[int], out: np.ndarray) -> None:
        joined = "\0".join(parts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        start = word_starts(symbols(codes, ends))
        start[ends] = True  # the place after a text is cut off as a word of its own
        raw = joined.encode()
        at = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000), out=at[1:])
        first = np.flatnonzero(start)
        offsets = np.r_[at[first], at[-1]]
        words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = pc.dictionary_encode(words)
        tokens = np.array([self.count(w) for w in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        tokens[np.searchsorted(first, ends)] = 0
        text = np.searchsorted(ends, first)
        np.add.at(out, owner, np.bincount(text, weights=tokens, minlength=len(parts)).astype(np.int64))


@lru_cache(maxsize=2)
def transducer(name: str) -> ByteTransducer:
    import public_tokenizers

    return ByteTransducer(public_tokenizers.path(name))


def with_token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of ``text``."""
    source = docs.drop(name)
    schema = StructType(source.schema.fields[:]).add(name, "long")

    def run(batches):
        machine = transducer(tokenizer)
        for batch in batches:
            counts = machine.counts(batch[text].to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts)], [*batch.schema.names, name])

    return source.mapInArrow(run, schema)
