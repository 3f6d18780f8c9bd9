"""SentencePiece encoding and decoding over a lattice of pieces.

Texts are escaped (a space is ``▁``, and one is put in front) and cut into words, where no piece crosses
a cut: before a space mark, and around characters that occur in no longer piece. Every substring of a word that is
in the piece table is an edge of the lattice, edges are grouped by word, and a fold picks the path.

For a unigram model the path is the one of highest total score (``viterbi``). In a merge model (BPE) the
scores are merge ranks, not log-probabilities, and the best total is another path than the model's; there
the fold merges, again and again, the edge of best score that spans two adjacent symbols (``merges``).
Characters without a piece become the ids of their UTF-8 bytes.

There are two forms. ``encode`` is one pass over the texts without a shuffle: each task keeps the ids of the words
it has met, up to ``KNOWN`` words, and makes the lattice of many new words at a time in arrays (``Lattice``). A word that several
tasks meet is folded in each. ``encode_rows`` is made of rows alone, for any path: words are counted once over the whole table, an equi-join of all their substrings with
the piece table finds the edges, a higher-order fold picks the path, and the ids are joined back to the texts; that
moves several times the text.

Defined results: a null text has null ids, an empty one an empty array; repeated rows are encoded each;
equal scores go to the leftmost edge; an empty table gives no rows; further columns are kept, except
those with the names of results.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ..session import materialise

SPACE = "▁"
#: Words whose ids a task keeps; beyond them it starts anew.
KNOWN = 1 << 18
#: Bytes of text that are encoded at a time, unless one text has more.
TEXT_AT_ONCE = 1 << 20
#: Code points of words whose lattice is made at a time, unless one word has more.
POINTS_AT_ONCE = 1 << 18
#: Length from which a word is folded alone.
LONG = 512


@dataclass(frozen=True)
class Pieces:
    """A model's piece table: (piece, id, score), and the ids of the 256 bytes."""

    rows: list[tuple[str, int, float]]
    byte_ids: list[int]
    texts: list[str]  # by id; bytes as they are written in the table
    longest: int

    @classmethod
    def load(cls, name: str = "piece_bpe_32k.model") -> "Pieces":
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        rows, byte_ids, texts = [], [0] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            texts.append("" if model.is_control(i) or model.is_unknown(i) else piece)
            if model.is_byte(i):
                byte_ids[int(piece[3:-1], 16)] = i
            elif texts[-1]:
                rows.append((piece, i, model.get_score(i)))
        return cls(rows, byte_ids, texts, max((len(r[0]) for r in rows), default=1))

    def joined(self) -> list[str]:
        """The characters that longer pieces hold, without the space mark."""
        return sorted({c for piece, _, _ in self.rows if len(piece) > 1 for c in piece} - {SPACE})

    def word_pattern(self) -> str:
        """A word: space marks and what follows of characters that longer pieces hold, or one other character."""
        joined = self.joined()
        near = "".join(re.escape(c) if c.isascii() else c for c in joined if c < "\u0100")
        far = "".join(c for c in joined if c >= "\u0100")
        # runs of Latin-1 by a class of bits alone; the many characters of other scripts are a chain of tests, tried where
        # a run ends, for such characters and not for a space mark
        runs = [f"[{near}]++"] * bool(near) + [f"[[^\\x00-\\xff{SPACE}]&&[{far}]]++"] * bool(far)
        letters = f"(?:{'|'.join(runs or ['(?!)'])})"
        return f"{SPACE}++{letters}*+|{letters}++|(?s)."

    def python_pattern(self) -> re.Pattern:
        """The same for Python, whose classes are looked up in tables."""
        letters = f"[{''.join(map(re.escape, self.joined()))}]" if self.joined() else "(?!)"
        return re.compile(f"{SPACE}+(?:{letters})*|(?:{letters})+|.", re.DOTALL)


class Lattice:
    """Lattices of many words in arrays, and their folds by best-scored merges.

    A substring is found by the steps of a trie over the piece table, all places of all words at once. An edge is a place in
    the words, one behind the other, and a length; ``spans`` has its node, or 0 where there is none."""

    NONE = 1 << 30  # rank of what is no piece

    def __init__(self, pieces: Pieces):
        nodes: dict[int, int] = {}
        ends = []
        for piece, _, _ in pieces.rows:
            node = 0
            for c in piece:
                node = nodes.setdefault(node << 21 | ord(c), len(nodes) + 1)
            ends.append(node)
        self.longest = max(pieces.longest, 2)
        self.steps = np.array(sorted(nodes), np.int64)
        self.to = np.array([nodes[step] for step in self.steps.tolist()], np.int64)
        self.ids = np.full(len(nodes) + 1, -1, np.int32)
        self.ranks = np.full(len(nodes) + 1, self.NONE, np.int64)
        self.ids[ends] = [i for _, i, _ in pieces.rows]
        self.ranks[ends] = np.unique([-score for _, _, score in pieces.rows], return_inverse=True)[1]
        self.byte_ids = np.array(pieces.byte_ids, np.int32)

    def spans(self, points: np.ndarray, left: np.ndarray) -> np.ndarray:
        """By length less one and place, the node of the substring; ``left`` code points are left in the word at a place."""
        found = np.zeros((self.longest, len(points)), np.int32)
        at, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for k in range(self.longest if len(self.steps) else 0):
            steps = node << 21 | points[at + k]
            i = np.minimum(np.searchsorted(self.steps, steps), len(self.steps) - 1)
            there = self.steps[i] == steps
            at, node = at[there], self.to[i[there]]
            found[k, at] = node
            more = left[at] > k + 1
            at, node = at[more], node[more]
        return found

    def fold(self, spans: np.ndarray, left: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each place, the length of the symbol that starts there, or 0.

        A key is the rank and the place of the edge that spans a symbol and the next one. Each round takes the least key of every
        word, so the best score, or the leftmost of equal ones; a long word alone takes them from a heap."""
        size, before = np.ones(len(left), np.int64), np.arange(-1, len(left) - 1)
        before[starts] = -1

        def key(at: np.ndarray) -> np.ndarray:
            inside = size[at] < left[at]
            both = size[at] + np.where(inside, size[np.where(inside, at + size[at], at)], 0)
            rank = self.ranks[spans[np.minimum(both, self.longest) - 1, at]]
            return np.where(inside & (both <= self.longest), rank, self.NONE) << 32 | at

        keys = key(np.arange(len(left)))

        def merge(at: np.ndarray) -> np.ndarray:
            """Merges the symbols at ``at``, of different words, with the next ones; returns the places with a new key."""
            second = at + size[at]
            size[at] += size[second]
            size[second] = 0
            keys[second] = self.NONE << 32
            follows = size[at] < left[at]
            before[(at + size[at])[follows]] = at[follows]
            changed = np.concatenate([at, before[at][before[at] >= 0]])
            keys[changed] = key(changed)
            return changed

        def places(best: np.ndarray) -> np.ndarray:
            return best[best < self.NONE << 32] & 0xFFFFFFFF

        if len(starts) > 1 or len(left) < LONG:
            while len(at := places(np.minimum.reduceat(keys, starts))):
                merge(at)
            return size
        heap = keys[keys < self.NONE << 32].tolist()
        heapq.heapify(heap)
        while heap:
            best = heapq.heappop(heap)
            at = best & 0xFFFFFFFF
            if keys[at] == best:
                for k in keys[merge(np.array([at]))].tolist():
                    if k < self.NONE << 32:
                        heapq.heappush(heap, k)
        return size

    def some(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(points))
        spans = self.spans(points, left)
        size = self.fold(spans, left, ends - lengths)
        at = np.flatnonzero(size)
        ids = self.ids[spans[size[at] - 1, at]]
        lacking = np.flatnonzero(ids < 0)
        takes = np.ones(len(at), np.int64)
        as_bytes = [chr(points[at[i]]).encode() for i in lacking]
        takes[lacking] = [len(b) for b in as_bytes]
        out = np.repeat(ids, takes)
        for place, b in zip((np.cumsum(takes) - takes)[lacking].tolist(), as_bytes):
            out[place : place + len(b)] = self.byte_ids[list(b)]
        per_place = np.zeros(len(points), np.int64)
        per_place[at] = takes
        return out, np.add.reduceat(per_place, ends - lengths)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the words, which are not empty, and for each word where its ids begin and how many they are."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")  # words of one length take about as many rounds
        total = np.cumsum(lengths[order])
        ids, counts, first = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while first < len(order):
            until = total[first] - lengths[order[first]] + POINTS_AT_ONCE
            last = max(first + 1, int(np.searchsorted(total, until, "right")))
            if lengths[order[last - 1]] >= LONG:  # the long ones one by one
                last = max(first + 1, int(np.searchsorted(lengths[order], LONG)))
            some, n = self.some([words[i] for i in order[first:last].tolist()], lengths[order[first:last]])
            ids.append(some)
            counts.append(n)
            first = last
        sorted_counts = np.concatenate(counts)
        starts, own = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[order], own[order] = np.cumsum(sorted_counts) - sorted_counts, sorted_counts
        return np.concatenate(ids), starts, own


class TextEncoder:
    """Ids of texts, with the ids of the words met so far."""

    def __init__(self, pieces: Pieces, lattice: Lattice, most: int = KNOWN):
        self.lattice, self.most, self.pattern = lattice, most, pieces.python_pattern()
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.forget()

    def forget(self) -> None:
        self.numbers.clear()
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text ends."""
        if len(self.numbers) > self.most:
            self.forget()
        cut, numbers, ends = self.pattern.findall, [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):  # the words of one text at a time
            words = cut(SPACE + text.replace(" ", SPACE)) if text else []
            numbers.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
            ends[i] = len(words)
        new = list(itertools.islice(self.numbers, len(self.counts), None))
        ids, starts, counts = self.lattice.words(new)
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        placed = np.concatenate(numbers)
        takes = self.counts[placed]
        after = np.concatenate([[0], np.cumsum(takes)])
        out = self.ids[np.repeat(self.starts[placed] - after[:-1], takes) + np.arange(after[-1])]
        return out, after[np.cumsum(ends)]


def slices(batch: pa.RecordBatch, text: str, at_once: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``at_once`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total, first = np.cumsum(sizes, dtype=np.int64), 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(total, total[first] - sizes[first] + at_once, "right")))
        yield batch.slice(first, last - first)
        first = last


def literal_array(values: list, kind: str) -> Column:
    """An array constant, looked up by place."""
    return F.split(F.lit("\x01".join(map(str, values))), "\x01").cast(f"array<{kind}>")


def escaped(text: Column) -> Column:
    return F.when(text == "", F.lit("")).otherwise(F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE))))


def edges(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, n, edges): edges are (s, e, id, score) between character places, of all pieces in the word."""
    spark = words.sparkSession
    table = F.broadcast(spark.createDataFrame(pieces.rows, "piece string, id int, score double"))  # one model's pieces
    placed = words.select("word", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("s"))
    ends = F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.char_length("word") - F.col("s") + 1))
    parts = placed.select("word", "s", F.explode(ends).alias("k")).select(
        "word", (F.col("s") - 1).alias("s"), (F.col("s") - 1 + F.col("k")).alias("e"), F.substring("word", F.col("s"), F.col("k")).alias("piece")
    )
    found = parts.join(table, "piece", "left").where(F.col("id").isNotNull() | (F.col("e") == F.col("s") + 1))
    grouped = found.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("s", "e", "id", "score"))).alias("edges"))
    return grouped.withColumn("n", F.char_length("word"))


def _spans(to: Column, x: Column) -> Column:
    """Whether edge ``x`` spans two adjacent symbols; ``to`` has the end of the symbol that starts at each place, or -1."""
    middle = F.get(to, x["s"])
    return (middle > 0) & (middle < x["e"]) & (F.get(to, middle) == x["e"])


def _merged(to: Column, x: Column) -> Column:
    return F.transform(to, lambda v, i: F.when(i == x["s"], x["e"]).when((i > x["s"]) & (i < x["e"]), F.lit(-1)).otherwise(v))


def merges(edge_list: Column, n: Column) -> Column:
    """For each place, the end of the symbol that starts there, or -1: best-scored merges first.

    A piece is made after the pieces it is merged from, so its score is below theirs, and one fold over the edges in
    the order of scores meets every merge when its turn has come. A piece that is put together from other parts than
    those it was made of may come too late; where an edge is still open at the end, the word is merged step by step.
    """
    longer = F.filter(edge_list, lambda x: x["e"] > x["s"] + 1)
    ordered = F.array_sort(F.transform(longer, lambda x: F.struct((-x["score"]).alias("rank"), x["s"].alias("s"), x["e"].alias("e"))))
    start = F.transform(F.sequence(F.lit(0), n - 1), lambda i: i + 1)
    swept = F.aggregate(ordered, start, lambda to, x: F.when(_spans(to, x), _merged(to, x)).otherwise(to))

    def settled(to: Column) -> Column:
        return F.when(F.exists(longer, lambda x: _spans(to, x)), merges_stepwise(edge_list, n)).otherwise(to)

    return F.get(F.transform(F.array(swept), settled), F.lit(0))


def merges_stepwise(edge_list: Column, n: Column) -> Column:
    """The same, looking for the best merge of all at each step."""
    longer = F.filter(edge_list, lambda x: x["e"] > x["s"] + 1)
    start = F.transform(F.sequence(F.lit(0), n - 1), lambda i: i + 1)

    def step(state: Column, _: Column) -> Column:
        to, open_ = state["to"], state["open"]
        best = F.aggregate(
            F.filter(open_, lambda x: _spans(to, x)), F.lit(None).cast("struct<s:int,e:int,score:double>"),
            lambda a, x: F.when(a.isNull() | (x["score"] > a["score"]), x).otherwise(a),
        )
        merged = F.transform(
            F.array(best),
            lambda b: F.when(b.isNotNull(), F.struct(_merged(to, b).alias("to"), open_.alias("open")))
            .otherwise(F.struct(to.alias("to"), F.slice(open_, 1, 0).alias("open"))),  # nothing is left to merge
        )
        return F.get(merged, F.lit(0))

    first = F.struct(start.alias("to"), F.transform(longer, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["score"].alias("score"))).alias("open"))
    return F.aggregate(F.sequence(F.lit(1), n), first, step, lambda s: s["to"])


def viterbi(edge_list: Column, n: Column, unknown: float = -100.0) -> Column:
    """For each place, the end of the symbol of the best path that starts there, or -1."""
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("from")))

    def step(best: Column, e: Column) -> Column:
        ending = F.filter(edge_list, lambda x: x["e"] == e)
        ways = F.transform(
            ending, lambda x: F.struct((F.get(best, x["s"])["score"] + F.coalesce(x["score"], F.lit(unknown))).alias("score"), x["s"].alias("from"))
        )
        top = F.aggregate(
            ways, F.lit(None).cast("struct<score:double,from:int>"),
            lambda a, x: F.when(a.isNull() | (x["score"] > a["score"]), x).otherwise(a),
        )
        return F.concat(best, F.array(top))

    best = F.aggregate(F.sequence(F.lit(1), n), first, step)

    def back(state: Column, p: Column) -> Column:
        at = F.get(state["best"], p)["from"]
        taken = F.struct(
            state["best"].alias("best"), at.alias("at"),
            F.transform(state["to"], lambda v, i: F.when(i == at, p).otherwise(v)).alias("to"),
        )
        return F.when(state["at"] == p, taken).otherwise(state)

    begin = F.struct(best.alias("best"), n.alias("at"), F.array_repeat(F.lit(-1), n).alias("to"))
    return F.aggregate(F.sequence(n, F.lit(1), F.lit(-1)), begin, back, lambda s: s["to"])


def word_ids(words: DataFrame, pieces: Pieces, path=merges) -> DataFrame:
    """(word, ids) of distinct words."""
    chosen = edges(words, pieces)
    byte_ids = literal_array(pieces.byte_ids, "int")

    def ids(x: Column) -> Column:
        letter = F.hex(F.encode(F.substring(F.col("word"), x["s"] + 1, F.lit(1)), "UTF-8"))
        single = F.transform(
            F.sequence(F.lit(1), F.length(letter) - 1, F.lit(2)),
            lambda i: F.get(byte_ids, F.conv(F.substring(letter, i, F.lit(2)), 16, 10).cast("int")),
        )
        return F.when(x["id"].isNotNull(), F.array(x["id"])).otherwise(single)

    def along(to: Column) -> Column:
        return F.flatten(F.transform(F.filter("edges", lambda x: F.get(to, x["s"]) == x["e"]), ids))

    # in an array, so that the path is found once and not for each edge that asks for it
    paths = F.array(path(F.col("edges"), F.col("n")))
    return chosen.select("word", F.get(F.transform(paths, along), F.lit(0)).alias("ids"))


def placed_words(texts: DataFrame, at_once: int = 100_000) -> DataFrame:
    """(_row, word, places) of ``texts`` (_row, words): a row per distinct word of a text."""

    def put_out(rows: list, words: list, places: list) -> pa.RecordBatch:
        columns = [pa.array(rows, pa.int64()), pa.array(words, pa.string()), pa.array(places, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, ["_row", "word", "places"])

    def run(batches):
        rows, words, places = [], [], []
        for batch in batches:
            for i in range(batch.num_rows):  # one text in Python at a time
                own: dict[str, list[int]] = {}
                for k, word in enumerate(batch["words"][i].as_py()):
                    own.setdefault(word, []).append(k)
                rows += [batch["_row"][i].as_py()] * len(own)
                words += own.keys()
                places += own.values()
                if len(rows) >= at_once:
                    yield put_out(rows, words, places)
                    rows, words, places = [], [], []
        yield put_out(rows, words, places)

    return texts.select("_row", "words").mapInArrow(run, "_row long, word string, places array<int>")


def encode(texts: DataFrame, pieces: Pieces, text: str = "text", name: str = "ids") -> DataFrame:
    """``texts`` with the ids of ``text`` in a merge model, in one pass over the texts."""
    kept = texts.drop(name)
    lattice = Lattice(pieces)

    def run(batches):
        encoder = TextEncoder(pieces, lattice)
        for batch in batches:
            for part in slices(batch, text, TEXT_AT_ONCE):
                column = part.column(text)
                ids, ends = encoder.texts(column.to_pylist())
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()), mask=column.is_null())
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, name])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(name, ArrayType(IntegerType()))]))


def encode_rows(texts: DataFrame, pieces: Pieces, text: str = "text", name: str = "ids", path=merges) -> DataFrame:
    """``texts`` with the ids of ``text``, by ``path``, with the lattice of all words in rows.

    A row is told from others by a number given when it is first stored."""
    source = materialise(texts.drop(name).withColumn("_row", F.monotonically_increasing_id()))
    found = F.regexp_extract_all(escaped(F.col(text)), F.lit(pieces.word_pattern()), F.lit(0))
    cut = source.where(F.col(text).isNotNull()).select("_row", found.alias("words"))
    occurring = placed_words(cut)
    # the shuffle that makes words distinct serves the grouping of their edges as well
    known = materialise(word_ids(cut.select(F.explode("words").alias("word")).distinct(), pieces, path))
    joined = (
        occurring.join(known, "word").groupBy("_row").agg(F.collect_list(F.struct("places", "ids")).alias("_parts"))  # one text's words
    )
    spread = F.flatten(F.transform("_parts", lambda p: F.transform(p["places"], lambda i: F.struct(i.alias("i"), p["ids"].alias("ids")))))
    flat = joined.select("_row", F.flatten(F.transform(F.sort_array(spread), lambda p: p["ids"])).alias(name))
    empty = F.when(F.col(text).isNotNull(), F.array().cast("array<int>"))
    return source.join(flat, "_row", "left").withColumn(name, F.coalesce(name, empty)).drop("_row")


def decode(encoded: DataFrame, pieces: Pieces, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of ``ids``; ids outside the model are left out. Bytes are put together
    as they follow each other, so a character of several bytes is whole again."""
    written = [p.encode().hex() if len(p) != 6 or p[:3] != "<0x" else p[3:5] for p in pieces.texts]
    table = literal_array(written, "string")
    raw = F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
    text = F.replace(F.decode(raw, "UTF-8"), F.lit(SPACE), F.lit(" "))
    return encoded.withColumn(name, F.when(text.startswith(" "), F.substring(text, F.lit(2), F.char_length(text))).otherwise(text))
