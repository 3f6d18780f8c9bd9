"""Packing of tokenised documents into fixed windows by Karmarkar-Karp multiway differencing.

``pieces`` encodes documents and cuts them: every full window of a document is a piece of its own,
the rest is cut evenly into pieces of at most ``max_piece`` ids. ``pack`` places pieces: a piece as
long as a window fills one, the others are dealt into groups of about ``group_windows`` windows,
and each group is partitioned by multiway differencing. ``sequences`` builds the padded windows.

Defined results: a null text counts as empty, so its document is the end id alone; repeated rows
are packed as often as they occur; ties between equal sizes fall to the piece stored first; an empty
table gives no pieces; further columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

CAPACITY = 4096
END_ID = 2
MAX_PIECE = 512
GROUP_WINDOWS = 128
#: Bytes of text that are encoded at a time, unless one text has more.
TEXT_AT_ONCE = 4 << 20

# Fixed values of the tokenizer's format: its byte alphabet, its split pattern, white space.
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
WHITE = "\t-\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PART = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte."""
    letters = {chr(b): b for b in PLAIN_BYTES}
    others = [b for b in range(256) if b not in PLAIN_BYTES]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def unassigned() -> list[int]:
    """Code points that Python's tables do not know, in the planes where characters are assigned."""
    import unicodedata

    planes = [*range(0x40000), *range(0xE0000, 0xE1000)]
    return [c for c in planes if unicodedata.category(chr(c)) == "Cn"]


def otherwise_normalised(normalize) -> list[int]:
    """Code points that ``normalize``, the tokenizer's own, lower-cases, composes or orders otherwise than Python."""
    import unicodedata

    def differs(text: str) -> bool:
        return normalize(text) != unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    out = []
    for c in map(chr, [*range(0x300, 0xD800), *range(0xF900, 0x20000), 0xE0000]):
        mark = unicodedata.combining(c)
        if mark and (differs(f"a{c}\u0334") or differs(f"a\u0345{c}")) or (mark or c.lower() != c or unicodedata.decomposition(c)) and differs(c):
            out.append(ord(c))
    return out


def one_of(codes: list[int]) -> re.Pattern:
    """A pattern for one of the code points, given in ascending order."""
    starts = [c for c, before in zip(codes, [-2, *codes]) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], -2]) if after != c + 1]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends)) + "]")


class WordEncoder:
    """Ids of texts by a BPE file with word ends, one encoding per distinct word of a batch.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    words in turn. Distinct words are encoded in one call of a merge table built from the same file:
    the word end is a newline byte, and the letters that carry it come before all merges. Texts that
    contain one of the file's special strings, or a character that Python's tables know otherwise than the
    tokenizer's, or not at all, go to the file's own tokenizer.
    """

    PART_END, WORD_END = "\n", "\r"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        suffix = spec["model"]["end_of_word_suffix"]
        letters = byte_letters()

        def raw(token: str) -> bytes:
            ended = token.endswith(suffix)
            return bytes(letters[c] for c in token[: -len(suffix) if ended else None]) + b"\n" * ended

        singles = sorted(letters, key=letters.get)
        tokens = [*singles, *(c + suffix for c in singles), *("".join(pair) for pair in spec["model"]["merges"])]
        vocab, ranks, ids = spec["model"]["vocab"], {}, []
        for token in tokens:
            key = raw(token)
            if key not in ranks:
                ranks[key] = len(ids)
                ids.append(-2 if key == b"\r" else -1 if key == b"\n" else vocab[token])
        self.ids = np.array(ids, np.int64)
        self.merges = tiktoken.Encoding(
            "words", pat_str=r"[^\n\r]*\n|\r", mergeable_ranks=ranks, special_tokens={}
        )
        self.unknown = one_of(sorted({*unassigned(), *otherwise_normalised(self.whole.normalizer.normalize_str)}))
        self.part = regex.compile(PART)
        self.white = regex.compile(f"[{WHITE}--[\r]]", regex.V1)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each word has."""
        import unicodedata

        text = unicodedata.normalize("NFC", "\r".join(words) + "\r")
        text = self.white.sub("\n", text).replace("Σ", "σ").lower()
        text = self.part.sub(r"\g<0>\n", text)
        out = self.ids[np.array(self.merges.encode_ordinary(text), np.int64)]
        ends = np.flatnonzero(out == -2)
        kept = out >= 0
        before = np.cumsum(kept)[ends] if len(ends) else np.zeros(0, np.int64)
        return out[kept].astype("<u4"), np.diff(before, prepend=0)

    def _unsure(self, text: str) -> bool:
        """Whether a text has a character of ``unknown``, all of which lie beyond Latin-1."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.unknown.search(text) is not None
        return False

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        texts = [t or "" for t in texts]
        odd = {i for i, t in enumerate(texts) if any(s in t for s in self.special) or self._unsure(t)}
        plain = pa.array(["" if i in odd else t for i, t in enumerate(texts)], pa.large_string())
        lists = pc.ascii_split_whitespace(plain)
        flat = pc.dictionary_encode(lists.flatten())
        words = flat.dictionary.to_pylist()
        if "" in words:  # leading or trailing white space
            words[words.index("")] = "\n"
        ids, sizes = self.words(words) if words else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        starts = np.cumsum(sizes) - sizes
        at = flat.indices.to_numpy(zero_copy_only=False)
        offsets, out = lists.offsets.to_numpy(), []
        for i in range(len(texts)):
            if i in odd:
                out.append(np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, "<u4"))
                continue
            own = at[offsets[i] : offsets[i + 1]]
            n = sizes[own]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out.append(ids[np.arange(total) + np.repeat(starts[own] - (ends - n), n)] if total else ids[:0])
        return out


@lru_cache(maxsize=2)
def encoder(name: str) -> WordEncoder:
    import public_tokenizers

    return WordEncoder(public_tokenizers.path(name))


def cuts(total: int, capacity: int, max_piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then even parts of the rest."""
    full = total // capacity
    out = [(i * capacity, capacity) for i in range(full)]
    rest = total - full * capacity
    parts = -(-rest // max_piece)
    for i in range(parts):
        first, last = rest * i // parts, rest * (i + 1) // parts
        out.append((full * capacity + first, last - first))
    return out


def parts_of(batch: pa.RecordBatch, most: int = TEXT_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive parts whose texts have at most ``most`` bytes together, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def pieces(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID, capacity: int = CAPACITY,
    max_piece: int = MAX_PIECE, with_ids: bool = True,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens[, ids]) of documents (doc_id, text)."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"

    def run(batches):
        words = encoder(tokenizer)
        # what encoding holds is many times its texts, and every core has a worker of its own
        for batch in (part for whole in batches for part in parts_of(whole)):
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), words.encode(batch["text"].to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start, length in cuts(len(ids), capacity, max_piece):
                    part = ids[start : start + length]
                    rows.append((doc_id, start, length, zlib.crc32(part.tobytes()), len(ids), *([part] * with_ids)))
            columns = list(zip(*rows)) or [()] * (5 + with_ids)
            types = [batch.schema.field("doc_id").type, *[pa.int64()] * 4, *[pa.list_(pa.int32())] * with_ids]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else "")
    )


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``k`` parts of near-equal sum.

    Each size begins as a partition into k parts of which one is filled. The two partitions with the
    widest gaps are merged, the fullest parts of one with the emptiest of the other, until one is left.
    A partition keeps only its filled parts, in falling order; the parts not listed are its lowest.
    """
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        free = k - len(a)
        if len(b) <= free:
            merged = a + b
        else:  # the fullest parts of b join the emptiest of a
            merged, over = a[: k - len(b)] + b[:free], b[free:]
            for (x, own), (y, more) in zip(reversed(a[k - len(b) :]), over):
                merged.append((x + y, own + more))
        merged.sort(key=lambda part: -part[0])
        if len(merged) == k and merged[-1][0]:
            low = merged[-1][0]
            merged = [(x - low, own) for x, own in merged]
        heapq.heappush(heap, (-(merged[0][0] - (merged[-1][0] if len(merged) == k else 0)), count, merged))
        count += 1
    return [own for _, own in heap[0][2]] if heap else []


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Parts of at most ``capacity``: the window count rises until differencing exceeds it nowhere."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = differencing(sizes, k)
        if max(sum(sizes[i] for i in part) for part in parts) <= capacity:
            return parts
        k += 1


def pack(placed: DataFrame, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of at most ``capacity``.

    The pieces are stored first, so that the size of all of them is known and a lost task meets the
    same numbering. Groups are dealt by that numbering, not by a column, so copies do not meet in one.
    """
    names = placed.columns
    stored = materialise(placed.select("*", F.monotonically_increasing_id().alias("_row")))
    short = stored.where(F.col("length") < capacity)
    total = short.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * group_windows)))
    dealt = short.select("_row", "length", F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_group"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row")
        rows, sizes = pdf["_row"].to_numpy(), pdf["length"].to_numpy()
        group, out = int(pdf["_group"].iat[0]), []
        for n, part in enumerate(windows(sizes.tolist(), capacity)):
            ends = np.cumsum(sizes[part])
            out.append(pd.DataFrame({"_row": rows[part], "_window": n, "offset": ends - sizes[part]}))
        done = pd.concat(out)
        # even ids: windows of groups; odd ids: pieces that fill a window alone
        done["sequence_id"] = (done["_window"] * groups + group) * 2
        return done[["_row", "sequence_id", "offset"]]

    places = dealt.groupBy("_group").applyInPandas(run, "_row long, sequence_id long, offset long")
    long = stored.where(F.col("length") >= capacity).select(
        *names, (F.col("_row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return short.join(places, "_row").select(*names, "sequence_id", "offset").unionByName(long)


def sequences(packed: DataFrame, pad_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, n_tokens, ids): the ids of each window's pieces in order, padded to ``capacity``
    unless their number is a power of two. ``packed`` has a column ids; a group is one window."""
    joined = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"),
    )
    short = (F.col("n_tokens") < capacity) & (F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) != 0)
    gap = F.when(short, capacity - F.col("n_tokens")).otherwise(0).cast("int")
    return joined.withColumn("ids", F.concat("ids", F.array_repeat(F.lit(pad_id), gap)))
