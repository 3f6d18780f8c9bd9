"""Divergence of the sources of a language, from exact smoothed term frequencies.

The index is built in one pass in memory. A task counts the terms of its documents in a block, for each
(language, source), and the documents of each term; once the block holds ``BLOCK`` postings it is spilled as a
run, sorted by hash shard and term and cut into short chunks. The runs of a shard meet in one task, in the
order of their chunks' first terms. There a heap holds one cursor per open chunk; whatever lies before the
next chunk's first term is merged and put out, so a task holds a chunk of each run, not the shard.

The divergence of two sources is a sum over all kept terms, most of which a source has never. It is made
of parts that need no such terms: a histogram of the counts of each source gives the sum against a count of
zero, and the terms that both have are corrected in a stream, summed per task in matrices of bounded size.

Defined results: null text, language and source are read as ''; every (language, source) that occurs has its
rows, even without terms; a language without kept terms gives pairs of value 0; a source without others in
its language gives none; repeated rows are documents of their own; ties go to the smaller item in UTF-8;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
#: Postings of a block, terms of a chunk, shards for each shuffle partition, cells of the correction matrices.
BLOCK = 1_000_000
CHUNK = 128
SHARDS_PER_PARTITION = 16
CELLS = 1 << 21
#: Pairs of sources corrected at once.
STEP = 1 << 18

#: Letters are A-Z, lower-cased, a-z and every byte of a longer UTF-8 sequence; all else separates.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

RUNS = "shard int, head binary, keys array<binary>, docs array<long>, sizes array<int>, sources array<string>, counts array<long>"
MERGED = "lang string, term string, docs long, total long, sources array<string>, counts array<long>"


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class Block:
    """Postings in memory: occurrences per (language, source), documents per language."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, lang: str, source: str, found: list[bytes]) -> None:
        counts, docs = self.counts[lang, source], self.docs[lang]
        before = len(counts) + len(docs)
        counts.update(found)
        docs.update(set(found))
        self.size += len(counts) + len(docs) - before

    def run(self, shards: int, chunk: int) -> pa.RecordBatch:
        """Sorted by shard and key (the language, a zero byte, the term), in rows of at most ``chunk`` keys of one shard."""
        by_lang: dict[str, list[tuple[str, Counter]]] = defaultdict(list)
        for (lang, source), counts in self.counts.items():
            by_lang[lang].append((source, counts))
        names = {source: i for i, source in enumerate(sorted({s for _, s in self.counts}))}
        keys: list[bytes] = []
        parts = []
        for lang, docs in self.docs.items():
            vocabulary = pa.array(list(docs), pa.binary())
            for source, counts in by_lang[lang]:
                at = pc.index_in(pa.array(list(counts), pa.binary()), value_set=vocabulary).to_numpy() + len(keys)
                parts.append((at, np.full(len(at), names[source]), np.fromiter(counts.values(), np.int64, len(at))))
            prefix = lang.encode() + b"\0"
            keys += [prefix + term for term in docs]
        in_docs = np.concatenate([np.fromiter(d.values(), np.int64, len(d)) for d in self.docs.values()])
        term, source, count = (np.concatenate(x) for x in zip(*parts))
        shard = np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % shards
        all_keys = pa.array(keys, pa.binary())
        order = pc.sort_indices(all_keys).to_numpy()
        order = order[np.argsort(shard[order], kind="stable")]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        term, shard = place[term], shard[order]
        by_term = np.argsort(term, kind="stable")
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        within = np.arange(len(shard)) - np.repeat(first, np.diff(np.r_[first, len(shard)]))
        starts = np.flatnonzero(within % chunk == 0)
        sizes = np.bincount(term, minlength=len(keys))
        limits = np.r_[starts, len(keys)]
        postings = np.r_[0, np.cumsum(sizes)][limits]
        all_keys = all_keys.take(pa.array(order))
        rows = pa.array(limits, pa.int32())
        columns = [
            pa.array(shard[starts], pa.int32()),
            all_keys.take(pa.array(starts)),
            pa.ListArray.from_arrays(rows, all_keys),
            pa.ListArray.from_arrays(rows, pa.array(in_docs[order])),
            pa.ListArray.from_arrays(rows, pa.array(sizes, pa.int32())),
            pa.ListArray.from_arrays(pa.array(postings, pa.int32()), pa.array(list(names), pa.string()).take(pa.array(source[by_term]))),
            pa.ListArray.from_arrays(pa.array(postings, pa.int32()), pa.array(count[by_term])),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "head", "keys", "docs", "sizes", "sources", "counts"])


def runs(docs: DataFrame, shards: int, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """The spilled runs of ``docs`` (lang, source, text), as chunks."""

    def build(batches):
        held = Block()
        for batch in batches:
            langs, sources = batch["lang"].to_pylist(), batch["source"].to_pylist()
            for lang, source, text in zip(langs, sources, batch["text"].cast(pa.binary()).to_pylist()):
                held.add(lang, source, terms(text))
                if held.size >= block:
                    yield held.run(shards, chunk)
                    held = Block()
        if held.size:
            yield held.run(shards, chunk)

    return docs.select("lang", "source", "text").mapInArrow(build, RUNS)


class Merger:
    """Merges the chunks of one shard after another; they come in the order of their first keys."""

    def __init__(self, min_docs: int) -> None:
        self.heap: list[tuple] = []
        self.min_docs = min_docs
        self.shard: int | None = None
        self.pushed = 0
        self.key: bytes | None = None
        self.docs = 0
        self.found: list[tuple] = []
        self.out: list[tuple] = []

    def push(self, shard: int, keys: list, docs: list, sizes: list, sources: list, counts: list) -> None:
        if shard != self.shard:
            self.drain()
            self.shard = shard
        else:
            self.drain(keys[0])
        ends = list(accumulate(sizes))
        entries = zip(keys, docs, [0, *ends], ends)
        self.pushed += 1
        heapq.heappush(self.heap, (keys[0], self.pushed, next(entries), entries, sources, counts))

    def drain(self, key: bytes | None = None) -> None:
        """Merges all entries before ``key``, or all."""
        heap = self.heap
        while heap and (key is None or heap[0][0] < key):
            at, pushed, (_, n, a, b), entries, sources, counts = heap[0]
            if at != self.key:
                self.flush()
                self.key = at
            self.docs += n
            self.found.append((sources, counts, a, b))
            following = next(entries, None)
            if following is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (following[0], pushed, following, entries, sources, counts))

    def flush(self) -> None:
        """The current term is over: it is put out if it is kept."""
        if self.docs >= self.min_docs:
            total: dict[str, int] = defaultdict(int)
            for sources, counts, a, b in self.found:
                for source, n in zip(sources[a:b], counts[a:b]):
                    total[source] += n
            lang, _, term = self.key.rpartition(b"\0")
            sources = sorted(total)
            self.out.append((lang.decode(), term.decode(), self.docs, sum(total.values()), sources, [total[s] for s in sources]))
        self.docs, self.found = 0, []

    def merged(self) -> pa.RecordBatch:
        names = ["lang", "term", "docs", "total", "sources", "counts"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
        columns = [pa.array([r[i] for r in self.out], kind) for i, kind in enumerate(kinds)]
        self.out = []
        return pa.RecordBatch.from_arrays(columns, names)


def merge(spilled: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, docs, total, sources, counts) of the terms in at least ``min_docs`` documents of a language."""

    def run(batches):
        merger = Merger(min_docs)
        for batch in batches:
            for shard, _, *chunk in zip(*(c.to_pylist() for c in batch.columns)):
                merger.push(shard, *chunk)
                if len(merger.out) >= 4096:
                    yield merger.merged()
        merger.drain()
        merger.flush()
        yield merger.merged()

    return spilled.repartition("shard").sortWithinPartitions("shard", "head").mapInArrow(run, MERGED)


def named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """Exact frequencies of the kept terms of each language, by source."""
    shards = SHARDS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return merge(runs(named(docs), shards, block, chunk), min_docs)


def probability(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), by long division in two steps; null without kept terms."""
    d = f"nullif({total} + 2 * {kept}, 0)"
    high = f"(({count} + 2) * 100000)"
    return F.expr(f"1 + ({high} div {d}) * 10000 + (({high} % {d}) * 10000) div {d}")


def spread(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Corrections:
    """Per pair of sources of a language: terms that both have, and what they change in the sum."""

    def __init__(self) -> None:
        self.ids: dict[str, dict[str, int]] = defaultdict(dict)
        self.sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.cells = 0

    def places(self, lang: str, sources: list[str]) -> np.ndarray:
        """Places of sources in the matrices of a language, which grow to hold them."""
        ids = self.ids[lang]
        places = np.array([ids.setdefault(s, len(ids)) for s in sources], np.int64)
        n, held = len(ids), self.sums.get(lang)
        if held is None or n > len(held[0]):
            size = max(16, 1 << (n - 1).bit_length())
            grown = np.zeros((size, size), np.int64), np.zeros((size, size), np.int64)
            if held is not None:
                for old, new in zip(held, grown):
                    new[: len(old), : len(old)] = old
                self.cells -= held[0].size
            self.cells += size * size
            self.sums[lang] = grown
        return places

    def add(self, lang: str, at: np.ndarray, p: np.ndarray, low: np.ndarray) -> None:
        """Terms with as many sources each, a row per term: their places, values, and values at a count of zero."""
        both, value = self.sums[lang]
        change = _change(p, low, p, low)
        cell = at[:, :, None] * len(both) + at[:, None, :]
        both += np.bincount(cell.ravel(), minlength=both.size).reshape(both.shape)
        # sums of doubles are exact: a step holds few enough terms of 32 bits
        value += np.bincount(cell.ravel(), change.ravel(), value.size).astype(np.int64).reshape(value.shape)

    def flushed(self) -> pa.RecordBatch:
        rows = []
        for lang, ids in self.ids.items():
            names = list(ids)
            both, value = self.sums[lang]
            np.fill_diagonal(both, 0)
            rows += [(lang, names[a], names[b], int(both[a, b]), int(value[a, b])) for a, b in zip(*np.nonzero(both))]
        self.__init__()
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "both", "change"])


def _change(p: np.ndarray, low: np.ndarray, q: np.ndarray, q_low: np.ndarray) -> np.ndarray:
    """What a common term adds over both one-sided values, for the sources in the last axis of either side."""
    own, zero, other, other_zero = p[..., :, None], low[..., :, None], q[..., None, :], q_low[..., None, :]
    return _f(own, other) - _f(own, other_zero) - _f(zero, other)


def corrections(postings: DataFrame, cells: int = CELLS) -> DataFrame:
    """(lang, source, item, both, change) of ``postings`` (lang, term, source, p, low), for pairs with a common term."""
    grouped = postings.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "low")).alias("found"))
    width = max(2, int(cells**0.5) // 2)

    def run(batches):
        held = Corrections()
        for batch in batches:
            found = batch["found"]
            starts = found.offsets.to_numpy()
            entries = found.values
            names = entries.field("source").dictionary_encode()
            code = names.indices.to_numpy()
            p, low = (entries.field(k).to_numpy() for k in ("p", "low"))
            sizes = np.diff(starts)
            langs = batch["lang"].dictionary_encode()
            lang_of = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = lang_of == k
                for size in np.unique(sizes[own & (sizes > 1) & (sizes <= width)]):
                    firsts = starts[:-1][own & (sizes == size)]
                    step = max(1, STEP // int(size) ** 2)
                    for i in range(0, len(firsts), step):
                        at = firsts[i : i + step, None] + np.arange(size)[None, :]
                        used, place = np.unique(code[at], return_inverse=True)
                        place = held.places(lang, names.dictionary.take(pa.array(used)).to_pylist())[place].reshape(at.shape)
                        held.add(lang, place, p[at], low[at])
                        if held.cells >= cells:
                            yield held.flushed()
                for row in np.flatnonzero(own & (sizes > width)):  # very many sources: in pairs of slices
                    yield from _wide(lang, names.take(pa.array(np.arange(starts[row], starts[row + 1]))).to_pylist(), p[starts[row] : starts[row + 1]], low[starts[row] : starts[row + 1]], width)
        yield held.flushed()

    summed = grouped.select("lang", "found").mapInArrow(run, "lang string, source string, item string, both long, change long")
    return summed.groupBy("lang", "source", "item").agg(F.sum("both").alias("both"), F.sum("change").alias("change"))


def _wide(lang: str, sources: list[str], p: np.ndarray, low: np.ndarray, width: int):
    """The pairs of one term's sources, slice by slice."""
    names = ["lang", "source", "item", "both", "change"]
    for i in range(0, len(p), width):
        for j in range(0, len(p), width):
            a, b = slice(i, i + width), slice(j, j + width)
            x, y = np.repeat(np.array(sources[a], object), len(sources[b])), np.tile(np.array(sources[b], object), len(sources[a]))
            other = x != y
            change = _change(p[a], low[a], p[b], low[b]).ravel()[other]
            ones = pa.array(np.ones(len(change), np.int64))
            columns = [pa.array([lang] * len(change), pa.string()), pa.array(x[other], pa.string()), pa.array(y[other], pa.string()), ones, pa.array(change)]
            yield pa.RecordBatch.from_arrays(columns, names)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence from each other source of the language, and the terms
    by which a source differs most from its language."""
    index = materialise(frequencies(docs, min_docs, block))
    occurring = named(docs).select("lang", "source").distinct()
    postings = index.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "total", F.col("e.sources").alias("source"), F.col("e.counts").alias("n")
    )
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("has"))
    langs = index.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_size"))
    zero = F.lit(0).cast("long")
    groups = materialise(
        occurring.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("size", "has", "kept", "lang_size")])
        .withColumn("low", probability("0L", "size", "kept"))
    )
    valued = materialise(
        postings.join(groups, ["lang", "source"])
        .select("lang", "term", "source", "n", probability("n", "size", "kept").alias("p"), "low",
                probability("total", "lang_size", "kept").alias("q"))
    )

    most = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    named_terms = (
        valued.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), spread("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= top)
    )

    other = groups.select("lang", F.col("source").alias("item"), F.col("has").alias("item_has"), F.col("low").alias("item_low"))
    pairs = materialise(groups.join(other, "lang").where("source <> item").select("lang", "source", "item", "has", "kept", "low", "item_has", "item_low"))
    histogram = valued.groupBy("lang", "source", "n", "p").agg(F.count("*").alias("terms"))
    against_zero = materialise(
        histogram.join(pairs.select("lang", "source", "item", "item_low"), ["lang", "source"])
        .groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * spread("p", "item_low")).alias("x"))
    )
    back = against_zero.select("lang", F.col("source").alias("item"), F.col("item").alias("source"), F.col("x").alias("y"))
    keys = ["lang", "source", "item"]
    neither = F.col("kept") - F.col("has") - F.col("item_has") + F.coalesce("both", zero)
    value = (
        F.coalesce("x", zero) + F.coalesce("y", zero) + F.coalesce("change", zero)
        + neither * F.coalesce(spread("low", "item_low"), zero)
    )
    diverging = (
        pairs.join(against_zero, keys, "left").join(back, keys, "left").join(corrections(valued), keys, "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
        .withColumn("rank", F.row_number().over(most))
    )
    return diverging.unionByName(named_terms)
