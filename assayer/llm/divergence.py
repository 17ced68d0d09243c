"""Source divergence audit by single-pass in-memory indexing.

A task reads texts into an in-memory block of postings and, when the block is full, spills it
as runs: per hash shard of the terms one sequence of entries (source, occurrences, documents)
sorted by language and term, cut into chunks. A shard's task reads the chunks by their first
term and merges them with a heap, so it holds the chunks whose ranges overlap. What comes out are exact corpus frequencies, written once. Profiles
are whole numbers; a pair of sources gets its divergence as a sum over terms that neither
has (a product), that one has (from histograms of counts, since only the count matters), and
a correction for each term that both have, streamed from the posting lists.

Defined results: null text, language and source count as empty; a document without terms
still makes its group; repeated rows are documents of their own; a language without kept
terms has pairs of value 0 and no terms; an empty table gives an empty one; other columns are
not read. Texts are cut at term borders into pieces of bounded size, whole texts are read.
A posting list has one entry per source of a language, and so has the result, per pair.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import Batches, arrow_schema

LEAST_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Occurrences and distinct terms that fill a block in memory; some 20 and 200 bytes each.
BLOCK_TOKENS = 2_000_000
BLOCK_TERMS = 400_000
#: Entries (term and source) of a chunk of a run, and terms of runs that are merged at once.
CHUNK_ENTRIES = 2_048
MERGED_TERMS = 100_000
#: Bytes of a text that are split into words at once.
PIECE_BYTES = 1 << 20
#: Pairs of sources that are corrected at once, and sums of pairs that a task holds.
PAIRS_AT_ONCE = 1 << 20
HELD_PAIRS = 1 << 20

# Bytes that are no part of a term become spaces; only A-Z are lower-cased. All bytes of
# characters beyond ASCII are from 0x80 on.
_TERM_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

RUNS = """shard int, lang string, first string, names array<string>, terms array<string>,
  entries array<int>, sources array<int>, counts array<long>, documents array<long>"""
POSTINGS = "lang string, term string, sources array<string>, counts array<long>"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, in lists of bounded size."""
    clean, start = text.translate(_TERM_BYTES), 0
    while start < len(clean):
        end = start + PIECE_BYTES
        if end < len(clean):
            border = clean.find(b" ", end)
            end = len(clean) if border < 0 else border
        yield clean[start:end].split()
        start = end


class Block:
    """Postings of some texts: for each occurrence its term and its text. The empty term occurs
    once in each text and stands for the text's source, so that no source is lost."""

    def __init__(self) -> None:
        new = itertools.count().__next__
        self.terms: dict[str, dict[bytes, int]] = defaultdict(lambda: defaultdict(new))
        self.groups: dict[tuple[str, str], int] = {}
        self.texts: list[int] = []  # the group of each
        self.codes: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.tokens = self.n_terms = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        own = self.terms[lang]
        code_of, before = own.__getitem__, len(own)
        self.texts.append(self.groups.setdefault((lang, source), len(self.groups)))
        self.codes.append(np.array([code_of(b"")], np.int32))
        length = 1
        for words in words_of(text):
            self.codes.append(np.fromiter(map(code_of, words), np.int32, len(words)))
            length += len(words)
        self.lengths.append(length)
        self.tokens += length
        self.n_terms += len(own) - before

    def postings(self) -> tuple[np.ndarray, ...]:
        """Term, group, occurrences and texts of each entry."""
        text = np.repeat(np.arange(len(self.texts)), self.lengths)
        key, count = _summed(np.concatenate(self.codes).astype(np.int64) * len(self.texts) + text)
        term, group = key // len(self.texts), np.array(self.texts)[key % len(self.texts)]
        key, count, texts = _summed(
            term * len(self.groups) + group, count, np.ones(len(count), np.int64)
        )
        return key // len(self.groups), key % len(self.groups), count, texts

    def runs(self, shards: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The block's sorted run of each shard, in chunks: a row each."""
        if not self.texts:
            return
        langs, words, codes, shard = [], [], [], []
        for lang, terms in sorted(self.terms.items()):
            start = zlib.crc32(lang.encode())
            own = sorted(terms.items())
            words += [term for term, _ in own]
            codes += [code for _, code in own]
            shard += [zlib.crc32(term, start) % shards for term, _ in own]
            langs += [lang] * len(own)
        by = np.argsort(np.array(shard), kind="stable")  # the terms were in order before
        rank = np.empty(len(by), np.int64)
        rank[np.array(codes)[by]] = np.arange(len(by))
        term, group, counts, texts = self.postings()
        order = np.argsort(rank[term], kind="stable")
        per_term = np.bincount(rank[term], minlength=len(by))
        ends = np.cumsum(per_term)
        lang_no = np.unique(langs, return_inverse=True)[1][by]
        own_shard = np.array(shard)[by]
        segment = np.flatnonzero(np.diff(own_shard, prepend=-1) | np.diff(lang_no, prepend=-1))
        first_entry = np.repeat(
            (ends - per_term)[segment], np.diff(np.append(segment, len(by)))
        )
        part = (ends - per_term - first_entry) // CHUNK_ENTRIES
        starts = np.flatnonzero(
            np.diff(own_shard, prepend=-1) | np.diff(lang_no, prepend=-1) | np.diff(part, prepend=-1)
        )
        sources = [source for _, source in self.groups]
        entry_starts = np.append((ends - per_term)[starts], len(order))
        names, numbers = [], []
        for a, b in zip(entry_starts, entry_starts[1:]):
            some, number = np.unique(group[order[a:b]], return_inverse=True)
            names.append([sources[i] for i in some])
            numbers.append(number)
        term_offsets = pa.array(np.append(starts, len(by)), pa.int32())
        entry_offsets = pa.array(entry_starts, pa.int32())
        ordered = pa.array([words[i] for i in by], pa.binary()).cast(pa.string())
        lists = [
            (term_offsets, ordered),
            (term_offsets, pa.array(per_term)),
            (entry_offsets, pa.array(np.concatenate(numbers))),
            (entry_offsets, pa.array(counts[order])),
            (entry_offsets, pa.array(texts[order])),
        ]
        columns = [
            pa.array(own_shard[starts]),
            pa.array([langs[i] for i in by[starts]]),
            ordered.take(pa.array(starts)),
            pa.array(names, pa.list_(pa.string())),
            *[pa.ListArray.from_arrays(offsets, values) for offsets, values in lists],
        ]
        whole = pa.RecordBatch.from_arrays(
            [c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
        )
        for at in range(0, len(whole), 100):
            yield whole.slice(at, 100)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys, ascending, and the sums of their values, or their number."""
    if not len(keys):
        return (keys, *(values or [np.zeros(0, np.int64)]))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    if not values:
        return keys[first], np.diff(np.append(first, len(keys)))
    return (keys[first], *[np.add.reduceat(v[order], first) for v in values])


def index_runs(
    docs: DataFrame,
    text_col: str,
    lang_col: str,
    source_col: str,
    shards: int,
    tokens: int = BLOCK_TOKENS,
    terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The term-sorted runs of all blocks."""
    columns = [
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (text_col, lang_col, source_col)
    ]
    texts = docs.select(
        *[c.alias(name) for c, name in zip(columns, ("text", "lang", "source"))]
    )
    target = arrow_schema(RUNS)

    def run(batches: Batches) -> Batches:
        block = Block()
        for batch in batches:
            langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i, text in enumerate(batch.column(0).cast(pa.binary())):
                block.add(langs[i], sources[i], text.as_py())
                if block.tokens >= tokens or block.n_terms >= terms:
                    yield from block.runs(shards, target)
                    block = Block()
        yield from block.runs(shards, target)

    return texts.mapInArrow(run, RUNS)


class Chunk:
    """A sorted part of a run: its terms, where the entries of each begin, and the entries."""

    def __init__(self, row: dict[str, pa.Scalar], numbers: dict[str, int]) -> None:
        self.lang, self.terms = row["lang"].as_py(), row["terms"].as_py()
        names = [numbers.setdefault(name, len(numbers)) for name in row["names"].as_py()]
        arrays = {
            name: row[name].values.to_numpy(zero_copy_only=False).astype(np.int64)
            for name in ("entries", "sources", "counts", "documents")
        }
        self.entries, self.counts = arrays["entries"], arrays["counts"]
        self.sources = np.array(names, np.int64)[arrays["sources"]]
        self.documents = arrays["documents"]


def chunks_of(batches: Batches, numbers: dict[str, int]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(len(batch)):
            yield Chunk({n: batch.column(n)[i] for n in batch.schema.names}, numbers)


def heap_merge(chunks: Iterable[Chunk]) -> Iterator[tuple[str, str, Chunk, int]]:
    """``lang, term, chunk, place`` of the terms of all chunks in order. Chunks come by language
    and first term, so only those whose range has begun stand in the heap."""
    heap: list[tuple] = []

    def step() -> tuple[str, str, Chunk, int]:
        lang, term, number, at, chunk = heap[0]
        if at + 1 < len(chunk.terms):
            heapq.heapreplace(heap, (lang, chunk.terms[at + 1], number, at + 1, chunk))
        else:
            heapq.heappop(heap)
        return lang, term, chunk, at

    for number, chunk in enumerate(chunks):
        while heap and heap[0][:2] < (chunk.lang, chunk.terms[0]):
            yield step()
        heapq.heappush(heap, (chunk.lang, chunk.terms[0], number, 0, chunk))
    while heap:
        yield step()


def merged_postings(
    merged: Iterable[tuple[str, str, Chunk, int]],
    numbers: dict[str, int],
    least_documents: int,
    schema: pa.Schema,
) -> Batches:
    """A row per language and term with enough documents: its sources and their counts. The
    empty term, a language's list of sources, always stays."""
    keys: list[tuple[str, str]] = []
    which: list[int] = []
    held: list[tuple[Chunk, int]] = []

    def summed() -> pa.RecordBatch:
        chunks = list({id(chunk): chunk for chunk, _ in held}.values())
        base = dict(zip(map(id, chunks), np.cumsum([0, *[len(c.terms) for c in chunks]]).tolist()))
        at = np.array([base[id(chunk)] + place for chunk, place in held])
        entries = np.concatenate([c.entries for c in chunks])
        lengths = entries[at]
        first = (np.cumsum(entries) - entries)[at]
        entry = np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        sources, counts, documents = (
            np.concatenate([getattr(c, name) for c in chunks])[entry]
            for name in ("sources", "counts", "documents")
        )
        key, counts, documents = _summed(
            np.repeat(np.array(which), lengths) * len(numbers) + sources, counts, documents
        )
        term = key // len(numbers)
        total = _summed(term, documents)[1]  # every term has an entry
        kept = (total >= least_documents) | np.array([not t for _, t in keys])
        own = kept[term]
        sizes = np.bincount(term, minlength=len(keys))[kept]
        offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        places = np.flatnonzero(kept).tolist()
        names = pa.array(list(numbers)).take(pa.array((key % len(numbers))[own]))
        columns = [
            pa.array([keys[i][0] for i in places], pa.string()),
            pa.array([keys[i][1] for i in places], pa.string()),
            pa.ListArray.from_arrays(offsets, names),
            pa.ListArray.from_arrays(offsets, pa.array(counts[own], pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(
            [c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
        )

    for lang, term, chunk, place in merged:
        if not keys or keys[-1] != (lang, term):
            if len(held) >= MERGED_TERMS:
                yield summed()
                keys, which, held = [], [], []
            keys.append((lang, term))
        which.append(len(keys) - 1)
        held.append((chunk, place))
    if held:
        yield summed()


def postings(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """``lang, term, sources, counts`` of the terms in at least so many documents of their
    language; the empty term lists all sources of the language."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = index_runs(docs, text_col, lang_col, source_col, shards)
    target = arrow_schema(POSTINGS)

    def merge(batches: Batches) -> Batches:
        numbers: dict[str, int] = {}  # of the sources met so far
        merged = heap_merge(chunks_of(batches, numbers))
        yield from merged_postings(merged, numbers, least_documents, target)

    dealt = runs.repartitionById(shards, "shard").sortWithinPartitions("lang", "first")
    return dealt.mapInArrow(merge, POSTINGS)


def _profile(count: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / total)`` in whole numbers, digits at a time so that
    nothing overflows: exact while counts stay below 9 * 10**15. (A total of 0 has no terms.)"""
    rest, quotient, total = count + 1, F.lit(1).cast("long"), F.greatest(total, F.lit(1))
    for power in (1_000_000, 1_000, 1):  # three digits of SCALE each
        shifted = rest * F.lit(1000).cast("long")
        quotient = quotient + F.call_function("div", shifted, total) * F.lit(power).cast("long")
        rest = shifted % total
    return quotient


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def profiles(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of written postings: a row per group (``lang, source, total, base`` with ``base`` the
    profile of a term that the group lacks, ``terms`` the language's kept terms), and one per
    kept term of a group (``lang, term, source, count, p, base, q``), q the language's own."""
    kept = lists.where("term != ''")
    entries = kept.select(
        "lang", "term", F.inline(F.arrays_zip("sources", "counts"))
    ).withColumnsRenamed({"sources": "source", "counts": "count"})
    known = lists.where("term = ''").select("lang", F.explode("sources").alias("source"))
    sums = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    own = F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)
    languages = kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum(own).alias("lang_n")
    )
    groups = (
        known.join(sums, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("terms", F.lit(0).cast("long")).alias("terms"),
            (F.coalesce("n", F.lit(0).cast("long")) + F.col("terms")).alias("total"),
            (F.col("lang_n") + F.col("terms")).alias("lang_total"),
        )
        .withColumn("base", _profile(F.lit(0).cast("long"), F.col("total")))
    )
    groups = written(groups, "divergence-groups")
    totals = groups.select("lang", "source", "total", "lang_total", "base")
    of_lang = kept.select("lang", "term", own.alias("lang_count"), "sources", "counts")
    weights = (
        of_lang.select("lang", "term", "lang_count", F.inline(F.arrays_zip("sources", "counts")))
        .withColumnsRenamed({"sources": "source", "counts": "count"})
        .join(totals, ["lang", "source"])
        .select(
            "lang",
            "term",
            "source",
            "count",
            _profile(F.col("count"), F.col("total")).alias("p"),
            "base",
            _profile(F.col("lang_count"), F.col("lang_total")).alias("q"),
        )
    )
    return groups, written(weights, "divergence-weights")


def pair_corrections(weights: DataFrame) -> DataFrame:
    """``lang, source, item, value``: what the terms that both sources have add to the sum of
    those that count each source alone; partial sums of each task."""
    lists = weights.groupBy("lang", "term").agg(
        F.collect_list(F.struct("source", "p", "base")).alias("own")
    )
    schema = "lang string, source string, item string, value long"
    target = arrow_schema(schema)

    def run(batches: Batches) -> Batches:
        held = PairSums(target)
        for batch in batches:
            yield from held.add(batch)
        yield from held.handed_on()

    return lists.select("lang", "own").mapInArrow(run, schema)


class PairSums:
    """Summed corrections of pairs of groups, a bounded number of them."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema
        self.numbers: dict[tuple[str, str], int] = {}
        self.pairs = np.zeros((2, 0), np.int64)
        self.sums = np.zeros(0, np.int64)

    def add(self, batch: pa.RecordBatch) -> Batches:
        """Take posting lists in; sums are handed on where too many are held."""
        lists = batch.column(1)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        own = lists.flatten()
        langs = np.repeat(np.array(batch.column(0).to_pylist(), object), sizes)
        keys = zip(langs.tolist(), own.field("source").to_pylist())
        group = np.fromiter(
            (self.numbers.setdefault(k, len(self.numbers)) for k in keys), np.int64, len(own)
        )
        p, base = (own.field(n).to_numpy(zero_copy_only=False) for n in ("p", "base"))
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        partners = np.repeat(sizes, sizes)
        ends = np.cumsum(partners)
        start = 0
        while start < len(own):
            # Entries with their partners, so many that their pairs are few, but one at least.
            done = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
            n = partners[start:end]
            i = np.repeat(np.arange(start, end), n)
            j = np.repeat(first[start:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            i, j = i[i != j], j[i != j]
            value = (
                _floor(p[i], p[j]) - _floor(p[i], base[j]) - _floor(base[i], p[j]) + _floor(base[i], base[j])
            )
            self._keep(np.stack([group[i], group[j]]), value)
            if len(self.sums) > HELD_PAIRS:
                yield from self.handed_on()
            start = end

    def _keep(self, pairs: np.ndarray, value: np.ndarray) -> None:
        key = pairs[0] << 32 | pairs[1]
        key, value = _summed(key, value)
        held = self.pairs[0] << 32 | self.pairs[1]
        key, self.sums = _summed(np.concatenate([held, key]), np.concatenate([self.sums, value]))
        self.pairs = np.stack([key >> 32, key & 0xFFFFFFFF])

    def handed_on(self) -> Batches:
        names = list(self.numbers)
        langs, sources = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
        one, other = (pa.array(p) for p in self.pairs)
        columns = [langs.take(one), sources.take(one), sources.take(other), pa.array(self.sums)]
        whole = pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.pairs, self.sums = self.pairs[:, :0], self.sums[:0]
        for at in range(0, len(whole), 10_000):
            yield whole.slice(at, 10_000)


def _floor(p, q):
    return (p - q) * (p - q) // q


def pair_divergence(groups: DataFrame, weights: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two sources of a language.

    The sum over all kept terms is terms * f(base, base), plus for each term of one source
    what it changes where the other lacks it, plus the corrections of the terms of both.
    """
    left = groups.select("lang", "source", "terms", "base")
    right = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("item_base"))
    pairs = left.join(right, "lang").where("source != item")
    neither = _divergence(F.col("base"), F.col("item_base"))
    start = pairs.select(
        "lang",
        "source",
        "item",
        F.when(F.col("terms") > 0, F.col("terms") * neither)
        .otherwise(F.lit(0).cast("long"))
        .alias("value"),
    )
    counts = weights.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    counts = written(counts, "divergence-counts")
    first = counts.join(pairs, ["lang", "source"]).select(
        "lang",
        "source",
        "item",
        (F.col("n") * (_divergence(F.col("p"), F.col("item_base")) - neither)).alias("value"),
    )
    second = (
        counts.withColumnRenamed("source", "item")
        .join(pairs, ["lang", "item"])
        .select(
            "lang",
            "source",
            "item",
            (F.col("n") * (_divergence(F.col("base"), F.col("p")) - neither)).alias("value"),
        )
    )
    parts = start.union(first).union(second).union(pair_corrections(weights))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergence(weights: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of the terms that a source has more than its language."""
    return weights.where("p > q").select(
        "lang",
        "source",
        F.col("term").alias("item"),
        _divergence(F.col("p"), F.col("q")).alias("value"),
    )


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(own))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: the divergence of each source from each other
    one of its language (``pair``), and its terms that stand out from the language (``term``)."""
    lists = written(
        postings(docs, text_col, lang_col, source_col, least_documents), "divergence-postings"
    )
    groups, weights = profiles(lists)
    pairs = _ranked(pair_divergence(groups, weights), "pair")
    return pairs.union(_ranked(term_divergence(weights), "term", top_terms))
