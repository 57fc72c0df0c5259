"""Problem 9: test items inside a training corpus, by a distributed positional inverted index.

The corpus is indexed in *segments*: each holds the sorted terms of some documents and, per term, the ascending list of
the positions where it stands. Segments are rows of a table in the shared folder; a document lies in one segment, so
that a search needs no shuffle. A search takes every phrase of an item, starts from the posting list of its rarest
term (counted over the whole corpus), and intersects it with the lists of the other terms, each shifted by its offset
in the phrase. Phrase hits close to each other are joined to runs (proximity matches), which tolerate small edits.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import cut, scratch_path

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)?")
_INDEX = "segment long, doc_ids array<bigint>, doc_starts array<int>, terms array<string>, term_starts array<int>, deltas array<int>"
#: Positions between two documents of a segment, so that no phrase spans both.
GAP = 64


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _segment(ids: list[int], texts: list[str]) -> dict[str, list]:
    known: dict[str, int] = {}
    starts, at, codes, places = [], 0, [], []
    for text in texts:
        own = [known.setdefault(w, len(known)) for w in words(text)]
        starts.append(at)
        codes.append(np.array(own, dtype=np.int32))
        places.append(np.arange(at, at + len(own), dtype=np.int32))
        at += len(own) + GAP
    code, place = np.concatenate(codes), np.concatenate(places)
    terms = sorted(known)
    rank = np.empty(len(terms), dtype=np.int32)
    rank[[known[t] for t in terms]] = np.arange(len(terms), dtype=np.int32)
    order = np.argsort(rank[code], kind="stable") if len(code) else np.zeros(0, dtype=np.int64)
    place = place[order]
    counts = np.bincount(rank[code], minlength=len(terms))
    firsts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    deltas = np.diff(place, prepend=np.int32(0)).astype(np.int32)
    deltas[firsts[:-1]] = place[firsts[:-1]]  # each list starts anew
    return {"doc_ids": ids, "doc_starts": starts, "terms": terms, "term_starts": firsts.tolist(), "deltas": deltas}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_chars: int = 6_000_000) -> DataFrame:
    """Write the positional index of all documents to the shared folder and return it, one row a segment.

    A segment takes whole documents until it holds ``segment_chars`` characters, so that its size is bounded by that
    and the longest text. Null ids and null texts are left out, blank texts have no postings; repeated rows are indexed
    twice. Other columns are not read.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            s = _segment(ids, texts)
            first = ids[0] if ids else 0
            return pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int64()), *(pa.array([s[k]], t) for k, t in (("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int32())), ("terms", pa.list_(pa.string())), ("term_starts", pa.list_(pa.int32())))), pa.array([s["deltas"]], pa.list_(pa.int32()))],
                names=["segment", "doc_ids", "doc_starts", "terms", "term_starts", "deltas"],
            )

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and size + len(t) > segment_chars:
                    yield flush()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield flush()

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    path = scratch_path(spark, "positional-index")
    rows.mapInArrow(segments, _INDEX).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_INDEX).parquet(path)


@dataclass
class _Segment:
    ids: np.ndarray
    starts: np.ndarray
    lists: dict[int, np.ndarray]
    length: int

    @staticmethod
    def read(batch: pa.RecordBatch, row: int, wanted: dict[str, int]) -> _Segment:
        col = lambda name: batch.column(batch.schema.get_field_index(name))[row].values
        terms, firsts, deltas = col("terms"), col("term_starts").to_numpy(), col("deltas").to_numpy()
        lists = {}
        for at in np.flatnonzero(pc.is_in(terms, value_set=pa.array(list(wanted), pa.string())).to_numpy(zero_copy_only=False)) if len(terms) else ():
            lists[wanted[terms[int(at)].as_py()]] = np.cumsum(deltas[firsts[at] : firsts[at + 1]])
        most = max((int(x[-1]) for x in lists.values()), default=-1)
        return _Segment(col("doc_ids").to_numpy(), col("doc_starts").to_numpy(), lists, most + GAP)


def term_counts(index: DataFrame, terms: list[str]) -> dict[str, int]:
    """Occurrences in the whole corpus of the given terms (a bounded list: the words of the test items)."""
    wanted = {t: k for k, t in enumerate(terms)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = defaultdict(int)
        for batch in batches:
            for row in range(batch.num_rows):
                sizes = batch.column(1)[row].values.to_numpy()
                names = batch.column(0)[row].values
                for at in np.flatnonzero(pc.is_in(names, value_set=pa.array(terms, pa.string())).to_numpy(zero_copy_only=False)) if len(names) else ():
                    total[wanted[names[int(at)].as_py()]] += int(sizes[at + 1] - sizes[at])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])

    rows = index.select("terms", "term_starts").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {terms[r.term]: r.n for r in rows}


@dataclass
class Phrases:
    """All phrases of some test items: term ids (phrase x length), their item and offset, whether the phrase is the item's
    own, and the order of rarity; per item the number of its own words and the places of its instruction line."""

    vocabulary: dict[str, int]
    grams: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    own: np.ndarray
    order: np.ndarray
    size: dict[int, int]
    foreign: dict[int, frozenset[int]]


def shared_phrases(items: DataFrame, length: int, shared: int, instruction: int) -> DataFrame:
    """(phrase, n, opening) over all items (item_id, text): phrases that more than ``shared`` items hold, and (``opening``)
    the first five words that at least ``instruction`` items start with."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, phrases, openings = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = words(text)
                found = {(" ".join(ws[j : j + length]), False) for j in range(len(ws) - length + 1)} | {(" ".join(ws[:5]), True)}
                ids += [i] * len(found)
                phrases += [x for x, _ in found]
                openings += [o for _, o in found]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(phrases, pa.string()), pa.array(openings, pa.bool_())], names=["item_id", "phrase", "opening"])

    rows = items.select("item_id", "text").mapInArrow(spell, "item_id long, phrase string, opening boolean")
    counts = rows.groupBy("phrase", "opening").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > F.when(F.col("opening"), instruction - 1).otherwise(min(shared, instruction - 1)))


def item_phrases(items: list[tuple[int, str]], counts: dict[str, int] | None, held: dict[str, int], openings: dict[str, int], length: int, shared: int, instruction: int = 3) -> Phrases:
    """Phrases of the items, given the phrases and openings that several of all items share (:func:`shared_phrases`).

    A phrase that at most ``shared`` items hold is an item's own. An instruction line is what at least ``instruction``
    items start with; it goes on as long as most of the items that start alike hold its phrases, so that what a few
    versions of one item have in common is their own wording."""
    tokens = {i: words(t) for i, t in items}
    vocabulary = {t: k for k, t in enumerate(sorted({w for ws in tokens.values() for w in ws}))}
    grams, item, offset, own, size, foreign = [], [], [], [], {}, {}
    for i, ws in tokens.items():
        places: set[int] = set()
        spelled = [" ".join(ws[j : j + length]) for j in range(len(ws) - length + 1)]
        if alike := openings.get(" ".join(ws[:5])):
            for j, phrase in enumerate(spelled):
                if held.get(phrase, 1) < max(instruction, alike / 2):
                    break
                places.update(range(j, j + length))
        for j, phrase in enumerate(spelled):
            grams.append([vocabulary[w] for w in ws[j : j + length]])
            item.append(i)
            offset.append(j)
            own.append(held.get(phrase, 1) <= shared)
        size[i], foreign[i] = len(ws) - len(places), frozenset(places)
    g = np.array(grams, dtype=np.int32).reshape(-1, length)
    often = np.array([(counts or {}).get(t, 0) for t in sorted(vocabulary)], dtype=np.int64)
    return Phrases(vocabulary, g, np.array(item, dtype=np.int64), np.array(offset, dtype=np.int32), np.array(own, dtype=bool), np.argsort(often[g], axis=1, kind="stable") if len(g) else g, size, foreign)


def telling_hits(hits: list[tuple[int, int, bool]], length: int, alone: int, foreign: frozenset[int]) -> list[tuple[int, int]]:
    """(offset, position) of the hits (offset, position, own) that lie in a telling stretch.

    A stretch is an unbroken match. It tells of the item if a phrase in it is the item's own, or if, for items that are
    versions of each other, it holds ``alone`` words outside the instruction line; shorter shared phrases are quotes.
    """
    out: list[tuple[int, int]] = []
    stretch: list[tuple[int, int, bool]] = []

    def close() -> None:
        if stretch and (any(o for *_, o in stretch) or len(set(range(stretch[0][0], stretch[-1][0] + length)) - foreign) >= alone):
            out.extend((k, j) for k, j, _ in stretch)
        stretch.clear()

    for hit in sorted(hits, key=lambda h: (h[1] - h[0], h[0])):
        if stretch and (hit[1] - hit[0] != stretch[-1][1] - stretch[-1][0] or hit[0] > stretch[-1][0] + 1):
            close()
        stretch.append(hit)
    close()
    return out


def _hits(segment: _Segment, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, position of its first word) of every exact phrase match."""
    if not segment.lists or not len(p.grams):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rarest = p.grams[np.arange(len(p.grams)), p.order[:, 0]]
    which, place = [], []
    for term in np.unique(rarest):
        posting = segment.lists.get(int(term))
        if posting is not None:
            own = np.flatnonzero(rarest == term)
            which.append(np.repeat(own, len(posting)))
            place.append((posting[None, :] - p.order[own, 0][:, None]).ravel())
    if not which:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    gram, at = np.concatenate(which), np.concatenate(place).astype(np.int64)
    # Membership in the shifted lists of the other terms, from the next rarest on.
    stands = np.full(segment.length + p.grams.shape[1], -1, dtype=np.int32)
    for term, posting in segment.lists.items():
        stands[posting] = term
    keep = at >= 0
    gram, at = gram[keep], at[keep]
    for k in range(1, p.grams.shape[1]):
        offset = p.order[gram, k]
        keep = stands[at + offset] == p.grams[gram, offset]
        gram, at = gram[keep], at[keep]
    return gram, at


def runs(pairs: list[tuple[int, int]], length: int, bridge: int, drift: int) -> list[tuple[int, int]]:
    """Chains of phrase hits (offset in the item, position in the text) as spans [first, end) of the item, longest first."""
    chains: list[list[tuple[int, int]]] = []
    for k, j in sorted(pairs):
        for chain in reversed(chains):
            dk, dj = k - chain[-1][0], j - chain[-1][1]
            if 0 <= dk <= length + bridge and 0 <= dj <= length + bridge and abs(dk - dj) <= drift:
                chain.append((k, j))
                break
        else:
            chains.append([(k, j)])
    return sorted(((c[0][0], c[-1][0] + length) for c in chains), key=lambda s: (s[0] - s[1], s))


def search_index(index: DataFrame, items: DataFrame, phrase: int = 4, shared: int = 2, bridge: int = 8, drift: int = 4, pieces: int = 2, share: float = 0.25, least: int = 8, alone: int = 16, shard_chars: int = 20_000_000) -> DataFrame:
    """Documents that leak items: ``(doc_id, item_id, coverage, longest)``.

    A run is a chain of exact phrases of ``phrase`` words in which at most ``bridge`` words in a row differ and the
    offset drifts by at most ``drift``. An item is leaked if its ``pieces`` longest runs (of at least ``least`` words
    the longest) cover the share ``share`` of its own wording, i.e. of all its words but an instruction line that it
    shares with others. Phrases that more than ``shared`` items hold count where they go on from one of the item's own,
    or where ``alone`` words match without a break (:func:`telling_hits`).

    The items' characters are counted first: up to ``shard_chars`` are held at once, more are searched shard by shard;
    what items share is counted over all of them. Items with a null id or text, and items shorter than a phrase, leak
    nowhere; of repeated ids the greatest text counts.
    """
    spark = index.sparkSession
    whole = items.where("item_id is not null and text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.max("text").alias("text"))
    whole = cut(whole, "items")
    chars = whole.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    common = cut(shared_phrases(whole, phrase, shared, 3), "shared-phrases")
    found: DataFrame | None = None
    for shard in range(shards):
        part = whole.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard)
        hits = _search(spark, index, part, common, phrase, shared, bridge, drift, pieces, share, least, alone)
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"), F.max("longest").alias("longest"))


def _search(spark: SparkSession, index: DataFrame, part: DataFrame, common: DataFrame, phrase: int, shared: int, bridge: int, drift: int, pieces: int, share: float, least: int, alone: int) -> DataFrame:
    """Hits of one shard of items."""
    items = sorted((int(r.item_id), r.text) for r in part.collect())
    spelled = {" ".join(ws[j : j + phrase]) for _, t in items for ws in [words(t)] for j in range(len(ws) - phrase + 1)} | {" ".join(words(t)[:5]) for _, t in items}
    asked = spark.createDataFrame([(x,) for x in sorted(spelled)], "phrase string")
    told = common.join(asked, "phrase").collect()
    terms = sorted({w for _, t in items for w in words(t)})
    counts = term_counts(index, terms) if terms else {}
    held = spark.sparkContext.broadcast(item_phrases(items, counts, {r.phrase: r.n for r in told if not r.opening}, {r.phrase: r.n for r in told if r.opening}, phrase, shared))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        for batch in batches:
            out: list[tuple[int, int, float, int]] = []
            for row in range(batch.num_rows):
                segment = _Segment.read(batch, row, p.vocabulary)
                gram, at = _hits(segment, p)
                met: dict[tuple[int, int], list[tuple[int, int, bool]]] = defaultdict(list)
                docs = np.searchsorted(segment.starts, at, side="right") - 1
                for d, i, k, j, own in zip(docs.tolist(), p.item[gram].tolist(), p.offset[gram].tolist(), at.tolist(), p.own[gram].tolist()):
                    met[d, i].append((k, j, own))
                for (d, i), hits in met.items():
                    foreign = p.foreign[i]
                    spans = [set(range(*s)) - foreign for s in runs(telling_hits(hits, phrase, alone, foreign), phrase, bridge, drift)]
                    spans = sorted(spans, key=lambda s: (-len(s), min(s, default=0)))
                    if not spans or len(spans[0]) < least:
                        continue
                    covered = len(set().union(*spans[:pieces]))
                    if covered >= share * p.size[i]:
                        out.append((int(segment.ids[d]), i, min(1.0, covered / max(1, p.size[i])), len(spans[0])))
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int32()))], names=["doc_id", "item_id", "coverage", "longest"])

    return index.mapInArrow(search, "doc_id long, item_id long, coverage double, longest int")


def leaked_items(docs: DataFrame, items: DataFrame, **options: float) -> DataFrame:
    """Index ``docs`` (doc_id, text) and search it for ``items`` (item_id, text); see :func:`search_index`."""
    return search_index(build_index(docs), items, **options)
