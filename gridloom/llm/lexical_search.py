"""Ranked lexical search by Block-Max MaxScore over an index in shards.

A task that reads documents also indexes them: each shard holds the compressed posting lists of some
megabytes of text, in blocks whose bounds are kept apart from their bytes. A search streams the
shards; in each, list bounds divide an item's terms into essential lists, which are read, and the
others, whose block bounds reject candidates before a block is decompressed. Every task
keeps the best documents of the shards it has seen, and the tasks' heaps are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import stored, table
from gridloom.llm.elias_fano import pack, unpack

TOP = 50
#: Text bytes from which a shard is closed; postings of a block; (item, term) rows that are searched at once.
SHARD_BYTES = 8 << 20
BLOCK = 128
BATCH_TERMS = 400_000
#: A block's bound is taken over these ranges of term frequencies (upper ends), each with its shortest document.
CLASSES = np.array([1, 2, 3, 4, 8, 16, 64])

#: ASCII bytes outside of terms become blanks and A-Z lower case; bytes of other characters belong to terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_INDEX = "n_docs long, n_terms long, terms binary, df binary, blob binary"
#: So that the few large rows of an index leave the writer's memory.
_LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(32 << 20)}


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in their order."""
    return [] if text is None else text.encode("utf-8", "replace").translate(_TERM_BYTES).split()


def impact(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """What a term of weight 1 adds to a document of ``n`` terms: whole numbers, rounded down."""
    m = 50 + (50 * n * docs) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def varint(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of seven bits, the lowest first, the last one of a value below 128; and where each value begins."""
    v = values.astype(np.uint64)
    size = 1 + sum((v >= np.uint64(1 << (7 * k))).astype(np.int64) for k in range(1, 5))
    starts = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(starts[-1], dtype=np.uint8)
    for k in range(5):
        has = size > k
        byte = (v[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[:-1][has] + k] = byte + np.where(size[has] > k + 1, 128, 0).astype(np.uint64)
    return out, starts


def unvarint(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    shift = np.arange(len(raw)) - np.repeat(starts, ends + 1 - starts)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * shift), starts)


class _Ids(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = value = len(self)
        return value


def build_shard(ids: list[int | None], texts: list[list[bytes]]) -> dict:
    """The index row of some documents, each with one term at least."""
    known = _Ids()
    lengths = np.array([len(ts) for ts in texts], dtype=np.int64)
    term = np.fromiter((known[t] for ts in texts for t in ts), dtype=np.int64, count=int(lengths.sum()))
    keys, tf = np.unique(term * len(texts) + np.repeat(np.arange(len(texts)), lengths), return_counts=True)
    term, doc = np.divmod(keys, len(texts))
    df = np.bincount(term, minlength=len(known))
    first = np.concatenate([[0], np.cumsum(-(-df // BLOCK))])  # the blocks of each term
    place = np.arange(len(keys)) - np.repeat(np.cumsum(df) - df, df)
    block = np.repeat(first[:-1], df) + place // BLOCK
    starts = np.flatnonzero(place % BLOCK == 0)
    gap = np.diff(doc, prepend=0)
    gap[starts] = doc[starts]
    raw, at = varint(np.column_stack([gap, tf]).ravel())
    group = block * 8 + np.searchsorted(CLASSES, tf)
    order = np.argsort(group, kind="stable")
    pair = np.flatnonzero(np.diff(group[order], prepend=-1))
    ends = np.append(starts[1:], len(keys)) - 1
    arrays = {
        "ids": np.array([0 if i is None else i for i in ids], dtype=np.int64),
        "null": np.array([i is None for i in ids], dtype=np.uint8),
        "n": lengths,
        "first": first.astype(np.uint32),
        "last": doc[ends].astype(np.uint32),
        "count": (ends - starts + 1).astype(np.uint8),
        "at": np.append(at[:-1:2][starts], len(raw)).astype(np.uint32),
        "pairs": np.searchsorted(group[order][pair] // 8, np.arange(first[-1])).astype(np.uint32),
        "pair_tf": np.maximum.reduceat(tf[order], pair).astype(np.uint32),
        "pair_n": np.minimum.reduceat(lengths[doc][order], pair).astype(np.uint32),
        "raw": raw,
    }
    return {"n_docs": len(texts), "n_terms": int(lengths.sum()), "terms": b" ".join(known), "df": df.astype("<u4").tobytes(), "blob": pack(arrays)}


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard of ``docs(doc_id, text)``; nothing is shuffled, and what a task holds is bounded by ``shard_bytes`` and the longest text.

    ``n_docs, n_terms`` of the shard, its ``terms`` with their ``df``, and ``blob`` with the lists. Indexes of
    several tables can be united: no value depends on other shards. Texts without terms are left out.
    """

    def build(batches):
        ids, texts, size = [], [], 0
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None), pdf["text"]):
                if terms := terms_of(text):
                    ids.append(None if doc_id is None else int(doc_id))
                    texts.append(terms)
                    size += len(text)
                if size >= shard_bytes:
                    yield pd.DataFrame([build_shard(ids, texts)])
                    ids, texts, size = [], [], 0
        if texts:
            yield pd.DataFrame([build_shard(ids, texts)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(build, _INDEX)


class Shard:
    """The lists of a shard, decoded block by block where a search asks for them."""

    def __init__(self, terms: bytes, blob: bytes, docs: int, length: int):
        self.a = a = unpack(blob)
        self.docs, self.length = docs, length
        self.term_at = {t: i for i, t in enumerate(terms.split(b" "))}
        self.n = a["n"].astype(np.int64)
        self.first, self.last, self.count = a["first"].astype(np.int64), a["last"].astype(np.int64), a["count"].astype(np.int64)
        bounds = impact(a["pair_tf"].astype(np.int64), a["pair_n"].astype(np.int64), docs, length)
        self.bound = np.maximum.reduceat(bounds, a["pairs"])
        self.list_bound = np.maximum.reduceat(self.bound, self.first[:-1])
        self.read: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.decoded = 0

    def _decode(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks, ascending, one after the other."""
        self.decoded += len(blocks)
        at, raw = self.a["at"].astype(np.int64) if not hasattr(self, "at") else self.at, self.a["raw"]
        self.at = at
        if blocks[-1] - blocks[0] + 1 == len(blocks):
            part = raw[at[blocks[0]] : at[blocks[-1] + 1]]
        else:
            part = np.concatenate([raw[at[b] : at[b + 1]] for b in blocks])
        values = unvarint(part)
        gaps, tf = values[::2], values[1::2]
        count = self.count[blocks]
        starts = np.cumsum(count) - count
        total = np.cumsum(gaps)
        docs = total - np.repeat(total[starts] - gaps[starts], count)
        return docs, impact(tf, self.n[docs], self.docs, self.length)

    def postings(self, term: int, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a list, or of its ``blocks`` (numbers within the list, ascending)."""
        first, end = self.first[term], self.first[term + 1]
        if term not in self.read:
            n = int(self.count[first:end].sum())
            self.read[term] = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(end - first, bool)
        docs, impacts, done = self.read[term]
        missing = np.flatnonzero(~done) if blocks is None else blocks[~done[blocks]]
        if len(missing):
            d, f = self._decode(first + missing)
            where = _ranges(missing * BLOCK, self.count[first + missing])
            docs[where], impacts[where], done[missing] = d, f, True
        if blocks is None:
            return docs, impacts
        where = _ranges(blocks * BLOCK, self.count[first + blocks])
        return docs[where], impacts[where]

    def search(self, terms: list[int], weights: list[int], top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, among them every one of the ``top`` best that scores ``floor`` or more."""
        lists = sorted((w * int(self.list_bound[t]), t, w) for t, w in zip(terms, weights) if w > 0)
        below = np.concatenate([[0], np.cumsum([b for b, _, _ in lists], dtype=np.int64)]).astype(np.int64)  # bound of a document that only the first i lists hold
        score = np.zeros(len(self.n), dtype=np.int64)
        floor, i = max(floor, 1), len(lists)
        while i and below[i] >= floor:  # essential lists
            i -= 1
            _, t, w = lists[i]
            docs, f = self.postings(t)
            score[docs] += w * f
            floor = max(floor, _best(score, top))
        found = np.flatnonzero((score > 0) & (score + below[i] >= floor))
        if i and len(found):
            blocks, bounds = [], np.zeros((i + 1, len(found)), dtype=np.int64)
            for j, (_, t, w) in enumerate(lists[:i]):
                first, end = self.first[t], self.first[t + 1]
                at = np.searchsorted(self.last[first:end], found)
                blocks.append(at)
                inside = at < end - first
                bounds[j + 1] = bounds[j] + np.where(inside, w * self.bound[first + np.minimum(at, end - first - 1)], 0)
            keep = np.arange(len(found))
            for j in range(i - 1, -1, -1):
                keep = keep[score[found[keep]] + bounds[j + 1][keep] >= floor]
                if not len(keep):
                    break
                _, t, w = lists[j]
                at = blocks[j][keep]
                inside = at < self.first[t + 1] - self.first[t]
                if inside.any():
                    docs, f = self.postings(t, np.unique(at[inside]))
                    wanted = found[keep]
                    place = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
                    score[wanted] += np.where(docs[place] == wanted, w * f[place], 0)
                    floor = max(floor, _best(score[wanted], top))
            found = found[keep]
        found = found[score[found] >= floor]
        return found, score[found]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``count`` of each."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def _best(scores: np.ndarray, top: int) -> int:
    """The ``top``-th largest of lower bounds of scores; 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - top)[len(scores) - top]) if len(scores) >= top else 0


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``, each once; the texts of rows with one id are one item, a null text has no terms."""

    @F.pandas_udf("array<binary>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(terms_of(t))) for t in texts])

    return items.select("item_id", F.explode(of("text")).alias("term")).distinct()


def document_counts(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """How many documents hold each of ``terms``; reads only the dictionaries of the shards."""
    sent = index.sparkSession.sparkContext.broadcast(frozenset(terms))

    def count(batches):
        for pdf in batches:
            for known, df in zip(pdf["terms"], pdf["df"]):
                rows = [(t, n) for t, n in zip(known.split(b" "), np.frombuffer(df, "<u4").tolist()) if t in sent.value]
                yield pd.DataFrame(rows, columns=["term", "n"])

    rows = index.select("terms", "df").mapInPandas(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["term"]): r["n"] for r in rows}


def search(index: DataFrame, items: DataFrame, top: int = TOP, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of a stored index for each row of ``items(item_id, text)``.

    Equal scores go by ascending ``doc_id``, null first. Documents without a term of the item, and items
    without a term that the documents hold, have no rows. Rows of documents with one id are ranked each on its own.

    Items are sent to the tasks in batches of about ``batch_terms`` (item, term) rows, so a
    list of any length is searched with bounded memory. Of each item a task returns
    ``top`` rows at most, and a window merges them.
    """
    facts = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    docs, length = facts[0] or 0, facts[1] or 0
    wanted = stored(item_terms(items), "search-terms")
    kind = items.schema["item_id"].dataType.simpleString()
    batches = max(1, -(-2 * wanted.count() // batch_terms)) if docs else 0
    result = items.sparkSession.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    for batch in range(batches):
        rows = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == batch).collect()
        counts = document_counts(index, sorted({bytes(r["term"]) for r in rows}))
        queries: dict = {}
        for r in rows:
            if n := counts.get(bytes(r["term"])):
                queries.setdefault(r["item_id"], []).append((bytes(r["term"]), math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1)))))
        sent = items.sparkSession.sparkContext.broadcast(queries)
        result = result.unionByName(index.select("terms", "blob").mapInPandas(_searcher(sent, docs, length, top), result.schema))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _searcher(sent, docs: int, length: int, top: int):
    """A task over shards: the best of each item so far bounds the search of the next shard."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict = {}
        for pdf in batches:
            for terms, blob in zip(pdf["terms"], pdf["blob"]):
                shard = Shard(terms, blob, docs, length)
                for item, query in sent.value.items():
                    present = [(shard.term_at[t], w) for t, w in query if t in shard.term_at]
                    if not present:
                        continue
                    known = best.get(item)
                    floor = int(known[0][-1]) if known is not None and len(known[0]) == top else 0
                    found, scores = shard.search([t for t, _ in present], [w for _, w in present], top, floor)
                    if not len(found):
                        continue
                    null, ids = shard.a["null"][found], shard.a["ids"][found]
                    if known is not None:
                        scores, null, ids = (np.concatenate(x) for x in zip(known, (scores, null, ids)))
                    order = np.lexsort((ids, 1 - null, -scores))[:top]
                    best[item] = scores[order], null[order], ids[order]
        for item, (scores, null, ids) in best.items():
            doc_id = pd.Series(ids, dtype="Int64").mask(null.astype(bool))
            yield pd.DataFrame({"item_id": [item] * len(ids), "doc_id": doc_id, "score": scores})

    return run


def stored_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """:func:`build_index`, written to the shared folder."""
    return stored(build_index(docs, shard_bytes), "search-index", **_LARGE_ROWS)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(stored_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH term AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS r FROM documents)
), posting AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM term GROUP BY r, term
), doc AS (SELECT r, sum(tf)::BIGINT AS n FROM posting GROUP BY r
), facts AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM doc
), weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), facts
), item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, p.r, any_value(p.doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
  FROM item JOIN posting p USING (term) JOIN weight USING (term) JOIN doc d ON p.r = d.r, facts GROUP BY item_id, p.r
), ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
